"""The three jobs: ingest a dump, build an index, run the lookups."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from wortfund.operators import index as I
from wortfund.operators import keyed
from wortfund.operators import lookup as L
from wortfund.operators.clean import clean_article, filter_namespace, project_article
from wortfund.session import drop_scratch, scratch_path
from wortfund.sources import buckets as B
from wortfund.sources import tables as S
from wortfund.sources import versions
from wortfund.sources.xml_dump import scan_all_pages, scan_xml_pages

#: Folders of the tables that the jobs keep.
BUCKETS = 64
#: For the borders of index files: bytes of text in a range and in the sample of articles, articles in it at least, keys for each border.
RANGE_BYTES, SAMPLE_BYTES, SAMPLE_ARTICLES, KEYS_A_BORDER = 8 << 20, 16 << 20, 256, 200
#: Bytes of text that a row of a stored index stands for, about.
ROW_BYTES = 8


def _articles(pages: DataFrame) -> DataFrame:
    return clean_article(project_article(filter_namespace(pages)))


def articles_from_dump(spark: SparkSession, dump: str) -> DataFrame:
    """Cleaned main-namespace articles of an XML dump; no shuffle."""
    return _articles(scan_xml_pages(spark, dump))


def ingest(
    spark: SparkSession,
    dump: str,
    target: str | None = None,
    kind="parquet",
    rejected: str | None = None,
    buckets: int = BUCKETS,
    **options,
) -> dict[str, int] | None:
    """Read, filter and clean a dump, and load its articles into the article table.

    A Parquet table at `target` is keyed: the load replaces the articles whose docid it holds (upsert_articles). To other
    kinds rows are appended, and the target's own key decides.

    A malformed page fails the job. With `rejected`, a folder, its text is appended there instead (column `page`) and all other
    pages are loaded; the result then tells how many `pages` there were and how many were `rejected`. Each page is parsed once: the
    parsed pages are written to a scratch table, good and bad apart, which both outputs read.
    """
    if rejected is None:
        _load_articles(spark, articles_from_dump(spark, dump), target, kind, buckets, options)
        return None
    counts = Observation("pages")
    parsed = scan_all_pages(spark, dump)
    bad = F.col("malformed").isNotNull()
    seen = parsed.observe(counts, F.count("*").alias("pages"), F.count_if(bad).alias("rejected"))
    scratch = scratch_path(spark, "pages")
    seen.withColumn("bad", bad.cast("int")).write.partitionBy("bad").parquet(scratch)
    pages = spark.read.schema(parsed.schema).parquet(scratch)
    pages.where(F.col("bad") == 1).select(F.col("malformed").alias("page")).write.mode("append").parquet(rejected)
    good = pages.where(F.col("bad") == 0).drop("bad", "malformed")
    _load_articles(spark, _articles(good), target, kind, buckets, options)
    drop_scratch(spark, scratch)
    return dict(counts.get)


def _load_articles(spark, articles, target, kind, buckets, options) -> None:
    if kind == "parquet":
        upsert_articles(spark, articles, target, buckets)
    else:
        S.append_articles(articles, target, kind, **options)


def upsert_articles(
    spark: SparkSession,
    loaded: DataFrame,
    path: str,
    buckets: int = BUCKETS,
    order: list[str] | None = None,
    deleted: DataFrame | None = None,
) -> str:
    """Load articles into the keyed table at `path`: a new version of it, in folders by docid, with its table of titles.

    A loaded article replaces the one with its docid; of several loaded ones the last by the columns `order` counts. Articles of the
    docids in `deleted` go. Returns the folder of the new version; versions.drop_old deletes old ones.
    """
    if versions.part(spark, path, "articles"):
        current = S.read_articles(spark, path).select("docid", "title", "wikitext")
        rows = keyed.upsert(current, loaded, ["docid"], order, deleted)
    else:
        rows = keyed.one_row_per_key(loaded, ["docid"], order).select("docid", "title", "wikitext")

    def write(folder: str) -> None:
        B.write_bucketed(rows, f"{folder}/articles", "docid", buckets)
        titles = spark.read.parquet(f"{folder}/articles").select("title", "docid")
        B.write_bucketed(titles, f"{folder}/titles", "title", buckets)

    return versions.publish(spark, path, write)


def build_index(articles: DataFrame, stopwords: DataFrame, layout: str) -> DataFrame:
    """One layout as a lazy DataFrame."""
    if layout == "postings":
        return I.index_postings(articles, stopwords)
    if layout == "positions":
        return I.index_positions(articles, stopwords)
    if layout == "by_term":
        return I.index_by_term(I.index_postings(articles, stopwords))
    raise ValueError(f"unknown index layout: {layout}")


def write_index(
    articles: DataFrame,
    stopwords: DataFrame,
    layout: str,
    path: str,
    column: str,
    buckets: int,
    docids: int = I.CHUNK_DOCIDS,
) -> None:
    """Build an index and append it to a table bucketed by `column` in so many folders.

    By `word` the table serves word lookups from one folder; a second copy by `docid` does the
    same for document lookups. By-term rows lie in folders by chunk of `docids` docids and word, and serve both. This appends:
    a further load of documents that may be there already goes in by upsert_index.
    """
    if layout == "by_term":
        if column != "word":
            raise ValueError("a by-term index is bucketed by word")
        B.write_by_term(build_index(articles, stopwords, "postings"), path, docids, buckets)
    else:
        sample, ranges = _sampled(articles, lambda some: build_index(some, stopwords, layout))
        S.write_layout(build_index(articles, stopwords, layout), layout, path, column, buckets, "append", sample, ranges)


def _sampled(articles: DataFrame, build) -> tuple[DataFrame, int]:
    """Some rows of the index of articles, to draw the borders of its files from, and the number of files wanted: as many as Spark's
    shuffle partitions at most. Borders decide how large the files are, not what is in them."""
    of = articles.agg(F.count("*").alias("n"), F.sum(F.octet_length("wikitext").cast("long")).alias("bytes")).first()
    size = of.bytes or 0
    ranges = max(1, min(int(articles.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // RANGE_BYTES))
    # every so many-th article by its docid's hash, then of their rows what the driver can hold; a row takes two bytes of text or more
    share = max(1, min(of.n // SAMPLE_ARTICLES, size // SAMPLE_BYTES))
    some = articles.where(F.pmod(F.xxhash64("docid"), F.lit(share)) == 0)
    fraction = min(1.0, ranges * KEYS_A_BORDER * 8 / max(1, size // share))
    return build(some).sample(fraction, seed=1), ranges


def _sampled_rows(parts: list[DataFrame]) -> tuple[DataFrame, int]:
    """The same of stored rows, which Spark counts without reading them."""
    n = sum(rows.count() for rows in parts)
    ranges = max(1, min(int(parts[0].sparkSession.conf.get("spark.sql.shuffle.partitions")), n * ROW_BYTES // RANGE_BYTES))
    fraction = min(1.0, ranges * KEYS_A_BORDER / max(1, n))
    return reduce(DataFrame.unionByName, parts).sample(fraction, seed=1), ranges


def listed_docids(spark: SparkSession, docids: DataFrame, path: str) -> DataFrame:
    """The distinct docids, written down at `path`: of a stored list Spark knows how small it is, so that the postings that it is
    compared with stay where they are."""
    docid = docids.schema["docid"].dataType.simpleString()
    docids.select("docid").distinct().write.parquet(path)
    return spark.read.schema(f"docid {docid}").parquet(path)


def upsert_index(
    spark: SparkSession,
    loaded: DataFrame,
    stopwords: DataFrame,
    layout: str,
    path: str,
    column: str = "word",
    buckets: int = BUCKETS,
    order: list[str] | None = None,
    deleted: DataFrame | None = None,
    docids: int = I.CHUNK_DOCIDS,
) -> str:
    """Load articles into the index at `path`: a new version of it, with its term dictionary.

    All postings of a loaded document are replaced by those of its new text, and those of the docids in `deleted` go, in any
    layout. Of several loaded articles of a docid the last by `order` counts. The dictionary is carried on: what the new
    postings count is added, what the replaced ones counted is taken off.
    """
    articles = keyed.one_row_per_key(loaded, ["docid"], order)
    built = build_index(articles, stopwords, "positions" if layout == "positions" else "postings")
    gone = loaded.select("docid")
    if deleted is not None:
        gone = gone.unionByName(deleted.select("docid"))
    listed = scratch_path(spark, "loaded-docids")
    gone = listed_docids(spark, gone, listed)
    published = versions.part(spark, path, "index") is not None
    current = S.read_layout(spark, path, layout) if published else None
    if published and layout == "by_term":
        width = L.by_term_width(current)
        if width is None or width[1] != docids:
            raise ValueError(f"the index at {path} is not cut at {docids} docids")
    # written down: the borders of the files, the files and the dictionary all read it
    scratch = scratch_path(spark, "loaded-index")
    built.write.parquet(scratch, compression=B.COMPRESSION)
    B.drop_shuffles(spark)
    new = spark.read.schema(built.schema).parquet(scratch)

    def write(folder: str) -> None:
        index = f"{folder}/index"
        counted = new
        if layout == "by_term":
            if published:
                parts = [current, I.index_by_term(new, docids)]
                rows = I.merge_by_term(parts, docids, [gone.limit(0), gone])
                B.write_merged_by_term(rows, index, docids, buckets)
            else:
                B.write_by_term(new, index, docids, buckets)
        else:
            names = new.columns
            rows = I.merge_postings([current.select(*names), new], [gone.limit(0), gone]) if published else new
            sample, ranges = _sampled_rows([current.select(*names), new] if published else [new])
            S.write_layout(rows, layout, index, column, buckets, "append", sample, ranges)
            if not published:
                # the same rows, by word, of which less moves
                counted = spark.read.schema(new.schema).parquet(index).select(*names)
        sample, ranges = _sampled_rows([new.select("word"), *([S.read_dictionary(spark, path).select("word")] if published else [])])
        B.write_in_ranges(dictionary(counted), f"{folder}/dictionary", "word", buckets, [], "append", sample, ranges)

    def dictionary(counted: DataFrame) -> DataFrame:
        added = I.term_dictionary(counted, docids)
        if not published:
            return added
        rows = current.select(*(["word", "chunk", "inv_index"] if layout == "by_term" else new.columns))
        if layout == "by_term":
            chunks = gone.select(I.chunk_of(F.col("docid"), docids).alias("chunk")).distinct()
            rows = I.by_term_to_postings(rows.join(chunks, "chunk", "left_semi"))
        removed = I.term_dictionary(rows.join(gone.distinct(), "docid", "left_semi"), docids)
        return I.merge_dictionaries([S.read_dictionary(spark, path), added], [removed])

    target = versions.publish(spark, path, write)
    drop_scratch(spark, scratch)
    drop_scratch(spark, listed)
    return target


def merge_index(
    spark: SparkSession,
    parts: list[str],
    path: str,
    buckets: int,
    docids: int = I.CHUNK_DOCIDS,
    loaded: list[DataFrame] | None = None,
) -> None:
    """Merge stored by-term indexes, oldest first, into a new one at `path`, one row per word and chunk of `docids` docids.

    A part that is cut otherwise, or does not tell how, is cut anew. `loaded`: for each part the docids that it was built from, so that a
    document of a later part replaces its older version; without it, no document may stand in two parts.
    """

    def cut(part: str) -> DataFrame:
        rows = S.read_layout(spark, part, "by_term")
        width = L.by_term_width(rows)
        return rows if width and width[1] == docids else I.recut_by_term(rows, docids)

    index = I.merge_by_term([cut(part) for part in parts], docids, loaded, B.term_folders(docids, buckets))
    B.write_merged_by_term(index, path, docids, buckets, "errorifexists")


def append_index(
    articles: DataFrame,
    stopwords: DataFrame,
    target: str | None = None,
    kind: str = "jdbc",
    **options,
) -> None:
    """Build the layout that the target keeps and append it there under the target's names."""
    index = build_index(articles, stopwords, S.INDEX_LAYOUTS[kind])
    S.append_table(S.to_target_index(index, kind), target, kind, **options)


def run_lookups(
    articles: DataFrame,
    index: DataFrame,
    keys: dict,
    index_by_docid: DataFrame | None = None,
    titles: DataFrame | None = None,
    dictionary: DataFrame | None = None,
) -> DataFrame:
    """(lookup, key, n) for all four key lists, one job instead of one per key.

    `index_by_docid` is a copy of the index bucketed by docid, `titles` the table of titles kept with the articles, and `dictionary`
    the index's term dictionary, which saves reading postings to count them, if there are any.
    """
    by_docid = index if index_by_docid is None else index_by_docid
    if dictionary is None:
        words = L.batch_lookup_word_docs(index, keys["words"])
    else:
        words = L.batch_lookup_word_counts(dictionary, keys["words"])
    counts = {
        "title": (L.batch_lookup_title(articles if titles is None else titles, keys["titles"]), "title"),
        "docid": (L.batch_lookup_docid(articles, keys["article_ids"]), "docid"),
        "doc_words": (L.batch_lookup_doc_words(by_docid, keys["index_ids"]), "docid"),
        "word_docs": (words, "word"),
    }
    return reduce(
        DataFrame.unionByName,
        [
            df.select(F.lit(name).alias("lookup"), F.col(key).cast("string").alias("key"), "n")
            for name, (df, key) in counts.items()
        ],
    )
