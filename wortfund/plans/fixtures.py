"""Inputs of the checked queries, derived from the given tables.

`documents` plays the article table. The given texts hold no wiki markup, so `markup` puts some in,
at every place of a frequent word, the same way in Spark and in SQL, and adds the raw web pages.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wortfund.plans import jobs
from wortfund.session import scratch_path
from wortfund.sources.buckets import write_bucketed
from wortfund.sources.lists import default_stopwords
from wortfund.sources.tables import read_articles, read_layout, read_titles

TITLE_PATTERN = "<title>(.*?)</title>"

# (text found, text put in its place), one after another over the whole text.
MARKUP = [
    (" the ", " {{the|{{of}}\n|{{{1}}} }} "),
    (" of ", " [[of that|OF]] "),
    (" and ", " ''and'' "),
    (" to ", ' <ref name="x">to</ref> '),
    (" in ", " [[in]] "),
    (" on ", " [http://x.example on line] "),
    (" is ", " <br/>is "),
    (" that ", " [[File:that.png]] "),
    (" for ", ' <div class="a"><div>for</div></div> '),
    (" with ", "\n* \n----\n#REDIRECT [[x]]\n:\n;\n#  \n* item\n"),
    (" de ", ' <span style="s">de <span>x</span></span> '),
    (" la ", " '''la''' "),
    (" le ", " {| class |- | le |} "),
    (" les ", " <nowiki>les<nowiki>x</nowiki></nowiki> "),
    (" que ", " <small>que</small>   "),
    (" et ", "\n== et ==\n"),
    (" der ", " [[Datei:der|mini|x]] [[der]] "),
    (" die ", " {{{die}}} "),
    (" und ", " <math>und</math> &amp; &quot; "),
    (" el ", ' [[:en:el|el]] <ref name="a/b">el</ref> <q>el</q> '),
    (" en ", "\n\n\n\nen   \n"),
    (" dans ", " |TEMPLATE| "),
    (" no ", "\n;\n"),
]
MARKUP_END = "\n----\n\n*\n;\n\n"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_paths: dict[tuple, str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, write) -> str:
    """Path of a table that `write(path)` makes once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _paths:
        path = scratch_path(spark, name)
        write(path)
        _paths[key] = path
    return _paths[key]


def in_files(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Some columns of a given table, from a copy of 64 files.

    A given table may lie in one Parquet row group, which one task would read.
    """
    rows = table(spark, sf_dir, name).select(*columns)
    path = stored(spark, sf_dir, f"{name}-files", lambda p: rows.repartition(64).write.parquet(p, compression="zstd"))
    return spark.read.schema(rows.schema).parquet(path)


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_files(spark, sf_dir, "documents", "doc_id", "text").select(
        F.col("doc_id").alias("docid"),
        F.concat(F.lit("T"), F.col("doc_id").cast("string")).alias("title"),
        F.col("text").alias("wikitext"),
    )


def page_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return in_files(spark, sf_dir, "pages", "page_id", "html").select(
        F.col("page_id").alias("docid"),
        F.regexp_extract("html", TITLE_PATTERN, 1).alias("title"),
        F.col("html").alias("wikitext"),
    )


def markup(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    for found, put in MARKUP:
        text = F.replace(text, F.lit(found), F.lit(put))
    documents = in_files(spark, sf_dir, "documents", "doc_id", "text").select(
        F.col("doc_id").alias("docid"), F.concat(text, F.lit(MARKUP_END)).alias("body")
    )
    pages = in_files(spark, sf_dir, "pages", "page_id", "html").select(
        (-1 - F.col("page_id")).alias("docid"), F.col("html").alias("body")
    )
    return documents.unionByName(pages)


def xml_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`documents` as rows of the XML page schema."""
    return table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("id"),
        (F.col("doc_id") % 3).alias("ns"),
        F.concat(F.lit("T"), F.col("doc_id").cast("string")).alias("title"),
        F.struct(F.struct(F.col("text").alias("_VALUE")).alias("text")).alias("revision"),
    )


def stored_index(spark: SparkSession, sf_dir: str, layout: str, column: str = "word") -> DataFrame:
    """The index of `documents`, read back from a table bucketed by `column`."""

    def write(path):
        stop = default_stopwords(spark)
        jobs.write_index(articles(spark, sf_dir), stop, layout, path, column, buckets=16)

    return read_layout(spark, stored(spark, sf_dir, f"{layout}-{column}", write), layout)


def stored_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The articles, read back from a table bucketed by docid."""
    path = stored(
        spark, sf_dir, "articles", lambda p: write_bucketed(articles(spark, sf_dir), p, "docid", 16)
    )
    return read_articles(spark, path)


def kept_articles(spark: SparkSession, sf_dir: str, rows=articles) -> tuple[DataFrame, DataFrame]:
    """Articles loaded into a keyed table, and the table of titles that is kept with them."""
    path = stored(
        spark,
        sf_dir,
        f"kept-{rows.__name__}",
        lambda p: jobs.upsert_articles(spark, rows(spark, sf_dir), p, 16),
    )
    return read_articles(spark, path), read_titles(spark, path)


def deleted_docids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that a later load deletes, some of which it loads again."""
    docids = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("docid"))
    return docids.where(F.col("docid") % 10 == 3)


def reloaded_index(spark: SparkSession, sf_dir: str, layout: str, docids: int) -> str:
    """Path of an index of `documents` into which the web pages were loaded, under docids that were there, and from which
    documents were deleted."""

    def write(path):
        stop = default_stopwords(spark)
        jobs.upsert_index(spark, articles(spark, sf_dir), stop, layout, path, "word", 16, docids=docids)
        jobs.upsert_index(
            spark,
            page_articles(spark, sf_dir),
            stop,
            layout,
            path,
            "word",
            16,
            deleted=deleted_docids(spark, sf_dir),
            docids=docids,
        )

    return stored(spark, sf_dir, f"reloaded-{layout}-{docids}", write)


# The elements that go with their content, those whose tags go, and the single tags that go; written down
# here once more, so that the texts below do not depend on the rules that they check.
DROPPED = (
    "table gallery math code syntaxhighlight score noinclude onlyinclude includeonly categorytree ce graph hiero imagemap "
    "indicator inputbox ref references source timeline templatedata time var ruby rb dl ol ul"
).split() + ["math chem"]
UNWRAPPED = (
    "h1 h2 h3 h4 h5 h6 small blockquote sup sub u del ins s p abbr b bdi bdo cite data dfn em i kbd mark q samp strong big "
    "center font tt div poem pre"
).split()
SINGLE = ["<b/>", "<ref/>", '<ref name="x" />', "<references/>", "<references a />", "<hr>", "<wbr>", "<nowiki />"]


def element_texts(text: str, kind: str) -> tuple[str, str]:
    """SQL of a text in which every element of a kind stands bare, with attributes, over lines, closed twice and unclosed, and of
    what is left of it; one of them holds the text of the expression `text`, which should hold no tags."""
    body, left = ["'begin '"], ["'begin '"]
    if kind == "single":
        for tag in SINGLE:
            body.append(f"'a{tag}b\n'")
            left.append("'ab\n'")
        return " || ".join([text, *body]), " || ".join([text, *left])
    keeps = kind == "keep"
    for tag in UNWRAPPED if keeps else DROPPED:
        over_lines = f'<{tag} k="v">y\nz</{tag}>'
        # a quote does not go over lines
        kept_lines = over_lines if tag == "q" else "y\nz"
        body += [f"'1<{tag}>'", text if tag in ("p", "table") else "'x'", f"'</{tag}>2{over_lines}3</{tag}>4<{tag}>5\n'"]
        left += ["'1'", (text if tag == "p" else "'x'") if keeps else "''", f"'2{kept_lines if keeps else ''}3</{tag}>4<{tag}>5\n'"]
    return " || ".join(body), " || ".join(left)


def without_tags(text: str) -> str:
    """SQL: a text without what could be part of a tag."""
    return f"replace(replace(coalesce({text}, ''), '<', ' '), '>', ' ')"


def elements(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """(docid, body): every document's text among all elements of a kind."""
    body, _ = element_texts(without_tags("text"), kind)
    documents = in_files(spark, sf_dir, "documents", "doc_id", "text")
    return documents.select(F.col("doc_id").alias("docid"), F.expr(body).alias("body"))


def damaged(docid):
    """How a page of the damaged dump is damaged, if it is: an entity that is not defined, an element without its end, an
    id that is no number."""
    return docid % 5


def damaged_dump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of a dump of `documents` that holds malformed pages."""
    escaped = F.coalesce("text", F.lit(""))
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ("\r", "&#13;")):
        escaped = F.replace(escaped, F.lit(char), F.lit(entity))
    kind = damaged(F.col("doc_id"))
    docid = F.col("doc_id").cast("string")
    return table(spark, sf_dir, "documents").select(
        F.concat(
            F.lit("<page><title>T"),
            docid,
            F.lit("</title><ns>0</ns><id>"),
            F.when(kind == 1, F.lit("x")).otherwise(F.lit("")),
            docid,
            F.lit("</id><revision><text>"),
            F.when(kind == 2, F.lit("&nope;")).otherwise(F.lit("")),
            escaped,
            F.when(kind == 3, F.lit("")).otherwise(F.lit("</text>")),
            F.lit("</revision></page>"),
        ).alias("value")
    )
