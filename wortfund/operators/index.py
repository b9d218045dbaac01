"""Index building and conversion between the three index layouts.

Postings and positions are built without a shuffle: no state larger than one article, or than a
million words. Only the by-term layout, which gathers a word over all documents, moves data.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wortfund.functions.tokens import build_index_keys, tokenize_display
from wortfund.operators import runs

# Width of a chunk of the by-term layout, in docids. It belongs to the layout: tables that are to be
# merged need the same one. A row holds at most so many postings.
CHUNK_DOCIDS = 200_000

#: Words that a task numbers and sorts at a time, besides those of the article that goes beyond.
TOKENS_AT_ONCE = 1 << 20


def token_positions(articles: DataFrame) -> DataFrame:
    """(docid, pos, word): every token with its 0-based place, stop words included."""
    return articles.select(
        "docid", F.posexplode(tokenize_display(F.col("wikitext"))).alias("pos", "token")
    ).select("docid", "pos", F.lower("token").alias("word"))


def stopword_filter(rows: DataFrame, stopwords: DataFrame) -> DataFrame:
    """Drop rows whose word is a stop word, after numbering, so that positions keep their gaps.

    No broadcast hint: Spark broadcasts the list when its size is below the threshold and
    joins by shuffle when it is not.
    """
    return rows.join(stopwords.select("word"), "word", "left_anti")


def _entries(batches):
    """(word, docid, occurences) of articles from their words in order. An article's words are numbered, and its runs of equal ones cut.

    Rows of neighbouring articles come out by word and docid: a sort by these, which every stored layout needs, then merges long runs.
    """
    for batch in batches:
        last = np.cumsum(np.diff(batch["words"].offsets.to_numpy()))
        part = np.maximum(last - 1, 0) // TOKENS_AT_ONCE
        cuts = np.concatenate([[0], np.flatnonzero(np.diff(part)) + 1, [len(batch)]])
        for some in (batch.slice(a, b - a) for a, b in zip(cuts, cuts[1:])):
            start = some["words"].offsets.to_numpy()
            tokens = some["words"].flatten().dictionary_encode()
            if not len(tokens):
                continue
            # numbers of words and of articles in the order wanted; articles of one docid stay apart
            by_word = pc.sort_indices(tokens.dictionary).to_numpy()
            by_docid = pc.sort_indices(some["docid"]).to_numpy()
            word, article = np.empty_like(by_word, dtype=np.int64), np.empty_like(by_docid, dtype=np.int64)
            word[by_word], article[by_docid] = np.arange(len(by_word)), np.arange(len(by_docid))
            own = np.repeat(np.arange(len(some)), np.diff(start))
            key = word[tokens.indices.to_numpy()] * len(some) + article[own]
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            places = (order - (start[:-1] - start[0])[own[order]]).astype(np.int32)
            ends = np.append(first, len(order)).astype(np.int32)
            yield pa.record_batch(
                [
                    tokens.dictionary.take(pa.array(by_word[key[first] // len(some)])),
                    some["docid"].take(pa.array(by_docid[key[first] % len(some)])),
                    pa.ListArray.from_arrays(pa.array(ends), pa.array(places)),
                ],
                names=["word", "docid", "occurences"],
            )


def flatten_entries(articles: DataFrame) -> DataFrame:
    """(word, docid, occurences) of every article, stop words included."""
    words = articles.select("docid", build_index_keys(F.col("wikitext")).alias("words"))
    docid = articles.schema["docid"].dataType.simpleString()
    return words.mapInArrow(_entries, f"word string, docid {docid}, occurences array<int>")


def index_postings(articles: DataFrame, stopwords: DataFrame) -> DataFrame:
    """Layout "postings": one row per word and document, positions ascending."""
    return stopword_filter(flatten_entries(articles), stopwords).select(
        "word", "docid", "occurences"
    )


def index_positions(articles: DataFrame, stopwords: DataFrame) -> DataFrame:
    """Layout "positions": one row per occurrence."""
    return stopword_filter(token_positions(articles), stopwords).select(
        "word", "docid", F.col("pos").alias("occurence")
    )


def long_words(postings: DataFrame, max_postings: int = CHUNK_DOCIDS) -> DataFrame:
    """(word, chunks) of the words with more than `max_postings` postings: a report, no layout uses it.

    Counts are combined before their shuffle.
    """
    return (
        postings.groupBy("word")
        .agg(F.count("*").alias("n"))
        .where(F.col("n") > max_postings)
        .select("word", F.ceil(F.col("n") / max_postings).cast("int").alias("chunks"))
    )


def chunk_of(docid: Column, docids: int = CHUNK_DOCIDS) -> Column:
    """floor(docid / docids) in whole numbers: the chunk depends on the docid alone."""
    width = F.lit(docids).cast("long")
    return F.call_function("div", docid - F.pmod(docid, width), width)


def index_by_term(postings: DataFrame, docids: int = CHUNK_DOCIDS) -> DataFrame:
    """Layout "by term": per word and chunk of docids the list of (docid, occurences), by docid.

    A row holds at most `docids` postings, whatever the word, so no task and no row has to hold a
    whole hot word. Chunks follow each other in docid order, and every load has the same keys. The
    postings are read once and move once; sorted, they are cut into lists.
    """
    rows = postings.select("word", chunk_of(F.col("docid"), docids).alias("chunk"), "docid", "occurences")
    return put_in_lists(rows.repartition("word", "chunk"), ["word", "chunk"])


def put_in_lists(rows: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, docid, occurences), the rows of a key in one partition -> (keys, inv_index), sorted by keys in each partition."""
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = ", ".join(f"`{k}` {kinds[k]}" for k in keys) + f", inv_index array<struct<docid: {kinds['docid']}, occurences: {kinds['occurences']}>>"
    return rows.sortWithinPartitions(*keys, "docid", "occurences").mapInArrow(runs.entries_to_lists(keys), schema)


def without_documents(rows: DataFrame, docids: DataFrame) -> DataFrame:
    """Postings or positions but those of the given documents. Where Spark can broadcast the docids, nothing moves."""
    return rows.join(docids.select("docid").distinct(), "docid", "left_anti").select(*rows.columns)


def by_term_without_documents(
    by_term: DataFrame, docids: DataFrame, width: int = CHUNK_DOCIDS
) -> DataFrame:
    """The same for by-term rows. Chunks that hold none of the documents pass as they are; the lists of the others are
    taken apart, and come out as rows of one entry, which merge_by_term puts together."""
    gone = docids.select("docid").distinct()
    chunks = gone.select(chunk_of(F.col("docid"), width).alias("chunk")).distinct()
    names = ["word", "chunk", "inv_index"]
    untouched = by_term.join(chunks, "chunk", "left_anti").select(*names)
    entries = by_term.join(chunks, "chunk", "left_semi").select(
        "word", "chunk", F.explode("inv_index").alias("entry")
    )
    kept = entries.withColumn("docid", F.col("entry.docid")).join(gone, "docid", "left_anti")
    return untouched.unionByName(kept.select("word", "chunk", F.array("entry").alias("inv_index")))


def _last_loads(parts: list[DataFrame], loaded: list[DataFrame] | None, without) -> list[DataFrame]:
    """The parts, oldest first, each without the documents that a later one loaded again."""
    if loaded is None:
        return parts
    if len(loaded) != len(parts):
        raise ValueError("one table of loaded documents for each part")
    out = []
    for i, rows in enumerate(parts):
        later = [d.select("docid") for d in loaded[i + 1 :]]
        out.append(without(rows, reduce(DataFrame.unionByName, later)) if later else rows)
    return out


def index_merge(
    parts: list[DataFrame], docids: int = CHUNK_DOCIDS, loaded: list[DataFrame] | None = None
) -> DataFrame:
    """Several partial indexes in layout "postings" -> one index in layout "by term".

    Parts come oldest first. `loaded` holds, for each part, the docids of all documents that it was built from or that were
    deleted with it: a document of a later part takes the place of an older version, whose words all go, also those that
    the new version lacks. Without it, no document may stand in two parts.
    """
    rows = _last_loads(parts, loaded, without_documents)
    return index_by_term(reduce(DataFrame.unionByName, rows), docids)


def merge_postings(parts: list[DataFrame], loaded: list[DataFrame]) -> DataFrame:
    """The same with the result in the layout of the parts, "postings" or "positions": they are only filtered."""
    return reduce(DataFrame.unionByName, _last_loads(parts, loaded, without_documents))


def merge_by_term(
    parts: list[DataFrame],
    docids: int = CHUNK_DOCIDS,
    loaded: list[DataFrame] | None = None,
    by: dict[str, Column] | None = None,
) -> DataFrame:
    """The same for partial indexes that are already in layout "by term", with chunks of one width.

    Rows of one word and chunk are put together as they are; a list is taken apart only if its chunk holds a document that
    was loaded again. `by` names further columns, which depend on word and chunk alone: the rows then come out with them, and those
    alike in them in one partition.
    """
    parts = [p.select("word", "chunk", "inv_index") for p in parts]
    parts = _last_loads(parts, loaded, lambda p, gone: by_term_without_documents(p, gone, docids))
    rows = reduce(DataFrame.unionByName, parts).select("word", "chunk", "inv_index").withColumns(by or {})
    keys = [*(by or {}), "chunk", "word"]
    rows = rows.repartition(*(by or ["word", "chunk"])).sortWithinPartitions(*keys).select(*keys, "inv_index")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(runs.lists_to_lists(keys), schema).select("word", "chunk", "inv_index", *(by or {}))


def recut_by_term(by_term: DataFrame, docids: int) -> DataFrame:
    """By-term rows cut into chunks of another width."""
    return index_by_term(by_term_to_postings(by_term), docids)


_COUNTS = "chunks array<struct<chunk: bigint, documents: bigint, occurrences: bigint>>"


def _dictionary(sent: DataFrame, docids: int | None = None) -> DataFrame:
    """(word, chunks), any number of rows a word -> a dictionary; words move once. `docids`: see lists_of_counts."""
    rows = sent.repartition("word").sortWithinPartitions("word")
    return rows.mapInArrow(runs.lists_of_counts(docids), f"word string, documents bigint, occurrences bigint, {_COUNTS}")


def term_dictionary(index: DataFrame, docids: int = CHUNK_DOCIDS) -> DataFrame:
    """(word, documents, occurrences, chunks) of an index in any layout: in how many documents a word stands, how often in
    all, and both for each chunk of docids. A task sends a word of some hundred thousand rows once, and words move once."""
    if "inv_index" in index.columns:
        each = F.transform("inv_index", lambda e: F.size(e["occurences"]))
        total = F.aggregate(each, F.lit(0).cast("long"), lambda n, x: n + x)
        counts = index.select("word", F.col("chunk").cast("long").alias("chunk"), F.size("inv_index").cast("long").alias("documents"), total.alias("occurrences"))
        return _dictionary(counts.mapInArrow(runs.counts_to_lists(False), f"word string, {_COUNTS}"))
    one, docid = F.lit(1).cast("long"), F.col("docid").cast("long")
    places = "occurence" in index.columns
    occurrences = one if places else F.size("occurences").cast("long")
    chunk = docid if places else chunk_of(docid, docids)
    counts = index.select("word", chunk.alias("chunk"), one.alias("documents"), occurrences.alias("occurrences"))
    return _dictionary(counts.mapInArrow(runs.counts_to_lists(places), f"word string, {_COUNTS}"), docids if places else None)


def merge_dictionaries(parts: list[DataFrame], removed: list[DataFrame] | None = None) -> DataFrame:
    """The dictionary of indexes without a document in common, less those of postings that were removed from them."""

    def less(chunk):
        return F.struct(chunk["chunk"].alias("chunk"), *[(-chunk[c]).alias(c) for c in ("documents", "occurrences")])

    rows = [p.select("word", "chunks") for p in parts]
    rows += [p.select("word", F.transform("chunks", less).alias("chunks")) for p in removed or []]
    return _dictionary(reduce(DataFrame.unionByName, rows))


def postings_to_positions(postings: DataFrame) -> DataFrame:
    return postings.select("word", "docid", F.explode("occurences").alias("occurence"))


def positions_to_postings(positions: DataFrame) -> DataFrame:
    """A group is one word of one article, so its size is bounded by the article. Rows that lie together, as in a stored index, move
    as one."""
    kinds = {f.name: f.dataType.simpleString() for f in positions.schema}
    schema = f"word {kinds['word']}, docid {kinds['docid']}, occurences array<{kinds['occurence']}>"
    rows = positions.select("word", "docid", "occurence").mapInArrow(runs.places_to_lists, schema)
    return rows.repartition("word", "docid").sortWithinPartitions("word", "docid").mapInArrow(runs.lists_of_places, schema)


def by_term_to_postings(by_term: DataFrame) -> DataFrame:
    return by_term.select("word", F.inline("inv_index")).select("word", "docid", "occurences")


def postings_to_by_term(postings: DataFrame, docids: int = CHUNK_DOCIDS) -> DataFrame:
    return index_by_term(postings, docids)


def positions_to_by_term(positions: DataFrame, docids: int = CHUNK_DOCIDS) -> DataFrame:
    return index_by_term(positions_to_postings(positions), docids)


def by_term_to_positions(by_term: DataFrame) -> DataFrame:
    return postings_to_positions(by_term_to_postings(by_term))
