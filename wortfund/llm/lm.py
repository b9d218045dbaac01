"""Stupid-backoff scores of documents under the n-gram counts of the whole collection.

A document is scored by counts without its own: c(g) is an n-gram's count over all documents less the
count in the document itself, or every n-gram would be known. For a word w after w1,
S(w | w1) = c(w1 w) / c(w1) if c(w1 w) > 0, else BACKOFF * S(w); S(w) = c(w) / N if c(w) > 0, else BACKOFF / (N + 1),
where N counts the words of the other documents. The first word of a document has S(w).

The n-grams are counted and joined by relations: (block, n-gram) entries, a count table partitioned by
the n-gram's hash, a join back by block, a sum for each document. See blocks.py for the form of the
entries. N-grams are known by 64-bit hashes of their words' 64-bit hashes.

A null or empty text has no words: its score is null, its sums 0. Repeated rows are documents of their
own. An empty table gives an empty result. A column of the input named like a new one is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wortfund.llm.blocks import in_blocks, looked_up
from wortfund.llm.common import hand_back_memory, quoted, words

BACKOFF = 0.4

#: Words whose own counts are taken at a time, besides those of the document that goes beyond.
WORDS_AT_ONCE = 1 << 17


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _grams(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a block: each word's hash and document, the hash of each bigram, and the places of their second words."""
    column = table["words"].combine_chunks()
    word = column.flatten().to_numpy(zero_copy_only=False).view(np.uint64)
    count = np.diff(column.offsets.to_numpy())
    doc = np.repeat(np.arange(len(count), dtype=np.int32), count)
    second = np.flatnonzero(doc[1:] == doc[:-1]) + 1
    # one to tell the lengths of n-grams apart
    pair = _mixed(word[second - 1] * np.uint64(3) + np.uint64(1)) + word[second] * np.uint64(0x9E3779B97F4A7C15)
    return word, doc, _mixed(pair), second


def _entries(parts: int):
    def run(table: pa.Table) -> pa.Table:
        word, _, pair, _ = _grams(table)
        block, out = table["block"][0].as_py(), []
        for order, gram in ((1, word), (2, pair)):
            value, count = np.unique(gram, return_counts=True)
            # parts are ranges of the hash, so the parts of a sorted table are slices
            part = ((value >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)
            cut = np.searchsorted(part, np.arange(parts + 1))
            some = np.flatnonzero(cut[1:] > cut[:-1])
            ends = pa.array(np.append(cut[some], len(value)).astype(np.int32))
            columns = [
                pa.array(np.full(len(some), block, dtype=np.int32)),
                pa.array(some.astype(np.int32)),
                pa.array(np.full(len(some), order, dtype=np.int32)),
                pa.ListArray.from_arrays(ends, pa.array(value.view(np.int64))),
                pa.ListArray.from_arrays(ends, pa.array(count.astype(np.int32))),
            ]
            out.append(pa.table(columns, names=["block", "part", "order", "grams", "counts"]))
        hand_back_memory()
        return pa.concat_tables(out)

    return run


def _totals(table: pa.Table) -> pa.Table:
    """A part of the count table: the counts over all blocks, for each block in its own order."""
    out, orders = [], np.asarray(table["order"])
    total_words = 0
    for order in np.unique(orders):
        rows = table.filter(pa.array(orders == order))
        grams, counts = rows["grams"].combine_chunks(), rows["counts"].combine_chunks()
        value, at = np.unique(grams.flatten().to_numpy(), return_inverse=True)
        total = np.bincount(at, weights=counts.flatten().to_numpy(), minlength=len(value)).astype(np.int64)
        if order == 1:
            total_words = int(total.sum())
        offset = grams.offsets.to_numpy()
        for row, block in enumerate(rows["block"].to_pylist()):
            out.append((block, rows["part"][0].as_py(), int(order), total[at[offset[row] : offset[row + 1]]]))
    columns = list(zip(*out)) or [(), (), (), ()]
    kinds = (pa.int32(), pa.int32(), pa.int32(), pa.list_(pa.int64()))
    answers = pa.table({c: pa.array(v, k) for c, v, k in zip(("block", "part", "order", "totals"), columns, kinds)})
    del out, columns
    hand_back_memory()
    return answers


def _without_own(total: np.ndarray, gram: np.ndarray, of: np.ndarray) -> np.ndarray:
    """For each n-gram of a block its total, less its count in the own document. total: of the distinct n-grams in order; of: the
    documents, ascending. Own counts are taken some documents at a time."""
    at = np.unique(gram, return_inverse=True)[1].astype(np.int32)
    left = total[at]
    borders = np.concatenate([[0], np.flatnonzero(of[1:] != of[:-1]) + 1, [len(of)]])
    cuts = np.append(borders[np.unique(np.searchsorted(borders, np.arange(0, len(of), WORDS_AT_ONCE)))], len(of))
    for a, b in zip(cuts, cuts[1:]):
        _, back, count = np.unique(of[a:b].astype(np.int64) * len(total) + at[a:b], return_inverse=True, return_counts=True)
        left[a:b] -= count[back]
    return left


def _scores(total_words: int):
    def run(docs: pa.Table, got: pa.Table) -> pa.Table:
        word, doc, pair, second = _grams(docs)
        got = got.sort_by("part")
        orders = np.asarray(got["order"])
        others, n_docs = [], len(docs)
        for order, gram, of in ((1, word, doc), (2, pair, doc[second])):
            total = got.filter(pa.array(orders == order))["totals"].combine_chunks()
            total = total.flatten().to_numpy() if len(total) else np.empty(0, dtype=np.int64)
            others.append(_without_own(total, gram, of))
        del got, pair, gram, of, total
        length = np.bincount(doc, minlength=n_docs)
        n = (total_words - length)[doc].astype(np.float64)
        one, two = others
        single = np.where(one > 0, one / np.maximum(n, 1), BACKOFF / (n + 1))
        value = single.copy()
        value[second] *= BACKOFF
        known = two > 0
        places = second[known]
        value[places] = two[known] / one[places - 1]
        log = np.bincount(doc, weights=np.log(value), minlength=n_docs)
        hits = np.bincount(doc[places], minlength=n_docs)
        out = pa.table(
            {
                "row": docs["row"].combine_chunks(),
                "lm_words": pa.array(length, pa.int64()),
                "lm_known_bigrams": pa.array(hits, pa.int64()),
                "lm_logsum": pa.array(log, pa.float64()),
                "lm_score": pa.array(log / np.maximum(length, 1), pa.float64(), mask=length == 0),
            }
        )
        del word, doc, second, others, one, two, n, single, value, known, places
        hand_back_memory()
        return out

    return run


def score(df: DataFrame, id_col="doc_id", text_col="text", block_bytes: int | None = None) -> DataFrame:
    """df with lm_words, lm_known_bigrams, lm_logsum (sum of ln S) and lm_score (mean of ln S)."""
    docs, blocks = in_blocks(df, id_col, text_col, block_bytes)
    total_words = df.agg(F.sum(F.size(words(quoted(text_col))).cast("long")).alias("n")).first().n or 0
    docs = docs.select("row", F.transform(words(F.col("row")[text_col]), lambda w: F.xxhash64(w)).alias("words"), "block")
    new = [("lm_words", T.LongType()), ("lm_known_bigrams", T.LongType()), ("lm_logsum", T.DoubleType()), ("lm_score", T.DoubleType())]
    schema = T.StructType([docs.schema["row"], *[T.StructField(c, t) for c, t in new]])
    out = looked_up(
        docs, blocks, _entries(blocks), "block int, part int, order int, grams array<long>, counts array<int>",
        _totals, "block int, part int, order int, totals array<long>", _scores(total_words), schema,
    )
    names = [c for c, _ in new]
    fields = [f.name for f in out.schema["row"].dataType.fields if f.name.lower() not in names]
    return out.select(*[F.col("row")[f].alias(f) for f in fields], *names)
