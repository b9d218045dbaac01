"""Periodic runs of words: what a text says over and over in a row, found by seeds and extension on diagonals.

A run is a longest stretch of words in which words a period q apart are identical, q being its smallest period, that is
at least max(LEAST_WORDS, REPEATS * q) words long. Its words after the first q are repetition, and may go.

Seeds. In a run of period q the words i and i + q agree on a stretch of at least max(LEAST_WORDS, REPEATS * q) - q
places. So for the lags a..1.5a there is a k, the least such overlap among them, for which every run of such a period
holds two equal k-grams q apart: the k-grams are indexed, and equal ones of one document are paired. As k is at least
2q, a k-gram cannot stand again between the two (it would have a period of its own that divides q, and so would the
run): pairs of *neighbouring* equal k-grams are enough, which are no more than there are words. By the same reason a
seed's lag is the smallest period of any stretch long enough to be a run. K-grams are numbered exactly, by doubling;
those that stand once in their document are left out as soon as they do.

Extension. A seed lies on the diagonal of its lag. For each lag the furthest place covered so far is kept: a seed below
it belongs to a stretch that has been extended already and is passed over. Any other is extended to both sides as far
as words a lag apart agree.

Every document is worked on by itself and whole, many short ones at a time; the work is a few sorts of its words for
each doubling of the period. There is no shuffle. A null or empty text, or one of white space, has no runs and
collapses to ''. Repeated rows are treated alike, ids are not looked at. An empty table gives an empty result. Columns of the input
named like a new one are replaced.
"""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wortfund.llm.common import others, packed, quoted, unpacked

#: A run has at least so many words, and at least so many periods.
LEAST_WORDS, REPEATS = 6, 4
#: Words that are worked on at a time; a longer document is worked on alone.
BLOCK_WORDS = 300_000

RUN = "struct<start: bigint, length: bigint, period: bigint>"


def lag_classes(most: int) -> list[tuple[int, int, int]]:
    """(least lag, greatest lag, k) of each class, for lags up to `most`. k is the overlap that the lags of the class
    guarantee at least, and at least twice the greatest of them."""
    out, a = [], 1
    while a <= most:
        b = max(a, a * 3 // 2)
        out.append((a, b, min(max(LEAST_WORDS, REPEATS * q) - q for q in range(a, b + 1))))
        a = b + 1
    return out


class _Grams:
    """Numbers of the k-grams of some documents that stand in one line: ids[i] tells the k-gram at i, or is -1 if that
    k-gram ends beyond its document or stands there once."""

    def __init__(self, words: np.ndarray, doc: np.ndarray, end: np.ndarray):
        self.doc, self.end, self.powers = doc, end, {1: words}

    def _sorted(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The places of k-grams, by k-gram and then place; and whether each has the k-gram of the one before it, in the
        same document."""
        half = 1 << (k.bit_length() - 1)
        if half == k and k > 1:
            half = k // 2
        ids = self._power(half)
        at = np.flatnonzero(ids >= 0)
        at = at[at + k <= self.end[at]]
        second = ids[at + k - half]
        at, second = at[second >= 0], second[second >= 0]
        key = ids[at].astype(np.int64) * (len(ids) + 1) + second
        order = np.argsort(key, kind="stable")
        at, key = at[order], key[order]
        again = np.zeros(len(at), dtype=bool)
        again[1:] = (key[1:] == key[:-1]) & (self.doc[at[1:]] == self.doc[at[:-1]])
        return at, again

    def _power(self, k: int) -> np.ndarray:
        if k not in self.powers:
            at, again = self._sorted(k)
            ids = np.full(len(self.doc), -1, dtype=np.int64)
            alone = ~again
            alone[:-1] &= ~again[1:]
            ids[at] = np.where(alone, -1, np.cumsum(~again))
            # a k-gram has one number in each document, which is all that is compared
            self.powers[k] = ids
            self.powers.pop(k // 4, None)
        return self.powers[k]

    def pairs(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(place, lag to the next place of the same k-gram in the document)."""
        at, again = self._sorted(k)
        first = np.flatnonzero(again[1:]) if len(at) else np.empty(0, dtype=np.int64)
        return at[first], at[first + 1] - at[first]


def _agree(words: np.ndarray, at: int, lag: int, stop: int) -> int:
    """The first place from `at` on where words a lag apart differ; at most stop - lag."""
    step, last = 16, stop - lag
    while at < last:
        to = min(last, at + step)
        differ = np.flatnonzero(words[at:to] != words[at + lag : to + lag])
        if len(differ):
            return at + int(differ[0])
        at, step = to, 2 * step
    return last


def _agree_back(words: np.ndarray, at: int, lag: int, start: int) -> int:
    """The least place s such that words a lag apart agree from s to `at`."""
    step = 16
    while at > start:
        to = max(start, at - step)
        differ = np.flatnonzero(words[to:at] != words[to + lag : at + lag])
        if len(differ):
            return to + int(differ[-1]) + 1
        at, step = to, 2 * step
    return start


def runs_in(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Runs of documents whose words stand in one line, as rows (document, start, length, period) in that order of
    sorting but period before length; starts count from the document's first word."""
    ends = np.cumsum(sizes)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    end = ends[doc] if len(doc) else doc
    grams, found = _Grams(words.astype(np.int64), doc, end), []
    for least, most, k in lag_classes(int(sizes.max(initial=0)) // REPEATS):
        at, lag = grams.pairs(k)
        near = (lag >= least) & (lag <= most)
        at, lag = at[near], lag[near]
        order = np.lexsort((at, lag))
        at, lag = at[order], lag[order]
        # a seed next to the one before it on its diagonal is covered by it
        fresh = np.ones(len(at), dtype=bool)
        fresh[1:] = (lag[1:] != lag[:-1]) | (at[1:] > at[:-1] + 1)
        furthest: dict[int, int] = {}
        for i, q in zip(at[fresh].tolist(), lag[fresh].tolist()):
            if i < furthest.get(q, 0):
                continue
            d = doc[i]
            stop = _agree(words, i + k, q, int(ends[d]))
            start = _agree_back(words, i, q, int(ends[d] - sizes[d]))
            furthest[q] = stop
            if stop - start + q >= max(LEAST_WORDS, REPEATS * q):
                found.append((int(d), start - int(ends[d] - sizes[d]), stop - start + q, q))
    return np.array(sorted(found, key=lambda r: (r[0], r[1], r[3])), dtype=np.int64).reshape(-1, 4)


def _of_texts(texts: list[bytes]) -> tuple[list[list[tuple[int, int, int]]], list[bytes]]:
    """The runs of each text, and the words that stay, joined by one space."""
    split = [t.split() for t in texts]  # bytes are split at ASCII white space
    sizes = np.array([len(s) for s in split], dtype=np.int64)
    flat = pa.array([w for s in split for w in s], pa.binary()).dictionary_encode().indices.to_numpy()
    runs = runs_in(flat, sizes)
    cut = np.searchsorted(runs[:, 0], np.arange(len(texts) + 1))
    per_text, kept = [], []
    for n, words in enumerate(split):
        own = runs[cut[n] : cut[n + 1], 1:]
        per_text.append(own.tolist())
        if len(own):
            change = np.zeros(len(words) + 1, dtype=np.int64)
            np.add.at(change, own[:, 0] + own[:, 2], 1)
            np.add.at(change, own[:, 0] + own[:, 1], -1)
            words = compress(words, (np.cumsum(change)[:-1] == 0).tolist())
        kept.append(b" ".join(words))
    return per_text, kept


def _blocks(texts: list[bytes]):
    """Slices of the texts with about BLOCK_WORDS words, by their bytes."""
    start, held = 0, 0
    for i, t in enumerate(texts):
        if held and held + len(t) > 6 * BLOCK_WORDS:
            yield texts[start:i]
            start, held = i, 0
        held += len(t)
    if start < len(texts):
        yield texts[start:]


def _run(batches):
    for batch in batches:
        texts = [t or b"" for t in batch["text"].cast(pa.binary()).to_pylist()]
        runs, kept = [], []
        for some in _blocks(texts):
            r, c = _of_texts(some)
            runs += [[{"start": s, "length": n, "period": q} for s, n, q in own] for own in r]
            kept += c
        kind = pa.list_(pa.struct([(f, pa.int64()) for f in ("start", "length", "period")]))
        yield pa.record_batch([batch["row"], pa.array(runs, kind), pa.array(kept, pa.binary()).cast(pa.string())], names=["row", "runs", "collapsed"])


def find_runs(df: DataFrame, text_col="text", keep_text=True, runs_col="runs", collapsed_col="collapsed_text") -> DataFrame:
    """df with `runs`, every run of the text's words by start and period (starts count words from 0), and
    `collapsed_text`, the words but those a run holds after its first period. keep_text=False leaves the text itself out."""
    kept = df if keep_text else df.select(*others(df, text_col))
    names = {runs_col, collapsed_col}
    row = packed(kept) if kept.columns else F.struct(F.lit(0).alias("none")).alias("row")
    # packed() names columns of df, of which `kept` has some
    rows = df.select(row, quoted(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(_run, T.StructType([rows.schema["row"], T.StructField("runs", T._parse_datatype_string(f"array<{RUN}>")), T.StructField("collapsed", T.StringType())]))
    return out.select(*(unpacked(out, *names) if kept.columns else []), F.col("runs").alias(runs_col), F.col("collapsed").alias(collapsed_col))


def planted(df: DataFrame, id_col="doc_id", text_col="text") -> DataFrame:
    """df whose text is periodic from some word on in every row for which h, the CRC-32 of the decimal id, divides by 10:
    with n words, g = floor(h / 10), a = g % n and p = 1 + floor((n - a) / (3 + g % 8)), word i >= a becomes word
    a + (i - a) % p, and words are joined by one space. Other rows, those without words and those without id stay."""
    from wortfund.functions.markup import bind
    from wortfund.llm.common import words

    h = F.crc32(quoted(id_col).cast("string").cast("binary"))

    def periodic(w, g):
        def repeat(s):
            p = F.lit(1) + F.floor((F.size(s["w"]) - s["a"]) / (3 + g % 8))
            return bind(p, lambda p: F.transform(s["w"], lambda x, i: F.when(i < s["a"], x).otherwise(F.get(s["w"], (s["a"] + (i - s["a"]) % p).cast("int")))))

        return bind(F.struct(w.alias("w"), (g % F.size(w)).alias("a")), repeat)

    g = F.floor(h / 10)
    text = bind(words(quoted(text_col)), lambda w: F.when(F.size(w) > 0, F.array_join(periodic(w, g), " ")).otherwise(quoted(text_col)))
    text = F.when(h % 10 == 0, text).otherwise(quoted(text_col))
    return df.select(*[text.alias(c) if c == text_col else quoted(c) for c in df.columns])
