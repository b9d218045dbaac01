"""Toxicity by subword-bag embeddings averaged into a linear softmax.

A word is the bag of its character n-grams (and itself), hashed into BUCKETS vectors; a stretch of text is
the average of its words' bags; a linear softmax over two classes judges it. Vectors and softmax are trained
jointly in numpy. A document is as toxic as its most toxic stretch of STRETCH words, in training as
in use, so that a few words count in a text of any length. Misspelt words share most of their n-grams, and so
their vectors, with the words seen in training.

Training takes a bounded sample of labelled documents: at most `per_class` of each label, in an order given by
a seeded digest of their ids, with whole texts of at most LONGEST_TEXT bytes each and SAMPLE_BYTES together. Scoring is a map over all
documents; the numbers sent to the tasks are BUCKETS scores.

A null or empty text, like one without a word, has the score of an empty bag, which is below 0.5. Repeated rows are
scored alike. A document labelled both ways counts as toxic. Without labels of both kinds every score is 0. An empty table
gives an empty result. A column of the input named like a new one is replaced.
"""

from __future__ import annotations

import re
import zlib
from itertools import zip_longest

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wortfund.llm.common import packed, quoted, unpacked

BUCKETS, DIM = 1 << 17, 8
GRAMS = (3, 4, 5)
STRETCH = 6
PER_CLASS = 2_000
SAMPLE_BYTES, LONGEST_TEXT = 64 << 20, 4 << 20
STEPS, RATE = 120, 0.05
#: Steps in which a document is its average, before it is its most toxic stretch.
WARM_STEPS = 40
#: Weight of all toxic documents in training against all others: labels call ordinary texts toxic, not the reverse.
POSITIVE_SHARE = 0.35
#: N-grams in fewer training documents than this keep the vector zero.
LEAST_DOCS = 5

_WORD = re.compile(r"\w+")


def bag(word: str) -> np.ndarray:
    """The buckets of a word in lower case and of its character n-grams."""
    marked = f"<{word}>"
    grams = [marked, *(marked[i : i + n] for n in GRAMS for i in range(len(marked) - n + 1))]
    return np.array([zlib.crc32(g.encode("utf-8", "surrogatepass")) % BUCKETS for g in grams], dtype=np.int64)


def tokens(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


class _Texts:
    """Texts as numbers of distinct words, and the bags of these."""

    def __init__(self, texts):
        number: dict[str, int] = {}
        self.docs = [np.array([number.setdefault(w, len(number)) for w in tokens(t)], dtype=np.int64) for t in texts]
        bags = [bag(w) for w in number]
        self.size = np.array([len(b) for b in bags], dtype=np.int64)
        self.gram = np.concatenate(bags) if bags else np.empty(0, dtype=np.int64)
        self.word = np.repeat(np.arange(len(bags)), self.size)

    def common_grams(self, least: int) -> np.ndarray:
        """Which buckets occur in `least` documents or more."""
        docs = np.zeros(len(self.size), dtype=np.int64)
        for d in self.docs:
            docs[np.unique(d)] += 1
        return np.bincount(self.gram, weights=docs[self.word], minlength=BUCKETS) >= least

    def word_scores(self, gram_scores: np.ndarray) -> np.ndarray:
        return np.bincount(self.word, weights=gram_scores[self.gram], minlength=len(self.size)) / np.maximum(self.size, 1)


def _best_stretch(score: np.ndarray, words: int | None = STRETCH) -> tuple[int, int, float]:
    """(start, end, mean) of the stretch of so many words with the largest mean; of the whole if it is shorter, or for None."""
    n = min(words or len(score), len(score))
    if not n:
        return 0, 0, 0.0
    total = np.concatenate([[0.0], np.cumsum(score)])
    mean = (total[n:] - total[:-n]) / n
    at = int(mean.argmax())
    return at, at + n, float(mean[at])


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def train(texts: list[str], labels: list[int], seed: int = 3) -> tuple[np.ndarray, float]:
    """(score of each bucket, bias): what the vectors give in the softmax's difference of the two classes."""
    data, y = _Texts(texts), np.asarray(labels, dtype=np.float64)
    rng = np.random.default_rng(seed)
    vectors = rng.normal(0, 0.1, (BUCKETS, DIM)) * data.common_grams(LEAST_DOCS)[:, None]
    softmax = np.stack([-(v := rng.normal(0, 0.5, DIM)), v])  # two classes
    bias = np.array([1.0, -1.0])
    weight = np.where(y > 0, POSITIVE_SHARE / max(1, y.sum()), (1 - POSITIVE_SHARE) / max(1, (1 - y).sum()))
    state = [np.zeros_like(a) for a in (vectors, softmax, bias) for _ in range(2)]
    seen = np.flatnonzero(vectors.any(axis=1))
    fixed = ~vectors.any(axis=1)
    for step in range(1, STEPS + 1):
        slope = softmax[1] - softmax[0]
        word = data.word_scores(vectors @ slope)
        best = [_best_stretch(word[d], None if step <= WARM_STEPS else STRETCH) for d in data.docs]
        logit = np.array([b[2] for b in best]) + bias[1] - bias[0]
        error = (_sigmoid(logit) - y) * weight
        g_word = np.zeros(len(data.size))
        for d, (a, b, _), e in zip(data.docs, best, error):
            np.add.at(g_word, d[a:b], e / max(1, b - a))
        g_gram = np.bincount(data.gram, weights=(g_word / np.maximum(data.size, 1))[data.word], minlength=BUCKETS)
        g_slope = g_gram[seen] @ vectors[seen]
        g_gram[fixed] = 0
        grads = (np.outer(g_gram, slope), np.stack([-g_slope, g_slope]), np.array([-error.sum(), error.sum()]))
        for k, (value, g) in enumerate(zip((vectors, softmax, bias), grads)):
            m, v = state[2 * k], state[2 * k + 1]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            value -= RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    return vectors @ (softmax[1] - softmax[0]), float(bias[1] - bias[0])


def _shortest(texts: DataFrame) -> DataFrame:
    """(id, text): (size, key) of each id's shortest text of LONGEST_TEXT bytes or less.

    One line of each id before ids meet their labels: a join would move the texts, and read size and key off them behind it.
    """
    lines = texts.select("id", F.octet_length("text").alias("size"), F.xxhash64("text").alias("key"))
    return lines.where(F.col("size") <= LONGEST_TEXT).groupBy("id").agg(F.min(F.struct("size", "key")).alias("text"))


def sample(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS, seed: int = 3, id_col="doc_id", text_col="text", label_col="toxic"):
    """(texts, labels): the bounded training sample.

    Labelled ids in the order of a seeded hash, the first `per_class` of each label; one row of each id, its shortest text. Texts
    of more than LONGEST_TEXT bytes take no part. Of the rest both labels are filled in turn; a text that no longer fits into
    SAMPLE_BYTES is passed over, not the end. What comes to the driver before the texts are ids and sizes.
    """
    known = labels.select(quoted(id_col).alias("id"), quoted(label_col).cast("int").alias("y")).dropna().groupBy("id").agg(F.max("y").alias("y"))
    texts = docs.select(quoted(id_col).alias("id"), quoted(text_col).alias("text")).where("text IS NOT NULL")
    one = _shortest(texts).join(known, "id").select("id", "y", "text")
    by_hash = F.xxhash64(F.lit(seed), "id")
    lines = [one.where(F.col("y") == y).orderBy(by_hash, "id").limit(per_class).select("id", "y", "text.*").collect() for y in (0, 1)]
    chosen, left = [], SAMPLE_BYTES
    for pair in zip_longest(*lines):
        for row in pair:
            if row is not None and row["size"] <= left:
                left -= row["size"]
                chosen.append((row["id"], row["y"], row["key"]))
    if not chosen:
        return [], []
    kind = docs.schema[id_col].dataType.simpleString()
    wanted = F.broadcast(docs.sparkSession.createDataFrame(chosen, f"id {kind}, y int, key bigint"))  # 2 * per_class rows at most
    found = texts.withColumn("key", F.xxhash64("text")).join(wanted, ["id", "key"]).groupBy("id").agg(F.max("y").alias("y"), F.min("text").alias("text"))
    got = found.orderBy(by_hash, "id").toLocalIterator()
    return [list(x) for x in zip(*((row.text, row.y) for row in got))] or ([], [])


def fit(docs: DataFrame, labels: DataFrame, **options) -> tuple[np.ndarray, float] | None:
    """The model, or None without labelled documents of both kinds."""
    texts, y = sample(docs, labels, **options)
    return train(texts, y) if len(set(y)) == 2 else None


def _scored(model):
    def run(batches):
        known: dict[str, float] = {}
        for batch in batches:
            out = []
            for text in batch["text"].to_pylist():
                if model is None:
                    out.append(0.0)
                    continue
                scores, bias = model
                words = tokens(text)
                for w in words:
                    if w not in known:
                        known[w] = float(scores[bag(w)].mean())
                best = _best_stretch(np.array([known[w] for w in words]))
                out.append(float(_sigmoid((best[2] if words else 0.0) + bias)))
                if len(known) > 500_000:
                    known.clear()
            yield pa.record_batch([batch["row"], pa.array(out, pa.float64())], names=["row", "toxicity"])

    return run


def predict(df: DataFrame, model, text_col="text") -> DataFrame:
    """df with `toxicity`, from 0 to 1."""
    rows = df.select(packed(df), quoted(text_col).cast("string").alias("text"))
    out = rows.mapInArrow(_scored(model), T.StructType([rows.schema["row"], T.StructField("toxicity", T.DoubleType())]))
    return out.select(*unpacked(out, "toxicity"), "toxicity")
