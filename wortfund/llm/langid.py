"""Language identification of documents that may mix languages.

Each language has a model: the shares of byte trigrams (letters only, other characters as one space), in
BUCKETS hash buckets, with additive smoothing. For a document, expectation-maximisation estimates the
proportions of the languages from the likelihoods of its trigrams. The set of languages is chosen by a
penalised likelihood: a language joins the set only if it raises the log-likelihood by more than
PENALTY * ln(trigrams). The largest proportion gives the language.

Counts are summed over all labelled texts by Spark; the model that goes to the tasks has BUCKETS numbers for
each language, 128 KB, and grows with the number of languages only, which has no limit but the memory of a task. A null text, or one without a letter, is `und` with
score 0. Repeated rows and ties are treated alike (ties go to the first language by name). With no labelled text
every document is `und`. An empty table gives an empty result. A column of the input named like a new one is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wortfund.llm.common import packed, quoted, unpacked

BUCKETS = 1 << 15
ROUNDS, PENALTY, SMOOTH = 12, 3.0, 0.1

# ASCII letters in lower case, everything else in ASCII one space; bytes of other characters stay
_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[ord("a") : ord("z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[ord("A") : ord("Z") + 1] = np.arange(ord("a"), ord("z") + 1)
_FOLD[128:] = np.arange(128, 256)


def trigrams(text: bytes) -> np.ndarray:
    """The buckets of a text's trigrams; those with two spaces in a row are left out."""
    raw = np.frombuffer(b" " + text + b" ", dtype=np.uint8)
    b = _FOLD[raw].astype(np.uint32)
    if len(b) < 3:
        return np.empty(0, dtype=np.int64)
    space = b == 32
    fine = ~((space[:-2] & space[1:-1]) | (space[1:-1] & space[2:]))
    code = (b[:-2] << 16 | b[1:-1] << 8 | b[2:])[fine]
    return ((code * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)


def _counted(batches):
    sums: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, text in zip(batch["lang"].to_pylist(), batch["text"]):
            own = sums.setdefault(lang, np.zeros(BUCKETS, dtype=np.int64))
            own += np.bincount(trigrams(text.as_buffer().to_pybytes()), minlength=BUCKETS)
        # many languages: give up what there is, so that the table stays small
        if len(sums) > 64:
            yield _sparse(sums)
            sums = {}
    yield _sparse(sums)


def _sparse(sums: dict[str, np.ndarray]) -> pa.RecordBatch:
    langs, buckets, counts = [], [], []
    for lang, own in sums.items():
        at = np.flatnonzero(own)
        langs += [lang] * len(at)
        buckets.append(at)
        counts.append(own[at])
    cat = lambda xs: np.concatenate(xs) if xs else np.empty(0, dtype=np.int64)
    return pa.record_batch([pa.array(langs, pa.string()), pa.array(cat(buckets), pa.int64()), pa.array(cat(counts), pa.int64())], names=["lang", "bucket", "n"])


def fit(df: DataFrame, lang_col="lang", text_col="text") -> tuple[list[str], np.ndarray]:
    """(languages, log shares [language, bucket]) from every row with a language and a text."""
    rows = df.select(quoted(lang_col).cast("string").alias("lang"), quoted(text_col).cast("string").alias("text")).dropna()
    counts = rows.mapInArrow(_counted, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    packed_rows = counts.groupBy("lang").agg(F.collect_list(F.struct("bucket", "n")).alias("c"))  # BUCKETS at most
    model = {}
    for row in packed_rows.select("lang", F.col("c.bucket").alias("b"), F.col("c.n").alias("n")).toLocalIterator():
        own = np.zeros(BUCKETS)
        own[np.array(row.b)] = np.array(row.n, dtype=float)
        model[row.lang] = np.log((own + SMOOTH) / (own.sum() + SMOOTH * BUCKETS)).astype(np.float32)
    langs = sorted(model)
    return langs, np.stack([model[x] for x in langs]) if langs else np.empty((0, BUCKETS), dtype=np.float32)


def _proportions(like: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, float]:
    """Expectation-maximisation: proportions of the languages (columns of like), and the log-likelihood."""
    share = np.full(like.shape[1], 1 / like.shape[1])
    for _ in range(ROUNDS):
        joint = like * share
        share = (count / joint.sum(axis=1)) @ joint / count.sum()
    return share, float(count @ np.log(like @ share + 1e-300))


def infer(log_model: np.ndarray, text: bytes) -> np.ndarray:
    """The proportion of each language, 0 for those outside the chosen set."""
    out = np.zeros(len(log_model))
    bucket, count = np.unique(trigrams(text), return_counts=True)
    if not len(bucket):
        return out
    logs = log_model[:, bucket].T.astype(np.float64)
    base = logs.max(axis=1)
    like = np.exp(logs - base[:, None])
    single = count @ (logs - base[:, None])
    chosen, best = [int(single.argmax())], float(single.max())
    share, price = np.ones(1), PENALTY * np.log(count.sum() + 1)
    while len(chosen) < len(log_model):
        # the language that explains best what the chosen ones explain badly
        rest = [j for j in range(len(log_model)) if j not in chosen]
        now = like[:, chosen] @ share
        gain = [count @ np.log(0.7 * now + 0.3 * like[:, j] + 1e-300) for j in rest]
        add = rest[int(np.argmax(gain))]
        if max(gain) <= best - 0.2 * count.sum():
            break
        trial, likelihood = _proportions(like[:, [*chosen, add]], count)
        if likelihood - best <= price:
            break
        chosen, share, best = [*chosen, add], trial, likelihood
    out[chosen] = share
    return out


def _predicted(langs: list[str], log_model: np.ndarray):
    def run(batches):
        for batch in batches:
            lang, score, shares = [], [], []
            for text in batch["text"]:
                share = None
                if text.is_valid and len(langs):
                    raw = text.as_buffer().to_pybytes()
                    if any(c.isalpha() for c in raw[:64].decode("utf-8", "ignore")) or any(c.isalpha() for c in raw.decode("utf-8", "ignore")):
                        share = infer(log_model, raw)
                if share is None or not share.any():
                    lang.append("und"), score.append(0.0), shares.append([])
                else:
                    lang.append(langs[int(share.argmax())]), score.append(min(1.0, float(share.max())))
                    shares.append([(langs[i], float(share[i])) for i in np.flatnonzero(share)])
            yield pa.record_batch(
                [batch["row"], pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(shares, pa.map_(pa.string(), pa.float64()))],
                names=["row", "lang_pred", "lang_score", "lang_shares"],
            )

    return run


def predict(df: DataFrame, model: tuple[list[str], np.ndarray], text_col="text") -> DataFrame:
    """df with `lang_pred`, `lang_score` (its proportion) and `lang_shares` (proportions of the chosen set)."""
    langs, log_model = model
    rows = df.select(packed(df), quoted(text_col).cast("string").alias("text"))
    new = [("lang_pred", T.StringType()), ("lang_score", T.DoubleType()), ("lang_shares", T.MapType(T.StringType(), T.DoubleType()))]
    out = rows.mapInArrow(_predicted(langs, log_model), T.StructType([rows.schema["row"], *[T.StructField(c, t) for c, t in new]]))
    names = [c for c, _ in new]
    return out.select(*unpacked(out, *names), *names)


def remainder(id_col: str, by: int) -> Column:
    """crc32 of the id as text, modulo `by`; null for a null id."""
    return F.crc32(quoted(id_col).cast("string").cast("binary")) % by
