"""Quality rules as a short-circuit cascade.

Each rule needs some measures of a text and rejects by them. On a seeded sample the cost (seconds)
and the share of rejected rows of each rule are estimated; the rules then run in the order of
rejections per second. A measure is only computed for the rows that no earlier rule has rejected:
it stands in the branch of a conditional expression, which Spark evaluates row by row. The order decides
the time and which rule is named first, never which rows are kept.

Built-in functions only; no shuffle. A null text has no words; texts without words or with very many
work alike; repeated rows are judged alike; an empty table gives an empty result. A column of the
input named like a new one is replaced.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wortfund.llm.common import WORD, packed, quoted, stored, unpacked, words

WINDOW = 5
#: Rows of the sample that orders the rules.
SAMPLE_ROWS = 2_000


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value), with value computed once for each row."""
    return F.get(F.transform(F.array(value), body), 0)


def _repeat_words(word: Column) -> Column:
    """Words that lie in a window of WINDOW words that occurs twice or more in the text."""
    last = F.size(word) - WINDOW

    def window_hash(i):
        return F.xxhash64(*[F.get(word, i + k) for k in range(WINDOW)])

    def window_text(i):
        return F.concat_ws(" ", *[F.get(word, i + k) for k in range(WINDOW)])

    # only a text with two windows of one hash can hold a repeated window
    may_repeat = _let(F.transform(F.sequence(F.lit(0), last), window_hash), lambda h: F.size(F.array_distinct(h)) < F.size(h))
    pairs = F.sort_array(F.transform(F.sequence(F.lit(0), last), lambda i: F.struct(window_text(i).alias("t"), i.alias("i"))))

    def starts(p):
        def alike(i, j):
            return F.coalesce(F.get(p, i)["t"] == F.get(p, j)["t"], F.lit(False))

        hits = F.filter(F.sequence(F.lit(0), last), lambda i: alike(i, i - 1) | alike(i, i + 1))
        return F.sort_array(F.transform(hits, lambda i: F.get(p, i)["i"]))

    def covered(s):
        gaps = F.transform(s, lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get(s, i + 1) - x, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0).cast("long"), lambda a, x: a + x)

    count = _let(pairs, lambda p: _let(starts(p), covered))
    return F.when(F.size(word) <= WINDOW, F.lit(0).cast("long")).when(may_repeat, count).otherwise(F.lit(0).cast("long"))


def _lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n", -1), lambda x: x.rlike(WORD))


#: A measure: (text, words of the text) -> long.
MEASURES: dict[str, Callable[[Column, Column], Column]] = {
    "n_words": lambda t, w: F.size(w),
    "word_chars": lambda t, w: F.length(F.array_join(w, "")),
    "n_symbols": lambda t, w: F.regexp_count(F.coalesce(t, F.lit("")), F.lit(r"[#*$%&|<>]")),
    "n_lines": lambda t, w: F.size(_lines(t)),
    "n_dup_lines": lambda t, w: _let(_lines(t), lambda x: F.size(x) - F.size(F.array_distinct(x))),
    "n_repeat_words": lambda t, w: _repeat_words(w),
}


@dataclass(frozen=True)
class Rule:
    name: str
    needs: tuple[str, ...]
    rejects: Callable[..., Column]


RULES = (
    Rule("few_words", ("n_words",), lambda n: n < 10),
    Rule("repeated_windows", ("n_repeat_words", "n_words"), lambda r, n: 100 * r > 20 * n),
    Rule("symbols", ("n_symbols", "n_words"), lambda s, n: 10 * s > n),
    Rule("repeated_lines", ("n_dup_lines", "n_lines"), lambda d, n: 100 * d > 40 * n),
    Rule("word_length", ("word_chars", "n_words"), lambda c, n: (c < 2 * n) | (c > 12 * n)),
)


def order_rules(df: DataFrame, rules=RULES, text_col="text", sample_rows: int = SAMPLE_ROWS, seed: int = 5) -> list[Rule]:
    """The rules by rejections per second, as a seeded sample of about sample_rows rows has them."""
    total = df.count()
    if not total:
        return list(rules)
    sample = stored(df.select(quoted(text_col).alias("t")).sample(min(1.0, sample_rows / total), seed).withColumn("w", words(F.col("t"))), "rules")
    seen = max(1, sample.count())

    def run(rule):
        measured = [MEASURES[m](F.col("t"), F.col("w")).cast("long") for m in rule.needs]
        began = time.perf_counter()
        hits = sample.agg(F.count_if(rule.rejects(*measured)).alias("n")).first().n
        return time.perf_counter() - began, hits

    gain = {}
    for rule in rules:
        run(rule)  # compiles the expressions
        seconds, hits = run(rule)
        gain[rule.name] = hits / seen / seconds
    return sorted(rules, key=lambda r: -gain[r.name])


def cascade(df: DataFrame, rules=RULES, text_col="text", order: list[Rule] | None = None, complete: bool = False) -> DataFrame:
    """df with the measures (long), `rejected_by` (the first rule that rejects, else null) and `kept`.

    A measure that no rule still needed is null, or filled in if `complete`.
    """
    order = order_rules(df, rules, text_col) if order is None else order
    names = list(dict.fromkeys(m for r in order for m in r.needs))
    cur = df.select(packed(df), quoted(text_col).alias("t"), words(quoted(text_col)).alias("w"), F.lit(None).cast("string").alias("by"))
    done: list[str] = []
    for rule in order:
        for m in [m for m in rule.needs if m not in done]:
            cur = cur.withColumn(f"m_{m}", F.when(F.col("by").isNull(), MEASURES[m](F.col("t"), F.col("w")).cast("long")))
            done.append(m)
        hit = rule.rejects(*[F.col(f"m_{m}") for m in rule.needs])
        cur = cur.withColumn("by", F.coalesce("by", F.when(hit, F.lit(rule.name))))

    def measure(m):
        col = F.col(f"m_{m}")
        return F.coalesce(col, MEASURES[m](F.col("t"), F.col("w")).cast("long")) if complete else col

    return cur.select(
        *unpacked(cur, *names, "rejected_by", "kept"),
        *[measure(m).alias(m) for m in names],
        F.col("by").alias("rejected_by"),
        F.col("by").isNull().alias("kept"),
    )


def keep_good(df: DataFrame, **options) -> DataFrame:
    """The rows of df, as they are, that no rule rejects."""
    judged = cascade(df.select(packed(df), quoted(options.pop("text_col", "text")).alias("text")), **options)
    # a filter on `kept` alone would be pushed below the cascade, its expressions written out again for each
    # use; a filter that also reads the partition number stays above them
    return judged.select("row", "kept", F.spark_partition_id().alias("at")).where("kept AND at >= 0").select("row.*")
