"""Mixing sources to target weights by Pfair scheduling.

Each source is cut into blocks of rows. With target weight w, block j (from 0) of a source is released
at floor(j / w) and due at ceil((j + 1) / w); of the released blocks the one due first comes next, of
those due alike the one of the source whose name comes first.
While all sources last, the blocks a source has had differ from its share by less than one.
Weights are whole parts of a period, so the schedule of one period repeats. When a source has run
out, its places fall away and the others go on: no row is left out or repeated.

Rows of a source come in the order of a seeded digest of id and text. They are numbered by ranges of
the digest, so a source of any size spreads over many tasks. Rows alike in id and text may come in
either order. Rows without a source are a source of their own. An empty table gives an empty result.
A column of the input named like a new one is replaced.

There may be any number of sources. Sources with as many parts have the same windows and take turns, so the
schedule is drawn up for classes of them: at most ROOT_PARTS classes, or as many different weights as add up to MAX_PARTS (under 200).
It is made SEGMENT slots at a time (5,000 sources, 26 classes, 106,375 slots: 47 s, so some 0.4 ms a slot, one after another) and stored as a table (source, own block, slot), which the
blocks of the sources are joined to. What lies before a block is a running sum over ranges of slots. All that one row or task
holds of the sources is eight bytes for each of them.
"""

from __future__ import annotations

from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wortfund.llm.common import packed, quoted, stored, unpacked

#: Parts of a period that given weights may add up to.
MAX_PARTS = 20_000
#: Parts of the largest source, where weights follow the square root of the sizes.
ROOT_PARTS = 32
#: Rows that one numbering task takes, about.
RANGE_ROWS = 10_000
#: Slots that one job schedules, those that are put into an array of their own, and those that one task sums up.
SEGMENT, CHUNK, SPAN = 1 << 19, 512, 1 << 16


def _named(source: Column) -> Column:
    """Null and text apart: a non-null key of a source; null comes first."""
    return F.when(source.isNull(), "").otherwise(F.concat(F.lit("+"), source.cast("string")))


def _let(value: Column, body) -> Column:
    """body(value), with value computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _segment(total: Column, had: Column, first: int, last: int) -> Column:
    """Slots first to last of a period of `total`, from `had`, the blocks that each class had before: struct of `had` after them and
    of `chunks`, arrays of (i, own): the source of a slot and which of its blocks in the period.

    Reads the columns `parts` and `members`: of each class the parts of one of its sources, and their numbers in order.
    """

    def pick(had, slot):
        def pending(part, c):
            members = F.get("members", c)
            size, given = F.size(members), F.get(had, c)
            own = F.floor(given / size)
            candidate = F.struct(
                F.ceil((own + 1) * total / part).alias("due"),
                F.get(members, (given % size).cast("int")).alias("i"),
                own.alias("own"),
                c.alias("c"),
            )
            return F.when((own < part) & (F.floor(own * total / part) <= slot), candidate)

        return F.array_min(F.transform("parts", pending))

    def step(state, slot):
        return _let(
            pick(state["had"], slot),
            lambda p: F.struct(
                F.transform(state["had"], lambda n, c: n + F.when(c == p["c"], 1).otherwise(0)).alias("had"),
                F.array_append(state["picks"], F.struct(p["i"].alias("i"), p["own"].alias("own"))).alias("picks"),
            ),
        )

    picks = "array<struct<i: bigint, own: bigint>>"

    def chunk(state, start):
        slots = F.sequence(start, F.least(start + (CHUNK - 1), F.lit(last)))
        none = F.struct(state["had"].alias("had"), F.array().cast(picks).alias("picks"))
        return _let(
            F.aggregate(slots, none, step),
            lambda x: F.struct(x["had"].alias("had"), F.array_append(state["chunks"], x["picks"]).alias("chunks")),
        )

    starts = F.sequence(F.lit(first).cast("long"), F.lit(last).cast("long"), F.lit(CHUNK).cast("long"))
    return F.aggregate(starts, F.struct(had.alias("had"), F.array().cast(f"array<{picks}>").alias("chunks")), chunk)


def schedule(sources: DataFrame) -> tuple[DataFrame, int]:
    """(i, own, slot) for each block of a period, and the slots of the period, from (i, parts) of each source."""
    spark = sources.sparkSession
    classes = sources.groupBy("parts").agg(F.sort_array(F.collect_list("i")).alias("members"))
    # one row, eight bytes a source
    one = stored(classes.groupBy().agg(F.sort_array(F.collect_list(F.struct("parts", "members"))).alias("all")), "mix_classes")
    one = one.select(F.col("all.parts").alias("parts"), F.col("all.members").alias("members"))
    period = sources.agg(F.sum("parts").alias("n")).first().n or 0
    had, segments = None, []
    for first in range(0, period, SEGMENT):
        # a number for each class
        before = F.transform("parts", lambda x: F.lit(0).cast("long")) if had is None else F.array(*[F.lit(n).cast("long") for n in had])
        last = min(first + SEGMENT, period) - 1
        got = stored(one.select(_segment(F.lit(period).cast("long"), before, first, last).alias("got")), "mix_segment")
        if last + 1 < period:
            had = got.select("got.had").first().had
        of_chunk = got.select(F.posexplode("got.chunks").alias("at", "picks"))
        each = of_chunk.select("at", F.posexplode("picks").alias("nth", "pick"))
        segments.append(each.select("pick.i", "pick.own", (F.lit(first).cast("long") + F.col("at") * CHUNK + F.col("nth")).alias("slot")))
    if not segments:
        return spark.createDataFrame([], "i long, own long, slot long"), 0
    return reduce(DataFrame.unionAll, segments), period


def _weighted(sizes: DataFrame, weights: dict[str, int] | None) -> DataFrame:
    """(name, n) with `i`, the number of the source, and `parts`, its parts of a period. weights: whole parts by source;
    a source that is not named gets one part. None: the square root of each source's size against the largest, in ROOT_PARTS parts."""
    numbered = sizes.withColumn("i", F.row_number().over(Window.orderBy("name")).cast("long") - 1)
    if weights is None:
        most = sizes.agg(F.max("n").alias("n")).first().n or 1
        parts = F.greatest(F.lit(1), F.floor(F.lit(ROOT_PARTS) * F.sqrt("n") / F.sqrt(F.lit(most))))
        return numbered.withColumn("parts", parts.cast("long"))
    given = sizes.sparkSession.createDataFrame([("+" + k, int(v)) for k, v in weights.items()], "name string, parts long")
    return numbered.join(given, "name", "left").withColumn("parts", F.coalesce("parts", F.lit(1).cast("long")))


def _places(ranges: DataFrame, sources: DataFrame, block_rows: int) -> DataFrame:
    """From (i, range, rows, start) the ranges of rows of each source, with the rows of the source before them: (i, range, start, places),
    where `places` holds the slot of each block that has rows in the range, and the rows of all sources before it."""
    slots, period = schedule(sources)
    block = F.explode(F.sequence(F.floor(F.col("start") / block_rows), F.floor((F.col("start") + F.col("rows") - 1) / block_rows)))
    blocks = ranges.join(sources.select("i", "n", "parts"), "i").select("i", "n", "parts", "range", "start", block.alias("block"))
    first = F.col("block") * block_rows
    # a block over the border of two ranges counts in the first
    rows = F.when(first >= F.col("start"), F.least(F.lit(block_rows), F.col("n") - first)).otherwise(0).cast("long")
    owned = blocks.withColumn("own", F.col("block") % F.col("parts")).join(slots, ["i", "own"])
    slot = F.floor(F.col("block") / F.col("parts")) * period + F.col("slot")
    owned = stored(owned.select("i", "range", "start", "block", slot.alias("slot"), rows.alias("rows")), "mix_blocks")
    # a row for SPAN slots
    span = F.floor(F.col("slot") / SPAN)
    earlier = Window.orderBy("span").rowsBetween(Window.unboundedPreceding, -1)
    sums = owned.groupBy(span.alias("span")).agg(F.sum("rows").alias("sum"))
    sums = sums.select("span", F.coalesce(F.sum("sum").over(earlier), F.lit(0)).alias("sum"))
    within = Window.partitionBy("span").orderBy("slot", "rows").rowsBetween(Window.unboundedPreceding, -1)
    summed = owned.withColumn("span", span).withColumn("sum_within", F.coalesce(F.sum("rows").over(within), F.lit(0)))
    place = F.struct("block", "slot", (F.col("sum") + F.col("sum_within")).alias("before"))
    return stored(summed.join(sums, "span").groupBy("i", "range", "start").agg(F.sort_array(F.collect_list(place)).alias("places")), "mix_places")


def mix(
    df: DataFrame, weights: dict[str, int] | None = None, block_rows: int = 16, seed: int = 11, source_col="source", id_col="doc_id", text_col="text"
) -> DataFrame:
    """df with `mix_block` (block of the row in its source), `mix_slot` (slot of that block in the
    endless schedule) and `mix_position` (place in the mixed order, from 0, without gaps)."""
    if weights is not None and (min(weights.values(), default=1) < 1 or sum(weights.values()) > MAX_PARTS):
        raise ValueError(f"weights are whole parts of 1 or more, together {MAX_PARTS} at most")
    text = F.coalesce(quoted(text_col).cast("string"), F.lit("\0"))
    key = F.md5(F.concat_ws(":", F.lit(str(seed)), F.coalesce(quoted(id_col).cast("string"), F.lit("\0")), text))
    sizes = stored(df.groupBy(_named(quoted(source_col)).alias("name")).agg(F.count("*").alias("n")), "mix_sizes")
    sources = stored(_weighted(sizes, weights).withColumn("ranges", F.ceil(F.col("n") / RANGE_ROWS)), "mix_sources")
    rows = df.select(packed(df), _named(quoted(source_col)).alias("name"), key.alias("key")).join(sources.select("name", "i", "ranges"), "name")
    # the first 32 bits of the digest say which range of a source a row is in
    in_range = F.expr("cast(conv(substr(key, 1, 8), 16, 10) as bigint) * ranges div 4294967296")
    ranged = rows.select("row", "key", "i", in_range.alias("range"))
    earlier = Window.partitionBy("i").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    counted = ranged.groupBy("i", "range").agg(F.count("*").alias("rows"))
    ranges = stored(counted.withColumn("start", F.coalesce(F.sum("rows").over(earlier), F.lit(0))), "mix_ranges")
    places = _places(ranges, sources, block_rows)
    numbered = ranged.withColumn("nth", F.row_number().over(Window.partitionBy("i", "range").orderBy("key")) - 1).join(places, ["i", "range"])
    rank = F.col("start") + F.col("nth")
    found = numbered.select(
        "row",
        F.floor(rank / block_rows).alias("block"),
        (rank % block_rows).alias("at"),
        F.get("places", (F.floor(rank / block_rows) - F.floor(F.col("start") / block_rows)).cast("int")).alias("place"),
    )
    return found.select(
        *unpacked(found, "mix_block", "mix_slot", "mix_position"),
        F.col("block").alias("mix_block"),
        F.col("place.slot").alias("mix_slot"),
        (F.col("place.before") + F.col("at")).alias("mix_position"),
    )


def in_order(df: DataFrame, **options) -> DataFrame:
    """The rows of df, as they are, in the mixed order: sorted by ranges, so files follow each other."""
    mixed = mix(df, **options)
    return mixed.orderBy("mix_position").select(*[quoted(c) for c in df.columns])


def placed(df: DataFrame, place_col="mix_position") -> DataFrame:
    """df, reread from the files that in_order's rows were written to, with the place of each row in them, from 0:
    files follow each other by their part numbers, rows by their index. A table that is in no files is written first."""
    try:
        df.select(df.metadataColumn("_metadata")["row_index"])
    except AnalysisException:
        df = stored(df, "placed")
    file = df.metadataColumn("_metadata")
    rows = df.select(packed(df), file["file_path"].alias("file"), file["row_index"].alias("at"))
    number = lambda pattern: F.regexp_extract("file", pattern, 1).try_cast("long")
    # a row a file
    files = df.select(file["file_path"].alias("file"), file["row_index"].alias("at")).groupBy("file").agg((F.max("at") + 1).alias("n"))
    follow = Window.orderBy(number(r"part-(\d+)[^/]*$"), number(r"-c(\d+)\.[^/]*$"), "file").rowsBetween(Window.unboundedPreceding, -1)
    before = files.select("file", F.coalesce(F.sum("n").over(follow), F.lit(0)).alias("before"))
    out = rows.join(F.broadcast(before), "file")
    return out.select(*unpacked(out, place_col), (F.col("before") + F.col("at")).alias(place_col))
