"""Global shuffle of a table into shards, in two passes.

Pass 1 scatters the rows uniformly over buckets that fit in memory, by a seeded hash. Pass 2 puts
each bucket into a random order by Fisher-Yates and writes it. The buckets, one after another, are
then one random order of all rows; it is cut into shards whose row counts differ by one at most.

One shuffle moves the rows; only a count per bucket is gathered besides. Rows alike in every
respect are salted by their input partition, so that no bucket grows with them.

Null ids and texts are values like any other; a repeated row gets a place for each copy; an empty
table gives an empty result. A column of the input named like a new one is replaced.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from wortfund.llm.common import packed, part_bytes, quoted, spread_key, stored, text_bytes, unpacked

#: Buckets at most: the table of their first places, 16 bytes each, is broadcast.
MAX_BUCKETS = 2_000_000
ROW_BYTES = 8


def _shuffled(seed: int):
    def shuffle(table: pa.Table) -> pa.Table:
        """A bucket in random order. Ordered by hash first, a retry gives the same order."""
        bucket = table["bucket"][0].as_py()
        by_hash = np.argsort(table["hash"].to_numpy(), kind="stable")
        # numpy's permutation is a Fisher-Yates shuffle
        order = by_hash[np.random.default_rng([seed, bucket]).permutation(len(by_hash))]
        out = table.select(["row", "bucket"]).take(pa.array(order))
        return out.append_column("place", pa.array(np.arange(len(order), dtype=np.int64)))

    return shuffle


def scatter(df: DataFrame, seed: int, bucket_bytes: int | None = None, id_col="doc_id", text_col="text") -> DataFrame:
    """(row, bucket, place): both passes, stored. bucket_bytes: text in a bucket; by default the
    session's advisory partition size."""
    spark = df.sparkSession
    total = text_bytes(df, text_col) + ROW_BYTES * df.count()
    buckets = -(-max(1, total) // (bucket_bytes or part_bytes(spark)))
    if buckets > MAX_BUCKETS:
        raise ValueError(f"{buckets} buckets: give a larger bucket_bytes")
    key = F.xxhash64(F.lit(seed), quoted(id_col), quoted(text_col))
    rows = df.select(packed(df), key.alias("hash"), spread_key(quoted(id_col), quoted(text_col), parts=buckets, seed=seed).alias("bucket"))
    schema = rows.select("row", "bucket", F.lit(0).cast("long").alias("place")).schema
    placed = rows.repartition(buckets, "bucket").groupBy("bucket").applyInArrow(_shuffled(seed), schema)
    return stored(placed, "shuffled")


def shard(df: DataFrame, shards: int = 24, seed: int = 20_25, bucket_bytes: int | None = None, id_col="doc_id", text_col="text") -> DataFrame:
    """df with `shard` (from 0) and `slot` (from 0 in each shard, without gaps)."""
    placed = scatter(df, seed, bucket_bytes, id_col, text_col)
    counts = placed.groupBy("bucket").agg(F.count("*").alias("n"))
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    everywhere = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = counts.select(
        "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start"), F.sum("n").over(everywhere).alias("total")
    )
    number = f"((start + place + 1) * {shards} - 1) div total"
    return placed.join(F.broadcast(starts), "bucket").select(  # at most MAX_BUCKETS rows
        *unpacked(placed, "shard", "slot"),
        F.expr(number).cast("int").alias("shard"),
        F.expr(f"start + place - (({number}) * total) div {shards}").alias("slot"),
    )


def write_shards(df: DataFrame, path: str, **options) -> None:
    """Write df as folders shard=0, shard=1, ..., the rows of each file in slot order."""
    shard(df, **options).sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
