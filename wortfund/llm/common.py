"""Small helpers of the operators in this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wortfund.session import drop_scratch, scratch_path

#: A word: a run of characters other than ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def others(df: DataFrame, *added: str) -> list[Column]:
    """The columns of df but those of the given names (in any case), which an operator replaces."""
    names = {name.lower() for name in added}
    return [quoted(c) for c in df.columns if c.lower() not in names]


def packed(df: DataFrame) -> Column:
    """The whole row as one struct, so that helper columns cannot clash with the caller's."""
    return F.struct(*[quoted(c) for c in df.columns]).alias("row")


def unpacked(df: DataFrame, *added: str) -> list[Column]:
    """The fields of the struct `row` but those of the given names."""
    names = {name.lower() for name in added}
    fields = [f.name for f in df.schema["row"].dataType.fields if f.name.lower() not in names]
    return [F.col("row")[name].alias(name) for name in fields]


def words(text: Column) -> Column:
    """The words of a text, in order; none for null."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(f"({WORD})"), F.lit(1))


def part_bytes(spark: SparkSession) -> int:
    """Bytes that one task is meant to hold: the session's advisory partition size."""
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64m")
    return int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(size))


def pieces(spark: SparkSession, total_bytes: int, limit: int | None = None) -> int:
    """How many pieces of `limit` bytes (default: part_bytes) hold the total."""
    return max(1, math.ceil(total_bytes / (limit or part_bytes(spark))))


def text_bytes(df: DataFrame, text_col: str) -> int:
    """Bytes of all texts of a table."""
    size = F.sum(F.octet_length(quoted(text_col)).cast("long"))
    return df.agg(size.alias("n")).first().n or 0


def stored(df: DataFrame, name: str) -> DataFrame:
    """df, written to a fresh folder below spark.checkpoint.dir and read back.

    It cuts the lineage; the files outlive any executor.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.stored_at = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Delete the files of stored tables, once all that is made of them is stored itself.

    Spark deletes the shuffle files of a job that has ended when the driver's JVM collects its plan, which a driver with little to
    do may put off for half an hour; so it is asked to.
    """
    for table in tables:
        drop_scratch(table.sparkSession, table.stored_at)
    if tables:
        spark = tables[0].sparkSession
        gc.collect()
        spark._jvm.System.gc()


def hand_back_memory() -> None:
    """At the end of a task: give what Arrow and the C library hold free back to the system, since the Python worker lives on."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def spread_key(*columns: Column, parts: int, seed: int = 0) -> Column:
    """A number below `parts` from a seeded hash of the columns and of the input partition.

    The input partition salts it: rows that are alike in all columns lie in one partition only as
    far as they came in one, so a row repeated without end still spreads over all parts.
    """
    return F.pmod(F.xxhash64(F.lit(seed), F.spark_partition_id(), *columns), F.lit(parts)).cast("int")
