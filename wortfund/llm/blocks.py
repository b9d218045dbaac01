"""Document blocks and tables of their distinct n-grams or words.

Exploding every word of every document into a row of its own moves several times the input. Instead the
documents are dealt into blocks of a bounded size; a block sends each distinct entry once, to the part of
the table that a hash of the entry names, and gets what the table says of it back in the same order.
Documents are shuffled once: both uses of the blocks share that exchange.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wortfund.llm.common import packed, pieces, quoted, spread_key, text_bytes


#: Text in a block. A Python process holds a block whole, and some twenty times its size in numbers, so this does not grow with the
#: session's partition size; nor is it less, since a block sends a row to every part of the table, and there are as many parts as blocks.
BLOCK_BYTES = 8 << 20


def in_blocks(df: DataFrame, id_col: str, text_col: str, block_bytes: int | None = None) -> tuple[DataFrame, int]:
    """(row, block) and the number of blocks of about block_bytes of text, BLOCK_BYTES by default. The text stands in the row only, so
    that it is moved once."""
    blocks = pieces(df.sparkSession, text_bytes(df, text_col), block_bytes or BLOCK_BYTES)
    block = spread_key(quoted(id_col), quoted(text_col), parts=blocks)
    return df.select(packed(df), block.alias("block")).repartition(blocks, F.col("block")), blocks


def looked_up(docs: DataFrame, blocks: int, entries, entry_schema: str, table, answer_schema: str, answers, out_schema) -> DataFrame:
    """entries(docs of a block) -> rows with (block, part, ...); table(rows of a part) -> rows with
    (block, part, ...); answers(docs of a block, its rows of the table) -> the result."""
    sent = docs.groupBy("block").applyInArrow(entries, entry_schema)
    got = sent.repartition(blocks, F.col("part")).groupBy("part").applyInArrow(table, answer_schema)
    return docs.groupBy("block").cogroup(got.groupBy("block")).applyInArrow(answers, out_schema)
