"""A bitmap of fixed size that keeps rows without a partner out of a shuffle.

It grows with neither side: the driver gathers its words at most, and a join decides what
a full bitmap lets through.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from wayside.llm.batches import by_batch
from wayside.storage import settle

BITS = 1 << 24


def bitmap(df: DataFrame, key: Column) -> np.ndarray:
    """Words with a bit for each value of a long column."""
    bit = F.pmod(key, F.lit(BITS)).cast("int")
    words = df.select(F.floor(bit / 64).cast("int").alias("word"), (bit % 64).alias("bit")).distinct()
    words = words.groupBy("word").agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.col("bit"))).alias("bits"))
    out = np.zeros(BITS // 64, np.int64)
    for row in words.toLocalIterator():
        out[row["word"]] = row["bits"]
    return out


def passing(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of some longs may be in the bitmap."""
    bit = keys & (BITS - 1)
    return (words[bit >> 6] >> (bit & 63)) & 1 == 1


def without(df: DataFrame, ids: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of df whose id is not among `ids`, a frame of that one column; rows without an id stay.

    Rows that cannot be among them never enter a shuffle: only those that pass the bitmap meet
    the ids in a join, which decides. Texts of the rest are read and passed on.
    """
    ids = settle(ids.distinct(), "ids")
    held = df.sparkSession.sparkContext.broadcast(bitmap(ids, F.xxhash64(id_col)))
    key = "_key"
    while key in df.columns:
        key += "_"

    def where(wanted: bool):
        def pick(batches):
            for batch in batches:
                among = passing(held.value, batch.column(batch.num_columns - 1).to_numpy())
                yield batch.filter(pa.array(among == wanted)).drop_columns([key])

        return by_batch(df.withColumn(key, F.xxhash64(id_col)), pick, df.schema)

    return where(False).unionByName(where(True).join(ids, id_col, "left_anti").select(df.columns))
