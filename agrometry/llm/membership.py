"""A filter of fixed size for rows whose key may be in a list."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: The filter takes 8 MB whatever the list's length; a long list only lets more other rows through.
BITS = 1 << 26
#: The filter is collected in blocks of so many 32-bit words.
_WORDS = 1 << 15


def _block(table: pa.Table) -> pa.Table:
    words = np.zeros(_WORDS, np.uint32)
    at = table.column("word").to_numpy() % _WORDS
    words[at] = table.column("bits").to_numpy().astype(np.uint32)
    return pa.table({"block": table.column("block").slice(0, 1), "words": pa.array([words.tobytes()], pa.binary())})


def bitmap(addresses: DataFrame):
    """Broadcast of a bit for each address (one bigint column, from 0 to ``BITS`` - 1)."""
    name = addresses.columns[0]
    words = addresses.groupBy(F.shiftright(name, 5).alias("word")).agg(
        F.bit_or(F.expr(f"shiftleft(1L, cast({name} % 32 as int))")).alias("bits")
    )
    blocks = words.withColumn("block", F.floor(F.col("word") / _WORDS)).groupBy("block")
    found = blocks.applyInArrow(_block, "block bigint, words binary").toArrow().to_pydict()
    every = np.zeros(BITS // 32, np.uint32)
    for block, part in zip(found["block"], found["words"]):
        every[block * _WORDS : (block + 1) * _WORDS] = np.frombuffer(part, np.uint32)
    return addresses.sparkSession.sparkContext.broadcast(every)


def marked(words: np.ndarray, address: np.ndarray) -> np.ndarray:
    return (words[address >> 5] >> (address & 31).astype(np.uint32)) & np.uint32(1) == 1


def address(key) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BITS))


def tester(keys: DataFrame):
    """The broadcast filter of ``keys`` (one column), and a test of addresses against it."""
    sent = bitmap(keys.select(address(keys.columns[0]).alias("bit")))

    @F.arrow_udf(T.BooleanType())
    def test(bit: pa.Array) -> pa.Array:
        return pa.array(marked(sent.value, bit.to_numpy(zero_copy_only=False)))

    return sent, test


def split(rows: DataFrame, key: str, keys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows whose key may be in ``keys`` (one column), all that are among them, and the other rows."""
    _, test = tester(keys)
    return rows.where(test(address(key))), rows.where(~test(address(key)))


def may_hold(rows: DataFrame, key: str, keys: DataFrame) -> DataFrame:
    return split(rows, key, keys)[0]
