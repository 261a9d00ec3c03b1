"""Joins whose small side is checked, never assumed.

A side is broadcast only after its rows and bytes have been measured against a
bound.  Past the bound the same result comes from a shuffled equi-join: products
on cells that a row hash spreads, joins on a key with adaptive skew splitting.
Row content and input partition (not random numbers) pick the cells: a task that
is run again after an executor is lost puts each row where it was before.
"""

from __future__ import annotations

from math import ceil

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 20_000
BROADCAST_BYTES = 64 * 1024 * 1024
# Fewest pieces a hot key or a product is cut into; a session with more
# shuffle partitions gets one piece per partition.
SPREAD = 64


def _shuffle_partitions(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def fits_broadcast(
    df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES
) -> bool:
    """Measure ``df`` by one aggregate that combines in the tasks: do its rows and bytes stay in bounds?"""
    size = F.octet_length(F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])))
    rows, used = df.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return rows <= max_rows and used <= max_bytes


def _cell(df: DataFrame, cells: int):
    """Cell of a row: its content and its input partition decide.

    The partition number spreads equal rows, however many copies there are.
    """
    content = [F.col(f"`{c}`") for c in df.columns]
    return F.pmod(F.xxhash64(*content, F.spark_partition_id()), F.lit(cells))


def _every_cell(cells: int):
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(cells - 1).cast("bigint")))


def pair_all(
    left: DataFrame,
    right: DataFrame,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Every left row with every right row, as an equi-join on hash cells.

    The result is a product by definition, so it is computed as a grid: each
    left row has one cell and each right row is copied to every left cell.

    A right side within the bound is broadcast.  Each left row then becomes as
    many rows as the right side has, so left rows are first dealt out evenly
    over all shuffle partitions; one row moves for every |right| rows written.

    A larger right side is cut into blocks of about ``max_rows`` at most; the
    grid of (left cell, right block) pairs is then a shuffle join in which no
    task holds either side whole.
    """
    if fits_broadcast(right, max_rows, max_bytes):
        dealt = left.repartition(_shuffle_partitions(left))
        grid_left = dealt.withColumn("_cell", _cell(left, 2))
        grid_right = F.broadcast(right.select("*", _every_cell(2).alias("_cell")))
        return grid_left.join(grid_right, "_cell").drop("_cell")

    blocks = max(2, ceil(right.count() / max_rows))
    spread = max(2, ceil(max(SPREAD, _shuffle_partitions(left)) / blocks))
    grid_left = left.withColumn("_cell", _cell(left, spread)).select(
        "*", _every_cell(blocks).alias("_block")
    )
    grid_right = right.withColumn("_block", _cell(right, blocks)).select(
        "*", _every_cell(spread).alias("_cell")
    )
    # Spark's size estimate does not see the copies; without the hint it might broadcast them.
    return grid_left.join(grid_right.hint("merge"), ["_cell", "_block"]).drop("_cell", "_block")


def join_checked(
    left: DataFrame,
    right: DataFrame,
    on: str,
    how: str,
    max_rows: int = BROADCAST_ROWS,
    max_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """``left_anti``, ``left_semi``, ``left`` or ``inner`` join on a hot column.

    Small right sides are broadcast.  Larger ones are joined by a sort-merge
    join of two plain shuffles, of which the adaptive engine cuts a partition
    that a hot key fills; no right row is copied but those of such a key.
    """
    if how not in ("left_anti", "left_semi", "left", "inner"):
        raise ValueError(f"join type {how!r} cannot be cut on the left side")
    if fits_broadcast(right, max_rows, max_bytes):
        return left.join(F.broadcast(right), on, how)
    return left.join(right.hint("merge"), on, how)
