"""Exact top-k by inner product with Fagin's threshold algorithm.

Vectors become rows of whole numbers and are dealt to blocks of a fixed number of rows; a block lists its vectors
sorted by every dimension.  Blocks of queries meet every block of candidates in an equi-join on the block's number.
In such a pair the lists are read from the end that a query's sign favours, a step deeper for all dimensions at a
time; every vector met gets its full score; the sum of the query's weights times the last values read bounds all
vectors not met, and a query is done when that bound cannot reach its k-th score.  Equal vectors of a block stand in
its lists once, with all ids that can be among the answers; a query whose best vectors share ids is searched again for
more vectors, until they hold as many ids as asked for.  The best of all blocks are ranked in the end.

Only vectors of equal length are compared.  Rows with a null id, a null vector, or a null or non-finite component take
no part; rows that repeat an id are one candidate, which counts with its best score, and one query.  Ties go to the
smaller id.  Components and scores beyond 64-bit numbers are held at their ends.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

CANDIDATES = 4096
QUERIES = 512
FIRST_DEPTH = 32
_FOUND = "query_id bigint, vec_id bigint, score bigint"
_BLOCK = "size int, block bigint, ids binary, counts binary, firsts binary, kind string, matrix binary"


def _quantised(scale: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vectors = batch.column(0), batch.column(1)
            rows, kept = [], []
            offsets = vectors.offsets.to_numpy()
            flat = vectors.values
            bad = np.zeros(len(flat) + 1, np.int64)
            numbers = flat.cast(pa.float64()).to_numpy(zero_copy_only=False)
            np.cumsum(~np.isfinite(numbers), out=bad[1:])  # nulls read as not-a-number
            whole = np.floor(np.clip(np.nan_to_num(numbers) * scale, -(2.0**62), 2.0**62)).astype(np.int64)
            for k in range(len(batch)):
                a, b = offsets[k], offsets[k + 1]
                if ids[k].is_valid and vectors[k].is_valid and bad[a] == bad[b]:
                    kept.append(k)
                    rows.append(whole[a:b].tobytes())
            taken = pa.array(kept, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids.take(taken), pa.array([len(r) // 8 for r in rows], pa.int32()), pa.array(rows, pa.binary())],
                ["vec_id", "size", "vector"],
            )

    return run


def _pack(k: int):
    """One row for a block: its different vectors, each with its ``k`` + 1 smallest ids, least id first."""

    def run(table: pa.Table) -> pa.Table:
        ids = table.column("vec_id").to_numpy()
        size = table.column("size")[0].as_py()
        flat = np.frombuffer(b"".join(table.column("vector").to_pylist()), np.int64).reshape(len(ids), size)
        order = np.argsort(ids, kind="stable")
        ids, flat = ids[order], flat[order]
        matrix, which = np.unique(flat, axis=0, return_inverse=True) if size else (flat[:1], np.zeros(len(ids), np.int64))
        which = which.ravel()
        place = np.argsort(which, kind="stable")
        place = place[np.concatenate([[True], (ids[place[1:]] != ids[place[:-1]]) | (which[place[1:]] != which[place[:-1]])])]
        counts = np.bincount(which[place])
        rank = np.arange(len(place)) - np.repeat(np.cumsum(counts) - counts, counts)
        place = place[rank <= k]
        counts = np.minimum(counts, k + 1)
        most = int(np.abs(matrix).max()) if matrix.size else 0
        kind = "<i2" if most < 1 << 15 else "<i4" if most < 1 << 31 else "<i8"
        firsts = np.cumsum(counts) - counts
        return pa.table(
            {
                "size": pa.array([size], pa.int32()),
                "block": table.column("block").slice(0, 1),
                "ids": [ids[place].astype("<i8").tobytes()],
                "counts": [counts.astype("<i8").tobytes()],
                "firsts": [firsts.astype("<i8").tobytes()],
                "kind": [kind],
                "matrix": [matrix.astype(kind).tobytes()],
            }
        )

    return run


def _merge(k: int, kept, row: np.ndarray, vector: np.ndarray, score: np.ndarray, least: np.ndarray):
    """The ``k`` best (row, vector, score) of each row among those kept and the new ones."""
    row, vector, score = (np.concatenate([a, b]) for a, b in zip(kept, (row, vector, score)))
    order = np.lexsort((least[vector], -score, row))
    row, vector, score = row[order], vector[order], score[order]
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]])) if len(row) else row
    rank = np.arange(len(row)) - np.repeat(first, np.diff(np.append(first, len(row))))
    best = rank < k
    return row[best], vector[best], score[best]


def threshold_search(matrix: np.ndarray, least: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query, vector, score) of each query's ``k`` best vectors, ties to the smaller ``least``."""
    count, size = matrix.shape
    none = np.zeros(0, np.int64)
    kept = (none, none, none)
    reach = float(np.abs(matrix).max(initial=0)) * float(np.abs(queries).max(initial=0)) * size
    if reach >= 2.0**52:  # beyond exact floating point: whole numbers of any length, for all vectors
        every = np.clip(queries.astype(object) @ matrix.T.astype(object), -(1 << 63) + 1, (1 << 63) - 1).astype(np.int64)
        row, vector = np.divmod(np.arange(every.size), count)
        return _merge(k, kept, row, vector, every.ravel(), least)
    matrix, queries = matrix.astype(np.float64), queries.astype(np.float64)
    lists = np.argsort(matrix, axis=0, kind="stable")
    up, down = np.maximum(queries, 0), np.minimum(queries, 0)
    met = np.zeros(count, bool)
    active = np.arange(len(queries))
    depth = 0
    while len(active) and depth < count:
        to = min(count, max(FIRST_DEPTH, 2 * depth))
        wanted = np.zeros(count, bool)
        wanted[lists[count - to : count - depth, (up[active] > 0).any(0)]] = True
        wanted[lists[depth:to, (down[active] < 0).any(0)]] = True
        wanted |= to == count
        new = np.flatnonzero(wanted & ~met)
        met[new] = True
        depth = to
        if len(new):
            score = queries[active] @ matrix[new].T
            floor = np.partition(score, -k, axis=1)[:, -k] if len(new) > k else np.full(len(active), -np.inf)
            row, column = np.nonzero(score >= floor[:, None])
            kept = _merge(k, kept, active[row], new[column], score[row, column].astype(np.int64), least)
        top = matrix[lists[count - depth], np.arange(size)]
        bottom = matrix[lists[depth - 1], np.arange(size)]
        bound = up[active] @ top + down[active] @ bottom
        held = np.bincount(kept[0], minlength=len(queries))
        worst = np.full(len(queries), np.iinfo(np.int64).max)
        np.minimum.at(worst, kept[0], kept[2])
        active = active[(held[active] < k) | (bound >= worst[active])]
    return kept


def _different(matrix: np.ndarray, least: np.ndarray, queries: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """(query, vector, score) of each query's best vectors, as many as it takes for ``k`` different ``least``.

    An id on none of them is then behind ``k`` others: their scores are higher, or equal with a smaller id.
    """
    parts, left, wide = [], np.arange(len(queries)), k
    while len(left):
        query, vector, score = threshold_search(matrix, least, queries[left], wide)
        held = np.unique(np.stack([query, least[vector]], 1), axis=0)[:, 0]
        full = (np.bincount(held, minlength=len(left)) >= k) | (wide >= len(matrix))
        done = full[query]
        parts.append((left[query[done]], vector[done], score[done]))
        left, wide = left[~full], min(4 * wide, len(matrix))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _search(k: int):
    def matrix(row: dict, side: str) -> np.ndarray:
        return np.frombuffer(row[f"{side}_matrix"], row[f"{side}_kind"]).astype(np.int64).reshape(-1, row["size"]) if row["size"] else np.zeros((len(row[f"{side}_counts"]) // 8, 0), np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                row = batch.slice(at, 1).to_pylist()[0]
                ids, counts, firsts = (np.frombuffer(row[f"c_{c}"], np.int64) for c in ("ids", "counts", "firsts"))
                asked, asked_counts = (np.frombuffer(row[f"q_{c}"], np.int64) for c in ("ids", "counts"))
                query, vector, score = _different(matrix(row, "c"), ids[firsts], matrix(row, "q"), k + 1)
                # all ids of each vector, for all ids of each query, without the query itself
                held = counts[vector]
                query, score = np.repeat(query, held), np.repeat(score, held)
                inner = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)
                vec = ids[np.repeat(firsts[vector], held) + inner]
                # an id counts once, with its best score
                order = np.lexsort((-score, vec, query))
                query, vec, score = query[order], vec[order], score[order]
                fresh = np.ones(len(vec), bool)
                fresh[1:] = (query[1:] != query[:-1]) | (vec[1:] != vec[:-1])
                query, vec, score = query[fresh], vec[fresh], score[fresh]
                best = _merge(k + 1, (query[:0], vec[:0], score[:0]), query, np.arange(len(vec)), score, vec)
                query, vec, score = best[0], vec[best[1]], best[2]
                first = np.cumsum(asked_counts) - asked_counts
                held = asked_counts[query]
                inner = np.arange(held.sum()) - np.repeat(np.cumsum(held) - held, held)
                asker = asked[np.repeat(first[query], held) + inner]
                vec, score = np.repeat(vec, held), np.repeat(score, held)
                own = asker == vec
                yield pa.RecordBatch.from_arrays([pa.array(x[~own]) for x in (asker, vec, score)], ["query_id", "vec_id", "score"])

    return run


def search(vectors: DataFrame, asked: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the ``k`` best candidates of every vector that ``asked`` picks by its id."""
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    whole = rows.mapInArrow(_quantised(scale), "vec_id bigint, size int, vector binary")
    counts = rows.agg(F.count("*"), F.count(F.when(asked, 1))).first()
    blocks, parts = (max(1, -(-n // size)) for n, size in zip(counts, (CANDIDATES, QUERIES)))

    def packed(part: DataFrame, count: int, keep: int, side: str) -> DataFrame:
        dealt = part.withColumn("block", F.pmod(F.monotonically_increasing_id(), F.lit(count)))
        found = dealt.groupBy("block", "size").applyInArrow(_pack(keep), _BLOCK)
        return found.select("size", "block", *[F.col(c).alias(f"{side}_{c}") for c in ("ids", "counts", "firsts", "kind", "matrix")])

    candidates = packed(whole, blocks, k, "c")
    # a query keeps all its ids: no more than a block has
    queries = packed(whole.where(asked), parts, QUERIES * 64, "q")
    queries = queries.withColumn("block", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint"))))
    found = queries.join(candidates, ["size", "block"]).mapInArrow(_search(k), _FOUND)
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
