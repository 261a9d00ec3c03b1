"""Maximal periodic runs of words, by string synchronising sets.

A run is a stretch of consecutive words with smallest period ``q`` (words ``q`` apart are equal) and at least
``max(LEAST, 2 q)`` words that no neighbour extends.  All runs of a text are found, in four steps:

1. Periods up to 8 are read off directly: the text is compared with itself, moved by ``q``.
2. For each dyadic scale ``t`` = 3, 6, 12, ... a synchronising set holds the places whose hash of ``t`` words, or that
   ``t`` words later, is the least of the ``t + 1`` between.  Whether a place belongs depends on its ``2 t`` words alone, so
   a run of period ``q`` in [3 t, 6 t) has two such places ``q`` apart, with equal contexts of ``2 t`` words.  Pairs of
   equal contexts at such a distance propose periods; as a context recurs at the earliest after ``t / 3`` words, a place
   has less than 18 partners.
3. Places in highly periodic regions (``t`` words of period ``t / 3`` or less) are in no set.  The runs of smaller scales
   tell these regions.  What they hide, runs whose first ``q`` words are such a region, begins where two runs of one
   small period meet; the distances between equal phases of the two propose their periods.
4. Each proposal is extended both ways by halving, over fingerprints of 1, 2, 4, ... words.  Of equal stretches the
   smallest period counts.

The work of a text is its length times its logarithm.  Texts are dealt in slices of half a megabyte (or one text), and
no text needs another, so there is no shuffle.

Null and empty texts have no words and no runs; ties in length go to the smallest start, then period; repeated rows
and null ids give rows of their own; other columns are ignored; very long texts are held whole, at a few hundred bytes a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from agrometry.llm import arrays

LEAST = 12
#: Periods up to here are read off directly; the first scale begins above.
DIRECT = 8
_ODD = np.uint64(0x9E3779B97F4A7C15)
_NEVER = np.uint64((1 << 64) - 1)


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return arrays.mixed(left * _ODD + right)


def _levels(values: np.ndarray, longest: int) -> list[np.ndarray]:
    """Fingerprints of the 1, 2, 4, ... words from each place, up to ``longest`` words."""
    found = [values]
    while (2 << (len(found) - 1)) <= longest:
        half = 1 << (len(found) - 1)
        found.append(_joined(found[-1][:-half], found[-1][half:]))
    return found


def _after(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words from ``a`` and ``b`` on are equal (``a`` before ``b``)."""
    length = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        at = b + length
        inside = at < len(levels[k])
        same = levels[k][np.where(inside, a + length, 0)] == levels[k][np.where(inside, at, 0)]
        length += (same & inside).astype(np.int64) << k
    return length


def _before(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many words before ``a`` and ``b`` are equal (``a`` before ``b``)."""
    length = np.zeros(len(a), np.int64)
    for k in range(len(levels) - 1, -1, -1):
        at = a - length - (1 << k)
        inside = at >= 0
        same = levels[k][np.where(inside, at, 0)] == levels[k][np.where(inside, b - length - (1 << k), 0)]
        length += (same & inside).astype(np.int64) << k
    return length


def _least(values: np.ndarray, reach: int) -> np.ndarray:
    """The smallest of each ``reach`` neighbours."""
    size = 1
    while size < reach:
        step = min(size, reach - size)
        values = np.minimum(values[:-step], values[step:])
        size += step
    return values


def _extended(levels: list[np.ndarray], place: np.ndarray, period: np.ndarray) -> np.ndarray:
    """Rows (start, end, period) of the stretches around proposals that hold their period twice."""
    start = place - _before(levels, place, place + period)
    end = place + period + _after(levels, place, place + period)
    return np.stack([start, end, period], 1)[end - start >= 2 * period]


def _smallest(found: np.ndarray) -> np.ndarray:
    """One row for each stretch, with its smallest period; ordered by start."""
    found = found[np.lexsort((found[:, 2], found[:, 1], found[:, 0]))]
    fresh = np.ones(len(found), bool)
    fresh[1:] = (found[1:, :2] != found[:-1, :2]).any(axis=1)
    return found[fresh]


def _direct(values: np.ndarray, period: int) -> np.ndarray:
    begin, end = arrays.runs(values[:-period] == values[period:])
    found = np.stack([begin, end + period, np.full(len(begin), period)], 1)
    return found[end - begin >= period]


def synchronising_set(levels: list[np.ndarray], scale: int, known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the set for ``t = 3 * 2**scale`` words, and the fingerprints of their ``2 t`` words.

    ``known`` holds all runs of period ``t / 3`` or less.
    """
    reach = 3 << scale
    marks = _joined(levels[scale + 1][: len(levels[scale]) - (2 << scale)], levels[scale][2 << scale :])
    periodic = known[(3 * known[:, 2] <= reach) & (known[:, 1] - known[:, 0] >= reach)]
    cover = np.zeros(len(marks) + 1, np.int64)
    np.add.at(cover, periodic[:, 0], 1)
    np.add.at(cover, periodic[:, 1] - reach + 1, -1)
    marks[arrays.sliding_any(cover)] = _NEVER
    least = _least(marks, reach + 1)
    chosen = ((least == marks[: len(least)]) | (least == marks[reach:])) & (least != _NEVER)
    place = np.flatnonzero(chosen)
    return place, _joined(levels[scale + 2][place], levels[scale + 1][place + (4 << scale)])


def _proposed(place: np.ndarray, context: np.ndarray, least: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and distances of pairs with equal contexts, at distances from ``least`` and under ``most``."""
    order = np.argsort(context, kind="stable")
    place, context = place[order], context[order]
    pairs = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    live, step = np.arange(len(place)), 1
    while len(live):
        live = live[live + step < len(place)]
        apart = place[live + step] - place[live]
        near = (context[live + step] == context[live]) & (apart < most)
        live, apart = live[near], apart[near]
        pairs.append((place[live][apart >= least], apart[apart >= least]))
        step += 1
    return np.concatenate([p for p, _ in pairs]), np.concatenate([d for _, d in pairs])


def _meetings(levels: list[np.ndarray], known: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proposals of runs that begin in a highly periodic region: where two runs of one small period meet."""
    longer = known[known[:, 1] - known[:, 0] >= 9 * known[:, 2]]
    longer = longer[np.lexsort((longer[:, 0], longer[:, 2]))]
    first, second = longer[:-1], longer[1:]
    meet = (first[:, 2] == second[:, 2]) & (second[:, 0] <= first[:, 1]) & (second[:, 0] > first[:, 0])
    first, second = first[meet], second[meet]
    period = first[:, 2]
    # the place in the last whole period of the first run that has the phase of the second run's begin
    row = np.repeat(np.arange(len(first)), period)
    turn = np.arange(len(row)) - np.repeat(np.cumsum(period) - period, period)
    place = first[row, 1] - 2 * period[row] + 1 + turn
    same = _after(levels, place, second[row, 0]) >= period[row]
    row, place = row[same], place[same]
    apart = second[row, 0] - place
    most = np.minimum(first[:, 1] - first[:, 0], second[:, 1] - second[:, 0])[row] + period[row]
    count = np.maximum((most - apart) // period[row] + 1, 0)
    every = np.repeat(np.arange(len(row)), count)
    times = np.arange(len(every)) - np.repeat(np.cumsum(count) - count, count)
    distance = apart[every] + times * period[row][every]
    return np.maximum(second[row, 0][every] - distance, first[row, 0][every]), distance


def find_runs(values: np.ndarray, longest: int, least: int = LEAST) -> np.ndarray:
    """Rows (start, end, period) of all runs, by start, then period.

    ``values`` are fingerprints of words, with a value of its own after each text; no text has more than ``longest`` words.
    """
    none = np.zeros((0, 3), np.int64)
    if longest < 2:
        return none
    levels = _levels(values, longest)
    known = _smallest(np.concatenate([none, *(_direct(values, q) for q in range(1, min(DIRECT, longest // 2) + 1))]))
    scale = 0
    while 2 * ((DIRECT + 1) << scale) <= longest:
        reach = 3 << scale
        place, context = synchronising_set(levels, scale, known)
        known = _smallest(np.concatenate([known, _extended(levels, *_proposed(place, context, 3 * reach, 6 * reach))]))
        scale += 1
    known = _smallest(np.concatenate([known, _extended(levels, *_meetings(levels, known))]))
    known = known[known[:, 1] - known[:, 0] >= np.maximum(least, 2 * known[:, 2])]
    return known[np.lexsort((known[:, 2], known[:, 0]))]


def _kept_texts(data: np.ndarray, offsets: np.ndarray, found: arrays.Words, keep: np.ndarray) -> pa.Array:
    """The kept words of each text, joined by one space."""
    kept = np.flatnonzero(keep)
    owner = found.text_of()[kept]
    marks = np.zeros(len(data) + 1, np.int64)
    marks[found.starts[kept]] += 1
    np.add.at(marks, found.ends[kept], -1)
    taken = arrays.sliding_any(marks)
    later = np.zeros(len(kept), bool)
    later[1:] = owner[1:] == owner[:-1]
    blank = found.starts[kept[later]] - 1
    data = data.copy()
    data[blank] = 0x20
    taken[blank] = True
    places = arrays.cumulative(taken)[offsets].astype(np.int32)
    return pa.Array.from_buffers(pa.string(), len(offsets) - 1, [None, pa.py_buffer(places.tobytes()), pa.py_buffer(data[taken].tobytes())])


def _finder(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(whole, "text"):
                data, offsets = arrays.text_bytes(batch.column(1))
                found = arrays.words(data, offsets)
                counts = found.counts()
                place = np.arange(len(found.hashes)) + found.text_of()
                values = arrays.mixed(np.arange(len(found.hashes) + len(counts), dtype=np.uint64))
                values[place] = found.hashes
                runs = find_runs(values, int(counts.max(initial=0)), least)
                first = found.first[:-1] + np.arange(len(counts))
                owner = np.searchsorted(first, runs[:, 0], side="right") - 1
                marks = np.zeros(len(values) + 1, np.int64)
                np.add.at(marks, runs[:, 0] + runs[:, 2], 1)
                np.add.at(marks, runs[:, 1], -1)
                keep = ~arrays.sliding_any(marks)[place]
                fields = (runs[:, 0] - first[owner], runs[:, 1] - runs[:, 0], runs[:, 2])
                listed = pa.StructArray.from_arrays([pa.array(f.astype(np.int64)) for f in fields], ["start", "length", "period"])
                ends = pa.array(np.searchsorted(owner, np.arange(len(counts) + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), pa.array(counts.astype(np.int64)), pa.ListArray.from_arrays(ends, listed), _kept_texts(data, offsets, found, keep)],
                    ["doc_id", "n_words", "runs", "collapsed"],
                )

    return run


def runs(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Rows (doc_id, n_words, runs, collapsed), one for each row of ``docs`` (doc_id, text).

    ``runs`` holds (start, length, period) in numbers of words, by start, then period.  ``collapsed`` are the words that
    no run contains after its first period, joined by one space.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id bigint, n_words bigint, runs array<struct<start:bigint,length:bigint,period:bigint>>, collapsed string"
    return rows.mapInArrow(_finder(least), schema)


def made_periodic(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A text in ten (by the checksum of its number) with all words from some place on repeating a few words there."""
    seed = F.crc32(F.col(doc_id).cast("string"))
    rest = F.floor(seed / 10)
    words = F.filter(F.split(F.col(text), "[\\x20\\x09-\\x0D]+"), lambda w: w != "")

    def periodic(held: Column) -> Column:
        count = F.size(held)
        begin = rest % count
        period = 1 + F.floor((count - begin) / (3 + rest % 8))
        place = F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.when(i < begin, i).otherwise(begin + (i - begin) % period).cast("int"))
        return F.array_join(F.transform(place, lambda i: F.get(held, i)), " ")

    # the outer array gives the words a name, so that they are split off once
    chosen = F.when((seed % 10 == 0) & (F.size(words) > 0), F.array(words))
    return F.coalesce(F.get(F.transform(chosen, periodic), F.lit(0)), F.col(text))


def digest(found: DataFrame) -> DataFrame:
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    sha = lambda text: F.sha2(F.encode(text, "UTF-8"), 256)
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.floor(1000 * F.col("best.length") / -F.col("best.period")).alias("exponent_milli"),
        sha(F.array_join(F.transform("runs", line), "")).alias("runs_sha256"),
        sha(F.col("collapsed")).alias("collapsed_sha256"),
    )


def sql() -> str:
    """The digest for DuckDB: every pair of equal words in a text, gathered into stretches of one distance."""
    from agrometry.llm.checksums import CRC_TABLE, crc_of

    return f"""
WITH {CRC_TABLE}, docs AS (
    SELECT row_number() OVER () AS rid, doc_id, {crc_of("doc_id")} AS h, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents, crc
), planned AS (SELECT *, len(words) AS n, h // 10 AS g, h % 10 = 0 AND len(words) > 0 AS made FROM docs),
placed AS (SELECT *, CASE WHEN made THEN g % n ELSE 0 END AS a, CASE WHEN made THEN 1 + (n - g % n) // (3 + g % 8) ELSE 1 END AS p FROM planned),
word AS (
    SELECT rid, i, words[1 + CASE WHEN made AND i >= a THEN a + (i - a) % p ELSE i END] AS w
    FROM (SELECT *, unnest(range(n)) AS i FROM placed)
), numbered AS (SELECT rid, i, w, hash(w) AS k FROM word),
pair AS (SELECT x.rid, x.i, y.i - x.i AS q FROM numbered x JOIN numbered y ON x.rid = y.rid AND x.k = y.k AND x.w = y.w AND y.i > x.i),
stretch AS (
    SELECT rid, q, min(i) AS s, count(*) + q AS length
    FROM (SELECT *, i - row_number() OVER (PARTITION BY rid, q ORDER BY i) AS part FROM pair) GROUP BY rid, q, part HAVING count(*) >= q
), run AS (SELECT rid, s, length, min(q) AS q FROM stretch WHERE length >= {LEAST} GROUP BY rid, s, length),
total AS (
    SELECT rid, count(*) AS n_runs, arg_min(struct_pack(s := s, length := length, q := q), struct_pack(a := -length, b := s, c := q)) AS best,
        string_agg(s || ',' || length || ',' || q || chr(10), '' ORDER BY s, q) AS lines
    FROM run GROUP BY rid
), gone AS (SELECT DISTINCT rid, unnest(range(s + q, s + length)) AS i FROM run),
kept AS (SELECT rid, string_agg(w, ' ' ORDER BY i) AS said FROM word ANTI JOIN gone USING (rid, i) GROUP BY rid)
SELECT doc_id, coalesce(n_runs, 0) AS n_runs, best.s AS start, best.length AS length, best.q AS period,
    1000 * best.length // best.q AS exponent_milli, sha256(coalesce(lines, '')) AS runs_sha256, sha256(coalesce(said, '')) AS collapsed_sha256
FROM docs LEFT JOIN total USING (rid) LEFT JOIN kept USING (rid)
"""
