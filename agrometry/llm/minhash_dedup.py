"""Near duplicates by bottom-k sketches of word shingles.

1. Every document's set of shingle fingerprints gives its ``k`` smallest values (one hash function), its size and a
   fingerprint of the whole set.  Documents with equal sets form a class; only its smallest doc_id goes on.
2. Inverted lists of the retained values generate overlaps.  Two sketches of similar documents share many values, so
   a document enters only the lists of its rarest values: with ``|S|`` values and ``m`` that must be shared, the
   ``|S| - m + 1`` rarest ones are enough, and common boilerplate falls out.  A first pass with short sketches leaves
   the documents that overlap with any other; only these get long sketches, whose closer bound on ``m`` also drops
   copies with too many changes of their own.
3. Rounds over the lists: the members of each list meet the list's head; pairs inside one component need no more
   test, so a group of near copies shrinks to one component without all its pairs.  When little is left to compare, all
   remaining pairs of list members from different components are made.  When a round has not halved what is left, the
   open documents share a template but not enough: their whole sets are then ordered, the rarest shingles first, and two
   documents meet only in a shingle that stands so early in one of the sets that what follows can be similar.  So
   documents with too many words of their own never meet, however many share the rest.  No link between components is
   lost in either way.
   A pair is only made if the parities of both sets, by 512 groups of values, differ in no more groups than the sets
   of similar documents may differ in values.
4. The bottom-k sketch of a pair's union estimates the similarity; pairs far under the threshold fall out.
5. The exact Jaccard similarity of the full shingle sets decides.

A bound on shared values lies ``DEVIATIONS`` standard deviations of the estimate under the threshold: a pair at the
threshold is lost with a probability of about 1e-9, a more similar one with less.  Sets shorter than a sketch are whole.

Shingles are 64-bit fingerprints of runs of lower-cased (A-Z) words; a text of fewer words is one shingle; null or
empty texts have none and stay alone.  Repeated rows count as documents of their own with the same id; different texts
under one id link it to the similar documents of each, so their groups become one component (number rows first where
that is not wanted, as the pipeline does); other columns
are ignored; rows with a null doc_id stay alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from agrometry.llm import arrays
from agrometry.llm.graph import components
from agrometry.llm.membership import may_hold
from agrometry.llm.staging import staged

SKETCH = 48
LONG_SKETCH = 400
DEVIATIONS = 7.5
#: Rounds with list heads go on while more pairs than this for each list entry are left.
PAIRS_PER_ENTRY = 2
_SET = ["n_shingles", "sum_a", "sum_b"]
#: 64-bit words of a set's parities.
PARITIES = 8
_PARITY = [f"parity_{k}" for k in range(PARITIES)]


def _sets(texts: pa.Array, size: int) -> list[np.ndarray]:
    """Sorted distinct shingle fingerprints of each text."""
    found = arrays.words(*arrays.text_bytes(texts), arrays.BLANK_WORDS, arrays.LOWER)
    values, text = arrays.shingles(found, size)
    values = values.view(np.int64)
    first = np.searchsorted(text, np.arange(len(texts) + 1))
    return [np.unique(values[a:b]) for a, b in zip(first[:-1], first[1:])]


def _parities(values: np.ndarray) -> np.ndarray:
    """Whether each of 512 groups of values holds an odd number of them, as bits."""
    odd = np.bincount((values.view(np.uint64) >> np.uint64(55)).astype(np.int64), minlength=64 * PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sketcher(size: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(whole, "text"):
                sets = _sets(batch.column(1), size)
                unsigned = [s.view(np.uint64) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(np.array([s.sum(dtype=np.uint64) for s in unsigned], np.uint64).view(np.int64)),
                        pa.array(np.array([arrays.mixed(s).sum(dtype=np.uint64) for s in unsigned], np.uint64).view(np.int64)),
                        pa.array([s[:k] for s in sets], pa.list_(pa.int64())),
                        *(pa.array(c) for c in np.array([_parities(s) for s in sets]).reshape(-1, PARITIES).T.copy()),
                    ],
                    ["doc_id", "n_shingles", "sum_a", "sum_b", "sketch", *_PARITY],
                )

    return run


def sketches(docs: DataFrame, size: int, k: int = SKETCH) -> DataFrame:
    """Size, fingerprint, bottom-k sketch and parities of each document's shingle set."""
    schema = "doc_id bigint, n_shingles bigint, sum_a bigint, sum_b bigint, sketch array<bigint>"
    schema = ", ".join([schema, *(f"{c} bigint" for c in _PARITY)])
    return docs.select("doc_id", "text").mapInArrow(_sketcher(size, k), schema)


def _verifier(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(whole, "text_a"):
                keep = []
                for x, y in zip(_sets(batch.column(2), size), _sets(batch.column(3), size)):
                    both = len(np.intersect1d(x, y, assume_unique=True))
                    keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
                yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def bound(percent: int, k: int) -> float:
    """Share of its values that a sketch of ``k`` has in common with that of any similar document."""
    share = percent / 100
    return max(share / 2, share - DEVIATIONS * (share * (1 - share) / k) ** 0.5)


def inverted_lists(classes: DataFrame, percent: int, k: int) -> DataFrame:
    """Rows (value, doc): each class in the lists of its rarest values; lists have two members or more."""
    entries = classes.select("doc", F.size("sketch").alias("held"), F.explode("sketch").alias("value"))
    common = entries.groupBy("value").agg(F.count("*").alias("listed")).where("listed > 1")
    shared = entries.join(common, "value")
    by_doc = Window.partitionBy("doc")
    ranked = shared.withColumns(
        {
            "alone": F.col("held") - F.count("*").over(by_doc),
            "place": F.row_number().over(by_doc.orderBy("listed", "value")),
        }
    )
    # a set that is whole in its sketch, and in the sketch of any document it may be similar to, shares `percent` of itself
    whole = F.ceil(F.col("held") * percent / 100)
    must = F.when(F.col("held") * 100 < k * percent, whole).otherwise(F.ceil(F.col("held") * bound(percent, k)))
    kept = staged(ranked.where(F.col("place") <= F.col("held") - must + 1 - F.col("alone")).select("value", "doc"), "lists")
    several = kept.groupBy("value").agg(F.count("*").alias("members")).where("members > 1")
    return staged(kept.join(several, "value", "left_semi").distinct(), "lists")


def union_estimate(a: str, b: str, k: int):
    """Share of a pair's union sketch that both sketches hold."""
    union = F.slice(F.array_sort(F.array_union(a, b)), 1, k)
    return F.size(F.array_intersect(union, F.array_intersect(a, b))) / F.size(union)


class _Pairs:
    """Tests pairs of classes: first the sketches, then the texts."""

    def __init__(self, sketched: DataFrame, texts: DataFrame, size: int, percent: int, k: int):
        self.sketched, self.texts = sketched.select("doc", "sketch"), texts
        self.size, self.percent, self.k = size, percent, k

    def links(self, pairs: DataFrame) -> DataFrame:
        side = lambda x: self.sketched.select(F.col("doc").alias(x), F.col("sketch").alias(f"sketch_{x}"))
        text = lambda x: self.texts.select(F.col("doc").alias(x), F.col("text").alias(f"text_{x}"))
        likely = pairs.join(side("a"), "a").join(side("b"), "b")
        likely = likely.where(union_estimate("sketch_a", "sketch_b", self.k) >= bound(self.percent, self.k)).select("a", "b")
        full = likely.join(text("a"), "a").join(text("b"), "b").select("a", "b", "text_a", "text_b")
        return staged(full.mapInArrow(_verifier(self.size, self.percent), "a bigint, b bigint").distinct(), "similar")


def _merge(state: DataFrame, links: DataFrame) -> DataFrame:
    """Components after more links between documents."""
    of = lambda x: state.select(F.col("doc").alias(x), F.col("component").alias(f"c{x}"))
    roots = components(links.join(of("a"), "a").join(of("b"), "b").select("ca", "cb"), "ca", "cb")
    joined = state.join(roots, state["component"] == roots["node"], "left")
    return staged(joined.select("doc", F.coalesce("root", "component").alias("component")), "state")


def _comparable(percent: int):
    """Whether sets a and b may be similar: sizes and parities."""
    apart = sum((F.bit_count(F.col(f"a.{c}").bitwiseXOR(F.col(f"b.{c}"))) for c in _PARITY[1:]), F.bit_count(F.col(f"a.{_PARITY[0]}").bitwiseXOR(F.col(f"b.{_PARITY[0]}"))))
    m, n = F.col("a.n_shingles"), F.col("b.n_shingles")
    return (100 * F.least(m, n) >= percent * F.greatest(m, n)) & (apart * (100 + percent) <= (100 - percent) * (m + n))


def _by_head(members: DataFrame, percent: int, turn: int) -> DataFrame:
    """Pairs (a, b): in each list of several components, its head and the members outside the head's component."""
    order = F.xxhash64("doc", F.lit(turn)) if turn else F.col("doc")
    first = F.min(F.struct(order.alias("order"), "doc", "component", "n_shingles", *_PARITY)).alias("first")
    spread = (F.min("component") < F.max("component")).alias("spread")
    heads = members.groupBy("value").agg(first, spread).where("spread").select("value", "first.*").drop("order")
    meet = (F.col("a.value") == F.col("b.value")) & (F.col("a.component") != F.col("b.component")) & _comparable(percent)
    return heads.alias("a").join(members.alias("b"), meet).select(F.col("a.doc").alias("a"), F.col("b.doc").alias("b")).distinct()


def _by_component(members: DataFrame, percent: int) -> DataFrame:
    """All pairs (a, b) of list members in different components."""
    spread = members.groupBy("value").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    open_lists = staged(members.join(spread, "value", "left_semi"), "members")
    meet = (F.col("a.value") == F.col("b.value")) & (F.col("a.doc") < F.col("b.doc"))
    meet = meet & (F.col("a.component") != F.col("b.component")) & _comparable(percent)
    return open_lists.alias("a").join(open_lists.alias("b"), meet).select(F.col("a.doc").alias("a"), F.col("b.doc").alias("b")).distinct()


def _exploder(size: int):
    """All shingles of each document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(whole, "text"):
                sets = _sets(batch.column(1), size)
                docs = np.repeat(batch.column(0).to_numpy(), [len(s) for s in sets])
                yield pa.RecordBatch.from_arrays([pa.array(docs), pa.array(np.concatenate([np.zeros(0, np.int64), *sets]))], ["doc", "value"])

    return run


def _by_prefix(members: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """Pairs (a, b) from different components that may be similar, by the rarest shingles of their whole sets.

    Sets are ordered by how many open documents hold a shingle.  If the first common shingle of two similar sets has
    ``i`` and ``j`` others before it, the sets share at most ``min(m - i, n - j)``.  So it stands among the first
    ``m - percent m + 1`` and ``n - percent n + 1``, and in one of them among the first ``(1 - percent) / (1 + percent)``.
    """
    spread = members.groupBy("value").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high")
    docs = staged(members.join(spread, "value", "left_semi").drop("value").distinct(), "open")
    # a shuffle between the filter and the shingles: no task keeps two Python workers
    wanted = may_hold(texts, "doc", docs.select("doc")).join(docs.select("doc").hint("merge"), "doc", "left_semi")
    rows = staged(wanted.select("doc", "text").mapInArrow(_exploder(size), "doc bigint, value bigint"), "shingles")
    shared = rows.groupBy("value").agg(F.count("*").alias("listed")).where("listed > 1")
    by_doc, n = Window.partitionBy("doc"), F.col("n_shingles")
    alone = n - F.count("*").over(by_doc)
    place = alone + F.row_number().over(by_doc.orderBy("listed", "value")) - 1
    ranked = rows.join(shared, "value").join(docs, "doc").withColumn("place", place)
    prefix = staged(ranked.where(F.col("place") <= n - F.ceil(n * percent / 100)).drop("listed"), "prefix")
    early = prefix.where(F.col("place") * (100 + percent) <= (100 - percent) * n)
    rest = F.least(F.col("a.n_shingles") - F.col("a.place"), F.col("b.n_shingles") - F.col("b.place"))
    enough = rest * (100 + percent) >= percent * (F.col("a.n_shingles") + F.col("b.n_shingles"))
    meet = (F.col("a.value") == F.col("b.value")) & (F.col("a.component") != F.col("b.component")) & enough & _comparable(percent)
    pairs = early.alias("a").join(prefix.alias("b"), meet)
    return pairs.select(F.least("a.doc", "b.doc").alias("a"), F.greatest("a.doc", "b.doc").alias("b")).distinct()


def _left(members: DataFrame) -> tuple[int, int]:
    """Pairs from different components in all lists, and list entries."""
    each = members.groupBy("value", "component").agg(F.count("*").cast("double").alias("n"))
    lists = each.groupBy("value").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("inside"))
    pairs, entries = lists.agg(F.sum((F.col("n") * F.col("n") - F.col("inside")) / 2), F.sum("n")).first()
    return pairs or 0, entries or 0


def near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80, k: int = SKETCH, long: int = LONG_SKETCH) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept): documents linked at ``percent`` similarity share a component."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    found = staged(sketches(docs, size, k).drop(*_PARITY), "sketches")
    usable = found.where("n_shingles > 0 and doc_id is not null")
    first = usable.groupBy(*_SET).agg(F.min(F.struct("doc_id", "sketch")).alias("first"))
    classes = staged(first.select(*_SET, F.col("first.doc_id").alias("doc"), F.col("first.sketch").alias("sketch")), "classes")
    near = staged(inverted_lists(classes, percent, k).select("doc").distinct(), "near")
    listed = may_hold(docs, "doc_id", near).select(F.col("doc_id").alias("doc"), "text")
    texts = staged(listed.join(near, "doc", "left_semi"), "texts")
    longer = staged(sketches(texts.withColumnRenamed("doc", "doc_id"), size, long).withColumnRenamed("doc_id", "doc"), "longer")
    lists = inverted_lists(longer, percent, long)
    state = staged(lists.select("doc", F.col("doc").alias("component")).distinct(), "state")
    facts = longer.select("doc", "n_shingles", *_PARITY)
    pairs = _Pairs(longer, texts, size, percent, long)
    turn, before = 0, float("inf")
    while True:
        members = lists.join(state, "doc").join(facts, "doc")
        left, entries = _left(members)
        if not left:
            break
        if left <= PAIRS_PER_ENTRY * entries:
            state = _merge(state, pairs.links(_by_component(members, percent)))
            break
        if left > before / 2:
            state = _merge(state, pairs.links(_by_prefix(members, texts, size, percent)))
            break
        state = _merge(state, pairs.links(_by_head(members, percent, turn)))
        turn, before = turn + 1, left
    of_class = classes.join(state, "doc", "left").select(*_SET, F.coalesce("component", "doc").alias("component"))
    rows = found.drop("sketch").join(of_class, _SET, "left")
    linked = F.when(F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.coalesce("component", "doc_id"))
    return rows.select("doc_id", "n_shingles", linked.alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))
    )
