"""Language of a text by a bit-sliced Bloom filter of n-grams.

Slot s of the filter holds one bit for each language, in as many 64-bit words as it takes; a language sets its bits at the slots of its n-grams.  A look-up
takes the AND of an n-gram's slots: the mask of all languages that may have it.  Over a text, each language counts its
bits (popcount of its slice); ``n`` n-grams of which a share ``p`` would hit by chance, from the filter's fill, make
``(count - n p) / (1 - p)`` the corrected count.  The largest count decides.

Learning: a language has an n-gram if the share of its documents with it is at least ``SHARE`` of that in the language
where it is most frequent, so an n-gram can belong to any number of languages.  Learning takes at most ``PER_LANGUAGE`` documents of each language, those with the smallest hash of
their doc_id; the filter has a fixed size.

N-grams are runs of ``GRAM`` bytes of lower-cased text with everything but letters turned into single blanks, with one before and after.  Null
texts and texts without letters are ``und`` with score 0.  Texts without any known n-gram get the commonest language
and score 0; with nothing learned all are ``und``.  Ties go to the alphabetically first language.  Repeated rows are
judged alike; other columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agrometry.llm import arrays
from agrometry.llm.staging import staged

GRAM = 4
#: Slots of the filter, each of one 64-bit mask for every 64 languages.
SLOT_BITS = 21
HASHES = 3
#: A language has an n-gram that is in its documents at this share of the highest rate; less is taken for quotation.
SHARE = 0.1
#: Documents of each language to learn from, at most.
PER_LANGUAGE = 2_000
#: Of a language, so many times as many documents are looked at for those with the smallest hashes.
SPARE = 4
UNKNOWN = "und"

_LETTER = np.zeros(256, bool)
_LETTER[0x61:0x7B] = True
_LETTER[0x80:] = True


def slots(grams: np.ndarray) -> np.ndarray:
    """Slots of each n-gram's fingerprint, one row for each hash."""
    cut = np.uint64((1 << SLOT_BITS) - 1)
    return np.stack([(grams >> np.uint64(SLOT_BITS * k)) & cut for k in range(HASHES)]).astype(np.int64)


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Fingerprints of all n-grams of all texts, and the text of each."""
    data = np.insert(arrays.LOWER[data], np.concatenate([offsets[:-1], offsets[1:]]), 0x20)
    letter = _LETTER[data]
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets) + 2)
    before = np.ones(len(data), bool)
    before[1:] = letter[:-1] | (text[1:] != text[:-1])
    kept = letter | before
    data, text = np.where(letter, data, 0x20)[kept].astype(np.uint64), text[kept]
    n = len(data) - GRAM + 1
    if n < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    packed = np.zeros(n, np.uint64)
    for k in range(GRAM):
        packed = (packed << np.uint64(8)) | data[k : k + n]
    inside = text[:n] == text[GRAM - 1 :]
    return arrays.mixed(packed[inside] + np.uint64(0x9E3779B97F4A7C15)), text[:n][inside]


def has_letter(texts: pa.Array) -> np.ndarray:
    """Whether each text has a letter of any script."""
    data, offsets = arrays.text_bytes(texts)
    plain = arrays.cumulative(_LETTER[arrays.LOWER[data]] & (data < 0x80))
    found = plain[offsets[1:]] > plain[offsets[:-1]]
    for k in np.flatnonzero(~found & (np.diff(offsets) > 0)):
        found[k] = any(unicodedata.category(c)[0] == "L" for c in texts[int(k)].as_py())
    return found


def held_out() -> Column:
    """The fourth of documents that nothing is learned from."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


@dataclass
class Filter:
    languages: list[str]
    masks: np.ndarray
    chance: np.ndarray
    common: int

    def judge(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        data, offsets = arrays.text_bytes(texts)
        n, width = len(texts), len(self.languages)
        lettered = has_letter(texts)
        if not width:
            return [UNKNOWN] * n, np.zeros(n)
        gram, text = grams(data, offsets)
        at = slots(gram)
        mask = self.masks[at[0]]
        for k in range(1, HASHES):
            mask = mask & self.masks[at[k]]
        size = np.bincount(text, minlength=n)
        count = np.stack([np.bincount(text[((mask[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)) == 1], minlength=n) for k in range(width)], 1)
        right = np.maximum(0, (count - size[:, None] * self.chance) / (1 - self.chance))
        total = right.sum(1)
        best = np.where(total > 0, right.argmax(1), self.common)
        score = np.where(total > 0, right.max(1) / np.maximum(total, 1e-12), 0.0)
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered)]
        return names, np.clip(np.where(lettered, score, 0.0), 0, 1)


def _counter(languages: list[str]):
    number = {name: k for k, name in enumerate(languages)}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(whole, "text"):
                gram, text = grams(*arrays.text_bytes(batch.column(1)))
                order = np.lexsort((text, gram))
                gram, text = gram[order], text[order]
                fresh = np.ones(len(gram), bool)
                fresh[1:] = (gram[1:] != gram[:-1]) | (text[1:] != text[:-1])
                gram, text = gram[fresh], text[fresh]
                language = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)[text]
                distinct, which = np.unique(gram, return_inverse=True)
                pair, count = np.unique(which * len(number) + language, return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(distinct[pair // len(number)].view(np.int64)),
                        pa.array((pair % len(number)).astype(np.int32)),
                        pa.array(count.astype(np.int64)),
                    ],
                    ["gram", "language", "n"],
                )

    return run


def learn(docs: DataFrame) -> Filter:
    """Fit the filter on texts with a known language that are not held out."""
    known = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"))
    known = known.where("text is not null and lang is not null and doc_id is not null").where(~held_out())
    # only hashes that a language's first PER_LANGUAGE documents can have are dealt by language
    found = known.groupBy("lang").count().collect()
    cuts = [(r["lang"], min((1 << 63) - 1, (SPARE * PER_LANGUAGE << 64) // r["count"] - (1 << 63))) for r in found]
    cuts = docs.sparkSession.createDataFrame(cuts, "lang string, cut bigint")
    first = known.select("lang", "doc_id", F.xxhash64("doc_id").alias("mark")).join(F.broadcast(cuts), "lang").where("mark <= cut")
    turn = F.row_number().over(Window.partitionBy("lang").orderBy("mark", "doc_id"))
    chosen = staged(first.select("lang", "doc_id", turn.alias("turn")).where(F.col("turn") <= PER_LANGUAGE), "learned")
    rows = chosen.groupBy("lang").count().orderBy("lang").collect()
    languages, sizes = [r["lang"] for r in rows], [r["count"] for r in rows]
    if not languages:
        return Filter([], np.zeros((0, 0), np.uint64), np.zeros(0), 0)
    width = len(languages)
    known = known.join(F.broadcast(chosen.select("doc_id", "lang").distinct()), ["doc_id", "lang"])
    counts = known.select("lang", "text").mapInArrow(_counter(languages), "gram bigint, language int, n bigint")
    # each gram's documents by language, as shares of the language's documents
    counts = counts.groupBy("gram", "language").agg(F.sum("n").alias("n"))
    size = F.element_at(F.array(*[F.lit(float(n)) for n in sizes]), F.col("language") + 1)
    rates = counts.select("gram", "language", (F.col("n") / size).alias("rate"))
    most = F.max("rate").over(Window.partitionBy("gram"))
    kept = rates.withColumn("most", most).where(F.col("rate") >= SHARE * F.col("most"))
    bits = kept.select("gram", F.floor(F.col("language") / 64).cast("int").alias("word"), F.expr("shiftleft(1L, language % 64)").alias("mask"))
    cut = (1 << SLOT_BITS) - 1
    places = F.array(*[F.shiftrightunsigned("gram", SLOT_BITS * k).bitwiseAND(F.lit(cut)) for k in range(HASHES)])
    filled = bits.select(F.explode(places).alias("slot"), "word", "mask").groupBy("slot", "word").agg(F.bit_or("mask").alias("mask"))
    found = staged(filled, "filter").toArrow()
    masks = np.zeros((1 << SLOT_BITS, -(-width // 64)), np.uint64)
    masks[found.column("slot").to_numpy(), found.column("word").to_numpy()] = found.column("mask").to_numpy().view(np.uint64)
    fill = np.array([((masks[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).mean() for k in range(width)])
    return Filter(languages, masks, np.minimum(fill**HASHES, 0.999), int(np.argmax(sizes)))


def _judge(sent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in arrays.slices(whole, "text"):
                names, score = sent.value.judge(batch.column(1))
                yield pa.RecordBatch.from_arrays([batch.column(0), arrays.strings(names), pa.array(score)], ["doc_id", "lang_pred", "score"])

    return run


def identify(docs: DataFrame, fitted: Filter) -> DataFrame:
    """Rows (doc_id, lang_pred, score) of all documents, from their text alone."""
    sent = docs.sparkSession.sparkContext.broadcast(fitted)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(_judge(sent), "doc_id bigint, lang_pred string, score double")


def digest(judged: DataFrame) -> DataFrame:
    return judged.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
