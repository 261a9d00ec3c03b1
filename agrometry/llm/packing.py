"""Pack tokenised documents into training windows without changing their order.

Each task takes the documents of its partition as one stream of tokens, every document followed by an end token, and
chooses where to cut it.  Cuts may fall at document ends, sentence ends, and, in stretches without either, between
tokens; a window holds at most ``length`` tokens.  Dynamic programming minimises padding plus penalties for cutting
documents: with cost(j) = penalty(j) + length - place(j) + min(cost(i) + place(i)) over places at most ``length``
back, the minimum comes from a monotone queue, so every place enters and leaves it once.

The stream is worked on in blocks of bounded size; the last windows of a block stay open and go on into the next.

Of equal costs the window that begins later counts.  A text of any length goes through in one piece; its windows are
cut like those of many texts.  Null or empty texts are a lone end token; repeated documents are packed each; other columns are ignored; a null doc_id
stays null.  The order is that of rows in a partition, so read a written table (a retried task then gets the same).
"""

from __future__ import annotations

import os
from collections import deque
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from agrometry.llm import arrays

LENGTH = 2048
END_TOKEN = 1
SENTENCE_PENALTY = 8
TOKEN_PENALTY = 32
#: Without a sentence end for so many tokens, cuts between tokens are allowed this far apart.
FREE_STEP = 64
#: Windows at the end of a block that may still change.
OPEN_WINDOWS = 4
#: A worker forgets its words beyond so many (a cache, not a limit of results).
REMEMBERED_WORDS = 400_000

_SENTENCE_ENDS = tuple(end + quote for end in (b".", b"!", b"?", "…".encode(), "。".encode()) for quote in (b"", b'"', b"'", b")", b'")', "”".encode(), "»".encode()))
#: How the vocabulary marks the last token of a word.
_WORD_END = "</w>"
#: So many words of letters are encoded as one text.
_TOGETHER = 1000
_ROW = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("start", pa.int64()),
        ("length", pa.int64()),
        ("ids", pa.binary()),
        ("doc_tokens", pa.int64()),
        ("sequence_id", pa.int64()),
        ("offset", pa.int64()),
    ]
)
_DDL = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def _divided(texts: list[bytes], control: list[bytes]) -> Iterator[bytes]:
    """Texts in lower case (A-Z), with a blank before every stop or comma between a letter and white space.

    A text that would hold a control token in lower case keeps its case, as the tokenizer looks for these first.
    """
    offsets = np.cumsum([0, *map(len, texts)])
    # a blank after each text, so that its last sign has one too
    raw = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    data = arrays.LOWER[raw]
    offsets += np.arange(len(offsets))
    whole = data.tobytes()
    if any(token in whole for token in control):
        for text, a, b in zip(texts, offsets[:-1], offsets[1:]):
            if any(token in text.lower() for token in control):
                data[a:b] = raw[a:b]
    stop = np.flatnonzero((data[1:-1] == 0x2E) | (data[1:-1] == 0x2C)) + 1
    stop = stop[(data[stop - 1] >= 0x61) & (data[stop - 1] <= 0x7A) & ~arrays.BLANK_WORDS[data[stop + 1]]]
    whole = np.insert(data, stop, 0x20).tobytes()
    offsets = (offsets + np.searchsorted(stop, offsets)).tolist()
    return (whole[a:b] for a, b in zip(offsets[:-1], offsets[1:]))


class Encoder:
    """Token ids of texts.

    The vocabulary drops white space, lowers case and parts letters from signs.  So texts are lowered (A-Z) and a full
    stop or comma between a letter and white space becomes a word of its own, which changes no id; each blank-separated
    word is then looked up once and kept.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.control = [token.content.lower().encode() for token in self.tokenizer.get_added_tokens_decoder().values()]
        vocabulary = self.tokenizer.get_vocab()
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends_word[[number for token, number in vocabulary.items() if token.endswith(_WORD_END)]] = True
        self.forget()

    def forget(self) -> None:
        """Word 0 is the end of a text."""
        self.words: dict[bytes | None, int] = {None: 0}
        self.ids = np.array([END_TOKEN], np.uint32)
        self.first = np.array([0, 1])
        self.ends_sentence = np.array([False])

    def learn(self, new: set[bytes]) -> None:
        texts = [(word, word.decode("utf-8", "replace")) for word in new]
        plain, other = [], []
        for pair in texts:
            text = pair[1]
            (plain if text.isalpha() and (text.isascii() or max(text) < "\u0130") else other).append(pair)
        flat, sizes = self._together([text for _, text in plain])
        if len(sizes) != len(plain):
            plain, other, flat, sizes = [], plain + other, flat[:0], sizes[:0]
        alone = self._encoded([text for _, text in other])
        more = np.fromiter(map(len, alone), np.int64, len(alone))
        self.ids = np.concatenate([self.ids, flat, np.fromiter(chain.from_iterable(alone), np.uint32, int(more.sum()))])
        self.first = np.concatenate([self.first, self.first[-1] + np.cumsum(np.concatenate([sizes, more]))])
        known = len(self.words)
        self.words.update(zip((word for word, _ in chain(plain, other)), range(known, known + len(new))))
        closed = np.zeros(len(new), bool)
        closed[len(plain) :] = [word.endswith(_SENTENCE_ENDS) for word, _ in other]
        self.ends_sentence = np.concatenate([self.ends_sentence, closed])

    def _together(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words of letters in a row, and how many each has: many are encoded as one text, which blanks divide."""
        texts = [" ".join(words[at : at + _TOGETHER]) for at in range(0, len(words), _TOGETHER)]
        flat = np.fromiter(chain.from_iterable(self._encoded(texts)), np.uint32)
        return flat, np.diff(np.flatnonzero(self.ends_word[flat]), prepend=-1)

    def _encoded(self, texts: list[str]) -> list[list[int]]:
        return [x.ids for x in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def encode(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of all texts in a row with their end tokens, the end of each text, and the ends of sentences."""
        if len(self.words) > REMEMBERED_WORDS:
            self.forget()
        found: list[bytes | None] = []
        for text in _divided(texts, self.control):
            found += text.split()
            found.append(None)
        word = np.fromiter(map(self.words.get, found, repeat(-1)), np.int64, len(found))
        unknown = np.flatnonzero(word < 0)
        if len(unknown):
            missed = [found[k] for k in unknown.tolist()]
            self.learn(set(missed))
            word[unknown] = np.fromiter(map(self.words.__getitem__, missed), np.int64, len(missed))
        sizes = self.first[word + 1] - self.first[word]
        ends = np.cumsum(sizes)
        total = int(ends[-1]) if len(ends) else 0
        place = np.arange(total) - np.repeat(ends - sizes - self.first[word], sizes)
        sentence = np.unique(ends[self.ends_sentence[word] & (ends > 0)])
        return self.ids[place], ends[word == 0], sentence


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
        arrays.caches["packing"] = _encoders.clear
    return _encoders[path]


def cut_places(doc_ends: np.ndarray, sentence_ends: np.ndarray, total: int) -> tuple[np.ndarray, np.ndarray]:
    """Places where a window may end, in order, and the penalty of each."""
    places = np.unique(np.concatenate([doc_ends, sentence_ends, [total]]))
    places = places[places > 0]
    gaps = np.diff(places, prepend=0)
    more = (gaps - 1) // FREE_STEP
    which = np.repeat(np.arange(len(places)), more)
    inner = np.arange(len(which)) - np.repeat(np.cumsum(more) - more, more)
    free = places[which] - gaps[which] + FREE_STEP * (inner + 1)
    every = np.concatenate([places, free])
    penalty = np.concatenate([np.full(len(places), SENTENCE_PENALTY), np.full(len(free), TOKEN_PENALTY)])
    order = np.argsort(every, kind="stable")
    every, penalty = every[order], penalty[order]
    penalty[np.isin(every, doc_ends, assume_unique=False) | (every == total)] = 0
    return every, penalty


def best_cuts(places: np.ndarray, penalty: np.ndarray, length: int) -> np.ndarray:
    """The cheapest window ends; places grow by less than ``length`` at a time."""
    at, cost = [0, *places.tolist()], [0]
    came = [0]
    queue = deque([(0, 0, 0)])  # value, place, number; values grow from the left
    for j, (place, fee) in enumerate(zip(at[1:], penalty.tolist()), 1):
        while place - queue[0][1] > length:
            queue.popleft()
        value, _, i = queue[0]
        now = fee + length - place + value
        cost.append(now)
        came.append(i)
        value = now + place
        while queue and queue[-1][0] >= value:
            queue.pop()
        queue.append((value, place, j))
    cuts, j = [], len(at) - 1
    while j:
        cuts.append(at[j])
        j = came[j]
    return np.array(cuts[::-1], np.int64)


class Stream:
    """The open end of a partition's token stream."""

    def __init__(self, part: int, length: int):
        self.length = length
        self.next = part << 32
        self.ids = np.zeros(0, np.uint32)
        self.sentences = np.zeros(0, np.int64)
        self.doc_ends = np.zeros(0, np.int64)
        self.docs: list = []
        self.tokens = np.zeros(0, np.int64)
        self.begun = 0  # tokens of the first document that are already out

    def add(self, docs: list, ids: np.ndarray, doc_ends: np.ndarray, sentences: np.ndarray) -> None:
        n = len(self.ids)
        self.ids = np.concatenate([self.ids, ids])
        self.sentences = np.concatenate([self.sentences, sentences + n])
        self.doc_ends = np.concatenate([self.doc_ends, doc_ends + n])
        self.docs += docs
        self.tokens = np.concatenate([self.tokens, np.diff(doc_ends, prepend=0)])

    def cut(self, last: bool) -> Iterator[pa.RecordBatch]:
        total = len(self.ids)
        if not total:
            return
        cuts = best_cuts(*cut_places(self.doc_ends, self.sentences, total), self.length)
        if not last:
            cuts = cuts[: max(0, len(cuts) - OPEN_WINDOWS)]
        if not len(cuts):
            return
        out = int(cuts[-1])
        ends = np.unique(np.concatenate([cuts, self.doc_ends[self.doc_ends <= out]]))
        starts = np.concatenate([[0], ends[:-1]])
        doc = np.searchsorted(self.doc_ends, starts, side="right")
        window = np.searchsorted(cuts, starts, side="right")
        doc_start = np.concatenate([[-self.begun], self.doc_ends])[doc]
        window_start = np.concatenate([[0], cuts])[window]
        for a in range(0, len(ends), 5000):
            b = min(a + 5000, len(ends))
            base = starts[a]
            data = self.ids[base : ends[b - 1]].astype("<u4").tobytes()
            places = (np.append(starts[a:b], ends[b - 1]) - base).astype(np.int32) * 4
            blob = pa.BinaryArray.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(places.tobytes()), pa.py_buffer(data)])
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([self.docs[k] for k in doc[a:b]], pa.int64()),
                    pa.array(starts[a:b] - doc_start[a:b]),
                    pa.array(ends[a:b] - starts[a:b]),
                    blob,
                    pa.array(self.tokens[doc[a:b]]),
                    pa.array(window[a:b] + self.next),
                    pa.array(starts[a:b] - window_start[a:b]),
                ],
                schema=_ROW,
            )
        gone = int(np.searchsorted(self.doc_ends, out, side="right"))
        self.next += len(cuts)
        self.begun = out - int(self.doc_ends[gone - 1]) if gone else out + self.begun
        self.ids = self.ids[out:]
        self.sentences = self.sentences[self.sentences > out] - out
        self.doc_ends = self.doc_ends[gone:] - out
        self.docs = self.docs[gone:]
        self.tokens = self.tokens[gone:]


def _packer(path: str, length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stream = Stream(TaskContext.get().partitionId(), length)
        for whole in batches:
            for batch in arrays.slices(whole, "text", owner="packing"):
                texts = batch.column(1).fill_null("").cast(pa.binary()).to_pylist()
                stream.add(batch.column(0).to_pylist(), *encoder(path).encode(texts))
                yield from stream.cut(last=False)
        yield from stream.cut(last=True)

    return run


def pack(docs: DataFrame, vocabulary: str, length: int = LENGTH) -> DataFrame:
    """Pieces (doc_id, start, length, ids, doc_tokens, sequence_id, offset).

    ``ids`` are little-endian unsigned 32-bit numbers; ``start`` counts the document's tokens before the piece and
    ``offset`` the sequence's.  ``sequence_id`` is the partition's number and the window's number within it.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_packer(vocabulary, length), _DDL)


def digest(pieces: DataFrame) -> DataFrame:
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
