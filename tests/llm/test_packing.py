import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from agrometry.llm import packing

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("length", [64, 2048])
def test_pieces_give_every_token_once(docs, rows, length):
    encoder = Tokenizer.from_file(PATH)
    pieces = packing.pack(docs, PATH, length).toPandas()
    summed = packing.digest(packing.pack(docs, PATH, length)).toPandas()
    assert sorted(zlib.crc32(x) for x in pieces.ids) == sorted(summed.ids_crc32)
    for doc_id, text in rows:
        ids = encoder.encode(text or "", add_special_tokens=False).ids + [1]
        mine = pieces[pieces.doc_id == doc_id].sort_values("start")
        assert np.frombuffer(b"".join(mine.ids), "<u4").tolist() == ids
        assert mine.start.tolist() == [0, *np.cumsum(mine.length)[:-1]]
        assert set(mine.doc_tokens) == {len(ids)}
    for _, window in pieces.groupby("sequence_id"):
        window = window.sort_values("offset")
        assert window.offset.tolist() == [0, *np.cumsum(window.length)[:-1]]
        assert window.length.sum() <= length


def test_cuts_are_the_cheapest():
    draw = np.random.default_rng(1)
    for _ in range(30):
        places = np.cumsum(draw.integers(1, 9, 14))
        fees = draw.integers(0, 6, 14)
        fees[-1] = 0
        fee = dict(zip([0, *places.tolist()], [0, *fees.tolist()]))

        def cost(cuts):
            return sum(12 - (b - a) + fee[b] for a, b in zip([0, *cuts], cuts))

        best = {0: 0}
        for j in places.tolist():
            best[j] = min(best[i] + 12 - (j - i) + fee[j] for i in best if j - i <= 12)
        assert cost(packing.best_cuts(places, fees, 12).tolist()) == best[int(places[-1])]


def test_small_blocks_stay_open(monkeypatch):
    stream, cuts = packing.Stream(0, 64), 0
    for k in range(40):
        ids = np.arange(30, dtype=np.uint32)
        stream.add([k], ids, np.array([30]), np.array([11, 19]))
        cuts += sum(b.num_rows for b in stream.cut(last=False))
    pieces = sum(b.num_rows for b in stream.cut(last=True))
    assert cuts > 0 and pieces > 0 and len(stream.ids) == 0


def test_ids_of_hostile_texts_are_those_of_the_tokenizer():
    plain, mine = Tokenizer.from_file(PATH), packing.Encoder(PATH)
    draw = random.Random(6)
    parts = [
        "a", "Word", "é", "É", "é", "ſ", "K", "İ", "ı", "Σ", "ς", "ß", "ŉ", "ǅ", "ﬁ", "日本", "ّ", "٣", "3", ".", ",", ".,", "...", "…", "”", "'s", "'S", "'re", "$$$", "#", "-", "_", "\\", "<|endoftext|>",
        "<|ENDOFTEXT|>", "<|startoftext|>", "<|", "|>", "</w>", "\x00", "\x1c", "\x85", "\xa0", " ", "​", "　", " ", "\t", "\n", "\r\n", "\x0b", "\x0c", "ing", "THE", "the.", "x.y", "1.5", "😀", "﻿", "�",
    ]
    texts = ["".join(draw.choice(parts) + draw.choice(["", "", " "]) for _ in range(draw.randrange(0, 14))) for _ in range(6000)]
    for at in range(0, len(texts), 500):
        some = texts[at : at + 500]
        ids, ends, _ = mine.encode([t.encode() for t in some])
        for text, got in zip(some, np.split(ids, ends)[:-1]):
            assert got.tolist() == plain.encode(text, add_special_tokens=False).ids + [1], repr(text)
