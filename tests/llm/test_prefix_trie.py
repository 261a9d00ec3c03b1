"""The trie of conversations against a plain one, with shards and splitters of any size."""

import hashlib
import random
import zlib

import pytest

from agrometry.llm import prefix_trie

SCHEMA = "conv_id bigint, turn bigint, role string, text string, depth int, path string, family string"


def plain_turns(rows):
    talks = {}
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            role, text = role or "", text or ""
            mark = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            talks.setdefault(conv_id, []).append((turn is not None, turn or 0, mark, (role, text)))
    return {c: [t[3] for t in sorted(listed)] for c, listed in talks.items()}


def regrown(talks):
    out = {}
    for c, own in talks.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = talks.get(c - c % 5, [])[:h] + own[h:]
    return out


def plain_trie(talks):
    members = {}
    for c, listed in talks.items():
        for d in range(len(listed) + 1):
            members.setdefault(tuple(listed[:d]), []).append(c)
    children, below = {}, {}
    for node in members:
        if node:
            children.setdefault(node[:-1], []).append(node)
    for node in sorted(members, key=len, reverse=True):
        held = [below[n] for n in children.get(node, [])]
        size = len(node[-1][1].encode()) if node else 0
        below[node] = (sum(x for x, _ in held) or 1, sum(y for _, y in held) + (len(members[node]) - 1) * size)
    rows = []
    for node, held in members.items():
        ends = ",".join(str(c) for c in sorted(held) if len(talks[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        rows.append((min(held), len(node), parent, len(held), len(children.get(node, [])), *below[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(rows, key=str)


def _rows(seed):
    draw = random.Random(seed)
    rows = []
    for c in range(draw.randrange(1, 140)):
        number = draw.choice([c, 5 * c, c])
        for k in range(draw.choice([0, 1, 2, 3, 5, 9, 12])):
            rows.append((number, k if draw.random() < 0.95 else None, draw.choice(["user", "assistant", None]), draw.choice(["é", "b" * 30, "", None, f"x{draw.randrange(3)}"])))
    rows += [(1000 + c, k, "user", "same") for c in range(60) for k in range(4)]
    rows += [(2000, k, "user", f"long {k}") for k in range(300)] + [(2005, k, "user", f"long {k}") for k in range(299)]
    rows += [(None, 0, "user", "nobody"), (None, None, None, None), (7, None, None, None), (7, None, None, None)]
    return rows


@pytest.mark.parametrize("seed,shards,sampled,size", [(1, 64, 20, 8 << 20), (2, 5, 1, 8 << 20), (3, 40, 1, 2_000), (4, 40, 50, 0), (5, 7, 3, 8 << 20)])
def test_trie_against_a_plain_one(spark, monkeypatch, seed, shards, sampled, size):
    monkeypatch.setattr(prefix_trie, "MOST_SHARDS", shards)
    monkeypatch.setattr(prefix_trie, "SAMPLED_PER_SHARD", sampled)
    monkeypatch.setattr(prefix_trie, "SPLITTER_BYTES", size)
    monkeypatch.setattr(prefix_trie, "_PIECE", 3)
    rows = _rows(seed)
    talks = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(3)
    found = prefix_trie.trie(prefix_trie.paths(prefix_trie.regrown(talks)))
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain_trie(regrown(plain_turns(rows)))


def test_conversations_as_they_are(spark):
    rows = _rows(9)
    talks = spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).where("conv_id is not null")
    found = prefix_trie.trie(prefix_trie.paths(prefix_trie.turns(talks, ["conv_id"])))
    assert sorted((tuple(r) for r in found.collect()), key=str) == plain_trie(plain_turns(rows))


def test_an_empty_table_has_no_node(spark):
    assert prefix_trie.trie(prefix_trie.paths(prefix_trie.regrown(spark.createDataFrame([], SCHEMA)))).isEmpty()


def test_shards_are_even_and_copies_are_split(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "MOST_SHARDS", 16)
    rows = [(c, k, "user", "same") for c in range(900) for k in range(2)] + [(c, 0, "user", f"t{c}") for c in range(900, 1800)]
    talks = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    splits = prefix_trie.splitters(prefix_trie.paths(prefix_trie.turns(talks, ["conv_id"])))
    same = [path for path, conv_id in splits if conv_id < 900]
    assert len(splits) >= 14 and len(same) >= 5 and len(set(same)) == 1
