"""The prefix trie against a plain version of the definition."""

from __future__ import annotations

import hashlib
import random
import zlib

import pytest

from lettermill.llm import conversations

SCHEMA = "conv_id long, turn long, role string, text string, depth string"


def rebuilt(rows):
    own = {}
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(ts)] for c, ts in own.items()}
    first = {c: zlib.crc32(str(c).encode()) % 9 for c in own}
    return {c: own.get(c - c % 5, [])[: first[c]] + ts[first[c] :] for c, ts in own.items()}


def plain(seqs):
    members = {}
    for c, seq in seqs.items():
        for d in range(len(seq) + 1):
            members.setdefault(tuple(seq[:d]), []).append(c)
    kids = {}
    for path in members:
        if path:
            kids.setdefault(path[:-1], []).append(path)
    leaves, saved = {}, {}
    for path in sorted(members, key=len, reverse=True):
        below = kids.get(path, [])
        leaves[path] = sum(leaves[k] for k in below) or 1
        saved[path] = sum(saved[k] for k in below) + (len(members[path]) - 1) * (len(path[-1][1].encode()) if path else 0)
    out = []
    for path, ids in members.items():
        ends = ",".join(str(c) for c in sorted(ids) if len(seqs[c]) == len(path))
        out.append((
            min(ids), len(path), min(members[path[:-1]]) if path else None, len(ids), len(kids.get(path, [])),
            leaves[path], saved[path], hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return sorted(out, key=repr)


def nodes(spark, rows, limit=4096, parts=3):
    found = conversations.conversation_trie(spark.createDataFrame(rows, SCHEMA).repartition(parts), limit)
    assert found.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(map(tuple, found.collect()), key=repr)


def make(seed, n=150, longest=9, vocab=3):
    rng = random.Random(seed)
    rows = []
    for c in range(n):
        rows += [(c * 2 % 97 if c % 10 == 0 else c, t, rng.choice(["user", "bot"]), rng.choice(["é" * k for k in range(vocab)]), "x") for t in range(rng.randrange(1, longest))]
    rows = list({(r[0], r[1]): r for r in rows}.values())
    rows += [(500, None, "user", "early", None), (500, 3, None, None, None), (500, 5, "user", "late", None), (None, 1, "user", "no one", None)]
    rows += [(505, 1, "user", "same", None)] * 3 + [(10**15, 2, "", "", None)]
    return rows


@pytest.mark.parametrize("seed, limit, segment", [(1, 4096, 256), (2, 3, 256), (3, 1, 256), (4, 4096, 3), (5, 2, 2), (6, 1, 1)])
def test_equals_the_plain_version(spark, monkeypatch, seed, limit, segment):
    monkeypatch.setattr(conversations, "SEGMENT", segment)
    monkeypatch.setattr(conversations, "SHARD_ROWS", 20)
    rows = make(seed)
    assert nodes(spark, rows, limit) == plain(rebuilt(rows))


def test_copies_and_a_long_conversation(spark, monkeypatch):
    monkeypatch.setattr(conversations, "SEGMENT", 16)
    monkeypatch.setattr(conversations, "PIECE_BYTES", 50)
    rows = [(c, t, "user", f"hello {t}", None) for c in range(300) for t in range(4)]
    rows += [(1001, t, "user", f"line {t % 50}", None) for t in range(700)] + [(1002, t, "user", f"line {t % 50}", None) for t in range(400)]
    assert nodes(spark, rows, 5, 7) == plain(rebuilt(rows))


def test_copies_never_fill_a_container(spark):
    """A group of copies is one suffix; the largest shard holds distinct suffixes only."""
    rows = [(c, t, "user", f"hello {t}", None) for c in range(2000) for t in range(8)]
    convs, turns = conversations.rebuilt_turns(spark.createDataFrame(rows, SCHEMA))
    distinct = conversations.distinct_rows(conversations.segment_rows(convs, turns))
    assert distinct.count() <= 9 and distinct.agg({"n": "sum"}).first()[0] == 2000


def test_empty_tables(spark):
    assert nodes(spark, []) == [] and nodes(spark, [(None, 1, "user", "x", None)]) == []
    assert nodes(spark, [(1, None, None, None, None)]) == plain(rebuilt([(1, None, None, None)]))
