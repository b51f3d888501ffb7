"""SimHash near-duplicates against a plain version of the definition."""

from __future__ import annotations

import random
import re

import numpy as np
import pytest
import xxhash

from lettermill.llm import simhash


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(ids, fps, limit=3):
    label = dict(zip(ids, ids))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(ids):
            for j, b in enumerate(ids):
                if (fps[i] ^ fps[j]).bit_count() <= limit and label[a] != label[b]:
                    label[a] = label[b] = min(label[a], label[b])
                    changed = True
    return label


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    words = ["alpha", "Beta", "été", "don't", "x", "ÀB", "gamma7"]
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "one two"), (6, "ONE two"), (7, "one two")]
    base = [rng.choice(words) + str(rng.randrange(50)) for _ in range(300)]
    for i in range(10, 60):
        text = list(base)
        for _ in range(rng.randrange(3)):
            text[rng.randrange(300)] = "new"
        rows.append((i, " ".join(text)))
    rows += [(i, " ".join(rng.choice(words) for _ in range(rng.randrange(1, 40)))) for i in range(60, 120)]
    return rows


def test_components_equal_plain_version(spark, rows):
    df = spark.createDataFrame([(i, t, "z") for i, t in rows], "doc_id long, text string, fp string")
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(df).collect()}
    fps = [plain_fingerprint(t) for _, t in rows]
    label = plain_components([i for i, _ in rows], fps)
    assert got == {i: (f"{f:016x}", label[i]) for (i, _), f in zip(rows, fps)}


def test_many_blocks_find_all_links(spark, monkeypatch):
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 64, 150, np.uint64)
    fps = np.unique(np.concatenate([base] + [
        base[rng.integers(0, 150, 150)] ^ (np.uint64(1) << rng.integers(0, 64, 150).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 150).astype(np.uint64))
        for _ in range(3)
    ]))
    ids = [int(i) for i in rng.permutation(len(fps))]
    monkeypatch.setattr(simhash, "BLOCK_FINGERPRINTS", 16)
    df = spark.createDataFrame(list(zip(ids, map(int, fps.view(np.int64)))), "rep long, fp long")
    from lettermill.llm.components import components

    got = {r["node"]: r["component"] for r in components(simhash.near_links(df, len(ids))).collect()}
    label = plain_components(ids, [int(f) for f in fps])
    assert {i: got.get(i, i) for i in ids} == label


def test_index_prunes_and_finds(monkeypatch):
    rng = np.random.default_rng(4)
    fps = rng.integers(0, 1 << 64, 2000, np.uint64)
    queries = fps[:50] ^ (np.uint64(1) << np.uint64(40)) ^ np.uint64(3)
    who, found = simhash.GrayIndex(fps).within(queries, 3, 1)
    assert {(int(a), int(b)) for a, b in zip(who, found)} >= {(i, i) for i in range(50)}


def test_dense_block_is_searched_in_pieces(monkeypatch):
    rng = np.random.default_rng(6)
    flips = [np.uint64(1) << rng.integers(0, 64, 1500).astype(np.uint64) for _ in range(2)]
    fps = np.unique(np.uint64(0x1234567890ABCDEF) ^ flips[0] ^ flips[1])  # all within four bits of each other
    index = simhash.GrayIndex(fps)
    expected = {
        (i, int(j)) for i, q in enumerate(fps)
        for j in np.flatnonzero((np.bitwise_count(q ^ fps) <= 3) & (np.bitwise_count((q ^ fps) >> simhash.HALF) <= 1))
    }
    for size in (1, 1000, 1 << 18):
        monkeypatch.setattr(simhash, "CANDIDATES", size)
        pieces = list(index.pieces_within(fps[:300] if size == 1 else fps, 3, 1))
        got = [(int(a), int(b)) for who, found in pieces for a, b in zip(who, found)]
        assert len(got) == len(set(got)) and set(got) == {p for p in expected if size > 1 or p[0] < 300}
        assert max(len(who) for who, _ in pieces) <= max(size, 16)
    assert len(index.within(fps[:0], 3, 1)[0]) == 0


def test_empty_and_repeated_rows(spark):
    schema = "doc_id long, text string"
    assert simhash.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    rows = simhash.near_duplicates(spark.createDataFrame([(3, "a b c"), (3, "a b c"), (None, "a b c")], schema)).collect()
    assert [r["component_id"] for r in rows] == [3, 3, 3]


def test_long_text_in_chunks(monkeypatch):
    text = " ".join(f"w{i % 77}" for i in range(1000))
    monkeypatch.setattr(simhash, "HASH_CHUNK", 64)
    assert simhash.fingerprint(text.encode()) % (1 << 64) == plain_fingerprint(text)
