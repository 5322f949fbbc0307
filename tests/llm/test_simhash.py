"""SimHash against all pairs of plainly computed fingerprints."""

import random
import re

import numpy as np
import pytest
import xxhash

from canvass.llm import simhash as s


def plain_fingerprint(text, n=4):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = [w for w in re.split("[ \t\n\x0b\x0c\r]+", low) if w]
    grams = [" ".join(found[i : i + n]) for i in range(len(found) - n + 1)] or ([" ".join(found)] if found else [])
    hashes = [xxhash.xxh64(g.encode(), seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain(rows, radius=4):
    """(id, fingerprint, component) of each row, by comparing all pairs."""
    fps = [plain_fingerprint(t) for _, t in rows]
    a = np.array(fps, np.uint64)
    parent = list(range(len(a)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(a)):
        near = np.flatnonzero(np.unpackbits((a ^ a[i]).view(np.uint8).reshape(-1, 8), axis=1).sum(axis=1) <= radius)
        for j in near.tolist():
            x, y = find(i), find(j)
            parent[max(x, y)] = min(x, y)
    groups = {}
    for i, (k, _) in enumerate(rows):
        groups.setdefault(find(i), []).append(k)
    least = {g: min((k for k in v if k is not None), default=None) for g, v in groups.items()}
    return sorted(((k, f"{fps[i]:016x}", least[find(i)]) for i, (k, _) in enumerate(rows)), key=repr)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_given_documents(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [tuple(r) for r in df.select("doc_id", "text").collect()]
    assert got(s.simhash_components(df)) == plain(rows)


def test_edges(spark, documents):
    rng = random.Random(2)
    base = [f"w{rng.randrange(3000)}" for _ in range(400)]
    rows = [(i, " ".join(base[:i] + [f"x{i}"] + base[i + 1 :])) for i in range(0, 120, 2)]
    rows += [(500, None), (501, ""), (502, " \n\t"), (503, "One"), (504, "one"), (505, "two words"), (506, "TWO\x0bwords ")]
    rows += [(507, "Été naïve café ß straße"), (508, "a b c d"), (508, "a b c d"), (None, "a b c d"), (None, "alone here")]
    rows += [(509, "nb sp　x y z"), (510, "y" * 300_000 + " z"), (511, " ".join(base * 60))]
    assert got(s.simhash_components(documents(*rows))) == plain(rows)


def test_empty_and_clashing(spark):
    df = spark.createDataFrame([], "doc_id bigint, text string")
    assert s.simhash_components(df).collect() == []
    df = spark.createDataFrame([(1, "a b", 1, 2, 3)], "doc_id bigint, text string, id int, fp int, least int")
    assert s.simhash_components(df).count() == 1


@pytest.mark.parametrize("radius", [0, 1, 4, 7])
def test_within_equals_popcount(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 2**64, 40, dtype=np.uint64)
    flips = (np.uint64(1) << rng.integers(0, 64, (4000, 6), dtype=np.uint64)).astype(np.uint64)
    fp = base[rng.integers(0, 40, 4000)] ^ np.bitwise_or.reduce(flips[:, : radius + 1], axis=1)
    stack = s.planes(fp)
    for d in (1, 63, 64, 65, 200, 3999):
        wanted = rng.random(len(fp) - d) < 0.7
        differ = np.unpackbits((fp[:-d] ^ fp[d:]).view(np.uint8).reshape(-1, 8), axis=1).sum(axis=1)
        assert s.within(stack, d, wanted, radius).tolist() == np.flatnonzero(wanted & (differ <= radius)).tolist()


@pytest.mark.parametrize("k", [1, 2, 3, 4, 5])
def test_any_number_of_blocks_finds_all_links(spark, monkeypatch, k):
    """Chains of fingerprints at the radius, a dense group, and keys cut into many blocks."""
    monkeypatch.setattr(s, "blocks_for", lambda count, radius: k)
    monkeypatch.setattr(s, "BLOCK", 40)
    rng = np.random.default_rng(k)
    fp = rng.integers(0, 2**64, 300, dtype=np.uint64).tolist()
    for start in fp[:20]:
        x = start
        for _ in range(6):
            for b in rng.choice(64, 4, replace=False):
                x ^= 1 << int(b)
            fp.append(x)
    fp += [fp[30] ^ (1 << int(a)) ^ (1 << int(b)) for a, b in rng.integers(0, 64, (200, 2)) if a != b]
    fp = sorted(set(fp))
    nodes = spark.createDataFrame([(f - 2**64 if f >= 2**63 else f,) for f in fp], "fp long")
    a = np.array(fp, np.uint64)

    def classes(pairs):
        parent = {f: f for f in fp}

        def find(i):
            while parent[i] != i:
                i = parent[i]
            return i

        for x, y in pairs:
            parent[max(find(x), find(y))] = min(find(x), find(y))
        return {f: find(f) for f in fp}

    pairs = [(r.a % 2**64, r.b % 2**64) for r in s.near_links(nodes).collect()]
    assert all((x ^ y).bit_count() <= 4 for x, y in pairs)
    near = [(fp[i], fp[j]) for i in range(len(fp)) for j in np.flatnonzero(np.bitwise_count(a ^ a[i]) <= 4)]
    assert classes(pairs) == classes(near)


def test_group_of_copies_gives_few_links():
    """Near copies in one key: one link a member, not one a pair."""
    rng = np.random.default_rng(1)
    fp = np.unique(np.uint64(2**40 + 12345) ^ (np.uint64(1) << rng.integers(0, 64, 3000, dtype=np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 3000, dtype=np.uint64)))
    n = len(fp)
    a, b = s.forest(fp, np.zeros(n, np.int64), np.zeros(n, np.int64), 4)
    assert len(a) == n - 1
