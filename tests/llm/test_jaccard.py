import random
import re

import numpy as np
import pytest

from canvass.llm import jaccard
from canvass.llm.components import components
from canvass.llm.jaccard import jaccard_components, similar


def brute(rows, n=4, percent=85):
    sets = []
    for _, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        sets.append({tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set()))
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = {}
    for i, s in enumerate(sets):
        for g in s:
            holders.setdefault(g, []).append(i)
    pairs = {(a, b) for h in holders.values() for a in h for b in h if a < b}
    for a, b in pairs:
        if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
            root[find(a)] = find(b)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted(((d, len(sets[i]), least.get(find(i))) for i, (d, _) in enumerate(rows)), key=repr)


def got(docs):
    return sorted((tuple(r) for r in jaccard_components(docs).collect()), key=repr)


def edited(rnd, words, most):
    w = list(words)
    for _ in range(rnd.randrange(most + 1)):
        w[rnd.randrange(len(w))] = f"e{rnd.randrange(10**6)}"
    return " ".join(w)


def test_families(documents, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK", 7)
    rnd = random.Random(3)
    rows = []
    for size, most in ((40, 3), (150, 8), (9, 1), (7, 1)):
        base = [f"{size}w{i}" for i in range(size)]
        rows += [(len(rows) + i, edited(rnd, base, most)) for i in range(40)]
    rnd.shuffle(rows)
    for parts in (1, 5):
        assert got(documents(*rows, parts=parts)) == brute(rows)


def test_chain(documents):
    """Each text differs a little from the next; the ends have little in common."""
    rows = [(i, " ".join(f"w{j}" for j in range(4 * i, 4 * i + 80))) for i in range(30)]
    assert got(documents(*rows)) == brute(rows)
    assert {r[2] for r in got(documents(*rows))} == {0}


def test_shapes(documents):
    t = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, None), (2, ""), (3, " \n"), (4, "a"), (5, "A"), (6, "a b c"), (7, "A B  C"), (8, t), (9, t.upper()), (9, t + " x"),
        (None, t + " y"), (None, "only here"), (10, "only here"), (11, "É"), (12, "é"), (13, "a b c d"), (9, t), (14, t * 50),
    ]
    assert got(documents(*rows)) == brute(rows)


def test_no_rows_and_clashing_columns(documents):
    df = documents((1, "a b c d e f"), (2, "a b c d e f")).withColumnsRenamed({"lang": "sig", "source": "root"})
    assert got(df) == [(1, 3, 1), (2, 3, 1)]
    assert got(df.filter("false")) == []


def test_threshold():
    x = np.arange(1, 101, dtype=np.uint64) * np.uint64(2**57)
    assert similar(x[:100], x[:85], 85)
    assert not similar(x[:100], x[:84], 85)


def test_components(spark):
    links = [(1, 2), (2, 3), (9, 8), (8, 7), (5, 5), (7, 9)] + [(100 + i, 101 + i) for i in range(40)]
    got = {tuple(r) for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (7, 7), (8, 7), (9, 7)} | {(100 + i, 100) for i in range(41)}


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_given_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(docs.repartition(5)) == brute(rows)


def test_pairs_are_verified_once(documents, monkeypatch):
    """Families whose members are partly beyond the threshold: pairs that fail as a star are not tried again."""
    seen, verify = [], jaccard.NearCopies._verify

    def record(self, pairs):
        seen.extend(tuple(sorted(r)) for r in pairs.select("a", "b").collect())
        return verify(self, pairs)

    monkeypatch.setattr(jaccard.NearCopies, "_verify", record)
    rnd = random.Random(9)
    rows = []
    for size in (150, 300):
        base = [f"{size}w{i}" for i in range(size)]
        rows += [(len(rows) + i, edited(rnd, base, 9)) for i in range(40)]
    assert got(documents(*rows)) == brute(rows)
    assert len(seen) == len(set(seen)) and len(seen) > 20
