import hashlib
import random
import re

import pytest

from canvass.llm.substrings import Repeats, substring_dedup

SF = "/root/testdata/sf0.001"


def brute(rows, k=20):
    """(doc_id, n_words, n_removed, sha) per row, from all windows in order."""
    texts = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in rows]
    first = {}
    for i, w in texts:
        for p in range(len(w) - k + 1):
            key = tuple(w[p : p + k])
            place = (i if i is not None else -(2**63), p)
            first[key] = min(first.get(key, place), place)
    out = []
    for i, w in texts:
        gone = [False] * len(w)
        for p in range(len(w) - k + 1):
            if first[tuple(w[p : p + k])] < (i if i is not None else -(2**63), p):
                gone[p : p + k] = [True] * k
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(docs, k=20):
    return sorted((tuple(r) for r in substring_dedup(docs, k).collect()), key=repr)


def test_random_texts(documents):
    rnd = random.Random(5)
    passage = [f"p{i}" for i in range(40)]
    rows = []
    for i in range(60):
        w = [rnd.choice("abcdefghij") + str(rnd.randrange(9)) for _ in range(rnd.randrange(0, 80))]
        at = rnd.randrange(0, len(w) + 1)
        part = passage[rnd.randrange(0, 20) : rnd.randrange(20, 41)]
        rows.append((i, " ".join(w[:at] + part * rnd.randrange(0, 3) + w[at:])))
    assert got(documents(*rows)) == brute(rows)


def test_shapes(documents):
    long = " ".join(str(i % 7) for i in range(300))
    text = " ".join(f"w{i}" for i in range(30))
    rows = [
        (1, None), (2, ""), (3, " \n\t "), (4, text), (5, text), (5, text), (6, "x\x0b" + text + "\r\n"), (7, long),
        (8, " ".join(f"w{i}" for i in range(19))), (9, text + " " + text), (None, text), (None, text), (9, "other text"),
        (9, "a " + text + " b"), (10, "one"),
    ]
    assert got(documents(*rows)) == brute(rows)
    assert got(documents(*rows, parts=1)) == brute(rows)


def test_no_rows(documents, spark):
    assert got(documents((1, "a")).filter("false")) == []


def test_clashing_columns(documents):
    df = documents((1, "a b c"), (2, "a b c")).withColumnsRenamed({"lang": "id", "source": "edge"})
    assert [r[2] for r in got(df, 20)] == [0, 0]


def test_spans(documents):
    text = [f"w{i}" for i in range(50)]
    rows = [(1, " ".join(["a", "b", *text])), (2, " ".join([*text[5:45], "z"]))]
    spans = [tuple(r) for r in Repeats(documents(*rows)).spans().collect()]
    assert spans == [(2, 0, 40, 1, 7)]


@pytest.mark.parametrize("folder", [SF])
def test_given_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert got(docs.repartition(5)) == brute(rows)
