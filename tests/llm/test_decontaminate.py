import random

import numpy as np
import pytest

from canvass.llm.decontaminate import align, contamination


def brute_score(a, b):
    h = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a, 1):
        for j, y in enumerate(b, 1):
            h[i][j] = max(0, h[i - 1][j - 1] + (2 if x == y else -1), h[i - 1][j] - 1, h[i][j - 1] - 1)
    return max(map(max, h))


def test_alignment():
    rnd = random.Random(0)
    for _ in range(300):
        a, b = ([rnd.randrange(4) for _ in range(rnd.randrange(1, 15))] for _ in range(2))
        assert align(np.array(a), np.array(b))[0] == brute_score(a, b)


@pytest.fixture()
def benchmark(spark):
    rnd = random.Random(7)
    word = lambda: "".join(rnd.choice(["ba", "ce", "di", "fo", "gu"]) for _ in range(3))
    items = [[word() for _ in range(30)] for _ in range(12)]
    rows = [(i, " ".join(w).capitalize() + ".") for i, w in enumerate(items)] + [(50, "xyzzy too short"), (53, "What is sodium?"), (51, None), (52, ""), (3, " ".join(items[3]))]
    return items, spark.createDataFrame(rows, "item_id bigint, text string"), word


def found(docs, bench):
    return {(r.doc_id, r.item_id): r for r in contamination(docs, bench).collect()}


def test_copies(documents, benchmark):
    items, bench, word = benchmark
    filler = lambda n: " ".join(word() for _ in range(n))
    edited = [w if i % 6 else "changed" for i, w in enumerate(items[1])]
    cut = items[2][:9] + items[2][11:20] + ["one", "more"] + items[2][20:]
    rows = [
        (1, f"{filler(50)} {' '.join(items[0]).upper()}! {filler(30)}"),
        (2, f"{filler(20)}\n{', '.join(edited)}"),
        (3, f"{filler(400)} {' '.join(cut)} {filler(100)}"),
        (4, f"{filler(20)} {' '.join(items[4][:9])} {filler(20)}"),
        (5, filler(300)),
        (6, " ".join(items[5]) + " " + filler(500) + " " + " ".join(items[6])),
        (7, None), (8, ""), (9, "too short"), (12, "xyzzy. TOO short"), (13, f"{filler(9)} what is sodium {filler(9)}"), (14, "what is sodium-free"), (None, " ".join(items[7])),
        (10, " ".join(items[8])), (10, " ".join(items[8])), (10, " ".join(items[9])),
    ]
    rows += [(11, " ".join(w if i % 5 else "other" for i, w in enumerate(items[10])))]
    rows += [(100 + i, f"{filler(5)} {' '.join(items[10])} {i}") for i in range(40)]
    df = documents(*rows).withColumnsRenamed({"lang": "seed", "source": "item"})
    got = found(df, bench)
    want = {(12, 50), (13, 53), (1, 0), (2, 1), (3, 2), (6, 5), (6, 6), (None, 7), (10, 8), (10, 9), (11, 10)} | {(100 + i, 10) for i in range(40)}
    assert set(got) == want
    assert len(contamination(df, bench).collect()) == len(want)
    assert got[1, 0].score == 1.0 and (got[1, 0].first_word, got[1, 0].end_word) == (50, 80)
    assert 0.5 < got[2, 1].score < 1 and 0.5 < got[3, 2].score < 1


def edited(item, step, how, word):
    """Every step-th word changed, left out, or followed by another."""
    out = []
    for i, w in enumerate(item, 1):
        out += [w] if i % step else [word()] if how == "changed" else [] if how == "left out" else [w, word()]
    return out


def test_recall_of_edited_copies(spark, documents):
    """Copies with every third to fifth word edited, among texts full of the items' frequent phrase, against aligning all
    pairs."""
    rnd = random.Random(3)
    word = lambda: "".join(rnd.choice(["ba", "ce", "di", "fo", "gu", "ha", "je"]) for _ in range(4))
    phrase = ["which", "of", "the", "following"]
    items = [[*(word() for _ in range(13)), *phrase, *(word() for _ in range(13))] for _ in range(40)]
    rows, kinds = [(5000 + i, " ".join([word() for _ in range(40)] + phrase)) for i in range(60)], {}
    for i, item in enumerate(items):
        for step in (3, 4, 5):
            for how in ("changed", "left out", "followed"):
                kinds[len(kinds)] = (step, how)
                text = [word() for _ in range(20)] + edited(item, step, how, word) + [word() for _ in range(20)]
                rows.append((len(kinds) - 1, " ".join(text)))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id bigint, text string")
    got = set(found(documents(*rows), bench))
    number = {w: k for k, w in enumerate({w for _, t in rows for w in t.split()} | {w for x in items for w in x})}
    code = lambda ws: np.array([number[w] for w in ws])
    want = {
        (d, i) for d, t in rows for i, item in enumerate(items) if align(code(item), code(t.split()))[0] >= len(item)
    }
    by_kind = {}
    for d, i in want:
        by_kind.setdefault(kinds[d], []).append((d, i) in got)
    assert got <= want and len(want) > 300
    assert len(by_kind) == 9
    assert all(np.mean(x) >= 0.95 for x in by_kind.values()), {k: np.mean(x) for k, x in by_kind.items()}


def test_recall_on_given_documents(spark):
    """Edited copies of the given items inside given documents."""
    rnd = random.Random(8)
    folder = "/root/testdata/sf0.01"
    docs, bench = (spark.read.parquet(f"{folder}/{x}.parquet") for x in ("documents", "benchmark"))
    items = [(r.item_id, r.text.split()) for r in bench.collect()][:30]
    texts = [r.text.split() for r in docs.limit(200).collect() if r.text]
    rows = []
    for k, (_, item) in enumerate(items):
        for step in (3, 4, 5):
            text = rnd.choice(texts)
            cut = rnd.randrange(len(text) + 1)
            rows.append((10**6 + 10 * k + step, " ".join([*text[:cut], *edited(item, step, "changed", lambda: "otherwise"), *text[cut:]])))
    more = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = set(found(docs.select("doc_id", "text").union(more), bench))
    want = {}
    for d, _ in rows:
        k, step = divmod(d - 10**6, 10)
        item = [hash(w) for w in items[k][1]]
        copy = [hash(w) for w in edited(items[k][1], step, "changed", lambda: "otherwise")]
        if align(np.array(item), np.array(copy))[0] >= len(item):
            want.setdefault(step, []).append((d, items[k][0]) in got)
    assert {4, 5} <= set(want) and all(np.mean(x) >= 0.95 for x in want.values())


def test_one_item_twice(documents, benchmark):
    items, bench, _ = benchmark
    assert set(found(documents((1, " ".join(items[3]))), bench)) == {(1, 3)}


def test_empty(documents, benchmark, spark):
    _, bench, _ = benchmark
    docs = documents((1, "a b c d e"))
    assert found(docs.filter("false"), bench) == {} == found(docs, bench.filter("false"))


def test_given_documents(spark):
    folder = "/root/testdata/sf0.01"
    docs, bench = (spark.read.parquet(f"{folder}/{x}.parquet") for x in ("documents", "benchmark"))
    got = set(found(docs, bench))
    whole = {(d.doc_id, b.item_id) for d in docs.collect() for b in bench.collect() if b.text in d.text}
    assert whole and whole <= got
    assert len({d for d, _ in got}) < 0.2 * docs.count()
