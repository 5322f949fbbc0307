import random
from collections import Counter, defaultdict

import duckdb
import pytest

from canvass.llm import mixing
from canvass.llm.mixing import Mix, mix_sources, mixed_documents


def targets(sizes, share=1.5, most=2):
    """By the rule: hand out by weight, stop at the caps, hand out the excess again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, out, open_ = share * sum(sizes.values()), {}, set(names)
    while open_:
        total = sum(weight[s] for s in open_)
        over = {s for s in open_ if left * weight[s] / total >= most * sizes[s]}
        if not over:
            return out | {s: left * weight[s] / total for s in open_}
        for s in over:
            out[s] = most * sizes[s]
        left -= sum(out[s] for s in over)
        open_ -= over
    return out


def check(rows, df):
    got = [tuple(r) for r in df.collect()]
    sizes, source = defaultdict(int), {}
    for i, t, s in rows:
        sizes[s] += len((t or "").split())
        source[i] = s
    want = targets(dict(sizes))
    taken = defaultdict(int)
    assert Counter((g[0], g[1]) for g in got) == Counter((i, len((t or "").split())) for i, t, _ in rows)
    for i, size, total, target, words in got:
        assert total == sizes[source[i]]
        assert target == pytest.approx(want[source[i]])
        assert 0 <= words <= 2 * size
        taken[source[i]] += words
    assert all(abs(taken[s] - want[s]) <= 0.5 for s in sizes)
    return got


def corpus(n=150, seed=4):
    rnd = random.Random(seed)
    names = ["b", "a", None, "ä", "Z", "hot", "hot", "hot"]
    return [(i, " ".join("w" * rnd.randrange(0, 90)) if i % 11 else None, rnd.choice(names)) for i in range(n)]


def test_targets(documents, monkeypatch):
    monkeypatch.setattr(mixing, "RUN", 8)
    rows = corpus()
    first = check(rows, mix_sources(documents(*rows, parts=5), block=32))
    assert sorted(first) == sorted(check(rows, mix_sources(documents(*rows, parts=2), block=32)))
    # the size of blocks decides the order, not the amounts
    assert sorted(first) == sorted(check(rows, mix_sources(documents(*rows, parts=2))))


def test_repeated_rows(documents):
    rows = [(1, "a b c", "x")] * 3 + [(None, "a b", "y"), (2, "", "y"), (2, None, "y"), (3, "one " * 40, None)]
    check(rows, mix_sources(documents(*rows), block=4))


def test_empty(documents):
    assert mix_sources(documents((1, "a")).filter("false")).collect() == []
    assert [tuple(r) for r in mix_sources(documents((1, None), (2, " "))).collect()] == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


def test_clashing_columns(documents):
    rows = corpus(30)
    check(rows, mix_sources(documents(*rows).withColumnsRenamed({"lang": "size", "n_chars": "key"})))


def test_schedule(documents):
    """Every stretch of the schedule holds each source about as often as its share says."""
    mix = Mix(documents(*corpus(300)), block=16)
    slots = sorted(tuple(r) for r in mix.slots.select("slot", "source", "epoch", "block").collect())
    share = {s: n / len(slots) for s, n in Counter(s for _, s, _, _ in slots).items()}
    for n in (50, 100, 200, len(slots)):
        held = Counter(s for _, s, _, _ in slots[:n])
        assert all(abs(held[s] - share[s] * n) <= 5 for s in share)
    assert len({(s, e, b) for _, s, e, b in slots}) == len(slots)


def test_mixed_documents(documents):
    rows = [(i, f"  {i} " + " ".join(f"{i}.{j}" for j in range(i % 40)), "abc"[i % 3]) for i in range(120)] + [(7, "same words here", "a")] * 3
    docs = documents(*rows)
    out = mixed_documents(docs, block=16)
    assert out.columns == docs.columns
    words = Counter()
    for r in out.collect():
        words[r.doc_id] += len(r.text.split())
    want = Counter()
    for r in mix_sources(docs, block=16).collect():
        want[r.doc_id] += r.taken
    assert words == +want
    texts = {t for _, t, _ in rows}
    assert sum(r.text in texts for r in out.collect()) >= out.count() - 4


@pytest.mark.parametrize("folder", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_given_documents(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    got = check([(r.doc_id, r.text, r.source) for r in docs.collect()], mix_sources(docs))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet'")
    want = con.execute(mixing.ORACLE).fetchall()
    rounded = lambda rows: sorted((i, a, b, round(t, 6), c) for i, a, b, t, c in rows)
    assert rounded(got) == rounded(want)
