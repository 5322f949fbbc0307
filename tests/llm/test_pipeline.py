"""The pipeline's stages and rows against plain computations."""

import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from canvass.llm import frames, mixing
from canvass.llm.quality import quality

FOLDER = "/root/testdata/sf0.001"


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def shingles(text, n=5):
    w = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


def first_of_groups(rows):
    sets, root = [shingles(r.text) for r in rows], list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)), key=lambda k: rows[k].doc_id)
                root[y] = x
    return {r.doc_id for i, r in enumerate(rows) if find(i) == i}


def score(item, text):
    j = np.arange(1, len(text) + 1)
    above, best = np.zeros(len(text) + 1, int), 0
    for w in item:
        t = np.maximum(np.maximum(above[:-1] + np.where(text == w, 2, -1), above[1:] - 1), 0)
        above[1:] = np.maximum.accumulate(t + j) - j
        best = max(best, int(above.max()))
    return best / (2 * len(item))


def plain_words(text):
    return np.array([w.strip(".,;:!?\"'()[]{}<>*#$%&|-_…“”‘’«»") for w in words(text.lower())])


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    root, docs, out = tmp_path_factory.mktemp("stages"), spark.read.parquet(f"{FOLDER}/documents.parquet"), []
    out.append(docs)
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, FOLDER).write.parquet(f"{root}/{i}")
        docs = spark.read.parquet(f"{root}/{i}")
        out.append(docs)
    return out


def test_columns(steps):
    assert all(x.columns == steps[0].columns for x in steps[1:-1])


def test_quality(spark, steps):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    good = {r.doc_id for r in quality(steps[0], labels).collect() if r.predicted}
    assert {r.doc_id for r in steps[1].collect()} == good
    marked = {r.doc_id: r.quality for r in labels.collect()}
    assert np.mean([d in good for d, q in marked.items() if q == 1]) > 0.9


def test_near_copies(steps):
    assert sorted(r.doc_id for r in steps[2].collect()) == sorted(first_of_groups(steps[1].collect()))


def test_decontamination(spark, steps):
    items = [plain_words(r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    held = {r.doc_id for r in steps[2].collect() if any(score(x, plain_words(r.text)) >= 0.5 for x in items)}
    assert {r.doc_id for r in steps[2].collect()} - {r.doc_id for r in steps[3].collect()} == held


def test_mix(steps):
    con = duckdb.connect()
    con.register("documents", steps[3].toArrow())
    want = Counter({r[0]: r[4] for r in con.execute(mixing.ORACLE).fetchall()})
    got = Counter()
    for r in steps[4].collect():
        got[r.doc_id] += len(words(r.text))
    assert got == +want


def test_tokens(steps):
    tokenizer = Tokenizer.from_file(frames.VOCABULARY)
    want = []
    for r in steps[4].collect():
        ids = np.array(tokenizer.encode(r.text, add_special_tokens=False).ids + [2], "<u4")
        want.append((r.doc_id, len(ids), zlib.crc32(ids.tobytes())))
    got = sorted(steps[5].collect(), key=lambda r: r.start)
    assert sorted((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == sorted(want)
    assert [r.doc_id for r in got] == sorted(r.doc_id for r in got)


def test_run(spark, steps):
    assert sorted(map(tuple, corpus_pipeline.run(spark, FOLDER).collect())) == sorted(map(tuple, steps[5].collect()))


def test_repeated_and_odd_rows(spark, documents, tmp_path):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (1, text), (2, text + " x"), (3, None), (3, None), (None, text), (4, " ".join(f"v{i}" for i in range(30))), (4, "short one")]
    out = corpus_pipeline.near_copies(spark, documents(*rows), "").collect()
    assert sorted((r.doc_id, len(r.text or "")) for r in out) == [(1, len(text)), (3, 0), (3, 0), (4, 9), (4, len(rows[6][1]))]
