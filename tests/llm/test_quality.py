import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from canvass.llm import quality, subwords
from canvass.llm.quality import good_documents


def scored(df, labels):
    return {r.doc_id: r for r in quality.quality(df, labels).collect()}


def test_features():
    number, bucket = subwords.features(pa.array(["ab", "", "éab"]), 16, (3,))
    by_word = [set(bucket[number == k]) for k in range(3)]
    assert len(by_word[0]) == 3 and len(by_word[1]) == 1  # <ab and ab>, and the word itself
    assert len(by_word[0] & by_word[2]) == 1  # ab>


def corpus(n=160):
    rnd = random.Random(3)
    word = lambda: rnd.choice(["river", "stone", "meadow", "cloud", "garden", "light"])
    rows, labels = [], []
    for i in range(n):
        bad = i % 3 == 0
        w = [word() for _ in range(40)]
        rows.append((i, " ".join(f"{x}%%%" if i % 2 else w[0] for x in w) if bad else " ".join(w)))
        labels.append((i, int(not bad), 0))
    return rows, labels


def test_learns_what_is_marked(documents, spark):
    rows, labels = corpus()
    rows += [(500, None), (501, ""), (None, "river stone"), (502, "cloud " * 30000), (502, "cloud light"), (502, "cloud light")]
    table = spark.createDataFrame([*labels, (None, 1, 0), (9, None, 0), (9, 7, 0), (900, 1, 0)], "doc_id bigint, quality int, toxic int")
    df = documents(*rows).withColumnsRenamed({"lang": "_id", "source": "label"})
    got = quality.quality(df, table).collect()
    assert len(got) == len(rows)
    by_id = {r.doc_id: r for r in got}
    assert all(by_id[i].predicted == q for i, q, _ in labels)
    for i in range(100):
        assert by_id[i].held_out == (zlib.crc32(str(i).encode()) % 3 == 1)
    assert all(0 <= r.score <= 1 for r in got) and by_id[500].score == by_id[501].score
    assert by_id[502].predicted in (0, 1)


def test_held_out_labels_are_not_learnt(documents, spark):
    rows, labels = corpus(90)
    flipped = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in labels]
    schema = "doc_id bigint, quality int, toxic int"
    df = documents(*rows)
    a, b = (scored(df, spark.createDataFrame(x, schema)) for x in (labels, flipped))
    # only the marks of rows that may be learnt from, and how often each is given, decide
    assert all(a[i].score == pytest.approx(b[i].score) for i, _ in rows)


def test_one_class_or_no_rows(documents, spark):
    schema = "doc_id bigint, quality int, toxic int"
    df = documents((1, "a"), (2, "b"))
    got = scored(df, spark.createDataFrame([(1, 1, 0), (2, 1, 0)], schema))
    assert len({r.score for r in got.values()}) == 1
    none = spark.createDataFrame([], schema)
    assert quality.quality(df.filter("false"), none).collect() == []
    assert len(scored(df, none)) == 2


def test_kept_documents(documents, spark):
    rows, labels = corpus()
    df = documents(*rows)
    kept = good_documents(df, spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int"))
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, q, _ in labels if q}


def test_same_scores_for_any_partitions(documents, spark):
    rows, labels = corpus()
    table = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    a, b = (scored(documents(*rows, parts=p), table) for p in (1, 6))
    assert all(a[i].score == pytest.approx(b[i].score) for i, _ in rows)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    got = scored(spark.read.parquet(f"{folder}/documents.parquet"), labels)
    held = [(r.quality, got[r.doc_id].predicted) for r in labels.collect() if got[r.doc_id].held_out]
    assert len(held) > 800
    assert np.mean([a == b for a, b in held]) > 0.98
    assert np.mean([b for a, b in held if a == 1]) > 0.99
