import json

from helpers import tuples

from canvass.operators import tally


def questions_of(spark, *rows):
    return spark.createDataFrame(list(rows), "poll_id string, question_key string, question_text string")


def test_percent_of_submissions(spark, submit, options):
    opts = options((1, "m", "A", "catalog", False, "Label A"), (2, "m", "B", "catalog", True))
    rows = submit({"answers": [("m", ["A", "B"])]}, {"answers": [("m", ["A"]), ("n", 5)]}, {"answers": []}, {})
    got = tuples(tally.response_tally(rows, questions_of(spark, ("p", "m", None)), opts))
    # catch-alls are counted, lists can sum to more than 100, numbers vanish, empty submissions count in the total
    assert got == [("p", 4, "m", "B", 1, 25.0), ("p", 4, "m", "Label A", 2, 50.0)]


def test_string_and_list_entry_stay_two_rows(spark, submit, options):
    rows = submit({"answers": [("m", "A")]}, {"answers": [("m", ["A"])]})
    got = tuples(tally.response_tally(rows, questions_of(spark, ("p", "m", "M?")), options((1, "m", "A"))))
    assert got == [("p", 2, "M?", "A", 1, 50.0), ("p", 2, "M?", "A", 1, 50.0)]


def test_null_list_entry_is_counted_without_a_label(spark, submit, options):
    rows = submit({"answers": [("m", ["A", None])]})
    got = tuples(tally.response_tally(rows, questions_of(spark), options((1, "m", "A"))))
    assert ("p", 1, "m", None, 1, 100.0) in got and len(got) == 2


def test_order_is_smallest_position_of_any_kind(spark, submit, options):
    rows = submit({"answers": [("b", 1), ("a", "x")]}, {"answers": [("a", "x"), ("c", "z"), ("b", "y")]}, {"poll_id": "p2", "answers": [("a", "x")]})
    got = tuples(tally.report_tally(rows, questions_of(spark), options((1, "a", "x")), "p").select("question", "question_order", "answer", "response_count"))
    assert got == [("a", 0, "x", 2), ("b", 0, "y", 1), ("c", 1, "z", 1)]


def test_documents(spark, submit, options):
    rows = submit({"answers": [("a", "x")]}, {"answers": [("a", "y")]}, {"answers": [("a", "y")]})
    counted = tally.response_tally(rows, questions_of(spark), options((1, "a", "x")))
    doc = tally.tally_documents(counted, size=10).first()
    assert [e["answer"] for e in json.loads(doc["answers"])] == ["y", "x"]
    parts = tally.tally_documents(counted, size=1).collect()
    assert sorted(r["part"] for r in parts) == [0, 1]
    assert sorted(e["answer"] for r in parts for e in json.loads(r["answers"])) == ["x", "y"]


def test_documents_stay_small(spark):
    """A free-text question of many answers, one with few, and labels that several values share."""
    rows = [("p", 9, "free", f"a{i}", 1 + i % 3, 0.1) for i in range(2500)] + [("p", 9, "few", "x", 2, 0.2), ("q", 1, "free", "x", 1, 0.3)]
    rows += [("q", 1, "same", "l", i, 0.1) for i in range(1, 6)] + [("q", 1, None, None, 1, 0.1)]
    df = spark.createDataFrame(rows, "poll_id string, total_responses bigint, question string, answer string, response_count bigint, pct double")
    got = tally.tally_documents(df, size=7).collect()
    sizes = {}
    for r in got:
        sizes.setdefault((r["poll_id"], r["question"]), []).append((r["part"], len(json.loads(r["answers"]))))
    assert sorted(sizes["p", "free"]) == [(k, 7) for k in range(357)] + [(357, 1)]
    assert sizes["p", "few"] == [(0, 1)] and sizes["q", "same"] == [(0, 5)] and sizes["q", None] == [(0, 1)]
    counts = [e["count"] for e in json.loads(next(r["answers"] for r in got if r["part"] == 3))]
    assert counts == sorted(counts, reverse=True)


def test_patterns(submit, options):
    rows = submit(
        {"answers": [("a", "1"), ("b", "2"), ("a", "3"), ("m", ["9"])]},
        {"answers": [("a", "1"), ("b", "2")]},
        {"poll_id": "other", "answers": [("a", "1"), ("b", "2")]},
    )
    opts = options((7, "a", "1"))
    got = tuples(tally.answer_patterns(rows, opts, "p"))
    # ordered pairs of different questions, lists left out
    assert got == [("p", "a", 7, "1", "b", None, "2", 2), ("p", "b", None, "2", "a", None, "3", 1)]
    assert len(tuples(tally.answer_patterns(rows, opts, top=1))) == 2
