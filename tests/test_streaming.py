import json
import random
from datetime import datetime

from helpers import tuples

from canvass.operators.upsert import NEW_IDS_FROM
from canvass.sources.responses import stage
from canvass.streaming import live

DOCS = [
    {"poll_id": "p", "answers": [{"question": "q", "answer": "A", "type": "single"}, {"question": "t", "answer": "x", "type": "text"}]},
    {"poll_id": "p", "answers": [{"question": "q", "answer": "B", "type": "single", "write_in": True}, {"question": "m", "answer": ["A", "", None, "B"]}]},
    {"poll_id": "p", "answers": [{"question": "q", "answer": "A"}, {"question": "n", "answer": 5}, {"question": "n", "answer": True}, {"question": "z", "answer": None}]},
    {"poll_id": "p", "answers": [{"question": "q", "answer": "B"}, {"question": "q", "answer": ""}]},
    {"answers": [{"question": "q", "answer": "A"}]},
    {"poll_id": "p"},
]
COUNTS = [("default", "q", "A", 1), ("p", "m", "A", 1), ("p", "m", "B", 1), ("p", "n", "5", 1), ("p", "n", "true", 1), ("p", "q", "A", 2), ("p", "q", "B", 1)]


def land(folder, docs, start=0):
    folder.mkdir(exist_ok=True)
    for i, doc in enumerate(docs, start):
        (folder / f"{i}.json").write_text(json.dumps(doc) + "\n")


def test_counts_of_batch_and_stream_are_equal(spark, tmp_path):
    land(tmp_path / "in", DOCS)
    raw = spark.read.text(str(tmp_path / "in")).withColumnRenamed("value", "raw")
    assert tuples(live.option_counts(stage(raw))) == COUNTS
    table = live.counter_table(spark, str(tmp_path / "out"), buckets=4, every=2)

    def run(files=None):
        arriving = live.raw_stream(spark, str(tmp_path / "in"), files_per_batch=files)
        query = live.run_option_counts(stage(arriving), table, str(tmp_path / "ck"))
        query.awaitTermination()
        return [p["batchId"] for p in query.recentProgress if p["numInputRows"]]

    assert run(2) == [0, 1, 2]
    assert tuples(table.read()) == COUNTS
    # a restart continues from the checkpoint and brings only what it changes
    land(tmp_path / "in", [DOCS[0]], start=100)
    (batch,) = run()
    brought = spark.read.parquet(f"{tmp_path}/out/changes/batch={batch}")
    assert tuples(brought.drop("bucket")) == [("p", "q", "A", 3)]
    after = sorted([c for c in COUNTS if c[:3] != ("p", "q", "A")] + [("p", "q", "A", 3)])
    assert tuples(table.read()) == after
    # a replayed batch changes nothing
    table.apply(spark.createDataFrame([("p", "q", "A", 3)], live.COUNTERS), batch)
    assert tuples(table.read()) == after


def test_keyed_table(spark, tmp_path):
    """Many small batches against a dictionary; merges rewrite only the buckets they touch."""
    rng, table, want = random.Random(4), live.counter_table(spark, str(tmp_path / "t"), buckets=4, every=3), {}
    assert table.read().collect() == []
    for n in range(8):
        rows = {("p", "q", str(rng.randrange(12)), rng.randrange(100))[:3]: n * 10 + i for i in range(rng.randrange(4))}
        table.apply(spark.createDataFrame([(*k, v) for k, v in rows.items()], live.COUNTERS), n)
        want |= rows
        assert tuples(table.read()) == sorted(((*k, v) for k, v in want.items()), key=repr)
    merges = {p.name: {b.name for b in p.iterdir() if b.is_dir()} for p in (tmp_path / "t" / "merged").iterdir() if p.is_dir()}
    assert set(merges) == {"merge=2", "merge=5"}
    # an unfinished merge is not read
    before = tuples(table.read())
    table.merge(7)
    (tmp_path / "t" / "places" / "version=7" / "_SUCCESS").unlink()
    assert tuples(table.read()) == before


def delivery(i, day, text="x", poll="p"):
    return (i, json.dumps({"poll_id": poll, "submitted_at": f"2024-01-{day:02d}T01:00:00Z", "device_id": text}))


def test_deliveries_are_taken_once(spark, tmp_path):
    intake = live.Intake(spark, str(tmp_path / "t"), days=3, until="2024-02-01")
    none = [(90, json.dumps({"poll_id": "p"})), (91, "not json"), (92, json.dumps({"submitted_at": "9999-01-01T00:00:00Z"}))]
    batches = [
        [delivery(1, 10), delivery(1, 10, "y"), delivery(2, 4), *none],
        [delivery(1, 10), delivery(2, 4), delivery(3, 7), delivery(4, 6), delivery(None, 9), delivery(5, 20)],
        [delivery(3, 7), delivery(5, 20), delivery(6, 17), delivery(7, 16)],
        [],
        [delivery(6, 17), delivery(5, 20), delivery(8, 19)],
    ]

    def result():
        return sorted(r[0] or 0 for r in intake.accepted().select("delivery_id").collect()), sorted(
            ((r[0], r[1]) for r in intake.aside().select("delivery_id", "reason").collect())
        )

    for n, rows in enumerate(batches):
        intake.take(spark.createDataFrame(rows, "delivery_id bigint, raw string"), n)
    want = [0, 1, 2, 3, 5, 6, 8], [(2, "late"), (3, "late"), (4, "late"), (7, "late"), (90, "undated"), (91, "undated"), (92, "undated")]
    assert result() == want
    # replays of the last batch change nothing
    intake.take(spark.createDataFrame(batches[-1], "delivery_id bigint, raw string"), 4)
    assert result() == want
    assert [r["device_id"] for r in intake.accepted().where("delivery_id = 1").collect()] == ["x"]


def test_intake_as_a_stream(spark, tmp_path):
    intake = live.Intake(spark, str(tmp_path / "t"), days=3, until="2024-02-01")
    for i in range(4):
        rows = [delivery(k, 5 + i) for k in range(i * 10, i * 10 + 10)] + [delivery(k, 4 + i) for k in range(max(i * 10 - 10, 0), i * 10)]
        spark.createDataFrame(rows, "delivery_id bigint, raw string").coalesce(1).write.parquet(str(tmp_path / "in" / f"n={i}"))
    intake.run(live.deliveries(spark, str(tmp_path / "in" / "*"), files_per_batch=1), str(tmp_path / "ck")).awaitTermination()
    assert sorted(r[0] for r in intake.accepted().select("delivery_id").collect()) == list(range(40))
    assert intake.aside().count() == 0


def test_shares_of_votes(spark):
    counts = spark.createDataFrame(COUNTS + [("p", "q", "C", 5)], "poll_id string, question_key string, option_value string, votes bigint")
    got = {(r["question_key"], r["label"]): r["percentage"] for r in live.option_stats(counts).where("poll_id = 'p'").collect()}
    assert got["q", "A"] == 25 and got["q", "B"] == 13 and got["q", "C"] == 63 and got["m", "A"] == 50


def test_raw_append(spark, tmp_path):
    land(tmp_path / "in", DOCS[:4])
    table, checkpoint = str(tmp_path / "raw"), str(tmp_path / "ck")
    for extra in (0, 2):
        land(tmp_path / "in", DOCS[4 : 4 + extra], start=50)
        live.run_raw_append(live.raw_stream(spark, str(tmp_path / "in"), files_per_batch=3), table, checkpoint).awaitTermination()
    rows = spark.read.parquet(table)
    assert rows.count() == 6
    assert sorted(r["ingestion_id"] for r in rows.collect()) == list(range(NEW_IDS_FROM, NEW_IDS_FROM + 6))


def test_repeats_are_dropped(spark, tmp_path):
    at = datetime(2024, 1, 1)
    rows = spark.createDataFrame([(1, at), (1, at), (2, at)], "ingestion_id bigint, submitted_at timestamp_ntz")
    rows.write.parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    run = (
        live.without_repeats(arriving)
        .writeStream.format("parquet")
        .option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(availableNow=True)
        .start(str(tmp_path / "out"))
    )
    run.awaitTermination()
    assert sorted(r["ingestion_id"] for r in spark.read.parquet(str(tmp_path / "out")).collect()) == [1, 2]
