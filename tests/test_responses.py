import json

from helpers import tuples

from canvass.sources import responses as source
from canvass.sources.adapter import Survey


def test_computed_columns_and_odd_documents(spark):
    raw = spark.createDataFrame(
        [
            (1, '{"poll_id":"p","submitted_at":"2025-03-04T13:29:55.695Z","answers":[{"question":"a","answer":"x"}]}'),
            (2, '{"poll_id":"p","submitted_at":"yesterday","answers":"oops"}'),
            (3, "garbage"),
            (4, '{"answers":[]}'),
        ],
        "ingestion_id bigint, raw string",
    )
    rows = {r["ingestion_id"]: r for r in source.stage(raw).collect()}
    assert str(rows[1]["submitted_at"]) == "2025-03-04 13:29:55.695000" and len(rows[1]["answers"]) == 1
    assert rows[2]["submitted_at"] is None and rows[2]["answers"] is None
    assert rows[3]["poll_id"] is None
    assert [r["ingestion_id"] for r in source.rejects(raw).orderBy("ingestion_id").collect()] == [3, 4]


def test_kinds_keep_position_and_odd_entries_do_no_harm(submit):
    rows = submit(
        {
            "answers": [
                ("s", "x"),
                ("n", 5),
                7,
                ("z", None),
                {"question": "m"},
                ("b", True),
                ("o", {"k": 1}),
                ("l", ["1", 2, None]),
                ("e", []),
                {"question": "w", "answer": "t", "write_in": "yes"},
            ]
        },
        {"answers": []},
        {},
    )
    got = tuples(source.answers(rows).select("pos", "question_key", "kind", "write_in"))
    assert got == [
        (0, "s", "string", False),
        (1, "n", "other", False),
        (2, None, "none", False),
        (3, "z", "none", False),
        (4, "m", "none", False),
        (5, "b", "other", False),
        (6, "o", "other", False),
        (7, "l", "array", False),
        (8, "e", "array", False),
        (9, "w", "string", True),
    ]
    values = tuples(source.elements(rows).select("question_key", "answer_value"))
    assert values == [("l", "1"), ("l", "2"), ("l", None), ("s", "x"), ("w", "t")]


def test_elements_read_only_what_they_need(spark, submit, tmp_path):
    path = str(tmp_path / "r")
    submit({"answers": [("s", "x")]}).write.parquet(path)
    plan = source.elements(spark.read.parquet(path))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<ingestion_id:bigint,poll_id:string,answers" in plan
    assert "external_id" not in plan and "Exchange" not in plan


def test_documents_are_made_without_a_variant_per_answer(spark, tmp_path):
    orders = [(6, 3, "F", "2-HIGH"), (8, 4, None, None), (None, None, None, None)]
    spark.createDataFrame(orders, "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string").write.parquet(f"{tmp_path}/orders.parquet")
    spark.createDataFrame([(6, 1, "R"), (6, 2, "A")], "l_orderkey bigint, l_partkey bigint, l_returnflag string").write.parquet(f"{tmp_path}/lineitem.parquet")
    spark.createDataFrame([(1, 'Brand"1')], "p_partkey bigint, p_brand string").write.parquet(f"{tmp_path}/part.parquet")
    made = Survey(spark, str(tmp_path)).raw
    assert "variant" not in made._jdf.queryExecution().analyzed().toString()
    docs = {r["ingestion_id"]: r["raw"] for r in made.collect()}
    assert docs[6] == (
        '{"poll_id":"poll_2","device_id":"dev_3","external_id":"garbage","market_name":"Market 3",'
        '"submitted_at":"2024-01-08T00:00:06.000Z","answers":['
        '{"question":"flags","answer":["A","R"],"type":"multi"},{"question":"status","answer":"F","type":"single"},'
        '{"question":"note","answer":"  BRAND\\"1 ","type":"text"},{"question":"rating","answer":1,"type":"rating"},'
        '{"question":"channel","answer":"Other 3","type":"single","write_in":true}]}'
    )
    assert '"answers":[{"question":"status","type":"single"},{"question":"flags","type":"multi"},{"question":"note",' in docs[8]
    assert json.loads(docs[None])["answers"] and "poll_id" not in json.loads(docs[None])
