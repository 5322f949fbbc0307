from datetime import datetime

import pytest

from canvass.operators import export, report

NOW = "11/30/2025, 23:59:59"
ROUTE, BAGS, WHY = "Which route?", "How many bags?", "Anything to add?"
META = [n for n, _ in report.META_COLUMNS]
DEMO = [n for n, _ in report.DEMOGRAPHIC_COLUMNS]
TYPES = {c: "boolean" if c.startswith(("has_", "affinity")) else "int" if c == "dma" else "string" for c in export.DEMOGRAPHICS}
#: A value per column, told apart by the column's name.
FULL = {c: {"boolean": True, "int": 501}.get(kind, f"{c} x") for c, kind in TYPES.items()} | {"affinity_investor": False}
COLUMNS = ", ".join(f"{c} {kind}" for c, kind in TYPES.items())
SCHEMA = (
    f"poll_id string, ingestion_id bigint, submitted_at timestamp_ntz, market_name string, identity_source string, {COLUMNS}, "
    "answers map<string,string>"
)


@pytest.fixture(scope="module")
def tally_rows(spark):
    """Eight submissions to one poll; the question on bags comes before the others, the last has no known order."""
    counts = {(ROUTE, "r", 2): {"north": 5, "coast": 1, "hills": 1}, (BAGS, "b", 0): {"0": 3, "1": 4}, (WHY, "w", None): {"no": 2}}
    rows = [("trip", 8, key, text, order, a, n) for (text, key, order), answers in counts.items() for a, n in answers.items()]
    return spark.createDataFrame(
        rows, "poll_id string, total_responses bigint, question_key string, question string, question_order int, answer string, response_count bigint"
    )


@pytest.fixture(scope="module")
def export_rows(spark):
    """Three submissions per poll: a known person, one of whom little is known, and one without answers."""

    def build(*polls):
        rows = []
        for poll in polls or ("trip",):
            some = {c: v for c, v in FULL.items() if c in ("state", "age_band", "has_children_hh")}
            rows += [
                (poll, 31, datetime(2025, 11, 3, 17, 0, 1, 250000), "East", "events", *FULL.values(), {ROUTE: "north", BAGS: "1", WHY: "no"}),
                (poll, 7, datetime(2025, 11, 1), "West", "payload", *[some.get(c) for c in TYPES], {ROUTE: "coast, hills"}),
                (poll, 112, None, None, None, *[None] * len(TYPES), {}),
            ]
        return spark.createDataFrame(rows, SCHEMA)

    return build


def grid(reports, poll):
    rows = reports.where(reports.poll_id == poll).orderBy(*report.POSITION).collect()
    return [r["cells"] for r in rows]


def test_wide_grid(export_rows):
    df = report.response_grid(export_rows(), [BAGS, ROUTE], "trip")
    assert df.columns == [*META, BAGS, ROUTE, *DEMO]
    rows = {r["Response ID"]: r for r in df.collect()}
    assert [rows["31"][BAGS], rows["31"][ROUTE], rows["31"]["DMA"]] == ["1", "north", "501"]
    assert [rows["31"]["Has Children"], rows["31"]["Affinity: Investor"], rows["31"]["Affinity: Homeowner"]] == ["Yes", "No", "Yes"]
    assert [rows["7"][BAGS], rows["7"]["State"], rows["7"]["Gender"]] == ["", "state x", ""]
    assert {rows["112"][c] for c in df.columns[1:]} == {""}


def test_headings_from_what_was_answered(spark, tally_rows, export_rows):
    order = lambda t: report.ordered_questions(t, export_rows(), "trip")
    assert order(tally_rows) == [BAGS, ROUTE, WHY]
    assert order(tally_rows.where(tally_rows.question == ROUTE)) == [ROUTE, WHY, BAGS]  # the rest by name
    assert order(tally_rows.where("false")) == sorted([ROUTE, BAGS, WHY])
    assert report.ordered_questions(tally_rows, export_rows(), "elsewhere") == []


def test_stacked_report(tally_rows, export_rows):
    rows = grid(report.survey_reports(tally_rows, export_rows(), NOW), "trip")
    blocks = [
        [[], [f'Q: "{q}"'], ["Answer", "Count", "%"], *lines]
        for q, lines in (
            (BAGS, [["1", "4", "50.0%"], ["0", "3", "37.5%"]]),
            (ROUTE, [["north", "5", "62.5%"], ["coast", "1", "12.5%"], ["hills", "1", "12.5%"]]),
            (WHY, [["no", "2", "25.0%"]]),
        )
    ]
    top = [["trip"], ["Total Responses:", "8", f"Last Updated: {NOW} ET"], *[x for block in blocks for x in block]]
    assert rows[: len(top)] == top
    assert rows[len(top) : len(top) + 5] == [[], [], [report.DIVIDER], [], [*META, BAGS, ROUTE, WHY, *DEMO]]
    body = rows[len(top) + 5 :]
    assert sorted(r[0] for r in body) == ["112", "31", "7"]
    assert {r[0]: r[1] for r in body}["31"] == "2025-11-03 17:00:01.250"


def test_polls(spark, tally_rows, export_rows):
    """All polls with responses, or those of the mapping, responses or not."""
    exported = export_rows("trip", "other", "third")
    polls = lambda df: sorted(r["poll_id"] for r in df.select("poll_id").distinct().collect())
    assert polls(report.survey_reports(tally_rows, exported, NOW)) == ["other", "third", "trip"]
    mapped = report.survey_reports(tally_rows, exported, NOW, spark.createDataFrame([("third",), ("unused",)], "poll_id string"))
    assert polls(mapped) == ["third", "unused"]
    assert grid(mapped, "unused")[:2] == [["unused"], ["Total Responses:", "0", f"Last Updated: {NOW} ET"]]
    assert grid(mapped, "unused")[-1] == [*META, *DEMO] and len(grid(mapped, "unused")) == 7


def test_writing_replaces_only_the_given_polls(tally_rows, export_rows, tmp_path):
    path = str(tmp_path / "reports")
    write = lambda *polls: report.write_reports(report.survey_reports(tally_rows, export_rows(*polls), NOW), path)
    write("trip", "other")
    before = grid(tally_rows.sparkSession.read.parquet(path), "other")
    write("trip")
    stored = tally_rows.sparkSession.read.parquet(path)
    assert grid(stored, "other") == before
    assert grid(stored, "trip") == grid(report.survey_reports(tally_rows, export_rows(), NOW), "trip")


def test_export(spark, submit, options):
    opts = options((1, "m", "A", "catalog", False, "Label A"), (2, "m", "Z", "catalog", True), (3, "m", "N", "catalog", None), (4, "t", "typed", "response"))
    rows = submit(
        {"answers": [("m", ["N", "A", "A", "Z", " "]), ("t", "Typed \"q\""), ("n", 5), ("k2", "x")], "market_name": "nor"},
        {"answers": [("k1", "y"), ("k2", "x")], "market_name": ""},
        {"answers": []},
    )
    questions = spark.createDataFrame([("p", "k1", "Same?"), ("p", "k2", "Same?"), ("p", "m", None)], "poll_id string, question_key string, question_text string")
    who = spark.createDataFrame([(1, "a" * 64, "payload", None), (2, None, None, "Gazette")], "ingestion_id bigint, hem string, hem_source string, publication_name string")
    persons = export_demographics(spark)
    got = {r["ingestion_id"]: r for r in export.response_demographics(rows, questions, opts, who, persons).collect()}
    # catch-alls and blanks dropped, an unset flag kept, free text kept, equal question texts merged
    assert got[1]["answers"] == {"Same?": "x", "m": "Label A, N", "t": 'Typed "q"'}
    assert got[2]["answers"] == {"Same?": "x, y"} and got[3]["answers"] == {}
    assert [(got[i]["market_name"], got[i]["identity_source"], got[i]["age_band"]) for i in (1, 2, 3)] == [
        ("nor", "payload", "age_band x"),
        ("Gazette", None, None),
        (None, None, None),
    ]


def export_demographics(spark):
    return spark.createDataFrame([("a" * 64, *FULL.values())], f"hem string, {COLUMNS}")
