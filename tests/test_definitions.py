import json

import pytest
from helpers import tuples

from canvass.sources import definitions

SCALE = [{"value": str(n), "label": name} for n, name in enumerate(["Never", "Rarely", "Often"])]
GARDEN = {
    "version": 4,
    "option_sets": {"scale": SCALE, "beds": [{"value": "Herbs"}, {"value": "No beds", "exclusive": True, "is_catch_all": True}, {"value": "Roses"}]},
    "questions": {
        "soil": {"type": "single", "question": "Soil?", "options": [{"value": "Clay"}]},
        "tasks": {
            "type": "matrix", "question": "How often?", "help_text": "one per row", "options": "scale",
            "rows": ["Dig & weed", "Water", "Prune (trees)"], "rows_from": "beds_kept", "auto_advance": True,
        },
        "beds_kept": {"type": "multi", "question": "Beds?", "min_select": 1, "options": "beds", "required": True},
        "diary": {"type": "text", "placeholder": "today …", "max_length": 90, "show_results": False},
    },
    "pages": [
        {"groups": [{"questions": ["soil"]}, {"questions": ["beds_kept", "tasks"]}]},
        {"groups": []},
        {"groups": [{"questions": ["diary"]}]},
    ],
}


@pytest.fixture(scope="module")
def items(spark):
    def build(*rows):
        columns = "id string, definition string, `1` string, `2` string, `10` string"
        full = [(list(r) + [None] * 5)[:5] for r in rows]
        return spark.createDataFrame(full, columns)

    return build


TASKS = ["tasks__dig_weed", "tasks__water", "tasks__prune_trees"]


def test_questions(items):
    rows = {r["question_key"]: r for r in definitions.questions(items(("g", json.dumps(GARDEN)))).collect()}
    assert sorted(rows) == sorted(["soil", "beds_kept", "diary", *TASKS])
    diary = rows["diary"]
    assert (diary["question_type"], diary["question_text"], diary["max_length"], diary["placeholder"]) == ("text", None, 90, "today …")
    assert not diary["show_results"] and not diary["is_required"] and rows["soil"]["show_results"]
    assert rows["beds_kept"]["min_select"] == 1 and rows["beds_kept"]["is_required"]


def test_matrix_rows_become_questions(items):
    source = items(("g", json.dumps(GARDEN)))
    rows = {r["question_key"]: r for r in definitions.questions(source).collect()}
    assert [rows[k]["question_text"] for k in TASKS] == ["How often? — Dig & weed", "How often? — Water", "How often? — Prune (trees)"]
    assert {rows[k]["question_type"] for k in TASKS} == {"single"}
    assert {rows[k]["help_text"] for k in TASKS} == {None} and not any(rows[k]["auto_advance"] for k in TASKS)
    logic = {r["question_key"]: r["show_if"] for r in definitions.survey_logic(source).collect()}
    assert [(logic[k]["question"], logic[k]["op"], logic[k]["list"]) for k in TASKS] == [
        ("beds_kept", "array_contains", [json.dumps(row)]) for row in GARDEN["questions"]["tasks"]["rows"]
    ]


def test_option_sets(items):
    source = items(("g", json.dumps(GARDEN)))
    got = tuples(definitions.options(source).select("question_key", "sort_order", "option_value", "option_label", "is_catch_all"))
    beds = [("beds_kept", 0, "Herbs", None, False), ("beds_kept", 1, "No beds", None, True), ("beds_kept", 2, "Roses", None, False)]
    scale = [(k, n, str(n), name, False) for k in TASKS for n, name in enumerate(["Never", "Rarely", "Often"])]
    assert got == sorted([*beds, *scale, ("soil", 0, "Clay", None, False)], key=repr)
    logic = {r["question_key"]: r for r in definitions.survey_logic(source).collect()}
    assert [o["exclusive"] for o in logic["beds_kept"]["options"]] == [False, True, False]


def test_pages(items):
    source = items(("g", json.dumps(GARDEN)))
    pages = tuples(definitions.page_questions(source).select("page_no", "group_no", "pos", "question_key"))
    beds = [(0, 1, i, k) for i, k in enumerate(["beds_kept", *TASKS])]
    assert pages == [(0, 0, 0, "soil"), *beds, (2, 0, 0, "diary")]


def test_multi_matrix_and_repeated_rows(items):
    doc = {"questions": {"m": {"type": "matrix", "multi": True, "question": "Q", "rows": ["R", "r!"], "options": [{"value": "X"}]}}}
    rows = definitions.questions(items(("p", json.dumps(doc)))).collect()
    # both rows have one slug: the later one wins, as in a keyed map
    assert [(r["question_key"], r["question_type"], r["question_text"]) for r in rows] == [("m__r", "multi", "Q — r!")]


def test_defaults_labels_and_types(items):
    doc = {
        "version": 2,
        "questions": {
            "q": {"question": "", "min_select": 2, "options": [{"value": "A", "label": "A"}, {"value": "B", "label": "Bee"}, {"label": "L"}, "odd"]},
            "r": {"type": "rating", "required": "yes", "auto_advance": False},
        },
    }
    source = items(("p", json.dumps(doc)))
    rows = {r["question_key"]: r for r in definitions.questions(source).collect()}
    assert rows["q"]["question_type"] == "single" and rows["q"]["question_text"] is None and rows["q"]["min_select"] == 2
    assert rows["q"]["definition_version"] == 2 and rows["q"]["is_required"] is False
    assert rows["r"]["question_type"] == "rating" and rows["r"]["is_required"] is False and rows["r"]["auto_advance"] is False
    opts = tuples(definitions.options(source).select("sort_order", "option_value", "option_label"))
    assert opts == [(0, "A", None), (1, "B", "Bee"), (2, "", "L"), (3, "", None)]


def test_encoded_twice_broken_and_without_id(items):
    source = items(
        ("twice", json.dumps(json.dumps(GARDEN))),
        ("cut", json.dumps(GARDEN)[:50]),
        (None, json.dumps(GARDEN)),
        ("list", "[1]"),
    )
    assert {r["poll_id"] for r in definitions.questions(source).collect()} == {"twice"}
    assert tuples(definitions.rejects(source)) == [("cut", "definition"), ("list", "definition")]


def test_retired_layout(items):
    q1 = json.dumps({"id": "k", "prompt": "P?", "options": [{"value": "A", "label": "Ay", "is_catch_all": True}]})
    none = json.dumps({"id": "x", "prompt": "P?", "options": []})
    source = items(("old", None, q1, "{oops", none), ("new", json.dumps(GARDEN), q1))
    rows = [r for r in definitions.questions(source).collect() if r["poll_id"] == "old"]
    assert [(r["question_key"], r["question_type"], r["question_text"], r["is_required"], r["show_results"]) for r in rows] == [("k", "single", "P?", None, True)]
    opts = [r for r in definitions.options(source).collect() if r["poll_id"] == "old"]
    assert [(o["option_value"], o["option_label"], o["is_catch_all"]) for o in opts] == [("A", "Ay", False)]
    assert tuples(definitions.rejects(source)) == [("old", "2")]


def test_files(spark, tmp_path):
    (tmp_path / "items.json").write_text(json.dumps({"id": "p", "definition": json.dumps(GARDEN)}) + "\n")
    assert definitions.questions(definitions.read_items(spark, str(tmp_path / "items.json"))).count() == 6
    flat = [{"POLL_ID": "p", "QUESTION_KEY": "q", "QUESTION_TEXT": "", "OPTION_VALUE": "A", "OPTION_LABEL": "Ay"}]
    (tmp_path / "flat.json").write_text(json.dumps(flat))
    assert tuples(definitions.read_flat_catalog(spark, str(tmp_path / "flat.json"))) == [("p", "q", "", "A", "Ay")]


def test_documents_told_by_their_first_character(items):
    doc = json.dumps({"questions": {"q": {"options": [{"value": "a"}]}}})
    texts = [f" \n{doc}", f"\t{json.dumps(doc)} ", json.dumps(f" {doc}"), "{", "[]", "null", "5", '"', '"x"', json.dumps("[]"), json.dumps(json.dumps(doc)), '{"a": 1, "a": 2}']
    source = items(*[(f"d{i:02d}", text) for i, text in enumerate(texts)])
    assert tuples(definitions.questions(source).select("poll_id").orderBy("poll_id")) == [("d00",), ("d01",), ("d02",)]
    assert tuples(definitions.rejects(source).select("poll_id").orderBy("poll_id")) == [(f"d{i:02d}",) for i in range(3, 12)]


def test_options_that_are_no_list(items):
    sets = {"5": [{"value": "five"}], "one": {"value": "single"}}
    given = {"number": 5, "named": "5", "object": {"value": "a"}, "unlisted": "one", "unknown": "two", "nothing": None}
    source = items(("p", json.dumps({"option_sets": sets, "questions": {k: {"options": v} for k, v in given.items()}})))
    assert tuples(definitions.options(source).select("question_key", "option_value")) == [("named", "five")]
