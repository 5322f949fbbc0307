import json

import pytest
from helpers import tuples

from canvass.operators import rules
from canvass.sources import definitions



def choice(*values, **flags):
    """Options by value; a flag names the values it is set for."""
    return [{"value": v, **{k: True for k, on in flags.items() if v in on}} for v in values]


def one_page(*keys):
    return {"groups": [{"questions": list(keys)}]}


@pytest.fixture
def logic(spark):
    """Logic of definitions given as poll=(pages, questions)."""

    def build(**polls):
        rows = [(k, json.dumps({"pages": pages, "questions": questions})) for k, (pages, questions) in polls.items()]
        return definitions.survey_logic(spark.createDataFrame(rows, "id string, definition string"))

    return build


def test_answers_on_hidden_pages(submit, logic):
    """The second page needs a ticket; a question that is on no page is never on show."""
    ticket = {"question": "ticket", "op": "in", "values": ["day", "week"]}
    pages = [one_page("ticket"), {**one_page("seat", "meal"), "show_if_answer": ticket}]
    questions = {k: {"type": "single"} for k in ("ticket", "seat", "meal", "spare")}
    rows = submit(
        {"poll_id": "train", "answers": [("ticket", "week"), ("seat", "7b")]},
        {"poll_id": "train", "answers": [("ticket", "none"), ("seat", "7b"), ("meal", None)]},
        {"poll_id": "train", "answers": [("meal", "soup"), ("spare", "1"), ("luggage", "2")]},
        {"poll_id": "bus", "answers": [("seat", "1a")]},
    )
    assert tuples(rules.hidden_answers(rows, logic(train=(pages, questions)))) == [
        (2, "train", "seat", "page hidden"),
        (3, "train", "luggage", "unknown question"),
        (3, "train", "meal", "page hidden"),
        (3, "train", "spare", "page hidden"),
    ]


def test_answers_to_hidden_questions(submit, logic):
    """Rules of single questions, one after the other; a rule on the respondent's attributes always holds here."""
    questions = {
        "pet": {"type": "multi"},
        "breed": {"type": "text", "show_if_answer": {"question": "pet", "op": "array_contains", "values": ["dog"]}},
        "walks": {"type": "rating", "show_if_answer": {"question": "breed", "op": "is_set"}},
    }
    page = {**one_page("pet", "breed", "walks"), "show_if_user": {"property": "plan", "op": "equals", "values": "x"}}
    rows = submit(
        {"poll_id": "pets", "answers": [("pet", ["cat", "dog"]), ("breed", "boxer"), ("walks", 3)]},
        {"poll_id": "pets", "answers": [("pet", ["cat"]), ("breed", "boxer"), ("walks", 3)]},
        {"poll_id": "pets", "answers": [("pet", ["dog"]), ("breed", ""), ("walks", 1)]},
    )
    assert tuples(rules.hidden_answers(rows, logic(pets=([page], questions)))) == [
        (2, "pets", "breed", "question hidden"),
        (3, "pets", "walks", "question hidden"),
    ]


OPERATORS = [
    ({"op": "equals", "values": "5"}, "5", True),
    ({"op": "equals", "values": 5}, "5", False),
    ({"op": "equals", "values": ["A"]}, ["A"], False),
    ({"op": "in", "values": ["A", "B"]}, "B", True),
    ({"op": "in", "values": ["A"]}, ["A"], False),
    ({"op": "in", "values": "A"}, "A", False),
    ({"op": "in", "values": ["A"]}, None, False),
    ({"op": "not_in", "values": ["A"]}, None, True),
    ({"op": "not_in", "values": "A"}, "B", False),
    ({"op": "not_in", "values": ["A"]}, "A", False),
    ({"op": "is_set"}, "", False),
    ({"op": "is_set"}, 0, True),
    ({"op": "is_set"}, None, False),
    ({"op": "array_contains", "values": ["A", "C"]}, ["B", "C"], True),
    ({"op": "array_contains", "values": ["A"]}, "A", False),
    ({"op": "array_contains", "values": ["A"]}, ["B"], False),
    ({"op": "unheard_of", "values": ["A"]}, "B", True),
]


def test_operators(spark, submit):
    """One poll per operator and answer: question b is on show if the rule on answer a holds."""
    surveys, docs = [], []
    for i, (rule, answer, _) in enumerate(OPERATORS):
        survey = {
            "pages": [{"groups": [{"questions": ["a", "b"]}]}],
            "questions": {"a": {"type": "single"}, "b": {"type": "single", "show_if_answer": {"question": "a", **rule}}},
        }
        surveys.append((f"p{i}", json.dumps(survey)))
        docs.append({"poll_id": f"p{i}", "answers": [("a", answer), ("b", "x")]})
    table = definitions.survey_logic(spark.createDataFrame(surveys, "id string, definition string"))
    hidden = {r["poll_id"] for r in rules.hidden_answers(submit(*docs), table).collect()}
    assert hidden == {f"p{i}" for i, (_, _, want) in enumerate(OPERATORS) if not want}


def test_required_single_and_text(submit, logic):
    questions = {"size": {"type": "single", "required": True}, "name": {"type": "text", "required": True}, "tip": {"type": "single"}}
    rows = submit(
        {"poll_id": "shop", "answers": [("size", 0), ("name", "Ada")]},
        {"poll_id": "shop", "answers": [("size", ""), ("name", "Ada"), ("tip", "")]},
        {"poll_id": "shop", "answers": []},
    )
    assert tuples(rules.incomplete_required(rows, logic(shop=([one_page(*questions)], questions)))) == [
        (2, "shop", "size", "missing"),
        (3, "shop", "name", "missing"),
        (3, "shop", "size", "missing"),
    ]


def test_required_lists(submit, logic):
    """Three of the days, or the catch-all alone."""
    days = {"type": "multi", "required": True, "min_select": 3, "options": choice("mon", "tue", "wed", "thu", "never", is_catch_all=["never"])}
    rows = submit(*[{"poll_id": "gym", "answers": [("days", v)]} for v in (["mon", "tue", "thu"], ["mon", "tue"], ["never"], [], "mon")])
    assert tuples(rules.incomplete_required(rows, logic(gym=([one_page("days")], {"days": days})))) == [
        (2, "gym", "days", "too few"),
        (4, "gym", "days", "missing"),
        (5, "gym", "days", "missing"),
    ]


def test_required_on_show_only(submit, logic):
    questions = {
        "car": {"type": "single"},
        "plate": {"type": "text", "required": True, "show_if_answer": {"question": "car", "op": "not_in", "values": ["no"]}},
    }
    rows = submit({"poll_id": "lot", "answers": [("car", "no")]}, {"poll_id": "lot", "answers": [("car", "yes")]})
    assert tuples(rules.incomplete_required(rows, logic(lot=([one_page(*questions)], questions)))) == [(2, "lot", "plate", "missing")]


def test_write_in_choice_without_text(submit, logic):
    """A single answer keeps the choice's own value then; a list only says that the choice was taken."""
    options = choice("tea", "juice", "else", write_in=["else"])
    questions = {"one": {"type": "single", "required": True, "options": options}, "many": {"type": "multi", "required": True, "options": options}}
    given = [("mate", ["tea", "mate"]), ("else", ["tea"]), ("tea", ["juice", "else"])]
    rows = submit(*[
        {"poll_id": "bar", "answers": [{"question": "one", "answer": a, "write_in": a != "tea"}, {"question": "many", "answer": b, "write_in": True}]}
        for a, b in given
    ])
    assert tuples(rules.incomplete_required(rows, logic(bar=([one_page(*questions)], questions)))) == [
        (2, "bar", "many", "blank write-in"),
        (2, "bar", "one", "blank write-in"),
        (3, "bar", "many", "blank write-in"),
    ]


def test_carried_lists(submit, logic):
    """The favourite is asked among the tools that were named; what a write-in adds is free."""
    questions = {
        "tools": {"type": "multi", "options": choice("saw", "axe", "file")},
        "best": {"type": "multi", "options_from": "tools", "options": choice("saw", "axe", "file", "all", is_catch_all=["all"])},
    }
    rows = submit(
        {"poll_id": "shed", "answers": [("tools", ["saw", "axe"]), ("best", ["axe", "all"])]},
        {"poll_id": "shed", "answers": [("tools", ["saw"]), ("best", ["file", "saw", "axe"])]},
        {"poll_id": "shed", "answers": [("best", ["all"])]},
        {"poll_id": "shed", "answers": [("tools", ["axe"]), {"question": "best", "answer": ["lathe", "saw"], "write_in": True}]},
    )
    assert tuples(rules.not_offered_options(rows, logic(shed=([one_page(*questions)], questions)))) == [
        (2, "shed", "best", "axe"),
        (2, "shed", "best", "file"),
        (4, "shed", "best", "saw"),
    ]


def test_exclusive_choices(submit, logic):
    allergy = {"type": "multi", "options": choice("nuts", "milk", "none", "unsure", exclusive=["none", "unsure"])}
    rows = submit(*[{"poll_id": "diet", "answers": [("allergy", v)]} for v in (["none"], ["nuts", "none", "unsure"], ["nuts", "milk"], ["milk", "unsure"])])
    assert tuples(rules.exclusive_conflicts(rows, logic(diet=([one_page("allergy")], {"allergy": allergy})))) == [
        (2, "diet", "allergy", "none, unsure", 3),
        (4, "diet", "allergy", "unsure", 2),
    ]


def test_write_ins(submit, options):
    opts = options((1, "q", "Other"), (2, "m", "A"))
    rows = submit(
        {"answers": [{"question": "q", "answer": "mine", "write_in": True}]},
        {"answers": [{"question": "q", "answer": "Other", "write_in": True}]},
        {"answers": [{"question": "m", "answer": ["A", "typed"], "write_in": True}]},
        {"answers": [("q", "plain")]},
    )
    assert tuples(rules.write_ins(rows, opts)) == [(1, "p", "q", "mine"), (3, "p", "m", "typed")]


def test_open_polls(spark):
    respondents = spark.createDataFrame([("r", '["a_segment-x", "b"]'), ("s", None)], "respondent_id string, completed string")
    tokens = spark.createDataFrame([("r", "f", "on"), ("s", "f", "off"), ("s", "g", "on-x"), ("s", "g", "on-x")], "respondent_id string, flag string, token string")
    polls = spark.createDataFrame([("a", "f"), ("a_segment-y", "f"), ("b", "f"), ("c", "f"), ("c", "g")], "poll_id string, flag string")
    assert tuples(rules.open_polls(respondents, tokens, polls)) == [("r", "c"), ("s", "c")]


def test_funnel(spark):
    clicks = spark.createDataFrame(
        [("p", r, b) for r, b in [("x", "Q1"), ("x", "Q1"), ("y", "Q1"), ("x", "Q10"), ("x", "Q2"), ("x", "Submit"), ("x", "Close")]],
        "poll_id string, respondent_id string, button string",
    )
    got = [(r["button"], r["respondents"]) for r in rules.page_funnel(clicks).orderBy("poll_id", "step").collect()]
    assert got == [("Q1", 2), ("Q2", 1), ("Q10", 1), ("Submit", 1)]
