"""Nested survey definitions → questions, options, page layout and answer rules.

Item columns: `id`, `definition` (JSON text, possibly encoded twice) and, in the retired layout, "1" … "10" with one
JSON question each. Everything a definition expands to stays in its own row until the final explode: no join, no
shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from canvass.functions.text import blank_to_null, slug
from canvass.sources.responses import once
from canvass.sources.schemas import DEFINITION, FLAT_CATALOG

# Numbered columns of the retired layout.
LEGACY_COLUMNS = [str(i) for i in range(1, 11)]


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """Catalog items exported as JSON lines."""
    columns = ", ".join(f"`{c}` string" for c in ["id", "definition", *LEGACY_COLUMNS])
    return spark.read.schema(columns).json(path)


def read_flat_catalog(spark: SparkSession, path: str) -> DataFrame:
    """The retired one-row-per-option catalog, exported as one JSON array with upper-case keys."""
    names = [field.split()[0] for field in FLAT_CATALOG.split(", ")]
    return (
        spark.read.schema(FLAT_CATALOG.upper().replace("STRING", "string"))
        .option("multiLine", True)
        .json(path)
        .toDF(*names)
    )


def _text(value: Column, field: str) -> Column:
    return F.try_variant_get(value, f"$.{field}", "string")


def _given(value: Column, field: str) -> Column:
    """A text field, with '' taken as absent."""
    return blank_to_null(_text(value, field))


def _json(value: Column, field: str) -> Column:
    return F.to_json(F.variant_get(value, f"$.{field}", "variant"))


def _is_true(value: Column, field: str) -> Column:
    return F.coalesce(_json(value, field) == "true", F.lit(False))


def _truthy(value: Column, field: str) -> Column:
    return F.coalesce(~_json(value, field).isin("false", "null", "0", '""'), F.lit(False))


def _is_list(value: Column) -> Column:
    return F.coalesce(F.schema_of_variant(value).startswith("ARRAY"), F.lit(False))


def _list(*values: Column) -> Column:
    """The first JSON list of the values as array<variant>; without one, an empty one."""
    lists = [F.try_variant_get(v, "$", "array<variant>") for v in values]
    return F.coalesce(*lists, F.array().cast("array<variant>"))


def _options(owner: Column, sets: Column) -> Column:
    """A question's options, given in place or as the name of an option set."""
    given = F.variant_get(owner, "$.options", "variant")
    named = F.try_element_at(sets, F.try_variant_get(given, "$", "string"))
    return _list(given, F.when(F.schema_of_variant(given) == "STRING", named))


def parsed(items: DataFrame) -> DataFrame:
    """(poll_id, broken, doc) for every item with a definition; `broken` marks the ones that cannot be read."""
    given = items.where(blank_to_null(F.col("id")).isNotNull() & blank_to_null(F.col("definition")).isNotNull())
    as_json = given.select(
        F.col("id").alias("poll_id"),
        "definition",
        once(F.struct(F.try_parse_json("definition").alias("outer"))),
    )
    # what parses is told by its first character; the schema of a whole definition would be built for that
    twice = F.coalesce(F.col("outer").isNotNull() & F.col("definition").rlike(r'^[ \t\r\n]*"'), F.lit(False))
    inner = F.when(twice, F.variant_get("outer", "$", "string")).otherwise(F.col("definition"))
    parses = F.when(~twice, F.col("outer").isNotNull())
    whole = as_json.select("poll_id", once(F.struct(inner.alias("text"), parses.alias("parses"))))
    parses = F.coalesce("parses", F.try_parse_json("text").isNotNull())
    readable = F.coalesce(F.col("text").rlike(r"^[ \t\r\n]*\{") & parses, F.lit(False))
    return whole.select("poll_id", (~readable).alias("broken"), F.from_json("text", DEFINITION).alias("doc"))


def _predicate(rule: Column) -> Column:
    """A show-if rule; values are compared as JSON text, so '5' and 5 differ."""
    values = F.variant_get(rule, "$.values", "variant")
    return F.when(
        rule.isNotNull() & ~F.is_variant_null(rule),
        F.struct(
            _text(rule, "question").alias("question"),
            _text(rule, "op").alias("op"),
            F.to_json(values).alias("value"),
            F.when(_is_list(values), F.transform(_list(values), lambda v: F.to_json(v))).alias("list"),
        ),
    )


def _row_predicate(question: Column, row: Column) -> Column:
    quoted = F.to_json(row.cast("variant"))
    return F.struct(
        question.alias("question"),
        F.lit("array_contains").alias("op"),
        quoted.alias("value"),
        F.array(quoted).alias("list"),
    )


def _questions(items: DataFrame) -> DataFrame:
    """One row per question after expansion; of two rows with one key the later wins, as in a keyed map."""
    readable = parsed(items).where("NOT broken")
    q = F.col("q")
    read = (
        readable.select(
            "poll_id",
            F.coalesce("doc.option_sets", F.create_map().cast("map<string,variant>")).alias("sets"),
            F.try_variant_get(F.col("doc.version"), "$", "bigint").alias("definition_version"),
            F.posexplode("doc.questions").alias("pos", "key", "q"),
        )
        .select(
            "poll_id",
            "definition_version",
            "pos",
            "key",
            F.coalesce(_given(q, "type"), F.lit("single")).alias("type"),
            _text(q, "question").alias("text"),
            _given(q, "help_text").alias("help_text"),
            _is_true(q, "required").alias("is_required"),
            F.try_variant_get(q, "$.min_select", "bigint").alias("min_select"),
            F.try_variant_get(q, "$.max_length", "bigint").alias("max_length"),
            _given(q, "placeholder").alias("placeholder"),
            F.coalesce(_json(q, "show_results") != "false", F.lit(True)).alias("show_results"),
            F.try_variant_get(q, "$.auto_advance", "boolean").alias("auto_advance"),
            _truthy(q, "multi").alias("multi"),
            _text(q, "rows_from").alias("rows_from"),
            F.try_variant_get(q, "$.rows", "array<string>").alias("rows"),
            _text(q, "options_from").alias("options_from"),
            _predicate(F.variant_get(q, "$.show_if_answer", "variant")).alias("rule"),
            _options(q, F.col("sets")).alias("options"),
        )
    )
    matrix = F.col("type") == "matrix"
    # an ordinary question is one row without a matrix row; a matrix without rows is none
    own = F.array(F.lit(None).cast("string"))
    listed = read.withColumn("rows", F.when(matrix, F.coalesce("rows", F.array().cast("array<string>"))).otherwise(own))
    by_row = F.when(matrix & F.col("rows_from").isNotNull(), _row_predicate(F.col("rows_from"), F.col("matrix_row")))
    row_key = F.concat("key", F.lit("__"), slug(F.col("matrix_row")))
    row_type = F.when(F.col("multi"), "multi").otherwise("single")
    unless_matrix = lambda name: F.when(~matrix, F.col(name)).alias(name)
    rows = listed.select("*", F.posexplode("rows").alias("row_no", "matrix_row")).select(
        "poll_id",
        "pos",
        "row_no",
        "definition_version",
        F.when(matrix, row_key).otherwise(F.col("key")).alias("question_key"),
        F.when(matrix, row_type).otherwise(F.col("type")).alias("question_type"),
        F.when(matrix, F.concat("text", F.lit(" — "), "matrix_row"))
        .otherwise(blank_to_null(F.col("text")))
        .alias("question_text"),
        unless_matrix("help_text"),
        "is_required",
        "min_select",
        unless_matrix("max_length"),
        unless_matrix("placeholder"),
        "show_results",
        F.when(matrix, F.lit(False)).otherwise(F.col("auto_advance")).alias("auto_advance"),
        "options",
        "options_from",
        F.coalesce(by_row, "rule").alias("show_if"),
    )
    rest = F.struct(*[c for c in rows.columns if c not in ("poll_id", "pos", "row_no", "question_key")])
    latest = rows.groupBy("poll_id", "question_key").agg(F.max_by(rest, F.struct("pos", "row_no")).alias("last"))
    return latest.select("poll_id", "question_key", "last.*")


def _option_rows(questions: DataFrame) -> DataFrame:
    value = F.coalesce(_text(F.col("o"), "value"), F.lit(""))
    label = _given(F.col("o"), "label")
    listed = questions.select("poll_id", "question_key", "described", F.posexplode("options").alias("sort_order", "o"))
    return listed.select(
        "poll_id",
        "question_key",
        value.alias("option_value"),
        F.when(label != value, label).alias("option_label"),
        F.when(F.col("described"), _given(F.col("o"), "description")).alias("option_description"),
        (F.col("described") & _is_true(F.col("o"), "is_catch_all")).alias("is_catch_all"),
        F.col("sort_order").cast("long").alias("sort_order"),
    )


def _legacy(items: DataFrame) -> DataFrame:
    """Questions of items in the retired layout; a column without a key or options is no question."""
    present = [c for c in LEGACY_COLUMNS if c in items.columns]
    if not present:
        return None
    listed = F.array(*[F.struct(F.lit(int(c)).alias("no"), F.col(f"`{c}`").alias("text")) for c in present])
    cells = (
        items.where(blank_to_null(F.col("id")).isNotNull() & blank_to_null(F.col("definition")).isNull())
        .select(F.col("id").alias("poll_id"), F.explode(listed).alias("c"))
        .select("poll_id", "c.no", F.col("c.text").alias("text"), F.try_parse_json("c.text").alias("q"))
        .where(blank_to_null(F.col("text")).isNotNull())
    )
    q = F.col("q")
    return cells.select(
        "poll_id",
        "no",
        "text",
        q.isNull().alias("broken"),
        F.coalesce(_given(q, "id"), _given(q, "question_key")).alias("question_key"),
        F.coalesce(_given(q, "prompt"), _given(q, "question")).alias("question_text"),
        _list(F.variant_get(q, "$.options", "variant")).alias("options"),
    )


def _legacy_questions(items: DataFrame) -> DataFrame | None:
    cells = _legacy(items)
    if cells is None:
        return None
    return cells.where("NOT broken AND question_key IS NOT NULL AND size(options) > 0")


def expanded(items: DataFrame) -> DataFrame:
    """Questions of both layouts with their options, which only a definition describes. A job that needs questions and
    options writes this once, so that no definition is read for each of them."""
    rows = _questions(items).drop("options_from", "show_if").withColumn("described", F.lit(True))
    old = _legacy_questions(items)
    if old is None:
        return rows
    absent = F.lit(None)
    return rows.unionByName(
        old.select(
            "poll_id",
            absent.cast("bigint").alias("definition_version"),
            "question_key",
            F.lit("single").alias("question_type"),
            "question_text",
            absent.cast("string").alias("help_text"),
            absent.cast("boolean").alias("is_required"),
            absent.cast("bigint").alias("min_select"),
            absent.cast("bigint").alias("max_length"),
            absent.cast("string").alias("placeholder"),
            F.lit(True).alias("show_results"),
            absent.cast("boolean").alias("auto_advance"),
            "options",
            F.lit(False).alias("described"),
        )
    )


def expanded_questions(rows: DataFrame) -> DataFrame:
    return rows.drop("options", "described")


def expanded_options(rows: DataFrame) -> DataFrame:
    """Options of all but text questions; their place in the list is the sort order, a label equal to the value NULL."""
    return _option_rows(rows.where("question_type <> 'text'"))


def questions(items: DataFrame) -> DataFrame:
    return expanded_questions(expanded(items))


def options(items: DataFrame) -> DataFrame:
    return expanded_options(expanded(items))


def rejects(items: DataFrame) -> DataFrame:
    """Definitions and retired-layout columns that could not be read; the other items still load."""
    bad = parsed(items).where("broken").select("poll_id", F.lit("definition").alias("field"))
    old = _legacy(items)
    if old is None:
        return bad
    return bad.union(old.where("broken").select("poll_id", F.col("no").cast("string").alias("field")))


def page_questions(items: DataFrame) -> DataFrame:
    """(poll, page_no, group_no, pos, question_key) after matrix expansion, with the page's id and rule."""
    readable = parsed(items).where("NOT broken")
    known = F.coalesce("doc.questions", F.create_map().cast("map<string,variant>"))

    def keys_of(name: Column) -> Column:
        q = F.try_element_at(F.col("known"), name)
        rows = F.coalesce(F.try_variant_get(q, "$.rows", "array<string>"), F.array().cast("array<string>"))
        # an empty matrix keeps an empty list, an ordinary question its own key
        return F.when(
            F.coalesce(_text(q, "type") == "matrix", F.lit(False)),
            F.transform(rows, lambda row: F.concat(name, F.lit("__"), slug(row))),
        ).otherwise(F.array(name))

    pages = readable.select("poll_id", known.alias("known"), F.posexplode("doc.pages").alias("page_no", "page"))
    described = pages.select(
        "poll_id",
        "known",
        "page_no",
        _text(F.col("page"), "page_id").alias("page_id"),
        _predicate(F.variant_get("page", "$.show_if_answer", "variant")).alias("page_show_if"),
        _list(F.variant_get("page", "$.groups", "variant")).alias("groups"),
    )
    groups = described.select("*", F.posexplode("groups").alias("group_no", "grp"))
    listed = F.coalesce(
        F.try_variant_get("grp", "$.questions", "array<string>"), F.array().cast("array<string>")
    )
    return groups.select(
        "poll_id",
        "page_no",
        "page_id",
        "page_show_if",
        "group_no",
        F.posexplode(F.flatten(F.transform(listed, keys_of))).alias("pos", "question_key"),
    )


def survey_logic(items: DataFrame) -> DataFrame:
    """One row per poll and question: its page with the page's rule, its own rule, and its options' flags."""
    option = lambda o: F.struct(
        F.coalesce(_text(o, "value"), F.lit("")).alias("value"),
        _truthy(o, "is_catch_all").alias("is_catch_all"),
        _truthy(o, "exclusive").alias("exclusive"),
        _truthy(o, "write_in").alias("write_in"),
    )
    first_page = F.min_by(F.struct("page_no", "page_show_if"), F.struct("page_no", "group_no", "pos"))
    place = page_questions(items).groupBy("poll_id", "question_key").agg(first_page.alias("page"))
    return (
        _questions(items)
        .join(place, ["poll_id", "question_key"], "left")
        .select(
            "poll_id",
            "question_key",
            "question_type",
            "is_required",
            "min_select",
            "options_from",
            "show_if",
            "page.page_no",
            "page.page_show_if",
            F.transform("options", option).alias("options"),
        )
    )
