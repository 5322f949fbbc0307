"""Explicit schemas; nothing is inferred from data."""

# A submission as it arrives. Elements of `answers` stay VARIANT, so an odd element never costs the whole list.
SUBMISSION = (
    "poll_id string, device_id string, external_id string, market_name string, variant string, "
    "submitted_at string, answers array<variant>, client_ip string"
)

# A survey definition. Maps keep the authoring order of their keys; values are read field by field.
DEFINITION = (
    "version variant, option_sets map<string,variant>, pages array<variant>, questions map<string,variant>"
)

QUESTIONS = (
    "poll_id string, question_key string, question_type string, question_text string, help_text string, "
    "is_required boolean, min_select bigint, max_length bigint, placeholder string, show_results boolean, "
    "auto_advance boolean, definition_version bigint"
)

OPTIONS = (
    "poll_id string, question_key string, option_value string, option_label string, option_description string, "
    "is_catch_all boolean, sort_order bigint"
)

OPTION_TABLE = (
    "option_id bigint, poll_id string, question_key string, option_value string, option_source string, "
    "option_label string, option_description string, is_catch_all boolean, sort_order bigint, updated_at timestamp_ntz"
)

TAXONOMY_TABLE = (
    "option_id bigint, bucket string, taxonomy_path string, taxonomy_depth bigint, taxonomy_levels array<string>, "
    "demographic_key string, demographic_value string, demographic_type string, confidence double, "
    "condition_sequence array<bigint>, classified_by string, is_approved boolean, updated_at timestamp_ntz"
)

TAXONOMY_ROWS = (
    "poll_id string, question_key string, option_value string, bucket string, taxonomy_path string, "
    "taxonomy_depth bigint, taxonomy_levels array<string>, demographic_key string, demographic_value string, "
    "demographic_type string, confidence double"
)

# A classifier's reply: one entry per answer option.
CLASSIFIED = (
    "array<struct<poll_id:string,question_key:string,option_value:string,taxonomies:array<struct<bucket:string,"
    "taxonomy_path:string,demographic_key:string,demographic_value:string,demographic_type:string,confidence:double>>>>"
)

FLAT_CATALOG = (
    "poll_id string, question_key string, question_text string, option_value string, option_label string"
)
