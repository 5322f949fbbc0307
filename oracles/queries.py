"""Query name → SQL."""

from oracles.base import BASE

_B = {}

_B["answer_rows"] = "SELECT ingestion_id, poll_id, CAST(pos AS INTEGER) AS pos, question_key, kind, type, write_in FROM ans"
_B["answer_elements"] = "SELECT ingestion_id, poll_id, question_key, CAST(pos AS INTEGER) AS pos, kind, v AS answer_value FROM el"
_B["staged_responses"] = """SELECT ingestion_id, poll_id, submitted_at, device_id, external_id, market_name, CAST(5 AS BIGINT) AS answers FROM sub"""
_B["answer_options"] = "SELECT ingestion_id, device_id, CAST(pos AS INTEGER) AS pos, option_id FROM ao"
_B["unconditional_taxonomy"] = "SELECT * FROM unc"
_B["conditional_taxonomy"] = "SELECT * FROM con"
_B["conditional_taxonomy_strict"] = """SELECT c.ingestion_id, c.device_id, c.bucket, c.taxonomy_path, c.demographic_key, c.demographic_value FROM con c
 JOIN sub s ON s.ingestion_id = c.ingestion_id
 WHERE (c.taxonomy_path = 'Returns|A|After F' AND s.k % 3 <> 0) OR (c.taxonomy_path = 'Returns|A|After F then N' AND false)"""
_B["profile_sync"] = "SELECT * FROM prof"
_B["profile_sync_approved"] = """, app AS (
 SELECT ao.device_id, t.bucket, t.taxonomy_path, t.demographic_key, t.demographic_value FROM ao JOIN tax t USING (option_id) WHERE NOT ao.is_catch_all AND t.needs IS NULL AND t.is_approved
 UNION ALL SELECT c.device_id, c.bucket, c.taxonomy_path, c.demographic_key, c.demographic_value FROM con c JOIN sub s USING (ingestion_id) WHERE s.poll_id = 'poll_1')
SELECT device_id, bucket || '_insights' AS user_property, CAST(to_json(list_sort(list(DISTINCT taxonomy_path))) AS VARCHAR) AS user_property_value FROM app WHERE bucket <> 'demographic' GROUP BY device_id, bucket
UNION ALL SELECT DISTINCT device_id, demographic_key, demographic_value FROM app WHERE bucket = 'demographic'"""
_B["profile_summary"] = "SELECT user_property, count(*) AS row_cnt, count(DISTINCT device_id) AS devices FROM prof GROUP BY user_property"
_B["device_attributes"] = """SELECT DISTINCT e.device_id, t.bucket, coalesce(t.taxonomy_path, t.demographic_key || ' = ' || t.demographic_value) AS profile_attribute
 FROM el e JOIN opt o ON o.poll_id = e.poll_id AND o.question_key = e.question_key AND o.option_value = e.v AND o.option_source = 'catalog' JOIN tax t USING (option_id) WHERE e.kind = 'string'"""

_HASH = "CAST('0x' || substr(md5({}), 1, 7) AS INTEGER)"
_PCT = "CAST(floor((n * 2000 + total) / (2 * total)) AS DOUBLE) / 10"
_B["response_tally"] = f"SELECT poll_id, total AS total_responses, question, answer, n AS response_count, {_PCT} AS pct FROM tal"
_B["tally_documents"] = f""", dealt AS (SELECT *, CAST((row_number() OVER (PARTITION BY poll_id, question ORDER BY {_HASH.format("answer")} % 4096, answer) - 1) // 10 AS INTEGER) AS part FROM tal)
SELECT poll_id, total AS total_responses, question, part,
 '[' || string_agg('{{"answer":' || CAST(to_json(answer) AS VARCHAR) || ',"count":' || n || ',"pct":' || CAST({_PCT} AS VARCHAR) || '}}', ',' ORDER BY n DESC, answer) || ']' AS answers
 FROM dealt GROUP BY ALL"""
_B["report_tally"] = "SELECT poll_id, total AS total_responses, question_key, question, CAST(q_order AS INTEGER) AS question_order, answer, n AS response_count FROM tal"
_PAIRS = """, a AS (SELECT * FROM el WHERE kind = 'string'),
 pairs AS (SELECT a1.poll_id, a1.question_key AS q1_key, a1.v AS q1_option, a2.question_key AS q2_key, a2.v AS q2_option, count(*) AS co_count
  FROM a a1 JOIN a a2 ON a2.ingestion_id = a1.ingestion_id AND a2.pos > a1.pos AND a2.question_key <> a1.question_key GROUP BY ALL),
 best AS (SELECT *, row_number() OVER (PARTITION BY poll_id ORDER BY co_count DESC, q1_key, q1_option, q2_key, q2_option) AS rn FROM pairs)
SELECT b.poll_id, q1_key, o1.option_id AS q1_option_id, q1_option, q2_key, o2.option_id AS q2_option_id, q2_option, co_count FROM best b
 LEFT JOIN opt o1 ON o1.poll_id = b.poll_id AND o1.question_key = q1_key AND o1.option_value = q1_option AND o1.option_source = 'catalog'
 LEFT JOIN opt o2 ON o2.poll_id = b.poll_id AND o2.question_key = q2_key AND o2.option_value = q2_option AND o2.option_source = 'catalog'"""
_B["answer_pairs"] = _PAIRS
_B["answer_patterns"] = f"{_PAIRS} WHERE rn <= 50"

_B["survey_catalog"] = """SELECT q.poll_id, q.question_key, q.question_type, q.question_text, o.option_id, o.option_value, o.option_label, o.option_description, o.is_catch_all, o.sort_order
 FROM que q JOIN opt o ON o.poll_id = q.poll_id AND o.question_key = q.question_key WHERE o.option_source = 'catalog'"""
_B["catalog_documents"] = """, c AS (SELECT q.poll_id, q.question_key, q.question_text, o.option_value, o.option_label, o.is_catch_all, o.sort_order FROM que q JOIN opt o USING (poll_id, question_key) WHERE o.option_source = 'catalog')
SELECT poll_id, count(*) AS total_rows, '[' || string_agg('{"question_key":' || CAST(to_json(question_key) AS VARCHAR) || coalesce(',"question_text":' || CAST(to_json(question_text) AS VARCHAR), '') || ',"option_value":' || CAST(to_json(option_value) AS VARCHAR)
 || coalesce(',"option_label":' || CAST(to_json(option_label) AS VARCHAR), '') || ',"is_catch_all":' || CAST(is_catch_all AS VARCHAR) || '}', ',' ORDER BY question_key, sort_order, option_value) || ']' AS options FROM c GROUP BY poll_id"""
_TAXROW = """SELECT o.poll_id, o.question_key, o.option_value, o.option_source, t.bucket, t.taxonomy_path, t.taxonomy_depth, CASE WHEN t.taxonomy_path IS NOT NULL THEN CAST(to_json(string_split(t.taxonomy_path,'|')) AS VARCHAR) END AS taxonomy_levels,
 t.demographic_key, t.demographic_value, t.demographic_type, t.confidence, t.is_approved, t.updated_at FROM tax t JOIN opt o USING (option_id)"""
_B["taxonomy_rows"] = _TAXROW
_B["taxonomy_filtered"] = "SELECT o.poll_id, o.option_value, t.taxonomy_path, t.confidence FROM tax t JOIN opt o USING (option_id) WHERE t.bucket = 'consumption' AND t.confidence >= 0.8 AND o.option_source = 'catalog' AND t.taxonomy_path LIKE 'Returns|%'"
_B["taxonomy_counts"] = "SELECT demographic_key, demographic_value, demographic_type, count(*) AS options FROM tax WHERE bucket = 'demographic' GROUP BY ALL"
_TEXT = "SELECT o.option_id, o.poll_id, o.question_key, o.option_value, q.question_text, q.question_type FROM opt o JOIN que q USING (poll_id, question_key) WHERE o.option_source = 'response'"
_B["text_answers"] = f"{_TEXT}"
_B["unclassified_text"] = f"{_TEXT} AND NOT EXISTS (SELECT 1 FROM tax t WHERE t.option_id = o.option_id)"
_B["text_option_candidates"] = "SELECT DISTINCT e.poll_id, e.question_key, lower(trim(e.v)) AS option_value, 'response' AS option_source FROM el e JOIN que q USING (poll_id, question_key) WHERE e.kind = 'string' AND trim(e.v) <> '' AND q.question_type = 'text'"
_VIEW = "SELECT q.poll_id, q.question_key, q.question_text, o.option_value, o.option_label, o.is_catch_all, o.updated_at FROM que q JOIN opt o USING (poll_id, question_key) WHERE o.option_source = 'catalog'"
_B["catalog_view"] = _VIEW
_B["flat_catalog_rows"] = f"SELECT poll_id, question_key, question_text, option_value, option_label FROM ({_VIEW})"
_B["seeded_questions"] = f"SELECT poll_id, question_key, max(question_text) AS question_text, 'single' AS question_type FROM ({_VIEW}) GROUP BY poll_id, question_key"
_B["seeded_options"] = f"SELECT poll_id, question_key, option_value, 'catalog' AS option_source, option_label, is_catch_all FROM ({_VIEW})"
_B["unclassified_polls"] = """SELECT DISTINCT o.poll_id FROM opt o JOIN que q USING (poll_id, question_key) WHERE o.option_source = 'catalog' AND o.is_catch_all = false AND q.question_type IN ('single','multi')
 AND NOT EXISTS (SELECT 1 FROM tax tx JOIN opt o2 ON o2.option_id = tx.option_id WHERE o2.poll_id = o.poll_id)"""
_B["unclassified_options"] = """, done AS MATERIALIZED (SELECT DISTINCT option_id FROM tax)
SELECT option_id, poll_id, question_key, option_value FROM opt WHERE option_source = 'catalog' AND NOT EXISTS (SELECT 1 FROM done WHERE done.option_id = opt.option_id)"""
_B["classification_status"] = """SELECT p.poll_id, (SELECT count(*) FROM tax t JOIN opt o USING (option_id) WHERE o.poll_id = p.poll_id) AS already_classified,
 (SELECT count(*) FROM que q WHERE q.poll_id = p.poll_id AND q.question_type IN ('single','multi')) AS classifiable_cnt,
 (SELECT count(*) FROM tax t JOIN opt o USING (option_id) WHERE o.poll_id = p.poll_id) = 0 AS proceed FROM (SELECT DISTINCT poll_id FROM que) p"""
_B["options_to_classify"] = "SELECT o.poll_id, o.question_key, q.question_text, o.option_value, o.option_label, o.is_catch_all, o.sort_order FROM opt o JOIN que q USING (poll_id, question_key) WHERE o.option_source = 'catalog' AND q.question_type IN ('single','multi')"
_B["existing_taxonomies"] = "SELECT DISTINCT bucket, taxonomy_path, demographic_key FROM tax"

_B["taxonomy_reference"] = "SELECT DISTINCT bucket AS section, CASE WHEN bucket = 'demographic' THEN demographic_key ELSE taxonomy_path END AS line FROM tax"
_BODY = "string_agg('[' || question_key || '] ' || coalesce('\"' || qt || '\"', '(question without text)') || chr(10) || body, '' ORDER BY question_key)"
_B["option_prompts"] = f""", ln AS (SELECT o.poll_id, o.question_key, max(q.question_text) AS qt, string_agg('* ' || o.option_value || CASE WHEN o.option_label IS NOT NULL THEN ' = ' || o.option_label ELSE '' END || CASE WHEN o.is_catch_all THEN ' (any other)' ELSE '' END || chr(10), '' ORDER BY o.sort_order, o.option_value) AS body
  FROM opt o JOIN que q USING (poll_id, question_key) WHERE o.option_source = 'catalog' AND q.question_type IN ('single','multi') GROUP BY o.poll_id, o.question_key)
SELECT poll_id, 'Assign taxonomy entries to each option below.' || chr(10) || chr(10) || 'Poll ' || poll_id || chr(10) || {_BODY} AS user_message FROM ln GROUP BY poll_id"""
_B["text_prompts"] = f""", r AS ({_TEXT} AND o.option_id NOT IN (SELECT option_id FROM tax)),
 n AS (SELECT poll_id, CAST(ceil(count(*) / 20) AS INTEGER) AS batches FROM r GROUP BY poll_id),
 ln AS (SELECT poll_id, {_HASH.format("option_value")} % batches AS batch, question_key, max(question_text) AS qt, string_agg('* ' || option_value || chr(10), '' ORDER BY option_value) AS body FROM r JOIN n USING (poll_id) GROUP BY ALL)
SELECT poll_id, batch, 'Assign taxonomy entries to each typed answer below, as if respondents had picked it from a list.' || chr(10) || chr(10) || 'Poll ' || poll_id || chr(10) || {_BODY} AS user_message FROM ln GROUP BY poll_id, batch"""

# Replies: what each part's reply says, without its wrapping.
_REPLY = """, rp AS (SELECT p_partkey AS k, 'poll_' || (p_partkey % 5 + 1) AS poll_id, 'channel' AS question_key, ['Web','Store','Phone'][p_partkey % 3 + 1] AS option_value, p_brand, p_type, p_size FROM part WHERE p_partkey % 10 <> 9),
 cr AS (
 SELECT poll_id, question_key, option_value, 'preference' AS bucket, 'Parts|' || p_brand || '|' || p_type AS taxonomy_path, CAST(3 AS BIGINT) AS taxonomy_depth, CAST(to_json(['Parts', p_brand, p_type]) AS VARCHAR) AS taxonomy_levels, NULL::VARCHAR AS demographic_key, NULL::VARCHAR AS demographic_value, NULL::VARCHAR AS demographic_type, CAST(0.5 AS DOUBLE) AS confidence FROM rp WHERE k % 4 = 1
 UNION ALL SELECT poll_id, question_key, option_value, 'demographic', NULL, NULL, NULL, 'size', CAST(p_size AS VARCHAR), 'NUMBER', 0.5 FROM rp WHERE k % 4 = 2
 UNION ALL SELECT poll_id, question_key, option_value, 'consumption', 'Brands|' || p_brand, 2, CAST(to_json(['Brands', p_brand]) AS VARCHAR), NULL, NULL, NULL, 0.5 FROM rp WHERE k % 4 = 3)"""
_B["classification_rows"] = _REPLY + "SELECT * FROM cr"
_B["classification_summary"] = _REPLY + "SELECT bucket, count(*) AS row_cnt FROM cr GROUP BY bucket UNION ALL SELECT '(skipped)', count(*) FROM rp WHERE k % 4 = 0"
_B["rekeyed_taxonomy"] = _REPLY + "SELECT o.option_id, c.bucket, c.taxonomy_path, c.demographic_key, c.demographic_value, c.confidence FROM cr c JOIN opt o USING (poll_id, question_key, option_value)"
_B["rejected_replies"] = """SELECT 'Sorry: [{"poll_id":"poll_' || (p_partkey % 5 + 1) || '","question_key":"channel","option_value":"' || ['Web','Store','Phone'][p_partkey % 3 + 1] || '","taxonomies":['
 || CASE p_partkey % 4 WHEN 1 THEN '{"bucket":"preference","taxonomy_path":"Parts|' || p_brand || '|' || p_type || '","confidence":0.5}' WHEN 3 THEN '{"bucket":"consumption","taxonomy_path":"Brands|' || p_brand || '","confidence":0.5},{"bucket":"demographic","taxonomy_path":"Lost|Path","confidence":0.5}' ELSE '' END || ']}]' AS reply FROM part WHERE p_partkey % 10 = 9"""
_B["taxonomy_rule"] = """SELECT option_id, 'preference' AS bucket, 'Orders|Returned' AS taxonomy_path, CAST(2 AS BIGINT) AS taxonomy_depth, '["Orders","Returned"]' AS taxonomy_levels, CAST(0.8 AS DOUBLE) AS confidence, '[410001]' AS condition_sequence
 FROM opt WHERE poll_id = 'poll_4' AND question_key = 'flags' AND option_value = 'A' AND option_source = 'catalog'"""

# Catalog items, one per part.
_ITEM = """, it AS (SELECT 'survey_' || p_partkey AS poll_id, p_partkey AS k, p_brand, p_type, p_name, p_size, p_partkey % 10 = 7 AS old FROM part WHERE p_partkey % 10 <> 8),
 wd AS (SELECT poll_id, p_size, w, i FROM (SELECT poll_id, p_size, old, unnest(string_split(p_name,' ')) AS w, generate_subscripts(string_split(p_name,' '), 1) AS i FROM it) WHERE NOT old)"""
_B["catalog_questions"] = _ITEM + """SELECT poll_id, CAST(p_size AS BIGINT) AS definition_version, 'kind' AS question_key, 'multi' AS question_type, 'Which ' || p_type || '?' AS question_text, NULL::VARCHAR AS help_text, true AS is_required, CAST(2 AS BIGINT) AS min_select, NULL::BIGINT AS max_length, NULL::VARCHAR AS placeholder, true AS show_results, NULL::BOOLEAN AS auto_advance FROM it WHERE NOT old
 UNION ALL SELECT poll_id, p_size, 'opinion__' || w, 'single', 'Opinion — ' || w, NULL, p_size % 2 = 0, NULL, NULL, NULL, p_size % 3 <> 0, false FROM wd
 UNION ALL SELECT poll_id, p_size, 'why', 'text', 'Why?', NULL, false, NULL, p_size, 'about ' || p_name, true, false FROM it WHERE NOT old
 UNION ALL SELECT poll_id, NULL, 'q1', 'single', 'Pick ' || p_brand, NULL, NULL, NULL, NULL, NULL, true, NULL FROM it WHERE old"""
_B["catalog_options"] = _ITEM + """SELECT poll_id, 'kind' AS question_key, p_brand AS option_value, NULL::VARCHAR AS option_label, NULL::VARCHAR AS option_description, false AS is_catch_all, CAST(0 AS BIGINT) AS sort_order FROM it WHERE NOT old
 UNION ALL SELECT poll_id, 'kind', 'None', NULL, NULL, true, 1 FROM it WHERE NOT old
 UNION ALL SELECT poll_id, 'opinion__' || w, 'Good', NULL, 'fine', false, 0 FROM wd UNION ALL SELECT poll_id, 'opinion__' || w, 'Bad', 'Not good', NULL, false, 1 FROM wd
 UNION ALL SELECT poll_id, 'q1', p_type, NULL, NULL, false, 0 FROM it WHERE old UNION ALL SELECT poll_id, 'q1', p_brand, 'B', NULL, false, 1 FROM it WHERE old"""
_B["catalog_rejects"] = "SELECT 'survey_' || p_partkey AS poll_id, CASE WHEN p_partkey % 10 = 8 THEN 'definition' ELSE '3' END AS field FROM part WHERE p_partkey % 10 = 8 OR p_partkey % 20 = 7"
_B["catalog_pages"] = _ITEM + """SELECT poll_id, 0 AS page_no, 'a' AS page_id, 0 AS pos, 'kind' AS question_key FROM it WHERE NOT old
 UNION ALL SELECT poll_id, 1, 'b', CAST(i - 1 AS INTEGER), 'opinion__' || w FROM wd UNION ALL SELECT poll_id, 1, 'b', CAST(len(string_split(p_name,' ')) AS INTEGER), 'why' FROM it WHERE NOT old"""
_B["upserted_questions"] = """SELECT poll_id, question_key, question_type, question_text, CASE WHEN question_key = 'channel' THEN true ELSE is_required END AS is_required, CAST(min_select AS BIGINT) AS min_select,
 CASE WHEN question_key = 'rating' AND poll_id = 'poll_3' THEN TIMESTAMP '2024-01-01' ELSE TIMESTAMP '2024-06-01' END AS updated_at FROM que"""
_B["upserted_options"] = """, d(question_key, option_value, is_catch_all, sort_order) AS (VALUES ('status','O',false,0),('status','F',false,1),('status','P',true,2),('flags','A',false,0),('flags','N',false,1),('flags','R',true,2),('channel','Web',false,0),('channel','Store',false,1),('channel','Phone',true,2),('channel','Other',false,3))
SELECT o.option_id, o.poll_id, o.question_key, o.option_value, o.option_source, CASE WHEN d.question_key IS NULL THEN o.option_label END AS option_label, NULL::VARCHAR AS option_description, coalesce(d.is_catch_all, o.is_catch_all) AS is_catch_all,
 CAST(coalesce(d.sort_order, o.sort_order) AS BIGINT) AS sort_order, CASE WHEN d.question_key IS NULL THEN o.updated_at ELSE TIMESTAMP '2024-06-01' END AS updated_at
 FROM opt o LEFT JOIN d ON d.question_key = o.question_key AND d.option_value = o.option_value
UNION ALL SELECT -1, poll_id, 'channel', 'Other', 'catalog', NULL, NULL, false, 3, TIMESTAMP '2024-06-01' FROM (SELECT DISTINCT poll_id FROM sub)"""
_B["added_text_options"] = "SELECT poll_id, question_key, option_value, option_source, is_catch_all, CASE WHEN option_source = 'catalog' THEN updated_at ELSE TIMESTAMP '2024-06-01' END AS updated_at FROM opt"
_B["new_option_ids"] = "SELECT count(*) AS added, count(*) AS ids, CAST(1000000000000 AS BIGINT) AS first_id, count(*) AS span FROM opt WHERE option_source = 'response'"
_B["upserted_taxonomy"] = _REPLY + """, res AS (SELECT o.option_id, c.* FROM cr c JOIN opt o USING (poll_id, question_key, option_value)),
 one AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY option_id, bucket, coalesce(taxonomy_path,''), coalesce(demographic_key,'') ORDER BY confidence DESC, taxonomy_path DESC, demographic_value DESC) AS rn FROM res) WHERE rn = 1)
SELECT option_id, bucket, taxonomy_path, taxonomy_depth, demographic_key, demographic_value, confidence, CASE WHEN needs IS NOT NULL THEN CAST(to_json(needs) AS VARCHAR) END AS condition_sequence, 'person' AS classified_by, is_approved, updated_at FROM tax
UNION ALL SELECT option_id, bucket, taxonomy_path, taxonomy_depth, demographic_key, demographic_value, confidence, NULL, 'model', false, TIMESTAMP '2024-06-01' FROM one"""

_B["event_window"] = "SELECT poll_id, first_submitted, last_submitted, responses, win_start, win_end FROM win"
_B["device_user"] = "SELECT poll_id, device_id, user_id FROM devu"
_B["device_publication"] = "SELECT poll_id, device_id, publication AS publication_name FROM devp"
_B["identity_candidates"] = "SELECT * FROM cand"
_B["respondent_identity"] = "SELECT * FROM idn"
_B["identity_summary"] = "SELECT poll_id, hem_source, count(*) AS row_cnt, count(hem) AS resolved FROM idn GROUP BY poll_id, hem_source"
_B["respondent_demographics"] = "SELECT * FROM dem"
_B["clustered_demographics"] = "SELECT * FROM dem"
_B["demographics_coverage"] = "SELECT count(*) AS hems, count(age_band) AS with_age, count(income_hh) AS with_income, count(state) AS with_state FROM dem"
_B["audience_profile"] = """, hems AS (SELECT DISTINCT poll_id, lower(user_id) AS hem FROM pev WHERE user_id IS NOT NULL UNION SELECT DISTINCT poll_id, lower(external_id) FROM sub WHERE external_id <> ''),
 ids AS (SELECT DISTINCT h.poll_id, e.id FROM hems h JOIN eml e ON lower(e.sha256) = h.hem),
 j AS (SELECT i.poll_id, d.* FROM ids i JOIN per d USING (id))
SELECT poll_id, 'AGE_BAND' AS dim, CASE WHEN age < 35 THEN '18-34' WHEN age < 45 THEN '35-44' WHEN age < 55 THEN '45-54' WHEN age < 65 THEN '55-64' WHEN age >= 65 THEN '65+' ELSE '(unknown)' END AS val, count(*) AS n FROM j GROUP BY ALL
UNION ALL SELECT poll_id, 'INCOME_HH', coalesce(income_hh,'(unknown)'), count(*) FROM j GROUP BY ALL
UNION ALL SELECT poll_id, 'NET_WORTH_HH', coalesce(net_worth_hh,'(unknown)'), count(*) FROM j GROUP BY ALL"""
_B["pending_responses"] = """SELECT s.ingestion_id, s.poll_id, s.submitted_at FROM sub s WHERE NOT EXISTS (SELECT 1 FROM idn i WHERE i.ingestion_id = s.ingestion_id AND i.hem IS NOT NULL)
 AND s.poll_id IN (SELECT poll_id FROM win WHERE last_submitted >= (SELECT max(submitted_at) FROM sub) - INTERVAL 14 DAY)"""
_B["unseen_respondents"] = "SELECT DISTINCT hem FROM idn WHERE hem IS NOT NULL AND hem NOT IN (SELECT hem FROM dem WHERE gender = 'F')"
_B["response_demographics"] = "SELECT * FROM exp"

_yn = lambda c: f"CASE WHEN {c} IS NULL THEN '' WHEN {c} THEN 'Yes' ELSE 'No' END"
_tx = lambda c: f"coalesce(CAST({c} AS VARCHAR), '')"
_META = ["CAST(e.ingestion_id AS VARCHAR)", "coalesce(strftime(e.submitted_at, '%Y-%m-%d %H:%M:%S.%g'), '')", _tx("e.market_name")]
_DEMO = [
    ("Age Band", _tx("age_band")),
    ("Generation", _tx("generation")),
    ("Household Income", _tx("income_hh")),
    ("Net Worth", _tx("net_worth_hh")),
    ("Education", _tx("education")),
    ("Occupation", _tx("occupation_category")),
    ("Marital Status", _tx("marital_status")),
    ("Home Owner", _tx("home_owner")),
    ("Ethnicity", _tx("ethnic_group")),
    ("Has Children", _yn("has_children_hh")),
    ("Gender", _tx("gender")),
    ("State", _tx("state")),
    ("DMA", _tx("dma")),
    ("Affinity: Investor", _yn("affinity_investor")),
    ("Affinity: Homeowner", _yn("affinity_homeowner")),
]
_QTXT = ["Order status?", "flags", "Brand note?", "Which channel?"]
_WIDE = """, wide AS (SELECT ingestion_id, """ + ", ".join(f"max(CASE WHEN qt = '{q}' THEN txt END) AS a{i}" for i, q in enumerate(_QTXT)) + " FROM qj GROUP BY ingestion_id)"
_B["response_grid"] = (
    _WIDE
    + f""" SELECT {_META[0]} AS "Response ID", {_META[1]} AS "Submitted At", {_META[2]} AS "Market", """
    + ", ".join(f"coalesce(a{i}, '') AS \"{q}\"" for i, q in enumerate(_QTXT))
    + ", "
    + ", ".join(f'{c} AS "{n}"' for n, c in _DEMO)
    + " FROM exp e LEFT JOIN wide w USING (ingestion_id)"
)
_QL = """, qp AS (SELECT poll_id, question, min(q_order * 100 + CASE question_key WHEN 'channel' THEN 1 WHEN 'flags' THEN 2 WHEN 'note' THEN 3 ELSE 4 END) AS p FROM tal GROUP BY poll_id, question),
 ql AS (SELECT poll_id, question, row_number() OVER (PARTITION BY poll_id ORDER BY p) - 1 AS no FROM qp)"""
_B["question_lists"] = _QL + "SELECT poll_id, CAST(to_json(list(question ORDER BY no)) AS VARCHAR) AS questions FROM ql GROUP BY poll_id"
_j = lambda *v: "CAST(to_json([" + ", ".join(v) + "]) AS VARCHAR)"
_B["survey_reports"] = _QL + f""", tot AS (SELECT poll_id, count(*) AS total FROM sub GROUP BY poll_id), polls AS (SELECT DISTINCT poll_id FROM sub),
 lst AS (SELECT poll_id, list(question ORDER BY no) AS qs FROM ql GROUP BY poll_id),
 cells AS (SELECT e.poll_id, e.ingestion_id, e.submitted_at, to_json(list_concat(list_concat([{", ".join(_META)}], (SELECT list(coalesce(qj.txt, '') ORDER BY ql.no) FROM ql LEFT JOIN qj ON qj.ingestion_id = e.ingestion_id AND qj.qt = ql.question WHERE ql.poll_id = e.poll_id)), [{", ".join(c for _, c in _DEMO)}])) AS c FROM exp e)
SELECT poll_id, 0 AS section, 0 AS question_no, 0 AS line, CAST(0 AS BIGINT) AS rank, '' AS row_key, {_j("poll_id")} AS cells FROM polls
UNION ALL SELECT poll_id, 0, 0, 1, 0, '', {_j("'Total Responses:'", "CAST(total AS VARCHAR)", "'Last Updated: 03/06/2025, 08:00:00 ET'")} FROM tot
UNION ALL SELECT poll_id, 1, CAST(no AS INTEGER), l, 0, '', CASE l WHEN 0 THEN '[]' WHEN 1 THEN {_j("'Q: \"' || question || '\"'")} ELSE '["Answer","Count","%"]' END FROM ql, (VALUES (0),(1),(2)) x(l)
UNION ALL SELECT t.poll_id, 1, CAST(ql.no AS INTEGER), 3, -t.n, t.answer, {_j("t.answer", "CAST(t.n AS VARCHAR)", "printf('%.1f%%', CAST(floor((t.n * 2000 + t.total) / (2 * t.total)) AS DOUBLE) / 10)")} FROM tal t JOIN ql ON ql.poll_id = t.poll_id AND ql.question = t.question
UNION ALL SELECT poll_id, 2, 0, l, 0, '', CASE WHEN l = 2 THEN '["RESPONSES + DEMOGRAPHICS"]' ELSE '[]' END FROM polls, (VALUES (0),(1),(2),(3)) x(l)
UNION ALL SELECT poll_id, 3, 0, 0, 0, '', CAST(to_json(list_concat(list_concat(['Response ID','Submitted At','Market'], qs), [{", ".join(f"'{n}'" for n, _ in _DEMO)}])) AS VARCHAR) FROM lst
UNION ALL SELECT poll_id, 4, 0, 0, epoch_us(submitted_at), lpad(CAST(ingestion_id AS VARCHAR), 20, '0'), CAST(c AS VARCHAR) FROM cells"""

_B["stored_reports"] = _B["survey_reports"]
_B["email_hashes"] = "SELECT c_custkey AS id, sha256(lower(c_name || '@mail.example')) AS hem FROM customer"

_VOTES = ", vt AS (SELECT poll_id, question_key, v AS option_value FROM el WHERE type <> 'text' AND NOT write_in AND v <> '' UNION ALL SELECT poll_id, 'rating', CAST(k % 5 AS VARCHAR) FROM sub), vc AS (SELECT poll_id, question_key, option_value, count(*) AS votes FROM vt GROUP BY ALL)"
_B["live_option_counts"] = _VOTES + "SELECT * FROM vc"
_B["live_option_stats"] = _VOTES + """SELECT poll_id, question_key, option_value AS label, votes, CAST(floor((votes * 200 + t) / (2 * t)) AS BIGINT) AS percentage
 FROM (SELECT *, CAST(sum(votes) OVER (PARTITION BY poll_id, question_key) AS BIGINT) AS t FROM vc)"""

_B["options_as_of"] = """SELECT '2024-01-01' AS as_of, option_id, question_text FROM opt JOIN que USING (poll_id, question_key)
UNION ALL SELECT '2024-02-01', option_id, question_text || ' (new)' FROM opt JOIN que USING (poll_id, question_key) WHERE option_source = 'catalog'"""
_B["rolled_back_tables"] = """SELECT 'options' AS name, poll_id, question_key, option_value AS value FROM opt
UNION ALL SELECT 'questions', poll_id, question_key, question_text FROM que"""
_B["refreshed_identity"] = "SELECT ingestion_id, poll_id, device_id, hem, hem_source, publication_name FROM idn WHERE poll_id <> 'poll_3'"
_B["caught_up"] = "SELECT ingestion_id, k % 1000 = 7 AS changed FROM sub"
_B["synced_catalog"] = f"""{_ITEM}, co AS ({_B["catalog_options"].removeprefix(_ITEM)}), cq AS ({_B["catalog_questions"].removeprefix(_ITEM)})
SELECT DISTINCT poll_id, question_key, question_type, option_value, sort_order, true AS dense FROM co JOIN cq USING (poll_id, question_key)"""
_B["delivered_once"] = """SELECT ingestion_id AS delivery_id, 'accepted' AS place, CAST(1 AS BIGINT) AS n FROM sub WHERE submitted_at >= DATE '2024-01-10'
UNION ALL SELECT ingestion_id, 'late', CAST(1 AS BIGINT) FROM sub WHERE submitted_at < DATE '2024-01-10'
 OR k % 10 = 4 AND submitted_at < (SELECT max(CAST(submitted_at AS DATE)) - 14 FROM sub)"""
_B["copy_parity"] = """SELECT 'submissions' AS object_name, count(*) AS source_count, count(*) FILTER (WHERE k % 100 <> 99) AS copied_count, CASE WHEN count(*) FILTER (WHERE k % 100 = 99 OR k % 1000 = 7) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM sub
UNION ALL SELECT 'options', count(*), count(*), 'PASS' FROM opt"""
_B["catch_up"] = "SELECT ingestion_id FROM sub WHERE k % 100 = 99"
_B["copy_differences"] = "SELECT ingestion_id, CASE WHEN k % 100 = 99 THEN 'missing' ELSE 'changed' END AS kind FROM sub WHERE k % 100 = 99 OR k % 1000 = 7"
_B["differing_ranges"] = """SELECT k // 64 * 64 AS first_key, k // 64 * 64 + 63 AS last_key, count(*) AS source_count, count(*) FILTER (WHERE k % 100 <> 99) AS copied_count
 FROM sub GROUP BY k // 64 HAVING count(*) FILTER (WHERE k % 100 = 99 OR k % 1000 = 7) > 0"""
_B["id_conflicts"] = "SELECT ingestion_id FROM sub WHERE k % 1000 = 7"
_B["rolled_back"] = "SELECT ingestion_id, k % 1000 = 7 AS changed FROM sub"
_B["id_faults"] = "SELECT l_orderkey * 10 + l_linenumber AS line_id, count(*) AS row_cnt FROM lineitem GROUP BY 1 HAVING count(*) <> 1"
_LINES = "(SELECT count(*) FROM (SELECT l_orderkey * 10 + l_linenumber AS i FROM lineitem GROUP BY 1 HAVING count(*) <> 1))"
_pf = lambda c: f"CASE WHEN {c} THEN 'PASS' ELSE 'FAIL' END"
_B["demographics_checks"] = f"""SELECT 'one row per respondent' AS check_name, {_pf("count(*) = count(DISTINCT hem)")} AS status, count(*) AS observed, count(DISTINCT hem) AS expected FROM dem
UNION ALL SELECT 'respondents matched', {_pf("m >= 0.85 * r")}, m, r FROM (SELECT (SELECT count(*) FROM dem) AS m, (SELECT count(DISTINCT hem) FROM idn) AS r)
UNION ALL SELECT 'age is banded', {_pf("count(*) = 0")}, count(*), 0 FROM dem WHERE age_band NOT IN ('18-34','35-44','45-54','55-64','65+')
UNION ALL SELECT 'no direct personal columns', 'PASS', 0, 0
UNION ALL SELECT 'hash shape and source', {_pf("count(*) = 0")}, count(*), 0 FROM idn WHERE (hem IS NOT NULL AND length(hem) <> 64) OR (hem IS NULL) <> (hem_source IS NULL)
UNION ALL SELECT 'one identity row per submission', {_pf("count(*) = 0")}, count(*), 0 FROM (SELECT ingestion_id FROM idn GROUP BY 1 HAVING count(*) > 1)"""
_B["export_checks"] = f"""SELECT 'one export row per submission' AS check_name, {_pf("count(*) = (SELECT count(*) FROM sub) AND count(*) = count(DISTINCT ingestion_id)")} AS status, count(*) AS observed, (SELECT count(*) FROM sub) AS expected FROM exp
UNION ALL SELECT 'age coverage', {_pf("count(age_band) >= 0.5 * count(*)")}, count(age_band), count(*) FROM exp
UNION ALL SELECT 'market present', {_pf("count(market_name) > 0")}, count(market_name), 1 FROM exp
UNION ALL SELECT 'unresolved submissions present', {_pf("count(*) > 0")}, count(*), 1 FROM exp WHERE age_band IS NULL
UNION ALL SELECT 'no personal columns in export', 'PASS', 0, 0"""
_B["table_checks"] = f"""SELECT 'submissions: ids present, unique, in range' AS check_name, 'PASS' AS status, CAST(0 AS BIGINT) AS observed, CAST(0 AS BIGINT) AS expected
UNION ALL SELECT 'options: ids present, unique, in range', 'PASS', 0, 0
UNION ALL SELECT 'lines: ids present, unique, in range', {_pf(_LINES + " = 0")}, {_LINES}, 0
UNION ALL SELECT 'submissions: same id, same content', {_pf("count(*) = 0")}, count(*), 0 FROM sub WHERE k % 1000 = 7
UNION ALL SELECT 'submissions: copies equal', 'FAIL', count(*) FILTER (WHERE k % 100 <> 99), count(*) FROM sub
UNION ALL SELECT 'options: copies equal', 'PASS', count(*), count(*) FROM opt"""

# Rules of the polls' own definition: rating needs flag A, the third page a status other than P, the note a status F.
_B["hidden_answers"] = """SELECT ingestion_id, poll_id, question_key, CASE WHEN question_key = 'rating' AND poll_id = 'poll_3' THEN 'unknown question' WHEN question_key = 'note' AND status <> 'P' THEN 'question hidden' ELSE 'page hidden' END AS reason
 FROM ans JOIN (SELECT ingestion_id, status, coalesce(list_contains(flags, 'A'), false) AS has_a FROM sub) USING (ingestion_id)
 WHERE kind <> 'none' AND ((question_key = 'rating' AND (poll_id = 'poll_3' OR NOT has_a)) OR (question_key IN ('note','channel') AND status = 'P') OR (question_key = 'note' AND status <> 'F'))"""
_B["incomplete_required"] = """SELECT ingestion_id, poll_id, 'flags' AS question_key, CASE WHEN flags IS NULL THEN 'missing' ELSE 'too few' END AS reason FROM sub WHERE flags IS NULL OR (NOT list_contains(flags, 'R') AND len(flags) < 2)"""
_B["not_offered_options"] = "SELECT ingestion_id, poll_id, 'channel' AS question_key, CASE c % 4 WHEN 0 THEN 'Web' ELSE 'Store' END AS option_value FROM sub WHERE c % 4 IN (0, 1)"
_B["exclusive_conflicts"] = "SELECT ingestion_id, poll_id, 'flags' AS question_key, 'N' AS exclusive, len(flags) AS choices FROM sub WHERE list_contains(flags, 'N') AND len(flags) > 1"
_B["write_ins"] = "SELECT ingestion_id, poll_id, 'channel' AS question_key, 'Other ' || (c % 7) AS write_in_text FROM sub WHERE c % 4 = 3"
_B["open_polls"] = """, tok AS (SELECT 'cust_' || c_custkey AS respondent_id, c_custkey AS k, i AS n, ['on','off',' Control ','on-le',NULL,'','No','ON'][(c_custkey + i) % 8 + 1] AS token FROM customer, (VALUES (1),(2),(3),(4),(5)) x(i)),
 pf AS (SELECT DISTINCT CAST(substr(poll_id, 6, 1) AS INTEGER) AS n, poll_id || CASE WHEN poll_id = 'poll_3' THEN '_segment-z' ELSE '' END AS poll_id FROM sub)
SELECT respondent_id, poll_id FROM tok JOIN pf USING (n) WHERE lower(token) IN ('on','on-le') AND NOT (k % 4 = 0 AND n IN (1, 2)) AND NOT (k % 4 = 1 AND n IN (1, 3))"""
_B["page_funnel"] = """SELECT 'poll_' || (user_id % 5 + 1) AS poll_id, CASE event_type WHEN 'view' THEN 'Q1' WHEN 'click' THEN 'Q2' WHEN 'signup' THEN 'Q3' ELSE 'Submit' END AS button, count(DISTINCT user_id) AS respondents
 FROM events WHERE event_type <> 'error' GROUP BY ALL"""

_TYPED = "SELECT poll_id, question_key, upper(option_value) AS option_value, 'preference' AS bucket, 'Brands|' || option_value AS taxonomy_path, CAST(2 AS BIGINT) AS taxonomy_depth, CAST(0.5 AS DOUBLE) AS confidence, TIMESTAMP '2024-06-01' AS updated_at FROM opt WHERE option_source = 'response'"
_B["upserted_flat_taxonomy"] = _TYPED
_B["upserted_text_taxonomy"] = """SELECT option_id, bucket, taxonomy_path, demographic_key, confidence, 'person' AS classified_by, updated_at FROM tax
UNION ALL SELECT option_id, 'preference', 'Brands|' || option_value, NULL, 0.5, 'model', TIMESTAMP '2024-06-01' FROM opt WHERE option_source = 'response'"""

# The same, for one poll.
for _name in "survey_catalog response_tally report_tally text_answers options_to_classify classification_status event_window device_user device_publication identity_candidates respondent_identity".split():
    _B[f"{_name}_of_poll"] = f"SELECT * FROM ({_B[_name]}) WHERE poll_id = 'poll_2'"
_B["answer_patterns_of_poll"] = f"{_B['answer_patterns']} AND b.poll_id = 'poll_2'"

ORACLES = {name: BASE + sql for name, sql in _B.items()}
