"""Common table expressions: the survey tables of the adapter, in long form."""

BASE = """
WITH li AS (
 SELECT l_orderkey, list_sort(list(DISTINCT l_returnflag)) AS flags, min(l_partkey) AS pk FROM lineitem GROUP BY l_orderkey),
sub AS (
 SELECT o_orderkey AS ingestion_id, 'poll_' || substr(o_orderpriority,1,1) AS poll_id,
  CASE WHEN o_orderkey % 50 = 1 THEN '' WHEN o_orderkey % 50 <> 0 THEN 'dev_' || CAST(o_custkey AS VARCHAR) END AS device_id,
  CASE WHEN o_custkey % 10 < 2 THEN sha256('dev_' || CAST(o_custkey AS VARCHAR))
       WHEN o_custkey % 10 = 2 THEN '  ' || upper(sha256('dev_' || CAST(o_custkey AS VARCHAR))) || ' '
       WHEN o_custkey % 10 = 3 THEN 'garbage' ELSE '' END AS external_id,
  CASE WHEN o_custkey % 3 = 0 THEN 'Market ' || CAST(o_custkey % 5 AS VARCHAR) ELSE '' END AS market_name,
  TIMESTAMP '2024-01-02 00:00:00' + to_days(CAST(o_orderkey % 28 AS INTEGER)) + to_seconds(o_orderkey % 86400) AS submitted_at,
  o_orderstatus AS status, li.flags, o_orderkey AS k, o_custkey AS c, p_brand,
  CASE WHEN o_orderkey % 7 = 0 THEN '   ' ELSE '  ' || upper(p_brand) || ' ' END AS typed
 FROM orders LEFT JOIN li ON l_orderkey = o_orderkey LEFT JOIN part ON p_partkey = li.pk),
ans AS (
 SELECT ingestion_id, poll_id, device_id, CASE WHEN k % 3 = 0 THEN 1 ELSE 0 END AS pos, 'status' AS question_key, 'string' AS kind, [status] AS elems, 'single' AS type, false AS write_in FROM sub
 UNION ALL
 SELECT ingestion_id, poll_id, device_id, CASE WHEN k % 3 = 0 THEN 0 ELSE 1 END, 'flags', CASE WHEN flags IS NULL THEN 'none' ELSE 'array' END, flags, 'multi', false FROM sub
 UNION ALL
 SELECT ingestion_id, poll_id, device_id, 2, 'note', CASE WHEN typed IS NULL THEN 'none' ELSE 'string' END, CASE WHEN typed IS NOT NULL THEN [typed] END, 'text', false FROM sub
 UNION ALL
 SELECT ingestion_id, poll_id, device_id, 3, 'rating', 'other', NULL, 'rating', false FROM sub
 UNION ALL
 SELECT ingestion_id, poll_id, device_id, 4, 'channel', 'string',
  [CASE c % 4 WHEN 3 THEN 'Other ' || CAST(c % 7 AS VARCHAR) WHEN 0 THEN 'Web' WHEN 1 THEN 'Store' ELSE 'Phone' END], 'single', c % 4 = 3 FROM sub),
el AS (SELECT ingestion_id, poll_id, device_id, pos, question_key, kind, type, write_in, unnest(elems) AS v FROM ans WHERE elems IS NOT NULL),
opt0 AS (
 SELECT DISTINCT poll_id, 'status' AS question_key, status AS option_value, 'catalog' AS option_source, CASE status WHEN 'F' THEN 1 WHEN 'O' THEN 2 ELSE 3 END AS ord, 1 AS code FROM sub
 UNION ALL
 SELECT DISTINCT poll_id, 'flags', f, 'catalog', CASE f WHEN 'A' THEN 1 WHEN 'N' THEN 2 ELSE 3 END, 2 FROM (SELECT poll_id, unnest(flags) AS f FROM sub)
 UNION ALL
 SELECT DISTINCT poll_id, 'note', lower(trim(typed)), 'response', CAST(substr(lower(trim(typed)), 7) AS INTEGER), 3 FROM sub WHERE trim(typed) <> ''
 UNION ALL
 SELECT DISTINCT poll_id, 'channel', v, 'catalog', o, 4 FROM sub, (VALUES ('Web',1),('Store',2),('Phone',3)) t(v,o)),
opt AS (
 SELECT CAST(substr(poll_id,6,1) AS BIGINT) * 100000 + code * 10000 + ord AS option_id, poll_id, question_key, option_value, option_source,
  CASE WHEN question_key = 'status' THEN 'Label ' || option_value END AS option_label,
  CASE WHEN question_key = 'channel' THEN 'via ' || option_value END AS option_description,
  (question_key = 'flags' AND option_value = 'R') AS is_catch_all,
  CASE WHEN option_source = 'catalog' THEN CAST(ord - 1 AS BIGINT) END AS sort_order, TIMESTAMP '2024-01-01' AS updated_at
 FROM opt0),
que AS (
 SELECT poll_id, q.* FROM (SELECT DISTINCT poll_id FROM sub), (VALUES
  ('status','single','Order status?',true,NULL),('flags','multi',NULL,true,2),('note','text','Brand note?',false,NULL),
  ('rating','rating','How was it?',false,NULL),('channel','single','Which channel?',false,NULL)) q(question_key,question_type,question_text,is_required,min_select)),
tax0 AS (
 SELECT option_id, poll_id, 'preference' AS bucket, 'Orders|Status|' || option_value AS path, NULL::VARCHAR AS dkey, NULL::VARCHAR AS dval, NULL::VARCHAR AS dtype, 0.9 AS conf, NULL::BIGINT[] AS needs FROM opt WHERE question_key='status'
 UNION ALL SELECT option_id, poll_id, 'consumption', 'Returns|' || option_value, NULL, NULL, NULL, 0.75, NULL FROM opt WHERE question_key='flags'
 UNION ALL SELECT option_id, poll_id, 'demographic', NULL, 'brand', option_value, 'STRING', 0.6, NULL FROM opt WHERE question_key='note'
 UNION ALL SELECT option_id, poll_id, 'consumption', 'Returns|A|After F', NULL, NULL, NULL, 1.0, [CAST(substr(poll_id,6,1) AS BIGINT) * 100000 + 10001] FROM opt WHERE question_key='flags' AND option_value='A'
 UNION ALL SELECT option_id, poll_id, 'consumption', 'Returns|A|After F then N', NULL, NULL, NULL, 1.0, [CAST(substr(poll_id,6,1) AS BIGINT) * 100000 + 10001, CAST(substr(poll_id,6,1) AS BIGINT) * 100000 + 20002] FROM opt WHERE question_key='flags' AND option_value='A'),
tax AS (
 SELECT option_id, bucket, path AS taxonomy_path, CAST(len(string_split(path,'|')) AS BIGINT) AS taxonomy_depth, dkey AS demographic_key, dval AS demographic_value, dtype AS demographic_type,
  CAST(conf AS DOUBLE) AS confidence, needs, poll_id = 'poll_1' AS is_approved, TIMESTAMP '2024-01-01' AS updated_at FROM tax0 WHERE poll_id <> 'poll_4'),
ao AS (
 SELECT e.ingestion_id, e.device_id, e.pos, o.option_id, o.is_catch_all FROM el e JOIN opt o ON o.poll_id = e.poll_id AND o.question_key = e.question_key
  AND ((o.option_source = 'catalog' AND o.option_value = e.v) OR (o.option_source = 'response' AND e.kind = 'string' AND trim(e.v) <> '' AND o.option_value = lower(trim(e.v))))
 WHERE e.device_id IS NOT NULL AND e.device_id <> ''),
unc AS (
 SELECT ao.ingestion_id, ao.device_id, t.bucket, t.taxonomy_path, t.demographic_key, t.demographic_value
 FROM ao JOIN tax t USING (option_id) WHERE NOT ao.is_catch_all AND t.needs IS NULL),
need AS (SELECT option_id AS target, bucket, taxonomy_path, demographic_key, demographic_value, unnest(needs) AS req, generate_subscripts(needs, 1) AS i, len(needs) AS total FROM tax WHERE needs IS NOT NULL),
firsts AS (SELECT ingestion_id, option_id, min(pos) AS pos FROM ao GROUP BY ALL),
probe AS (
 SELECT a.ingestion_id, a.device_id, n.*, s.pos AS this_pos, lead(s.pos) OVER (PARTITION BY a.ingestion_id, n.target, n.taxonomy_path ORDER BY n.i) AS next_pos
 FROM (SELECT DISTINCT ingestion_id, device_id, option_id FROM ao WHERE NOT is_catch_all) a JOIN need n ON n.target = a.option_id
 LEFT JOIN firsts s ON s.ingestion_id = a.ingestion_id AND s.option_id = n.req),
con AS (
 SELECT ingestion_id, device_id, bucket, taxonomy_path, demographic_key, demographic_value FROM probe
 GROUP BY ingestion_id, device_id, target, bucket, taxonomy_path, demographic_key, demographic_value
 HAVING sum(CASE WHEN this_pos IS NULL THEN 1 ELSE 0 END) = 0 AND sum(CASE WHEN next_pos IS NOT NULL AND this_pos >= next_pos THEN 1 ELSE 0 END) = 0),
ut AS (SELECT * FROM unc UNION ALL SELECT * FROM con),
prof AS (
 SELECT device_id, bucket || '_insights' AS user_property, CAST(to_json(list_sort(list(DISTINCT taxonomy_path))) AS VARCHAR) AS user_property_value
 FROM ut WHERE bucket IN ('consumption','preference') AND taxonomy_path IS NOT NULL GROUP BY device_id, bucket
 UNION ALL SELECT DISTINCT device_id, demographic_key, demographic_value FROM ut WHERE bucket = 'demographic' AND demographic_key IS NOT NULL),
ev AS (
 SELECT 'dev_' || CAST(user_id AS VARCHAR) AS device_id,
  CASE WHEN event_type = 'error' THEN NULL WHEN CAST(props->>'k' AS BIGINT) % 10 = 0 THEN sha256('dev_' || CAST(user_id + 1 AS VARCHAR)) ELSE sha256('dev_' || CAST(user_id AS VARCHAR)) END AS user_id,
  ts AS event_time, CASE WHEN event_type = 'view' THEN '[Guides-Surveys] view' ELSE event_type END AS event_type,
  CASE WHEN CAST(props->>'k' AS BIGINT) % 7 = 0 THEN '' WHEN CAST(props->>'k' AS BIGINT) % 11 <> 0 THEN 'pub_' || CAST(CAST(props->>'k' AS BIGINT) % 3 AS VARCHAR) END AS publication FROM events),
win AS (
 SELECT poll_id, min(submitted_at) AS first_submitted, max(submitted_at) AS last_submitted, count(*) AS responses,
  CAST(min(submitted_at) AS DATE) - 1 AS win_start, CAST(max(submitted_at) AS DATE) + 1 AS win_end FROM sub GROUP BY poll_id),
rsp AS (SELECT DISTINCT s.poll_id, s.device_id, w.win_start, w.win_end FROM sub s JOIN win w USING (poll_id) WHERE s.device_id <> ''),
pev AS (SELECT r.poll_id, e.* FROM rsp r JOIN ev e ON e.device_id = r.device_id AND e.event_time BETWEEN CAST(r.win_start AS TIMESTAMP) AND CAST(r.win_end AS TIMESTAMP)),
devu AS (
 SELECT poll_id, device_id, user_id FROM (SELECT poll_id, device_id, user_id, row_number() OVER (PARTITION BY poll_id, device_id ORDER BY count(*) DESC, max(event_time) DESC, user_id DESC) AS rn
  FROM pev WHERE user_id IS NOT NULL GROUP BY poll_id, device_id, user_id) WHERE rn = 1),
devp AS (
 SELECT poll_id, device_id, publication FROM (SELECT poll_id, device_id, publication, row_number() OVER (PARTITION BY poll_id, device_id ORDER BY count(*) DESC, max(event_time) DESC, publication DESC) AS rn
  FROM pev WHERE event_type LIKE '[Guides-Surveys]%' AND publication <> '' GROUP BY poll_id, device_id, publication) WHERE rn = 1),
cand AS (
 SELECT s.ingestion_id, s.poll_id, nullif(s.device_id,'') AS device_id, nullif(s.external_id,'') AS payload_external_id, u.user_id AS recovered_user_id, p.publication AS recovered_publication
 FROM sub s LEFT JOIN devu u ON u.poll_id = s.poll_id AND u.device_id = s.device_id LEFT JOIN devp p ON p.poll_id = s.poll_id AND p.device_id = s.device_id),
idn AS (
 SELECT ingestion_id, poll_id, device_id,
  CASE WHEN regexp_full_match(lower(trim(payload_external_id)), '[0-9a-f]{64}') THEN lower(trim(payload_external_id)) WHEN regexp_full_match(lower(trim(recovered_user_id)), '[0-9a-f]{64}') THEN lower(trim(recovered_user_id)) END AS hem,
  CASE WHEN regexp_full_match(lower(trim(payload_external_id)), '[0-9a-f]{64}') THEN 'payload' WHEN regexp_full_match(lower(trim(recovered_user_id)), '[0-9a-f]{64}') THEN 'events' END AS hem_source,
  recovered_publication AS publication_name FROM cand),
eml AS (
 SELECT c_custkey AS id, sha256('dev_' || CAST(unnest([c_custkey, c_custkey // 3]) AS VARCHAR)) AS sha256, CASE WHEN c_custkey % 13 <> 0 THEN c_custkey % 5 END AS q, CASE WHEN c_custkey % 17 <> 0 THEN c_custkey % 7 END AS r,
  DATE '2024-01-01' + CAST(c_custkey % 300 AS INTEGER) AS u FROM customer),
per AS (
 SELECT c_custkey AS id, CASE WHEN c_custkey % 11 <> 0 THEN 18 + c_custkey % 70 END AS age, 'gen_' || (c_custkey % 4) AS generation, CASE WHEN c_custkey % 9 <> 0 THEN c_mktsegment END AS income_hh,
  'worth_' || (c_custkey % 3) AS net_worth_hh, 'edu_' || (c_custkey % 5) AS education, 'job_' || (c_custkey % 6) AS occupation_category, 'status_' || (c_custkey % 2) AS marital_status,
  'home_' || (c_custkey % 2) AS home_owner, 'group_' || (c_custkey % 4) AS ethnic_group, CASE WHEN c_custkey % 8 <> 0 THEN c_custkey % 3 END AS children_hh, CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
  CASE WHEN c_custkey % 6 <> 0 THEN 1 + c_custkey % 4 END AS home_owner_ordinal, CASE WHEN c_custkey % 4 <> 0 THEN c_custkey % 3 END AS owns_investments FROM customer WHERE c_custkey % 19 <> 0),
plc AS (
 SELECT c_custkey AS id, CASE WHEN c_custkey % 5 = 0 THEN 'X' END AS gender, n_name AS state, c_nationkey AS dma FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey WHERE c_custkey % 23 <> 0),
prim AS (
 SELECT hem, id FROM (SELECT h.hem, e.id, row_number() OVER (PARTITION BY h.hem ORDER BY e.q DESC NULLS LAST, e.r ASC NULLS LAST, e.u DESC NULLS LAST, e.id ASC) AS rn
  FROM (SELECT DISTINCT hem FROM idn WHERE hem IS NOT NULL) h JOIN eml e ON e.sha256 = h.hem) WHERE rn = 1),
dem AS (
 SELECT pp.hem, CASE WHEN d.age IS NULL THEN NULL WHEN d.age < 35 THEN '18-34' WHEN d.age < 45 THEN '35-44' WHEN d.age < 55 THEN '45-54' WHEN d.age < 65 THEN '55-64' ELSE '65+' END AS age_band,
  d.generation, d.income_hh, d.net_worth_hh, d.education, d.occupation_category, d.marital_status, d.home_owner, d.ethnic_group, d.children_hh > 0 AS has_children_hh, coalesce(p.gender, d.gender) AS gender,
  p.state, p.dma, d.owns_investments = 1 AS affinity_investor, d.home_owner_ordinal >= 3 AS affinity_homeowner
 FROM prim pp LEFT JOIN per d ON d.id = pp.id LEFT JOIN plc p ON p.id = pp.id),
lab AS (
 SELECT e.ingestion_id, coalesce(q.question_text, e.question_key) AS qt, coalesce(o.option_label, e.v) AS label
 FROM el e LEFT JOIN opt o ON o.poll_id = e.poll_id AND o.question_key = e.question_key AND o.option_value = e.v AND o.option_source = 'catalog'
 LEFT JOIN que q ON q.poll_id = e.poll_id AND q.question_key = e.question_key
 WHERE coalesce(o.is_catch_all, false) = false),
qj AS (SELECT ingestion_id, qt, string_agg(DISTINCT label, ', ' ORDER BY label) AS txt FROM lab WHERE trim(label) <> '' GROUP BY ingestion_id, qt),
amap AS (SELECT ingestion_id, '{' || string_agg(CAST(to_json(qt) AS VARCHAR) || ':' || CAST(to_json(txt) AS VARCHAR), ',' ORDER BY qt) || '}' AS answers FROM qj GROUP BY ingestion_id),
exp AS (
 SELECT b.ingestion_id, b.poll_id, b.submitted_at, coalesce(i.publication_name, nullif(b.market_name,'')) AS market_name, i.hem_source AS identity_source, dem.* EXCLUDE (hem), coalesce(a.answers, '{}') AS answers
 FROM sub b LEFT JOIN idn i USING (ingestion_id) LEFT JOIN dem ON dem.hem = i.hem LEFT JOIN amap a ON a.ingestion_id = b.ingestion_id),
tal AS (
 SELECT t.poll_id, t.question_key, t.v, t.n, coalesce(q.question_text, t.question_key) AS question, coalesce(o.option_label, t.v) AS answer, tot.total, qo.q_order
 FROM (SELECT poll_id, question_key, kind, v, count(*) AS n FROM el GROUP BY ALL) t JOIN (SELECT poll_id, count(*) AS total FROM sub GROUP BY poll_id) tot USING (poll_id)
 LEFT JOIN (SELECT poll_id, question_key, min(pos) AS q_order FROM ans GROUP BY ALL) qo USING (poll_id, question_key)
 LEFT JOIN que q USING (poll_id, question_key)
 LEFT JOIN opt o ON o.poll_id = t.poll_id AND o.question_key = t.question_key AND o.option_value = t.v AND o.option_source = 'catalog')
"""
