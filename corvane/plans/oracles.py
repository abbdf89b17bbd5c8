"""SQL for another engine that states what each registered query must return.

Written against the given tables alone and in a different shape from the Spark
plans where there is a choice: recursion instead of a fold, joins instead of
sets, pairs instead of blocks.
"""

from __future__ import annotations

from corvane import fixed_values as fixed
from corvane.functions import routing
from corvane.plans import tables as given
from corvane.plans.registry import DECLARED, GUARDED, LETTERS

# The given tables' columns and types.
COLUMNS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
    "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
    "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "documents": "doc_id bigint, text string, lang string, source string, n_chars bigint",
    "embeddings": "vec_id bigint, embedding array<float>, label int",
    "pages": "page_id bigint, url string, html string",
    "benchmark": "item_id bigint, text string",
    "labels": "doc_id bigint, quality int, toxic int",
    "conversations": "conv_id bigint, turn bigint, role string, text string",
}
SPACE = (
    r"[\x09-\x0d\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)


def quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def stripped(expression: str) -> str:
    return f"regexp_replace({expression}, '^{SPACE}+|{SPACE}+$', '', 'g')"


def pick(values, by: str) -> str:
    return f"list_extract([{', '.join(map(quoted, values))}], CAST(({by}) % {len(values)} AS INT) + 1)"


def columns_of(table: str) -> list[tuple[str, str]]:
    return [tuple(c.strip().rsplit(" ", 1)) for c in COLUMNS[table].split(",")]


# Named parts of WITH clauses, and the parts each one needs.

DOCS = (
    "docs AS (SELECT doc_id AS document_id, 'raw/pdf/' || source || '/' || doc_id || '.pdf' AS s3_key, "
    "text FROM documents)"
)
SENTENCES = rf"""{DOCS},
pieces AS (
  SELECT document_id, s3_key,
    string_split(regexp_replace(body, '([.!?]){SPACE}+', '\1' || chr(1), 'g'), chr(1)) AS list
  FROM (SELECT document_id, s3_key, {stripped('text')} AS body FROM docs) WHERE body <> ''),
sentences AS (
  SELECT document_id, s3_key, generate_subscripts(list, 1) AS i, unnest(list) AS sentence FROM pieces),
sized AS (
  SELECT document_id, i, CAST(greatest(1, length(sentence) // 4) AS INT) AS n FROM sentences)"""
CHUNKS = f"""{SENTENCES},
fold AS (
  SELECT document_id, i, CASE WHEN n > {fixed.CHUNK_MAX_TOKENS} THEN -1 ELSE n END AS held, 0 AS g
  FROM sized WHERE i = 1
  UNION ALL
  SELECT s.document_id, s.i,
    CASE WHEN s.n > {fixed.CHUNK_MAX_TOKENS} THEN -1
      WHEN f.held < 0 OR (f.held + s.n > {fixed.CHUNK_MAX_TOKENS} AND f.held >= {fixed.CHUNK_MIN_TOKENS}) THEN s.n
      ELSE f.held + s.n END,
    f.g + CASE WHEN s.n > {fixed.CHUNK_MAX_TOKENS} OR f.held < 0
      OR (f.held + s.n > {fixed.CHUNK_MAX_TOKENS} AND f.held >= {fixed.CHUNK_MIN_TOKENS}) THEN 1 ELSE 0 END
  FROM fold f JOIN sized s ON s.document_id = f.document_id AND s.i = f.i + 1),
joined AS (
  SELECT document_id, any_value(s3_key) AS s3_key, g AS chunk_index,
    string_agg(sentence, ' ' ORDER BY i) AS chunk_text
  FROM fold JOIN sentences USING (document_id, i) GROUP BY document_id, g),
chunks AS (
  SELECT *, CAST(greatest(1, length(chunk_text) // 4) AS INT) AS token_count,
    sha256(s3_key || '#' || chunk_index) AS chunk_id FROM joined)"""
INDEX = (
    "idx AS (SELECT document_id, s3_key, 0 AS chunk_index, CAST(embedding AS DOUBLE[]) AS embedding "
    "FROM embeddings JOIN docs ON vec_id = document_id)"
)
QUESTIONS = f"""questions AS (
  SELECT conv_id AS question_id, {pick(given.QUESTIONS, 'conv_id')} AS question,
    {pick(given.REPLIES, 'conv_id')} AS reply, {pick(given.ROUTE_REPLIES, 'conv_id')} AS route_reply,
    CAST(embedding AS DOUBLE[]) AS vector
  FROM (SELECT DISTINCT conv_id FROM conversations) LEFT JOIN embeddings ON vec_id = conv_id)"""
SCORED = """scored AS (
  SELECT question_id, s3_key, chunk_index, round(list_cosine_similarity(vector, embedding), 9) AS score
  FROM questions, idx WHERE vector IS NOT NULL)"""


def ranked(source: str) -> str:
    return f"""hits AS (
  SELECT question_id, rank, s3_key, chunk_index, score FROM (
    SELECT *, row_number() OVER (PARTITION BY question_id ORDER BY score DESC, s3_key, chunk_index) AS rank
    FROM {source}) WHERE rank <= {fixed.TOP_K})"""


HITS = f"{INDEX},\n{QUESTIONS},\n{SCORED},\n{ranked('scored')}"
EVIDENCE = f"""{CHUNKS},
{HITS},
evidence AS (
  SELECT question_id,
    string_agg('[source: ' || s3_key || ', chunk ' || chunk_index || ']' || chr(10) || chunk_text,
      chr(10) || chr(10) ORDER BY rank) AS context,
    string_agg(s3_key || '#' || chunk_index, ';' ORDER BY rank) AS sources,
    count(*) AS n_hits
  FROM hits JOIN chunks USING (s3_key, chunk_index) GROUP BY question_id)"""


def churn(source: str, user: str, time: str, period: str, name: str = "customer_metrics") -> str:
    step = {"day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAY", "month": "INTERVAL 1 MONTH"}[period]
    return f"""active AS (SELECT DISTINCT {user} AS u, CAST(date_trunc('{period}', {time}) AS DATE) AS d FROM {source}),
steps AS (SELECT u, d, CAST(d + {step} AS DATE) AS after FROM active),
{name} AS (
  SELECT p.after AS metric_date, CAST(count(*) AS BIGINT) AS total_customers,
    CAST(count(*) FILTER (WHERE n.u IS NULL) AS BIGINT) AS churned_customers,
    CAST(count(*) FILTER (WHERE n.u IS NULL) / count(*) AS DECIMAL(6,4)) AS churn_rate,
    '{source}.parquet' AS source_file
  FROM steps p LEFT JOIN active n ON n.u = p.u AND n.d = p.after
  WHERE p.after IN (SELECT d FROM active) GROUP BY p.after)"""


METRICS = churn("events", "user_id", "ts", "day")
METADATA = "glue_catalog_metadata AS (" + " UNION ALL ".join(
    f"SELECT '{table}' AS dataset_name, '{field}' AS column_name, 'STRING' AS data_type, "
    f"true AS is_required_field, {str(field in dict(columns_of(table))).lower()} AS is_present, "
    f"CAST(count(*) AS BIGINT) AS row_count, "
    f"CAST(count({field if field in dict(columns_of(table)) else 'NULL'}) AS BIGINT) AS filled_count FROM {table}"
    for table in COLUMNS
    for field in given.WANTED
) + ")"
CATALOG = "catalog AS (" + " UNION ALL ".join(
    f"SELECT '{table}' AS dataset_name, unnest([{', '.join(quoted(c) for c, _ in columns_of(table))}]) AS column_name, "
    f"unnest([{', '.join(quoted(t) for _, t in columns_of(table))}]) AS data_type, "
    f"(SELECT CAST(count(*) AS BIGINT) FROM {table}) AS row_count"
    for table in COLUMNS
) + ")"
STORED = (
    "structured_data AS (SELECT event_id AS record_id, 'raw/json/' || event_type AS source_file, "
    "'json' AS source_type, ts AS ingested_at, CAST(json(props) AS VARCHAR) AS raw_payload FROM events), document_embeddings AS (SELECT * FROM idx)"
)


def _result(sql: str) -> str:
    return sql.rstrip(";")


FACTS = "facts AS (" + " UNION ALL ".join(
    f"SELECT {quoted(sql)} AS sql, '[' || coalesce(string_agg(j, ',' ORDER BY j), '') || ']' AS rows "
    f"FROM (SELECT CAST(to_json(t) AS VARCHAR) AS j FROM ({_result(sql)}) t)"
    for sql in given.STATEMENTS.values()
) + ")"


def fence_free(expression: str) -> str:
    body = stripped(expression)
    inner = f"trim({body}, '`')"
    return (
        f"CASE WHEN starts_with({body}, '```') THEN "
        + stripped(f"CASE WHEN starts_with(lower({inner}), 'sql') THEN substr({inner}, 4) ELSE {inner} END")
        + f" ELSE {body} END"
    )


def guard_reason(expression: str) -> str:
    body = stripped(expression)
    upper = f"upper({body})"
    tests = " ".join(
        f"WHEN contains(' ' || {upper} || ' ', ' {k} ') OR starts_with({upper}, '{k}') "
        f"THEN '{fixed.REASON_KEYWORD.format(keyword=k)}'"
        for k in fixed.BLOCKED_KEYWORDS
    )
    return (
        f"CASE {tests} WHEN NOT starts_with({upper}, 'SELECT') THEN '{fixed.REASON_NOT_SELECT}' "
        f"WHEN contains(rtrim({body}, ';'), ';') THEN '{fixed.REASON_STACKED}' ELSE '{fixed.REASON_OK}' END"
    )


def by_words(expression: str) -> str:
    documents = f"regexp_matches(lower({expression}), '{'|'.join(routing.DOCUMENT_WORDS)}')"
    warehouse = f"regexp_matches(lower({expression}), '{'|'.join(routing.WAREHOUSE_WORDS)}')"
    return (
        f"CASE WHEN {documents} AND NOT {warehouse} THEN 'opensearch' "
        f"WHEN {warehouse} AND NOT {documents} THEN 'redshift' ELSE 'both' END"
    )


def filled(template: str, **values: str) -> str:
    expression = quoted(template)
    for name, value in values.items():
        expression = f"replace({expression}, '{{{name}}}', coalesce({value}, ''))"
    return expression


GUARDED_QUESTIONS = f"""guarded AS (
  SELECT *, CASE WHEN reason <> 'OK' THEN 'Refusing to execute query: ' || reason END AS blocked FROM (
    SELECT *, {guard_reason('sql_used')} AS reason FROM (
      SELECT *, {fence_free('reply')} AS sql_used, {by_words('question')} AS route FROM questions))),
known AS (
  SELECT g.*, CASE WHEN blocked IS NULL THEN f.rows END AS rows,
    CASE WHEN blocked IS NOT NULL THEN 'SQL: ' || sql_used || chr(10) || 'Execution blocked by validator: ' || blocked
      ELSE 'SQL: ' || sql_used || chr(10) || 'Results: ' || coalesce(f.rows, '') END AS facts
  FROM guarded g LEFT JOIN facts f ON f.sql = g.sql_used)"""
ANSWERS = f"""WITH RECURSIVE {EVIDENCE},
{METRICS},
{METADATA},
{FACTS},
{GUARDED_QUESTIONS},
answers AS (
  SELECT question_id, route, question,
    CASE WHEN route <> 'opensearch' THEN sql_used END AS sql_used,
    CASE WHEN route = 'redshift' THEN NULL
      WHEN route = 'opensearch' AND context IS NULL THEN NULL
      WHEN route = 'opensearch' THEN {filled(fixed.DOCUMENT_PROMPT, question='question', context='context')}
      ELSE {filled(fixed.SYNTHESIS_PROMPT, question='question', structured_data='facts',
                   document_context=f"coalesce(context, '{fixed.NO_DOCUMENT_CONTEXT}')")} END AS prompt,
    CASE WHEN route = 'redshift' THEN rows
      WHEN route = 'opensearch' AND context IS NULL THEN '{fixed.NO_DOCUMENT_ANSWER}' END AS answer,
    CASE WHEN route = 'redshift' THEN blocked END AS error,
    CASE route WHEN 'redshift' THEN 'Redshift' WHEN 'opensearch' THEN coalesce(sources, '')
      ELSE concat_ws(';', 'Redshift', sources) END AS sources,
    CAST(CASE route WHEN 'redshift' THEN 1 WHEN 'opensearch' THEN coalesce(n_hits, 0)
      ELSE 1 + coalesce(n_hits, 0) END AS INT) AS n_sources,
    route = 'both' AND coalesce(n_hits, 0) > 0 AS cites_both
  FROM known LEFT JOIN evidence USING (question_id))"""
CALLS = """calls AS (
  SELECT conv_id, turn, role AS call_type,
    CAST(CASE WHEN role = 'assistant' THEN 0 ELSE greatest(1, length(text) // 4) END AS BIGINT) AS input_tokens,
    CAST(CASE WHEN role = 'assistant' THEN greatest(1, length(text) // 4) ELSE 0 END AS BIGINT) AS output_tokens
  FROM conversations)"""
SPENT = (
    "CAST(count(*) AS BIGINT) AS calls, CAST(sum(input_tokens) AS BIGINT) AS input_tokens, "
    "CAST(sum(output_tokens) AS BIGINT) AS output_tokens, "
    "CAST(sum(3 * input_tokens + 15 * output_tokens) AS BIGINT) AS micro"
)
SUMMARY = f"""{CALLS},
summary AS (
  SELECT false AS is_total, call_type, {SPENT} FROM calls GROUP BY call_type
  UNION ALL SELECT true, NULL, {SPENT} FROM calls)"""
STATEMENT_LOG = f"""log AS (
  SELECT conv_id, turn, {pick([q for q, _ in given.GUARD_CASES], 'conv_id + turn')} AS query,
    list_extract([{', '.join(str(v).lower() for _, v in given.GUARD_CASES)}],
      CAST((conv_id + turn) % {len(given.GUARD_CASES)} AS INT) + 1) AS expected
  FROM conversations)"""
UPLOADS = f"""{DOCS}, uploads AS (
  SELECT s3_key AS key FROM docs
  UNION ALL SELECT 'raw/json/' || event_id || '.json' FROM events
  UNION ALL SELECT 'raw/csv/' || page_id || '.csv' FROM pages
  UNION ALL SELECT 'processed/' || doc_id || '.txt' FROM labels)"""
DATED = (
    "CAST(metric_date AS VARCHAR) AS metric_date, total_customers, churned_customers, "
    "CAST(churn_rate AS DOUBLE) AS churn_rate"
)

ORACLES = {
    "assemble_lines": "SELECT doc_id AS document_id, text FROM documents",
    "token_counts": "SELECT doc_id AS document_id, CAST(greatest(1, length(text) // 4) AS INT) AS token_count FROM documents",
    "split_sentences": f"WITH {SENTENCES} SELECT document_id, CAST(i - 1 AS INT) AS pos, sentence FROM sentences",
    "chunk_documents": f"WITH RECURSIVE {CHUNKS} SELECT document_id, chunk_index, chunk_text, token_count FROM chunks",
    "chunks_per_document": f"WITH RECURSIVE {CHUNKS} SELECT d.document_id, CAST(count(chunk_id) AS INT) AS chunks_created "
    "FROM docs d LEFT JOIN chunks c ON c.document_id = d.document_id GROUP BY d.document_id",
    "chunk_keys": f"WITH RECURSIVE {CHUNKS} SELECT s3_key, chunk_index, chunk_id FROM chunks",
    "embed_chunks": rf"WITH RECURSIVE {CHUNKS} SELECT document_id, chunk_index, {fixed.EMBEDDING_DIM} AS dim, "
    r"CASE WHEN regexp_matches(chunk_text, '[\p{L}\p{N}_]') THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS norm FROM chunks",
    "l2_normalize": "SELECT vec_id, CAST(i - 1 AS INT) AS pos, round(x / n, 6) AS x FROM (SELECT vec_id, "
    "generate_subscripts(v, 1) AS i, unnest(v) AS x, sqrt(list_inner_product(v, v)) AS n FROM (SELECT vec_id, "
    "list_transform(embedding, lambda x: x * 3.0::DOUBLE) AS v FROM embeddings))",
    "embedding_dim_check": f"WITH {DOCS}, {INDEX} SELECT s3_key, chunk_index, CAST(len(embedding) AS INT) AS dim, "
    "len(embedding) = (SELECT min(len(embedding)) FROM embeddings) AS matches FROM idx",
    "mirror_embeddings": f"WITH RECURSIVE {CHUNKS}, {INDEX} SELECT c.chunk_id, c.document_id, c.s3_key, c.chunk_text, "
    "c.chunk_id AS opensearch_doc_id, CAST(len(x.embedding) AS INT) AS dim, round(x.embedding[1], 6) AS first_value "
    "FROM chunks c JOIN idx x ON x.s3_key = c.s3_key AND x.chunk_index = c.chunk_index",
    "embeddings_with_facts": f"WITH {DOCS}, {INDEX} SELECT s3_key, chunk_index, CAST(count(*) AS BIGINT) AS records, "
    "CAST(sum(quality) AS BIGINT) AS quality, CAST(sum(toxic) AS BIGINT) AS toxic "
    "FROM idx JOIN labels ON doc_id = document_id GROUP BY s3_key, chunk_index",
    "knn_topk": f"WITH {DOCS}, {HITS} SELECT question_id, CAST(rank AS INT) AS rank, s3_key, chunk_index, "
    "round(score, 6) AS score FROM hits",
    "cited_context": f"WITH RECURSIVE {EVIDENCE} SELECT question_id, context, sources FROM evidence",
    "parse_route": f"WITH {QUESTIONS}, letters AS (SELECT question_id, route_reply, "
    "regexp_replace(upper(route_reply), '[^A-Z]', '', 'g') AS label FROM questions) "
    "SELECT question_id, route_reply, CASE WHEN contains(label, 'BOTH') THEN 'both' "
    "WHEN contains(label, 'OPENSEARCH') THEN 'opensearch' WHEN contains(label, 'REDSHIFT') THEN 'redshift' "
    "ELSE 'both' END AS route FROM letters",
    "route_questions": f"WITH {QUESTIONS} SELECT question_id, question, {by_words('question')} AS route FROM questions",
    "strip_fences": f"WITH {QUESTIONS} SELECT question_id, {fence_free('reply')} AS sql FROM questions",
    "render_prompts": "SELECT conv_id, turn, "
    f"{filled(fixed.ROUTING_PROMPT, question='text')} AS routing_prompt, "
    f"{filled(fixed.SQL_PROMPT, schema=quoted(fixed.WAREHOUSE_TABLES), question='text')} AS sql_prompt, "
    f"{filled(fixed.DOCUMENT_PROMPT, context='role', question='text')} AS document_prompt, "
    f"{filled(fixed.SYNTHESIS_PROMPT, structured_data='NULL', document_context='role', question='text')} "
    "AS synthesis_prompt FROM conversations",
    "validate_sql": f"WITH {STATEMENT_LOG} SELECT conv_id, turn, query, reason = 'OK' AS valid, reason FROM "
    f"(SELECT *, {guard_reason('query')} AS reason FROM log)",
    "guard_audit": f"WITH {STATEMENT_LOG} SELECT expected, CAST(count(*) FILTER (WHERE (reason = 'OK') = expected) AS BIGINT) "
    f"AS passed, CAST(count(*) AS BIGINT) AS total FROM (SELECT *, {guard_reason('query')} AS reason FROM log) GROUP BY expected",
    "document_answers": f"WITH RECURSIVE {EVIDENCE} SELECT question_id, question, "
    f"CASE WHEN context IS NOT NULL THEN {filled(fixed.DOCUMENT_PROMPT, question='question', context='context')} END AS prompt, "
    f"CASE WHEN context IS NULL THEN '{fixed.NO_DOCUMENT_ANSWER}' END AS answer, coalesce(sources, '') AS sources "
    "FROM questions LEFT JOIN evidence USING (question_id)",
    "synthesis_context": f"WITH RECURSIVE {EVIDENCE}, {METRICS}, {METADATA}, {FACTS}, {GUARDED_QUESTIONS}, ready AS (SELECT *, "
    f"coalesce(context, '{fixed.NO_DOCUMENT_CONTEXT}') AS shown FROM known LEFT JOIN evidence USING (question_id)) "
    "SELECT question_id, question, sql_used, facts, shown AS context, coalesce(sources, '') AS sources, "
    f"{filled(fixed.SYNTHESIS_PROMPT, question='question', structured_data='facts', document_context='shown')} AS prompt FROM ready",
    "answer_batch": f"{ANSWERS} SELECT question_id, route, question, sql_used, prompt, answer, error, sources FROM answers",
    "answer_records": f"{ANSWERS} SELECT question_id, route, sql_used, error IS NOT NULL AS refused, n_sources FROM answers",
    "citation_check": f"{ANSWERS} SELECT question_id, route, cites_both FROM answers",
    "run_outcomes": f"{ANSWERS} SELECT route, coalesce(answer, prompt, error) IS NOT NULL AS ok, "
    "CAST(count(*) AS BIGINT) AS questions, CAST(count(error) AS BIGINT) AS refused FROM answers GROUP BY 1, 2",
    "run_report": f"{ANSWERS}, {SUMMARY} SELECT 'query_results' AS section, CAST(json_object('question_id', question_id, "
    "'question', question, 'route', route, 'ok', coalesce(answer, prompt, error) IS NOT NULL) AS VARCHAR) AS line FROM answers "
    "UNION ALL SELECT 'cost_summary', '{\"is_total\":' || is_total || CASE WHEN is_total THEN '' ELSE ',\"call_type\":\"' || call_type "
    "|| '\"' END || ',\"calls\":' || calls || ',\"input_tokens\":' || input_tokens || ',\"output_tokens\":' || output_tokens || "
    "',\"cost_usd\":' || CAST(micro / 1e6 AS DECIMAL(18,6)) || ',\"avg_cost_per_call_usd\":' || "
    "CAST(micro / 1e6 / calls AS DECIMAL(18,6)) || ',\"price_per_million_input_tokens_usd\":3.0,"
    "\"price_per_million_output_tokens_usd\":15.0}' FROM summary",
    "customer_metrics": f"WITH {METRICS} SELECT {DATED}, source_file FROM customer_metrics",
    "customer_metrics_weekly": f"WITH {churn('events', 'user_id', 'ts', 'week')} SELECT {DATED} FROM customer_metrics",
    "order_metrics_monthly": f"WITH {churn('orders', 'o_custkey', 'o_orderdate', 'month')} SELECT {DATED} FROM customer_metrics",
    "high_churn": f"WITH {METRICS} SELECT {DATED}, source_file FROM customer_metrics WHERE churn_rate > 0.1",
    "churn_series": f"WITH {METRICS} SELECT CAST(metric_date AS VARCHAR) AS metric_date, CAST(churn_rate AS DOUBLE) "
    "AS churn_rate FROM customer_metrics ORDER BY metric_date",
    "avg_churn_quarter": f"WITH {METRICS} SELECT round(avg(CAST(churn_rate AS DOUBLE)), 6) AS avg_churn FROM customer_metrics "
    "WHERE metric_date >= DATE '2024-01-08' AND metric_date < DATE '2024-01-15'",
    "last_month_churned": f"WITH {METRICS} SELECT CAST(metric_date AS VARCHAR) AS metric_date, churned_customers "
    "FROM customer_metrics ORDER BY customer_metrics.metric_date DESC LIMIT 1",
    "total_customers": f"WITH {METRICS} SELECT CAST(sum(total_customers) AS BIGINT) AS total_customers FROM customer_metrics",
    "churn_trend": f"WITH {METRICS}, t AS (SELECT metric_date, churn_rate, lag(churn_rate) OVER (ORDER BY metric_date) AS previous "
    "FROM customer_metrics) SELECT CAST(metric_date AS VARCHAR) AS metric_date, CAST(churn_rate AS DOUBLE) AS churn_rate, "
    "CAST(previous AS DOUBLE) AS previous_rate, CAST(churn_rate - previous AS DOUBLE) AS change FROM t",
    "churn_vs_target": f"WITH {METRICS} SELECT CAST(metric_date AS VARCHAR) AS metric_date, CAST(churn_rate AS DOUBLE) AS churn_rate, "
    "0.1::DOUBLE AS target_rate, churn_rate <= 0.1 AS aligned FROM customer_metrics",
    "embedding_count": f"WITH {DOCS}, {INDEX} SELECT CAST(count(*) AS BIGINT) AS embedding_count FROM idx",
    "normalize_columns": "SELECT chr(9) || ' ' || event_id || '  ' AS event_id, chr(9) || ' ' || user_id || '  ' AS user_id, "
    "chr(9) || ' ' || event_type || '  ' AS event__type, CASE WHEN event_type = 'error' THEN ' n/a ' "
    "ELSE chr(9) || ' ' || value || '  ' END AS value, props AS \"x-props\" FROM events",
    "coerce_types": "SELECT props AS \"x-props\", event_id, user_id, event_type AS event__type, "
    "CASE WHEN event_type <> 'error' THEN value END AS value, CAST(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS INT) "
    "AS coercion_failures FROM events",
    "payload_extract": "SELECT 'raw/json/' || event_type AS source_file, 'json' AS source_type, event_id, value, "
    "CAST(json_extract_string(props, '$.k') AS INT) AS k FROM events",
    "by_source_file": "SELECT event_id, event_type AS source_file, value FROM events WHERE event_type = 'click'",
    "dataset_names": f"WITH {UPLOADS} SELECT key, string_split(key, '/')[-1] AS dataset_name FROM uploads",
    "route_files": f"WITH {UPLOADS} SELECT key, string_split(key, '/')[2] AS file_type, CASE WHEN key LIKE 'raw/pdf/%' "
    "THEN 'document_ingest' ELSE 'structured_load' END AS handler FROM uploads WHERE key LIKE 'raw/%'",
    "event_records": f"WITH {DOCS} SELECT 'uploads' AS bucket, s3_key AS key FROM docs "
    "UNION ALL SELECT 'uploads', replace(s3_key, 'pdf', 'json') FROM docs",
    "csv_scan": "SELECT event_id, user_id, event_type, value, props, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts FROM events",
    "csv_texts": "SELECT doc_id, text, source FROM documents",
    "json_scan": "SELECT conv_id, turn, role, text FROM conversations",
    "discover_schema": " UNION ALL ".join(
        f"SELECT '{table}' AS dataset_name, '{column}' AS column_name, '{kind}' AS data_type, "
        f"CAST(count({column}) AS BIGINT) AS occurrences FROM {table}"
        for table, column, kind in (
            ("events", "event_id", "bigint"),
            ("events", "user_id", "bigint"),
            ("events", "event_type", "string"),
            ("events", "props", "object<k: bigint>"),
            ("conversations", "conv_id", "bigint"),
            ("conversations", "turn", "bigint"),
            ("conversations", "role", "string"),
            ("conversations", "text", "string"),
        )
    ),
    "column_catalog": f"WITH {CATALOG} SELECT dataset_name, row_count, column_name, data_type FROM catalog",
    "list_datasets": f"WITH {CATALOG} SELECT DISTINCT dataset_name FROM catalog",
    "required_field_audit": f"WITH {METADATA} SELECT * FROM glue_catalog_metadata",
    "missing_fields": f"WITH {METADATA} SELECT dataset_name, column_name FROM glue_catalog_metadata WHERE NOT is_present",
    "metadata_completeness": f"WITH {METADATA} SELECT dataset_name, CAST(count(*) FILTER (WHERE is_present) AS BIGINT) "
    "AS present_count, CAST(count(*) AS BIGINT) AS required_count FROM glue_catalog_metadata GROUP BY dataset_name",
    "governance_gaps": f"WITH {METADATA} SELECT dataset_name, column_name FROM glue_catalog_metadata WHERE NOT is_present",
    "missing_by_dataset": f"WITH {METADATA} SELECT dataset_name, coalesce(string_agg(column_name, ',' ORDER BY CASE column_name "
    "WHEN 'doc_id' THEN 1 WHEN 'text' THEN 2 ELSE 3 END) FILTER (WHERE NOT is_present), '') AS missing "
    "FROM glue_catalog_metadata GROUP BY dataset_name",
    "latest_metadata": "SELECT dataset_name, column_name, is_present, event_id FROM (SELECT event_type AS dataset_name, "
    "'k' || json_extract_string(props, '$.k') AS column_name, value > 50 AS is_present, event_id, row_number() OVER "
    "(PARTITION BY event_type, json_extract_string(props, '$.k') ORDER BY ts DESC, event_id DESC) AS r FROM events) WHERE r = 1",
    "upsert_documents": f"WITH {DOCS} SELECT document_id, s3_key, CASE WHEN l THEN 'first' ELSE 'second' END AS source_bucket, "
    "CASE WHEN v THEN 'processed' ELSE 'pending' END AS status FROM (SELECT document_id, s3_key, "
    "document_id IN (SELECT doc_id FROM labels) AS l, document_id IN (SELECT vec_id FROM embeddings) AS v FROM docs) WHERE l OR v",
    "stream_documents": f"WITH RECURSIVE {CHUNKS} SELECT d.s3_key, sha256(d.s3_key) AS document_id, 'processed' AS status, "
    "CAST(count(c.chunk_id) AS BIGINT) AS chunks, CAST(coalesce(sum(c.token_count), 0) AS BIGINT) AS tokens "
    "FROM docs d LEFT JOIN chunks c ON c.document_id = d.document_id GROUP BY d.s3_key",
    "stream_structured": "SELECT 'raw/json/events.json' AS source_file, event_id AS record_id, event_type AS source_system, value FROM events",
    "call_cost": f"WITH {CALLS} SELECT conv_id, turn, (3 * input_tokens + 15 * output_tokens) / 1e6 AS cost_usd FROM calls",
    "cost_by_type": f"WITH {SUMMARY} SELECT call_type, calls, input_tokens, output_tokens, micro / 1e6 AS cost_usd "
    "FROM summary WHERE NOT is_total",
    "cost_summary": f"WITH {SUMMARY} SELECT is_total, call_type, calls, input_tokens, output_tokens, micro / 1e6 AS cost_usd, "
    "CAST(CAST(micro / 1e6 / calls AS DECIMAL(18,6)) AS DOUBLE) AS avg_cost_per_call_usd, "
    "3.0::DOUBLE AS price_per_million_input_tokens_usd, 15.0::DOUBLE AS price_per_million_output_tokens_usd FROM summary",
    "cost_report": f"WITH {SUMMARY} SELECT is_total, call_type, CASE WHEN is_total THEN '  TOTAL: calls=' || calls ELSE "
    "'  [' || call_type || '] calls=' || calls END || ' input_tokens=' || input_tokens || ' output_tokens=' || output_tokens || "
    "' cost=$' || CAST(micro / 1e6 AS DECIMAL(18,6)) || CASE WHEN is_total THEN ' (avg $' || "
    "CAST(micro / 1e6 / calls AS DECIMAL(18,6)) || '/call)' ELSE '' END AS line FROM summary",
}
LETTER_COUNTS = ", ".join(f"length(chunk_text) - length(replace(chunk_text, '{c}', ''))" for c in LETTERS)
RENEWED = CHUNKS.replace("FROM documents)", "FROM renewed)", 1)
ORACLES["stored_versions"] = (
    "WITH RECURSIVE renewed AS (SELECT * REPLACE (CASE WHEN doc_id NOT IN (SELECT doc_id FROM labels) THEN text "
    "WHEN doc_id % 2 = 0 THEN 'Second delivery. ' || text END AS text) FROM documents), "
    f"{RENEWED} SELECT s3_key, CAST(chunk_index AS INT) AS chunk_index, chunk_id, chunk_text, token_count, "
    f"array_to_string([{LETTER_COUNTS}], ',') AS vector FROM chunks"
)
ORACLES["knn_topk_pruned"] = ORACLES["knn_topk"]


def _guarded(name: str, sql: str) -> str:
    columns = {
        "guarded_churn_series": "CAST(metric_date AS VARCHAR) AS metric_date, CAST(churn_rate AS DOUBLE) AS churn_rate",
        "guarded_completeness": "dataset_name, CAST(present_count AS BIGINT) AS present_count, "
        "CAST(required_count AS BIGINT) AS required_count",
        "guarded_high_churn": f"{DATED}, source_file",
        "guarded_by_source": "* REPLACE (strftime(ingested_at, '%Y-%m-%d %H:%M:%S.%f') AS ingested_at)",
    }.get(name, "*")
    return f"WITH {DOCS}, {INDEX}, {METRICS}, {METADATA}, {STORED} SELECT {columns} FROM ({_result(sql)}) t"


ORACLES.update({name: _guarded(name, sql) for name, sql in GUARDED.items()})
ORACLES.update({
    name: f"WITH RECURSIVE {CHUNKS}, {INDEX}, {METRICS}, {METADATA}, {STORED} {sql}" for name, (_, sql) in DECLARED.items()
})
ORACLES["stream_uploads"] = """
SELECT 'raw/csv/event_type=' || event_type || '/' AS folder, 'csv' AS source_type, event_type AS dataset,
  CAST(event_id AS BIGINT) AS record_id, event_type AS source_system, CAST(NULL AS BIGINT) AS conv_id,
  CAST(NULL AS BIGINT) AS turn, CAST(NULL AS INT) AS n_chars
FROM events
UNION ALL
SELECT 'raw/json/role=' || role || '/', 'json', role, NULL, NULL, CAST(conv_id AS BIGINT), CAST(turn AS BIGINT),
  CAST(length(text) AS INT)
FROM conversations
"""
LINES = """lines AS (
  SELECT 'rows' AS d, to_json({'key': event_id, 'value': value}) AS j FROM events
  UNION ALL SELECT 'rows', to_json({'key': conv_id, 'value': text}) FROM conversations
  UNION ALL SELECT 'props', CAST(props AS JSON) FROM events WHERE json_valid(props))"""
ORACLES["merged_schema"] = f"""
WITH {LINES}, keys AS (SELECT d, j, unnest(json_keys(j)) AS k FROM lines),
types AS (SELECT d, k, json_type(j, '$.' || k) AS t FROM keys)
SELECT d AS dataset_name, k AS column_name,
  CASE WHEN bool_and(t IN ('BIGINT', 'UBIGINT')) THEN 'bigint'
    WHEN bool_and(t IN ('BIGINT', 'UBIGINT', 'DOUBLE')) THEN 'double' ELSE 'string' END AS data_type,
  CAST(count(*) AS BIGINT) AS occurrences
FROM types WHERE t <> 'NULL' GROUP BY d, k
"""
ORACLES["unparsed_records"] = """
SELECT * FROM (
  SELECT 'texts' AS dataset_name, CAST(count(text) AS BIGINT) AS occurrences FROM conversations
  UNION ALL SELECT 'props', CAST(count(*) AS BIGINT) FROM events WHERE NOT json_valid(props)) t WHERE occurrences > 0
"""
