"""Fixed values that results depend on: limits, labels, word lists, messages
and prompt templates. Everything here is data, stated as text."""

# Chunk limits in tokens, and the heuristic counter's characters per token.
CHUNK_MIN_TOKENS = 500
CHUNK_MAX_TOKENS = 1000
CHARS_PER_TOKEN = 4

# Retrieval defaults.
TOP_K = 5
EF_SEARCH = 100
EMBEDDING_DIM = 384
ENCODER_BATCH = 32

# Prices in dollars per million tokens.
INPUT_PRICE = 3
OUTPUT_PRICE = 15

# Upload key prefixes and the handler each one feeds.
UPLOAD_HANDLERS = {
    "raw/pdf/": "document_ingest",
    "raw/csv/": "structured_load",
    "raw/json/": "structured_load",
}

# Columns every structured dataset must have.
REQUIRED_FIELDS = ("record_date", "source_system", "record_id")

# Statements the guard blocks, in the order they are tested, and its reasons.
BLOCKED_KEYWORDS = (
    "DROP",
    "DELETE",
    "UPDATE",
    "INSERT",
    "ALTER",
    "TRUNCATE",
    "GRANT",
    "REVOKE",
)
REASON_KEYWORD = "Blocked: {keyword} not permitted"
REASON_NOT_SELECT = "Only SELECT queries are permitted"
REASON_STACKED = "Blocked: multiple/stacked statements not permitted"
REASON_OK = "OK"
REFUSAL = "Refusing to execute query: {reason}"

# Route labels in the order a reply is tested for them.
ROUTE_BOTH = "both"
ROUTE_DOCUMENTS = "opensearch"
ROUTE_WAREHOUSE = "redshift"
ROUTE_LABELS = (
    ("BOTH", ROUTE_BOTH),
    ("OPENSEARCH", ROUTE_DOCUMENTS),
    ("REDSHIFT", ROUTE_WAREHOUSE),
)

# How the warehouse is named in an answer's source list.
WAREHOUSE_SOURCE = "Redshift"

# Sentences used where retrieval gives nothing.
NO_DOCUMENT_ANSWER = "No relevant document context was found for this question."
NO_DOCUMENT_CONTEXT = "No relevant document context found."

# Warehouse tables as the SQL prompt describes them.
WAREHOUSE_TABLES = """
Tables available in the Redshift warehouse:

structured_data(record_id, source_file, source_type, ingested_at, raw_payload)
document_embeddings(chunk_id, document_id, s3_key, chunk_text, embedding_vector, opensearch_doc_id, loaded_at)
customer_metrics(metric_date, total_customers, churned_customers, churn_rate, source_file)
glue_catalog_metadata(dataset_name, column_name, data_type, is_required_field, is_present, catalog_synced_at)
"""

# Prompt templates.
ROUTING_PROMPT = """You are a query router for a data platform with two backends:

- OPENSEARCH: semantic search over unstructured document text (policies, strategy docs, governance docs, PDFs).
- REDSHIFT: SQL queries over structured data (customer metrics, churn rates, Glue catalog metadata, counts, aggregates).

Classify the question below into exactly one label: OPENSEARCH, REDSHIFT, or BOTH.
Use BOTH only when the question requires combining a documented policy/strategy (OPENSEARCH)
with a structured/numeric fact (REDSHIFT) into a single synthesized answer.

Question: {question}

Respond with exactly one word: OPENSEARCH, REDSHIFT, or BOTH."""

SQL_PROMPT = """You write read-only SQL for a Redshift warehouse.

Schema:
{schema}

Rules:
- Only ever write a single SELECT statement.
- Never write DROP, DELETE, UPDATE, INSERT, ALTER, TRUNCATE, GRANT, or REVOKE.
- Never write more than one statement (no semicolon-separated stacked statements).
- Return ONLY the SQL query, no explanation, no markdown code fences.

Question: {question}

SQL query:"""

DOCUMENT_PROMPT = """Answer the question using ONLY the source excerpts below.
Cite each fact you use by its [source: s3_key, chunk N] tag. If the excerpts
don't contain the answer, say so explicitly rather than guessing.

Source excerpts:
{context}

Question: {question}

Answer (with inline citations):"""

SYNTHESIS_PROMPT = """You are answering a question that requires combining two sources:

1. STRUCTURED DATA (from the Redshift data warehouse):
{structured_data}

2. DOCUMENT CONTEXT (from company policy/strategy documents):
{document_context}

Write ONE unified answer that directly addresses the question by combining
both sources -- do not answer them separately. Explicitly state whether the
structured data aligns with, or is missing something required by, the
document context. Cite the structured data as [source: Redshift] and each
document excerpt as [source: s3_key, chunk N].

Question: {question}

Unified answer:"""

# Layout of one cited excerpt.
CITATION = "[source: {s3_key}, chunk {chunk_index}]\n{chunk_text}"

# Layout of the structured part of a synthesis prompt.
FACTS_FOUND = "SQL: {sql}\nResults: {rows}"
FACTS_BLOCKED = "SQL: {sql}\nExecution blocked by validator: {message}"
