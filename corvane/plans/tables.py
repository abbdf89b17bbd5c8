"""The model's tables over the given parquet tables.

Uploads are the rows of ``documents``, user activity is ``events``, questions
are the conversations, model calls their turns, and vectors ``embeddings``.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions.keys import chunk_key
from corvane.operators.audit import column_catalog, required_field_audit
from corvane.operators.chunking import chunk_text_at
from corvane.operators.knn import dimension
from corvane.operators.metrics import customer_metrics
from corvane.schemas import table_schema
from corvane.session import fresh_path, side_by_side
from corvane.sinks.tables import calls_from_texts
from corvane.sources.files import spread
from corvane.sources.warehouse import own_session

TABLE_NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem",
    "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)

# Required columns asked of the given tables: some have all, some a few, most none.
WANTED = ("doc_id", "text", "lang")

# The ten questions of a run.
QUESTIONS = (
    "What is the average churn rate for Q3 2026?",
    "How many customers churned in the last recorded month?",
    "What does our documented retention strategy recommend for at-risk customers?",
    "What onboarding steps does our customer success playbook describe?",
    "List all datasets currently catalogued by Glue.",
    "What is the total customer count across all recorded months?",
    "What does our data governance policy say about required metadata fields?",
    "Does our current customer churn rate (from the data warehouse) align with what "
    "our documented retention strategy says we should be seeing?",
    "Based on our data governance policy documents, are any of the currently-ingested "
    "datasets missing required metadata fields (check against the Glue Catalog)?",
    "What is the churn rate trend compared to what our retention strategy targets?",
)

# Statements that answer them, and how a model might reply with one: plain,
# fenced, tagged, and some the guard refuses.
STATEMENTS = {
    "average": "SELECT CAST(AVG(CAST(churn_rate AS DOUBLE)) AS DECIMAL(6,4)) AS avg_churn FROM customer_metrics",
    "last": "SELECT MAX_BY(churned_customers, metric_date) AS churned FROM customer_metrics",
    "datasets": "SELECT DISTINCT dataset_name FROM glue_catalog_metadata",
    "total": "SELECT CAST(SUM(total_customers) AS BIGINT) AS total FROM customer_metrics",
    "missing": "SELECT dataset_name, column_name FROM glue_catalog_metadata WHERE is_present = false",
    "high": "SELECT COUNT(*) AS n FROM customer_metrics WHERE churn_rate > 0.1;",
}
REPLIES = (
    STATEMENTS["average"],
    f"```sql\n{STATEMENTS['last']}\n```",
    STATEMENTS["datasets"],
    "DROP TABLE customer_metrics",
    f"  {STATEMENTS['datasets']}\n",
    f"```\n{STATEMENTS['total']}\n```",
    STATEMENTS["missing"],
    f"```SQL {STATEMENTS['high']}```",
    STATEMENTS["missing"],
    "SELECT churn_rate FROM customer_metrics; DROP TABLE customer_metrics;",
)

# How a model might reply when asked for a route.
ROUTE_REPLIES = (
    "BOTH", "Opensearch.", "**REDSHIFT**", "not both", "?", "REDSHIFT or OPENSEARCH",
    "redshift\n", "open search", "The answer is: both", "",
)

# The statements the guard is tested with, and whether they pass;
# then edge cases of its rules.
GUARD_CASES = (
    ("SELECT * FROM customer_metrics WHERE churn_rate > 0.1", True),
    ("select dataset_name from glue_catalog_metadata where is_present = false", True),
    ("SELECT * FROM customer_metrics; DROP TABLE customer_metrics;", False),
    ("DELETE FROM structured_data WHERE record_id = 1", False),
    ("UPDATE customer_metrics SET churn_rate = 0", False),
    ("INSERT INTO customer_metrics VALUES (CURRENT_DATE, 100, 5, 0.05, 'x')", False),
    ("GRANT ALL ON customer_metrics TO PUBLIC", False),
    ("SELECT * FROM structured_data WHERE source_file = 'a'; SELECT * FROM customer_metrics;", False),
    ("DROP TABLE structured_data", False),
    ("SELECT * FROM customer_metrics WHERE churn_rate > 0.1;", True),
    ("SELECT churn_rate FROM customer_metrics; DROP TABLE customer_metrics;", False),
    ("select dataset_name, column_name from glue_catalog_metadata where is_present = false", True),
    ("SELECT COUNT(*) FROM document_embeddings", True),
    # further edges of the rules
    ("SELECT 1;DROP TABLE t", False),
    ("SELECT ' drop '", False),
    ("SELECT 'a;b'", False),
    ("SELECT 1; ;", False),
    ("SELECT 1;;", True),
    ("WITH a AS (SELECT 1) SELECT * FROM a", False),
    ("UPDATED", False),
    ("SELECT * INTO t2 FROM t", True),
    ("", False),
    ("\t select 1 \n", True),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def pick(values: tuple[str, ...], by: Column) -> Column:
    """One of a few texts for each row, by a number."""
    return F.get(F.array(*map(F.lit, values)), F.pmod(by, F.lit(len(values))).cast("int"))


def s3_key() -> Column:
    return F.concat(
        F.lit("raw/pdf/"), F.col("source"), F.lit("/"), F.col("doc_id").cast("string"), F.lit(".pdf")
    )


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """document_id, s3_key, text."""
    uploads = table(spark, sf_dir, "documents")
    return uploads.select(F.col("doc_id").alias("document_id"), s3_key().alias("s3_key"), "text")


def spread_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(documents(spark, sf_dir), "document_id")


def vector_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given vectors as the vectors of each document's first chunk."""
    owners = documents(spark, sf_dir).select("document_id", "s3_key")
    vectors = table(spark, sf_dir, "embeddings")
    return vectors.join(owners, F.col("vec_id") == F.col("document_id")).select(
        "document_id", "s3_key", F.lit(0).alias("chunk_index"), "embedding"
    )


def dim(spark: SparkSession, sf_dir: str) -> int:
    """The dimension of the given vectors."""
    return dimension(table(spark, sf_dir, "embeddings"), "embedding")


def questions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One question per conversation with its vector and a model's two replies."""
    asked = table(spark, sf_dir, "conversations").select("conv_id").distinct()
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    number = F.col("conv_id")
    return asked.join(vectors, number == F.col("vec_id"), "left").select(
        number.alias("question_id"),
        pick(QUESTIONS, number).alias("question"),
        "vector",
        pick(REPLIES, number).alias("sql"),
        pick(ROUTE_REPLIES, number).alias("route_reply"),
    )


def metrics(spark: SparkSession, sf_dir: str, **range_of: dt.date) -> DataFrame:
    return customer_metrics(table(spark, sf_dir, "events"), source_file="events.parquet", **range_of)


def given(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    frames = side_by_side(spark, [partial(table, spark, sf_dir, name) for name in TABLE_NAMES])
    return dict(zip(TABLE_NAMES, frames))


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return required_field_audit(given(spark, sf_dir), WANTED)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_catalog(given(spark, sf_dir))


def calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return calls_from_texts(table(spark, sf_dir, "conversations"))


def statement_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log of statements to guard, one per conversation turn."""
    which = F.col("conv_id") + F.col("turn")
    expected = F.get(
        F.array(*[F.lit(valid) for _, valid in GUARD_CASES]),
        F.pmod(which, F.lit(len(GUARD_CASES))).cast("int"),
    )
    return table(spark, sf_dir, "conversations").select(
        "conv_id", "turn", pick(tuple(q for q, _ in GUARD_CASES), which).alias("query"),
        expected.alias("expected"),
    )


def metadata_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as successive synchronisations of a dataset's columns."""
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("dataset_name"),
        F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("column_name"),
        F.struct("ts", "event_id").alias("catalog_synced_at"),
        (F.col("value") > 50).alias("is_present"),
        "event_id",
    )


def uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys of uploads of every kind, one per document, event and page."""
    def keys(name: str, prefix: str, key: str, suffix: str) -> DataFrame:
        path = F.concat(F.lit(prefix), F.col(key).cast("string"), F.lit(suffix))
        return table(spark, sf_dir, name).select(path.alias("key"))

    parts = [
        documents(spark, sf_dir).select(F.col("s3_key").alias("key")),
        keys("events", "raw/json/", "event_id", ".json"),
        keys("pages", "raw/csv/", "page_id", ".csv"),
        keys("labels", "processed/", "doc_id", ".txt"),
    ]
    return reduce(DataFrame.unionByName, parts)


def open_warehouse(spark: SparkSession, sf_dir: str) -> SparkSession:
    """A session of its own with the warehouse tables, as declared, for guarded statements.

    The two small ones, a row per date and a row per audited field, are loaded into
    the shared folder first, as the structured path would have done. The others are
    views: a statement computes the columns that it names. The caller's session sees none of them.
    """
    own = own_session(spark)

    def load(name: str, build: Callable[[SparkSession, str], DataFrame]) -> None:
        df, path = build(own, sf_dir), fresh_path(own, name)
        df.write.parquet(path)
        own.read.schema(df.schema).parquet(path).createOrReplaceTempView(name)

    side_by_side(
        own,
        [partial(load, "customer_metrics", metrics), partial(load, "glue_catalog_metadata", synced_metadata)],
    )
    document_embeddings(own, sf_dir).createOrReplaceTempView("document_embeddings")
    structured_data(own, sf_dir).createOrReplaceTempView("structured_data")
    return own


def synced_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    synced = metadata(spark, sf_dir).withColumn("catalog_synced_at", F.current_timestamp())
    return synced.select(*table_schema("glue_catalog_metadata").fieldNames())


def document_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The given vectors with their chunk's text, as the warehouse declares them."""
    chunks = vector_index(spark, sf_dir).join(documents(spark, sf_dir).select("document_id", "text"), "document_id")
    made = {
        "chunk_id": chunk_key(F.col("s3_key"), F.col("chunk_index")),
        "embedding_vector": F.col("embedding").cast("array<float>"),
        "opensearch_doc_id": F.lit(None).cast("string"),
        "loaded_at": F.current_timestamp(),
    }
    names = table_schema("document_embeddings").fieldNames()
    return chunk_text_at(chunks).select(*(made.get(c, F.col(c)).alias(c) for c in names))


def structured_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as rows of an upload, with what they carry as a variant."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("record_id"),
        F.concat(F.lit("raw/json/"), "event_type").alias("source_file"),
        F.lit("json").alias("source_type"),
        F.col("ts").cast("timestamp").alias("ingested_at"),
        F.try_parse_json("props").alias("raw_payload"),
    )
