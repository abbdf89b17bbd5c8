"""Guard, routes, prompts, costs, vectors, keys and the structured path."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane import fixed_values as fixed
from corvane.functions import costs, guard, keys, prompts, routing, vectors
from corvane.operators import audit, embedding, etl, metrics
from corvane.operators import costs as cost_plans
from corvane.plans.tables import GUARD_CASES, open_warehouse
from corvane.schemas import table_schema
from corvane.sources.warehouse import RefusedStatement, run_guarded


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")
    return [r[1] for r in df.select("i", expression(F.col("v"))).orderBy("i").collect()]


def test_guard(spark):
    queries = [q for q, _ in GUARD_CASES] + [None]
    reasons = column(spark, queries, "string", guard.guard_reason)
    assert [r == "OK" for r in reasons] == [v for _, v in GUARD_CASES] + [False]
    named = dict(zip(queries, reasons))
    assert named["DROP TABLE structured_data"] == "Blocked: DROP not permitted"
    assert named["SELECT * FROM customer_metrics; DROP TABLE customer_metrics;"] == "Blocked: DROP not permitted"
    assert named["SELECT 1;DROP TABLE t"] == "Blocked: multiple/stacked statements not permitted"
    assert named["UPDATED"] == "Blocked: UPDATE not permitted"
    assert named[""] == "Only SELECT queries are permitted"


def test_guarded_read(spark):
    spark.range(5).createOrReplaceTempView("five")
    assert run_guarded(spark, " select count(*) AS n from five; ").first().n == 5
    with pytest.raises(RefusedStatement, match="Refusing to execute query: Blocked: DROP not permitted"):
        run_guarded(spark, "DROP TABLE five")


def test_the_plan_of_a_statement_is_guarded(spark, tmp_path):
    spark.range(5).createOrReplaceTempView("five")
    file = str(tmp_path / "f")
    spark.range(3).write.parquet(file)
    spark.udf.register("own_code", lambda: 1)
    for sql in (
        f"SELECT * FROM parquet.`{file}`",
        f"SELECT (SELECT max(id) FROM parquet.`{file}`) AS m FROM five",
        f"SELECT id FROM five WHERE id IN (SELECT id FROM parquet.`{file}`)",
        f"SELECT * FROM (WITH a AS (SELECT * FROM parquet.`{file}`) SELECT * FROM a)",
        "SELECT * FROM IDENTIFIER('fi' || 've')",
        "SELECT reflect('java.lang.System', 'getProperty', 'user.home') AS h",
        "SELECT transform(array(1), x -> java_method('java.lang.System', 'nanoTime')) AS h",
        "SELECT IDENTIFIER('refl' || 'ect')('java.lang.System', 'nanoTime') AS h",
        "SELECT own_code() AS h",
        "SELECT * FROM range(5)",
        "SELECT TRANSFORM(id) USING 'cat' AS (b) FROM five",
        "SELECT * FROM unknown_table",
        "SELECT * FROM a.b.five",
    ):
        with pytest.raises(RefusedStatement, match="Refusing to execute query: Blocked"):
            run_guarded(spark, sql)
    joined = "SELECT f.id, count(*) OVER (PARTITION BY f.id) AS n FROM five f JOIN (SELECT id FROM `five` WHERE id > 2) g ON f.id = g.id"
    assert sorted(tuple(r) for r in run_guarded(spark, joined).collect()) == [(3, 1), (4, 1)]
    assert run_guarded(spark, "SELECT t.x FROM five LATERAL VIEW explode(array(1, 2)) t AS x").count() == 10


def test_the_warehouse_has_a_session_of_its_own(spark):
    spark.range(7).createOrReplaceTempView("customer_metrics")
    own = open_warehouse(spark, "/root/testdata/sf0.001")
    for name in ("document_embeddings", "structured_data", "customer_metrics", "glue_catalog_metadata"):
        declared = table_schema(name)
        found = own.table(name).schema
        assert found.fieldNames() == declared.fieldNames()
        keys = ("record_id", "document_id")
        assert [f.dataType for f in found if f.name not in keys] == [f.dataType for f in declared if f.name not in keys], name
    assert spark.table("customer_metrics").count() == 7
    assert {v.name for v in spark.catalog.listTables()}.isdisjoint({"structured_data", "glue_catalog_metadata"})
    spark.catalog.dropTempView("customer_metrics")
    assert own.conf.get("spark.sql.shuffle.partitions") == spark.conf.get("spark.sql.shuffle.partitions")


def test_routes(spark):
    replies = ["BOTH", "Opensearch.", "**REDSHIFT**", "not both", "?", "REDSHIFT or OPENSEARCH", "red shift"]
    expected = ["both", "opensearch", "redshift", "both", "both", "opensearch", "redshift"]
    assert column(spark, replies, "string", routing.parse_route) == expected
    asked = {
        "What is the average churn rate for Q3 2026?": "redshift",
        "What does our documented retention strategy recommend for at-risk customers?": "opensearch",
        "Does our current customer churn rate (from the data warehouse) align with what our documented "
        "retention strategy says we should be seeing?": "both",
        "Based on our data governance policy documents, are any of the currently-ingested datasets missing "
        "required metadata fields (check against the Glue Catalog)?": "both",
        "Hello?": "both",
    }
    assert column(spark, list(asked), "string", routing.route_by_words) == list(asked.values())


def test_fences(spark):
    replies = ["SELECT 1", " ```sql\nSELECT 1\n``` ", "```SELECT 1```", "```SQL SELECT `a` FROM t```", "sql"]
    expected = ["SELECT 1", "SELECT 1", "SELECT 1", "SELECT `a` FROM t", "sql"]
    assert column(spark, replies, "string", routing.strip_fences) == expected


def test_prompts_take_values_literally(spark):
    values = ["{context} 100% $1", None]
    got = column(spark, values, "string", lambda v: prompts.document_prompt(v, F.lit("C")))
    assert got[0] == fixed.DOCUMENT_PROMPT.replace("{context}", "C").replace("{question}", values[0])
    assert got[1] == fixed.DOCUMENT_PROMPT.replace("{context}", "C").replace("{question}", "")


def test_costs(spark):
    calls = spark.createDataFrame(
        [("a", 1000, 200), ("a", 1, 0), ("b", 0, 1)], "call_type string, input_tokens long, output_tokens long"
    )
    by_type = {r.call_type: r.cost_usd for r in cost_plans.cost_by_type(calls).collect()}
    assert by_type == {"a": Decimal("0.006003"), "b": Decimal("0.000015")}
    total = cost_plans.cost_summary(calls).filter("is_total").first()
    assert (total.calls, total.cost_usd, total.avg_cost_per_call_usd) == (3, Decimal("0.006018"), Decimal("0.002006"))


def test_costs_of_an_empty_log(spark):
    none = spark.createDataFrame([], "call_type string, input_tokens long, output_tokens long")
    (total,) = cost_plans.cost_summary(none).collect()
    assert total.is_total and total.calls == 0 and total.cost_usd == 0 and total.avg_cost_per_call_usd == 0
    assert cost_plans.cost_report(none).first().line == (
        "  TOTAL: calls=0 input_tokens=0 output_tokens=0 cost=$0.000000 (avg $0.000000/call)"
    )


def test_latency(spark):
    start = dt.datetime(2024, 1, 1)
    end = start + dt.timedelta(milliseconds=12, microseconds=340)
    df = spark.createDataFrame([(start, end)], "a timestamp, b timestamp")
    assert df.select(costs.latency_ms(F.col("a"), F.col("b"))).first()[0] == 12.3


def test_vectors(spark):
    df = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],), ([1.0],), (None,), ([1.0, None],)], "v array<float>")
    rows = df.select(vectors.l2_normalize(F.col("v")).alias("u"), vectors.searchable(F.col("v"), 2).alias("s")).collect()
    assert rows[0].u == pytest.approx([0.6, 0.8]) and rows[1].u == [0.0, 0.0]
    assert [r.s for r in rows] == [True, False, False, False, False]


def test_keys(spark):
    paths = ["raw/pdf/a/b.pdf", "raw/csv/x.csv", "raw/json/y", "processed/raw/pdf/z", "charts/q.png"]
    handlers = ["document_ingest", "structured_load", "structured_load", None, None]
    assert column(spark, paths, "string", keys.upload_handler) == handlers
    assert column(spark, paths, "string", keys.upload_type) == ["pdf", "csv", "json", None, None]
    assert column(spark, paths, "string", keys.dataset_name) == ["b.pdf", "x.csv", "y", "z", "q.png"]


def test_column_names(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], [" Record ID", "Source System", "A  b", "X-Y"])
    assert etl.normalize_columns(df).columns == ["record_id", "source_system", "a__b", "x-y"]
    with pytest.raises(ValueError, match="a_b"):
        etl.normalize_columns(df.toDF("A b", "a_b", "c", "d"))


def test_coercion_and_payload(spark):
    rows = [(" 1 ", "2024-01-02", " x "), ("\tno", "", None), (None, "later", "y")]
    df = spark.createDataFrame(rows, "n string, d string, s string")
    typed = etl.coerce_types(df, T.StructType.fromDDL("n int, d date, s string"))
    got = [tuple(r) for r in typed.collect()]
    assert got == [(1, dt.date(2024, 1, 2), "x", 0), (None, None, None, 1), (None, None, "y", 1)]
    packed = etl.pack_payload(typed, F.lit("f"), F.lit("csv"))
    assert packed.select(etl.payload_field(F.col("raw_payload"), "n", "int")).first()[0] == 1


def test_audit(spark):
    full = spark.createDataFrame([(1, 2, None), (1, None, None)], "record_id int, source_system int, record_date date")
    datasets = {"full": full, "part": full.select("record_id"), "empty": full.filter("false")}
    rows = audit.required_field_audit(datasets).collect()
    got = {(r.dataset_name, r.column_name): (r.is_present, r.row_count, r.filled_count) for r in rows}
    assert got == {
        ("full", "record_date"): (True, 2, 0), ("full", "source_system"): (True, 2, 1), ("full", "record_id"): (True, 2, 2),
        ("part", "record_date"): (False, 2, 0), ("part", "source_system"): (False, 2, 0), ("part", "record_id"): (True, 2, 2),
        ("empty", "record_date"): (True, 0, 0), ("empty", "source_system"): (True, 0, 0), ("empty", "record_id"): (True, 0, 0),
    }
    catalog = audit.column_catalog(datasets)
    assert {tuple(r) for r in audit.governance_gaps(catalog).collect()} == {
        ("part", "record_date"), ("part", "source_system")
    }
    missing = {r.dataset_name: r.missing for r in audit.missing_by_dataset(catalog).collect()}
    assert missing == {"full": [], "part": ["record_date", "source_system"], "empty": []}


def test_churn_with_gaps_and_a_heavy_user(spark):
    days = [("u", d) for d in (1, 2, 4)] + [("v", d) for d in (1, 4, 5)] + [("w", 2)] + [("u", 1)] * 500
    rows = [(u, dt.datetime(2024, 3, d, 5)) for u, d in days]
    activity = spark.createDataFrame(rows, "user_id string, ts timestamp")
    got = {r.metric_date.day: (r.total_customers, r.churned_customers, r.churn_rate) for r in metrics.customer_metrics(activity).collect()}
    # Day 3 has no activity, so it has no row; days 1 and 4 follow no active day.
    assert got == {2: (2, 1, Decimal("0.5000")), 5: (2, 1, Decimal("0.5000"))}


def test_default_encoder(spark):
    df = spark.createDataFrame([(1, "b a"), (2, "a b"), (3, "c"), (4, ""), (5, None)], "i int, t string")
    rows = embedding.hashing_encoder(16)(df, "t", "e").orderBy("i").collect()
    assert rows[0].e == rows[1].e != rows[2].e
    norms = [round(float(np.linalg.norm(r.e)), 4) for r in rows]
    assert norms == [1, 1, 1, 0, 0] and len(rows[0].e) == 16


def test_model_encoder_loads_once_per_worker(spark):
    def load():
        state = {"calls": 0}

        def model(texts):
            state["calls"] += 1
            assert len(texts) <= 2
            return [[float(len(t)), float(state["calls"])] for t in texts]

        return model

    df = spark.createDataFrame([(i, "x" * (i + 1)) for i in range(5)], "i int, t string").coalesce(1)
    rows = embedding.model_encoder(load, batch=2)(df, "t", "e").orderBy("i").collect()
    ratios = [round(r.e[0] / r.e[1], 3) for r in rows]
    assert ratios == [1.0, 2.0, 1.5, 2.0, 1.667]
