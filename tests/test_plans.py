"""What the plans must look like to hold at scale."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from corvane.operators import audit, metrics
from corvane.operators import costs as cost_plans
from corvane.plans import tables as given
from corvane.plans.registry import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["token_counts", "normalize_columns", "coerce_types", "payload_extract", "by_source_file",
             "event_records", "validate_sql", "render_prompts", "call_cost", "l2_normalize", "dataset_names"],
)
def test_row_by_row_queries_do_not_shuffle(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "Exchange" not in plan and "Python" not in plan


@pytest.mark.parametrize("name", ["token_counts", "chunks_per_document", "split_sentences", "embed_chunks"])
def test_text_stays_in_the_jvm(spark, name):
    assert "Python" not in plan_of(QUERIES[name](spark, SF_DIR))


def test_filters_and_columns_reach_the_scan(spark):
    plan = plan_of(QUERIES["by_source_file"](spark, SF_DIR))
    assert "EqualTo(event_type,click)" in plan
    assert "ReadSchema: struct<event_id:bigint,event_type:string,value:double>" in plan
    plan = plan_of(QUERIES["csv_scan"](spark, SF_DIR).filter("value > 50"))
    assert "GreaterThan(value,50.0)" in plan
    plan = plan_of(QUERIES["avg_churn_quarter"](spark, SF_DIR))
    assert "GreaterThanOrEqual(ts,2024-01-07T00:00" in plan and "LessThan(ts,2024-01-15T00:00" in plan


def test_audit_is_one_shuffle_and_reads_required_columns_only(spark):
    plan = plan_of(given.metadata(spark, SF_DIR))
    assert plan.count("Exchange") == 1
    assert "html" not in plan and "l_quantity" not in plan
    plan = plan_of(given.catalog(spark, SF_DIR))
    assert plan.count("Exchange") == 1 and plan.count("ReadSchema: struct<>") == len(given.TABLE_NAMES)


def test_metrics_shuffle_by_user_then_by_date_without_a_join(spark):
    plan = plan_of(given.metrics(spark, SF_DIR))
    assert plan.count("Exchange") == 2 and "Join" not in plan
    assert "ReadSchema: struct<ts:timestamp_ntz,user_id:bigint>" in plan


def test_cost_summary_reads_the_log_once(spark):
    summary = cost_plans.cost_summary(given.calls(spark, SF_DIR))
    summary.collect()
    final = plan_of(summary)
    assert "ReusedExchange" in final


def test_latest_row_needs_no_sort(spark):
    plan = plan_of(audit.latest_metadata(given.metadata_history(spark, SF_DIR)))
    assert plan.count("Exchange") == 1 and "Window" not in plan


def test_retrieval_leaves_the_documents_where_they_are(spark):
    plan = plan_of(QUERIES["cited_context"](spark, SF_DIR))
    assert "WindowGroupLimit" in plan and "Cartesian" not in plan and "NestedLoop" not in plan
    texts = [line for line in plan.split("\n") if "FileScan" in line and "text" in line.split("Batched")[0]]
    assert len(texts) == 1
    above = plan[: plan.index(texts[0])].rstrip().split("\n")[-6:]
    assert not any("Exchange hashpartitioning" in line for line in above)


def test_date_range_reaches_a_stored_metrics_table(spark, tmp_path):
    given.metrics(spark, SF_DIR).write.parquet(str(tmp_path / "m"))
    stored = spark.read.parquet(str(tmp_path / "m"))
    plan = plan_of(metrics.average_churn(stored, dt.date(2024, 1, 1), dt.date(2024, 1, 8)))
    assert "GreaterThanOrEqual(metric_date,2024-01-01), LessThan(metric_date," in plan
    assert "GreaterThan(churn_rate,0.1" in plan_of(metrics.high_churn(stored))


def test_no_query_crosses_rows(spark):
    for name in ("knn_topk", "governance_gaps", "churn_vs_target", "synthesis_context", "upsert_documents"):
        plan = plan_of(QUERIES[name](spark, SF_DIR))
        assert "Cartesian" not in plan and "NestedLoop" not in plan, name
