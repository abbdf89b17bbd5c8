"""Files, catalogue, keyed writes and streams."""

import datetime as dt
import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions.keys import upload_key
from corvane.schemas import TABLES, create_tables
from corvane.sinks import tables as sinks
from corvane.sources import catalog, files
from corvane.streaming import ingest

LIMITS = {"min_tokens": 2, "max_tokens": 4}


def put_pdf(folder: Path, name: str, *lines: str) -> None:
    """An upload whose bytes are a stored extraction response."""
    blocks = [{"BlockType": "PAGE"}] + [{"BlockType": "LINE", "Text": t} for t in lines]
    target = folder / "raw" / "pdf" / name
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(json.dumps({"Blocks": blocks}))


@pytest.fixture
def store(tmp_path):
    return ingest.DocumentStore(str(tmp_path / "store"))


def stored_chunks(spark, store):
    rows = store.chunks(spark).collect()
    return sorted((r.s3_key, r.chunk_index, r.chunk_text) for r in rows)


def run_documents(spark, folder, store):
    uploads = files.scan_documents(spark, str(folder / "raw" / "pdf"), stream=True, per_batch=1)
    texts = ingest.uploads_to_text(uploads, "uploads")
    ingest.document_stream(texts, store, f"{store.root}/checkpoint", **LIMITS).awaitTermination()


def test_document_stream_takes_new_files_only(spark, tmp_path, store):
    put_pdf(tmp_path, "a.pdf", "One two three.", "Four five six. Seven eight.")
    put_pdf(tmp_path, "b.txt", "Not a document.")
    run_documents(spark, tmp_path, store)
    first = stored_chunks(spark, store)
    assert [c[:2] for c in first] == [("raw/pdf/a.pdf", 0), ("raw/pdf/a.pdf", 1), ("raw/pdf/a.pdf", 2)]
    created = store.chunks(spark).agg(F.max("created_at")).first()[0]
    put_pdf(tmp_path, "c/d.pdf", "Ten.")
    run_documents(spark, tmp_path, store)
    assert stored_chunks(spark, store) == sorted(first + [("raw/pdf/c/d.pdf", 0, "Ten.")])
    kept = store.chunks(spark).filter("s3_key like '%a.pdf'")
    assert kept.agg(F.max("created_at")).first()[0] == created
    vectors = store.vectors(spark)
    assert vectors.count() == 4 and vectors.select(F.size("embedding")).distinct().collect() == [(384,)]


def test_batches_of_one_file_each(spark, tmp_path, store):
    for name in "abc":
        put_pdf(tmp_path, f"{name}.pdf", f"Text {name}.")
    run_documents(spark, tmp_path, store)
    assert [c[2] for c in stored_chunks(spark, store)] == ["Text a.", "Text b.", "Text c."]


def test_reingestion_replaces(spark, store):
    def take(rows):
        texts = spark.createDataFrame([(k, "b", t) for k, t in rows], "s3_key string, source_bucket string, text string")
        ingest.ingest_documents(texts, store, **LIMITS)

    take([("k1", "One two three. Four five six."), ("k2", "Seven."), ("k3", "Eight.")])
    before = {r.s3_key: r for r in store.documents(spark).collect()}
    take([("k1", "New."), ("k1", "New."), ("k2", ""), ("k4", "Nine.")])
    after = {r.s3_key: r for r in store.documents(spark).collect()}
    assert set(after) == {"k1", "k2", "k3", "k4"}
    assert all(after[k] == before[k] for k in before)
    want = [("k1", 0, "New."), ("k3", 0, "Eight."), ("k4", 0, "Nine.")]
    assert stored_chunks(spark, store) == want
    vectors = store.vectors(spark).collect()
    assert sorted((r.s3_key, r.chunk_index, r.chunk_text) for r in vectors) == want


def size_of(path):
    return sum(f.stat().st_size for f in Path(path).rglob("*.parquet"))


def deliver(spark, store, rows, txn=None):
    texts = spark.createDataFrame([(k, "b", t) for k, t in rows], "s3_key string, source_bucket string, text string")
    return ingest.ingest_documents(texts, store, txn=txn, **LIMITS)


def test_a_batch_writes_in_proportion_to_itself(spark, store):
    deliver(spark, store, [(f"k{k}", f"One {k} two. Three {k} four. " * 60) for k in range(300)])
    before = size_of(store.root)
    deliver(spark, store, [("k7", "New.")])
    assert size_of(store.root) - before < before / 10
    assert [c for c in stored_chunks(spark, store) if c[0] == "k7"] == [("k7", 0, "New.")]
    assert len({c[0] for c in stored_chunks(spark, store)}) == 300


def test_a_crash_between_files_leaves_the_old_state(spark, store, monkeypatch):
    deliver(spark, store, [("a", "One."), ("b", "Two.")], "x-0")
    old = stored_chunks(spark, store), store.vectors(spark).count(), store.documents(spark).count()

    def broken(df, text, vector):
        return df.withColumn(vector, F.raise_error(F.lit("lost")).cast("array<float>"))

    texts = spark.createDataFrame([("a", "b", "Changed."), ("c", "b", "More.")], "s3_key string, source_bucket string, text string")
    with pytest.raises(Exception, match="lost"):
        ingest.ingest_documents(texts, store, broken, txn="x-1", **LIMITS)
    assert (stored_chunks(spark, store), store.vectors(spark).count(), store.documents(spark).count()) == old
    assert ingest.ingest_documents(texts, store, txn="x-1", **LIMITS) == 1
    assert [c[2] for c in stored_chunks(spark, store)] == ["Changed.", "Two.", "More."]


def test_a_repeated_batch_is_left_out(spark, store):
    assert deliver(spark, store, [("a", "One.")], "x-0") == 0
    before = size_of(store.root)
    assert deliver(spark, store, [("a", "Other.")], "x-0") is None
    assert size_of(store.root) == before and stored_chunks(spark, store) == [("a", 0, "One.")]


def test_compaction_and_vacuum(spark, store):
    assert store.compact(spark) is None
    for k in range(3):
        deliver(spark, store, [("a", f"Text {k}."), (f"b{k}", "Same.")], f"x-{k}")
    deliver(spark, store, [("b0", "")], "x-3")
    rows = stored_chunks(spark, store)
    parents = sorted(store.documents(spark).collect())
    assert store.compact(spark) == 4 and [r.version for r in store.log(spark)] == [4]
    store.vacuum(spark)
    assert len(list((Path(store.root) / "data" / "documents").iterdir())) == 1
    assert stored_chunks(spark, store) == rows and sorted(store.documents(spark).collect()) == parents
    assert deliver(spark, store, [("a", "Again.")], "x-2") is None
    assert deliver(spark, store, [("a", "Last.")], "x-4") == 5
    assert ("a", 0, "Last.") in stored_chunks(spark, store)


def test_two_writers_cannot_take_one_version(spark, store):
    deliver(spark, store, [("a", "One.")])
    other = spark.createDataFrame([(0, "c", None, False)], "version long, commit string, txn string, replaces boolean")
    other.write.parquet(f"{store.root}/log/{1:012d}")
    folder = Path(store.root) / "log" / f"{1:012d}"
    for file in folder.iterdir():
        file.unlink()
    with pytest.raises(Exception, match="already exists"):
        deliver(spark, store, [("a", "Two.")])


def test_latest_delivery_of_a_key(spark, store):
    at = [dt.datetime(2024, 1, d) for d in (1, 3, 2)]
    rows = [("k", "b", text, when) for text, when in zip(("Old.", "Last.", "Zwischen."), at)]
    kind = "s3_key string, source_bucket string, text string, modified timestamp"
    ingest.ingest_documents(spark.createDataFrame(rows, kind), store, **LIMITS)
    assert stored_chunks(spark, store) == [("k", 0, "Last.")]
    untimed = [("k", "b", "One two. Three."), ("k", "b", "Only. Other.")]
    ingest.ingest_documents(spark.createDataFrame(untimed, "s3_key string, source_bucket string, text string"), store, **LIMITS)
    assert {c[2] for c in stored_chunks(spark, store)} in ({"Only. Other."}, {"Only.", "Other."})


def test_streams_on_two_checkpoints_add_up(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "w")
    folder.mkdir()
    (folder / "1.csv").write_text("record_id,source_system\n1,crm\n")
    for name in ("one", "two"):
        rows = files.scan_csv(spark, str(folder), "record_id string, source_system string", stream=True)
        ingest.structured_stream(rows, root, f"{tmp_path}/{name}", "sales", "csv").awaitTermination()
    assert spark.read.parquet(f"{root}/structured_data").count() == 2


def test_standard_csv(spark, tmp_path):
    (tmp_path / "q.csv").write_text('a,b\r\n"x ""y"" z","line\none"\r\n1,"2,3"\r\n', newline="")
    got = {tuple(r) for r in files.scan_csv(spark, str(tmp_path), "a string, b string").collect()}
    assert got == {('x "y" z', "line\none"), ("1", "2,3")}


def test_upsert_changes_only_the_status(spark):
    schema = "document_id int, s3_key string, page_count int, status string"
    old = spark.createDataFrame([(1, "a", None, "pending"), (2, "b", 7, "pending")], schema)
    new = spark.createDataFrame([(9, "a", 5, "processed"), (3, "c", 6, "processed"), (3, "c", 6, "processed")], schema)
    rows = {tuple(r) for r in sinks.upsert_documents(old, new).collect()}
    assert rows == {(1, "a", None, "processed"), (2, "b", 7, "pending"), (3, "c", 6, "processed")}


def test_structured_stream(spark, tmp_path):
    folder, root = tmp_path / "raw" / "csv" / "sales", str(tmp_path / "warehouse")
    folder.mkdir(parents=True)
    (folder / "1.csv").write_text(" Record ID,Source System,Amount\n1,crm,2.5\n2,crm,oops\n")
    schema = "` Record ID` string, `Source System` string, Amount string"
    types = "record_id bigint, source_system string, amount double"

    def run():
        rows = files.scan_csv(spark, str(folder), schema, stream=True)
        ingest.structured_stream(
            rows, root, f"{tmp_path}/checkpoint", "sales", "csv", types=types
        ).awaitTermination()
        stored = spark.read.parquet(f"{root}/structured_data")
        amounts = stored.select(
            F.variant_get("raw_payload", "$.record_id", "long"), F.variant_get("raw_payload", "$.amount", "double")
        )
        return {tuple(r) for r in amounts.collect()}

    assert run() == {(1, 2.5), (2, None)}
    audit = spark.read.parquet(f"{root}/glue_catalog_metadata")
    assert {(r.column_name, r.is_present) for r in audit.collect()} == {
        ("record_date", False), ("source_system", True), ("record_id", True)
    }
    (folder / "2.csv").write_text(" Record ID,Source System,Amount\n3,erp,4\n")
    assert run() == {(1, 2.5), (2, None), (3, 4.0)}


def put(folder, name, text):
    target = folder / "raw" / name
    target.parent.mkdir(parents=True, exist_ok=True)
    target.write_text(text)


def test_one_stream_takes_every_kind(spark, tmp_path, store):
    folder, root = tmp_path / "in", str(tmp_path / "w")
    put(folder, "csv/sales/1.csv", " Record ID,Source System,Amount\n1,crm,2\n2,,3\n")
    put(folder, "csv/sales/2.csv", "Amount,Region, Record ID\n7,north,3\n")  # other order, other columns
    put(folder, "csv/visits.csv", "record_id\n9\n")
    put(folder, "json/people/a.json", '{"name": "x", "age": 1}\nnot json\n{"name": "y", "age": "old"}\n')
    put(folder, "other/z.csv", "a\n1\n")
    put_pdf(folder, "d.pdf", "One two three.")

    def stored():
        rows = spark.read.parquet(f"{root}/structured_data")
        names = [("record_id", "int"), ("amount", "int"), ("region", "string"), ("name", "string"), ("age", "string"), ("_corrupt_record", "string")]
        fields = [F.try_variant_get("raw_payload", f"$.{n}", t) for n, t in names]
        return sorted(map(tuple, rows.select("dataset_name", "source_file", *fields).collect()), key=str)

    def run():
        uploads = files.scan_uploads(spark, str(folder), stream=True)
        ingest.upload_stream(uploads, store, root, f"{tmp_path}/checkpoint", **LIMITS).awaitTermination()

    run()
    want = [
        ("people", "raw/json/people/a.json", None, None, None, "x", "1", None),
        ("people", "raw/json/people/a.json", None, None, None, "y", "old", None),
        ("people", "raw/json/people/a.json", None, None, None, None, None, "not json"),
        ("sales", "raw/csv/sales/1.csv", 1, 2, None, None, None, None),
        ("sales", "raw/csv/sales/1.csv", 2, 3, None, None, None, None),
        ("sales", "raw/csv/sales/2.csv", 3, 7, "north", None, None, None),
        ("visits.csv", "raw/csv/visits.csv", 9, None, None, None, None, None),
    ]
    assert stored() == sorted(want, key=str)
    assert stored_chunks(spark, store) == [("raw/pdf/d.pdf", 0, "One two three.")]
    audit = spark.read.parquet(f"{root}/glue_catalog_metadata").filter("dataset_name = 'sales'")
    assert {(r.column_name, r.is_present, r.row_count, r.filled_count) for r in audit.collect()} == {
        ("record_date", False, 3, 0), ("source_system", True, 3, 1), ("record_id", True, 3, 3)
    }
    put(folder, "csv/sales/3.csv", "Record ID\n4\n")
    run()
    assert stored() == sorted([*want, ("sales", "raw/csv/sales/3.csv", 4, None, None, None, None, None)], key=str)


def test_bytes_of_documents_alone_are_read(spark, tmp_path, store):
    folder, root = tmp_path / "in", str(tmp_path / "w")
    put(folder, "csv/sales/1.csv", "record_id\n1\n")
    put_pdf(folder, "d [1]*.pdf", "One.")
    uploads = files.scan_uploads(spark, str(folder), stream=True)
    touched = F.when(F.col("path").endswith(".csv"), F.raise_error(F.lit("read whole")).cast("binary"))
    uploads = uploads.withColumn("content", touched.otherwise(F.col("content")))
    ingest.upload_stream(uploads, store, root, f"{tmp_path}/checkpoint", **LIMITS).awaitTermination()
    assert spark.read.parquet(f"{root}/structured_data").count() == 1
    assert stored_chunks(spark, store) == [("raw/pdf/d [1]*.pdf", 0, "One.")]


def test_a_repeated_batch_of_uploads_changes_nothing(spark, tmp_path, store):
    folder, root = tmp_path / "in", str(tmp_path / "w")
    put(folder, "csv/sales/1.csv", "record_id\n1\n")
    put(folder, "json/people/a.json", '{"name": "x"}\n')
    put_pdf(folder, "d.pdf", "One.")
    uploads = files.scan_uploads(spark, str(folder))
    for _ in range(2):
        assert ingest.take_uploads(uploads, store, root, "s-0", **LIMITS) == {"people": 1, "sales": 1}
    assert spark.read.parquet(f"{root}/structured_data").count() == 2
    assert len(store.log(spark)) == 1 and len(stored_chunks(spark, store)) == 1


def test_a_load_reads_its_input_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def touched(x):
        seen.add(1)
        return x

    rows = spark.createDataFrame([(str(k), "x") for k in range(50)], "record_id string, source_system string")
    rows = rows.withColumn("record_id", touched.asNondeterministic()("record_id"))
    assert ingest.load_structured(rows, str(tmp_path), "d", "json", load_id="a") == 50
    assert seen.value == 50


def test_a_batch_goes_through_its_texts_once(spark, store):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def touched(x):
        seen.add(1)
        return x

    rows = spark.createDataFrame([(f"k{k}", "b", "One. Two." if k else " ") for k in range(20)], "s3_key string, source_bucket string, text string")
    rows = rows.withColumn("text", touched.asNondeterministic()("text"))
    assert ingest.ingest_documents(rows, store, txn="a") == 0
    assert ingest.ingest_documents(rows, store, txn="a") is None
    assert seen.value == 20
    assert store.documents(spark).count() == 20 and store.chunks(spark).count() == 19


def test_the_newest_version_is_read_without_a_join(spark, store):
    rows = spark.createDataFrame([("k1", "b", "One."), ("k2", "b", "Two.")], "s3_key string, source_bucket string, text string")
    ingest.ingest_documents(rows, store)
    ingest.ingest_documents(rows.filter("s3_key = 'k2'").withColumn("text", F.lit(" ")), store)
    assert [r.s3_key for r in store.chunks(spark).collect()] == ["k1"]
    store.compact(spark)
    chunks = store.chunks(spark)
    assert "Join" not in chunks._jdf.queryExecution().toString()
    assert [(r.s3_key, r.chunk_text) for r in chunks.collect()] == [("k1", "One.")]


def test_repeated_batch_replaces_itself(spark, tmp_path):
    rows = spark.createDataFrame([("1", "x")], "record_id string, source_system string")
    for _ in range(2):
        assert ingest.load_structured(rows, str(tmp_path), "d", "json", load_id="a") == 1
    ingest.load_structured(rows, str(tmp_path), "d", "json", load_id="b")
    assert spark.read.parquet(f"{tmp_path}/structured_data").count() == 2
    assert spark.read.parquet(f"{tmp_path}/glue_catalog_metadata").count() == 6


def test_events_and_prefixes(spark):
    event = {"Records": [{"s3": {"bucket": {"name": "b"}, "object": {"key": k}}} for k in ("raw/pdf/a b.pdf", "charts/c.png")]}
    df = spark.createDataFrame([(json.dumps(event),), ("{}",), ("no json",)], "event string")
    unpacked = files.unpack_events(df)
    assert {tuple(r) for r in unpacked.collect()} == {("b", "raw/pdf/a b.pdf"), ("b", "charts/c.png")}
    assert [(r.key, r.handler) for r in files.route_files(unpacked).collect()] == [("raw/pdf/a b.pdf", "document_ingest")]
    path = spark.range(1).select(upload_key(F.lit("file:/x/raw/json/d/1.json"))).first()[0]
    assert path == "raw/json/d/1.json"


@pytest.fixture
def database(spark, tmp_path):
    name = "corvane_test"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{tmp_path}/db'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


def test_tables_and_defaults(spark, database):
    create_tables(spark, database)
    create_tables(spark, database)
    assert {t.name for t in spark.catalog.listTables(database) if not t.isTemporary} == set(TABLES)
    parents = spark.createDataFrame([("1", "k", "b", "pdf")], "document_id string, s3_key string, source_bucket string, file_type string")
    sinks.append(parents, f"{database}.documents")
    row = catalog.scan_table(spark, database, "documents").first()
    assert row.status == "processed" and row.page_count is None and isinstance(row.ingested_at, dt.datetime)


def test_call_log(spark, database):
    create_tables(spark, database)
    log = f"{database}.call_log"
    calls = spark.createDataFrame([("sql_generation", 10, 5)], "call_type string, input_tokens long, output_tokens long")
    assert sinks.load_counted(calls.union(calls), log) == 2
    sinks.log_calls(calls.withColumn("latency_ms", F.lit(1.5)), log)
    rows = spark.table(log).collect()
    assert sorted(r.latency_ms for r in rows) == [0.0, 0.0, 1.5]
    assert all(dt.datetime.fromisoformat(r.timestamp) for r in rows)
    sinks.reset_calls(spark, log)
    assert spark.table(log).count() == 0


def test_discovery(spark, database, tmp_path):
    folder = tmp_path / "raw" / "json" / "d"
    folder.mkdir(parents=True)
    (folder / "1.json").write_text('{"a": 1}\n{"a": 2, "b": "x"}\n')
    table = f"{database}.found"
    assert catalog.register_dataset(spark, table, str(folder), "json") == ["a", "b"]
    assert catalog.register_dataset(spark, table, str(folder), "json") == []
    keys = [r.key for r in catalog.list_files(spark, str(folder)).collect()]
    assert keys == ["raw/json/d/1.json"]
    seen = spark.createDataFrame([(k,) for k in keys], "key string")
    (folder / "2.json").write_text('{"a": 3, "c": 1.5}\n')
    assert catalog.register_dataset(spark, table, str(folder), "json") == ["c"]
    spark.sql(f"REFRESH TABLE {table}")
    assert {(r.a, r.b, r.c) for r in spark.table(table).collect()} == {(1, None, None), (2, "x", None), (3, None, 1.5)}
    (folder / "1.json").unlink()
    gone = catalog.deleted_files(seen, catalog.list_files(spark, str(folder)))
    assert [r.key for r in gone.collect()] == ["raw/json/d/1.json"]


def test_discovered_json_fields(spark):
    df = spark.createDataFrame([("d", '{"a": 1, "b": [1]}'), ("d", '{"a": "x"}'), ("d", "bad"), ("d", None)], "ds string, js string")
    rows = {tuple(r) for r in catalog.discover_json_schema(df, "ds", "js").collect()}
    assert rows == {
        ("d", "a", "bigint", 1), ("d", "a", "string", 1), ("d", "b", "array<bigint>", 1), ("d", None, "unparsed", 1)
    }
    nested = spark.createDataFrame([("d", '{"p": {"Zip": 1, "DOUBLE": ["x"]}}')], "ds string, js string")
    assert catalog.discover_json_schema(nested, "ds", "js").first().data_type == "object<DOUBLE: array<string>, Zip: bigint>"


def test_types_of_a_field_are_merged(spark):
    lines = [
        '{"n": 1, "m": 1, "t": true, "a": [1], "o": {"p": 1}, "z": null, "same": {"q": "x"}}',
        '{"n": 2.5, "m": 2, "t": null, "a": ["x"], "o": {"r": 1}, "z": null, "same": {"q": "y"}}',
        '{"n": 1e300, "m": "x", "e": {}}', '[1, 2]', '3', "{", "", "{}", None,
    ]
    df = spark.createDataFrame([("d", x) for x in lines] + [("empty", None)], "ds string, js string")
    found = catalog.discover_json_schema(df, "ds", "js")
    assert [(r.dataset_name, r.column_name, r.occurrences) for r in found.filter("data_type = 'unparsed'").collect()] == [("d", None, 4)]
    merged = {r.column_name: (r.data_type, r.occurrences) for r in catalog.merged_schema(found).collect()}
    assert merged == {
        "n": ("double", 3), "m": ("string", 3), "t": ("boolean", 2), "a": ("array<variant>", 2), "o": ("variant", 2),
        "z": ("void", 2), "same": ("object<q: string>", 2), "e": ("object<>", 1),
    }


def test_csv_inference(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a,b\n1,x\n")
    assert files.scan_csv(spark, str(tmp_path)).dtypes == [("a", "int"), ("b", "string")]
