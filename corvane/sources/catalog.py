"""Schema discovery and the catalogue of registered datasets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from corvane.functions.keys import upload_key
from corvane.sources.files import scan_csv, scan_json


def scan_table(spark: SparkSession, database: str, table: str) -> DataFrame:
    """A registered table; database and table are separate parameters."""
    return spark.table(f"`{database}`.`{table}`")


def register_dataset(spark: SparkSession, table: str, folder: str, kind: str) -> list[str]:
    """Infer the schema of a CSV or JSON folder and register it as a table.

    A table that exists is kept and gains the columns that are new. Returns the
    columns added.
    """
    scan = {"csv": scan_csv, "json": scan_json}[kind]
    found = scan(spark, folder)
    if not spark.catalog.tableExists(table):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in found.schema)
        header = ", header 'true'" if kind == "csv" else ""
        spark.sql(
            f"CREATE TABLE {table} ({columns}) USING {kind} OPTIONS (path '{folder}'{header})"
        )
        return found.columns
    known = {c.name.lower() for c in spark.catalog.listColumns(table)}
    added = [f for f in found.schema if f.name.lower() not in known]
    if added:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in added)
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    return [f.name for f in added]


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """Keys of the files below a folder; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(folder)
    return files.select(F.coalesce(F.nullif(upload_key("path"), F.lit("")), "path").alias("key"))


def deleted_files(seen: DataFrame, present: DataFrame) -> DataFrame:
    """Files recorded earlier and gone now: reported, never dropped from a table."""
    return seen.join(present, "key", "left_anti")


# Names that ``schema_of_variant`` gives to types.
VARIANT_TYPES = (
    "ARRAY", "OBJECT", "VOID", "BOOLEAN", "BIGINT", "DOUBLE", "FLOAT", "DECIMAL", "STRING", "BINARY", "DATE",
    "TIMESTAMP", "TIMESTAMP_NTZ", "VARIANT",
)


def _type_text(value: Column) -> Column:
    """A variant's type in lower case; names of nested fields keep theirs."""
    text = F.schema_of_variant(value)
    for name in VARIANT_TYPES:
        text = F.regexp_replace(text, rf"\b{name}\b(?=[<>,(]|$)", name.lower())
    return text


#: The type of what does not parse, in a row without a column name.
UNPARSED = "unparsed"


def discover_json_schema(records: DataFrame, dataset: str, column: str) -> DataFrame:
    """Fields and types that occur in a column of JSON objects, with their counts.

    Every object is read; counts combine before the shuffle, which carries one
    row per dataset, field and type. Texts that do not parse, or are no objects, are
    counted under the type ``UNPARSED`` without a column name; nulls are not records.
    """
    fields = records.filter(F.col(column).isNotNull()).select(
        F.col(dataset).alias("dataset_name"),
        F.try_parse_json(F.col(column)).alias("v"),
    )
    is_object = F.coalesce(F.schema_of_variant("v").startswith("OBJECT"), F.lit(False))
    fields = fields.withColumn("v", F.when(is_object, F.col("v"))).withColumn("bad", ~is_object)
    fields = fields.lateralJoin(records.sparkSession.tvf.variant_explode_outer(F.col("v").outer()))
    found = F.when(F.col("bad"), F.lit(UNPARSED)).otherwise(_type_text(F.col("value")))
    return (
        fields.filter("bad or key is not null")
        .groupBy("dataset_name", F.col("key").alias("column_name"), found.alias("data_type"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )


def merged_schema(discovered: DataFrame) -> DataFrame:
    """One type per field of ``discover_json_schema``: the least that holds every value found.

    void is below all types; whole numbers are below double, which also takes decimals; arrays of different
    elements are arrays of variants, objects of different fields a variant, all else is string. The rows are
    few; every test of a field's types is an aggregate that combines before the shuffle.
    """
    kind = F.col("data_type")
    known = kind != "void"
    number = kind.isin("bigint", "double", "float") | kind.startswith("decimal")

    def all_are(test: Column) -> Column:
        return F.coalesce(F.bool_and(F.when(known, test)), F.lit(False))

    one = F.min(F.when(known, kind)).alias("least"), F.max(F.when(known, kind)).alias("most")
    tests = {"numbers": number, "arrays": kind.startswith("array<"), "objects": kind.startswith("object<")}
    grouped = discovered.filter(kind != UNPARSED).groupBy("dataset_name", "column_name").agg(
        *one, *(all_are(t).alias(n) for n, t in tests.items()),
        all_are(kind == "bigint").alias("whole"), F.sum("occurrences").alias("occurrences"),
    )
    merged = (
        F.when(F.col("most").isNull(), "void")
        .when(F.col("whole"), "bigint")
        .when(F.col("numbers"), "double")
        .when(F.col("least") == F.col("most"), F.col("most"))
        .when(F.col("arrays"), "array<variant>")
        .when(F.col("objects"), "variant")
        .otherwise("string")
    )
    return grouped.select("dataset_name", "column_name", merged.alias("data_type"), "occurrences")
