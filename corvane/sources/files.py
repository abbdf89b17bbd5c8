"""Uploaded files and the events that announce them."""

from __future__ import annotations

import re
from functools import partial, reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corvane.functions.keys import upload_handler, upload_key, upload_type
from corvane.session import side_by_side

UPLOAD_EVENT = (
    "Records array<struct<s3: struct<bucket: struct<name: string>, object: struct<key: string>>>>"
)
UPLOAD = "path string, modificationTime timestamp, length bigint, content binary"
EXTRACTION = "Blocks array<struct<BlockType: string, Text: string>>"


def _reader(spark: SparkSession, stream: bool, per_batch: int | None):
    """A batch reader, or a stream's that takes at most so many files at a time."""
    if not stream:
        return spark.read
    reader = spark.readStream
    return reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader


def scan_documents(
    spark: SparkSession, folder: str, *, stream: bool = False, per_batch: int | None = None
) -> DataFrame:
    """PDF uploads below a folder: path, modificationTime, length, content."""
    return (
        _reader(spark, stream, per_batch)
        .format("binaryFile")
        .schema("path string, modificationTime timestamp, length bigint, content binary")
        .option("pathGlobFilter", "*.pdf")
        .option("recursiveFileLookup", "true")
        .load(folder)
    )


def scan_uploads(
    spark: SparkSession, folder: str, *, stream: bool = False, per_batch: int | None = None
) -> DataFrame:
    """Uploads of every kind below a folder, as ``scan_documents`` gives them. Contents not asked for are not read;
    a stream's batch has all of its columns read, so ask before it starts."""
    return (
        _reader(spark, stream, per_batch)
        .format("binaryFile")
        .schema(UPLOAD)
        .option("recursiveFileLookup", "true")
        .load(folder)
    )


def read_contents(spark: SparkSession, paths: list[str]) -> DataFrame:
    """The named files alone, as ``scan_uploads`` gives them."""
    if not paths:
        return spark.createDataFrame([], UPLOAD)
    literal = [re.sub(r"([{}\[\]*?\\])", r"\\\1", path) for path in paths]  # names are no patterns
    return spark.read.format("binaryFile").schema(UPLOAD).option("recursiveFileLookup", "true").load(literal)


#: Holds the path of the file a row comes from, until the row is packed.
SOURCE = "_source_file"


def read_files(spark: SparkSession, paths: list[str], kind: str) -> DataFrame:
    """CSV or JSON-lines files of one dataset as one table, with the file of each row in ``SOURCE``.

    CSV columns are texts and go by name: files whose headers differ in order, or have columns that others
    lack, are read in groups of one header each. JSON types are inferred over all files; lines that do not
    parse stay, whole, in ``_corrupt_record``.
    """
    source = upload_key(F.col("_metadata.file_path")).alias(SOURCE)
    if kind == "json":
        rows = spark.read.json(paths)
        return rows.select(*(F.col(f"`{c}`") for c in rows.columns), source)
    form = {"header": "true", "escape": '"', "multiLine": "true"}

    def header(path: str) -> tuple[str, ...]:
        return tuple(spark.read.options(**form).csv(path).columns)

    groups: dict[tuple[str, ...], list[str]] = {}
    for path, columns in zip(paths, side_by_side(spark, [partial(header, x) for x in paths]), strict=True):
        groups.setdefault(columns, []).append(path)
    tables = []
    for columns, own in sorted(groups.items()):
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        rows = spark.read.options(**form).schema(schema).csv(own)
        tables.append(rows.select(*(F.col(f"`{c}`") for c in columns), source))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def scan_csv(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str | None = None,
    *,
    stream: bool = False,
    per_batch: int | None = None,
    multi_line: bool = True,
) -> DataFrame:
    """CSV uploads with a header line; without a schema the types are inferred.

    Quotes within a quoted field are doubled, as in RFC 4180. Fields may hold line
    breaks; a file is then read by one task. Where they do not, ``multi_line=False``
    lets large files be split.
    """
    reader = _reader(spark, stream, per_batch).options(header="true", escape='"', multiLine=multi_line)
    reader = reader.schema(schema) if schema else reader.option("inferSchema", "true")
    return reader.csv(folder)


def scan_json(
    spark: SparkSession,
    folder: str,
    schema: T.StructType | str | None = None,
    *,
    stream: bool = False,
    per_batch: int | None = None,
) -> DataFrame:
    """JSON-lines uploads; without a schema it is inferred."""
    reader = _reader(spark, stream, per_batch)
    return (reader.schema(schema) if schema else reader).json(folder)


def unpack_events(events: DataFrame, column: str = "event") -> DataFrame:
    """(bucket, key) of every record of JSON upload events."""
    parsed = F.from_json(F.col(column), UPLOAD_EVENT)
    return events.select(F.explode(parsed["Records"]).alias("r")).select(
        F.col("r.s3.bucket.name").alias("bucket"), F.col("r.s3.object.key").alias("key")
    )


def route_files(uploads: DataFrame, key: str = "key") -> DataFrame:
    """Uploads under a known prefix, with their type and the handler they feed."""
    routed = uploads.withColumn("file_type", upload_type(F.col(key))).withColumn(
        "handler", upload_handler(F.col(key))
    )
    return routed.filter(F.col("handler").isNotNull())


def extraction_blocks(content: Column) -> Column:
    """The blocks of an extraction response stored as JSON bytes or text."""
    return F.from_json(content.cast("string"), EXTRACTION)["Blocks"]


def spread(df: DataFrame, key: str) -> DataFrame:
    """Rows over all cores if the input has fewer pieces than there are cores.

    Only a small input, such as one file with one row group, is ever shuffled;
    a large one has pieces enough and stays where it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, key) if df.rdd.getNumPartitions() < cores else df
