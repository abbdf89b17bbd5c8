"""Column catalogue, required-field audit and what follows from them.

Datasets are named DataFrames. Their rows are counted together in one grouping,
which combines before its shuffle; of each dataset only the columns asked for
are read. A marker row per dataset carries what its schema says, so an empty
dataset is reported like any other.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from corvane import fixed_values as fixed


def _first(datasets: Mapping[str, DataFrame]) -> DataFrame:
    return next(iter(datasets.values()))


def column_catalog(datasets: Mapping[str, DataFrame]) -> DataFrame:
    """Every column of every dataset with its type and the dataset's row count."""
    listing = "dataset_name string, columns array<struct<column_name: string, data_type: string>>"
    markers = _first(datasets).sparkSession.createDataFrame(
        [(name, df.dtypes) for name, df in datasets.items()], listing
    ).withColumn("row", F.lit(0))
    columns = F.lit(None).cast(markers.schema["columns"].dataType).alias("columns")
    rows = [
        df.select(F.lit(name).alias("dataset_name"), columns, F.lit(1).alias("row"))
        for name, df in datasets.items()
    ]
    counted = reduce(DataFrame.unionByName, rows, markers).groupBy("dataset_name").agg(
        F.sum("row").alias("row_count"), F.any_value("columns", True).alias("columns")
    )
    return counted.select("dataset_name", "row_count", F.inline("columns"))


def required_field_audit(
    datasets: Mapping[str, DataFrame], required: Iterable[str] = fixed.REQUIRED_FIELDS
) -> DataFrame:
    """One row per dataset and required field: present or not, and rows filled.

    Presence goes by normalised column names, so normalise first.
    """
    required = list(required)
    numbers = range(len(required))
    columns = {name: set(df.columns) for name, df in datasets.items()}
    flags = ", ".join(f"present_{i} boolean" for i in numbers)
    markers = _first(datasets).sparkSession.createDataFrame(
        [(name, *[f in have for f in required]) for name, have in columns.items()],
        f"dataset_name string, {flags}",
    ).select(
        "*", F.lit(0).alias("row"), *[F.lit(False).alias(f"filled_{i}") for i in numbers]
    )

    def rows(name: str, df: DataFrame) -> DataFrame:
        filled = [
            F.col(f"`{f}`").isNotNull() if f in columns[name] else F.lit(False) for f in required
        ]
        return df.select(
            F.lit(name).alias("dataset_name"),
            F.lit(1).alias("row"),
            *[F.lit(False).alias(f"present_{i}") for i in numbers],
            *[filled[i].alias(f"filled_{i}") for i in numbers],
        )

    parts = [rows(name, df) for name, df in datasets.items()]
    counted = reduce(DataFrame.unionByName, parts, markers).groupBy("dataset_name").agg(
        F.sum("row").alias("row_count"),
        *[F.max(f"present_{i}").alias(f"present_{i}") for i in numbers],
        *[F.count_if(f"filled_{i}").alias(f"filled_{i}") for i in numbers],
    )
    entries = F.array(
        *[
            F.struct(
                F.lit(required[i]).alias("column_name"),
                F.lit("STRING").alias("data_type"),
                F.lit(True).alias("is_required_field"),
                F.col(f"present_{i}").alias("is_present"),
                F.col("row_count").alias("row_count"),
                F.col(f"filled_{i}").alias("filled_count"),
            )
            for i in numbers
        ]
    )
    return counted.select("dataset_name", F.inline(entries))


def observed_audit(
    dataset: str, rows: DataFrame, required: Iterable[str] = fixed.REQUIRED_FIELDS
) -> tuple[DataFrame, Callable[[], list[tuple]]]:
    """The rows, counted as whoever writes them reads them, and a function for the audit afterwards.

    Nothing is read for the audit: presence goes by column names, rows and filled fields are counted on the way.
    The function gives the entries of ``required_field_audit`` and waits for the write.
    """
    required, seen = list(required), Observation()
    filled = [F.count(F.col(f"`{f}`") if f in rows.columns else F.lit(None)) for f in required]
    counts = [c.alias(f"filled_{i}") for i, c in enumerate(filled)]
    counted = rows.observe(seen, F.count(F.lit(1)).alias("rows"), *counts)

    def entries() -> list[tuple]:
        got = seen.get
        return [
            (dataset, f, "STRING", True, f in rows.columns, got["rows"], got[f"filled_{i}"])
            for i, f in enumerate(required)
        ]

    return counted, entries


def missing_fields(metadata: DataFrame) -> DataFrame:
    return metadata.filter(~F.col("is_present")).select("dataset_name", "column_name")


def metadata_completeness(metadata: DataFrame) -> DataFrame:
    """Present and audited fields per dataset."""
    return metadata.groupBy("dataset_name").agg(
        F.count_if("is_present").alias("present_count"),
        F.count(F.lit(1)).alias("required_count"),
    )


def governance_gaps(
    catalog: DataFrame, required: Iterable[str] = fixed.REQUIRED_FIELDS
) -> DataFrame:
    """(dataset, required field) pairs with no such column in the catalogue."""
    wanted = catalog.select("dataset_name").distinct().select(
        "dataset_name", F.explode(F.array(*map(F.lit, required))).alias("column_name")
    )
    return wanted.join(catalog, ["dataset_name", "column_name"], "left_anti")


def missing_by_dataset(
    catalog: DataFrame, required: Iterable[str] = fixed.REQUIRED_FIELDS
) -> DataFrame:
    """Per dataset the array of required fields it lacks, in the given order.

    One flag per required field, so a group is one row however many columns
    it has.
    """
    required = list(required)
    seen = [
        F.max(F.when(F.col("column_name") == f, F.lit(f))).alias(f"seen_{i}")
        for i, f in enumerate(required)
    ]
    wanted = F.array(*map(F.lit, required))
    present = F.array(*[F.col(f"seen_{i}") for i in range(len(required))])
    return catalog.groupBy("dataset_name").agg(*seen).select(
        "dataset_name", F.array_except(wanted, present).alias("missing")
    )


def list_datasets(catalog: DataFrame) -> DataFrame:
    return catalog.select("dataset_name").distinct()


def latest_metadata(history: DataFrame) -> DataFrame:
    """The newest row of each (dataset, column), by time of synchronisation.

    A greatest-struct aggregate: it combines before the shuffle, so a dataset
    with most of the history costs no more than any other.
    """
    keys = ["dataset_name", "column_name"]
    rest = [c for c in history.columns if c not in (*keys, "catalog_synced_at")]
    newest = F.max(F.struct("catalog_synced_at", *rest)).alias("newest")
    return history.groupBy(*keys).agg(newest).select(*keys, "newest.*")
