"""Click tables, tab-separated snapshots and history text files."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from clickweave.functions.hashing import uniform01
from clickweave.operators.filters import CLICK_COLUMNS, not_null, partition_is

# Text ids; the time is declared as a number so that it compares as one.
SNAPSHOT_SCHEMA = "uid string, id string, ctime bigint"
TEXT = {"sep": "\t", "header": True, "ignoreLeadingWhiteSpace": False,
        "ignoreTrailingWhiteSpace": False, "escape": '"', "nullValue": "\\N"}


def scan_hour(table: DataFrame, day: str, hour: str,
              cols: Sequence[str] = CLICK_COLUMNS) -> DataFrame:
    """One hour of a click table partitioned by (pdate, phour)."""
    return table.where(partition_is(day, hour)).select(*cols)


def write_click_table(clicks: DataFrame, path: str) -> None:
    """Parquet partitioned by (pdate, phour); big hours are split over several files."""
    (clicks.hint("rebalance", "pdate", "phour")
     .write.partitionBy("pdate", "phour").parquet(path))


def write_clustered_clicks(clicks: DataFrame, path: str) -> None:
    """Parquet in hour order without a folder per hour.

    For logs whose hours are far smaller than a file: a filter on the hour
    skips files and row groups by their statistics. The user and item columns
    let a big hour be cut into several files.
    """
    order = ["pdate", "phour", "uid", "id"]
    clicks.repartitionByRange(*order).sortWithinPartitions(*order).write.parquet(path)


def click_table_schema(clicks: DataFrame) -> T.StructType:
    parts = {"pdate", "phour"}
    fields = [f for f in clicks.schema if f.name not in parts]
    return T.StructType([*fields, T.StructField("pdate", T.StringType()),
                         T.StructField("phour", T.StringType())])


def read_click_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).parquet(path)


def write_snapshot(clicks: DataFrame, path: str, files: int | None = None,
                   mode: str = "errorifexists") -> None:
    """Tab-separated text with a header. ``files=None`` leaves the count to Spark.

    Text comes back as it was: white space stays, an empty text isn't a missing one,
    and a text with a line break, which a line can't hold, ends the job.
    """
    checked = [
        F.when(F.col(f.name).rlike("[\r\n]"),
               F.raise_error(F.lit(f"{f.name} holds a line break"))).otherwise(F.col(f.name))
        .alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in clicks.schema]
    spread = clicks.select(*checked)
    spread = spread if files is None else spread.repartition(files)
    spread.write.mode(mode).options(**TEXT).csv(path)


def read_snapshot(spark: SparkSession, path: str | Sequence[str],
                  schema: str = SNAPSHOT_SCHEMA) -> DataFrame:
    """Every part file of one or more snapshot folders.

    A malformed number reads as NULL; such rows carry no usable time and are
    dropped together with rows that miss a key.
    """
    paths = [path] if isinstance(path, str) else list(path)
    rows = spark.read.schema(schema).options(**TEXT).option("mode", "PERMISSIVE").csv(paths)
    return rows.where(not_null())


def write_histories(lists: DataFrame, path: str, files: int | None = None) -> None:
    """One JSON line per history row."""
    lines = lists.select(F.to_json(F.struct(*lists.columns)).alias("value"))
    (lines if files is None else lines.repartition(files)).write.text(path)


def read_histories(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    parsed = spark.read.text(path).select(F.from_json("value", schema).alias("r"))
    return parsed.select("r.*")


def tab_lines(df: DataFrame, cols: Sequence[str] = CLICK_COLUMNS) -> DataFrame:
    """One tab-joined line per row. A NULL would vanish from the line, so rows with one go."""
    texts = [F.col(c).cast("string") for c in cols]
    return df.where(not_null(cols)).select(F.concat_ws("\t", *texts).alias("line"))


def memory_table(spark: SparkSession, rows: Sequence[tuple], schema: str,
                 partitions: int | None = None) -> DataFrame:
    """Small in-memory table, optionally with a fixed number of partitions."""
    df = spark.createDataFrame(list(rows), schema)
    return df if partitions is None else df.repartition(partitions)


def exact_partitions(df: DataFrame, n: int) -> DataFrame:
    return df.repartition(n)


def synthetic_vectors(ids: DataFrame, row: str, dim: int, seed: int = 1234,
                      drift: float = 1000.0) -> DataFrame:
    """(row_id, vec): uniform in [0, 1), dimension 0 moved by row / ``drift``.

    Every number is drawn from (seed, row, dimension), so the table is the same
    however it is partitioned.
    """
    def cell(d: Column) -> Column:
        base = uniform01(str(seed), F.col(row).cast("string"), d.cast("string"))
        return F.when(d == 0, base + F.col(row) / F.lit(drift)).otherwise(base)

    vec = F.transform(F.sequence(F.lit(0), F.lit(dim - 1)), cell)
    return ids.select(F.col(row).alias("row_id"), vec.alias("vec"))
