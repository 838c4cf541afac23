"""Readers and writers.

CSV is read with a declared schema, bound to the header by name: column order
and extra columns in the files do not matter, a declared column that is not
there or a cell that is not of its type is an error, or goes to a side table
(``read_csv_quarantined``) while the rest goes on.  Writers never funnel the data through
one task; a single file is produced only for small, bounded outputs
(``single_file=True``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    header = spark.read.option("header", True).csv(path).columns  # the first line alone
    cells = spark.read.schema(_cells(header)).option("header", True).option("enforceSchema", False)
    return _typed(cells.option("mode", "FAILFAST").csv(path), schema)


def read_csv_options(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Option-style CSV scan (same result as ``read_csv``)."""
    header = spark.read.format("csv").options(header="true").load(path).columns
    cells = spark.read.format("csv").options(header="true", enforceSchema="false", mode="FAILFAST")
    return _typed(cells.schema(_cells(header)).load(path), schema)


CORRUPT = "_corrupt_record"  # where Spark's reader puts a line of the wrong shape
QUARANTINE = "column STRING, reason STRING, cell STRING, record STRING"


def read_csv_apart(spark: SparkSession, path: str, schema: T.StructType | str) -> tuple[DataFrame, DataFrame]:
    """(good, bad): the rows of the declared types, and what keeps the others out.

    ``bad`` has a row for each bad cell (column, reason, cell, the record as
    CSV) and for each line with too few or too many cells (column null).  A row
    with a bad cell is in ``bad`` alone; the rest go on.  Both are lazy scans.
    """
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    header = spark.read.option("header", True).csv(path).columns
    cells = spark.read.schema(_cells([*header, CORRUPT])).option("header", True).option("columnNameOfCorruptRecord", CORRUPT).csv(path)
    wrong = [
        F.when(
            F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(f.dataType).isNull(),
            F.struct(
                F.lit(f.name).alias("column"), F.lit(f"is no {f.dataType.simpleString()}").alias("reason"), F.col(f"`{f.name}`").alias("cell"),
                F.to_csv(F.struct(*[F.col(f"`{c}`") for c in header])).alias("record"),
            ),
        )
        for f in declared.fields
    ]
    shape = F.when(
        F.col(CORRUPT).isNotNull(),
        F.array(F.struct(
            F.lit(None).cast("string").alias("column"), F.lit("has another number of cells than the header").alias("reason"),
            F.lit(None).cast("string").alias("cell"), F.col(CORRUPT).alias("record"),
        )),
    )
    found = cells.withColumn("_wrong", F.coalesce(shape, F.array_compact(F.array(*wrong))))
    good = _typed(found.where(F.size("_wrong") == 0), declared)
    return good, found.select(F.explode("_wrong").alias("w")).select("w.*")


def read_csv_quarantined(spark: SparkSession, path: str, schema: T.StructType | str, side_table: str) -> DataFrame:
    """The good rows; what keeps the others out is written to ``side_table`` (parquet)."""
    good, bad = read_csv_apart(spark, path, schema)
    bad.write.mode("overwrite").parquet(side_table)
    return good


def _cells(header: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in header])


def _typed(cells: DataFrame, schema: T.StructType | str) -> DataFrame:
    """The declared columns of text cells, cast; a cell that cannot be cast is an error."""
    declared = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    out = []
    for f in declared.fields:
        cell = F.col(f"`{f.name}`")
        value = cell.try_cast(f.dataType)
        bad = F.raise_error(F.format_string(f"column {f.name}: '%s' is no {f.dataType.simpleString()}", cell))
        out.append(F.when(cell.isNotNull() & value.isNull(), bad.cast(f.dataType)).otherwise(value).alias(f.name))
    return cells.select(*out)


def read_table(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)


def write_csv(df: DataFrame, path: str, single_file: bool = False) -> None:
    out = df.coalesce(1) if single_file else df
    out.write.mode("overwrite").option("header", True).csv(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def save_factor(factor: DataFrame, path: str) -> None:
    """The adjustment factor as a one-row parquet table next to the model."""
    factor.coalesce(1).write.mode("overwrite").parquet(path)


def load_factor(spark: SparkSession, path: str) -> DataFrame:
    """The saved factor; it must be one row with a value (an empty table would
    lose every client it is applied to, two rows would double them)."""
    factor = spark.read.parquet(path)
    rows = factor.select("factor").limit(2).collect()
    if len(rows) != 1 or rows[0]["factor"] is None:
        raise ValueError(f"{path}: expected one row with a factor, found {rows}")
    return factor
