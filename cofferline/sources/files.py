"""Reading and writing tables. Parquet between steps, CSV at the edge."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from cofferline import schemas
from cofferline.functions.text import list_from_text, text_from_list


def _read_csv(spark: SparkSession, path: str, headers: dict[str, str]) -> DataFrame:
    schema = StructType([StructField(name, StringType()) for name in headers])
    raw = spark.read.csv(path, header=True, schema=schema, enforceSchema=False, escape='"', multiLine=False)
    return raw.select(*[F.col(f"`{raw_name}`").alias(name) for raw_name, name in headers.items()])


def read_accounts_csv(spark: SparkSession, path: str) -> DataFrame:
    """Account rows, all text."""
    return _read_csv(spark, path, schemas.ACCOUNT_HEADERS)


def read_portfolios_csv(spark: SparkSession, path: str) -> DataFrame:
    """Portfolio rows, all text."""
    return _read_csv(spark, path, schemas.PORTFOLIO_HEADERS)


def read_merged_csv(spark: SparkSession, path: str) -> DataFrame:
    """Portfolio rows with the account columns, all text."""
    return _read_csv(spark, path, schemas.MERGED_HEADERS)


def read_cleaned_csv(spark: SparkSession, path: str) -> DataFrame:
    """Cleaned holdings with their item key, all text."""
    return _read_csv(spark, path, schemas.CLEANED_HEADERS)


def read_baskets_csv(spark: SparkSession, path: str, separator: str = ",") -> DataFrame:
    """Baskets whose items are separated text. An item holding the separator is split in two."""
    rows = _read_csv(spark, path, {"Address": "owner", "Items": "items"})
    return rows.withColumn("items", F.split("items", f"\\Q{separator}\\E"))


def read_itemsets_csv(spark: SparkSession, path: str) -> DataFrame:
    """Itemsets written as list text."""
    rows = _read_csv(spark, path, {"items": "items", "freq": "freq"})
    return rows.select(list_from_text(F.col("items")).alias("items"), F.col("freq").cast("long"))


def read_rules_csv(spark: SparkSession, path: str) -> DataFrame:
    """Rules written as list text."""
    names = [field.name for field in schemas.RULES.fields]
    rows = _read_csv(spark, path, {name: name for name in names})
    return rows.select(
        list_from_text(F.col("antecedent")).alias("antecedent"),
        list_from_text(F.col("consequent")).alias("consequent"),
        *[F.col(name).cast("double") for name in names[2:]],
    )


def write_csv(df: DataFrame, path: str, one_file: bool = False) -> None:
    """Write text rows as CSV; arrays become list text. ``one_file`` is for small reports."""
    arrays = {f.name for f in df.schema.fields if f.dataType.typeName() == "array"}
    flat = df.select(
        *[text_from_list(F.col(c)).alias(c) if c in arrays else F.col(c) for c in df.columns]
    )
    if one_file:
        flat = flat.coalesce(1)
    flat.write.csv(path, header=True, mode="overwrite", escape='"')


def write_table(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Write Parquet, one folder per value of the given columns (a split or a grid cell)."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
