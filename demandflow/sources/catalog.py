"""Load a directory of tables into a catalog, resolve tables by role, Parquet/CSV I/O."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Declared types of the raw CSV columns, applied by column name (no inference pass).
_TS = T.TimestampNTZType()
REFERENCE_SCHEMAS: dict[str, T.StructType] = {
    "orders": T.StructType([
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("order_status", T.StringType()),
        T.StructField("order_purchase_timestamp", T.StringType()),
        T.StructField("order_approved_at", T.StringType()),
        T.StructField("order_delivered_carrier_date", T.StringType()),
        T.StructField("order_delivered_customer_date", T.StringType()),
        T.StructField("order_estimated_delivery_date", T.StringType()),
    ]),
    "order_items": T.StructType([
        T.StructField("order_id", T.StringType()),
        T.StructField("order_item_id", T.LongType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("seller_id", T.StringType()),
        T.StructField("shipping_limit_date", T.StringType()),
        T.StructField("price", T.DoubleType()),
        T.StructField("freight_value", T.DoubleType()),
    ]),
    "products": T.StructType([
        T.StructField("product_id", T.StringType()),
        T.StructField("product_category_name", T.StringType()),
    ]),
    "customers": T.StructType([
        T.StructField("customer_id", T.StringType()),
        T.StructField("customer_unique_id", T.StringType()),
        T.StructField("customer_zip_code_prefix", T.StringType()),
        T.StructField("customer_city", T.StringType()),
        T.StructField("customer_state", T.StringType()),
    ]),
    "order_reviews": T.StructType([
        T.StructField("review_id", T.StringType()),
        T.StructField("order_id", T.StringType()),
        T.StructField("review_score", T.IntegerType()),
    ]),
}


def _schema_for(name: str, schemas: dict[str, T.StructType] | None) -> T.StructType | None:
    schemas = REFERENCE_SCHEMAS if schemas is None else schemas
    lowered = name.lower()
    for role in sorted(schemas, key=len, reverse=True):
        if role in lowered:
            return schemas[role]
    return None


#: Roles whose CSV holds free text with line breaks.
MULTI_LINE_ROLES = ("review",)


def _path(spark: SparkSession, path: str):
    """A path and its file system, whichever store it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def list_tables(spark: SparkSession, base_dir: str, fmt: str) -> dict[str, str]:
    """Base name -> path of every ``*.<fmt>`` file or directory of ``base_dir``, sorted, on any
    store that Spark reads."""
    p, fs = _path(spark, f"{base_dir.rstrip('/')}/*.{fmt}")
    return {s.getPath().getName(): s.getPath().toString() for s in sorted(fs.globStatus(p) or [], key=lambda s: s.getPath().getName())}


def load_dataset(spark: SparkSession, base_dir: str, fmt: str = "csv", schemas: dict[str, T.StructType] | None = None,
                 multi_line: Iterable[str] = MULTI_LINE_ROLES) -> dict[str, DataFrame]:
    """Every ``*.csv`` (or ``*.parquet``) table of ``base_dir`` keyed by base name.

    CSV columns are read by header name as text (no inference pass over the data), then
    the columns declared for the file's role are cast by name; a declared schema is never
    applied by position, so column order in the file does not matter.  Reads are lazy.
    A CSV is cut into as many tasks as its size asks for, unless its name holds one of
    ``multi_line``: quoted line breaks can only be read from a file's start.
    """
    catalog: dict[str, DataFrame] = {}
    for name, path in list_tables(spark, base_dir, fmt).items():
        if fmt != "csv":
            catalog[name] = spark.read.parquet(path)
            continue
        whole = any(role in name.lower() for role in multi_line)
        df = (spark.read.option("header", True).option("inferSchema", False).option("multiLine", whole)
              .option("escape", '"').csv(path))
        schema = _schema_for(name, schemas)
        if schema is not None:
            types = {f.name: f.dataType for f in schema.fields}
            df = df.select(*[F.col(c).cast(types[c]).alias(c) if c in types and not isinstance(
                types[c], T.StringType) else F.col(c) for c in df.columns])
        catalog[name] = df
    return catalog


def resolve_table(catalog: dict[str, DataFrame], role: str) -> DataFrame:
    """The first table (in sorted name order) whose name contains ``role``,
    case-insensitive; a missing role raises ``KeyError``."""
    needle = role.lower()
    for key in sorted(catalog):
        if needle in key.lower():
            return catalog[key]
    raise KeyError(f"no table for role {role!r} among {sorted(catalog)}")


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    """S3: Parquet scan; a path that its store does not have raises ``FileNotFoundError`` up front."""
    p, fs = _path(spark, path)
    if not fs.exists(p):
        raise FileNotFoundError(path)
    return spark.read.parquet(path)


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Overwrite a Parquet data set (optionally partitioned, e.g. by period year)."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Report table as CSV with a header row, quotes doubled as in RFC 4180."""
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)


def read_csv_semi(spark: SparkSession, path: str, df: DataFrame, key: str = "feature",
                  schema: T.StructType | str | None = None) -> DataFrame:
    """Re-read a saved report and keep its rows whose ``key`` is in ``df``."""
    reader = spark.read.option("header", True).option("escape", '"')
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    report = reader.csv(path)
    return report.join(df.select(key).distinct(), key, "left_semi")
