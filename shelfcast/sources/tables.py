"""Dataset readers and result writers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from shelfcast.fixed_values import ID_COLUMNS

CALENDAR_SCHEMA = T.StructType(
    [
        T.StructField("date", T.DateType()),
        T.StructField("wm_yr_wk", T.IntegerType()),
        T.StructField("weekday", T.StringType()),
        T.StructField("wday", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("d", T.StringType()),
        T.StructField("event_name_1", T.StringType()),
        T.StructField("event_type_1", T.StringType()),
        T.StructField("event_name_2", T.StringType()),
        T.StructField("event_type_2", T.StringType()),
        T.StructField("snap_CA", T.IntegerType()),
        T.StructField("snap_TX", T.IntegerType()),
        T.StructField("snap_WI", T.IntegerType()),
    ]
)

PRICES_SCHEMA = T.StructType(
    [
        T.StructField("store_id", T.StringType()),
        T.StructField("item_id", T.StringType()),
        T.StructField("wm_yr_wk", T.IntegerType()),
        T.StructField("sell_price", T.DoubleType()),
    ]
)


def read_csv(spark: SparkSession, path: str, declared: T.StructType) -> DataFrame:
    """CSV by declared types in the order of the header line.

    Key columns are text and day columns whole numbers; no values are scanned
    to guess types.
    """
    types = {f.name: f.dataType for f in declared} | {c: T.StringType() for c in ID_COLUMNS}
    header = spark.read.csv(path, header=True).columns
    fields = [T.StructField(c, types.get(c, T.IntegerType())) for c in header]
    return spark.read.csv(path, header=True, schema=T.StructType(fields))


def read_dataset(spark: SparkSession, folder: str, fmt: str = "csv") -> dict[str, DataFrame]:
    """The sales, calendar and prices tables of one folder."""
    names = {"sales": T.StructType([]), "calendar": CALENDAR_SCHEMA, "prices": PRICES_SCHEMA}
    if fmt == "parquet":
        return {n: spark.read.parquet(f"{folder}/{n}.parquet") for n in names}
    if fmt != "csv":
        raise ValueError(f"unknown format {fmt!r}; use csv or parquet")
    return {n: read_csv(spark, f"{folder}/{n}.csv", declared) for n, declared in names.items()}


def write_dataset(tables: dict[str, DataFrame], folder: str, fmt: str = "csv") -> None:
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        if fmt == "csv":
            writer.csv(f"{folder}/{name}.csv", header=True)
        else:
            writer.parquet(f"{folder}/{name}.parquet")


def write_by_store(df: DataFrame, path: str, store_col: str = "store_id") -> None:
    """Parquet partitioned by store, so that a store view reads one folder.

    The date joins the shuffle key: a store with most of the rows is written
    by many tasks.
    """
    keys = [c for c in (store_col, "date") if c in df.columns]
    df.repartition(*keys).write.mode("overwrite").partitionBy(store_col).parquet(path)


def read_by_store(spark: SparkSession, path: str, stores: list[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df if stores is None else df.filter(df["store_id"].isin(stores))
