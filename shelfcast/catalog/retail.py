"""Retail tables derived from the order tables, in Spark and in SQL.

A part's type is its department and the noun of its name, within the type,
its item; a supplier's region is its state and the region's nations form two
stores. Sales are shipped quantities over the whole span of ship dates.
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfcast.functions import dates as D
from shelfcast.operators import panel as P
from shelfcast.session import cut_lineage
from shelfcast.sources import calendar as C

# Category of each department.
CATEGORIES = {
    "CAT_A": ["ECONOMY", "STANDARD"],
    "CAT_B": ["SMALL", "MEDIUM"],
    "CAT_C": ["LARGE", "PROMO"],
}

# State flags; the two states left out test the "no flag" branch.
STATE_FLAGS = {"AFRICA": "snap_CA", "AMERICA": "snap_TX", "ASIA": "snap_WI"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shipments(spark: SparkSession, sf_dir: str, since: date | None = None) -> DataFrame:
    """Line items with item and store keys, of all days or from a day on; the day reaches the scan.

    The dimensions join one after the other without hints: Spark broadcasts
    those whose files are small and joins the others by shuffle, where a hot
    part or supplier is split at run time.
    """
    dept, item_noun = F.col("p_type"), F.split("p_name", " ").getItem(1)
    cat = F.when(dept.isin(CATEGORIES["CAT_A"]), "CAT_A").when(dept.isin(CATEGORIES["CAT_B"]), "CAT_B")
    lines = table(spark, sf_dir, "lineitem")
    if since is not None:
        start = F.lit(since.isoformat()).cast(lines.schema["l_shipdate"].dataType)
        lines = lines.filter(F.col("l_shipdate") >= start)
    lines = lines.select(
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", F.to_date("l_shipdate").alias("date")
    )
    joined = (
        lines.join(table(spark, sf_dir, "part"), F.col("l_partkey") == F.col("p_partkey"))
        .join(table(spark, sf_dir, "supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey"))
        .join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return joined.select(
        F.concat_ws("_", dept, item_noun).alias("item_id"),
        dept.alias("dept_id"),
        cat.otherwise("CAT_C").alias("cat_id"),
        F.concat_ws("_", "r_name", (F.col("n_nationkey") % 2).cast("string")).alias("store_id"),
        F.col("r_name").alias("state_id"),
        "date",
        "l_quantity",
        "l_extendedprice",
    )


def bounds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and last ship date, one row."""
    lines = table(spark, sf_dir, "lineitem").select(F.to_date("l_shipdate").alias("date"))
    return C.date_bounds(lines)


def daily_sales(spark: SparkSession, sf_dir: str, since: date | None = None) -> DataFrame:
    """Series and days with shipments; partial sums are combined before the shuffle."""
    keys = ["item_id", "dept_id", "cat_id", "store_id", "state_id"]
    sums = shipments(spark, sf_dir, since).groupBy(*keys, "date").agg(F.sum("l_quantity").alias("sales"))
    return sums.select(F.concat_ws("_", "item_id", "store_id").alias("id"), *keys, "date", "sales")


def sold_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily sales with the sum and number of the unit prices behind them, from one pass over the line items.

    It is written once, as sales and prices both come from it; it has one row for each series and day with shipments.
    """
    keys = ["item_id", "dept_id", "cat_id", "store_id", "state_id"]
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    sums = shipments(spark, sf_dir).groupBy(*keys, "date").agg(
        F.sum("l_quantity").alias("sales"), F.sum(unit).alias("units"), F.count(unit).alias("n_units")
    )
    return cut_lineage(sums.select(F.concat_ws("_", "item_id", "store_id").alias("id"), *keys, "date", "sales", "units", "n_units"))


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every series on every day, partitioned by series."""
    ends = bounds(spark, sf_dir)
    return P.densify(
        daily_sales(spark, sf_dir), ends.select("first").scalar(), ends.select("last").scalar()
    )


def stored_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel written once, for queries that read it several times.

    It is far smaller than the line items it comes from.
    """
    return cut_lineage(panel(spark, sf_dir))


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every series with its keys."""
    keys = ["item_id", "dept_id", "cat_id", "store_id", "state_id"]
    known = shipments(spark, sf_dir).select(*keys).distinct()
    return known.select(F.concat_ws("_", "item_id", "store_id").alias("id"), *keys)


def recent_panel(spark: SparkSession, sf_dir: str, days: int) -> DataFrame:
    """Every series on the last ``days`` days, written once; older shipments only name the series."""
    last = bounds(spark, sf_dir).select("last").first()[0]
    first = last - timedelta(days=days - 1)
    every = F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))).alias("date")
    sold = daily_sales(spark, sf_dir, first).select("id", "date", "sales")
    filled = series(spark, sf_dir).select("*", every).join(sold, ["id", "date"], "left")
    return cut_lineage(filled.withColumn("sales", F.coalesce("sales", F.lit(0.0))))


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean unit price by store, item and ISO week."""
    unit = F.col("l_extendedprice") / F.col("l_quantity")
    return (
        shipments(spark, sf_dir)
        .groupBy("store_id", "item_id", D.iso_week_key(F.col("date")).alias("wm_yr_wk"))
        .agg(F.avg(unit).alias("sell_price"))
    )


def prices_of(sold: DataFrame) -> DataFrame:
    """Mean unit price by store, item and ISO week from the sums of ``sold_days``."""
    weeks = sold.groupBy("store_id", "item_id", D.iso_week_key(F.col("date")).alias("wm_yr_wk"))
    return weeks.agg((F.sum("units") / F.nullif(F.sum("n_units"), F.lit(0))).alias("sell_price"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event days by rule within the span of ship dates."""
    return events_between(bounds(spark, sf_dir))


def events_between(span: DataFrame) -> DataFrame:
    """Event days by rule; ``span`` holds one row (first, last)."""
    day = F.col("date")
    sunday, thursday = D.day_of_week(day) == 6, D.day_of_week(day) == 3
    month, dom = F.month(day), F.dayofmonth(day)
    fixed = lambda m, d: (month == m) & (dom == d)
    rules = [
        ("SuperBowl", "Sporting", (month == 2) & sunday & (dom <= 7)),
        ("ValentinesDay", "Cultural", fixed(2, 14)),
        ("MotherDay", "Cultural", (month == 5) & sunday & dom.between(8, 14)),
        ("Halloween", "Cultural", fixed(10, 31)),
        ("Thanksgiving", "National", (month == 11) & thursday & dom.between(22, 28)),
        ("Christmas", "National", fixed(12, 25)),
    ]
    event = F.lit(None)
    for name, kind, rule in rules:
        event = F.when(rule, F.struct(F.lit(name).alias("name"), F.lit(kind).alias("type"))).otherwise(event)
    days = C.days_between(span).withColumn("e", event).filter(F.col("e").isNotNull())
    return days.select("date", F.col("e.name").alias("event_name_1"), F.col("e.type").alias("event_type_1"))


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.build_calendar(bounds(spark, sf_dir), events(spark, sf_dir))


def coming_calendar(spark: SparkSession, sf_dir: str, days: int) -> DataFrame:
    """Calendar of the days after the last ship date."""
    last = F.col("last")
    span = bounds(spark, sf_dir).select(F.date_add(last, 1).alias("first"), F.date_add(last, days).alias("last"))
    return C.build_calendar(span, events_between(span))


def dated_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel with its calendar columns."""
    return P.merge_calendar(panel(spark, sf_dir), calendar(spark, sf_dir), "date")


def dated_panel_of(spark: SparkSession, sf_dir: str, sold: DataFrame) -> DataFrame:
    """The dated panel from ``sold_days``; line items are read for their first and last day only, once."""
    span = cut_lineage(bounds(spark, sf_dir))
    first, last = span.select("first").scalar(), span.select("last").scalar()
    long = P.densify(sold.drop("units", "n_units"), first, last)
    return P.merge_calendar(long, C.build_calendar(span, events_between(span)), "date")


def priced_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel with calendar, prices and state flags."""
    df = P.merge_prices(dated_panel(spark, sf_dir), prices(spark, sf_dir))
    return P.add_snap_flag(df, STATE_FLAGS)


SHIPMENTS_SQL = """
ship AS (
  SELECT concat_ws('_', p_type, split_part(p_name, ' ', 2)) AS item_id, p_type AS dept_id,
         CASE WHEN p_type IN ('ECONOMY', 'STANDARD') THEN 'CAT_A'
              WHEN p_type IN ('SMALL', 'MEDIUM') THEN 'CAT_B' ELSE 'CAT_C' END AS cat_id,
         concat_ws('_', r_name, CAST(n_nationkey % 2 AS VARCHAR)) AS store_id, r_name AS state_id,
         CAST(l_shipdate AS DATE) AS date, l_quantity, l_extendedprice
  FROM lineitem
  JOIN part ON l_partkey = p_partkey
  JOIN supplier ON l_suppkey = s_suppkey
  JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
)"""

DAYS_SQL = """
bounds AS (SELECT CAST(min(l_shipdate) AS DATE) AS lo, CAST(max(l_shipdate) AS DATE) AS hi FROM lineitem),
days AS (SELECT CAST(unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date FROM bounds)"""

PANEL_SQL = (
    SHIPMENTS_SQL
    + ","
    + DAYS_SQL
    + """,
sparse AS (SELECT item_id, store_id, date, sum(l_quantity) AS sales FROM ship GROUP BY ALL),
series AS (
  SELECT DISTINCT concat_ws('_', item_id, store_id) AS id, item_id, dept_id, cat_id, store_id, state_id FROM ship
),
panel AS (
  SELECT s.*, d.date, coalesce(x.sales, 0.0) AS sales
  FROM series s CROSS JOIN days d
  LEFT JOIN sparse x ON x.item_id = s.item_id AND x.store_id = s.store_id AND x.date = d.date
)"""
)

CALENDAR_SQL = """
event_days AS (
  SELECT date,
    CASE WHEN month(date) = 12 AND day(date) = 25 THEN 'Christmas'
         WHEN month(date) = 11 AND isodow(date) = 4 AND day(date) BETWEEN 22 AND 28 THEN 'Thanksgiving'
         WHEN month(date) = 10 AND day(date) = 31 THEN 'Halloween'
         WHEN month(date) = 5 AND isodow(date) = 7 AND day(date) BETWEEN 8 AND 14 THEN 'MotherDay'
         WHEN month(date) = 2 AND day(date) = 14 THEN 'ValentinesDay'
         WHEN month(date) = 2 AND isodow(date) = 7 AND day(date) <= 7 THEN 'SuperBowl' END AS event_name_1
  FROM days
),
events_found AS (
  SELECT date, event_name_1,
    CASE WHEN event_name_1 IN ('Christmas', 'Thanksgiving') THEN 'National'
         WHEN event_name_1 = 'SuperBowl' THEN 'Sporting' ELSE 'Cultural' END AS event_type_1
  FROM event_days WHERE event_name_1 IS NOT NULL
),
cal AS (
  SELECT date, CAST(isoyear(date) * 100 + week(date) AS INTEGER) AS wm_yr_wk, dayname(date) AS weekday,
         CAST(isodow(date) AS INTEGER) AS wday, CAST(month(date) AS INTEGER) AS month,
         CAST(year(date) AS INTEGER) AS year,
         'd_' || CAST(date_diff('day', (SELECT lo FROM bounds), date) + 1 AS VARCHAR) AS d,
         event_name_1, event_type_1,
         CAST(NULL AS VARCHAR) AS event_name_2, CAST(NULL AS VARCHAR) AS event_type_2,
         CAST(day(date) <= 6 AS INTEGER) AS snap_CA, CAST(day(date) <= 7 AS INTEGER) AS snap_TX,
         CAST(day(date) <= 8 AS INTEGER) AS snap_WI
  FROM days LEFT JOIN events_found USING (date)
)"""

PRICES_SQL = """
prices AS (
  SELECT store_id, item_id, CAST(isoyear(date) * 100 + week(date) AS INTEGER) AS wm_yr_wk,
         avg(l_extendedprice / l_quantity) AS sell_price
  FROM ship GROUP BY ALL
)"""

PRICED_SQL = """
joined AS (
  SELECT p.*, c.* EXCLUDE (date), r.sell_price AS raw_price
  FROM panel p JOIN cal c USING (date)
  LEFT JOIN prices r ON r.store_id = p.store_id AND r.item_id = p.item_id AND r.wm_yr_wk = c.wm_yr_wk
),
medians AS (SELECT item_id, store_id, median(raw_price) AS med FROM joined GROUP BY ALL),
filled AS (
  SELECT j.*, coalesce(raw_price, med) AS group_price FROM joined j JOIN medians USING (item_id, store_id)
),
priced AS (
  SELECT * EXCLUDE (raw_price, group_price),
         coalesce(group_price, (SELECT median(group_price) FROM filled), 1.0) AS sell_price,
         CASE state_id WHEN 'AFRICA' THEN snap_CA WHEN 'AMERICA' THEN snap_TX WHEN 'ASIA' THEN snap_WI
              ELSE 0 END AS snap
  FROM filled
)"""


def with_ship(body: str) -> str:
    return f"WITH {SHIPMENTS_SQL} {body}"


def with_calendar(body: str, *ctes: str) -> str:
    return "WITH " + ", ".join([DAYS_SQL, CALENDAR_SQL, *ctes]) + "\n" + body


def with_panel(body: str, *ctes: str) -> str:
    return "WITH " + ", ".join([PANEL_SQL, *ctes]) + "\n" + body


def with_dated(body: str, *ctes: str) -> str:
    return with_panel(body, CALENDAR_SQL, *ctes)


def with_priced(body: str, *ctes: str) -> str:
    return with_panel(body, CALENDAR_SQL, PRICES_SQL, PRICED_SQL, *ctes)


def r6(column) -> Column:
    """Six digits, without a negative zero."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column, 6) + F.lit(0.0)


def rounded(df: DataFrame) -> DataFrame:
    """Round every double column for comparison across engines."""
    return df.select(*[r6(c).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])
