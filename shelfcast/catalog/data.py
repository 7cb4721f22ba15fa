"""Sources, reshapes, projections, filters: queries S, R and P."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.catalog import query
from shelfcast.catalog import retail as R
from shelfcast.catalog.profiles import NAIVE_SQL, SPLIT_SQL, lag_sql, profile, profile_sql, rolling_sql
from shelfcast.fixed_values import CALENDAR_COLUMNS, ENCODED_COLUMNS, ID_COLUMNS, LAGS, WINDOWS
from shelfcast.functions import scalars as S
from shelfcast.operators import features as X
from shelfcast.operators import metrics as M
from shelfcast.operators import ordering as O
from shelfcast.operators import panel as P
from shelfcast.operators import reshape
from shelfcast.session import shared_folder
from shelfcast.sources import calendar as C
from shelfcast.sources import tables as T


def _scratch(spark, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def _wide(spark, sf_dir) -> DataFrame:
    first, last = R.bounds(spark, sf_dir).first()
    return reshape.widen_sales(R.panel(spark, sf_dir), (last - first).days + 1)


@query(
    "s1_csv_dataset",
    R.with_panel(
        """SELECT store_id, n_days, sum_sales, n_prices, sum_price FROM
        (SELECT store_id, count(*) AS n_days, sum(sales) AS sum_sales FROM panel GROUP BY store_id)
        JOIN (SELECT store_id, count(*) AS n_prices, round(sum(sell_price), 4) + 0.0 AS sum_price
              FROM prices GROUP BY store_id) USING (store_id)""",
        R.PRICES_SQL,
    ),
)
def s1_csv_dataset(spark, sf_dir):
    """Write the three tables as CSV, read them by schema, total them by store."""
    folder = _scratch(spark, "dataset")
    wide = _wide(spark, sf_dir)
    ids = [c for c in wide.columns if c in ID_COLUMNS]
    wide = wide.selectExpr(*ids, *[f"CAST({c} AS INT) AS {c}" for c in reshape.day_columns(wide)])
    T.write_dataset(
        {"sales": wide, "calendar": R.calendar(spark, sf_dir), "prices": R.prices(spark, sf_dir)}, folder
    )
    read = T.read_dataset(spark, folder)
    long = P.merge_calendar(reshape.melt_sales(read["sales"]), read["calendar"])
    sold = long.groupBy("store_id").agg(F.count("date").alias("n_days"), F.sum("sales").alias("sum_sales"))
    priced = read["prices"].groupBy("store_id").agg(
        F.count("*").alias("n_prices"), (F.round(F.sum("sell_price"), 4) + 0.0).alias("sum_price")
    )
    return sold.join(priced, "store_id")


@query("s2_calendar", R.with_calendar(f"SELECT {', '.join(CALENDAR_COLUMNS)} FROM cal"))
def s2_calendar(spark, sf_dir):
    return R.calendar(spark, sf_dir)


@query("s3_event_lookup", R.with_calendar("SELECT date, event_name_1, event_type_1 FROM events_found"))
def s3_event_lookup(spark, sf_dir):
    return R.events(spark, sf_dir)


@query(
    "s5_forecast_sink",
    R.with_panel(
        """SELECT store_id, count(*) AS n_rows, round(sum(forecast), 6) + 0.0 AS forecast,
        min(date) AS first_day, max(date) AS last_day FROM pairs GROUP BY store_id""",
        NAIVE_SQL,
    ),
)
def s5_forecast_sink(spark, sf_dir):
    """Forecasts written by store and read back."""
    path = _scratch(spark, "forecasts")
    train, val = P.train_val_split(R.stored_panel(spark, sf_dir))
    T.write_by_store(M.pair_forecasts(val, M.naive_baseline(val, train)), path)
    return (
        T.read_by_store(spark, path)
        .groupBy("store_id")
        .agg(
            F.count("*").alias("n_rows"),
            R.r6(F.sum("forecast")).alias("forecast"),
            F.min("date").alias("first_day"),
            F.max("date").alias("last_day"),
        )
    )


@query(
    "r1_melt_sales",
    R.with_panel(
        """SELECT store_id, 'd_' || CAST(date_diff('day', (SELECT lo FROM bounds), date) + 1 AS VARCHAR) AS d,
        count(*) AS n_rows, count(sales) AS n_sales, round(avg(sales) + 1.1e-8, 6) + 0.0 AS avg_sales
        FROM panel GROUP BY ALL"""
    ),
)
def r1_melt_sales(spark, sf_dir):
    folder = _scratch(spark, "wide")
    T.write_dataset({"sales": _wide(spark, sf_dir)}, folder, "parquet")
    wide = spark.read.parquet(f"{folder}/sales.parquet")
    return profile(reshape.melt_sales(wide), ["sales"], ["store_id", "d"])


@query(
    "r2_last_28_days",
    R.with_panel(
        "SELECT id, sum(sales) AS sales FROM train WHERE date > (SELECT max(date) FROM train) - 28 GROUP BY id",
        SPLIT_SQL,
    ),
)
def r2_last_28_days(spark, sf_dir):
    train, _ = P.train_val_split(R.stored_panel(spark, sf_dir))
    return P.trailing_days(train, 28).groupBy("id").agg(F.sum("sales").alias("sales"))


_STORES = [f"{s}_{n}" for s in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST") for n in (0, 1)]


@query(
    "r3_metric_matrix",
    R.with_panel(
        "SELECT metric, "
        + ", ".join(f"max(value) FILTER (store_id = '{s}') AS \"{s}\"" for s in _STORES)
        + """
        FROM (SELECT store_id, 'total_sales' AS metric, sum(sales) AS value FROM panel GROUP BY store_id
              UNION ALL SELECT store_id, 'mean_sales', round(avg(sales), 6) + 0.0 FROM panel GROUP BY store_id)
        GROUP BY metric"""
    ),
)
def r3_metric_matrix(spark, sf_dir):
    stores = R.panel(spark, sf_dir).groupBy("store_id").agg(
        F.sum("sales").alias("total_sales"), R.r6(F.avg("sales")).alias("mean_sales")
    )
    return reshape.metric_matrix(stores, "store_id", ["total_sales", "mean_sales"], _STORES)


@query("p1_tolerant_projection", R.with_panel("SELECT state_id, id, date, sales FROM panel JOIN sparse USING (item_id, store_id, date, sales)"))
def p1_tolerant_projection(spark, sf_dir):
    return P.pick(R.daily_sales(spark, sf_dir), ["state_id", "colour", "id", "date", "sales"])


@query(
    "p2_snap_flag",
    R.with_dated(
        """SELECT state_id, date, count(*) AS n_rows,
        CAST(sum(CASE state_id WHEN 'AFRICA' THEN snap_CA WHEN 'AMERICA' THEN snap_TX WHEN 'ASIA' THEN snap_WI
                 ELSE 0 END) AS BIGINT) AS snap_rows
        FROM panel JOIN cal USING (date) GROUP BY state_id, date"""
    ),
)
def p2_snap_flag(spark, sf_dir):
    flagged = P.add_snap_flag(R.dated_panel(spark, sf_dir), R.STATE_FLAGS)
    return flagged.groupBy("state_id", "date").agg(
        F.count("*").alias("n_rows"), F.sum("snap").alias("snap_rows")
    )


_WHOLE = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
_FLOATING = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _narrow_sql() -> str:
    def whole(c):
        steps = [("tinyint", 7), ("smallint", 15), ("int", 31)]
        cases = " ".join(
            f"WHEN min({c}) >= -{2**b} AND max({c}) < {2**b} THEN '{t}'" for t, b in steps
        )
        return f"SELECT '{c}' AS column_name, CASE {cases} ELSE 'bigint' END AS narrow_type FROM lineitem"

    def floating(c):
        return (
            f"SELECT '{c}', CASE WHEN max(abs({c})) <= 3.4028234663852886e38 THEN 'float' ELSE 'double' END"
            " FROM lineitem"
        )

    text = [f"SELECT '{c}', 'string'" for c in ("l_returnflag", "l_linestatus")]
    text.append("SELECT 'l_shipdate', 'timestamp_ntz'")  # dates stay as they are
    return " UNION ALL ".join([whole(c) for c in _WHOLE] + [floating(c) for c in _FLOATING] + text)


@query("p3_narrow_types", _narrow_sql())
def p3_narrow_types(spark, sf_dir):
    lines = R.table(spark, sf_dir, "lineitem")
    narrow = P.narrow_types(lines)
    types = narrow.agg(*[F.max(F.typeof(c)).alias(c) for c in narrow.columns])
    return types.unpivot([], narrow.columns, "column_name", "narrow_type")


_LABELS_SQL = "labels_found AS (" + " UNION ".join(
    f"SELECT '{c}' AS col, {c} AS label FROM panel JOIN cal USING (date) WHERE {c} IS NOT NULL"
    for c in ENCODED_COLUMNS
) + "), codes AS (SELECT col, CAST(row_number() OVER (PARTITION BY col ORDER BY label) - 1 AS INTEGER) AS code, label FROM labels_found)"


@query("p4_label_codes", R.with_dated("SELECT col, code, label FROM codes", _LABELS_SQL))
def p4_label_codes(spark, sf_dir):
    return O.fit_encoders(R.dated_panel(spark, sf_dir))


_CODED_SQL = "coded AS (SELECT sales, " + ", ".join(f"coalesce(k{i}.code, -1) AS {c}" for i, c in enumerate(ENCODED_COLUMNS)) + " FROM panel p JOIN cal c USING (date) " + " ".join(
    f"LEFT JOIN codes k{i} ON k{i}.col = '{c}' AND k{i}.label = {'c' if c in CALENDAR_COLUMNS else 'p'}.{c}"
    for i, c in enumerate(ENCODED_COLUMNS)
) + ")"


@query(
    "p4_encode_labels",
    R.with_dated(
        """SELECT item_id, dept_id, cat_id, store_id, state_id, count(*) AS n_rows,
        CAST(sum(weekday) AS BIGINT) AS weekday, CAST(sum(event_name_1) AS BIGINT) AS event_name_1,
        CAST(sum(event_type_1) AS BIGINT) AS event_type_1 FROM coded GROUP BY 1, 2, 3, 4, 5""",
        _LABELS_SQL,
        _CODED_SQL,
    ),
)
def p4_encode_labels(spark, sf_dir):
    df = R.dated_panel(spark, sf_dir)
    coded = O.encode_labels(df, O.fit_encoders(df))
    ids = ["item_id", "dept_id", "cat_id", "store_id", "state_id"]
    return coded.groupBy(*ids).agg(
        F.count("*").alias("n_rows"),
        *[F.sum(c).alias(c) for c in ("weekday", "event_name_1", "event_type_1")],
    )


@query(
    "p5_decode_labels",
    R.with_dated(
        """SELECT coalesce(event_name_1, '-1') AS event_name_1, store_id, count(*) AS n_rows, sum(sales) AS sales
        FROM panel JOIN cal USING (date) GROUP BY 1, 2"""
    ),
)
def p5_decode_labels(spark, sf_dir):
    df = R.dated_panel(spark, sf_dir)
    encoders = O.fit_encoders(df, ["event_name_1", "store_id"])
    coded = O.encode_labels(df, encoders, ["event_name_1", "store_id"])
    sums = coded.groupBy("event_name_1", "store_id").agg(
        F.count("*").alias("n_rows"), F.sum("sales").alias("sales")
    )
    return O.decode_labels(O.decode_labels(sums, encoders, "event_name_1"), encoders, "store_id")


_PART_COLUMNS = "count(*) AS n_rows, min(date) AS first_day, max(date) AS last_day, sum(sales) AS sales"


def _part(df: DataFrame, name: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("n_rows"),
        F.min("date").alias("first_day"),
        F.max("date").alias("last_day"),
        F.sum("sales").alias("sales"),
    ).withColumn("part", F.lit(name))


@query(
    "p6_train_val_split",
    R.with_panel(
        f"SELECT 'train' AS part, {_PART_COLUMNS} FROM train UNION ALL SELECT 'val', {_PART_COLUMNS} FROM val",
        SPLIT_SQL,
    ),
)
def p6_train_val_split(spark, sf_dir):
    train, val = P.train_val_split(R.stored_panel(spark, sf_dir))
    return _part(train, "train").unionByName(_part(val, "val"))


_LAGS_SQL = (
    f"lagged AS (SELECT *, {', '.join(lag_sql(LAGS) + rolling_sql(WINDOWS))} FROM panel "
    "WINDOW w AS (PARTITION BY id ORDER BY date))"
)
_LAG_NAMES = [f"sales_lag_{n}" for n in LAGS]
_ROLLING_NAMES = [f"rolling_{s}_{k}" for k in WINDOWS for s in ("mean", "std")]


@query(
    "p7_validation_features",
    R.with_panel(
        profile_sql("lagged", _LAG_NAMES + _ROLLING_NAMES, ["id"]).replace(
            " FROM lagged", " FROM lagged WHERE date >= (SELECT max(date) - 27 FROM panel)"
        ),
        _LAGS_SQL,
    ),
)
def p7_validation_features(spark, sf_dir):
    """Lags of the validation days reach back into the training days."""
    full = R.stored_panel(spark, sf_dir)
    features = X.add_rolling_features(X.add_lag_features(full))
    val = features.filter(F.col("date") >= P.validation_start(full))
    return profile(val, _LAG_NAMES + _ROLLING_NAMES, ["id"])


@query(
    "p8_drop_missing_lags",
    R.with_panel(
        """SELECT id, count(*) AS n_rows, min(date) AS first_day FROM lagged
        WHERE sales_lag_28 IS NOT NULL AND rolling_mean_28 IS NOT NULL GROUP BY id""",
        _LAGS_SQL,
    ),
)
def p8_drop_missing_lags(spark, sf_dir):
    features = X.add_rolling_features(X.add_lag_features(R.panel(spark, sf_dir)))
    return P.drop_missing_lags(features).groupBy("id").agg(
        F.count("*").alias("n_rows"), F.min("date").alias("first_day")
    )


@query(
    "p9_trailing_windows",
    R.with_panel(
        f"""SELECT 'year' AS part, {_PART_COLUMNS} FROM panel WHERE date > (SELECT max(date) FROM panel) - 365
        UNION ALL SELECT 'offset', {_PART_COLUMNS} FROM panel
          WHERE date > (SELECT max(date) FROM panel) - 56 AND date <= (SELECT max(date) FROM panel) - 28
        UNION ALL SELECT 'recent', {_PART_COLUMNS} FROM panel WHERE date >= (SELECT max(date) FROM panel) - 7"""
    ),
)
def p9_trailing_windows(spark, sf_dir):
    df = R.stored_panel(spark, sf_dir)
    last = P.last_day(df)
    parts = [
        _part(P.trailing_days(df, 365), "year"),
        _part(P.trailing_days(df, 56).filter(F.col("date") <= F.date_sub(last, 28)), "offset"),
        _part(P.trailing_days(df, 8), "recent"),
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query(
    "p10_clamp",
    """SELECT l_returnflag, round(sum(greatest(l_extendedprice - 30000, 0.0)), 4) + 0.0 AS above,
    round(sum(l_quantity / greatest(l_discount, 0.01)), 4) + 0.0 AS guarded FROM lineitem GROUP BY l_returnflag""",
)
def p10_clamp(spark, sf_dir):
    above = S.at_least(F.col("l_extendedprice") - 30000, 0.0)
    guarded = F.col("l_quantity") / S.at_least(F.col("l_discount"), 0.01)
    return R.table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(
        (F.round(F.sum(above), 4) + 0.0).alias("above"), (F.round(F.sum(guarded), 4) + 0.0).alias("guarded")
    )


@query(
    "p11_default_fill",
    R.with_panel(
        "SELECT id, count(*) AS n_rows, sum(coalesce(sales_lag_42, 0)) AS filled, sum(coalesce(sales_lag_42, 1)) AS ones FROM lagged GROUP BY id",
        _LAGS_SQL,
    ),
)
def p11_default_fill(spark, sf_dir):
    lagged = X.add_lag_features(R.panel(spark, sf_dir), [42])
    zero = lagged.withColumn("one", F.coalesce("sales_lag_42", F.lit(1.0))).fillna(0.0, ["sales_lag_42"])
    return zero.groupBy("id").agg(
        F.count("*").alias("n_rows"), F.sum("sales_lag_42").alias("filled"), F.sum("one").alias("ones")
    )


@query(
    "p12_drill_down",
    R.with_ship(
        """SELECT dept_id, date, sum(l_quantity) AS sales FROM ship
        WHERE store_id = 'ASIA_1' AND item_id LIKE 'SMALL%' GROUP BY dept_id, date"""
    ),
)
def p12_drill_down(spark, sf_dir):
    df = R.daily_sales(spark, sf_dir)
    chosen = df.filter((F.col("store_id") == "ASIA_1") & F.col("id").startswith("SMALL"))
    return chosen.groupBy("dept_id", "date").agg(F.sum("sales").alias("sales"))


@query(
    "p13_event_and_zero_filters",
    R.with_dated(
        """SELECT event_name_1, count(*) AS n_rows, count(*) FILTER (sales > 0) AS n_sold,
        round(avg(CASE WHEN sales = 0 THEN 1.0 ELSE 0.0 END), 6) + 0.0 AS zero_rate
        FROM panel JOIN cal USING (date) WHERE event_name_1 IS NOT NULL GROUP BY event_name_1"""
    ),
)
def p13_event_and_zero_filters(spark, sf_dir):
    df = R.dated_panel(spark, sf_dir).filter(F.col("event_name_1").isNotNull())
    return df.groupBy("event_name_1").agg(
        F.count("*").alias("n_rows"),
        F.count_if(F.col("sales") > 0).alias("n_sold"),
        R.r6(F.avg(F.when(F.col("sales") == 0, 1.0).otherwise(0.0))).alias("zero_rate"),
    )


@query(
    "p14_min_history",
    R.with_panel(
        """SELECT id, count(*) AS n_days, sum(sales) AS sales FROM sparse JOIN series USING (item_id, store_id)
        GROUP BY id HAVING count(DISTINCT date) >= 60"""
    ),
)
def p14_min_history(spark, sf_dir):
    kept = P.with_min_history(R.daily_sales(spark, sf_dir), "id", 60)
    return kept.groupBy("id").agg(F.count("*").alias("n_days"), F.sum("sales").alias("sales"))


@query(
    "s3_last_entry_wins",
    R.with_calendar(
        """SELECT date, arg_max(event_name_1, place) AS event_name_1, arg_max(event_type_1, place) AS event_type_1 FROM (
          SELECT 0 AS place, date, event_name_1, event_type_1 FROM events_found
          UNION ALL SELECT 1, date, 'Payday', 'Local' FROM days WHERE day(date) IN (14, 25)) GROUP BY date"""
    ),
)
def s3_last_entry_wins(spark, sf_dir):
    """A list with two entries on some days: the later one replaces the earlier."""
    listed = R.events(spark, sf_dir).select(F.lit(0).alias("place"), F.col("event_name_1").alias("name"), F.col("event_type_1").alias("type"), "date")
    days = C.days_between(R.bounds(spark, sf_dir)).filter(F.dayofmonth("date").isin(14, 25))
    paid = days.select(F.lit(1).alias("place"), F.lit("Payday").alias("name"), F.lit("Local").alias("type"), "date")
    return C.one_event_per_day(listed.unionByName(paid), "place")
