"""Calendar features, trip dates and holidays."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.timeparts import PERIODS, cyclic_features, seconds_between, time_columns, time_features
from ..operators import holidays
from ..sources.readers import read_table
from .registry import events, lineitem, query

_B = "CAST({} AS BIGINT)"


def _ints(**columns: str) -> str:
    return ", ".join(f"CAST({v} AS BIGINT) AS {k}" for k, v in columns.items())


@query(
    "time_parts",
    "SELECT event_id, "
    + _ints(
        ts_minute="minute(ts)", ts_hour="hour(ts)", ts_day="day(ts)", ts_dow="isodow(ts)",
        ts_is_weekend="CASE WHEN isodow(ts) >= 6 THEN 1 ELSE 0 END", ts_doy="dayofyear(ts)",
        ts_is_month_start="CASE WHEN day(ts) = 1 THEN 1 ELSE 0 END",
        ts_is_month_end="CASE WHEN CAST(ts AS DATE) = last_day(ts) THEN 1 ELSE 0 END",
    )
    + ", hour(ts) BETWEEN 7 AND 11 AS ts_morning, hour(ts) BETWEEN 12 AND 17 AS ts_afternoon,"
    " hour(ts) BETWEEN 18 AND 22 AS ts_evening, hour(ts) IN (23, 0, 1) AS ts_late_evening,"
    " hour(ts) BETWEEN 2 AND 6 AS ts_night, hour(ts) BETWEEN 8 AND 17 AS ts_work_hour,"
    " hour(ts) BETWEEN 11 AND 13 AS ts_lunch FROM events",
)
def _time_parts(spark, folder):
    rows = events(spark, folder).select("event_id", "ts")
    return time_features(rows, "ts", parts=("within_hour", "hour", "day")).drop("ts")


DAY_KEY = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]


@query(
    "week_features",
    """WITH t AS (SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_shipdate s, weekofyear(l_shipdate) w,
         month(l_shipdate) m, year(l_shipdate) y FROM lineitem)
       SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, """
    + _ints(
        ship_week="w", ship_month="m", ship_year="y", ship_quarter="quarter(s)", ship_days_in_month="day(last_day(s))",
        ship_week_mid_summer_index="CASE WHEN w BETWEEN 3 AND 28 THEN w - 3 WHEN w >= 29 THEN 54 - w ELSE 0 END",
        ship_season_num="(m // 3) % 4 + 1",
        ship_week_id="isoyear(s) * 100 + w",
    )
    + " FROM t",
)
def _week_features(spark, folder):
    rows = lineitem(spark, folder, *DAY_KEY, "l_shipdate")
    return time_features(rows, "l_shipdate", "ship_", ("week", "month", "season", "year")).drop("l_shipdate")


@query(
    "period_edges",
    """SELECT o_orderkey, CAST(o_orderdate AS DATE) = CAST(date_trunc('quarter', o_orderdate) AS DATE) AS is_quarter_start,
         CAST(o_orderdate AS DATE) = CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS is_quarter_end,
         CAST(o_orderdate AS DATE) = CAST(date_trunc('year', o_orderdate) AS DATE) AS is_year_start,
         month(o_orderdate) = 12 AND day(o_orderdate) = 31 AS is_year_end FROM orders""",
)
def _period_edges(spark, folder):
    rows = read_table(spark, folder, "orders", ["o_orderkey", "o_orderdate"])
    return time_features(rows, "o_orderdate", "", ("edges",)).drop("o_orderdate")


_CYCLIC_SOURCE = {
    "day": "day(ts)", "month": "month(ts)", "quarter": "quarter(ts)", "week": "weekofyear(ts)", "dow": "isodow(ts)",
    "doy": "dayofyear(ts)", "season_num": "((month(ts) // 3) % 4 + 1)",
}


@query(
    "cyclic_time",
    "SELECT event_id, "
    + ", ".join(
        f"round({f}(2 * pi() * {_CYCLIC_SOURCE[n]} / {p}), 6) AS ts_{n}_{s}"
        for n, p in PERIODS.items()
        for f, s in (("sin", "sin"), ("cos", "cos"))
    )
    + " FROM events",
)
def _cyclic_time(spark, folder):
    return cyclic_features(events(spark, folder).select("event_id", "ts"), "ts").drop("ts")


@query(
    "epoch_diff",
    """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
         CAST(epoch(l_shipdate) - epoch(o_orderdate) AS BIGINT) AS seconds FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
)
def _epoch_diff(spark, folder):
    orders = read_table(spark, folder, "orders", ["o_orderkey", "o_orderdate"])
    rows = lineitem(spark, folder, *DAY_KEY, "l_shipdate").join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return rows.select(*DAY_KEY, seconds_between("o_orderdate", "l_shipdate").alias("seconds"))


def _trips(spark, folder):
    orders = read_table(spark, folder, "orders", ["o_orderkey", "o_custkey", "o_orderdate"])
    rows = orders.withColumns({"wait": F.col("o_custkey") % 60, "stay": F.col("o_orderkey") % 14})
    return holidays.trip_interval(rows, "o_orderdate", "wait", "stay").select(
        "o_orderkey", "date", "trip_start_date", "trip_end_date"
    )


_TRIPS_SQL = """trips AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS date,
  CAST(o_orderdate AS DATE) + CAST(o_custkey % 60 AS INTEGER) AS trip_start_date,
  CAST(o_orderdate AS DATE) + CAST(o_custkey % 60 AS INTEGER) + CAST(o_orderkey % 14 AS INTEGER) AS trip_end_date FROM orders)"""

# The federal calendar by rule, as the oracle sees it.
_CALENDAR_SQL = """years AS (SELECT unnest(generate_series(1995, 2003)) AS y),
  fixed AS (SELECT make_date(y, m, d) AS day, name FROM years, (VALUES (1, 1, 'New Year''s Day'), (7, 4, 'Independence Day'),
    (11, 11, 'Veterans Day'), (12, 25, 'Christmas Day')) v(m, d, name)),
  nth AS (SELECT make_date(y, m, 1) + CAST((dow - isodow(make_date(y, m, 1)) + 7) % 7 + 7 * (n - 1) AS INTEGER) AS day, name
    FROM years, (VALUES (1, 1, 3, 'Martin Luther King Jr. Day'), (2, 1, 3, 'Presidents Day'), (9, 1, 1, 'Labor Day'),
    (10, 1, 2, 'Columbus Day'), (11, 4, 4, 'Thanksgiving')) v(m, dow, n, name)),
  memorial AS (SELECT make_date(y, 5, 31) - CAST(isodow(make_date(y, 5, 31)) - 1 AS INTEGER) AS day, 'Memorial Day' AS name FROM years),
  shifted AS (SELECT CASE isodow(day) WHEN 6 THEN day - 1 WHEN 7 THEN day + 1 ELSE day END AS holiday, name FROM fixed
    UNION ALL SELECT * FROM nth UNION ALL SELECT * FROM memorial)"""


@query(
    "trip_interval",
    f"WITH {_TRIPS_SQL} SELECT * FROM trips",
)
def _trip_interval(spark, folder):
    return _trips(spark, folder)


@query(
    "holiday_calendar",
    f"""WITH {_TRIPS_SQL}, {_CALENDAR_SQL},
      span AS (SELECT year(min(trip_start_date)) lo, year(max(trip_end_date)) hi FROM trips)
      SELECT holiday, name, (SELECT count(*) FROM orders WHERE CAST(o_orderdate AS DATE) = holiday) AS orders
      FROM shifted, span WHERE year(holiday) BETWEEN lo AND hi""",
)
def _holiday_calendar(spark, folder):
    """The holidays in the years the trips span, with the orders placed on each."""
    trips = _trips(spark, folder)
    calendar = holidays.holidays_of(trips, "trip_start_date", "trip_end_date")
    placed = trips.groupBy("date").agg(F.count(F.lit(1)).alias("orders"))
    joined = calendar.join(placed, F.col("holiday") == F.col("date"), "left")
    return joined.select("holiday", "name", F.coalesce("orders", F.lit(0)).alias("orders"))


@query(
    "holidays_in_interval",
    f"""WITH {_TRIPS_SQL}, {_CALENDAR_SQL}
      SELECT o_orderkey, (SELECT count(*) FROM shifted WHERE holiday BETWEEN trip_start_date AND trip_end_date) AS holidays_during_trip,
        (SELECT count(*) FROM shifted WHERE holiday BETWEEN trip_start_date AND trip_end_date) > 0 AS holiday_during_trip,
        (SELECT count(*) FROM shifted WHERE holiday = date) > 0 AS holiday_during_booking FROM trips""",
)
def _holidays_in_interval(spark, folder):
    trips = _trips(spark, folder)
    calendar = holidays.holidays_of(trips, "date", "trip_end_date")
    return holidays.trip_holidays(trips, calendar).drop("date", "trip_start_date", "trip_end_date")


@query(
    "interval_count",
    """SELECT l_orderkey, l_partkey, l_suppkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
         (SELECT count(*) FROM orders WHERE o_orderstatus = 'P'
           AND CAST(o_orderdate AS DATE) BETWEEN CAST(l_shipdate AS DATE) AND CAST(l_shipdate AS DATE) + 7) AS pending
         FROM lineitem""",
)
def _interval_count(spark, folder):
    """Any dated table can serve as calendar, several entries a day included."""
    calendar = read_table(spark, folder, "orders", ["o_orderdate", "o_orderstatus"]).filter("o_orderstatus = 'P'")
    rows = lineitem(spark, folder, *DAY_KEY, "l_shipdate").withColumn("until", F.date_add(F.to_date("l_shipdate"), 7))
    counted = holidays.count_in_interval(rows, "l_shipdate", "until", calendar, "pending", "o_orderdate")
    return counted.select(*DAY_KEY, "pending")


@query(
    "booking_part_counts",
    "SELECT " + _ints(dow="isodow(ts)", hour="hour(ts)") + ", count(*) AS n FROM events GROUP BY 1, 2",
)
def _booking_part_counts(spark, folder):
    parts = time_columns("ts", "", ("hour", "day"))
    return events(spark, folder).groupBy(parts["dow"].alias("dow"), parts["hour"].alias("hour")).agg(F.count(F.lit(1)).alias("n"))
