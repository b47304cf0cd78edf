"""Features of the impression log.

Definitions under "ours" are our reading of a feature name whose formula is not
published; the others follow the published text.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import business_trip, flag, graded_target, row_min, safe_div
from ..functions.numeric import log_shifted, transform_columns
from ..functions.timeparts import time_columns
from ..operators import encode, holidays, pricing, ranking, stats
from ..operators.ordering import HOT_ROWS, attach, beside
from ..session import discard, written
from ..sources.schema import COMPETITORS
from .catalogue import COMPOSITES, Composite, composite_columns, composite_stats

AFAR = 3000.0  # ours: distance from which a trip counts as crossing an ocean
TRIP_PARTS = ("week", "month", "season", "year", "edges")


def _log10_or_null(value: Column) -> Column:
    return F.when(value > 0, log_shifted(value, 10))


def competitor_columns() -> dict[str, Column]:
    """Ours: how many competitors are dearer, cheaper or equal, and by how much."""
    rates = [F.col(f"comp{i}_rate") for i in COMPETITORS]

    def count(condition: Column) -> Column:
        return F.coalesce(condition, F.lit(False)).cast("int")

    def total(parts: list[Column]) -> Column:
        out = parts[0]
        for p in parts[1:]:
            out = out + p
        return out

    higher, lower = total([count(r == 1) for r in rates]), total([count(r == -1) for r in rates])
    same, known = total([count(r == 0) for r in rates]), total([r.isNotNull().cast("int") for r in rates])
    out = {
        "higher_price_count": higher,
        "lower_price_count": lower,
        "same_price_count": same,
        "comp_num_avail": known,
        "ratio_of_comp_with_higher_price": safe_div(higher.cast("double"), known),
        "ratio_of_comp_with_lower_price": safe_div(lower.cast("double"), known),
        # 1: no competitor is cheaper or equal; 0: one is equal; -1: one is cheaper.
        "own_price_is_lowest": row_min([f"comp{i}_rate" for i in COMPETITORS]),
    }
    for i in COMPETITORS:
        gap = f"comp{i}_rate_percent_diff"
        out[f"{gap}_signed"] = F.col(f"comp{i}_rate") * F.col(gap)
        out[f"{gap}_log_2"] = log_shifted(F.col(gap), 2)
        out[f"{gap}_log_10"] = log_shifted(F.col(gap), 10)
    return out


def location_columns() -> dict[str, Column]:
    """Ours: both location scores combined."""
    a, b = F.col("prop_location_score1"), F.col("prop_location_score2")
    base = {"diff": a - b, "sum": a + b, "mul": a * b}
    out = {f"prop_location_score_{n}": v for n, v in base.items()}
    out.update({f"prop_location_score_{n}_log": _log10_or_null(v) for n, v in base.items()})
    out["prop_location_score2_round"] = F.round(b, 2)
    return out


def price_columns() -> dict[str, Column]:
    """Ours: the price against the visitor's and the item's history."""
    usual, past = F.col("visitor_hist_adr_usd"), F.exp(F.col("prop_log_historical_price"))
    out = {
        "prop_historical_price": past,
        "was_sold_in_that_period": F.col("prop_log_historical_price") > 0,
        "place_hist_price_diff_usr_hist": past - usual,
        "usr_extra_pay": F.col("gross_bookings_usd") - F.col("price_usd"),
        "srch_query_affinity_score_prob": F.exp(F.col("srch_query_affinity_score")),
    }
    for prefix, price in (("price", "price_usd"), ("price_per_day", "price_per_day"), ("price_per_trip", "price_per_trip")):
        out[f"{prefix}_diff_to_usr_hist"] = F.col(price) - usual
        out[f"{prefix}_ratio_to_usr_hist"] = safe_div(F.col(price), usual)
        out[f"{prefix}_diff_to_place_hist_price"] = F.col(price) - past
    for value in ("price_usd", "visitor_hist_adr_usd", "prop_log_historical_price", "price_per_trip", "price_per_day"):
        out.update(transform_columns(value, (0.33, 0.5, 2), (2, 10, math.e), True, False))
    return out


def star_columns(booked_stars: Column | None = None) -> dict[str, Column]:
    """Ours: stars, reviews and the price per star."""
    stars, review = F.col("prop_starrating"), F.col("prop_review_score")
    usual = safe_div("visitor_hist_adr_usd", "visitor_hist_starrating")
    per_star, per_review = safe_div("price_usd", stars), safe_div("price_usd", review)
    out = {
        "prop_star_usr_hist_diff": stars - F.col("visitor_hist_starrating"),
        "prop_review_usr_hist_diff": review - F.col("visitor_hist_starrating"),
        "prop_starrating_bonus_chain": stars + F.col("prop_brand_bool"),
        "prop_star_review_sum": stars + review,
        "prop_star_review_diff": stars - review,
        "prop_star_review_min": F.least(stars, review),
        "prop_star_review_max": F.greatest(stars, review),
        "prop_star_review_mean": (stars + review) / 2,
        "price_per_star": per_star,
        "price_per_review_score": per_review,
        "usr_price_per_star": usual,
        "price_per_star_diff_with_usr": per_star - usual,
        "price_per_review_diff_with_usr": per_review - usual,
        "price_per_star_log_10": log_shifted(per_star, 10),
        "price_per_review_score_log_10": log_shifted(per_review, 10),
        "usr_price_per_star_log_10": log_shifted(usual, 10),
    }
    if booked_stars is not None:
        out["prop_starrating_monotonic"] = F.abs(stars - booked_stars)
    return out


def trip_columns() -> dict[str, Column]:
    """Ours but for the business flag: who travels, how long and how far ahead."""
    window, stay = F.col("srch_booking_window"), F.col("srch_length_of_stay")
    adults, children, rooms = F.col("srch_adults_count"), F.col("srch_children_count"), F.col("srch_room_count")
    return {
        "travel_inside": F.col("visitor_location_country_id") == F.col("prop_country_id"),
        "trans_ocean": flag(F.col("orig_destination_distance") > AFAR),
        "booking_weeks_ahead": window / 7,
        "booking_months_ahead": window / 30,
        "len_of_stay_to_booking_ahead_ratio": stay / (window + F.lit(1e-2)),
        "len_of_stay_to_booking_ahead_diff": stay - window,
        "srch_length_of_stay_in_weeks": stay / 7,
        "children_per_adult": safe_div(children, adults),
        "total_people": adults + children,
        "people_per_room": safe_div(adults + children, rooms),
        "separate_children_room": (rooms > 1) & (children > 0),
        "business_trip": business_trip(
            "srch_children_count", "srch_adults_count", "srch_saturday_night_bool", "srch_length_of_stay"
        ),
    }


def row_features(log: DataFrame) -> DataFrame:
    """Everything that needs one row only; wants ``price_per_day`` and ``price_per_trip``."""
    return log.withColumns(
        {
            "target": graded_target("click_bool", "booking_bool"),
            **competitor_columns(),
            **location_columns(),
            **price_columns(),
            **trip_columns(),
            **star_columns(),
        }
    )


def date_features(log: DataFrame, source: DataFrame | None = None) -> DataFrame:
    """Trip dates, calendar parts of booking, start and end, and holidays."""
    trips = holidays.trip_interval(log, "date_time", "srch_booking_window", "srch_length_of_stay")
    parts = {
        **time_columns("date_time", "booking_time_"),
        **time_columns("trip_start_date", "trip_start_date_", TRIP_PARTS),
        **time_columns("trip_end_date", "trip_end_date_", TRIP_PARTS),
    }
    dated = trips.withColumns(parts)
    spans = holidays.trip_interval(log if source is None else source, "date_time", "srch_booking_window", "srch_length_of_stay")
    return holidays.trip_holidays(dated, holidays.holidays_of(spans, "date", "trip_end_date"))


def item_affinity(df: DataFrame, source: DataFrame | None = None, sizes: DataFrame | None = None) -> DataFrame:
    """Ours: mean query affinity per item, of the rows of ``source`` if that is given."""
    if source is None:
        return beside(df, ["prop_id"], {"mean_srch_query_affinity_score": F.avg("srch_query_affinity_score")}, sizes=sizes)
    table = source.groupBy("prop_id").agg(F.avg("srch_query_affinity_score").alias("mean_srch_query_affinity_score"))
    return attach(df, table, ["prop_id"], source=source)


def priced_features(log: DataFrame, tiebreak: Sequence[str] = (), hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Price order and price basis, which move the rows."""
    df = log
    for key in ("srch_id", "srch_destination_id", "prop_id"):
        df = ranking.index_in_group(df, key, "price_usd", ["srch_id", "prop_id", *tiebreak], hot_rows=hot_rows)
    shares = pricing.daily_items(log, "prop_id", "price_usd", "gross_bookings_usd", "srch_length_of_stay")
    return pricing.price_columns(df, shares, "prop_id", "price_usd", "srch_length_of_stay", log, hot_rows)


def base_features(log: DataFrame, tiebreak: Sequence[str] = (), hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Price order, price basis and everything that needs one row only.

    The order comes first, while rows are narrow, since it moves them.
    """
    return date_features(row_features(priced_features(log, tiebreak, hot_rows)), log)


ROW = "_row"
# What the group-relative features read.
RELATIVE_INPUTS = (
    "date_time", "price_usd", "prop_starrating", "click_bool", "booking_bool", "position", "random_bool",
    "srch_query_affinity_score",
)


def build_features(
    log: DataFrame,
    split: str = "split",
    composites: Sequence[Composite] = COMPOSITES,
    tiebreak: Sequence[str] = (),
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """All features of the registry, for a log with a split column.

    The log is written once, with a row number. Price order, price basis and the
    group-relative features are built on the few columns they need, so that the
    shuffles of some forty statistics move narrow rows. Each group of them is written, so that its shuffles
    go before the next one's come, and put into one table of new columns. This meets the columns of the log
    once; what needs one row only is computed after that and moves in no shuffle.
    """
    base = written(log.withColumn(ROW, F.monotonically_increasing_id()), "zstd")
    priced = priced_features(base, tiebreak, hot_rows)
    made = [c for c in priced.columns if c not in base.columns]
    used = dict.fromkeys(
        [ROW, split, "srch_id", "prop_id", *RELATIVE_INPUTS, *[c for e in composites for c in (*e.keys, e.value)], *made]
    )
    narrow = written(date_features(row_features(priced), base).select(*used), "zstd")
    df = narrow
    for key in ("prop_id", "srch_id"):
        df = stats.normalize_by(df, key, "price_usd", log10=True, source=narrow)
    df = stats.normalize_by(df, "srch_id", "prop_starrating", source=narrow)
    df = encode.dense_ordinal(df, "date_time", hot_rows=hot_rows, source=narrow)
    df = encode.train_stats(df, "prop_id", "click_bool", "booking_bool", "position", "random_bool", split, narrow)
    df = item_affinity(df, narrow)
    others = [c for c in narrow.columns if c != ROW]
    relative = written(df.drop(*others), "zstd")
    grouped = written(composite_stats(narrow, composites, split, hot_rows).drop(*others), "zstd")
    # Statistics that only differences read.
    features = composite_columns(composites)
    helpers = [c for c in grouped.columns if c not in (ROW, *features)]
    new = written(narrow.select(ROW, *made).join(relative, [ROW]).join(grouped, [ROW]), "zstd")
    for done in (relative, grouped, narrow):
        discard(done)
    joined = base.join(new, [ROW])
    return date_features(row_features(joined), base).withColumns(features).drop(ROW, *helpers)


ENCODED_KEYS = ("prop_country_id", "site_id", "visitor_location_country_id", "prop_id", "srch_destination_id")
QUALITY = {
    "click_bool": "mean_click_bool_per_prop_id",
    "booking_bool": "mean_booking_bool_per_prop_id",
    "price_index_per_srch_id": "mean_position_per_prop_id",
}
# The columns and keys of the mean/min/max block.
BLOCK_COLUMNS = (
    "visitor_hist_starrating", "visitor_hist_adr_usd", "prop_starrating", "prop_review_score", "prop_brand_bool",
    "prop_location_score1", "prop_location_score2", "prop_log_historical_price", "price_usd", "promotion_flag",
    "srch_length_of_stay", "srch_booking_window", "srch_adults_count", "srch_children_count", "srch_room_count",
    "srch_query_affinity_score", "orig_destination_distance",
)
BLOCK_KEYS = ("srch_id", "visitor_location_country_id", "prop_id", "prop_starrating", "srch_destination_id")


def encode_keys(df: DataFrame, hot_rows: int | None = HOT_ROWS) -> DataFrame:
    """Ordinals of the five key columns by mean daily price."""
    return encode.ordinal_by_mean(df, ENCODED_KEYS, "price_per_day", hot_rows)


def item_quality(df: DataFrame, min_n: int = 10) -> DataFrame:
    """Click, booking and price place per item, from rows in ranked order."""
    return encode.support_encode(df, "prop_id", QUALITY, F.col("random_bool") == 0, min_n)


def block_features(df: DataFrame, keys: Sequence[str] = BLOCK_KEYS, columns: Sequence[str] = BLOCK_COLUMNS) -> DataFrame:
    """Mean, minimum and maximum per key, and each value relative to them."""
    return stats.block_rel_diff(df, list(keys), list(columns))
