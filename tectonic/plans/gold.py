"""Gold: the summary tables over the event fact.

Shares of the total are computed from the group counts themselves (every row falls in one
group), via a scalar subquery over the small aggregated result — no second scan of the fact
and no cross join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.bins import (DEPTH_BINS, MAGNITUDE_BINS, bin_label, percent_exact,
                              percent_of_double)

OFFSHORE = "Offshore"
# The years pivoted into columns.
PIVOT_YEARS = tuple(range(2000, 2020))


def _count() -> F.Column:
    return F.count(F.lit(1))


def quakes_by_year(fact: DataFrame) -> DataFrame:
    return (fact.groupBy(F.year("event_time").alias("event_year"))
            .agg(_count().alias("total_quakes"))
            .orderBy(F.asc_nulls_last("event_year")))


def quakes_by_month(fact: DataFrame) -> DataFrame:
    monthly = fact.groupBy(F.month("event_time").alias("event_month")) \
        .agg(_count().alias("earthquake_count"))
    total = monthly.select(F.sum("earthquake_count")).scalar()
    return (monthly.select("event_month", "earthquake_count",
                           percent_exact("earthquake_count", total).alias("percentage"))
            .orderBy(F.asc_nulls_last("event_month")))


def share_by_label(fact: DataFrame, label: F.Column, label_name: str, count_name: str,
                   pct_name: str) -> DataFrame:
    """Count per label as double plus ``ROUND((count/total*100)::numeric, 2)``."""
    counts = fact.groupBy(label.alias(label_name)).agg(_count().cast("double").alias(count_name))
    total = counts.select(F.sum(count_name)).scalar()
    return (counts.select(label_name, count_name,
                          percent_of_double(count_name, total).alias(pct_name))
            .orderBy(F.asc_nulls_last(label_name)))


def depth_distribution(fact: DataFrame) -> DataFrame:
    return share_by_label(fact, bin_label("depth_km", DEPTH_BINS), "depth_range",
                          "depth_count", "percentage")


def magnitude_distribution(fact: DataFrame) -> DataFrame:
    return share_by_label(fact, bin_label("magnitude_1", MAGNITUDE_BINS), "magnitude_range",
                          "mag_count", "percentage")


def shindo_proportion(fact: DataFrame) -> DataFrame:
    return share_by_label(fact, F.col("shindo_value"), "shindo_value", "shindo_count",
                          "shindo_percentage")


def _named_counts(fact: DataFrame, dim: DataFrame, *extra: F.Column) -> DataFrame:
    """Aggregate by province id first (a handful of rows), then attach names."""
    by_id = fact.groupBy("province_id", *extra).agg(_count().alias("n"))
    names = dim.select("province_id", "province_name")
    return (by_id.join(names, "province_id", "left")
            .withColumn("province_name", F.coalesce("province_name", F.lit(OFFSHORE))))


def quakes_by_province(fact: DataFrame, dim: DataFrame) -> DataFrame:
    """Counts by province *name* (equal names merge; no province -> 'Offshore')."""
    return (_named_counts(fact, dim).groupBy("province_name")
            .agg(F.sum("n").alias("earthquake_count"))
            .orderBy(F.desc("earthquake_count"), F.asc("province_name")))


# The aggregates a pivot may take.
PIVOT_AGGREGATES = {"sum": F.sum, "max": F.max, "min": F.min, "avg": F.avg, "count": F.count}


def pivot(df: DataFrame, key: str, column: str, values, agg: str = "sum", then_value: F.Column | str | int = 1,
          else_value: int | None = 0) -> DataFrame:
    """One row per ``key``, one column per listed value of ``column``: the aggregate, over all rows
    of the key, of ``then_value`` where the row has that value and of ``else_value`` where it has
    another (None: such rows don't count). One pass of conditional aggregates, combined map-side."""
    function = PIVOT_AGGREGATES[agg]
    then = F.expr(then_value) if isinstance(then_value, str) else F.lit(then_value)
    return df.groupBy(key).agg(*[
        function(F.when(F.col(column) == F.lit(v), then).otherwise(F.lit(else_value))).alias(str(v)) for v in values])


def pivot_counts(df: DataFrame, key: str, column: str, values, count_col: str = "n"
                 ) -> DataFrame:
    """One row per ``key``, one bigint column per listed value (missing -> 0), of rows that carry
    counts."""
    return pivot(df, key, column, values, "sum", F.col(count_col))


def province_year_pivot(fact: DataFrame, dim: DataFrame) -> DataFrame:
    named = _named_counts(fact, dim, F.year("event_time").alias("event_year"))
    return pivot_counts(named, "province_name", "event_year", PIVOT_YEARS) \
        .orderBy(F.asc_nulls_last("province_name"))


# The order of each model's rows (ascending with nulls last; counts descending).
MODEL_ORDER = {
    "gold_total_quakes_by_year": [F.asc_nulls_last, "event_year"],
    "gold_earthquake_by_month": [F.asc_nulls_last, "event_month"],
    "gold_earthquake_depth_distribution": [F.asc_nulls_last, "depth_range"],
    "gold_earthquake_magnitude_distribution": [F.asc_nulls_last, "magnitude_range"],
    "gold_quake_shindo_proportion": [F.asc_nulls_last, "shindo_value"],
    "gold_earthquake_by_province": [F.desc, "earthquake_count", F.asc, "province_name"],
    "gold_earthquake_by_province_year": [F.asc_nulls_last, "province_name"],
}


def model_order(table: str) -> list[F.Column]:
    """Sort columns of a model (made on demand: columns need a session)."""
    spec = MODEL_ORDER[table]
    return [direction(column) for direction, column in zip(spec[::2], spec[1::2])]


# --- all models from one pass over the fact ---------------------------------------------

def summary_counts(fact: DataFrame) -> DataFrame:
    """Event counts per (year, month, province id, depth class, magnitude class, intensity
    class). Every gold model is a count, so each one is a roll-up of this table; its size is
    bounded by the product of those small domains, not by the number of events, and it is
    computed with one scan of the fact (partial aggregation before the shuffle)."""
    return fact.groupBy(
        F.year("event_time").alias("event_year"), F.month("event_time").alias("event_month"),
        "province_id", bin_label("depth_km", DEPTH_BINS).alias("depth_range"),
        bin_label("magnitude_1", MAGNITUDE_BINS).alias("magnitude_range"), "shindo_value",
    ).agg(_count().alias("n"))


def _share_from_counts(counts: DataFrame, label: str, count_name: str, pct_name: str
                       ) -> DataFrame:
    per = counts.groupBy(label).agg(F.sum("n").cast("double").alias(count_name))
    total = per.select(F.sum(count_name)).scalar()
    return (per.select(label, count_name, percent_of_double(count_name, total).alias(pct_name))
            .orderBy(F.asc_nulls_last(label)))


def models_from_counts(counts: DataFrame, dim: DataFrame) -> dict[str, DataFrame]:
    """The seven gold models as roll-ups of :func:`summary_counts` (same results as the
    per-model functions above, which aggregate the fact directly)."""
    by_year = (counts.groupBy("event_year").agg(F.sum("n").alias("total_quakes"))
               .orderBy(F.asc_nulls_last("event_year")))
    monthly = counts.groupBy("event_month").agg(F.sum("n").alias("earthquake_count"))
    month_total = monthly.select(F.sum("earthquake_count")).scalar()
    by_month = (monthly.select("event_month", "earthquake_count",
                               percent_exact("earthquake_count", month_total).alias("percentage"))
                .orderBy(F.asc_nulls_last("event_month")))
    names = dim.select("province_id", "province_name")
    named = (counts.groupBy("province_id", "event_year").agg(F.sum("n").alias("n"))
             .join(names, "province_id", "left")
             .withColumn("province_name", F.coalesce("province_name", F.lit(OFFSHORE))))
    by_province = (named.groupBy("province_name").agg(F.sum("n").alias("earthquake_count"))
                   .orderBy(F.desc("earthquake_count"), F.asc("province_name")))
    pivot = pivot_counts(named, "province_name", "event_year", PIVOT_YEARS) \
        .orderBy(F.asc_nulls_last("province_name"))
    return {
        "gold_total_quakes_by_year": by_year,
        "gold_earthquake_by_month": by_month,
        "gold_earthquake_depth_distribution":
            _share_from_counts(counts, "depth_range", "depth_count", "percentage"),
        "gold_earthquake_magnitude_distribution":
            _share_from_counts(counts, "magnitude_range", "mag_count", "percentage"),
        "gold_quake_shindo_proportion":
            _share_from_counts(counts, "shindo_value", "shindo_count", "shindo_percentage"),
        "gold_earthquake_by_province": by_province,
        "gold_earthquake_by_province_year": pivot,
    }
