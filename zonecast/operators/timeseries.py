"""Calendar resampling with empty buckets kept, and series pairing."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.functions.time import bucket_label, calendar_labels
from zonecast.operators.partials import mean, totals


def resample_mean(df: DataFrame, date_col: str, value_cols, rule: str,
                  out_col: str | None = None, keep_keys: DataFrame | None = None,
                  key_col: str = "ID_STATION") -> DataFrame:
    """Mean of ``value_cols`` per calendar bucket, one row for every bucket
    between the first and the last observed bucket (empty ones NULL).

    The bucket aggregate is tiny (one row per calendar day at most): each of
    its rows also gives the empty buckets up to the next one, so the calendar
    is filled in one pass over it and the observations are scanned once.

    ``keep_keys`` restricts the rows to those whose ``key_col`` appears in it
    (e.g. stations present in a name dimension). The rows are then summed per
    (key, bucket) first and only those sums meet the key set, so no raw row
    is joined; means are combined as sum of sums over sum of counts.
    """
    out_col = out_col or date_col
    values = [value_cols] if isinstance(value_cols, str) else list(value_cols)
    rows = df.where(F.col(date_col).isNotNull())
    bucket = bucket_label(F.col(date_col), rule).alias(out_col)
    if keep_keys is None:
        per_bucket = rows.groupBy(bucket).agg(*[mean(rows, v).alias(v) for v in values])
    else:
        sums = [agg.alias(f"{c}_{v}") for v in values for c, agg in zip(("_s", "_n"), totals(rows, v), strict=True)]
        per_key = (rows.groupBy(F.col(key_col), bucket).agg(*sums)
                   .join(keep_keys.select(key_col).distinct(), key_col, "left_semi"))
        per_bucket = per_key.groupBy(out_col).agg(*[
            F.when(F.sum(f"_n_{v}") > 0, F.sum(f"_s_{v}") / F.sum(f"_n_{v}")).alias(v) for v in values])
    following = F.lead(out_col).over(Window.orderBy(out_col))         # over calendar buckets, not observations
    filled = per_bucket.withColumn("_next", following)
    labels = calendar_labels(F.col(out_col), F.coalesce("_next", out_col), rule)
    own = F.when(F.col("_next").isNull(), labels).otherwise(F.slice(labels, F.lit(1), F.size(labels) - 1))
    each = filled.select(F.posexplode(own).alias("_i", "_label"), *values)
    return each.select(F.col("_label").alias(out_col), *[F.when(F.col("_i") == 0, F.col(v)).alias(v) for v in values])


def paired_series(air: DataFrame, weather: DataFrame, rule: str,
                  weather_keys: DataFrame | None = None) -> DataFrame:
    """Pollutant and weather series on one time axis (full outer on bucket)."""
    a = resample_mean(air, "DATE_OBSERVATION", "VALEUR", rule, out_col="BUCKET")
    w = resample_mean(weather, "DATE", ("TEMP", "WDSP", "DEWP"), rule, out_col="BUCKET",
                      keep_keys=weather_keys)
    return a.join(w, "BUCKET", "full")
