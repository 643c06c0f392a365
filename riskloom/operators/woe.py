"""Weight of Evidence, Information Value, and their use as encodings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from riskloom import fixed_values as V
from riskloom.functions.numeric import dround
from riskloom.sources.layers import filter_split
from riskloom.sources.storage import fits_broadcast, materialize

BINS_PER_MAP = 8   # a map is searched entry by entry


def union_feature_bins(df: DataFrame, features: list[str]) -> DataFrame:
    """Counts per (feature, bin), all features in one scan and one shuffle.

    The unpivoted rows never leave the map side: partial counts do, one per
    bin and task, so a bin with most of the rows costs no more than others.
    """
    long = df.select("is_bad", *features).unpivot("is_bad", features, "feature", "bin")
    return long.groupBy("feature", "bin").agg(
        F.count("*").alias("total"),
        F.sum("is_bad").alias("events"),
        F.sum(1 - F.col("is_bad")).alias("non_events"),
    )


def woe_table(df: DataFrame, features: list[str] = V.BINNED_FEATURES,
              split: str | None = "train") -> DataFrame:
    """WoE and IV part of every bin; NULL is a bin; positive WoE is riskier.

    Bins without events or without non-events get WoE 0.  Every feature's bins
    hold all rows, so totals are sums over the counts of one feature.
    """
    source = df if split is None else filter_split(df, split)
    counts = union_feature_bins(source, features)
    whole = W.partitionBy("feature")
    share_bad = F.try_divide(F.col("events"), F.sum("events").over(whole))
    share_good = F.try_divide(F.col("non_events"), F.sum("non_events").over(whole))
    weight = F.when((F.col("events") == 0) | (F.col("non_events") == 0), 0.0).otherwise(
        dround(F.log(F.col("dist_events") / F.col("dist_non_events")), 4))
    part = dround((F.col("dist_events") - F.col("dist_non_events")) * F.col("woe"), 6)
    return (counts
            .withColumns({"bad_rate_pct": dround(F.col("events") * 100.0 / F.col("total"), 2),
                          "dist_events": share_bad, "dist_non_events": share_good})
            .withColumn("woe", weight)
            .withColumn("iv_component", part)
            .select("feature", "bin", "total", "events", "non_events", "bad_rate_pct",
                    "dist_events", "dist_non_events", "woe", "iv_component"))


def fit_woe(df: DataFrame, features: list[str] = V.BINNED_FEATURES,
            split: str | None = "train") -> DataFrame:
    """The WoE table computed once, to be joined many times."""
    return materialize(woe_table(df, features, split))


def iv_summary(woe: DataFrame) -> DataFrame:
    """Information value per feature, strongest first."""
    return (woe.groupBy("feature")
            .agg(dround(F.sum("iv_component"), 4).alias("iv"))
            .orderBy(F.desc_nulls_last("iv"), "feature"))


def _one_row_per_bin(woe: DataFrame) -> int:
    """The number of bins of the feature with most; a bin that is there twice raises."""
    counts = woe.groupBy("feature", "bin").count()
    repeated = counts.where("count > 1").select("feature", "bin").orderBy("feature", "bin").limit(5).collect()
    if repeated:
        raise ValueError(f"bins with several WoE values: {[tuple(r) for r in repeated]}")
    return counts.groupBy("feature").count().agg(F.max("count")).first()[0] or 1


def _bucket(value: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(value), F.lit(buckets)).cast("int")


def _woe_maps(woe: DataFrame, features: list[str], buckets: int) -> Column:
    """One struct value: for each feature an array of buckets, each a map from bin to WoE."""
    known = woe.where(F.col("bin").isNotNull() & F.col("feature").isin(*features))
    filled = (known.withColumn("bucket", _bucket(F.col("bin"), buckets)).groupBy("feature", "bucket")
              .agg(F.collect_list(F.struct("bin", "woe")).alias("bins")))
    every = F.explode(F.sequence(F.lit(0), F.lit(buckets - 1))).alias("bucket")
    frame = filled.select("feature").distinct().select("feature", every)
    listed = frame.join(filled, ["feature", "bucket"], "left").groupBy("feature").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("bucket", "bins"))), lambda b: F.map_from_entries(b["bins"])).alias("buckets"))
    return listed.agg(*[F.first(F.when(F.col("feature") == feature, F.col("buckets")), ignorenulls=True).alias(feature)
                        for feature in features]).select(F.struct(*features)).scalar()


def apply_woe(df: DataFrame, woe: DataFrame,
              features: list[str] = V.BINNED_FEATURES) -> DataFrame:
    """``df`` with one ``<feature>_woe`` per feature; unknown and NULL bins give NULL.

    A (feature, bin) that ``woe`` holds twice raises a ValueError, so rows never
    multiply.  A table that is small enough to broadcast becomes one value, in
    which a bin is found by its hash, and encoding is a projection; one that is
    not is joined feature by feature, with a shuffle and the same result.
    """
    most = _one_row_per_bin(woe)
    if not fits_broadcast(woe):
        return join_woe(df, woe, features)
    buckets = -(-most // BINS_PER_MAP)
    found = F.col("_woe")
    return df.withColumn("_woe", _woe_maps(woe, features, buckets)).select(
        *df.columns, *[F.try_element_at(F.get(found[name], _bucket(F.col(name), buckets)), F.col(name)).alias(f"{name}_woe")
                       for name in features])


def join_woe(df: DataFrame, woe: DataFrame,
             features: list[str] = V.BINNED_FEATURES) -> DataFrame:
    """``apply_woe`` by one left join per feature, for tables of any size."""
    _one_row_per_bin(woe)
    encoded = df
    for feature in features:
        side = (woe.where(F.col("feature") == feature)
                .select(F.col("bin").alias(feature), F.col("woe").alias(f"{feature}_woe")))
        encoded = encoded.join(side, feature, "left")
    return encoded.select(*df.columns, *[f"{feature}_woe" for feature in features])


def lookup_woe(apps: DataFrame, woe: DataFrame, default: float = 0.0,
               features: list[str] = V.BINNED_FEATURES) -> DataFrame:
    """``apply_woe`` at scoring time: unknown bins get ``default``."""
    return apply_woe(apps, woe, features).fillna(
        default, subset=[f"{feature}_woe" for feature in features])


def model_input(features: DataFrame, woe: DataFrame) -> DataFrame:
    """The model-ready table: keys, raw features and WoE features."""
    return apply_woe(features, woe).select(
        "id", "is_bad", "split", "vintage_year", "vintage",
        *V.RAW_FEATURES, *V.WOE_FEATURES)


def woe_extremes(woe: DataFrame) -> DataFrame:
    """Lowest and highest WoE per feature and the bin of the highest."""
    return woe.groupBy("feature").agg(
        F.min("woe").alias("min_woe"), F.max("woe").alias("max_woe"),
        F.max_by("bin", F.struct("woe", "bin")).alias("max_bin"))
