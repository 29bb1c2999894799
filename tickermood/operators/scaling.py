"""Scalers as aggregates looked up by their rows."""

from pyspark.sql import Column, DataFrame, Window, functions as F


SLOTS = 256


def _by_group(df: DataFrame, stats: dict[str, Column], keys) -> Column:
    """The statistics of a row's group, looked up in a one-row result.

    The groups (symbols) are aggregated to an array of small maps by hash, which a
    scalar subquery hands to every task: the rows themselves are not shuffled, so a
    group of any size is fine. Groups are few by contract; their number is what
    travels.
    """
    key = F.struct(*keys)
    slot = F.pmod(F.hash(*keys), F.lit(SLOTS))
    # A row without a key has no group; map keys may hold nulls inside a struct.
    grouped = df.groupBy(*keys).agg(*[c.alias(n) for n, c in stats.items()])
    maps = grouped.groupBy(slot.alias("slot")).agg(
        F.map_from_entries(F.collect_list(F.struct(key.alias("k"), F.struct(*stats).alias("s")))).alias("m")
    )
    by_slot = maps.agg(F.map_from_entries(F.collect_list(F.struct("slot", "m"))).alias("by_slot"))
    array = F.transform(F.sequence(F.lit(0), F.lit(SLOTS - 1)), lambda s: F.try_element_at("by_slot", s))
    return F.try_element_at(F.get(by_slot.select(array.alias("slots")).scalar(), slot), key)


def _with_stats(df: DataFrame, stats: dict[str, Column], by, per_day: bool) -> DataFrame:
    """Add one statistic per ``by`` group (or of the whole frame) to every row.

    The statistics are a grouped aggregate whose partial sums are made map-side.
    It reads ``df`` twice. ``per_day`` is for frames with one row per symbol and day,
    where a group is bounded by the calendar: a window then does it in one pass.
    """
    if by is None:
        row = df.agg(F.struct(*[c.alias(n) for n, c in stats.items()]).alias("s")).scalar()
        return df.withColumn("_stats", row).withColumns({n: F.col("_stats")[n] for n in stats}).drop("_stats")
    keys = [by] if isinstance(by, str) else list(by)
    if per_day:
        group = Window.partitionBy(*keys)
        return df.withColumns({n: c.over(group) for n, c in stats.items()})
    found = df.withColumn("_stats", _by_group(df, stats, keys))
    return found.withColumns({n: F.col("_stats")[n] for n in stats}).drop("_stats")


def _fitted(col: str, fit_on) -> Column:
    return F.col(col) if fit_on is None else F.when(fit_on, F.col(col))


def scale(
    df: DataFrame, col: str, center: bool, by=None, fit_on=None, out=None, per_day=False, ddof=1
) -> DataFrame:
    """Divide by the standard deviation, after centring if ``center``.

    ``ddof`` is 1 for the deviation of a sample, 0 for that of a population. ``fit_on`` is a condition on the rows to fit on, such as the train split. A
    column without spread becomes 0.
    """
    x = _fitted(col, fit_on)
    stats = {"_std": {0: F.stddev_pop, 1: F.stddev_samp}[ddof](x)}
    if center:
        stats["_mean"] = F.avg(x)
    joined = _with_stats(df, stats, by, per_day)
    base = F.col(col) - F.col("_mean") if center else F.col(col)
    scaled = F.when(F.col(col).isNull(), None).otherwise(F.coalesce(F.try_divide(base, F.col("_std")), F.lit(0.0)))
    return joined.withColumn(out or col, scaled).select(*_columns(df, out or col))


def minmax(df: DataFrame, col: str, lo=-1.0, hi=1.0, by=None, fit_on=None, out=None, per_day=False) -> DataFrame:
    """Map the range of ``col`` to ``lo`` .. ``hi``; a constant goes to the middle."""
    x = _fitted(col, fit_on)
    joined = _with_stats(df, {"_low": F.min(x), "_high": F.max(x)}, by, per_day)
    share = F.coalesce(
        F.try_divide(F.col(col) - F.col("_low"), (F.col("_high") - F.col("_low")).cast("double")), F.lit(0.5)
    )
    scaled = F.when(F.col(col).isNull(), None).otherwise(share * (hi - lo) + lo)
    return joined.withColumn(out or col, scaled).select(*_columns(df, out or col))


def div_to_max(df: DataFrame, col: str, by=None, out=None, per_day=False) -> DataFrame:
    joined = _with_stats(df, {"_high": F.max(col)}, by, per_day)
    scaled = F.try_divide(F.col(col).cast("double"), F.col("_high").cast("double"))
    return joined.withColumn(out or col, scaled).select(*_columns(df, out or col))


def _columns(df: DataFrame, out: str) -> list[str]:
    return df.columns + ([out] if out not in df.columns else [])
