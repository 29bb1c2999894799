"""Daily bars, percent changes and next-session targets.

Windows here run over ``(symbol, date)`` frames with one row a day, so a symbol's
group is bounded by the calendar (about 250 rows a year) however many ticks or
articles lie behind it. ``daily_bars`` brings other frames to that grain.
"""

from pyspark.sql import DataFrame, Window, functions as F

from tickermood.functions.columns import change, fill_target
from tickermood.schemas import TARGET


def daily_bars(ticks: DataFrame, price: str, ts: str, tie: str, by="symbol") -> DataFrame:
    """Last price and number of ticks of each day, summed up map-side first."""
    last = F.max_by(price, F.struct(ts, tie))
    return ticks.groupBy(by, F.col(ts).cast("date").alias("date")).agg(
        last.alias("adjclose"), F.count(F.lit(1)).alias("volume")
    )


def _sessions(by, order):
    return Window.partitionBy(by).orderBy(order)


def once_a_day(df: DataFrame, by="symbol", order="date") -> DataFrame:
    """``df``, failing where a symbol has two rows of one day.

    Ticks would bring a whole symbol into one task and make "the previous row" a matter
    of chance. The check shares the window of the changes and costs no shuffle.
    """
    twice = F.lag(order, 1).over(_sessions(by, order)) == F.col(order)
    message = F.concat(F.lit("more than one row of a day for "), F.col(by).cast("string"), F.lit(": use daily_bars"))
    day = F.when(F.coalesce(twice, F.lit(False)), F.raise_error(message).cast(df.schema[order].dataType)).otherwise(F.col(order))
    return df.withColumn(order, day)


def pct_change(df: DataFrame, col: str, scale=100.0, by="symbol", order="date", out=None) -> DataFrame:
    """Change against the previous session; ``scale=1`` for a fraction."""
    previous = F.lag(col, 1).over(_sessions(by, order))
    return df.withColumn(out or f"{col}_change", change(F.col(col), previous, scale))


def next_day_target(df: DataFrame, col="price_percent_change", by="symbol", order="date", out=TARGET) -> DataFrame:
    return df.withColumn(out, F.lead(col, 1).over(_sessions(by, order)))


def price_features(bars: DataFrame, inference=False) -> DataFrame:
    """(symbol, date, price and volume change, next session's price change).

    ``bars`` has one row per symbol and day, else the job fails. All windows share one shuffle and one sort. ``inference`` sets the
    unknown target of the last session to 0.
    """
    changed = pct_change(bars, "adjclose", out="price_percent_change")
    changed = pct_change(changed, "volume", out="volume_percent_change")
    rows = once_a_day(next_day_target(changed)).select(
        "symbol", "date", "price_percent_change", "volume_percent_change", TARGET
    )
    return fill_target(rows, TARGET) if inference else rows


def score_span(scores: DataFrame, by="symbol", order="date") -> DataFrame:
    return scores.groupBy(by).agg(F.min(order).alias("first_day"), F.max(order).alias("last_day"))


def within_span(df: DataFrame, scores: DataFrame, by="symbol", order="date") -> DataFrame:
    """Rows between a symbol's first and last scored day.

    Only the days of ``scores`` are read here: Spark prunes the score columns and
    with them the text they come from.
    """
    inside = df.join(score_span(scores, by, order), by)
    return inside.filter(F.col(order).between(F.col("first_day"), F.col("last_day"))).select(*df.columns)


def span_bounds(scores: DataFrame, order="date"):
    """First and last scored day of all symbols together, None without any. A job over the days alone."""
    found = scores.agg(F.min(order).alias("first_day"), F.max(order).alias("last_day")).first()
    return (found["first_day"], found["last_day"]) if found["first_day"] is not None else None


def neighbour_bounds(bars: DataFrame, first_day, last_day, by="symbol", order="date"):
    """The bounds, moved out so far that every symbol keeps the session before and the one after its rows within.

    Reads symbols and days only.
    """
    days = bars.select(by, order)
    before = days.filter(F.col(order) < F.lit(first_day)).groupBy(by).agg(F.max(order).alias("day"))
    after = days.filter(F.col(order) > F.lit(last_day)).groupBy(by).agg(F.min(order).alias("day"))
    low, high = before.agg(F.min("day")).first()[0], after.agg(F.max("day")).first()[0]
    return low or first_day, high or last_day


def restrict_to_span(bars: DataFrame, scores: DataFrame, cut="after", inference=False) -> DataFrame:
    """Price features of the scored span.

    ``cut="after"`` derives the changes first, so the first session in the span
    keeps its change. ``cut="before"`` drops earlier bars first and loses it.

    The scored days are looked up first and bound the scan of ``bars`` as constants, so that
    files and row groups of other days are not read; each symbol's own span is cut after that.
    """
    if cut not in ("after", "before"):
        raise ValueError(f"unknown cut {cut!r}: use 'after' or 'before'")
    bounds = span_bounds(scores)
    if bounds is None:
        bars = bars.limit(0)
    else:
        if cut == "after":
            bounds = neighbour_bounds(bars, *bounds)
        bars = bars.filter(F.col("date").between(*map(F.lit, bounds)))
    if cut == "after":
        return within_span(price_features(bars, inference), scores)
    return price_features(within_span(bars, scores), inference)
