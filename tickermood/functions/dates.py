"""Publication dates, sessions and fetch windows."""

from pyspark.sql import Column, DataFrame, functions as F


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def news_date(published) -> Column:
    """Day of an RFC-1123 publication text; null when it holds none.

    After the weekday and its comma come day, month and year, then a time of day.
    """
    words = F.split(F.trim(F.split_part(_col(published), F.lit(","), F.lit(2))), " +")
    timed = F.contains(F.get(words, F.lit(3)), F.lit(":"))
    return F.when(timed, F.try_to_date(F.array_join(F.slice(words, 1, 3), " "), "d MMM yyyy"))


def month_name(date) -> Column:
    return F.date_format(_col(date), "MMMM")


def next_session_date(date, weekends=False) -> Column:
    """The day a prediction made on ``date`` is for.

    Exchanges rest on Saturday and Sunday; ``weekends=True`` is for assets that
    trade every day.
    """
    day = _col(date)
    if weekends:
        return F.date_add(day, 1)
    # weekday(): Monday is 0, so Friday is 4 and Saturday 5.
    step = F.when(F.weekday(day) == 4, 3).when(F.weekday(day) == 5, 2).otherwise(1)
    return F.date_add(day, step)


def fetch_windows(df: DataFrame, start="start", final="final", day_range=2) -> DataFrame:
    """One row per fetch window ``[window_start, window_start + day_range]``.

    Windows follow each other without overlap, the last one being the last that
    starts no later than ``final``.
    """
    starts = F.sequence(F.col(start), F.col(final), F.make_dt_interval(F.lit(day_range + 1)))
    rest = [c for c in df.columns if c not in (start, final)]
    # sequence() would count downwards from a start after the final day.
    return (
        df.filter(F.col(start) <= F.col(final))
        .select(*rest, F.posexplode(starts).alias("bucket", "window_start"))
        .withColumn("window_end", F.date_add("window_start", day_range))
    )


def assign_window(df: DataFrame, date="date", origin="origin", day_range=2) -> DataFrame:
    """Number the fetch window each row's day falls into, without a join."""
    step = day_range + 1
    bucket = F.floor(F.datediff(F.col(date), _col(origin)) / step).cast("int")
    return (
        df.withColumn("bucket", bucket)
        .withColumn("window_start", F.date_add(_col(origin), F.col("bucket") * step))
        .withColumn("window_end", F.date_add("window_start", day_range))
    )
