"""Row-wise expressions for changes, labels and features."""

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, functions as F

from tickermood.schemas import MARKET_COLUMNS, SENTIMENT_COLUMNS


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def change(current, previous, scale=100.0) -> Column:
    """Relative change; null without a previous value or when that is zero."""
    current, previous = _col(current), _col(previous)
    return F.try_divide((current - previous).cast("double"), previous.cast("double")) * F.lit(float(scale))


def polarity(positive, negative) -> Column:
    """(p - n) / max(p + n, 1), always within -1 and 1."""
    positive, negative = _col(positive), _col(negative)
    return (positive - negative) / F.greatest(positive + negative, F.lit(1))


def direction(value, rule="gt0") -> Column:
    """1 for up and 0 for down. A zero counts as down by ``gt0``, as up by ``ge0``.

    ``gt0`` takes a null for down, ``ge0`` for up; drop nulls first when training.
    """
    value = _col(value)
    if rule == "gt0":
        return F.when(value > 0, 1).otherwise(0)
    if rule == "ge0":
        return F.when(value < 0, 0).otherwise(1)
    raise ValueError(f"unknown rule {rule!r}: use 'gt0' or 'ge0'")


def label_direction(df: DataFrame, col: str, rule="gt0", out="label") -> DataFrame:
    return df.withColumn(out, direction(col, rule))


def trend_label(prediction) -> Column:
    return F.when(_col(prediction) == 1, "bullish").otherwise("bearish")


def fill_target(df: DataFrame, col: str) -> DataFrame:
    """The latest session has no next day yet; inference sets its target to 0."""
    return df.withColumn(col, F.coalesce(F.col(col), F.lit(0.0)))


def first_element(vector) -> Column:
    return vector_to_array(_col(vector))[0]


def feature_columns(emotion: bool) -> list[str]:
    """Model inputs with (True) or without (False) the sentiment columns."""
    return (SENTIMENT_COLUMNS if emotion else []) + MARKET_COLUMNS


def landing_name(symbol, start, end, ordinal) -> Column:
    """File name of a landed article: symbol, fetch window and article number."""
    day = lambda c: F.date_format(_col(c), "dd-MMMM-yyyy")
    return F.format_string("%s_%s-%s_%d.json", _col(symbol), day(start), day(end), _col(ordinal))
