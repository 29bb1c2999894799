"""Feature table: joins, ticker lookup, null handling."""

from pyspark.sql import DataFrame, functions as F

from tickermood.functions.columns import fill_target
from tickermood.schemas import FEATURES, TARGET


def unknown_companies(df: DataFrame, tickers: DataFrame, company="company") -> DataFrame:
    """Companies of ``df`` without a ticker."""
    return df.select(company).join(tickers.select(F.col("company").alias(company)), company, "left_anti").distinct()


def resolve_symbol(df: DataFrame, tickers: DataFrame, company="company", on_unknown="error", out="symbol") -> DataFrame:
    """Add the ticker of each row's company.

    An unknown company fails the job that reads the symbol, without a job of its
    own to look for one; ``on_unknown="null"`` keeps such rows with a null.
    """
    known = tickers.select(F.col("company").alias(company), F.col("ticker").alias(out))
    joined = df.join(known, company, "left").select(*df.columns, out)
    if on_unknown == "null":
        return joined
    if on_unknown != "error":
        raise ValueError(f"unknown setting {on_unknown!r}: use 'error' or 'null'")
    message = F.concat(F.lit("no ticker for company "), F.coalesce(F.col(company), F.lit("null")))
    return joined.withColumn(out, F.coalesce(F.col(out), F.raise_error(message).cast("string")))


def join_features(scores: DataFrame, prices: DataFrame, how="inner", inference=False) -> DataFrame:
    """Scores and price changes of a day in one row, rows with a null dropped.

    A right outer join followed by the drop keeps the same rows as an inner join,
    but Spark does not see that; ``how="right"`` is there to compare.
    """
    if how not in ("inner", "right"):
        raise ValueError(f"unknown join {how!r}: use 'inner' or 'right'")
    joined = scores.join(prices, ["symbol", "date"], how)
    if inference:
        joined = fill_target(joined, TARGET)
    return joined.select("symbol", *[f.name for f in FEATURES.fields]).dropna()
