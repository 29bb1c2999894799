"""Class balance and correlations."""

from itertools import product

from pyspark.sql import DataFrame, functions as F


def class_balance(df: DataFrame, label="label") -> DataFrame:
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("count")).orderBy(F.desc("count"), label)


def correlation_matrix(df: DataFrame, cols, by=()) -> DataFrame:
    """Pearson correlation of every pair of columns, one row per pair, in one pass."""
    cols, by = list(cols), list(by)
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i:]]
    wide = df.groupBy(*by).agg(*[F.corr(a, b).alias(f"{a}|{b}") for a, b in pairs])
    cell = lambda a, b: F.col(f"{a}|{b}" if cols.index(a) <= cols.index(b) else f"{b}|{a}")
    cells = F.array(
        *[
            F.struct(F.lit(a).alias("col_a"), F.lit(b).alias("col_b"), cell(a, b).alias("corr"))
            for a, b in product(cols, cols)
        ]
    )
    return wide.select(*by, F.inline(cells))


def linear_fit_1d(df: DataFrame, y: str, x: str, by="symbol") -> DataFrame:
    """Least-squares line of ``y`` over ``x`` for every group, from running sums."""
    return df.groupBy(by).agg(
        F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"), F.regr_r2(y, x).alias("r2")
    )
