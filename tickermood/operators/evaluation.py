"""Model metrics as aggregates."""

from pyspark.sql import DataFrame, Window, functions as F

from tickermood.operators.ordinal import ranged


def _fit_terms(label, prediction):
    """RMSE and R2 from plain sums, so they need a single pass."""
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    sse = F.sum((y - p) * (y - p))
    sst = F.var_pop(y) * F.count(y)
    return F.sqrt(F.avg((y - p) * (y - p))), 1 - F.try_divide(sse, sst)


def regression_metrics(df: DataFrame, label="label", prediction="prediction", by=()) -> DataFrame:
    rmse, r2 = _fit_terms(label, prediction)
    return df.groupBy(*by).agg(rmse.alias("rmse"), r2.alias("r2"))


def classification_metrics(df: DataFrame, label="label", prediction="prediction", by=()) -> DataFrame:
    right = (F.col(label).cast("double") == F.col(prediction).cast("double")).cast("double")
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("rows"), F.avg(right).alias("accuracy"))


def auc(df: DataFrame, label="label", score="score", by=()) -> DataFrame:
    """Area under the ROC curve: the share of (up, down) pairs ranked rightly.

    Ties count half; null without both classes. Rows are first counted per
    distinct score. These counts are dealt out in ranges of equal size, so that no
    task has to rank all scores of a group: inside a range by a window, between
    ranges by their sums.
    """
    by = list(by)
    up, down = F.count_if(F.col(label) == 1).alias("up"), F.count_if(F.col(label) != 1).alias("down")
    value = F.col(score).cast("double").alias("_score")
    counts = ranged(df.select(*by, value, label).groupBy(*by, "_score").agg(up, down), *by, "_score")
    cell = [*by, "_part"]
    inside = Window.partitionBy(*cell).orderBy("_score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("down").over(inside), F.lit(0))
    in_part = (
        counts.withColumn("below", below)
        .groupBy(*cell)
        .agg(
            F.sum(F.col("up") * (F.col("below") + F.col("down") / 2)).alias("pairs"),
            F.sum("up").alias("up"),
            F.sum("down").alias("down"),
        )
    )
    lower = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    ranked = in_part.withColumn("below", F.coalesce(F.sum("down").over(lower), F.lit(0)))
    pairs = F.sum(F.col("pairs") + F.col("up") * F.col("below"))
    return ranked.groupBy(*by).agg(
        F.try_divide(pairs, (F.sum("up") * F.sum("down")).cast("double")).alias("auc")
    )


def _batched(df: DataFrame, by, order, batch_size) -> DataFrame:
    number = F.row_number().over(Window.partitionBy(by).orderBy(order))
    return df.withColumn("batch_id", F.floor((number - 1) / batch_size))


def batched_accuracy(
    df: DataFrame, label="label", prediction="prediction", by="symbol", order="date", batch_size=32
) -> DataFrame:
    """Unweighted mean of the accuracy of consecutive batches. Daily frames only."""
    per_batch = classification_metrics(_batched(df, by, order, batch_size), label, prediction, [by, "batch_id"])
    return per_batch.groupBy(by).agg(
        F.count(F.lit(1)).alias("batches"), F.avg("accuracy").alias("mean_batch_accuracy"),
        F.try_divide(F.sum(F.col("accuracy") * F.col("rows")), F.sum("rows")).alias("accuracy"),
    )


def batched_r2(
    df: DataFrame, label="label", prediction="prediction", by="symbol", order="date", batch_size=32
) -> DataFrame:
    """Unweighted mean of R2 over consecutive batches, next to the R2 of all rows.

    A batch without spread has no R2 and does not count. Daily frames only.
    """
    y, p = F.col(label).cast("double"), F.col(prediction).cast("double")
    per_batch = (
        _batched(df, by, order, batch_size)
        .groupBy(by, "batch_id")
        .agg(
            F.count(y).alias("n"),
            F.avg(y).alias("mean"),
            (F.var_pop(y) * F.count(y)).alias("sst"),
            F.sum((y - p) * (y - p)).alias("sse"),
        )
    )
    # Spread of all rows: within the batches, and of the batch means.
    n, mean = F.col("n"), F.col("mean")
    sst = F.sum("sst") + F.sum(n * mean * mean) - F.sum(n * mean) * F.sum(n * mean) / F.sum(n)
    return per_batch.groupBy(by).agg(
        F.count(F.lit(1)).alias("batches"),
        F.avg(1 - F.try_divide("sse", "sst")).alias("mean_batch_r2"),
        (1 - F.try_divide(F.sum("sse"), sst)).alias("r2"),
    )
