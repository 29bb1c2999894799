"""Price, feature, metric, history and model files."""

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tickermood.schemas import FEATURES, HISTORY, PRICES


def read_prices(spark: SparkSession, path, symbols=None, start=None, end=None) -> DataFrame:
    """Daily bars of a symbol-partitioned table, ``start`` and ``end`` included.

    The symbol filter prunes folders and the date range reaches the scan.
    """
    bars = spark.read.schema(PRICES).parquet(path)
    if symbols is not None:
        bars = bars.filter(F.col("symbol").isin(list(symbols)))
    if start is not None:
        bars = bars.filter(F.col("date") >= F.lit(start).cast("date"))
    if end is not None:
        bars = bars.filter(F.col("date") <= F.lit(end).cast("date"))
    return bars.select("symbol", "date", "adjclose", "volume")


def write_prices(bars: DataFrame, path) -> None:
    """One folder per symbol, each file in the order of days, so that readers skip by day."""
    rows = bars.hint("rebalance", "symbol").sortWithinPartitions("symbol", "date")
    rows.write.mode("overwrite").partitionBy("symbol").parquet(path)


def read_features(spark: SparkSession, path, header=False, format="csv", symbol=None) -> DataFrame:
    """Feature rows. CSV columns go by position; ``header=True`` skips a first line.

    ``symbol=...`` folders give the symbol column; for a bare folder of one stock
    pass ``symbol``.
    """
    reader = spark.read
    if format == "csv":
        reader = reader.option("header", header).option("enforceSchema", True)
    if symbol is not None:
        return reader.schema(FEATURES).format(format).load(path).withColumn("symbol", F.lit(symbol))
    return reader.schema(StructType([*FEATURES.fields, StructField("symbol", StringType())])).format(format).load(path)


def write_features(df: DataFrame, path, format="parquet") -> None:
    """One folder per symbol, each file in the order of days.

    The rebalance hint gathers a symbol's rows into few files, and lets adaptive
    execution split a symbol that is too large for one task.
    """
    columns = [f.name for f in FEATURES.fields]
    rows = df.select(*columns, "symbol").hint("rebalance", "symbol").sortWithinPartitions("symbol", "date")
    rows.write.mode("overwrite").partitionBy("symbol").format(format).save(path)


def write_ordered(df: DataFrame, path, order=("date", "symbol"), files=None) -> None:
    """Files in one global order: ranges of ``order`` that do not overlap, each sorted within.

    The bounds come from a sample; equal values share a file. ``files`` says into how many
    ranges, by default as many as there are shuffle partitions.
    """
    count = [files] if files else []
    rows = df.repartitionByRange(*count, *order).sortWithinPartitions(*order)
    rows.write.mode("overwrite").parquet(path)


def file_bounds(spark: SparkSession, path, order=("date", "symbol")) -> DataFrame:
    """``(file, first, last, rows, offset)`` of files written in order; ``offset`` is the number of rows before them."""
    key = F.struct(*order)
    found = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(
        F.min(key).alias("first"), F.max(key).alias("last"), F.count(F.lit(1)).alias("rows")
    )
    # One row per file: this window is as small as the list of files.
    before = F.sum("rows").over(Window.orderBy("first", "last", "file").rowsBetween(Window.unboundedPreceding, -1))
    return found.withColumn("offset", F.coalesce(before, F.lit(0)))


def read_ordered(spark: SparkSession, path, order=("date", "symbol"), position="position") -> DataFrame:
    """The rows with their place in the global order from 0, read off from file and row, without a sort.

    Fails where two files overlap, or a row comes before its predecessor in the file.
    """
    bounds = file_bounds(spark, path, order)
    previous = F.lag("last").over(Window.orderBy("first", "last", "file"))
    checked = bounds.select(
        F.col("file").alias("_file"),
        F.when(F.coalesce(previous > F.col("first"), F.lit(False)), F.raise_error(F.concat(F.lit("overlaps: "), "file")).cast("long"))
        .otherwise(F.col("offset")).alias("_offset"),
    )
    rows = spark.read.parquet(path).select("*", F.col("_metadata.file_path").alias("_path"), F.col("_metadata.row_index").alias("_at"))
    key = F.struct(*order)
    before = F.lag(key).over(Window.partitionBy("_path").orderBy("_at"))
    place = F.when(F.coalesce(before > key, F.lit(False)), F.raise_error(F.concat(F.lit("out of order: "), "_path")).cast("long"))
    placed = rows.withColumn("_at", place.otherwise(F.col("_at")))
    met = placed.join(checked, F.col("_path") == F.col("_file")).withColumn(position, F.col("_offset") + F.col("_at"))
    return met.drop("_path", "_file", "_offset", "_at")


def write_metrics(df: DataFrame, path) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def write_histories(df: DataFrame, path) -> None:
    df.write.mode("append").json(path)


def read_histories(spark: SparkSession, path) -> DataFrame:
    """Training histories with their headline metric.

    A history without a ``name`` takes the name of its file, up to the first dot.
    Other files of the folder (metric tables) are passed over.
    """
    file_name = F.element_at(F.split(F.url_decode(F.col("_metadata.file_path")), "/"), -1)
    rows = spark.read.schema(HISTORY).option("pathGlobFilter", "*.json").json(path)
    return rows.select(
        F.coalesce("name", F.split_part(file_name, F.lit("."), F.lit(1))).alias("name"),
        "loss",
        "val_loss",
        F.when(F.col("test_r_2_score").isNotNull(), "test_r_2_score")
        .when(F.col("test_accuracy").isNotNull(), "test_accuracy")
        .alias("metric"),
        F.coalesce("test_r_2_score", "test_accuracy").alias("value"),
    )


def save_model(model: PipelineModel, path) -> None:
    """Save the whole fitted pipeline, scaler included."""
    model.write().overwrite().save(path)


def load_model(path) -> PipelineModel:
    return PipelineModel.load(path)
