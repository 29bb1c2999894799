"""What the operators of this package share."""

from pyspark.sql import Column, DataFrame, functions as F

from tickermood.session import scratch_path

# The white space of the word contract: space and U+0009 to U+000D.
SPACES = " \t\n\x0b\x0c\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()

BUCKET_BYTES = 256 << 20


def ascii_lower(text: Column) -> Column:
    """A-Z lower-cased; other letters stay."""
    return F.translate(text, UPPER, LOWER)


def strip_spaces(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def saved(df: DataFrame, name: str) -> DataFrame:
    """The frame written once to the shared folder and read back.

    Later jobs then read rows and not the work behind them, and a lost executor
    loses nothing. The files are Parquet, so they are pruned like any table.
    """
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, name: str, buckets: int | None = None) -> DataFrame:
    """Like ``saved``, with the files bucketed by ``key``: a join by it moves the other side only.

    Unless told otherwise there are as many buckets as shuffle partitions, and more where a
    bucket of the input would pass ``BUCKET_BYTES``.
    """
    spark = df.sparkSession
    if buckets is None:
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
        buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), min(size // BUCKET_BYTES, 100_000))
    path = scratch_path(spark, name)
    table = path.rpartition("/")[2].replace("-", "_")
    writer = df.write.bucketBy(buckets, key).sortBy(key)
    writer.option("path", path).option("compression", "zstd").format("parquet").saveAsTable(table)
    return spark.table(table)


def unused(columns, name: str) -> str:
    """``name``, lengthened until no column is called so (case does not count)."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def documents(spark, sf_dir, *columns) -> DataFrame:
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return table.select(*columns) if columns else table
