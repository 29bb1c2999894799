"""Article files: scan, shaping and landing."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickermood.functions.columns import landing_name
from tickermood.functions.dates import assign_window, news_date
from tickermood.operators.ordinal import article_ordinal
from tickermood.schemas import LANDED_NEWS, NEWS


def folder_name() -> Column:
    """Name of the folder a row's file lies in (one folder per stock)."""
    path = F.regexp_replace(F.col("_metadata.file_path"), r"\+", "%2B")
    return F.url_decode(F.regexp_extract(path, r"([^/]+)/[^/]+$", 1))


def clean_news(df: DataFrame) -> DataFrame:
    """A failed download leaves the bare token NaN in the article; it means null."""
    return df.withColumn("article", F.when(F.col("article") != "NaN", F.col("article")))


def read_news(spark: SparkSession, path, symbol=None) -> DataFrame:
    """Scan article files with a fixed schema, so no job infers one.

    ``symbol`` names the stock of the whole path. Without it each row takes the
    name of its folder, for a path such as ``news/*``.
    """
    owner = F.lit(symbol) if symbol is not None else folder_name()
    return clean_news(spark.read.schema(NEWS).json(path).withColumn("symbol", owner))


def flatten_news(raw: DataFrame, keep=()) -> DataFrame:
    """Search results with a nested publisher to landing columns, plus the day."""
    return raw.select(
        "symbol",
        "article",
        "description",
        "published date",
        F.col("publisher.title").alias("publisher"),
        F.col("publisher.href").alias("publisher_url"),
        "title",
        "url",
        news_date("`published date`").alias("date"),
        *keep,
    )


def shape_news(raw: DataFrame, origin, day_range=2, key=None) -> DataFrame:
    """Fetch window, article number in it and file name of every search result.

    ``origin`` is the first day ever fetched. Articles of a window are numbered by
    day, then by the numeric column ``key`` if there is one and else by a hash of
    the address: the order of a search result is not data. Rows whose publication
    text holds no date keep null in those columns. The rows that are numbered hold the
    length of the article and not its text, so no text is shuffled; ``land_news``
    writes the texts as ``flatten_news`` gives them.
    """
    named = F.xxhash64("url", "title").alias("_key") if key is None else key
    flat = flatten_news(raw, keep=[named]).withColumn("n_chars", F.length("article")).drop("article", "description")
    windowed = assign_window(flat, "date", F.lit(origin).cast("date"), day_range)
    numbered = article_ordinal(
        windowed, by=["symbol", "bucket"], order=["date"], key=key or "_key", tie_break=["url", "title"]
    )
    name = landing_name("symbol", "window_start", "window_end", "ordinal")
    return numbered.withColumn("file_name", F.when(F.col("date").isNotNull(), name)).drop("_key")


def land_news(flat: DataFrame, path, articles_per_file=None) -> None:
    """Write landing rows as JSON, one folder per symbol.

    The rebalance hint spares every task from writing a small file per symbol;
    adaptive execution splits a symbol too large for one task.
    ``articles_per_file=1`` gives one object per file; at scale leave it unset.
    """
    rows = flat.select(*[F.col(f"`{f.name}`") for f in NEWS.fields], "symbol").hint("rebalance", "symbol")
    writer = rows.write.mode("append").partitionBy("symbol")
    if articles_per_file:
        writer = writer.option("maxRecordsPerFile", articles_per_file)
    writer.json(path)


def read_landed_news(spark: SparkSession, path) -> DataFrame:
    """Articles written by ``land_news``, with the symbol of their folder."""
    return clean_news(spark.read.schema(LANDED_NEWS).json(path))
