"""The given star-schema tables seen as articles, bars and dictionaries."""

from pyspark.sql import DataFrame, SparkSession, functions as F

from tickermood.operators.market import daily_bars
from tickermood.schemas import CLASS_LEXICON, LEMMAS, LINEAR_MODEL, PERCEPTRON, TICKERS, TREE_NODES, VALENCE_LEXICON
from tickermood.session import spread_small
from tickermood.sources.local import small_frame

EVENT_SYMBOLS = ["click", "error", "purchase", "signup", "view"]
SEGMENT_SYMBOLS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
FIRST_DAY = "2024-01-01"
SEGMENT_FIRST_DAY = "1996-01-01"

# (term, valence, class): words that do occur in the sample texts.
SAMPLE_LEXICON = [
    ("with", 2, "positive"),
    ("this", 1, "positive"),
    ("was", 1, "positive"),
    ("that", -1, "negative"),
    ("trash", -2, "negative"),
    ("worthless", -3, "negative"),
    ("scum", -3, "negative"),
    ("moron", -3, "negative"),
    ("pathetic", -2, "negative"),
    ("clown", -1, "negative"),
    ("disgusting", -3, "negative"),
    ("stupid", -2, "negative"),
    ("loser", -2, "negative"),
    ("idiot", -3, "negative"),
    ("is", 0, "increment"),
    ("as", 0, "decrement"),
    ("from", 0, "revert"),
    ("of the", 0, "revert"),
]

SAMPLE_LEMMAS = [("were", "be"), ("was", "be"), ("is", "be"), ("are", "be"), ("on", "upon"), ("the", "that"), ("in", "with")]

SAMPLE_TICKERS = [("click", "CLCK"), ("error", "ERR"), ("purchase", "BUY"), ("signup", "JOIN"), ("view", "VIEW")]

# Small models over the inputs afinn, pnn, price and volume change, as they come out of ``plans.scoring``.
SAMPLE_TREES = [
    # tree, weight, node, feature, threshold, left, right, down, up
    (0, 1.0, 0, 2, 0.25, 1, 4, None, None),
    (0, 1.0, 1, 0, -1.5, 2, 3, None, None),
    (0, 1.0, 2, -1, None, -1, -1, 0.75, 0.25),
    (0, 1.0, 3, -1, None, -1, -1, 0.375, 0.625),
    (0, 1.0, 4, 3, 10.0, 5, 6, None, None),
    (0, 1.0, 5, -1, None, -1, -1, 0.25, 0.75),
    (0, 1.0, 6, -1, None, -1, -1, 0.5, 0.5),
    (1, 0.5, 0, 1, 0.0, 1, 2, None, None),
    (1, 0.5, 1, -1, None, -1, -1, 0.875, 0.125),
    (1, 0.5, 2, 3, -20.0, 3, 4, None, None),
    (1, 0.5, 3, -1, None, -1, -1, 0.125, 0.875),
    (1, 0.5, 4, 2, -2.0, 5, 6, None, None),
    (1, 0.5, 5, -1, None, -1, -1, 0.25, 0.75),
    (1, 0.5, 6, -1, None, -1, -1, 0.625, 0.375),
    (2, 0.25, 0, -1, None, -1, -1, 0.5, 0.75),
]

# layer, unit, input (-1 for the bias), weight
SAMPLE_PERCEPTRON = [
    (0, 0, -1, 0.1), (0, 0, 0, 0.5), (0, 0, 1, -0.25), (0, 0, 2, 0.125), (0, 0, 3, 0.01),
    (0, 1, -1, -0.2), (0, 1, 0, -0.75), (0, 1, 1, 0.5), (0, 1, 2, 0.25), (0, 1, 3, -0.02),
    (0, 2, -1, 0.0), (0, 2, 0, 0.3), (0, 2, 1, 0.3), (0, 2, 2, -0.3), (0, 2, 3, 0.03),
    (1, 0, -1, 0.05), (1, 0, 0, 1.5), (1, 0, 1, -1.0), (1, 0, 2, 0.5),
    (1, 1, -1, -0.05), (1, 1, 0, -1.25), (1, 1, 1, 0.75), (1, 1, 2, 0.25),
]

# input ('' for the intercept), mean, deviation, coefficient
SAMPLE_LINEAR = [
    ("", 0.0, 1.0, -0.05), ("afinn_sentiment", 0.0, 1.0, 0.08), ("pnn_sentiment", 0.0, 1.0, -0.4),
    ("price_percent_change", 0.0, 1.0, -0.03), ("volume_percent_change", 12.5, 40.0, 0.1),
]


def table(spark: SparkSession, sf_dir, name) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _pick(names, number):
    return F.element_at(F.array(*[F.lit(n) for n in names]), (number % len(names)).cast("int") + 1)


def as_news(documents: DataFrame, symbols=EVENT_SYMBOLS, first_day=FIRST_DAY, days=30, keep=()) -> DataFrame:
    """Documents dealt out over symbols and days."""
    day = F.expr(f"cast((doc_id div {len(symbols)}) % {days} as int)")
    return documents.select(
        "doc_id",
        _pick(symbols, F.col("doc_id")).alias("symbol"),
        F.date_add(F.lit(first_day).cast("date"), day).alias("date"),
        F.col("text").alias("article"),
        *keep,
    )


def documents(spark, sf_dir, *columns) -> DataFrame:
    """The document texts, in enough partitions to cut them into words in parallel."""
    return spread_small(table(spark, sf_dir, "documents").select("doc_id", "text", *columns), "doc_id")


def news(spark, sf_dir) -> DataFrame:
    return as_news(documents(spark, sf_dir))


def prices(spark, sf_dir) -> DataFrame:
    """Last value and number of events per type and day."""
    events = table(spark, sf_dir, "events").withColumnRenamed("event_type", "symbol")
    return daily_bars(events, "value", "ts", "event_id")


def segment_news(spark, sf_dir) -> DataFrame:
    """Documents dealt out over market segments and two years of days."""
    return as_news(documents(spark, sf_dir), SEGMENT_SYMBOLS, SEGMENT_FIRST_DAY, 730)


def segment_prices(spark, sf_dir) -> DataFrame:
    """Mean order price and number of orders per market segment and day."""
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
    return (
        orders.join(customers, orders.o_custkey == customers.c_custkey)
        .groupBy(F.col("c_mktsegment").alias("symbol"), F.col("o_orderdate").cast("date").alias("date"))
        .agg(F.avg("o_totalprice").alias("adjclose"), F.count(F.lit(1)).alias("volume"))
    )


def valences(spark) -> DataFrame:
    return small_frame(spark, [(t, v) for t, v, _ in SAMPLE_LEXICON], VALENCE_LEXICON)


def classes(spark) -> DataFrame:
    return small_frame(spark, [(t, c) for t, _, c in SAMPLE_LEXICON], CLASS_LEXICON)


def lemmas(spark) -> DataFrame:
    return small_frame(spark, SAMPLE_LEMMAS, LEMMAS)


def tickers(spark) -> DataFrame:
    return small_frame(spark, SAMPLE_TICKERS, TICKERS)


def trees(spark) -> DataFrame:
    return small_frame(spark, SAMPLE_TREES, TREE_NODES)


def perceptron(spark) -> DataFrame:
    return small_frame(spark, SAMPLE_PERCEPTRON, PERCEPTRON)


def linear(spark) -> DataFrame:
    return small_frame(spark, SAMPLE_LINEAR, LINEAR_MODEL)
