"""Word lists, dictionaries and the ticker map."""

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickermood.schemas import CLASS_LEXICON, TICKERS
from tickermood.sources.local import small_frame

# The default sentiment dictionary.
DEFAULT_CLASSES = [
    ("good", "positive"),
    ("nice", "positive"),
    ("awesome", "positive"),
    ("cool", "positive"),
    ("superb", "positive"),
    ("bad", "negative"),
    ("uninspired", "negative"),
    ("expensive", "negative"),
    ("disappointed", "negative"),
    ("recommend others to avoid", "negative"),
    ("lack of", "revert"),
    ("not", "revert"),
    ("too", "increment"),
    ("very", "increment"),
    ("sorely", "increment"),
    ("barely", "decrement"),
    ("little", "decrement"),
]

# Ticker of each followed company.
DEFAULT_TICKERS = [
    ("NVIDIA", "NVDA"),
    ("Bitcoin", "BTC-USD"),
    ("Apple", "AAPL"),
    ("Tesla", "TSLA"),
]

# Word lists of the plain polarity score, compared in lower case.
POSITIVE_WORDS = [
    "Love", "Happy", "Joy", "Excited", "Wonderful", "Amazing", "Fantastic", "Great", "Excellent", "Awesome",
    "Delight", "Bliss", "Grateful", "Hopeful", "Peaceful", "Success", "Thrilled", "Enthusiastic", "Optimistic",
    "Admire", "Brilliant", "Cheerful", "Ecstatic", "Energetic", "Fascinating", "Glorious", "Harmony",
    "Inspirational", "Magical", "Miracle", "Radiant", "Sensational", "Triumphant", "Vibrant", "Wholesome",
    "Affection", "Blessing", "Caring", "Charming", "Courage", "Dazzling", "Dream", "Empower", "Freedom", "Glowing",
    "Healing", "Honor", "Incredible", "Jubilant", "Kindness", "Liberate", "Marvelous", "Noble", "Paradise",
    "Rejoice", "Spectacular", "Sunny", "Transform", "Uplift", "Wondrous", "Abundant", "Blissful", "Calm", "Divine",
    "Euphoric", "Genuine", "Heartfelt", "Inspire", "Majestic", "Nurture", "Overflowing", "Radiate", "Serene",
    "Sparkling", "Tranquil", "Unconditional", "Vitality", "Warmth", "Zest", "Adoration", "Bountiful", "Celebrate",
    "Compassion", "Elegant", "Faith", "Gratitude", "Hope", "Imagination", "Lively", "Miraculous", "Passion",
    "Renew", "Serenity", "Splendid", "Treasure", "Vibrant", "Wisdom",
]

# The negative counterpart.
NEGATIVE_WORDS = [
    "Hate", "Sad", "Angry", "Disappointed", "Terrible", "Horrible", "Awful", "Disgusting", "Annoyed", "Frustrated",
    "Depressed", "Gloomy", "Miserable", "Dreadful", "Unhappy", "Painful", "Sorrow", "Regret", "Agony", "Grief",
    "Melancholy", "Despair", "Hopeless", "Lonely", "Heartbroken", "Wretched", "Suffering", "Apathetic", "Desperate",
    "Furious", "Enraged", "Bitter", "Jealous", "Hostile", "Offensive", "Resentful", "Pessimistic", "Gloomy",
    "Nauseating", "Repulsive", "Disappointing", "Disgusted", "Disheartened", "Disillusioned", "Dismal",
    "Distressed", "Disturbed", "Grieving", "Lament", "Languish", "Moody", "Morose", "Nervous", "Pessimism", "Rage",
    "Rueful", "Shameful", "Somber", "Sorrowful", "Stressful", "Tearful", "Tragic", "Troubled", "Unpleasant",
    "Upset", "Vexed", "Weary", "Woeful", "Worst", "Worried", "Abominable", "Abysmal", "Anguish", "Anxious",
    "Appalled", "Atrocious", "Dejected", "Detest", "Dismayed", "Dread", "Fretful", "Grumpy", "Horrified",
    "Humiliated", "Inferior", "Insecure", "Irked", "Lousy", "Mournful", "Nasty", "Panicked", "Pathetic",
    "Perplexed", "Repugnant", "Shocked", "Stressed", "Tense", "Tiresome", "Unbearable", "Uncertain", "Unhappy",
    "Unpleasant", "Unsettled",
]


def _fields(delimiter: str) -> Column:
    return F.split(F.trim("value"), F.lit(f"\\Q{delimiter}\\E"))


def read_lexicon(spark: SparkSession, path, delimiter=",") -> DataFrame:
    """``term,class`` lines; the term may hold several words. Other lines are passed over."""
    parts = _fields(delimiter)
    rows = spark.read.text(path).select(
        F.trim(F.get(parts, F.lit(0))).alias("term"), F.trim(F.get(parts, F.lit(1))).alias("class")
    )
    return rows.filter("term <> '' and class <> ''")


def read_valences(spark: SparkSession, path, delimiter="\t") -> DataFrame:
    """``term<TAB>valence`` lines with integer valences of -5 to 5. Other lines are passed over."""
    parts = _fields(delimiter)
    rows = spark.read.text(path).select(
        F.trim(F.get(parts, F.lit(0))).alias("term"), F.trim(F.get(parts, F.lit(1))).try_cast("int").alias("valence")
    )
    return rows.filter("term <> '' and valence is not null")


def read_lemmas(spark: SparkSession, path, key_delimiter="->", value_delimiter="\t") -> DataFrame:
    """``lemma->form<TAB>form`` lines to one row per form in lower case. Other lines are passed over.

    A form listed under several lemmas takes the alphabetically first.
    """
    parts = F.split("value", F.lit(f"\\Q{key_delimiter}\\E"))
    forms = F.split(F.get(parts, F.lit(1)), F.lit(f"\\Q{value_delimiter}\\E"))
    rows = spark.read.text(path).select(F.trim(F.get(parts, F.lit(0))).alias("lemma"), F.explode(forms).alias("form"))
    return (
        rows.select(F.lower(F.trim("form")).alias("form"), F.lower("lemma").alias("lemma"))
        .filter("form <> '' and lemma <> ''")
        .groupBy("form")
        .agg(F.min("lemma").alias("lemma"))
    )


def default_lexicon(spark: SparkSession) -> DataFrame:
    return small_frame(spark, DEFAULT_CLASSES, CLASS_LEXICON)


def default_tickers(spark: SparkSession) -> DataFrame:
    return small_frame(spark, DEFAULT_TICKERS, TICKERS)


def default_wordlist(spark: SparkSession) -> DataFrame:
    words = [(w.lower(), "positive") for w in POSITIVE_WORDS] + [(w.lower(), "negative") for w in NEGATIVE_WORDS]
    return small_frame(spark, words, CLASS_LEXICON)
