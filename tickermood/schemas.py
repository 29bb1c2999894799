"""Row layouts shared by sources, operators and sinks."""

from pyspark.sql import types as T

_S, _D = T.StringType(), T.DoubleType()


def _struct(*fields):
    return T.StructType([T.StructField(name, dtype, True) for name, dtype in fields])


# One news article as it lies in the landing folder.
NEWS = _struct(
    ("article", _S),
    ("description", _S),
    ("published date", _S),
    ("publisher", _S),
    ("publisher_url", _S),
    ("title", _S),
    ("url", _S),
)

# The same with the symbol of a landing folder written by ``land_news``.
LANDED_NEWS = T.StructType([*NEWS.fields, T.StructField("symbol", _S, True)])

# One search result before shaping: the publisher is still nested.
RAW_NEWS = _struct(
    ("article", _S),
    ("description", _S),
    ("published date", _S),
    ("publisher", _struct(("href", _S), ("title", _S))),
    ("title", _S),
    ("url", _S),
)

PRICES = _struct(
    ("symbol", _S),
    ("date", T.DateType()),
    ("adjclose", _D),
    ("volume", T.LongType()),
)

SENTIMENT_COLUMNS = ["afinn_sentiment", "pnn_sentiment"]
MARKET_COLUMNS = ["price_percent_change", "volume_percent_change"]
TARGET = "next_day_price_percent_change_shifted"

# Positional, headerless feature file.
FEATURES = _struct(
    ("date", T.DateType()),
    *[(c, _D) for c in SENTIMENT_COLUMNS + MARKET_COLUMNS + [TARGET]],
)

RESULTS = _struct(("model", _S), ("stock", _S), ("emotion", _S), ("accuracy", T.FloatType()))

HISTORY = _struct(
    ("name", _S),
    ("loss", T.ArrayType(_D)),
    ("val_loss", T.ArrayType(_D)),
    ("accuracy", T.ArrayType(_D)),
    ("val_accuracy", T.ArrayType(_D)),
    ("test_r_2_score", _D),
    ("test_accuracy", _D),
)

CLASS_LEXICON = _struct(("term", _S), ("class", _S))
VALENCE_LEXICON = _struct(("term", _S), ("valence", T.IntegerType()))
LEMMAS = _struct(("form", _S), ("lemma", _S))
TICKERS = _struct(("company", _S), ("ticker", _S))

# Fitted models as tables: see plans.scoring.
_I = T.IntegerType()
TREE_NODES = _struct(
    ("tree", _I), ("weight", _D), ("node", _I), ("feature", _I), ("threshold", _D), ("left_node", _I), ("right_node", _I),
    ("down", _D), ("up", _D),
)
PERCEPTRON = _struct(("layer", _I), ("unit", _I), ("input", _I), ("weight", _D))
LINEAR_MODEL = _struct(("input", _S), ("mean", _D), ("deviation", _D), ("coefficient", _D))
