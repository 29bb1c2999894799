"""From articles and bars to the feature table."""

from pyspark.sql import DataFrame, functions as F

from tickermood.functions.text import sentence_words
from tickermood.operators.features import join_features
from tickermood.operators.market import price_features
from tickermood.operators.scaling import scale
from tickermood.operators.sentiment import (
    both_scores,
    daily_sentiment,
    dictionary_sentiment,
    pnn_score,
    valence_score,
)


def score_articles(news: DataFrame, valences: DataFrame, classes: DataFrame, lemmas=None, text_col="article") -> DataFrame:
    """Both article scores, computed where the article is read.

    The text is cut into words once: the words of its sentences in a row are its
    words, since no word reaches over a sentence gap. Small dictionaries without lemmas
    need one pass for both scores.
    """
    scored = both_scores(news, valences, classes, text_col) if lemmas is None else None
    if scored is not None:
        return pnn_score(scored)
    cut = news.withColumn("_sentences", sentence_words(text_col))
    scored = valence_score(cut, valences, text_col, words=F.flatten("_sentences"))
    labelled = dictionary_sentiment(scored, classes, text_col, lemmas=lemmas, sentences=F.col("_sentences"))
    return pnn_score(labelled).drop("_sentences")


def daily_scores(news: DataFrame, valences: DataFrame, classes: DataFrame, lemmas=None, text_col="article") -> DataFrame:
    """Daily mean of both scores, the valence mean scaled by its deviation.

    The articles are read once and only sums per symbol and day are shuffled.
    """
    return scale_daily(daily_sentiment(score_articles(news, valences, classes, lemmas, text_col)))


def scale_daily(daily: DataFrame) -> DataFrame:
    scaled = scale(daily, "afinn_sentiment_mean", center=False, by="symbol", out="afinn_sentiment", per_day=True)
    return scaled.select("symbol", "date", "afinn_sentiment", "pnn_sentiment")


def feature_table(
    news: DataFrame, bars: DataFrame, valences: DataFrame, classes: DataFrame,
    lemmas=None, text_col="article", how="inner", inference=False,
) -> DataFrame:
    """One row per symbol and day with sentiment, market changes and target."""
    scores = daily_scores(news, valences, classes, lemmas, text_col)
    return join_features(scores, price_features(bars), how, inference)
