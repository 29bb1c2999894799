"""Splitting text into sentences, words and phrases, one expression each."""

from pyspark.sql import Column, functions as F

SENTENCE_GAP = r"(?<=[.!?])[ \t\n\f\r]+"


def _col(c):
    return F.col(c) if isinstance(c, str) else c


def sentence_array(text) -> Column:
    """Sentences end at ``.``, ``!`` or ``?`` before white space; never empty strings."""
    return F.array_remove(F.split(_col(text), SENTENCE_GAP), "")


def word_array(text) -> Column:
    """Lower-cased runs of the letters a to z, in order."""
    return F.array_remove(F.split(F.lower(_col(text)), "[^a-z]+"), "")


def blank_separated(text) -> Column:
    """Lower-cased text cut at white space, punctuation left on the words."""
    return F.split(F.trim(F.lower(_col(text))), r"\s+")


def sentence_words(text) -> Column:
    """Words of each sentence: array<array<string>>."""
    return F.transform(sentence_array(text), word_array)


def ahead(words: Column, size: int) -> Column:
    """For each word the ``size`` words starting with it (fewer at the end)."""
    return F.transform(words, lambda word, i: F.slice(words, i + 1, size))
