"""Dictionary lookup inside an expression.

Scoring a text needs nothing but the text and a dictionary. One of up to ``INLINE_TERMS``
rows is held as a constant of the plan and looked up where the text is read: no row leaves
its task, nothing is shuffled, no column is needed to tell rows apart, and a stream is
scored like a table. A larger one is joined instead (``operators.term_join``), with the
same results.
"""

import json

from pyspark.sql import Column, DataFrame, functions as F

# What goes to the driver and to every task has a bound: about a MB at this many terms.
INLINE_TERMS = 20_000


class Lookup:
    """Constant map from word to value, probed in constant time.

    A map literal is searched from its start, which is slow for thousands of
    words. The words are therefore spread over an array of small maps by hash.
    """

    def __init__(self, hashed: list[tuple], value_type: str):
        size = 1
        while size < 2 * len(hashed):
            size *= 2
        slots: list[dict] = [{} for _ in range(size)]
        for word, word_hash, value in hashed:
            slots[word_hash % size][word] = value
        self._size = size
        text = json.dumps(slots).replace("\\", "\\\\").replace("'", "\\'")
        self._slots = f"from_json('{text}', 'array<map<string,{value_type}>>')"

    def of(self, word: Column) -> Column:
        """The value of ``word``, null for an unknown one."""
        slot = F.pmod(F.hash(word), F.lit(self._size))
        return F.try_element_at(F.get(F.expr(self._slots), slot), word)

    def get(self, word: str) -> str:
        """SQL of the value of ``word``, itself SQL; null for an unknown word."""
        return f"try_element_at({self._slots}[pmod(hash({word}), {self._size})], {word})"


def fetch_lookup_rows(rows: DataFrame):
    """The rows of a dictionary with the hash of ``word``; None if there are more than ``INLINE_TERMS``."""
    found = rows.withColumn("word_hash", F.hash("word")).limit(INLINE_TERMS + 1).collect()
    return found if len(found) <= INLINE_TERMS else None


def word_lookup(rows: DataFrame, value: str, value_type: str) -> Lookup | None:
    """Lookup of a ``(word, value)`` table with one row per word; None for a large one."""
    found = fetch_lookup_rows(rows.select("word", value))
    return None if found is None else Lookup([(r["word"], r["word_hash"], r[value]) for r in found], value_type)
