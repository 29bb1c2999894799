"""Dictionary lookup by join: for dictionaries too large to stand in the plan.

Texts are dealt into groups by a hash of their words, some hundred KB of files to a group.
The distinct words of a group meet the dictionary, and what was found goes back to the
group as one row, a small hash table, which each of its texts is then looked up in. So
what moves is each text twice and each word of a group, however often its texts hold it.
A Bloom filter of the terms, of one fixed size whatever the dictionary, drops other words
before they move. No row needs an id, equal texts are in one group, and a task that runs
again after the loss of an executor gives the same groups.

A word that very many groups hold makes one large key; adaptive execution splits it, since
only the dictionary's few rows for it are repeated. It splits a group of very many equal
texts likewise. A dictionary that Spark knows to be small is broadcast by the same plan.
"""

from pyspark.sql import Column, DataFrame, functions as F

from tickermood.functions.text import ahead
from tickermood.session import plan_bytes

# Longs of the Bloom filter: 2 MB, below one false word in ten up to a million terms.
BLOOM_LONGS = 1 << 18

# Bytes of files whose texts make one group, and of those that one task cuts into words.
GROUP_BYTES = 1 << 18
TASK_BYTES = 16 << 20
# Groups of a frame whose size Spark does not know, such as a batch of a stream.
GROUPS_UNKNOWN = 1 << 12
# Lists of a group's hash table: with some thousand words, a few to a list.
SLOTS = 1024
# Tasks that the words of a very common text are dealt over.
SALTS = 4


def _place(word: Column) -> Column:
    return F.pmod(F.xxhash64(word), F.lit(64 * BLOOM_LONGS))


def bloom_filter(terms: DataFrame, column="term"):
    """A test of words: false only for words that are no term.

    The filter is one row of fixed size, computed once and used as a constant.
    """
    place = terms.select(_place(F.col(column)).alias("place"))
    bit = F.expr("shiftleft(1L, cast(place % 64 as int))")
    bits = place.groupBy(F.expr("place div 64").alias("at")).agg(F.bit_or(bit).alias("bits"))
    every = terms.sparkSession.range(BLOOM_LONGS).join(bits, F.col("id") == F.col("at"), "left")
    row = every.agg(F.sort_array(F.collect_list(F.struct("id", F.coalesce("bits", F.lit(0)).alias("bits")))).alias("all"))
    longs = row.select(F.col("all.bits")).scalar()
    return lambda word: F.getbit(F.get(longs, F.floor(_place(word) / 64).cast("int")), _place(word) % 64) == 1


def _sizes(df: DataFrame) -> tuple[int, int]:
    """(groups, tasks) for the texts of ``df``."""
    size, least = plan_bytes(df), int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    if size >= 1 << 60:
        return GROUPS_UNKNOWN, least
    return max(1, -(-size // GROUP_BYTES)), max(least, -(-size // TASK_BYTES))


def _slot(word: Column) -> Column:
    return F.pmod(F.hash(word), F.lit(SLOTS))


def _grams(words: Column, sizes) -> Column:
    """The runs of ``sizes`` words, each with a blank between."""
    if list(sizes) == [1]:
        return words

    def runs(n: int) -> Column:
        return F.transform(F.filter(ahead(words, n), lambda run: F.size(run) == n), lambda run: F.array_join(run, " "))

    return F.concat(*map(runs, sizes))


def _with_tables(df: DataFrame, sentences: Column, sizes, terms: DataFrame) -> DataFrame:
    """``df`` with ``_tables``: of the entries ``terms(term, entry)``, those that texts of the row's group hold.

    array<map<string, entry>>, a term in the map at its ``_slot``; null for a group without any.
    """
    groups, tasks = _sizes(df)
    known = bloom_filter(terms)
    # One text is in one group. Other columns only part its copies, so they need not give the same value again.
    group = F.pmod(F.xxhash64(sentences), F.lit(groups))
    others = [F.col(f"`{c}`") for c, kind in df.dtypes if not any(t in kind for t in ("map<", "variant"))]
    salt = F.pmod(F.xxhash64(F.lit("salt"), *others), F.lit(SALTS))
    distinct = F.array_distinct(F.flatten(F.transform(sentences, lambda words: _grams(words, sizes))))
    texts = df.select(group.alias("_group"), salt.alias("_salt"), distinct.alias("_distinct"))
    texts = texts.where("size(_distinct) > 0").repartition(tasks, "_group", "_salt")
    words = texts.select("_group", F.explode("_distinct").alias("term"))
    found = words.where(known(F.col("term"))).distinct().join(terms, "term").repartition(tasks, "_group")
    listed = found.groupBy("_group", _slot(F.col("term")).alias("slot")).agg(
        F.map_from_entries(F.collect_list(F.struct("term", "entry"))).alias("held")
    )
    by_group = listed.groupBy("_group").agg(F.collect_list("slot").alias("slots"), F.collect_list("held").alias("helds"))
    dense = F.expr(f"transform(sequence(0, {SLOTS - 1}), k -> get(helds, cast(array_position(slots, k) as int) - 1))")
    tables = by_group.select("_group", dense.alias("_tables"))
    return df.withColumn("_group", group).join(tables, "_group", "left").drop("_group")


def _held(word: Column) -> Column:
    """The entry of ``word`` in the table of its row's group; null for a word without one."""
    return F.try_element_at(F.get("_tables", _slot(word)), word)


# What a table gives for a text is computed with its join's output row, of which the table
# is no part any more: nothing copies it.


def word_values(df: DataFrame, words: Column, terms: DataFrame, out="_entries") -> DataFrame:
    """``df`` with ``out``: the entry of each of ``words`` that is a term of ``terms(term, entry)``, in order.

    Null for a text of which nothing is known: one without words or without a term in its group.
    """
    met = _with_tables(df, F.array(words), [1], terms)
    found = F.when(F.col("_tables").isNotNull(), F.filter(F.transform(words, _held), lambda e: e.isNotNull()))
    return met.select(*[F.col(f"`{c}`") for c in df.columns], found.alias(out))


def phrase_sizes(terms: DataFrame) -> list[int]:
    """The numbers of words ``n`` of ``terms``, largest first."""
    return sorted((r["n"] for r in terms.select("n").distinct().collect()), reverse=True) or [1]


def phrase_hits(df: DataFrame, sentences: Column, terms: DataFrame, sizes) -> DataFrame:
    """``df`` with ``_hits``: what its sentences hold of ``terms(term, n, value, factor)``, n being among ``sizes``.

    ``sentences`` is array<array<string>>; ``term`` is ``n`` words with a blank between. One row
    per term. ``_hits`` has an array<struct<pos, end, value, factor>> for each sentence,
    hits in order of position and longest first; null for a text that is null.
    """
    met = _with_tables(df, sentences, sizes, terms.select("term", F.struct("value", "factor").alias("entry")))

    def hit(words: Column, word: Column, pos: Column, n: int) -> Column:
        entry = _held(word) if n == 1 else F.when(pos + n <= F.size(words), _held(F.array_join(F.slice(words, pos + 1, n), " ")))
        fields = lambda e: F.struct(pos.alias("pos"), (pos + (n - 1)).alias("end"), e["value"].alias("value"), e["factor"].alias("factor"))
        return F.transform(F.filter(F.array(entry), lambda e: e.isNotNull()), fields)

    at = lambda words: F.flatten(F.transform(words, lambda w, p: F.concat(*[hit(words, w, p, n) for n in sizes])))
    # Without a table: sentences without hits.
    looked_up = F.transform(sentences, lambda words: F.when(F.col("_tables").isNotNull(), at(words)))
    none = F.expr("cast(array() as array<struct<pos:int,`end`:int,value:double,factor:double>>)")
    hits = F.transform(looked_up, lambda found: F.coalesce(found, none))
    return met.select(*[F.col(f"`{c}`") for c in df.columns], hits.alias("_hits"))


def replaced_words(df: DataFrame, sentences: Column, forms: DataFrame, out: str) -> DataFrame:
    """``df`` with ``out``: the words of ``sentences`` replaced as ``forms(word, lemma)`` says, one row per word."""
    met = _with_tables(df, sentences, [1], forms.select(F.col("word").alias("term"), F.struct("lemma").alias("entry")))
    changed = F.transform(sentences, lambda words: F.transform(words, lambda w: F.coalesce(_held(w)["lemma"], w)))
    return met.withColumn(out, changed).drop("_tables")
