"""How the word use of the sources of a language differs (operator 13).

Each language keeps the terms found in enough of its documents. A group (language and
source) gives every kept term a smoothed share ``p`` in parts of a billion, terms it never
uses included: these all have the group's zero baseline ``b``. The distance of two groups
is the sum of ``|p - q|`` over all kept terms, and most of these are baselines.

Row accumulation after Gustavson: the shares lie in a term-major index, cut into chunks of
terms. A task holds one chunk; for each group it walks the group's terms, scatters what each
adds into one dense accumulator with a place for every peer, and gives out the accumulator.
No pair of postings ever becomes a row. Only the terms both groups use are met in the
index; all others are made good by baselines: with ``d = |b_g - b_h|``

    distance(g, h) = V d + own(g, h) + own(h, g) + both(g, h)
    own(g, h)  = sum over the terms of g of |p_g - b_h| - d
    both(g, h) = sum over the terms of both of |p_g - p_h| - |p_g - b_h| - |b_g - p_h| + d

All arithmetic is on whole numbers.

Cases: null text, lang and source are ''. A null or empty text adds no term; a group
without any still has its row for every peer. In a language without kept terms all
distances are 0. Repeated rows are documents like any other. Equal values are ordered by
item. Very long texts are cut into words like others. An empty table gives an empty table;
other columns are not read.
"""

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tickermood.llm.common import saved

MIN_DOCS = 30
SMOOTHING = 5
WHOLE = 1_000_000_000
TOP_TERMS = 50
# A task's words are given out when so many different ones are held.
HELD_WORDS = 400_000
CHUNK_POSTINGS = 500_000

# Letters of ASCII in lower case and all bytes of other characters stay; the rest parts terms.
_TERM_BYTES = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(text: bytes) -> list[bytes]:
    return text.translate(_TERM_BYTES).split()


def _blank(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def term_counts(docs: DataFrame) -> DataFrame:
    """``(lang, source, term, n, n_docs)``: occurrences and documents of each term in each group."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[tuple, tuple[Counter, Counter]] = {}

        def out():
            for (lang, source), (n, n_docs) in counts.items():
                terms = list(n)
                for at in range(0, len(terms), 50_000):
                    some = terms[at : at + 50_000]
                    yield pa.record_batch({
                        "lang": pa.array([lang] * len(some), pa.string()),
                        "source": pa.array([source] * len(some), pa.string()),
                        "term": pa.array(some, pa.binary()).cast(pa.string()),
                        "n": pa.array([n[t] for t in some], pa.int64()),
                        "n_docs": pa.array([n_docs[t] for t in some], pa.int64()),
                    })
            counts.clear()

        for batch in batches:
            for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                words = terms_of(text)
                if words:
                    n, n_docs = counts.setdefault((lang, source), (Counter(), Counter()))
                    n.update(words)
                    n_docs.update(set(words))
            if sum(len(n) for n, _ in counts.values()) > HELD_WORDS:
                yield from out()
        yield from out()

    rows = docs.select(_blank("lang").alias("lang"), _blank("source").alias("source"),
                       _blank("text").cast("binary").alias("text"))
    parts = rows.mapInArrow(count, "lang string, source string, term string, n long, n_docs long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("n_docs").alias("n_docs"))


def share(n: Column, total: Column, v: Column) -> Column:
    """1 + floor(10^9 (n + 5) / (total + 5 V)), in decimals, which hold any count."""
    whole = lambda c: c.cast("decimal(19,0)")
    above = whole(n + SMOOTHING) * F.lit(WHOLE).cast("decimal(10,0)")
    below = whole(total) + whole(v) * F.lit(SMOOTHING).cast("decimal(1,0)")
    return (F.lit(1) + F.call_function("div", above, below)).cast("long")


def kept_counts(counts: DataFrame, min_docs: int) -> DataFrame:
    """The counts of the terms that are in enough documents of their language."""
    kept = counts.groupBy("lang", "term").agg(F.sum("n_docs").alias("in_docs")).where(F.col("in_docs") >= min_docs)
    kept = kept.select(F.col("lang").alias("of_lang"), F.col("term").alias("of_term"))
    met = counts.join(kept, (F.col("lang") == F.col("of_lang")) & (F.col("term") == F.col("of_term")))
    return met.select("lang", "source", "term", "n")


def groups_of(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """``(lang, source, place, v, total, baseline)``: every group, numbered within its language, with what smoothing asks."""
    groups = docs.select(_blank("lang").alias("lang"), _blank("source").alias("source")).distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sizes = kept.select("lang", "term").distinct().groupBy("lang").agg(F.count(F.lit(1)).alias("v"))
    by_source = Window.partitionBy("lang").orderBy("source")
    met = groups.join(totals, ["lang", "source"], "left").join(sizes, "lang", "left")
    met = met.na.fill(0, ["total", "v"]).withColumn("place", F.row_number().over(by_source) - 1)
    nothing = F.lit(0).cast("long")
    return met.withColumn("baseline", F.when(F.col("v") > 0, share(nothing, F.col("total"), F.col("v"))))


def accumulate(baselines: np.ndarray, places: np.ndarray, terms: np.ndarray, shares: np.ndarray) -> Iterator[tuple]:
    """(group, mine, other) for each group: what a chunk's terms add to the distances from it and to it.

    The postings are the triples ``(places, terms, shares)``. ``mine[h]`` holds ``own(g, h) + both(g, h)``,
    ``other[h]`` holds ``own(g, h)``, which belongs to the distance from h to g.
    """
    by_term = np.argsort(terms, kind="stable")
    index_places, index_shares = places[by_term], shares[by_term]
    _, term_at, term_size = np.unique(terms[by_term], return_index=True, return_counts=True)
    numbered = np.unique(terms, return_inverse=True)[1]
    by_group = np.argsort(places, kind="stable")
    groups, group_at = np.unique(places[by_group], return_index=True)
    for g, rows in zip(groups.tolist(), np.split(by_group, group_at[1:])):
        b, p = int(baselines[g]), np.sort(shares[rows])
        apart = np.abs(b - baselines)
        # Sum of |p - b_h| over the group's terms: those below b_h and those above it.
        sums = np.concatenate([[0], np.cumsum(p)])
        below = np.searchsorted(p, baselines)
        own = baselines * (2 * below - len(p)) + sums[-1] - 2 * sums[below] - len(p) * apart
        both = np.zeros(len(baselines), np.int64)
        size = term_size[numbered[rows]]
        for some in np.split(np.arange(len(rows)), np.flatnonzero(np.diff(np.cumsum(size) // 1_000_000)) + 1):
            at, n = term_at[numbered[rows[some]]], size[some]
            postings = np.repeat(at - np.cumsum(n) + n, n) + np.arange(n.sum())
            peer, q = index_places[postings], index_shares[postings]
            mine = np.repeat(shares[rows[some]], n)
            np.add.at(both, peer, np.abs(mine - q) - np.abs(mine - baselines[peer]) - np.abs(b - q) + apart[peer])
        yield g, own + both, own


def pair_distances(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """``(lang, source, item, value)`` for every two sources of a language, both ways."""
    n = shares.count()
    chunks = max(1, n // CHUNK_POSTINGS)
    chunk = F.pmod(F.xxhash64("term"), F.lit(chunks)).cast("int").alias("chunk")
    some = groups.where("v > 0")
    postings = shares.select("lang", chunk, F.lit(1).alias("kind"), "place", "term", "p")
    # Each chunk begins with the baselines of all groups of the language.
    heads = some.select(
        "lang", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1))).alias("chunk"), F.lit(0).alias("kind"), "place",
        F.lit("").alias("term"), F.col("baseline").alias("p"),
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, kinds, places, terms, p in _chunks(batches):
            head = kinds == 0
            baselines = p[head][np.argsort(places[head])]
            for g, mine, other in accumulate(baselines, places[~head], terms[~head], p[~head]):
                yield pa.record_batch({
                    "lang": pa.array([lang]), "g": pa.array([g], pa.int32()),
                    "mine": pa.array([mine.tolist()], pa.list_(pa.int64())),
                    "other": pa.array([other.tolist()], pa.list_(pa.int64())),
                })

    rows = heads.unionByName(postings).repartition("lang", "chunk").sortWithinPartitions("lang", "chunk", "kind")
    found = rows.mapInArrow(run, "lang string, g int, mine array<long>, other array<long>")
    parts = found.select("lang", F.col("g").alias("a"), F.posexplode("mine").alias("b", "part")).unionByName(
        found.select("lang", F.col("g").alias("b"), F.posexplode("other").alias("a", "part"))
    )
    added = parts.groupBy("lang", "a", "b").agg(F.sum("part").alias("part"))
    one = groups.select(F.col("lang").alias("l"), "source", F.col("place").alias("a_place"), "v", F.col("baseline").alias("b_a"))
    peers = groups.select(F.col("lang").alias("m"), F.col("source").alias("item"), F.col("place").alias("b_place"),
                          F.col("baseline").alias("b_b"))
    pairs = one.join(peers, (F.col("l") == F.col("m")) & (F.col("a_place") != F.col("b_place")))
    met = pairs.join(
        added, (F.col("l") == F.col("lang")) & (F.col("a_place") == F.col("a")) & (F.col("b_place") == F.col("b")), "left"
    )
    value = F.col("v") * F.abs(F.col("b_a") - F.col("b_b")) + F.coalesce("part", F.lit(0))
    return met.select(F.col("l").alias("lang"), "source", "item", F.coalesce(value, F.lit(0)).cast("long").alias("value"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(lang, kinds, places, terms, p) of each chunk, whose rows come one after the other; terms as numbers."""

    def closed(lang: str, held: list[pa.RecordBatch]) -> tuple:
        table = pa.Table.from_batches(held).combine_chunks()
        terms = table["term"].combine_chunks().dictionary_encode().indices
        return lang, table["kind"].to_numpy(), table["place"].to_numpy(), terms.to_numpy(), table["p"].to_numpy()

    now, held = None, []
    for batch in batches:
        keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
        start = 0
        while start < len(keys):
            end = start + 1
            while end < len(keys) and keys[end] == keys[start]:
                end += 1
            if keys[start] != now and held:
                yield closed(now[0], held)
                held = []
            now = keys[start]
            held.append(batch.slice(start, end - start))
            start = end
    if held:
        yield closed(now[0], held)


def divergence(docs: DataFrame, min_docs=MIN_DOCS, top=TOP_TERMS) -> DataFrame:
    """``(lang, source, part, item, value, rank)``: distances to the other sources, and the terms used above the language's share."""
    counts = saved(term_counts(docs), "term-counts")
    kept = saved(kept_counts(counts, min_docs), "kept-terms")
    groups = saved(groups_of(docs, kept), "term-groups")
    sized = groups.select(F.col("lang").alias("l"), F.col("source").alias("s"), "place", "v", "total")
    met = kept.join(sized, (F.col("lang") == F.col("l")) & (F.col("source") == F.col("s")))
    shares = saved(
        met.select("lang", "source", "place", "term", share(F.col("n"), F.col("total"), F.col("v")).alias("p")), "term-shares"
    )
    whole = kept.groupBy("lang", "term").agg(F.sum("n").alias("n"))
    langs = groups.groupBy("lang").agg(F.sum("total").alias("total"), F.first("v").alias("v"))
    whole = whole.join(langs.withColumnRenamed("lang", "l"), F.col("lang") == F.col("l")).select(
        F.col("lang").alias("l"), F.col("term").alias("t"), share(F.col("n"), F.col("total"), F.col("v")).alias("q")
    )
    above = shares.join(whole, (F.col("lang") == F.col("l")) & (F.col("term") == F.col("t"))).where("p > q")
    terms = above.select("lang", "source", F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    ranked = lambda rows, part: rows.withColumn("rank", F.row_number().over(order)).select(
        "lang", "source", F.lit(part).alias("part"), "item", "value", "rank"
    )
    pairs = ranked(pair_distances(groups, shares), "pair")
    return pairs.unionByName(ranked(terms, "term").where(F.col("rank") <= top))
