"""Quality rules with verdicts by host (operator 1, DataFrame functions only).

Every document is measured against four rules. Failures are counted by host, and the rate
of each rule is shrunk with a beta prior fitted to all hosts by moments, so that a host of
few documents is not judged by chance. The shrunk rates are held against the fitted prior:

* a host of which a rate lies more than ``SUSPECT`` prior deviations above the prior's mean
  is suspect: its documents have to pass all four rules;
* one of which a rate is at least ``LEAST_RATE``, and more than ``CONDEMNED`` deviations above
  that mean, is condemned with all its documents;
* the documents of any other host are trusted: symbols and repeated lines alone do not
  reject them.

The host of a document is its ``source``. Cases: documents without a host are judged by all
four rules themselves. A null text has no words. Repeated rows count as often as they come.
A very long text is measured whole, in its row. An empty table gives an empty table. Words
are runs of characters other than space and U+0009 to U+000D; equal windows are found by
a 64-bit hash of their three words.
"""

from pyspark.sql import Column, DataFrame, functions as F

from tickermood.llm.common import SPACES, saved, strip_spaces

MIN_WORDS = 50
SUSPECT, CONDEMNED = 2.0, 1.0
LEAST_RATE = 0.5
SYMBOLS = "#*$%&|<>"
RULES = ["few_words", "repeated_words", "symbols", "repeated_lines"]

# The 3-word windows of a text as (hash, place), those that occur twice or more, and
# how many words their union covers: a window adds the words its predecessor left.
_WINDOWS = """
if(size(words) < 3, array(), sort_array(transform(
  sequence(0, size(words) - 3),
  i -> named_struct('h', xxhash64(words[i], words[i + 1], words[i + 2]), 'i', i))))
"""
_REPEATED = """
sort_array(transform(
  filter(windows, (w, k) -> w.h = get(windows, k - 1).h or w.h = get(windows, k + 1).h),
  w -> w.i))
"""
_COVERED = """
aggregate(places, named_struct('last', -3, 'n', 0L),
  (a, i) -> named_struct('last', i, 'n', a.n + least(3, i - a.last)), a -> a.n)
"""


def words_of(text: Column) -> Column:
    body = strip_spaces(F.coalesce(text, F.lit("")))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, "[ \\t-\\r]+"))


def measured(docs: DataFrame, *keep) -> DataFrame:
    """One row per document: the kept columns and the measures of its whole text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n", -1), lambda line: F.length(strip_spaces(line)) > 0)
    return (
        docs.select(*keep, text.alias("body"), words_of(F.col("text")).alias("words"), lines.alias("lines"))
        .select(
            *keep,
            F.size("words").cast("long").alias("n_words"),
            F.length(F.translate("body", SPACES, "")).cast("long").alias("word_chars"),
            (F.length("body") - F.length(F.translate("body", SYMBOLS, ""))).cast("long").alias("n_symbols"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
            F.size("lines").cast("long").alias("n_text_lines"),
            F.expr(_WINDOWS).alias("windows"),
        )
        .withColumn("places", F.expr(_REPEATED))
        .withColumn("n_repeat_words", F.expr(_COVERED))
        .drop("windows", "places")
    )


def rule_failures() -> dict[str, Column]:
    return {
        "few_words": F.col("n_words") < MIN_WORDS,
        "repeated_words": 100 * F.col("n_repeat_words") > 50 * F.col("n_words"),
        "symbols": 10 * F.col("n_symbols") > F.col("word_chars"),
        "repeated_lines": 10 * F.col("n_dup_lines") > 3 * F.col("n_text_lines"),
    }


def host_verdicts(measures: DataFrame, host="source") -> DataFrame:
    """``(host, n_docs, <rule>_rate..., suspect, condemned)`` for each host that is not null."""
    failures = rule_failures()
    hosts = (
        measures.where(F.col(host).isNotNull())
        .groupBy(F.col(host).alias("host"))
        .agg(F.count(F.lit(1)).alias("n_docs"), *[F.count_if(failures[r]).alias(r) for r in RULES])
    )
    # Moments of the rates over hosts, weighted by documents.
    moments = hosts.agg(
        F.sum("n_docs").alias("n"), F.count(F.lit(1)).alias("k"),
        *[F.sum(r).alias(r) for r in RULES],
        *[F.sum(F.col(r) * F.col(r) / F.col("n_docs")).alias(f"{r}_sq") for r in RULES],
    )
    prior = []
    for r in RULES:
        mean = F.col(r) / F.col("n")
        between = F.col(f"{r}_sq") / F.col("n") - mean * mean
        noise = mean * (1 - mean) * F.col("k") / F.col("n")
        strength = F.try_divide(mean * (1 - mean), F.greatest(between - noise, F.lit(1e-9))) - 1
        strength = F.least(F.greatest(strength, F.lit(2.0)), F.lit(1e6))
        deviation = F.sqrt(mean * (1 - mean) / (strength + 1))
        prior += [mean.alias(f"{r}_m"), strength.alias(f"{r}_s"), deviation.alias(f"{r}_d")]
    fitted = moments.select(F.struct(*prior).alias("prior")).scalar()
    rates = hosts.withColumn("prior", fitted)
    suspect = condemned = F.lit(False)
    shrunk = {}
    for r in RULES:
        mean, strength, deviation = (F.col(f"prior.{r}_{part}") for part in "msd")
        rate = shrunk[r] = (F.col(r) + mean * strength) / (F.col("n_docs") + strength)
        suspect |= rate > mean + SUSPECT * deviation
        condemned |= (rate > mean + CONDEMNED * deviation) & (rate >= LEAST_RATE)
    return rates.select(
        "host", "n_docs", *[shrunk[r].alias(f"{r}_rate") for r in RULES], suspect.alias("suspect"), condemned.alias("condemned")
    )


def quality_verdicts(docs: DataFrame, host="source") -> DataFrame:
    """Measures, ``base_failed``, the host's ``suspect`` and ``condemned``, and ``kept`` for every row of ``docs``.

    The measures are written once; the join with the hosts moves these narrow rows
    and no text, and a hot host is split by adaptive execution.
    """
    measures = saved(measured(docs, "doc_id", host), "quality")
    verdicts = host_verdicts(measures, host).select(F.col("host").alias("known"), "suspect", "condemned")
    failures = rule_failures()
    failed = failures["few_words"] | failures["repeated_words"]
    other = failures["symbols"] | failures["repeated_lines"]
    judged = measures.join(verdicts, measures[host] == verdicts["known"], "left")
    untrusted = F.col("known").isNull() | F.col("suspect")
    rejected = failed | F.coalesce("condemned", F.lit(False)) | (untrusted & other)
    return judged.select(
        "doc_id", host, "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), "suspect", "condemned", (~rejected).alias("kept"),
    )
