"""Article scores by valence list, by dictionary with modifiers and by word list.

Each has two ways with the same results: a small dictionary is a constant of the plan, a
larger one is joined with the words of the texts. ``both_scores`` gives the first two in one
pass by small dictionaries.
"""

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickermood.functions.columns import polarity
from tickermood.functions.lookup import Lookup, fetch_lookup_rows, word_lookup
from tickermood.functions.text import blank_separated, sentence_words, word_array
from tickermood.operators.term_join import phrase_hits, phrase_sizes, replaced_words, word_values
from tickermood.operators.text import each, lemma_forms

_ENTRY = "struct<n:int,words:array<string>,value:double,factor:double>"

# Polarity of a term and the factor a modifier puts on the term after it.
_CLASS_VALUE = {"positive": 1.0, "negative": -1.0}
_CLASS_FACTOR = {"increment": 2.0, "decrement": 0.5, "revert": -1.0}


def _case(column, table) -> Column:
    expr = F.lit(None).cast("double")
    for key, value in table.items():
        expr = F.when(F.col(column) == key, value).otherwise(expr)
    return expr


def _entries(lexicon: DataFrame, value: Column, factor: Column) -> DataFrame:
    """Dictionary rows: first word, all words, their number, value and factor."""
    words = word_array("term")
    rows = lexicon.select(words.alias("words"), value.alias("value"), factor.alias("factor"))
    return rows.filter(F.size("words") > 0).select(
        F.col("words")[0].alias("word"), F.size("words").alias("n"), "words", "value", "factor"
    )


def class_entries(lexicon: DataFrame) -> DataFrame:
    """Entries of a ``term,class`` dictionary: either a value or a factor is set."""
    return _entries(lexicon, _case("class", _CLASS_VALUE), _case("class", _CLASS_FACTOR))


def valence_entries(lexicon: DataFrame) -> DataFrame:
    return _entries(lexicon, F.col("valence").cast("double"), F.lit(None).cast("double"))


def _phrases(entries: DataFrame) -> dict | None:
    """(first word, its hash) -> entries, longest first; None for a large dictionary.

    Of several entries with the same words the one of smallest value counts.
    """
    rows = fetch_lookup_rows(entries)
    if rows is None:
        return None
    grouped: dict = {}
    nulls_first = lambda v: (v is not None, v or 0.0)
    for r in sorted(rows, key=lambda r: (-r["n"], nulls_first(r["value"]), nulls_first(r["factor"]))):
        entry = {"n": r["n"], "words": r["words"], "value": r["value"], "factor": r["factor"]}
        grouped.setdefault((r["word"], r["word_hash"]), []).append(entry)
    return grouped


def _phrase_lookup(entries: DataFrame) -> tuple[Lookup, int] | None:
    """(lookup of first word -> entries, longest first; largest n), or None for a large dictionary."""
    grouped = _phrases(entries)
    if grouped is None:
        return None
    lookup = Lookup([(w, h, e) for (w, h), e in grouped.items()], f"array<{_ENTRY}>")
    return lookup, max((found[0]["n"] for found in grouped.values()), default=1)


def _terms(entries: DataFrame) -> DataFrame:
    """The entries as (term, n, value, factor), one row per term, the one of smallest value."""
    least = F.min(F.struct("value", "factor")).alias("least")
    rows = entries.groupBy(F.array_join("words", " ").alias("term"), "n").agg(least)
    return rows.select("term", "n", "least.value", "least.factor")


def _refuse_stream(df: DataFrame) -> None:
    if df.isStreaming:
        raise ValueError("a stream is scored by a large dictionary batch by batch: see streaming.news.write_scored")


# The expressions below are SQL text: one call to the JVM instead of hundreds, one
# for every function in them.


def _hits(words: str, lookup: Lookup, max_n: int) -> str:
    """SQL of the longest dictionary entry at each position of ``words``.

    array<struct<pos,end,value,factor>>; entries of a word are sorted by length.
    """
    found = lookup.get("w")
    if max_n > 1:
        found = f"filter({found}, e -> e.n = 1 or slice({words}, i + 1, e.n) = e.words)"
    hit = f"""transform(slice({found}, 1, 1), e -> named_struct(
        'pos', i, 'end', i + e.n - 1, 'value', e.value, 'factor', e.factor))"""
    listed = f"transform({words}, (w, i) -> {hit})"
    return f"flatten(filter({listed}, h -> h is not null))"


def _fold(hits: str, overlap=True) -> str:
    """SQL of the sum of one sentence's hits, in order of position and longest first.

    A hit that starts inside an earlier one is passed over. A value is multiplied
    by the factor of the hit directly before it, if that is a modifier, and then
    by the factor of the modifier before that. Without ``overlap`` every hit is one word.
    """
    if not overlap:
        return f"""aggregate({hits},
            named_struct('near', cast(null as double), 'far', cast(null as double), 'total', 0D),
            (s, h) -> named_struct('near', h.factor, 'far', s.near,
                'total', s.total + coalesce(if(s.near is null, h.value, h.value * (s.near * coalesce(s.far, 1D))), 0D)),
            s -> s.total)"""
    inside = "h.pos <= s.`end`"
    factor = "if(s.near is null, 1D, s.near * coalesce(s.far, 1D))"
    return f"""aggregate({hits},
        named_struct('end', -1, 'near', cast(null as double), 'far', cast(null as double), 'total', 0D),
        (s, h) -> named_struct(
            'end', greatest(s.`end`, h.`end`),
            'near', if({inside}, s.near, h.factor),
            'far', if({inside}, s.far, s.near),
            'total', s.total + if({inside}, 0D, coalesce(h.value * {factor}, 0D))),
        s -> s.total)"""


def _lemmatized(df: DataFrame, words: Column, lemmas: DataFrame, out: str) -> DataFrame:
    """``df`` with ``out``: the words of array<array<string>> replaced by their lemmas."""
    forms = lemma_forms(lemmas)
    lookup = word_lookup(forms, "lemma", "string")
    if lookup is None:
        _refuse_stream(df)
        return replaced_words(df, words, forms, out)
    return df.withColumn(out, F.transform(words, lambda s: F.transform(s, lambda w: F.coalesce(lookup.of(w), w))))


def valence_score(
    df: DataFrame, lexicon: DataFrame, text_col="article", out="afinn_sentiment", words=None
) -> DataFrame:
    """Sum of the valences of a text's matching words and phrases; 0 without any.

    ``words`` gives the words of the text where they are at hand already.
    """
    entries = valence_entries(lexicon)
    small = _phrase_lookup(entries)
    words = word_array(text_col) if words is None else words
    if small is None:
        _refuse_stream(df)
        terms = _terms(entries)
        sizes = phrase_sizes(terms)
        if sizes == [1]:
            found = word_values(df, words, terms.select("term", F.struct("value").alias("entry")), "_hits")
            total = F.expr("aggregate(_hits, 0D, (total, h) -> total + h.value)")
        else:
            found = phrase_hits(df, F.array(words), terms, sizes)
            total = F.expr(_fold("_hits[0]"))
        return found.withColumn(out, F.coalesce(total, F.lit(0.0))).drop("_hits")
    lookup, max_n = small
    with_words = df.withColumn("_words", words)
    if max_n == 1:
        known = f"filter(transform(_words, w -> {lookup.get('w')}), e -> e is not null)"
        total = F.expr(f"aggregate({known}, 0D, (total, e) -> total + e[0].value)")
    else:
        total = F.expr(_fold(_hits("_words", lookup, max_n)))
    return with_words.withColumn(out, F.coalesce(total, F.lit(0.0))).drop("_words")


def _label(total: Column) -> Column:
    return F.when(total > 0, "positive").when(total < 0, "negative").otherwise("neutral")


def dictionary_sentiment(
    df: DataFrame, lexicon: DataFrame, text_col="article", lemmas=None, granularity="document", sentences=None
) -> DataFrame:
    """Adds ``sentiment_score`` and the label array ``sentiment``.

    Every sentence is scored by the class dictionary. ``granularity`` says whether
    the labels are that of the whole text or the distinct ones of its sentences.
    ``sentences`` gives the words of each sentence where they are at hand already.
    """
    if granularity not in ("document", "sentence"):
        raise ValueError(f"unknown granularity {granularity!r}: use 'document' or 'sentence'")
    words = sentence_words(text_col) if sentences is None else sentences
    with_words = df.withColumn("_words", words) if lemmas is None else _lemmatized(df, words, lemmas, "_words")
    entries = class_entries(lexicon)
    small = _phrase_lookup(entries)
    if small is None:
        _refuse_stream(df)
        rows, cut = (df, words) if lemmas is None else (with_words, F.col("_words"))
        terms = _terms(entries)
        sizes = phrase_sizes(terms)
        fold = _fold("hits", overlap=sizes != [1])
        scored = phrase_hits(rows, cut, terms, sizes).withColumn("_totals", F.expr(f"transform(_hits, hits -> {fold})"))
    else:
        fold = _fold(_hits("words", *small))
        scored = with_words.withColumn("_totals", F.expr(f"transform(_words, words -> {fold})"))
    total = F.aggregate("_totals", F.lit(0.0), lambda a, b: a + b)
    scored = scored.withColumn("sentiment_score", F.coalesce(total, F.lit(0.0)))
    if granularity == "document":
        labels = F.array(_label(F.col("sentiment_score")))
    else:
        labels = F.coalesce(F.sort_array(F.array_distinct(F.transform("_totals", _label))), F.expr("cast(array() as array<string>)"))
    return scored.select(*df.columns, "sentiment_score", labels.alias("sentiment"))


def both_scores(df: DataFrame, valences: DataFrame, classes: DataFrame, text_col="article") -> DataFrame | None:
    """``valence_score`` and ``dictionary_sentiment`` of whole texts in one pass; None for a large dictionary.

    The columns are those of the two, one after the other. Texts go to Python in Arrow
    batches and come back as two numbers: a loop over the words there costs a fraction of
    the same steps in nested expressions.
    """
    small = [_phrases(entries) for entries in (valence_entries(valences), class_entries(classes))]
    if None in small:
        return None
    fields = lambda e: (e["n"], [w.encode() for w in e["words"]], e["value"], e["factor"])
    terms = [{word.encode(): [fields(e) for e in found] for (word, _), found in grouped.items()} for grouped in small]
    totals = F.arrow_udf(_text_totals(*terms), "struct<valence:double,score:double>")
    scored = df.withColumn("_totals", totals(F.col(text_col)))
    scored = scored.withColumns({"afinn_sentiment": F.col("_totals.valence"), "sentiment_score": F.col("_totals.score")})
    return scored.withColumn("sentiment", F.array(_label(F.col("sentiment_score")))).drop("_totals")


def _text_totals(valences: dict, classes: dict):
    """The function of an Arrow batch of texts: their totals by terms that are bytes.

    Works on UTF-8, of which every byte outside ASCII parts words. Two letters outside
    ASCII hold one of a to z in lower case.
    """
    kinds = bytearray(b"\t" * 256)
    for letter in range(26):
        kinds[65 + letter] = kinds[97 + letter] = 97 + letter
    for mark, signs in ((b".", b".!?"), (b" ", b" \t\n\f\r")):
        for sign in signs:
            kinds[sign] = mark[0]

    def sentences(text: bytes) -> list[list[bytes]]:
        if not text.isascii():
            text = text.replace("\u0130".encode(), b"i\0").replace("\u212a".encode(), b"k")
        # A sentence ends where white space follows its sign; other signs part words.
        ended = text.translate(kinds).replace(b". ", b"\n").replace(b".", b" ")
        return [sentence.split() for sentence in ended.split(b"\n")]

    def total(words: list[bytes], places: list[int], terms: dict) -> float:
        """As ``_fold`` has it, ``places`` being those of the words that begin a term."""
        end, near, far, found = -1, None, None, 0.0
        for i in places:
            for n, term, value, factor in terms.get(words[i], ()):
                if n == 1 or words[i:i + n] == term:
                    if i > end:
                        if value is not None:
                            found += value if near is None else value * (near * (1.0 if far is None else far))
                        near, far = factor, near
                    end = max(end, i + n - 1)
                    break
        return found

    known = {*valences, *classes}

    def totals(text: bytes) -> tuple[float, float]:
        """By valences over the whole text, by classes sentence by sentence."""
        words, places, score = [], [], 0.0
        for sentence in sentences(text):
            if not known.isdisjoint(sentence):
                here = [i for i, word in enumerate(sentence) if word in known]
                score += total(sentence, here, classes)
                places += [len(words) + i for i in here]
            words += sentence
        return total(words, places, valences), score

    def batch(texts: pa.Array) -> pa.Array:
        found = [totals(text.as_py() or b"") for text in texts.cast(pa.large_binary())]
        columns = [pa.array([pair[k] for pair in found], pa.float64()) for k in (0, 1)]
        return pa.StructArray.from_arrays(columns, ["valence", "score"])

    return batch


def dictionary_hits(
    df: DataFrame, lexicon: DataFrame, text_col="article", id_col="doc_id"
) -> DataFrame:
    """(id, sent_id, pos, n, term) of the entries that count towards the score.

    At a position the longest entry counts, unless it starts inside an earlier one.
    """
    terms = lexicon.select(F.array_join(word_array("term"), " ").alias("term")).distinct()
    entries = _entries(terms, F.lit(0.0), F.lit(0.0)).select("word", "n", "words", "value", "factor")
    by_sentence = each(df, [id_col], sentence_words(text_col), "sent_id", "_s")
    small = _phrase_lookup(entries)
    if small is None:
        _refuse_stream(df)
        terms = _terms(entries)
        found = phrase_hits(by_sentence, F.array("_s"), terms, phrase_sizes(terms))
        rows = found.withColumn("_hits", F.col("_hits")[0])
    else:
        rows = by_sentence.withColumn("_hits", F.expr(_hits("_s", *small)))
    # A running maximum of the ends tells the hits that start inside an earlier one.
    state = F.struct(F.lit(-1).alias("end"), F.expr("cast(array() as array<struct<pos:int,n:int>>)").alias("kept"))

    def step(acc, h):
        one = F.struct(h["pos"].alias("pos"), (h["end"] - h["pos"] + 1).alias("n"))
        kept = F.when(h["pos"] <= acc["end"], acc["kept"]).otherwise(F.concat(acc["kept"], F.array(one)))
        return F.struct(F.greatest(acc["end"], h["end"]).alias("end"), kept.alias("kept"))

    kept = F.aggregate("_hits", state, step, lambda acc: acc["kept"])
    named = F.transform(
        "_kept",
        lambda k: F.struct(k["pos"], k["n"], F.array_join(F.slice("_s", k["pos"] + 1, k["n"]), " ").alias("term")),
    )
    hits = rows.withColumn("_kept", kept).select(id_col, "sent_id", F.inline_outer(named))
    return hits.filter(F.col("pos").isNotNull())


def pnn_score(df: DataFrame, sentiment="sentiment", out="pnn_sentiment") -> DataFrame:
    """1 with any positive label, else -1 with any negative one, else 0."""
    labels = F.col(sentiment)
    score = (
        F.when(F.array_contains(labels, "positive"), 1)
        .when(F.array_contains(labels, "negative"), -1)
        .otherwise(0)
    )
    return df.withColumn(out, score)


def wordlist_polarity(df: DataFrame, words: DataFrame, text_col="article", out="sentiment_score") -> DataFrame:
    """(p - n) / max(p + n, 1) over the listed words, compared in lower case."""
    listed = words.select(F.lower("term").alias("word"), "class")
    rows = fetch_lookup_rows(listed)
    if rows is None:
        _refuse_stream(df)
        return _joined_polarity(df, listed, text_col, out)
    classes: dict = {}
    for r in rows:
        classes.setdefault((r["word"], r["word_hash"]), set()).add(r["class"])
    marked = [(w, h, {c: c in held for c in ("positive", "negative")}) for (w, h), held in classes.items()]
    lookup = Lookup(marked, "struct<positive:boolean,negative:boolean>")
    marks = df.withColumn("_words", blank_separated(text_col)).withColumn(
        "_marks", F.expr(f"filter(transform(_words, w -> {lookup.get('w')}), m -> m is not null)")
    )
    count = lambda field: F.expr(f"size(filter(_marks, m -> m.{field}))")
    score = polarity(count("positive"), count("negative"))
    scored = marks.withColumn(out, F.when(F.col("_marks").isNotNull(), score).otherwise(0.0))
    return scored.drop("_words", "_marks")


def _joined_polarity(df: DataFrame, listed: DataFrame, text_col: str, out: str) -> DataFrame:
    """The polarity by a large list; a hit's value marks a positive word, its factor a negative one."""
    held = lambda name: F.max((F.col("class") == name).cast("double"))
    marks = F.struct(held("positive").alias("value"), held("negative").alias("factor")).alias("entry")
    terms = listed.groupBy(F.col("word").alias("term")).agg(marks).where("term is not null")
    found = word_values(df, blank_separated(text_col), terms, "_marks")
    count = lambda field: F.expr(f"size(filter(coalesce(_marks, array()), m -> m.{field} = 1D))")
    return found.withColumn(out, polarity(count("value"), count("factor"))).drop("_marks")


def daily_sentiment(df: DataFrame, agg="avg", by=("symbol", "date")) -> DataFrame:
    """Mean (or sum) of both scores per symbol and day.

    Each task first sums what it read, so a symbol with very many articles sends
    no more rows through the shuffle than any other.
    """
    fn = {"avg": F.avg, "sum": F.sum}[agg]
    suffix = "mean" if agg == "avg" else "sum"
    return df.groupBy(*by).agg(
        fn("afinn_sentiment").alias(f"afinn_sentiment_{suffix}"),
        fn("pnn_sentiment").alias("pnn_sentiment"),
    )
