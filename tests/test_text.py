import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from tickermood.functions import lookup
from tickermood.functions.text import word_array
from tickermood.operators import sentiment, term_join, text
from tickermood.plans.catalog import QUERIES
from tickermood.schemas import CLASS_LEXICON, LEMMAS, VALENCE_LEXICON
from tickermood.sources.dictionaries import NEGATIVE_WORDS, POSITIVE_WORDS, default_lexicon, default_wordlist
from tickermood.sources.local import small_frame

SCHEMA = "doc_id long, article string"

# Scores must not depend on the size of the dictionary.
BOTH_SIZES = pytest.mark.parametrize("filler", [0, 10_000, 25_000])


def padded(spark, lexicon, filler):
    """The dictionary with as many terms more that occur in no text."""
    first, second = lexicon.columns
    rest = spark.range(filler).select(
        F.concat(F.lit("zq"), F.translate(F.col("id").cast("string"), "0123456789", "abcdefghij")).alias(first),
        F.lit("1" if second == "valence" else "positive").cast(lexicon.schema[second].dataType).alias(second),
    )
    return lexicon.unionByName(rest)


def docs(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), SCHEMA)


def column(df, name):
    return [r[name] for r in rows(df, "doc_id")]


def test_sentences_and_tokens(spark):
    df = docs(spark, "One two. Three!  Four?\nfive ", "", None, "no end")
    found = rows(text.sentences(df), "doc_id", "sent_id")
    assert [(r["doc_id"], r["sent_id"], r["sentence"]) for r in found] == [
        (0, 0, "One two."), (0, 1, "Three!"), (0, 2, "Four?"), (0, 3, "five "), (3, 0, "no end"),
    ]
    found = rows(text.tokens(df), "doc_id", "sent_id", "pos")
    assert [(r["doc_id"], r["sent_id"], r["pos"], r["token"]) for r in found] == [
        (0, 0, 0, "one"), (0, 0, 1, "two"), (0, 1, 0, "three"), (0, 2, 0, "four"), (0, 3, 0, "five"),
        (3, 0, 0, "no"), (3, 0, 1, "end"),
    ]


def test_lemmatize_keeps_unknown_forms(spark):
    lemmas = small_frame(spark, [("went", "go")], LEMMAS)
    found = rows(text.lemmatize(text.tokens(docs(spark, "they went")), lemmas), "pos")
    assert [r["token"] for r in found] == ["they", "go"]


def test_ngrams_stay_within_a_sentence(spark):
    found = rows(text.ngrams(docs(spark, "a b. c"), max_n=2), "sent_id", "pos", "n")
    assert [(r["sent_id"], r["pos"], r["n"], r["gram"]) for r in found] == [
        (0, 0, 1, "a"), (0, 0, 2, "a b"), (0, 1, 1, "b"), (1, 0, 1, "c"),
    ]


def test_explode_sentences_pads_the_shorter_array(spark):
    df = spark.createDataFrame([(1, ["a", "b"], [[1.0]])], "doc_id int, sentences array<string>, embeddings array<array<float>>")
    found = rows(text.explode_sentences(df), "sent_id")
    assert [(r["sentence"], r["embedding"]) for r in found] == [("a", [1.0]), ("b", None)]


@BOTH_SIZES
def test_dictionary_scores(spark, filler):
    cases = {
        "not good": -1.0,
        "very good": 2.0,
        "not very good": -2.0,
        "very not very good": -2.0,  # only the two hits before the word count
        "good very": 1.0,
        "very": 0.0,
        "lack of good": -1.0,
        "I recommend others to avoid it": -1.0,
        "very. good": 1.0,  # modifiers do not reach over a sentence end
        "barely good": 0.5,
        "very good bad": 1.0,
        "GOOD, nice": 2.0,
        "": 0.0,
    }
    df = docs(spark, *cases, None)
    scored = sentiment.dictionary_sentiment(df, padded(spark, default_lexicon(spark), filler))
    assert column(scored, "sentiment_score") == [*cases.values(), 0.0]
    label = lambda v: "positive" if v > 0 else "negative" if v < 0 else "neutral"
    assert column(scored, "sentiment") == [[label(v)] for v in [*cases.values(), 0.0]]
    assert column(sentiment.pnn_score(scored), "pnn_sentiment") == [(v > 0) - (v < 0) for v in [*cases.values(), 0.0]]


@BOTH_SIZES
def test_sentence_labels_and_lemmas(spark, filler):
    df = docs(spark, "Good. Bad. Table.", "goods", None)
    lemmas = padded(spark, small_frame(spark, [("goods", "good")], LEMMAS), filler)
    scored = sentiment.dictionary_sentiment(
        df, padded(spark, default_lexicon(spark), filler), lemmas=lemmas, granularity="sentence"
    )
    assert column(scored, "sentiment") == [["negative", "neutral", "positive"], ["positive"], []]
    assert column(sentiment.pnn_score(scored), "pnn_sentiment") == [1, 1, 0]


def _brute_force(article, lexicon):
    """The rule of the dictionary score, word by word."""
    import re

    value = {"positive": 1.0, "negative": -1.0}
    factor = {"increment": 2.0, "decrement": 0.5, "revert": -1.0}
    total = 0.0
    for sentence in re.split(r"(?<=[.!?])[ \t\n\f\r]+", article):
        words = re.findall("[a-z]+", sentence.lower())
        candidates = []
        for i in range(len(words)):
            for n in (4, 3, 2, 1):
                term = " ".join(words[i : i + n])
                if i + n <= len(words) and term in lexicon:
                    candidates.append((i, i + n - 1, lexicon[term]))
                    break
        kept = [c for j, c in enumerate(candidates) if not any(e >= c[0] for _, e, _ in candidates[:j])]
        for j, (_, _, kind) in enumerate(kept):
            if kind in value:
                before = [factor.get(k) for _, _, k in kept[:j]][-2:]
                near = before[-1] if before else None
                far = before[-2] if len(before) > 1 else None
                total += value[kind] * (near if near is not None else 1) * (far if near is not None and far is not None else 1)
    return total


@BOTH_SIZES
def test_dictionary_scores_of_random_texts(spark, filler):
    lexicon = {
        "a": "positive", "b": "negative", "c": "revert", "d": "increment", "e": "decrement",
        "a b": "negative", "b c d": "positive", "c d": "increment", "d e a b": "negative", "f": "positive",
    }
    draw = random.Random(7)
    texts = [
        "".join(draw.choice("abcdefgh") + draw.choice([" ", " ", " ", ". ", ", "]) for _ in range(draw.randint(0, 40)))
        for _ in range(200)
    ]
    entries = padded(spark, small_frame(spark, lexicon.items(), CLASS_LEXICON), filler)
    scored = sentiment.dictionary_sentiment(docs(spark, *texts), entries)
    assert column(scored, "sentiment_score") == [_brute_force(t, lexicon) for t in texts]


@BOTH_SIZES
def test_hits(spark, filler):
    lexicon = padded(spark, small_frame(spark, [(t, "positive") for t in ("a", "a b", "b c", "c")], CLASS_LEXICON), filler)
    df = docs(spark, "a b c. a c", "b c a b")
    found = rows(sentiment.dictionary_hits(df, lexicon), "doc_id", "sent_id", "pos")
    # "b c" starts inside "a b" and goes; so does "c", which starts inside "b c".
    assert [(r["doc_id"], r["sent_id"], r["pos"], r["term"]) for r in found] == [
        (0, 0, 0, "a b"), (0, 1, 0, "a"), (0, 1, 1, "c"), (1, 0, 0, "b c"), (1, 0, 2, "a b"),
    ]


@BOTH_SIZES
def test_valence_score(spark, filler):
    words = [("good", 3), ("bad", -3), ("can t stand", -4)]
    df = docs(spark, "Good good. BAD", "I can't stand good", "none", None)
    single = padded(spark, small_frame(spark, words[:2], VALENCE_LEXICON), filler)
    assert column(sentiment.valence_score(df, single), "afinn_sentiment") == [3.0, 3.0, 0.0, 0.0]
    phrases = padded(spark, small_frame(spark, words, VALENCE_LEXICON), filler)
    assert column(sentiment.valence_score(df, phrases), "afinn_sentiment") == [3.0, -1.0, 0.0, 0.0]


def test_text_column_is_honoured(spark):
    df = spark.createDataFrame([(0, "good", "bad")], "doc_id int, title string, article string")
    lexicon = small_frame(spark, [("good", 3), ("bad", -3)], VALENCE_LEXICON)
    assert column(sentiment.valence_score(df, lexicon, text_col="title"), "afinn_sentiment") == [3.0]


@BOTH_SIZES
def test_wordlist_polarity(spark, filler):
    df = docs(spark, "I love this GREAT product", "love hate", "terrible awful love", "nothing", " \n", None)
    scored = sentiment.wordlist_polarity(df, padded(spark, default_wordlist(spark), filler))
    found = column(scored, "sentiment_score")
    assert found == pytest.approx([1.0, 0.0, -1 / 3, 0.0, 0.0, 0.0])
    assert all(-1 <= v <= 1 for v in found)


def test_word_lists_do_not_overlap():
    assert not {w.lower() for w in POSITIVE_WORDS} & {w.lower() for w in NEGATIVE_WORDS}


@BOTH_SIZES
def test_scores_need_no_id_and_bear_repeated_ones(spark, filler):
    valences = padded(spark, small_frame(spark, [("good", 3), ("Good", 3), ("bad", -3)], VALENCE_LEXICON), filler)
    twice = spark.createDataFrame([(1, "good"), (1, "good bad")], "doc_id int, article string")
    assert sorted(column(sentiment.valence_score(twice, valences), "afinn_sentiment")) == [0.0, 3.0]
    nameless = twice.drop("doc_id")
    assert sorted(r["afinn_sentiment"] for r in rows(sentiment.valence_score(nameless, valences))) == [0.0, 3.0]


@BOTH_SIZES
def test_forms_that_differ_in_case_are_one(spark, filler):
    lemmas = padded(spark, small_frame(spark, [("US", "usa"), ("us", "we")], LEMMAS), filler)
    lexicon = small_frame(spark, [("usa", "positive"), ("we", "negative"), ("not", "revert")], CLASS_LEXICON)
    df = docs(spark, "us not us")
    # The alphabetically first lemma: usa, not usa.
    assert column(sentiment.dictionary_sentiment(df, lexicon, lemmas=lemmas), "sentiment_score") == [0.0]
    tokens = text.lemmatize(text.tokens(df), lemmas)
    assert sorted(r["token"] for r in rows(tokens)) == ["not", "usa", "usa"]


def random_texts(n, seed=4):
    """Texts with repeats, without words and without a text; some ids twice or missing."""
    rnd = random.Random(seed)
    words = "not very good bad lack of little cool too zz recommend others to avoid barely Good, BAD".split()
    texts = [" ".join(rnd.choices(words, k=rnd.randrange(12))) + rnd.choice(["", ".", "! Not good. x"]) for _ in range(n)]
    found = [(i % (n - 3), t) for i, t in enumerate(texts)] + [(None, texts[0]), (None, None), (1, ""), (2, texts[1])]
    return found + [found[4]] * 3


def _scores(spark, df, lemmas):
    valences = small_frame(spark, [("good", 3), ("bad", -3), ("bad", -1), ("not good", -2), ("lack of cool", 5)], VALENCE_LEXICON)
    words = default_wordlist(spark).unionByName(small_frame(spark, [("good,", "positive"), ("bad", "negative")], CLASS_LEXICON))
    order = lambda found: sorted(map(repr, rows(found)))
    yield order(sentiment.valence_score(df, valences))
    yield order(sentiment.valence_score(df, valences.where("not term like '% %'")))
    for granularity in ("document", "sentence"):
        for forms in (None, lemmas):
            yield order(sentiment.dictionary_sentiment(df, default_lexicon(spark), lemmas=forms, granularity=granularity))
    yield order(sentiment.dictionary_hits(df, default_lexicon(spark)))
    yield order(sentiment.wordlist_polarity(df, words))


def test_a_joined_dictionary_scores_like_an_inline_one(spark, monkeypatch):
    df = spark.createDataFrame(random_texts(60), SCHEMA).withColumn("term", F.lit("x")).repartition(3)
    lemmas = small_frame(spark, [("little", "barely"), ("cool", "good"), ("zz", "not")], LEMMAS)
    inline = list(_scores(spark, df, lemmas))
    monkeypatch.setattr(lookup, "INLINE_TERMS", 0)
    joined = list(_scores(spark, df, lemmas))
    assert joined == inline


def test_half_a_million_terms(spark):
    """The joined way, against sums by hand; the words of the texts are among the terms."""
    terms = spark.range(500_000).select(
        F.concat(F.lit("w"), F.translate(F.hex("id"), "0123456789ABCDEF", "abcdefghijklmnop")).alias("term"),
        (F.col("id") % 11 - 5).cast("int").alias("valence"),
    )
    name = lambda i: "w" + format(i, "X").translate(str.maketrans("0123456789ABCDEF", "abcdefghijklmnop"))
    numbers = [[7, 499_999, 123_456, 7], [500_001, 600_000], [], list(range(0, 500_000, 4999))]
    df = docs(spark, *(" ".join(map(name, n)) for n in numbers), "no such words")
    expected = [sum(i % 11 - 5 for i in n if i < 500_000) for n in numbers] + [0]
    assert column(sentiment.valence_score(df, terms), "afinn_sentiment") == expected
    classes = terms.select("term", F.when(F.col("valence") > 0, "positive").otherwise("negative").alias("class"))
    signs = [sum(1 if i % 11 > 5 else -1 for i in n if i < 500_000) for n in numbers] + [0]
    assert column(sentiment.dictionary_sentiment(df, classes), "sentiment_score") == signs


def test_words_are_filtered_before_they_move(spark, monkeypatch):
    """The Bloom filter stands below the join, and no text takes part in it."""
    monkeypatch.setattr(lookup, "INLINE_TERMS", 0)
    monkeypatch.setattr(term_join, "BLOOM_LONGS", 64)
    known = term_join.bloom_filter(small_frame(spark, [("good", 3), ("bad", 1)], VALENCE_LEXICON))
    words = spark.range(4096).select(F.concat(F.lit("w"), "id").alias("w")).union(spark.createDataFrame([("good",), ("bad",)], "w string"))
    passed = rows(words.where(known(F.col("w"))))
    assert {"good", "bad"} <= {r["w"] for r in passed} and len(passed) < 40
    plan = sentiment.valence_score(docs(spark, "good"), small_frame(spark, [("good", 3)], VALENCE_LEXICON))
    plan = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "getbit" in plan or "bit_get" in plan


def test_what_meets_a_large_dictionary_is_distinct_words(spark, monkeypatch):
    """Texts that hold a word a thousand times send it to the join once, and one table comes back for their group."""
    monkeypatch.setattr(lookup, "INLINE_TERMS", 0)
    df = docs(spark, *["good bad " * 1000, "bad " * 500] * 20)
    lexicon = small_frame(spark, [("good", 3), ("bad", -1)], VALENCE_LEXICON)
    met = term_join._with_tables(
        df, F.array(word_array("article")), [1], lexicon.select("term", F.struct("valence").alias("entry"))
    )
    tables = {str(r["_tables"]) for r in rows(met.groupBy(F.xxhash64("article")).agg(F.max(F.to_json("_tables")).alias("_tables")))}
    assert 1 <= len(tables) <= 2
    for found in (
        sentiment.valence_score(df, lexicon), sentiment.dictionary_sentiment(df, default_lexicon(spark)),
        sentiment.wordlist_polarity(df, default_wordlist(spark)),
    ):
        plan = found._jdf.queryExecution().optimizedPlan().toString()
        assert "posexplode" not in plan and "explode(_distinct" in plan
    assert column(sentiment.valence_score(df, lexicon), "afinn_sentiment") == [2000.0, -500.0] * 20


def test_lemmas_are_counted_before_the_join(spark):
    lemmas = small_frame(spark, [("were", "be"), ("Is", "be")], LEMMAS)
    token_rows = text.tokens(docs(spark, "were is IS was. be", "is", None))
    counted = text.lemma_counts(token_rows, lemmas)
    plain = text.lemmatize(token_rows, lemmas).groupBy("token").agg(F.count(F.lit(1)).alias("uses"))
    assert rows(counted, "token") == rows(plain, "token") == [{"token": "be", "uses": 5}, {"token": "was", "uses": 1}]
    plan = QUERIES["lemmas_large"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().optimizedPlan().toString()
    below = plan[plan.index("Join"):]
    assert below.index("Aggregate [token") < below.index("Generate")


def test_daily_mean_and_sum(spark):
    df = spark.createDataFrame(
        [("A", "2024-01-01", 1.0, 1), ("A", "2024-01-01", 3.0, -1), ("A", "2024-01-02", 5.0, 0)],
        "symbol string, date string, afinn_sentiment double, pnn_sentiment int",
    ).withColumn("date", F.col("date").cast("date"))
    found = rows(sentiment.daily_sentiment(df), "date")
    assert [(r["afinn_sentiment_mean"], r["pnn_sentiment"]) for r in found] == [(2.0, 0.0), (5.0, 0.0)]
    found = rows(sentiment.daily_sentiment(df, agg="sum"), "date")
    assert [r["afinn_sentiment_sum"] for r in found] == [4.0, 5.0]


def test_scoring_shuffles_daily_sums_only(spark):
    """Articles are scored where they are read: one exchange, of sums per day."""
    from tickermood.plans.feature_table import score_articles

    df = docs(spark, "good").withColumns({"symbol": F.lit("A"), "date": F.current_date()})
    valences = small_frame(spark, [("good", 3)], VALENCE_LEXICON)
    daily = sentiment.daily_sentiment(score_articles(df, valences, default_lexicon(spark)))
    plan = daily._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_avg" in plan


def test_both_scores_in_one_pass_are_those_of_each(spark):
    draw = random.Random(5)
    valences = small_frame(spark, [("good", 3), ("bad", -2), ("not good", -1), ("good not", 5), ("kin", 2), ("so", None)], VALENCE_LEXICON)
    classes = small_frame(spark, [
        ("good", "positive"), ("bad", "negative"), ("very", "increment"), ("hardly", "decrement"), ("not", "revert"),
        ("very good bad", "negative"), ("bad very", "positive"), ("so", "other"), ("i", "positive"), ("kin", "negative"),
    ], CLASS_LEXICON)
    words = ["good", "BAD", "very", "hardly", "not", "so", "x", "I", "\u0130", "\u212ain", "\u00e4", "\u4e16", "Good-bad", "it's"]
    gaps = [" "] * 6 + [". ", "! ", "?\n", ".", " .\x0b", ".\x0c", ".\r", ".\t ", ". . ", "\u00a0", "\u2003", ".\u00a0", "\0", "\n", ".,", ",. "]
    texts = ["".join(draw.choice(words) + draw.choice(gaps) for _ in range(draw.randrange(40))) for _ in range(400)]
    df = docs(spark, *texts, None, "", " . ", "good. " * 5_000, "not" + " " * 100_000 + "good", "not" + ". " * 50_000 + "good")
    found = sentiment.both_scores(df, valences, classes)
    each = sentiment.dictionary_sentiment(sentiment.valence_score(df, valences), classes)
    assert found.columns == each.columns and [f.dataType for f in found.schema] == [f.dataType for f in each.schema]
    assert rows(found, "doc_id") == rows(each, "doc_id")
    assert len({r["sentiment_score"] for r in found.collect()}) > 20


def test_articles_are_scored_in_one_pass_by_small_dictionaries_only(spark, monkeypatch):
    from tickermood.plans.feature_table import score_articles

    df = docs(spark, "very good. Not bad", None)
    valences = small_frame(spark, [("good", 3)], VALENCE_LEXICON)
    scored = lambda: score_articles(df, valences, default_lexicon(spark))
    one_pass = scored()
    assert one_pass._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 1
    monkeypatch.setattr(lookup, "INLINE_TERMS", 0)
    assert rows(one_pass, "doc_id") == rows(scored(), "doc_id")
