"""Sentence, token, lemma and phrase tables.

The long tables serve analysis; the scorers of ``operators.sentiment`` work
inside each row and never build them.
"""

from pyspark.sql import DataFrame, functions as F

from tickermood.functions.text import ahead, sentence_array, sentence_words


def each(df: DataFrame, keys, array, pos: str, item: str) -> DataFrame:
    """One row per array element with its position.

    Written with the outer form: the plain one makes Spark test the size of the
    array in a filter of its own, which computes the array a second time.
    """
    rows = df.select(*keys, F.posexplode_outer(array).alias(pos, item))
    return rows.filter(F.col(pos).isNotNull())


def sentences(df: DataFrame, text_col="article", id_col="doc_id") -> DataFrame:
    return each(df, [id_col], sentence_array(text_col), "sent_id", "sentence")


def tokens(df: DataFrame, text_col="article", id_col="doc_id") -> DataFrame:
    """(id, sent_id, pos, token), positions from 0 within each sentence."""
    by_sentence = each(df, [id_col], sentence_words(text_col), "sent_id", "words")
    return each(by_sentence, [id_col, "sent_id"], "words", "pos", "token")


def lemma_forms(lemmas: DataFrame) -> DataFrame:
    """``(word, lemma)`` in lower case, one row per form; of several lemmas the first by alphabet."""
    forms = lemmas.select(F.lower("form").alias("word"), F.lower("lemma").alias("lemma"))
    return forms.groupBy("word").agg(F.min("lemma").alias("lemma"))


def lemmatize(token_rows: DataFrame, lemmas: DataFrame) -> DataFrame:
    """Replace each token by its lemma; a form without one stays as it is.

    No join hint: Spark broadcasts a dictionary it knows to be small, and past
    that size joins by shuffle with skewed tokens split by adaptive execution.
    """
    forms = lemma_forms(lemmas).select(F.col("word").alias("token"), F.col("lemma").alias("_lemma"))
    joined = token_rows.join(forms, "token", "left")
    others = [c for c in token_rows.columns if c != "token"]
    return joined.select(*others, F.coalesce("_lemma", "token").alias("token"))


def lemma_counts(token_rows: DataFrame, lemmas: DataFrame) -> DataFrame:
    """(token, uses): how often each lemma occurs, a form without one standing for itself.

    Tokens are counted before they meet the dictionary: what moves is a row for each
    distinct token of a task, and no task sorts the uses of a common one.
    """
    counts = token_rows.groupBy("token").agg(F.count(F.lit(1)).alias("uses"))
    return lemmatize(counts, lemmas).groupBy("token").agg(F.sum("uses").alias("uses"))


def ngrams(df: DataFrame, text_col="article", id_col="doc_id", max_n=4) -> DataFrame:
    """(id, sent_id, pos, n, gram) for every run of up to ``max_n`` words of a sentence."""
    by_sentence = each(df, [id_col], sentence_words(text_col), "sent_id", "words")
    starts = each(by_sentence, [id_col, "sent_id"], ahead(F.col("words"), max_n), "pos", "ahead")
    sizes = F.explode(F.sequence(F.lit(1), F.size("ahead"))).alias("n")
    gram = F.array_join(F.slice("ahead", F.lit(1), F.col("n")), " ").alias("gram")
    return starts.select("*", sizes).select(id_col, "sent_id", "pos", "n", gram)


def explode_sentences(df: DataFrame, sentence_col="sentences", embedding_col="embeddings", keep=("doc_id",)) -> DataFrame:
    """One row per sentence with its embedding, from two arrays of equal order.

    A row without embeddings keeps its sentences.
    """
    listed = F.coalesce(F.col(embedding_col), F.array())
    pairs = F.arrays_zip(F.col(sentence_col).alias("sentence"), listed.alias("embedding"))
    return each(df, keep, pairs, "sent_id", "pair").select(
        *keep, "sent_id", F.col("pair.sentence").alias("sentence"), F.col("pair.embedding").alias("embedding")
    )


def attach_sentences(articles: DataFrame, sentence_rows: DataFrame, on="doc_id") -> DataFrame:
    """Article rows with the rows of their sentences."""
    return articles.join(sentence_rows, on)
