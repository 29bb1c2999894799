"""Every operator as a query over the sample tables: (spark, sf_dir) -> DataFrame."""

from functools import reduce

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, functions as F

from tickermood.functions.columns import direction, feature_columns, first_element, label_direction, trend_label
from tickermood.functions.dates import assign_window, fetch_windows, month_name, news_date, next_session_date
from tickermood.functions.text import sentence_array, word_array
from tickermood.operators import evaluation, features, market, neighbours, scaling, sentiment, splits, stats, text
from tickermood.operators.ordinal import article_ordinal
from tickermood.plans import inference, scoring, training
from tickermood.plans.feature_table import daily_scores, feature_table, scale_daily, score_articles
from tickermood.schemas import FEATURES, MARKET_COLUMNS, SENTIMENT_COLUMNS, TARGET
from tickermood.session import materialize, pieces, saved, scratch_path
from tickermood.sources import sample
from tickermood.sources import news as news_files
from tickermood.sources import tables
from tickermood.sources.dictionaries import default_wordlist, read_lemmas, read_lexicon, read_valences
from tickermood.streaming import news as streaming

QUERIES = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def rounded(df: DataFrame, digits=4) -> DataFrame:
    """Doubles to four places, so that summation order does not show."""
    return df.select(
        *[F.round(c, digits).alias(c) if t in ("double", "float") else F.col(c) for c, t in df.dtypes]
    )


def _features(spark, sf, **options):
    return feature_table(
        sample.news(spark, sf), sample.prices(spark, sf), sample.valences(spark), sample.classes(spark), **options
    )


def _segment_features(spark, sf, **options):
    return feature_table(
        sample.segment_news(spark, sf), sample.segment_prices(spark, sf), sample.valences(spark),
        sample.classes(spark), **options,
    )


def _scored(spark, sf):
    return score_articles(sample.news(spark, sf), sample.valences(spark), sample.classes(spark))


def _valued(spark, sf):
    return sentiment.valence_score(sample.news(spark, sf), sample.valences(spark))


def _segment_changes(spark, sf):
    return market.price_features(sample.segment_prices(spark, sf))


# --- prices -----------------------------------------------------------------


@query
def price_features(spark, sf):
    return rounded(market.price_features(sample.prices(spark, sf)))


@query
def segment_price_features(spark, sf):
    return rounded(_segment_changes(spark, sf))


@query
def price_return_fraction(spark, sf):
    bars = market.pct_change(sample.prices(spark, sf), "adjclose", scale=1, out="p_return")
    return rounded(bars.select("symbol", "date", "p_return"))


@query
def price_span_restricted(spark, sf):
    return rounded(market.restrict_to_span(sample.segment_prices(spark, sf), sample.segment_news(spark, sf)))


@query
def price_span_cut_before(spark, sf):
    bars, scores = sample.segment_prices(spark, sf), sample.segment_news(spark, sf)
    return rounded(market.restrict_to_span(bars, scores, cut="before"))


@query
def price_span_files(spark, sf):
    """The scored span of bars that lie in files, a folder per symbol; the scan is bounded by the scored days."""
    path = scratch_path(spark, "bars")
    tables.write_prices(sample.segment_prices(spark, sf), path)
    return rounded(market.restrict_to_span(tables.read_prices(spark, path), sample.segment_news(spark, sf)))


@query
def ordered_files(spark, sf):
    """Bars written in one order of days, with the place of each row as its file tells it."""
    path = scratch_path(spark, "ordered")
    tables.write_ordered(sample.segment_prices(spark, sf), path, files=7)
    return tables.read_ordered(spark, path).select("position", "symbol", "date", "volume")


@query
def next_session(spark, sf):
    days = sample.segment_prices(spark, sf).select("symbol", "date")
    session = next_session_date("date")
    return days.select("symbol", "date", session.alias("next_session"), month_name(session).alias("month"))


# --- articles ---------------------------------------------------------------


def _published(date="date"):
    return F.concat(F.date_format(date, "EEE, dd MMM yyyy"), F.lit(" 07:00:00 GMT"))


def _raw_news(spark, sf):
    """Documents in the shape of search results, publisher still nested."""
    return sample.as_news(sample.documents(spark, sf, "source"), keep=["source"]).select(
        "doc_id",
        "symbol",
        "article",
        F.lit(None).cast("string").alias("description"),
        _published().alias("published date"),
        F.struct(
            F.concat(F.lit("https://"), "source").alias("href"), F.col("source").alias("title")
        ).alias("publisher"),
        F.concat(F.lit("Article "), "doc_id").alias("title"),
        F.concat(F.lit("https://example.org/"), "doc_id").alias("url"),
    )


@query
def news_date_parse(spark, sf):
    rows = sample.news(spark, sf).withColumn("published", _published())
    return rows.select("doc_id", "published", news_date("published").alias("published_date"))


@query
def news_shape(spark, sf):
    shaped = news_files.shape_news(_raw_news(spark, sf), sample.FIRST_DAY, key="doc_id")
    return shaped.select(
        "doc_id", "symbol", "publisher", "publisher_url", "date", "bucket", "window_start", "window_end",
        "ordinal", "file_name", "n_chars",
    )


@query
def article_numbers(spark, sf):
    windowed = assign_window(sample.news(spark, sf).drop("article"), "date", F.lit(sample.FIRST_DAY).cast("date"))
    return article_ordinal(windowed, by=["symbol", "bucket"], order=["date"], key="doc_id").select(
        "doc_id", "symbol", "bucket", "ordinal"
    )


@query
def fetch_window_days(spark, sf):
    days = sample.segment_news(spark, sf).groupBy("symbol").agg(F.min("date").alias("start"), F.max("date").alias("final"))
    return fetch_windows(days)


@query
def news_landing(spark, sf):
    """Articles written as JSON, read back with the fixed schema, counted per day."""
    path = scratch_path(spark, "landing")
    news_files.land_news(news_files.flatten_news(_raw_news(spark, sf)), path)
    rows = news_files.read_landed_news(spark, path)
    return rows.groupBy("symbol", news_date("`published date`").alias("date")).agg(
        F.count(F.lit(1)).alias("articles"), F.sum(F.length("article")).alias("n_chars")
    )


# --- text -------------------------------------------------------------------


@query
def sentences(spark, sf):
    return text.sentences(sample.news(spark, sf))


@query
def tokens_count(spark, sf):
    rows = text.tokens(sample.news(spark, sf))
    return rows.groupBy("doc_id").agg(F.count(F.lit(1)).alias("tokens"), F.max("sent_id").alias("last_sentence"))


@query
def lemmas(spark, sf):
    rows = text.lemmatize(text.tokens(sample.news(spark, sf)), sample.lemmas(spark))
    return rows.groupBy("token").agg(F.count(F.lit(1)).alias("uses"))


@query
def ngrams_count(spark, sf):
    return text.ngrams(sample.news(spark, sf)).groupBy("n").agg(F.count(F.lit(1)).alias("grams"))


@query
def ngram_hits(spark, sf):
    return sentiment.dictionary_hits(sample.news(spark, sf), sample.classes(spark))


@query
def article_sentences(spark, sf):
    articles = sample.news(spark, sf)
    rows = text.attach_sentences(articles.select("doc_id", "symbol", "date"), text.sentences(articles))
    return rows.select("doc_id", "symbol", "date", "sent_id", F.length("sentence").alias("n_chars"))


@query
def explode_embeddings(spark, sf):
    """Sentences of every document zipped with the four quarters of its vector, if it has one."""
    vectors = sample.table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "embedding")
    quarters = F.transform(F.sequence(F.lit(0), F.lit(3)), lambda i: F.slice("embedding", i * 16 + 1, 16))
    rows = sample.news(spark, sf).join(vectors, "doc_id", "left").select(
        "doc_id", sentence_array("article").alias("sentences"),
        F.when(F.col("embedding").isNotNull(), quarters).alias("embeddings"),
    )
    return text.explode_sentences(rows).select(
        "doc_id", "sent_id", F.length("sentence").alias("n_chars"),
        F.round(F.get("embedding", F.lit(0)).cast("double"), 4).alias("first_value"),
    )


# --- scores -----------------------------------------------------------------


@query
def valence_score(spark, sf):
    return _valued(spark, sf).select("doc_id", "afinn_sentiment")


@query
def dictionary_sentiment(spark, sf):
    rows = sentiment.dictionary_sentiment(sample.news(spark, sf), sample.classes(spark))
    return rows.select("doc_id", "sentiment_score", F.array_join("sentiment", ",").alias("sentiment"))


@query
def dictionary_sentiment_lemmas(spark, sf):
    rows = sentiment.dictionary_sentiment(sample.news(spark, sf), sample.classes(spark), lemmas=sample.lemmas(spark))
    return rows.select("doc_id", "sentiment_score", F.array_join("sentiment", ",").alias("sentiment"))


@query
def sentence_labels(spark, sf):
    rows = sentiment.dictionary_sentiment(sample.news(spark, sf), sample.classes(spark), granularity="sentence")
    return rows.select("doc_id", F.array_join("sentiment", ",").alias("sentiment"))


@query
def pnn_score(spark, sf):
    rows = sentiment.dictionary_sentiment(sample.news(spark, sf), sample.classes(spark))
    return sentiment.pnn_score(rows).select("doc_id", "pnn_sentiment")


@query
def wordlist_polarity(spark, sf):
    rows = sentiment.wordlist_polarity(sample.news(spark, sf), default_wordlist(spark))
    return rounded(rows.select("doc_id", "sentiment_score"))


@query
def daily_sentiment(spark, sf):
    return rounded(sentiment.daily_sentiment(_scored(spark, sf)))


@query
def daily_sentiment_sum(spark, sf):
    return rounded(sentiment.daily_sentiment(_scored(spark, sf), agg="sum").withColumn("pnn_sentiment", F.col("pnn_sentiment").cast("long")))


@query
def scaled_sentiment(spark, sf):
    return rounded(daily_scores(sample.news(spark, sf), sample.valences(spark), sample.classes(spark)))


@query
def minmax_sentiment(spark, sf):
    valued = saved(_valued(spark, sf).drop("article"), "valued")
    rows = scaling.minmax(valued, "afinn_sentiment", by="symbol", out="minmax")
    return rounded(rows.select("doc_id", "minmax"))


@query
def div_to_max(spark, sf):
    valued = saved(_valued(spark, sf).drop("article"), "valued")
    rows = scaling.div_to_max(valued, "afinn_sentiment", by="symbol", out="share")
    return rounded(rows.select("doc_id", "share"))


@query
def article_scaling_daily_sum(spark, sf):
    """Three article-level scalings over the whole table, summed per day."""
    valued = saved(_valued(spark, sf).drop("article"), "valued")
    rows = scaling.minmax(valued, "afinn_sentiment", out="min_max_afinn")
    rows = scaling.scale(rows, "afinn_sentiment", center=True, out="std_afinn", ddof=0)
    rows = scaling.div_to_max(rows, "afinn_sentiment", out="div_to_max")
    sums = [F.sum(c).alias(c) for c in ("afinn_sentiment", "min_max_afinn", "std_afinn", "div_to_max")]
    return rounded(rows.groupBy("date").agg(*sums), 3)


# --- feature table ----------------------------------------------------------


@query
def feature_table_inner(spark, sf):
    return rounded(_features(spark, sf))


@query
def feature_table_right(spark, sf):
    return rounded(_features(spark, sf, how="right"))


@query
def feature_table_inference(spark, sf):
    return rounded(_features(spark, sf, inference=True))


@query
def segment_feature_table(spark, sf):
    return rounded(_segment_features(spark, sf))


@query
def feature_files(spark, sf):
    """Feature rows written as headerless CSV and read back by position."""
    path = scratch_path(spark, "features")
    tables.write_features(_features(spark, sf), path, format="csv")
    return rounded(tables.read_features(spark, path))


@query
def price_files(spark, sf):
    """Bars written per symbol and read back by symbol and day."""
    path = scratch_path(spark, "prices")
    tables.write_prices(sample.segment_prices(spark, sf), path)
    bars = tables.read_prices(spark, path, symbols=["BUILDING", "MACHINERY"], start="1996-01-01", end="1997-12-31")
    return rounded(bars, 6)


@query
def resolve_symbol(spark, sf):
    events = sample.table(spark, sf, "events").select("event_id", F.col("event_type").alias("company"))
    return features.resolve_symbol(events, sample.tickers(spark))


@query
def unknown_companies(spark, sf):
    events = sample.table(spark, sf, "events").select(F.col("event_type").alias("company"))
    segments = sample.table(spark, sf, "customer").select(F.col("c_mktsegment").alias("company"))
    return features.unknown_companies(events.unionByName(segments), sample.tickers(spark))


# --- splits, labels, sequences ----------------------------------------------


@query
def chrono_split(spark, sf):
    return splits.chrono_split(_segment_changes(spark, sf).dropna()).select("symbol", "date", "split")


@query
def three_way_split(spark, sf):
    rows = splits.chrono_split(_segment_changes(spark, sf).dropna(), (0.9, 0.9))
    return rows.select("symbol", "date", "split")


@query
def except_split(spark, sf):
    rows = sample.table(spark, sf, "orders").select(
        F.col("o_orderpriority").alias("symbol"), F.col("o_orderdate").cast("date").alias("date")
    )
    counted = rows.groupBy("symbol", "date").agg(F.count(F.lit(1)).alias("orders"))
    train, test = splits.except_split(counted)
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@query
def label_gt0(spark, sf):
    rows = _segment_changes(spark, sf).dropna()
    return label_direction(rows, TARGET, "gt0").select("symbol", "date", "label")


@query
def label_ge0(spark, sf):
    rows = _segment_changes(spark, sf).dropna()
    return label_direction(rows, "price_percent_change", "ge0").select("symbol", "date", "label")


@query
def volume_zscore(spark, sf):
    parts = splits.chrono_split(_segment_changes(spark, sf).dropna())
    rows = scaling.scale(
        parts, "volume_percent_change", center=True, by="symbol", fit_on=F.col("split") == "train",
        out="volume_z", per_day=True,
    )
    return rounded(rows.select("symbol", "date", "volume_z"))


@query
def volume_zscore_all_rows(spark, sf):
    rows = scaling.scale(_segment_changes(spark, sf).dropna(), "volume_percent_change", center=True, out="volume_z")
    return rounded(rows.select("symbol", "date", "volume_z"))


@query
def volume_zscore_stages(spark, sf):
    """The same by pipeline stages: assembler, scaler, first element of the vector."""
    rows = _segment_changes(spark, sf).dropna()
    scaled = Pipeline(stages=training.feature_stages(False)[:2]).fit(rows).transform(rows)
    return rounded(scaled.select("symbol", "date", first_element("volume_z").alias("volume_z")))


@query
def sample_arrays(spark, sf):
    """Inputs without sentiment as arrays, one row per number in them."""
    rows = splits.sample_arrays(_segment_changes(spark, sf).dropna(), feature_columns(False), TARGET)
    return rounded(rows.select("symbol", "date", "label", F.posexplode("x").alias("feature", "value")))


@query
def sequences(spark, sf):
    """Windows of ten sessions, one row per number in them."""
    rows = splits.make_sequences(_segment_changes(spark, sf).dropna(), MARKET_COLUMNS, TARGET, 10)
    steps = rows.select("symbol", "date", "target", F.posexplode("seq").alias("step", "row"))
    cells = steps.select("symbol", "date", "target", "step", F.posexplode("row").alias("feature", "value"))
    return rounded(cells)


@query
def latest_row(spark, sf):
    return rounded(splits.latest_row(_features(spark, sf, inference=True)))


@query
def trend_calls(spark, sf):
    """The call of a forecast that expects the last move to go on."""
    last = splits.latest_row(_segment_changes(spark, sf).select("symbol", "date", "price_percent_change"))
    call = trend_label(direction("price_percent_change"))
    return last.select("symbol", "date", next_session_date("date").alias("next_session"), call.alias("trend"))


# --- statistics and metrics -------------------------------------------------


@query
def class_balance(spark, sf):
    return stats.class_balance(label_direction(_segment_changes(spark, sf).dropna(), TARGET))


@query
def correlation_matrix(spark, sf):
    columns = SENTIMENT_COLUMNS + MARKET_COLUMNS + [TARGET]
    return rounded(stats.correlation_matrix(_segment_features(spark, sf), columns))


@query
def linear_fit_1d(spark, sf):
    return rounded(stats.linear_fit_1d(_segment_changes(spark, sf).dropna(), TARGET, "price_percent_change"))


def _persistence(spark, sf):
    """Forecast that tomorrow moves as today: label, prediction and score without a model."""
    rows = _segment_changes(spark, sf).dropna()
    return rows.select("symbol", "date", F.col(TARGET).alias("label"), F.col("price_percent_change").alias("prediction"))


def _persistence_direction(spark, sf):
    rows = _persistence(spark, sf)
    return rows.select(
        "symbol", "date", direction("label").alias("label"), direction("prediction").alias("prediction"),
        F.col("prediction").alias("score"),
    )


@query
def regression_metrics(spark, sf):
    return rounded(evaluation.regression_metrics(_persistence(spark, sf), by=["symbol"]))


@query
def classification_metrics(spark, sf):
    return rounded(evaluation.classification_metrics(_persistence_direction(spark, sf), by=["symbol"]))


@query
def auc(spark, sf):
    return rounded(evaluation.auc(_persistence_direction(spark, sf), by=["symbol"]))


@query
def batched_r2(spark, sf):
    return rounded(evaluation.batched_r2(_persistence(spark, sf)))


@query
def batched_accuracy(spark, sf):
    return rounded(evaluation.batched_accuracy(_persistence_direction(spark, sf)))


@query
def metric_files(spark, sf):
    """Metrics written as CSV with a header and read back."""
    path = scratch_path(spark, "metrics")
    tables.write_metrics(evaluation.classification_metrics(_persistence_direction(spark, sf), by=["symbol"]), path)
    return rounded(spark.read.option("header", True).schema("symbol string, rows long, accuracy double").csv(path))


@query
def knn_vote(spark, sf):
    rows = label_direction(materialize(splits.chrono_split(_segment_features(spark, sf))), TARGET)
    train, test = rows.filter("split = 'train'"), rows.filter("split = 'test'")
    called = neighbours.knn_classify(train, test, feature_columns(True))
    return called.select("symbol", "date", "label", "prediction")


# --- models -----------------------------------------------------------------


def _fitted(spark, sf, fit, rule="gt0", emotion=True, **params):
    """Predictions for both splits by a model fitted on the first rows of every segment."""
    parts = training.labelled(materialize(splits.chrono_split(_segment_features(spark, sf))), rule)
    model = fit(parts.filter("split = 'train'"), emotion, **params)
    return training.predict(model, parts, keep=["split"])


@query
def linear_model(spark, sf):
    return evaluation.regression_metrics(_fitted(spark, sf, training.fit_linear, rule=None), by=["split"])


@query
def svm(spark, sf):
    return evaluation.classification_metrics(_fitted(spark, sf, training.fit_svm), by=["split"])


@query
def forest(spark, sf):
    return evaluation.classification_metrics(_fitted(spark, sf, training.fit_forest), by=["split"])


@query
def forest_66(spark, sf):
    predictions = _fitted(spark, sf, training.fit_forest, numTrees=66, maxDepth=5)
    return evaluation.classification_metrics(predictions, by=["split"])


@query
def gbt(spark, sf):
    """Accuracy and area under the curve, each by its name."""
    predictions = materialize(_fitted(spark, sf, training.fit_gbt))
    accuracy = evaluation.classification_metrics(predictions, by=["split"])
    return accuracy.join(evaluation.auc(predictions, by=["split"]), "split")


@query
def logistic(spark, sf):
    return evaluation.classification_metrics(_fitted(spark, sf, training.fit_logistic), by=["split"])


def _sequence_parts(spark, sf):
    return materialize(training.sequence_samples(_segment_features(spark, sf), emotion=True))


@query
def sequence_regressor(spark, sf):
    samples = _sequence_parts(spark, sf).withColumn("label", F.col("target"))
    model = training.fit_sequence_regressor(samples.filter("split = 'train'"))
    return evaluation.batched_r2(model.transform(samples.filter("split = 'test'")))


@query
def sequence_mlp(spark, sf):
    samples = _sequence_parts(spark, sf).withColumn("label", direction("target", "ge0").cast("double"))
    model = training.fit_sequence_classifier(samples.filter("split = 'train'"), inputs=10 * len(feature_columns(True)))
    return evaluation.batched_accuracy(model.transform(samples.filter("split = 'test'")))


@query
def experiment_grid(spark, sf):
    """Every model for every segment, without and with sentiment."""
    return training.run_experiments(_segment_features(spark, sf), sample.SEGMENT_SYMBOLS)


@query
def experiment_rows(spark, sf):
    """Test rows of the grid by their label, and how well the better of two constant calls would do.

    The fits are those that also learn from a segment of one label; ``experiment_grid`` makes all of them.
    """
    predictions = training.experiment_predictions(
        _segment_features(spark, sf), sample.SEGMENT_SYMBOLS, ("LinearRegression", "LogisticRegression")
    )
    up = F.count_if(F.col("label") > 0)
    share = up / F.count("prediction")
    found = predictions.groupBy("model", "stock", "emotion").agg(
        F.count("prediction").alias("rows"), up.alias("ups"), F.greatest(share, 1 - share).alias("constant_accuracy")
    )
    return rounded(found)


def _moments(predictions, fitted):
    """Mean of each input times the fitted value, over train rows.

    A least-squares or maximum-likelihood fit has the same moments as the label itself,
    and no other coefficients have; so SQL can tell whether the fit is the optimum.
    """
    train = predictions.filter("split = 'train'")
    inputs = [F.lit(1.0).alias("one"), *[F.col(c).alias(c) for c in feature_columns(True)]]
    rows = train.select(fitted.alias("fitted"), *inputs)
    cells = F.array(*[
        F.struct(F.lit(c).alias("input"), F.avg(F.col(c) * F.col("fitted")).alias("moment"))
        for c in ["one", *feature_columns(True)]
    ])
    return rounded(rows.agg(cells.alias("cells")).select(F.inline("cells")), 2)


@query
def linear_moments(spark, sf):
    """The linear model, saved and loaded, against its normal equations."""
    parts = training.labelled(materialize(splits.chrono_split(_segment_features(spark, sf))), None)
    path = scratch_path(spark, "model")
    tables.save_model(training.fit_linear(parts.filter("split = 'train'"), True), path)
    return _moments(tables.load_model(path).transform(parts), F.col("prediction"))


@query
def logistic_moments(spark, sf):
    """The logistic model against its likelihood equations."""
    parts = training.labelled(materialize(splits.chrono_split(_segment_features(spark, sf))), "gt0")
    model = training.fit_logistic(parts.filter("split = 'train'"), True, maxIter=500, tol=1e-9)
    return _moments(model.transform(parts), vector_to_array("probability")[1])


@query
def sequence_moments(spark, sf):
    """The sequence regressor against its normal equations, input by input."""
    samples = _sequence_parts(spark, sf).withColumn("label", F.col("target"))
    train = samples.filter("split = 'train'")
    fitted = training.fit_sequence_regressor(train, solver="normal").transform(train)
    cells = fitted.select("prediction", F.posexplode(F.flatten("seq")).alias("input", "value"))
    return rounded(cells.groupBy("input").agg(F.avg(F.col("prediction") * F.col("value")).alias("moment")), 2)


@query
def classifier_checks(spark, sf):
    """Row and label counts of both splits, and how many rows a model's exported table calls as the model does.

    The forest and the boosted trees are exported as nodes and the SVM as coefficients; each scores the
    rows a second time without the ML runtime.
    """
    parts = training.labelled(materialize(splits.chrono_split(_segment_features(spark, sf))), "gt0")
    found = []
    for name in ("SVM", "RandomForest", "GradientBoosting"):
        model = training.MODELS[name][0](parts.filter("split = 'train'"), True)
        rows = model.transform(parts).withColumn("x", vector_to_array("features"))
        if name == "SVM":
            call = scoring.called(scoring.linear_score(scoring.linear_rows(model, True)))
        else:
            inputs = [f"x{k}" for k in range(len(feature_columns(True)))]
            rows = rows.select("*", *[F.col("x")[k].alias(c) for k, c in enumerate(inputs)])
            rows = rows.withColumn("votes", scoring.tree_votes(scoring.tree_nodes(model), inputs))
            call = (F.col("votes.up") > F.col("votes.down")).cast("double")
        same = rows.select("split", "label", "prediction", (call == F.col("prediction")).alias("same"))
        found.append(same.withColumn("model", F.lit(name)))
    return reduce(DataFrame.unionByName, found).groupBy("model", "split").agg(
        F.count("prediction").alias("rows"), F.sum("label").cast("long").alias("ups"), F.count_if("same").alias("same_calls")
    )


@query
def training_histories(spark, sf):
    """Losses of the sequence classifier per choice of inputs, on train and validation rows, written and read back."""
    features_ = materialize(_segment_features(spark, sf))
    path = scratch_path(spark, "histories")
    for emotion in (False, True):
        samples = training.sequence_samples(features_, emotion, fractions=(0.9, 0.9))
        samples = materialize(samples.withColumn("label", direction("target", "ge0").cast("double")))
        parts = {name: samples.filter(F.col("split") == name) for name in ("train", "valid", "test")}
        model, losses, valid_losses = training.fit_with_history(
            parts["train"], parts["valid"], 10 * len(feature_columns(emotion))
        )
        accuracy = evaluation.classification_metrics(model.transform(parts["test"]))
        tables.write_histories(
            accuracy.select(
                F.lit(f"segments_emotion_{emotion}").alias("name"),
                F.array(*[F.lit(x) for x in losses]).alias("loss"),
                F.array(*[F.lit(x) for x in valid_losses]).alias("val_loss"),
                F.col("accuracy").alias("test_accuracy"),
            ),
            path,
        )
    return tables.read_histories(spark, path)


@query
def history_files(spark, sf):
    """What the history files hold, as far as it needs no model: names, metric, numbers of rounds."""
    rows = training_histories(spark, sf)
    falls = F.element_at("loss", -1) <= F.element_at("loss", 1)
    return rows.select("name", "metric", F.size("val_loss").alias("rounds"), falls.alias("loss_falls"))


def _trend_model(spark, scores, changes, emotion):
    """Fit on the train rows, save, load."""
    rows = materialize(splits.chrono_split(features.join_features(scores, changes)))
    path = scratch_path(spark, "model")
    tables.save_model(training.fit_svm(training.labelled(rows, "gt0").filter("split = 'train'"), emotion), path)
    return tables.load_model(path)


@query
def predict_trend(spark, sf):
    """Calls without and with sentiment; all steps share the daily scores, so articles are read once."""
    scores = materialize(daily_scores(sample.segment_news(spark, sf), sample.valences(spark), sample.classes(spark)))
    changes = materialize(_segment_changes(spark, sf))
    rows = features.join_features(scores, changes, inference=True)
    calls = [
        inference.predict_trend(rows, _trend_model(spark, scores, changes, emotion), emotion)
        for emotion in (False, True)
    ]
    return inference.trend_text(calls[0].unionByName(calls[1]))


@query
def tree_scores(spark, sf):
    """Votes of a tree ensemble that is a table of nodes, and the class they call."""
    votes = scoring.tree_votes(sample.trees(spark), feature_columns(True))
    rows = _segment_features(spark, sf).withColumn("votes", votes).select("symbol", "date", "votes.*")
    return rounded(rows.withColumn("prediction", (F.col("up") > F.col("down")).cast("int")))


@query
def perceptron_scores(spark, sf):
    """Probability of a rise by a perceptron that is a table of weights."""
    x = "array(" + ", ".join(f"cast({c} as double)" for c in feature_columns(True)) + ")"
    found = scoring.perceptron_probabilities(sample.perceptron(spark), x)
    return rounded(_segment_features(spark, sf).select("symbol", "date", found[0].alias("down"), found[1].alias("up")))


@query
def linear_calls(spark, sf):
    """The call after each symbol's latest day by a model that is a table of coefficients."""
    score = scoring.linear_score(sample.linear(spark))
    calls = inference.predict_trend(_segment_features(spark, sf, inference=True), scoring.called(score), True)
    return calls.select("symbol", "date", "next_session", "sentiment", "trend")


# --- streams ----------------------------------------------------------------

# The landed articles come in at least this many triggers.
LANDED_FILES = 6


def _landed_stream(spark, sf, news):
    """Articles landed as JSON in a folder per symbol, then read as they come, a sixth of the files a trigger.

    The tasks that write grow in number with the articles, not in size.
    """
    landing = scratch_path(spark, "landing")
    flat = news.select(
        F.concat(F.lit("Article "), "doc_id").alias("title"), F.lit(None).cast("string").alias("description"),
        _published().alias("published date"), F.concat(F.lit("https://example.org/"), "doc_id").alias("url"),
        F.lit("p").alias("publisher"), F.lit("u").alias("publisher_url"), "article", "symbol",
    )
    flat.repartition(pieces(news, LANDED_FILES), "url").write.partitionBy("symbol").json(landing)
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(landing).select("path").count()
    rows = streaming.stream_news(spark, f"{landing}/*", files_per_trigger=max(1, files // LANDED_FILES))
    return rows.withColumn("symbol", F.regexp_replace("symbol", "^symbol=", ""))


@query
def stream_daily_sentiment(spark, sf):
    """Daily means kept up to date over several triggers of landed files, read back at the end.

    The documents lie in no order of time, so the watermark spans all their days.
    """
    daily = streaming.stream_daily_sentiment(
        _landed_stream(spark, sf, sample.news(spark, sf)), sample.valences(spark), sample.classes(spark), watermark="31 days"
    )
    path = scratch_path(spark, "daily")
    job = streaming.write_updates(daily, path, scratch_path(spark, "offsets"), available_now=True)
    job.awaitTermination()
    return rounded(streaming.read_updates(spark, path))


@query
def stream_trend(spark, sf):
    """Calls of a saved model, kept up to date over several triggers."""
    lexicons = (sample.valences(spark), sample.classes(spark))
    history = materialize(sentiment.daily_sentiment(score_articles(sample.segment_news(spark, sf), *lexicons)))
    changes = saved(_segment_changes(spark, sf), "changes")
    model = _trend_model(spark, scale_daily(history), changes, emotion=True)
    deviation = history.groupBy("symbol").agg(F.stddev_samp("afinn_sentiment_mean").alias("deviation"))
    stream = _landed_stream(spark, sf, sample.segment_news(spark, sf))
    daily = streaming.stream_daily_sentiment(stream, *lexicons, watermark="731 days")
    path = scratch_path(spark, "trend")
    job = streaming.stream_trend(
        daily, changes, model, True, path, scratch_path(spark, "offsets"), materialize(deviation), available_now=True
    )
    job.awaitTermination()
    return streaming.read_trends(spark, path)


@query
def stream_linear_calls(spark, sf):
    """Calls of a model that is a table of coefficients, kept up to date over several triggers."""
    lexicons = (sample.valences(spark), sample.classes(spark))
    history = materialize(sentiment.daily_sentiment(score_articles(sample.segment_news(spark, sf), *lexicons)))
    deviation = history.groupBy("symbol").agg(F.stddev_samp("afinn_sentiment_mean").alias("deviation"))
    stream = _landed_stream(spark, sf, sample.segment_news(spark, sf))
    path = scratch_path(spark, "trend")
    streaming.stream_trend(
        streaming.stream_daily_sentiment(stream, *lexicons, watermark="731 days"),
        saved(_segment_changes(spark, sf), "changes"), scoring.called(scoring.linear_score(sample.linear(spark))), True,
        path, scratch_path(spark, "offsets"), materialize(deviation), available_now=True,
    ).awaitTermination()
    return streaming.read_trends(spark, path).select("symbol", "date", "next_session", "sentiment", "trend")


# Days of a landing, of which a seventh of the articles lands two landings later.
LANDING_DAYS = 5


@query
def stream_late_articles(spark, sf):
    """Six landings, some articles long after their day: what each day keeps and what the watermark drops."""
    landing, daily, offsets = (scratch_path(spark, name) for name in ("late-landing", "late-daily", "late-offsets"))
    news = sample.news(spark, sf).withColumn("landing", F.floor(F.datediff("date", F.lit(sample.FIRST_DAY)) / LANDING_DAYS))
    late = F.when(F.col("doc_id") % 7 == 3, 2).otherwise(0)
    news = news.withColumn("landing", F.least(F.col("landing") + late, F.lit(5)))
    staged = scratch_path(spark, "late-news")
    # A folder per landing, so that each reads its own articles only.
    news.select("landing", "article", _published().alias("published date"), "symbol").write.partitionBy("landing").parquet(staged)
    rows = spark.read.schema("article string, `published date` string, symbol string, landing int").parquet(staged)
    stream = lambda: streaming.stream_news(spark, f"{landing}/*/*").withColumn(
        "symbol", F.regexp_replace("symbol", "^symbol=", "")
    )
    for k in range(6):
        rows.where(F.col("landing") == k).drop("landing").write.partitionBy("symbol").json(f"{landing}/{k}")
        scores = streaming.stream_daily_sentiment(stream(), sample.valences(spark), sample.classes(spark), counts=True)
        streaming.write_updates(scores, daily, offsets, available_now=True).awaitTermination()
    arrivals = scratch_path(spark, "arrivals")
    streaming.write_arrivals(stream(), arrivals, scratch_path(spark, "arrival-offsets"), available_now=True).awaitTermination()
    return streaming.late_articles(spark, arrivals, daily)


@query
def stream_trend_days(spark, sf):
    """The day each symbol's streamed call is for, which no model decides."""
    return stream_trend(spark, sf).select("symbol", "date", "next_session", "month", "sentiment")


# --- dictionaries from files and of large size ------------------------------


def _corpus_words(spark, sf):
    """All words of the documents, each with a number from its letters."""
    words = sample.documents(spark, sf).select(F.explode(F.array_distinct(word_array("text"))).alias("term")).distinct()
    return words.withColumn("number", F.ascii(F.substring("term", -1, 1)) - 96 + F.length("term"))


@query
def valence_score_large(spark, sf):
    """Valences of every word of the corpus, written as a file and loaded from it."""
    path = scratch_path(spark, "valences")
    lines = _corpus_words(spark, sf).select(F.concat("term", F.lit("\t"), (F.col("number") % 11 - 5).cast("string")))
    lines.union(spark.createDataFrame([("",), ("no valence",), ("bad\tnumber",)], "line string")).write.text(path)
    rows = sentiment.valence_score(sample.news(spark, sf), read_valences(spark, path))
    return rows.select("doc_id", "afinn_sentiment")


def _large_classes(spark, sf):
    names = F.array(*[F.lit(c) for c in ("positive", "negative", "increment", "decrement", "revert")])
    kind = F.get(names, (F.col("number") % 5).cast("int"))
    return _corpus_words(spark, sf).select("term", kind.alias("class"))


@query
def dictionary_sentiment_large(spark, sf):
    """A class dictionary of every word of the corpus, written as a file and loaded from it."""
    path = scratch_path(spark, "classes")
    _large_classes(spark, sf).select(F.concat_ws(",", "term", "class")).write.text(path)
    rows = sentiment.dictionary_sentiment(sample.news(spark, sf), read_lexicon(spark, path))
    return rows.select("doc_id", "sentiment_score", F.array_join("sentiment", ",").alias("sentiment"))


@query
def wordlist_large(spark, sf):
    rows = sentiment.wordlist_polarity(sample.news(spark, sf), saved(_large_classes(spark, sf), "wordlist"))
    return rounded(rows.select("doc_id", "sentiment_score"))


@query
def lemmas_large(spark, sf):
    """Lemmas of every word of the corpus, loaded from a file that lists some forms twice."""
    path = scratch_path(spark, "lemmas")
    forms = _corpus_words(spark, sf).select(
        F.concat(F.substring("term", 1, 3), F.lit("->"), "term", F.lit("\t"), F.upper("term")).alias("line")
    )
    forms.union(spark.createDataFrame([("",), ("zzz->the",), ("alone",)], "line string")).write.text(path)
    return text.lemma_counts(text.tokens(sample.news(spark, sf)), read_lemmas(spark, path))


@query
def article_files(spark, sf):
    """Articles landed as JSON and scanned by symbol folder, as a whole and per day."""
    landing = scratch_path(spark, "articles")
    news_files.land_news(news_files.flatten_news(_raw_news(spark, sf)), landing)
    rows = news_files.read_news(spark, f"{landing}/*").withColumn("date", news_date("`published date`"))
    symbol = F.regexp_replace("symbol", "^symbol=", "").alias("symbol")
    return rows.groupBy(symbol, "date").agg(
        F.count("article").alias("articles"), F.sum(F.length("article")).alias("n_chars"), F.min("title").alias("first_title")
    )


@query
def header_files(spark, sf):
    """Feature rows written as CSV with a header and read back by position."""
    path = scratch_path(spark, "header")
    rows = _features(spark, sf).select(*[f.name for f in FEATURES.fields])
    rows.write.option("header", True).csv(path)
    return rounded(tables.read_features(spark, path, header=True).drop("symbol"))


@query
def title_score(spark, sf):
    """Scores of another column than the article."""
    rows = sample.news(spark, sf).withColumnRenamed("article", "title")
    scored = score_articles(rows, sample.valences(spark), sample.classes(spark), text_col="title")
    return scored.select("doc_id", "afinn_sentiment", "pnn_sentiment")
