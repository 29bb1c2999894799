"""The same results in plain SQL, to check the queries against.

Written without regard for speed, and independently of the operators: scores by
joins over a token table, ordinals and splits by single windows.
"""

from tickermood.sources.dictionaries import NEGATIVE_WORDS, POSITIVE_WORDS
from tickermood.sources.sample import SAMPLE_LEMMAS, SAMPLE_LEXICON, SAMPLE_LINEAR, SAMPLE_PERCEPTRON, SAMPLE_TICKERS, SAMPLE_TREES

_T = "next_day_price_percent_change_shifted"


def _values(rows) -> str:
    cell = lambda v: "null" if v is None else f"'{v}'" if isinstance(v, str) else str(v)
    return ", ".join("(" + ", ".join(cell(v) for v in row) + ")" for row in rows)


# Named parts; a query lists those it needs, in order.
PARTS = {
    "lexicon": f"lexicon(term, valence, class) as (values {_values(SAMPLE_LEXICON)})",
    "lemma": f"lemma(form, lemma) as (values {_values(SAMPLE_LEMMAS)})",
    "corpuswords": """corpuswords as (
        select term, ascii(right(term, 1)) - 96 + length(term) as number
        from (select distinct unnest(regexp_extract_all(lower(text), '[a-z]+')) as term from documents) w)""",
    "largelexicon": """lexicon as (
        select term, number % 11 - 5 as valence,
               ['positive', 'negative', 'increment', 'decrement', 'revert'][number % 5 + 1] as class
        from corpuswords)""",
    "largelemma": """lemma as (select term as form, substr(term, 1, 3) as lemma from corpuswords)""",
    "largewordlist": """wordlist as (
        select term as word, case number % 5 when 0 then 'p' else 'n' end as class from corpuswords where number % 5 < 2)""",
    "ticker": f"ticker(company, ticker) as (values {_values(SAMPLE_TICKERS)})",
    "wordlist": "wordlist(word, class) as (values "
    + _values(
        [(w, "p") for w in sorted({w.lower() for w in POSITIVE_WORDS})]
        + [(w, "n") for w in sorted({w.lower() for w in NEGATIVE_WORDS})]
    )
    + ")",
    "prices": """prices as (
        select symbol, date, adjclose, volume from (
            select event_type as symbol, cast(ts as date) as date, value as adjclose,
                   count(*) over (partition by event_type, cast(ts as date)) as volume,
                   row_number() over (partition by event_type, cast(ts as date)
                                      order by ts desc, event_id desc) as rn
            from events) where rn = 1)""",
    "segprices": """prices as (
        select c_mktsegment as symbol, cast(o_orderdate as date) as date,
               avg(o_totalprice) as adjclose, count(*) as volume
        from orders join customer on o_custkey = c_custkey
        group by 1, 2)""",
    "news": """news as (
        select doc_id, text as article,
               case doc_id % 5 when 0 then 'click' when 1 then 'error' when 2 then 'purchase'
                               when 3 then 'signup' else 'view' end as symbol,
               date '2024-01-01' + cast((doc_id // 5) % 30 as int) as date
        from documents)""",
    "segnews": """news as (
        select doc_id, text as article,
               case doc_id % 5 when 0 then 'AUTOMOBILE' when 1 then 'BUILDING' when 2 then 'FURNITURE'
                               when 3 then 'HOUSEHOLD' else 'MACHINERY' end as symbol,
               date '1996-01-01' + cast((doc_id // 5) % 730 as int) as date
        from documents)""",
    "changes": f"""moved as (
        select symbol, date,
               (adjclose - lag(adjclose) over w) / nullif(lag(adjclose) over w, 0) * 100 as price_percent_change,
               cast(volume - lag(volume) over w as double) / nullif(lag(volume) over w, 0) * 100
                   as volume_percent_change
        from prices window w as (partition by symbol order by date)),
    changes as (
        select *, lead(price_percent_change) over (partition by symbol order by date) as {_T}
        from moved)""",
    "known": f"""known as (
        select * from changes
        where price_percent_change is not null and volume_percent_change is not null and {_T} is not null)""",
    "sents": """sents as (
        select doc_id, cast(g - 1 as int) as sent_id, parts[g] as sentence
        from (select doc_id, string_split(regexp_replace(article, '([.!?])[ \\t\\n\\f\\r]+', '\\1' || chr(1), 'g'), chr(1)) as parts
              from news) s, unnest(range(1, len(parts) + 1)) as r(g)
        where parts[g] <> '')""",
    "toks": """toks as (
        select doc_id, sent_id, cast(g - 1 as int) as pos, words[g] as token
        from (select doc_id, sent_id, regexp_extract_all(lower(sentence), '[a-z]+') as words from sents) s,
             unnest(range(1, len(words) + 1)) as r(g))""",
    "lemtoks": """toks as (
        select doc_id, sent_id, pos, coalesce(lemma, token) as token
        from plain left join lemma on token = form)""",
    "hits": """grams as (
        select doc_id, sent_id, pos, token as t1,
               token || ' ' || lead(token, 1) over w as t2,
               token || ' ' || lead(token, 1) over w || ' ' || lead(token, 2) over w as t3,
               token || ' ' || lead(token, 1) over w || ' ' || lead(token, 2) over w || ' ' || lead(token, 3) over w as t4
        from toks window w as (partition by doc_id, sent_id order by pos)),
    found as (
        select doc_id, sent_id, pos, 1 as n, class, term from grams join lexicon on t1 = term
        union all select doc_id, sent_id, pos, 2, class, term from grams join lexicon on t2 = term
        union all select doc_id, sent_id, pos, 3, class, term from grams join lexicon on t3 = term
        union all select doc_id, sent_id, pos, 4, class, term from grams join lexicon on t4 = term),
    longest as (
        select * from (select *, row_number() over (partition by doc_id, sent_id, pos order by n desc) as rn
                       from found) f where rn = 1),
    free as (
        select *, max(pos + n - 1) over (partition by doc_id, sent_id order by pos
                                         range between 3 preceding and 1 preceding) as taken
        from longest),
    hits as (select doc_id, sent_id, pos, n, class, term from free where taken is null or taken < pos)""",
    "sentscores": """ranked as (
        select *, case class when 'increment' then 2.0 when 'decrement' then 0.5 when 'revert' then -1.0 end as f
        from hits),
    before as (
        select *, lag(f, 1) over w as f1, lag(f, 2) over w as f2
        from ranked window w as (partition by doc_id, sent_id order by pos)),
    sentscores as (
        select doc_id, sent_id, sum(case class when 'positive' then 1.0 when 'negative' then -1.0 end
                   * coalesce(f1, 1.0) * case when f1 is null then 1.0 else coalesce(f2, 1.0) end) as total
        from before where class in ('positive', 'negative') group by 1, 2)""",
    "dictscores": """dictscores as (
        select news.doc_id, symbol, date, cast(coalesce(sum(total), 0) as double) as sentiment_score
        from news left join sentscores on news.doc_id = sentscores.doc_id group by 1, 2, 3)""",
    "valued": """words as (select doc_id, unnest(regexp_extract_all(lower(article), '[a-z]+')) as token from news),
    sums as (select doc_id, cast(sum(valence) as double) as total from words join lexicon on token = term group by 1),
    valued as (
        select news.doc_id, symbol, date, coalesce(total, 0.0) as afinn_sentiment
        from news left join sums on news.doc_id = sums.doc_id)""",
    "daily": """daily as (
        select v.symbol, v.date, avg(afinn_sentiment) as afinn_sentiment_mean,
               avg(sign(sentiment_score)) as pnn_sentiment,
               sum(afinn_sentiment) as afinn_sentiment_sum, cast(sum(sign(sentiment_score)) as bigint) as pnn_sum
        from valued v join dictscores d on v.doc_id = d.doc_id group by 1, 2)""",
    "scores": """scores as (
        select symbol, date,
               coalesce(afinn_sentiment_mean / nullif(stddev_samp(afinn_sentiment_mean) over (partition by symbol), 0), 0)
                   as afinn_sentiment,
               pnn_sentiment
        from daily)""",
    "features": f"""features as (
        select s.symbol, s.date, afinn_sentiment, pnn_sentiment, price_percent_change, volume_percent_change, {_T}
        from scores s join known k on s.symbol = k.symbol and s.date = k.date)""",
    "split": """numbered as (
        select *, row_number() over (partition by symbol order by date) as rn,
               count(*) over (partition by symbol) as total
        from known),
    parts as (select *, case when rn <= floor(total * 0.8::double) then 'train' else 'test' end as split from numbered)""",
    "forecast": f"forecast as (select symbol, date, {_T} as label, price_percent_change as prediction from known)",
    "calls": """calls as (
        select symbol, date, case when label > 0 then 1 else 0 end as label,
               case when prediction > 0 then 1 else 0 end as prediction, prediction as score from forecast)""",
}

_SCORED = "lexicon sents toks hits sentscores dictscores valued daily scores"
_FEATURES = f"prices changes known news {_SCORED} features"
_SEGMENT_FEATURES = f"segprices changes known segnews {_SCORED} features"

_ROUNDED_CHANGES = f"""select symbol, date, round(price_percent_change, 4) as price_percent_change,
    round(volume_percent_change, 4) as volume_percent_change, round({_T}, 4) as {_T}"""
_ROUNDED_FEATURES = f"""select symbol, date, round(afinn_sentiment, 4) as afinn_sentiment,
    round(pnn_sentiment, 4) as pnn_sentiment, round(price_percent_change, 4) as price_percent_change,
    round(volume_percent_change, 4) as volume_percent_change, round({_T}, 4) as {_T}"""


def _sql(parts: str, body: str) -> str:
    return "with " + ",\n".join(PARTS[p] for p in parts.split()) + "\n" + body


def _session(date: str) -> str:
    return f"{date} + case dayofweek({date}) when 5 then 3 when 6 then 2 else 1 end"


_LABEL = "case when sentiment_score > 0 then 'positive' when sentiment_score < 0 then 'negative' else 'neutral' end"
PARTS["plain"] = PARTS["toks"].replace("toks as", "plain as", 1)
PARTS["filled"] = f"""filled as (
        select s.symbol, s.date, afinn_sentiment, pnn_sentiment, price_percent_change, volume_percent_change,
               coalesce({_T}, 0) as {_T}
        from scores s join changes k on s.symbol = k.symbol and s.date = k.date
        where price_percent_change is not null and volume_percent_change is not null)"""
PARTS["rawnews"] = """rawnews as (
        select n.doc_id, n.symbol, n.date, d.source, length(n.article) as n_chars,
               cast(floor((n.date - date '2024-01-01') / 3) as int) as bucket
        from news n join documents d on n.doc_id = d.doc_id)"""
PARTS["span"] = "span as (select symbol, min(date) as a, max(date) as b from news group by 1)"
PARTS["cutprices"] = PARTS["segprices"].replace("prices as", "allprices as", 1)
PARTS["inspan"] = """prices as (
        select p.* from allprices p join span s on p.symbol = s.symbol where date between a and b)"""
PARTS["knn"] = f"""labelled as (
        select *, case when {_T} > 0 then 1 else 0 end as label,
               row_number() over (partition by symbol order by date) as rn,
               count(*) over (partition by symbol) as total
        from features),
    train as (select * from labelled where rn <= floor(total * 0.8::double)),
    test as (select * from labelled where rn > floor(total * 0.8::double)),
    pairs as (
        select t.symbol, t.date, t.label, r.label as vote,
               row_number() over (partition by t.symbol, t.date order by
                   (r.afinn_sentiment - t.afinn_sentiment) ** 2 + (r.pnn_sentiment - t.pnn_sentiment) ** 2
                   + (r.price_percent_change - t.price_percent_change) ** 2
                   + (r.volume_percent_change - t.volume_percent_change) ** 2, r.date) as near
        from test t join train r on t.symbol = r.symbol),
    votes as (select symbol, date, label, vote, count(*) as n from pairs where near <= 7 group by 1, 2, 3, 4),
    best as (select *, row_number() over (partition by symbol, date order by n desc, vote) as place from votes)"""
PARTS["sse"] = """batched as (
        select *, (row_number() over (partition by symbol order by date) - 1) // 32 as batch_id from forecast),
    perbatch as (
        select symbol, batch_id, 1 - sum((label - prediction) ** 2) / nullif(var_pop(label) * count(*), 0) as r2
        from batched group by 1, 2)"""
_COLUMNS = ["afinn_sentiment", "pnn_sentiment", "price_percent_change", "volume_percent_change", _T]

ORACLE = {
    "price_features": _sql("prices changes", f"{_ROUNDED_CHANGES} from changes"),
    "segment_price_features": _sql("segprices changes", f"{_ROUNDED_CHANGES} from changes"),
    "price_return_fraction": _sql(
        "prices",
        """select symbol, date, round((adjclose - lag(adjclose) over w) / nullif(lag(adjclose) over w, 0), 4) as p_return
        from prices window w as (partition by symbol order by date)""",
    ),
    "price_span_restricted": _sql(
        "segprices changes segnews span",
        f"{_ROUNDED_CHANGES} from changes join span using (symbol) where date between a and b",
    ),
    "price_span_cut_before": _sql("cutprices segnews span inspan changes", f"{_ROUNDED_CHANGES} from changes"),
    "next_session": _sql(
        "segprices",
        f"""select symbol, date, next_session, strftime(next_session, '%B') as month
        from (select symbol, date, cast({_session('date')} as date) as next_session from prices) d""",
    ),
    "news_date_parse": _sql(
        "news",
        """select doc_id, published,
            cast(strptime(substr(published, 6, 11), '%d %b %Y') as date) as published_date
        from (select doc_id, strftime(date, '%a, %d %b %Y') || ' 07:00:00 GMT' as published from news) n""",
    ),
    "news_shape": _sql(
        "news rawnews",
        """select doc_id, symbol, source as publisher, 'https://' || source as publisher_url, date, bucket,
            window_start, window_start + 2 as window_end, ordinal,
            symbol || '_' || strftime(window_start, '%d-%B-%Y') || '-' || strftime(window_start + 2, '%d-%B-%Y')
                || '_' || ordinal || '.json' as file_name, n_chars
        from (select *, date '2024-01-01' + bucket * 3 as window_start,
                     row_number() over (partition by symbol, bucket order by date, doc_id) as ordinal
              from rawnews) r""",
    ),
    "article_numbers": _sql(
        "news rawnews",
        """select doc_id, symbol, bucket,
            row_number() over (partition by symbol, bucket order by date, doc_id) as ordinal from rawnews""",
    ),
    "fetch_window_days": _sql(
        "segnews span",
        """select symbol, cast(g as int) as bucket, a + cast(g * 3 as int) as window_start,
            a + cast(g * 3 + 2 as int) as window_end
        from span, unnest(range(0, (b - a) // 3 + 1)) as r(g)""",
    ),
    "news_landing": _sql(
        "news",
        "select symbol, date, count(*) as articles, cast(sum(length(article)) as bigint) as n_chars from news group by 1, 2",
    ),
    "sentences": _sql("news sents", "select doc_id, sent_id, sentence from sents"),
    "tokens_count": _sql(
        "news sents toks",
        "select doc_id, count(*) as tokens, max(sent_id) as last_sentence from toks group by 1",
    ),
    "lemmas": _sql("news lemma sents plain lemtoks", "select token, count(*) as uses from toks group by 1"),
    "ngrams_count": _sql(
        "news sents toks",
        """, sizes as (select doc_id, sent_id, count(*) as words from toks group by 1, 2)
        select cast(n as int) as n, cast(sum(greatest(words - n + 1, 0)) as bigint) as grams
        from sizes, unnest(range(1, 5)) as r(n) group by 1""",
    ),
    "ngram_hits": _sql("news lexicon sents toks hits", "select doc_id, sent_id, pos, n, term from hits"),
    "article_sentences": _sql(
        "news sents",
        "select doc_id, symbol, date, sent_id, length(sentence) as n_chars from news join sents using (doc_id)",
    ),
    "explode_embeddings": _sql(
        "news sents",
        """, quarters as (
            select vec_id as doc_id, cast(g as int) as sent_id, embedding[g * 16 + 1] as first_value
            from embeddings, unnest(range(0, 4)) as r(g) where vec_id in (select doc_id from news)),
        kept as (select * from sents)
        select coalesce(k.doc_id, q.doc_id) as doc_id, coalesce(k.sent_id, q.sent_id) as sent_id,
            length(sentence) as n_chars, round(cast(first_value as double), 4) as first_value
        from kept k full join quarters q on k.doc_id = q.doc_id and k.sent_id = q.sent_id""",
    ),
    "valence_score": _sql("news lexicon valued", "select doc_id, afinn_sentiment from valued"),
    "dictionary_sentiment": _sql(
        "news lexicon sents toks hits sentscores dictscores",
        f"select doc_id, sentiment_score, {_LABEL} as sentiment from dictscores",
    ),
    "dictionary_sentiment_lemmas": _sql(
        "news lexicon lemma sents plain lemtoks hits sentscores dictscores",
        f"select doc_id, sentiment_score, {_LABEL} as sentiment from dictscores",
    ),
    "sentence_labels": _sql(
        "news lexicon sents toks hits sentscores",
        f""", labelled as (
            select distinct s.doc_id, {_LABEL.replace('sentiment_score', 'coalesce(total, 0)')} as label
            from sents s left join sentscores c on s.doc_id = c.doc_id and s.sent_id = c.sent_id)
        select news.doc_id, coalesce(string_agg(label, ',' order by label), '') as sentiment
        from news left join labelled on news.doc_id = labelled.doc_id group by 1""",
    ),
    "pnn_score": _sql(
        "news lexicon sents toks hits sentscores dictscores",
        "select doc_id, cast(sign(sentiment_score) as int) as pnn_sentiment from dictscores",
    ),
    "wordlist_polarity": _sql(
        "news wordlist",
        """, counts as (
            select doc_id, count(*) filter (class = 'p') as p, count(*) filter (class = 'n') as n
            from (select doc_id, unnest(regexp_split_to_array(trim(lower(article)), '\\s+')) as word from news) w
            join wordlist using (word) group by 1)
        select news.doc_id, round(coalesce(cast(p - n as double) / greatest(p + n, 1), 0), 4) as sentiment_score
        from news left join counts on news.doc_id = counts.doc_id""",
    ),
    "daily_sentiment": _sql(
        f"news {_SCORED}",
        """select symbol, date, round(afinn_sentiment_mean, 4) as afinn_sentiment_mean,
            round(pnn_sentiment, 4) as pnn_sentiment from daily""",
    ),
    "daily_sentiment_sum": _sql(
        f"news {_SCORED}",
        "select symbol, date, round(afinn_sentiment_sum, 4) as afinn_sentiment_sum, pnn_sum as pnn_sentiment from daily",
    ),
    "scaled_sentiment": _sql(
        f"news {_SCORED}",
        """select symbol, date, round(afinn_sentiment, 4) as afinn_sentiment,
            round(pnn_sentiment, 4) as pnn_sentiment from scores""",
    ),
    "minmax_sentiment": _sql(
        "news lexicon valued",
        """select doc_id, round(coalesce((afinn_sentiment - min(afinn_sentiment) over w)
            / nullif(max(afinn_sentiment) over w - min(afinn_sentiment) over w, 0), 0.5) * 2 - 1, 4) as minmax
        from valued window w as (partition by symbol)""",
    ),
    "div_to_max": _sql(
        "news lexicon valued",
        """select doc_id, round(afinn_sentiment / nullif(max(afinn_sentiment) over (partition by symbol), 0), 4) as share
        from valued""",
    ),
    "article_scaling_daily_sum": _sql(
        "news lexicon valued",
        """, fit as (
            select min(afinn_sentiment) as lo, max(afinn_sentiment) as hi, avg(afinn_sentiment) as mean,
                   stddev_pop(afinn_sentiment) as std from valued)
        select date, round(sum(afinn_sentiment), 3) as afinn_sentiment,
            round(sum((afinn_sentiment - lo) / (hi - lo) * 2 - 1), 3) as min_max_afinn,
            round(sum((afinn_sentiment - mean) / std), 3) as std_afinn,
            round(sum(afinn_sentiment / hi), 3) as div_to_max
        from valued, fit group by 1""",
    ),
    "feature_table_inner": _sql(_FEATURES, f"{_ROUNDED_FEATURES} from features"),
    "feature_table_right": _sql(_FEATURES, f"{_ROUNDED_FEATURES} from features"),
    "feature_table_inference": _sql(f"prices changes news {_SCORED} filled", f"{_ROUNDED_FEATURES} from filled"),
    "segment_feature_table": _sql(_SEGMENT_FEATURES, f"{_ROUNDED_FEATURES} from features"),
    "feature_files": _sql(_FEATURES, f"{_ROUNDED_FEATURES} from features"),
    "price_files": _sql(
        "segprices",
        """select symbol, date, round(adjclose, 6) as adjclose, volume from prices
        where symbol in ('BUILDING', 'MACHINERY') and date between date '1996-01-01' and date '1997-12-31'""",
    ),
    "resolve_symbol": _sql(
        "ticker", "select event_id, company, ticker as symbol from events join ticker on event_type = company"
    ),
    "unknown_companies": _sql(
        "ticker",
        """select distinct company from (
            select event_type as company from events union all select c_mktsegment from customer) c
        where company not in (select company from ticker)""",
    ),
    "chrono_split": _sql("segprices changes known split", "select symbol, date, split from parts"),
    "three_way_split": _sql(
        "segprices changes known split",
        """select symbol, date, case when rn <= floor(floor(total * 0.9::double) * 0.9::double) then 'train'
            when rn <= floor(total * 0.9::double) then 'valid' else 'test' end as split from numbered""",
    ),
    "except_split": """with days as (
            select o_orderpriority as symbol, cast(o_orderdate as date) as date, count(*) as orders
            from orders group by 1, 2),
        numbered as (
            select *, row_number() over (partition by symbol order by date) as rn,
                   count(*) over (partition by symbol) as total from days),
        train as (select symbol, date, orders from numbered where rn <= floor(total * 0.8::double))
        select *, 'train' as split from train
        union all
        select *, 'test' as split from (select * from days except select * from train) t""",
    "label_gt0": _sql(
        "segprices changes known", f"select symbol, date, case when {_T} > 0 then 1 else 0 end as label from known"
    ),
    "label_ge0": _sql(
        "segprices changes known",
        "select symbol, date, case when price_percent_change < 0 then 0 else 1 end as label from known",
    ),
    "volume_zscore": _sql(
        "segprices changes known split",
        """, fit as (
            select symbol, avg(volume_percent_change) as mean, stddev_samp(volume_percent_change) as std
            from parts where split = 'train' group by 1)
        select symbol, date, round(coalesce((volume_percent_change - mean) / nullif(std, 0), 0), 4) as volume_z
        from parts join fit using (symbol)""",
    ),
    "volume_zscore_all_rows": _sql(
        "segprices changes known",
        """select symbol, date, round((volume_percent_change - avg(volume_percent_change) over ())
            / stddev_samp(volume_percent_change) over (), 4) as volume_z from known""",
    ),
    "sequences": _sql(
        "segprices changes known split",
        f"""select t.symbol, t.date, round(t.{_T}, 4) as target, cast(r.rn - t.rn + 10 as int) as step,
            f.feature, round(case f.feature when 0 then r.price_percent_change else r.volume_percent_change end, 4) as value
        from numbered t
        join numbered r on t.symbol = r.symbol and r.rn between t.rn - 10 and t.rn - 1
        cross join (values (0), (1)) f(feature)
        where t.rn > 10""",
    ),
    "latest_row": _sql(
        f"prices changes news {_SCORED} filled",
        f"""{_ROUNDED_FEATURES} from (
            select *, row_number() over (partition by symbol order by date desc) as rn from filled) f where rn = 1""",
    ),
    "trend_calls": _sql(
        "segprices changes",
        f"""select symbol, date, cast({_session('date')} as date) as next_session,
            case when price_percent_change > 0 then 'bullish' else 'bearish' end as trend
        from (select *, row_number() over (partition by symbol order by date desc) as rn from changes) c where rn = 1""",
    ),
    "class_balance": _sql(
        "segprices changes known",
        f"select case when {_T} > 0 then 1 else 0 end as label, count(*) as count from known group by 1",
    ),
    "correlation_matrix": _sql(
        _SEGMENT_FEATURES,
        " union all ".join(
            f"select '{a}' as col_a, '{b}' as col_b, round(corr({a}, {b}), 4) as corr from features"
            for a in _COLUMNS
            for b in _COLUMNS
        ),
    ),
    "linear_fit_1d": _sql(
        "segprices changes known",
        f"""select symbol, round(regr_slope({_T}, price_percent_change), 4) as slope,
            round(regr_intercept({_T}, price_percent_change), 4) as intercept,
            round(regr_r2({_T}, price_percent_change), 4) as r2 from known group by 1""",
    ),
    "regression_metrics": _sql(
        "segprices changes known forecast",
        """select symbol, round(sqrt(avg((label - prediction) ** 2)), 4) as rmse,
            round(1 - sum((label - prediction) ** 2) / nullif(var_pop(label) * count(*), 0), 4) as r2
        from forecast group by 1""",
    ),
    "classification_metrics": _sql(
        "segprices changes known forecast calls",
        """select symbol, count(*) as rows, round(avg(case when label = prediction then 1.0 else 0.0 end), 4) as accuracy
        from calls group by 1""",
    ),
    "auc": _sql(
        "segprices changes known forecast calls",
        """, placed as (
            select symbol, label, rank() over (partition by symbol order by score) as low,
                   count(*) over (partition by symbol, score) as ties from calls)
        select symbol, round((sum(case when label = 1 then low + (ties - 1) / 2.0 end)
            - sum(label) * (sum(label) + 1) / 2.0) / (sum(label) * (count(*) - sum(label))), 4) as auc
        from placed group by 1""",
    ),
    "batched_r2": _sql(
        "segprices changes known forecast sse",
        """, whole as (
            select symbol, 1 - sum((label - prediction) ** 2) / nullif(var_pop(label) * count(*), 0) as r2
            from forecast group by 1)
        select p.symbol, count(*) as batches, round(avg(p.r2), 4) as mean_batch_r2, round(any_value(w.r2), 4) as r2
        from perbatch p join whole w on p.symbol = w.symbol group by 1""",
    ),
    "batched_accuracy": _sql(
        "segprices changes known forecast calls",
        """, batched as (
            select symbol, case when label = prediction then 1.0 else 0.0 end as ok,
                   (row_number() over (partition by symbol order by date) - 1) // 32 as batch_id from calls),
        perbatch as (select symbol, batch_id, avg(ok) as a, count(*) as n, sum(ok) as s from batched group by 1, 2)
        select symbol, count(*) as batches, round(avg(a), 4) as mean_batch_accuracy,
            round(sum(s) / sum(n), 4) as accuracy from perbatch group by 1""",
    ),
    "knn_vote": _sql(
        f"{_SEGMENT_FEATURES} knn", "select symbol, date, label, vote as prediction from best where place = 1"
    ),
    "stream_daily_sentiment": _sql(
        f"news {_SCORED}",
        """select symbol, date, round(afinn_sentiment_mean, 4) as afinn_sentiment_mean,
            round(pnn_sentiment, 4) as pnn_sentiment from daily""",
    ),
}

ORACLE["metric_files"] = ORACLE["classification_metrics"]
ORACLE["volume_zscore_stages"] = ORACLE["volume_zscore_all_rows"]
ORACLE["sample_arrays"] = _sql(
    "segprices changes known",
    f"""select symbol, date, round({_T}, 4) as label, feature,
        round(case feature when 0 then price_percent_change else volume_percent_change end, 4) as value
    from known cross join (values (0), (1)) f(feature)""",
)

ORACLE["valence_score_large"] = _sql("news corpuswords largelexicon valued", "select doc_id, afinn_sentiment from valued")
ORACLE["dictionary_sentiment_large"] = _sql(
    "news corpuswords largelexicon sents toks hits sentscores dictscores",
    f"select doc_id, sentiment_score, {_LABEL} as sentiment from dictscores",
)
ORACLE["wordlist_large"] = ORACLE["wordlist_polarity"].replace(PARTS["wordlist"], f"{PARTS['corpuswords']}, {PARTS['largewordlist']}")
ORACLE["lemmas_large"] = ORACLE["lemmas"].replace(PARTS["lemma"], f"{PARTS['corpuswords']}, {PARTS['largelemma']}")
ORACLE["article_files"] = _sql(
    "news",
    """select symbol, date, count(article) as articles, cast(sum(length(article)) as bigint) as n_chars,
        min('Article ' || doc_id) as first_title from news group by 1, 2""",
)
ORACLE["header_files"] = _sql(_FEATURES, f"{_ROUNDED_FEATURES} from features").replace("select symbol, date, round", "select date, round")
# Scored is the whole text, read under another name.
ORACLE["title_score"] = _sql(
    "news lexicon sents toks hits sentscores dictscores valued",
    """select v.doc_id, v.afinn_sentiment, cast(sign(sentiment_score) as int) as pnn_sentiment
    from valued v join dictscores d on v.doc_id = d.doc_id""",
)
# The stream's last call of a symbol is for its latest day with a price change and articles.
ORACLE["stream_trend_days"] = _sql(
    "segprices changes segnews",
    f"""select symbol, date, cast({_session('date')} as date) as next_session,
        strftime(cast({_session('date')} as date), '%B') as month, 'with' as sentiment
    from (select symbol, max(date) as date from news join changes using (symbol, date)
          where price_percent_change is not null and volume_percent_change is not null group by 1) d""",
)

# The split of the segment features, as the models see it.
PARTS["fsplit"] = """fnumbered as (
        select *, row_number() over (partition by symbol order by date) as rn, count(*) over (partition by symbol) as total
        from features),
    parts as (select *, case when rn <= floor(total * 0.8::double) then 'train' else 'test' end as split from fnumbered)"""
_INPUTS = ["afinn_sentiment", "pnn_sentiment", "price_percent_change", "volume_percent_change"]


def _label_moments(label: str) -> str:
    cells = [f"select 'one' as input, round(avg({label}), 2) as moment from parts where split = 'train'"]
    cells += [f"select '{c}', round(avg({c} * {label}), 2) from parts where split = 'train'" for c in _INPUTS]
    return " union all ".join(cells)


_UP = f"case when {_T} > 0 then 1.0 else 0.0 end"
ORACLE["linear_moments"] = _sql(f"{_SEGMENT_FEATURES} fsplit", _label_moments(_T))
ORACLE["logistic_moments"] = _sql(f"{_SEGMENT_FEATURES} fsplit", _label_moments(_UP))
ORACLE["classifier_checks"] = _sql(
    f"{_SEGMENT_FEATURES} fsplit",
    f"""select model, split, count(*) as rows, cast(sum({_UP}) as bigint) as ups, count(*) as same_calls
    from parts, (values ('SVM'), ('RandomForest'), ('GradientBoosting')) m(model) group by 1, 2""",
)
ORACLE["experiment_rows"] = _sql(
    f"{_SEGMENT_FEATURES} fsplit",
    f"""select model, symbol as stock, emotion, count(*) as rows, cast(sum({_UP}) as bigint) as ups,
        round(greatest(avg({_UP}), 1 - avg({_UP})), 4) as constant_accuracy
    from parts, (values ('LinearRegression'), ('LogisticRegression')) m(model), (values ('False'), ('True')) e(emotion)
    where split = 'test' group by 1, 2, 3""",
)
ORACLE["sequence_moments"] = _sql(
    f"{_SEGMENT_FEATURES} fsplit",
    f"""select cast((r.rn - t.rn + 10) * 4 + f.place as int) as input,
        round(avg(t.price_percent_change * case f.place when 0 then r.{_INPUTS[0]} when 1 then r.{_INPUTS[1]}
            when 2 then r.{_INPUTS[2]} else r.{_INPUTS[3]} end), 2) as moment
    from parts t join parts r on t.symbol = r.symbol and r.rn between t.rn - 10 and t.rn - 1
    cross join (values (0), (1), (2), (3)) f(place)
    where t.rn > 10 and t.split = 'train' group by 1""",
).replace("floor(total * 0.8::double)", "floor(total * 0.9::double)")
ORACLE["history_files"] = """select name, 'test_accuracy' as metric, 5 as rounds, true as loss_falls
    from (values ('segments_emotion_False'), ('segments_emotion_True')) v(name)"""

ORACLE["price_span_files"] = ORACLE["price_span_restricted"]
ORACLE["ordered_files"] = _sql(
    "segprices", "select row_number() over (order by date, symbol) - 1 as position, symbol, date, volume from prices"
)

# Models as tables, walked and multiplied row by row.
PARTS["nodes"] = f"nodes(tree, weight, node, feature, threshold, lft, rgt, down, up) as (values {_values(SAMPLE_TREES)})"
ORACLE["tree_scores"] = _sql(
    f"{_SEGMENT_FEATURES} nodes",
    """, walk as (
        select symbol, date, tree, 0 as node from features, (select distinct tree from nodes) t
        union all
        select w.symbol, w.date, tree,
            case when (case n.feature when 0 then afinn_sentiment when 1 then pnn_sentiment when 2 then price_percent_change
                else volume_percent_change end) <= n.threshold then n.lft else n.rgt end
        from walk w join nodes n using (tree, node) join features f on f.symbol = w.symbol and f.date = w.date
        where n.feature >= 0),
    voted as (
        select symbol, date, sum(weight * down) as down, sum(weight * up) as up
        from walk join nodes using (tree, node) where feature < 0 group by 1, 2)
    select symbol, date, round(down, 4) as down, round(up, 4) as up, cast(up > down as int) as prediction from voted""",
).replace("with ", "with recursive ", 1)
PARTS["weights"] = f"weights(layer, unit, input, weight) as (values {_values(SAMPLE_PERCEPTRON)})"
ORACLE["perceptron_scores"] = _sql(
    f"{_SEGMENT_FEATURES} weights",
    """, inputs as (
        select symbol, date, -1 as input, 1.0 as x from features union all select symbol, date, 0, afinn_sentiment from features
        union all select symbol, date, 1, pnn_sentiment from features
        union all select symbol, date, 2, price_percent_change from features
        union all select symbol, date, 3, volume_percent_change from features),
    hidden as (
        select symbol, date, unit as input, 1 / (1 + exp(-sum(weight * x))) as x
        from inputs join weights using (input) where layer = 0 group by 1, 2, 3
        union all select symbol, date, -1, 1.0 from features),
    outputs as (
        select symbol, date, unit, exp(sum(weight * x)) as e from hidden join weights using (input) where layer = 1 group by 1, 2, 3)
    select symbol, date, round(sum(e) filter (unit = 0) / sum(e), 4) as down, round(sum(e) filter (unit = 1) / sum(e), 4) as up
    from outputs group by 1, 2""",
)
_LINEAR = " + ".join(
    f"({c})" if not name else f"({c}) * ({name} - ({mean})) / {dev}" for name, mean, dev, c in SAMPLE_LINEAR
)
ORACLE["linear_calls"] = _sql(
    f"segprices changes segnews {_SCORED} filled",
    f"""select symbol, date, cast({_session('date')} as date) as next_session, 'with' as sentiment,
        case when {_LINEAR} > 0 then 'bullish' else 'bearish' end as trend
    from (select *, row_number() over (partition by symbol order by date desc) as rn from filled) f where rn = 1""",
)
ORACLE["stream_linear_calls"] = ORACLE["linear_calls"]
# A landing keeps what is less than three days older than the newest day of the landings before it.
ORACLE["stream_late_articles"] = _sql(
    "news",
    """, landed as (
        select symbol, date, least((date - date '2024-01-01') // 5 + case when doc_id % 7 = 3 then 2 else 0 end, 5) as landing from news),
    newest as (select landing, max(date) as day from landed group by 1),
    judged as (
        select symbol, date, coalesce(date > (select max(day) from newest n where n.landing < l.landing) - 3, true) as ok from landed l)
    select symbol, date, count(*) filter (ok) as kept, count(*) filter (not ok) as dropped from judged group by 1, 2""",
)
