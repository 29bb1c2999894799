"""Operators 11 to 13 against brute force, and on the cases every operator must bear."""

import itertools
import random

import numpy as np
import pytest
from frames import documents
from pyspark.sql import functions as F

from tickermood.llm import queries, source_divergence, suffix_dedup, whitening


# -- suffix-array dedup --------------------------------------------------------------


@pytest.mark.parametrize("modulus", suffix_dedup.COVERS)
def test_every_residue_is_a_difference_of_the_cover(modulus):
    members = suffix_dedup.COVERS[modulus]
    assert {(a - b) % modulus for a in members for b in members} == set(range(modulus))


def brute_repeats(rows, window):
    """(id, bytes, spans, kept) with every window in a set."""
    ordered = sorted(((i, (t or "").encode()) for i, t in rows), key=lambda r: (r[0] is None, r[0] or 0))
    seen, out = set(), []
    for doc_id, text in ordered:
        gone = np.zeros(len(text), bool)
        for at in range(len(text) - window + 1):
            if text[at : at + window] in seen:
                gone[at : at + window] = True
            seen.add(text[at : at + window])
        runs, at = [], 0
        for marked, some in itertools.groupby(gone.tolist()):
            size = len(list(some))
            runs += [(at, at + size)] if marked else []
            at += size
        kept = bytes(b for b, g in zip(text, gone) if not g)
        out.append((doc_id, len(text), tuple(runs), kept))
    return out


def found_repeats(df, **options):
    rows = suffix_dedup.without_repeats(df, **options).collect()
    return [(r.doc_id, r.n_bytes, tuple((s.start, s.end) for s in r.spans), bytes(r.kept)) for r in rows]


def _order(row):
    return (row[0] is None, row[0] or 0, *row[1:])


def passages(seed, n_docs):
    """Documents made of shared passages, own letters and doubled texts."""
    rnd = random.Random(seed)
    letters = "abcdefgh ü"
    shared = ["".join(rnd.choices(letters, k=k)) for k in (60, 99, 100, 101, 140, 300, 700)]
    rows = []
    for doc in range(n_docs):
        parts = [
            rnd.choice(shared) if rnd.random() < 0.5 else "".join(rnd.choices(letters, k=rnd.randrange(200)))
            for _ in range(rnd.randrange(7))
        ]
        text = "".join(parts)
        rows.append((doc * 3, text * 2 if rnd.random() < 0.2 else text))
    same = [(1000, None), (1001, ""), (1002, "a" * 1000), (1003, rows[5][1]), (1004, rows[5][1][3:-1]), (None, rows[7][1])]
    return rows + same


@pytest.mark.parametrize("window, block_bytes, hot", [(100, 4000, 256), (100, 1 << 20, 256), (20, 3000, 2), (100, 1500, 1)])
def test_repeats_against_brute_force(spark, monkeypatch, window, block_bytes, hot):
    """Also where each rank counts as hot and is split by its surroundings."""
    monkeypatch.setattr(suffix_dedup, "HOT_BLOCKS", hot)
    rows = passages(window + block_bytes, 80)
    df = spark.createDataFrame(random.Random(1).sample(rows, len(rows)), "doc_id long, text string").repartition(3)
    found = found_repeats(df, window=window, block_bytes=block_bytes)
    assert sorted(found, key=_order) == sorted(brute_repeats(rows, window), key=_order)


def test_all_cases_lose_what_is_repeated(spark):
    docs = documents(spark)
    found = found_repeats(docs)
    assert len(found) == docs.count()
    expected = brute_repeats([(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()], 100)
    assert sorted(found, key=_order) == sorted(expected, key=_order)
    assert found_repeats(documents(spark, rows=[])) == []


def test_short_windows_are_refused():
    with pytest.raises(ValueError):
        suffix_dedup.Cover.of(10)


def test_texts_are_joined_with_their_marks_without_a_shuffle(spark):
    """Bucketed by block, only the marks move."""
    docs = spark.range(500).select(F.col("id").alias("doc_id"), F.repeat(F.sha2(F.col("id").cast("string"), 512), 3).alias("text"))
    blocks = suffix_dedup.blocks_of(docs, suffix_dedup.Cover.of(100), 2000)
    marks = spark.range(10).select(F.col("id").alias("block_id"), F.lit(1).alias("kind"), F.lit(b"").alias("places"))
    with_join = suffix_dedup.with_marks(blocks.hint("merge"), marks, "left")
    plan = with_join._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan


# -- whitening -----------------------------------------------------------------------


def vectors(spark, rows):
    schema = "vec_id long, embedding array<float>, label int, x string, n string"
    return spark.createDataFrame([(i, v, 1, "x", "n") for i, v in rows], schema)


def brute_whitening(rows, most=8):
    x = np.floor(1024 * np.array(rows, np.float32).astype(float)) + 100_000
    n, mean = len(x), x.mean(0)
    cov = (x - mean).T @ (x - mean) / n
    eigen, axes = np.linalg.eigh(cov)
    order = np.argsort(-eigen)[:most]
    return n, (x - mean) @ axes[:, order] / np.sqrt(eigen[order]), eigen[order] / np.trace(cov), x


def test_whitening_against_eigenvectors(spark):
    rng = np.random.default_rng(3)
    rows = (rng.normal(size=(300, 12)) @ rng.normal(size=(12, 12)) * np.geomspace(10, 0.01, 12)).astype(np.float32)
    df = vectors(spark, [(i, r.tolist()) for i, r in enumerate(rows)]).repartition(3)
    found = whitening.whitened(df).orderBy("vec_id", "component").collect()
    n, expected, explained, x = brute_whitening(rows)
    assert len(found) == 300 * 8 and {r.n for r in found} == {n}
    got = np.array([r.whitened for r in found]).reshape(300, 8)
    sign = np.sign((got * expected).sum(0))
    assert np.abs(got * sign - expected).max() < 1e-6
    assert np.allclose([r.explained for r in found[:8]], explained, rtol=1e-9)
    assert max(r.identity_error for r in found) < 1e-9
    whole = x.astype(object)
    deviations = ((n * whole - whole.sum(0)) ** 2).sum(1)
    assert [r.deviation for r in found[::8]] == deviations.tolist()


def test_whitening_of_few_dimensions_and_broken_rows(spark):
    nan, inf = float("nan"), float("inf")
    broken = [(90, None), (91, [1.0, None]), (92, [nan, 1.0]), (93, [inf, 1.0]), (94, []), (95, [1.0, 2.0, 3.0])]
    good = [(1, [1.0, 5.0]), (1, [1.0, 5.0]), (None, [3.0, 5.0]), (4, [2.0, 5.0])]
    found = whitening.whitened(vectors(spark, broken + good)).collect()
    # The second dimension is constant: one component, which explains all.
    assert sorted(r.vec_id for r in found if r.vec_id is not None) == [1, 1, 4] and len(found) == 4
    assert {(r.component, r.n) for r in found} == {(1, 4)}
    assert abs(found[0].explained - 1) < 1e-9 and found[0].identity_error < 1e-6


@pytest.mark.parametrize("rows", [[], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, None)]])
def test_whitening_without_variance_is_empty(spark, rows):
    df = whitening.whitened(vectors(spark, rows))
    assert df.collect() == [] and df.columns[:3] == ["vec_id", "component", "n"]


def test_whitening_query_over_its_table(spark):
    found = queries.op12_whitening(spark, "/root/testdata/sf0.001").collect()
    table = spark.read.parquet("/root/testdata/sf0.001/embeddings.parquet").orderBy("vec_id").collect()
    n, expected, explained, _ = brute_whitening([r.embedding for r in table])
    got = {(r.vec_id, r.component): r for r in found}
    assert len(found) == len(got) == n * 8
    for k in range(8):
        mine = np.array([got[r.vec_id, k + 1].whitened for r in table])
        assert min(np.abs(mine - expected[:, k]).max(), np.abs(mine + expected[:, k]).max()) < 1e-5
        assert abs(got[table[0].vec_id, k + 1].explained / explained[k] - 1) < 1e-6
    assert found[0].identity_error < 1e-6


def test_very_different_scales_keep_their_small_components(spark):
    rng = np.random.default_rng(5)
    rows = rng.normal(size=(400, 3)) * [1e4, 10.0, 0.05]
    found = whitening.whitened(vectors(spark, [(i, r.tolist()) for i, r in enumerate(rows)])).collect()
    _, expected, explained, _ = brute_whitening(rows)
    third = np.array([r.whitened for r in sorted(found, key=lambda r: r.vec_id) if r.component == 3])
    assert min(np.abs(third - expected[:, 2]).max(), np.abs(third + expected[:, 2]).max()) < 1e-3
    assert found[0].identity_error < 1e-4
    assert {r.deviation for r in found} != {None}
    large = [r for r in found if r.exact_deviation >= 2**63]
    assert large and all(r.deviation is None for r in large)
    assert all(r.deviation == r.exact_deviation for r in found if r.exact_deviation < 2**63)


# -- source divergence ---------------------------------------------------------------


def brute_divergence(rows, min_docs, top=50):
    import re
    from collections import Counter, defaultdict

    counts, in_docs, langs = defaultdict(Counter), defaultdict(Counter), defaultdict(set)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        words = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lowered)
        counts[lang, source].update(words)
        in_docs[lang].update(set(words))
        langs[lang].add(source)
    out = []
    for lang, sources in langs.items():
        kept = [t for t, n in in_docs[lang].items() if n >= min_docs]
        share = {}
        whole = Counter()
        for s in sources:
            total = sum(counts[lang, s][t] for t in kept)
            share[s] = {t: 1 + 10**9 * (counts[lang, s][t] + 5) // (total + 5 * len(kept)) for t in kept}
            whole.update({t: counts[lang, s][t] for t in kept})
        q = {t: 1 + 10**9 * (whole[t] + 5) // (sum(whole.values()) + 5 * len(kept)) for t in kept}
        for s in sources:
            pairs = [(sum(abs(share[s][t] - share[o][t]) for t in kept), o) for o in sources if o != s]
            terms = [(share[s][t] - q[t], t) for t in kept if counts[lang, s][t] and share[s][t] > q[t]]
            for part, items in (("pair", pairs), ("term", terms)):
                ordered = sorted(items, key=lambda i: (-i[0], i[1].encode()))
                out += [(lang, s, part, item, value, rank) for rank, (value, item) in enumerate(ordered, 1) if part == "pair" or rank <= top]
    return sorted(out)


def divergent(spark, rows, **options):
    schema = "text string, lang string, source string, term string, p string, place string, value string"
    df = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], schema).repartition(3)
    return sorted(tuple(r) for r in source_divergence.divergence(df, **options).collect())


@pytest.mark.parametrize("chunk", [7, 500_000])
def test_divergence_against_brute_force(spark, monkeypatch, chunk):
    """Also with the index in many chunks and the words of a task given out early."""
    monkeypatch.setattr(source_divergence, "CHUNK_POSTINGS", chunk)
    monkeypatch.setattr(source_divergence, "HELD_WORDS", 20)
    rnd = random.Random(chunk)
    words = ["the", "The", "of", "naïve", "日本", "x1y", "don't", "a-b", "ÀB", "zz", "Q", "rare"]
    rows = [(" ".join(rnd.choices(words, k=rnd.randrange(30))), rnd.choice(["en", "de"]), rnd.choice("abcde")) for _ in range(90)]
    rows += [(None, "en", "a"), ("", "en", "f"), (None, None, None), ("the the", None, "a"), ("only here", "fr", "g"), ("12 34", "fr", "h")]
    rows += [rows[0]] * 3
    assert divergent(spark, rows, min_docs=6) == brute_divergence(rows, 6)


def test_divergence_of_tables_without_terms(spark):
    assert divergent(spark, []) == []
    rows = [("one two", "en", "a"), (None, "en", "b"), (None, None, "c")]
    assert divergent(spark, rows) == [("en", "a", "pair", "b", 0, 1), ("en", "b", "pair", "a", 0, 1)]


def test_divergence_of_long_texts_and_ties(spark):
    rows = [("word " * 50_000 + "b a", "en", s) for s in "xyz"] + [("other", "en", "w")] * 3
    assert divergent(spark, rows, min_docs=3) == brute_divergence(rows, 3)
