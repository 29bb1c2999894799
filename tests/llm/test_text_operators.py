"""SentencePiece, HTML, packing, secrets, toxicity and the pipeline."""

import dataclasses
import hashlib
import math
import re
import time
import zlib
from array import array
from collections import Counter

import frames
import numpy as np
import pytest

import corpus_pipeline
from conftest import rows
from tickermood.llm import html_text, toxicity
from tickermood.llm.common import saved
from tickermood.llm.html_text import extract_text, main_text
from tickermood.llm.packing import TokenBytes, difference, divide, pack_documents
from tickermood.llm.queries import op2_sentencepiece
from tickermood.llm.secret_scan import BASE62, automaton, mask_secrets, scan, scan_secrets
from tickermood.llm.sentence_pieces import MARK, Pieces, decoded, encoded

SF = "/root/testdata/sf0.001"
ODD = ["a  b", " a", "a ", "\n", " ", "   x  y ", "Ａｂ 日本語", "tab\there", "x" * 400, "é́ ü", "a\x0bb", "\r\n\r\n z", "<|endoftext|> q"]


def viterbi(pieces, word):
    score = {pieces.text[i]: s for i, s in zip(pieces.ids.tolist(), pieces.scores.tolist(), strict=True)}
    best, cut = [0.0] + [-math.inf] * len(word), [0] * (len(word) + 1)
    for end in range(1, len(word) + 1):
        for size in range(1, min(end, pieces.longest) + 1):
            part = word[end - size : end]
            value = best[end - size] + score.get(part, pieces.missing if size == 1 else -math.inf)
            if value > best[end]:
                best[end], cut[end] = value, end - size
    parts, end = [], len(word)
    while end:
        parts.append(word[cut[end] : end])
        end = cut[end]
    return parts[::-1]


def test_pieces_are_the_best_spelling(spark):
    pieces = Pieces()
    words = ["▁the", "▁unbelievable", "▁Thonner", "▁ñüé", "▁▁▁", "▁x日y"]
    for word in words:
        expected = []
        for part in viterbi(pieces, word):
            expected += [pieces.text.index(part)] if part in pieces.text else pieces._bytes(part)
        pieces.learn({word[1:]})
        assert np.frombuffer(pieces.spelt[word[1:]], "<i4").tolist() == expected


def test_piece_round_trip(spark):
    import public_tokenizers
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    docs = frames.documents(spark, [*frames.TEXTS, *((100 + i, t) for i, t in enumerate(ODD))])
    found = rows(decoded(encoded(docs)))
    texts = sorted(repr((i, t or "")) for i, t in [*frames.TEXTS, *((100 + i, t) for i, t in enumerate(ODD))])
    assert sorted(repr((r["doc_id"], r["text"])) for r in found) == texts
    assert all(library.decode(r["ids"]) == r["text"] for r in found)
    assert rows(encoded(frames.documents(spark, []))) == []


def test_long_words_are_spelt_like_short_ones():
    pieces = Pieces()
    rng = np.random.default_rng(6)
    letters = [*"abcdefghijklmnopqrstuvwxyzABC0123456789+/é日", MARK]
    for size in (3, 40, 150, 400):
        word = MARK + "".join(rng.choice(letters, size))
        assert pieces.spell_long(word) == pieces.spell([word])[0]


def test_a_word_of_two_hundred_thousand_characters(spark):
    import time

    word = "".join(np.random.default_rng(1).choice(list("abcdefghijklmnopqrstuvwxyz0123456789+/"), 200_000))
    texts = [word, "a " + word + " b", "日本" * 3000, None]
    begin = time.perf_counter()
    found = rows(decoded(encoded(frames.documents(spark, list(enumerate(texts))))), "doc_id")
    assert [r["text"] for r in found] == [t or "" for t in texts]
    assert time.perf_counter() - begin < 60


def test_ids_decode_in_parts(spark):
    """Cuts between parts of a batch change nothing."""
    docs = frames.documents(spark)
    whole = sorted(map(repr, rows(decoded(encoded(docs)))))
    assert sorted(map(repr, rows(decoded(encoded(docs, batch_bytes=10), batch_ids=3)))) == whole


def test_piece_query_decodes_all_documents(spark):
    texts = {r["doc_id"]: r["text"] for r in rows(spark.read.parquet(f"{SF}/documents.parquet"))}
    for r in rows(op2_sentencepiece(spark, SF)):
        assert r["decoded_sha256"] == hashlib.sha256((texts[r["doc_id"]] or "").encode()).hexdigest()
        assert r["n_ids"] == len(r["ids"])


PAGE = """<html><body class="has-sidebar"><header><h1>Site</h1></header><div id="cookie-notice">We use cookies and the
 like for all of you to be as happy with this site as we are.</div><div class="content"><h2>Head</h2>
 <p>This is the text of the page, and it is long enough to be seen as content &amp; more &#8211; x.</p><p>Short.</p>
 <ul><li><a href=x>one</a></li></ul></div><div class="comments"><p>I think that this is the best thing that was ever on the
 web, and so do all of you who read it.</p></div><aside>Side</aside><form>Name <input></form><footer>Foot</footer>"""


def test_main_text(spark):
    body = "This is the text of the page, and it is long enough to be seen as content & more – x."
    assert main_text(PAGE) == f"Head\n{body}\nShort."
    assert main_text(f"<nav><a href=/>x</a></nav><article><h1>T</h1><div class=ad>Buy</div><p><b>a\n b<br>c<p>d</article>{PAGE}") == "T\na b c\nd"
    for page, text in [
        (None, ""), ("", ""), ("plain", "plain"), ("<p>a<p>b", "a\nb"), ("a < b", "a < b"), ("x<!-- y", "x"), ("<script>x", ""),
        ("<div class=with-sidebar><article><h2 class=header>H</h2><p>x</p><div class=reader-comments>c</div></article></div>", "H\nx"),
        ("<div id=cookieBanner>We use</div><p>x<div class='adsbygoogle'>y</div><div role=navigation>z</div>", "x"),
        ("<p><a href=a>one</a><p><a href=b>two</a><p>Few words.", "Few words."),
        ("<p>a&nbsp;&amp</p>", "a &"), ("<article></article>", ""), ("<p title='a>b'>c</p>", "c"), ("<style>x>y", ""),
    ]:
        assert main_text(page) == text


PROSE = "This is the long text of the page and that is what we have in the end for all of you. "


@pytest.mark.parametrize("page, expected", [
    # Linked characters count as decoded and collapsed.
    ("<article><p>Read the report <a>\n      now      or   in the   days   that   come  \n </a> in full.</p></article>",
     "Read the report now or in the days that come in full."),
    ("<article><p>See <a>R&amp;D &amp; Q&amp;A</a> or A to Z</p></article>", "See R&D & Q&A or A to Z"),
    # A teaser does not take the place of the long text.
    (f"<main><p>{PROSE * 3}</p><article><p>Teaser of the day.</p></article></main>", (PROSE * 3).strip() + "\nTeaser of the day."),
    # Headline, short lines and linked paragraphs of an article stay.
    (f"<nav><a>Home</a></nav><article><h2>T</h2><p>Short one.</p><p><a>All of this is a link</a></p><p>{PROSE * 2}</p></article>",
     "T\nShort one.\nAll of this is a link\n" + (PROSE * 2).strip()),
    # Without article and main, what is near boilerplate goes with it.
    (f"<div class=menu>{PROSE * 2}</div><div>Home</div><p>{PROSE * 2}</p><p>The end.</p><div>By us</div><footer>f</footer>",
     "Home\n" + (PROSE * 2).strip() + "\nThe end."),
    # An advert in prose inside of the article stays out and takes nothing with it.
    (f"<article><p>{PROSE * 2}</p><div class='advert'>{PROSE * 3}</div><p>Last line.</p></article>", (PROSE * 2).strip() + "\nLast line."),
])
def test_text_of_pages(page, expected):
    assert main_text(page) == expected


def plain_labels(found):
    """Both passes once more, without the operator's helpers: distances to all decided blocks."""
    def first(block, inside):
        if block.hinted or (block.linked > 0.5 * len(block.text) and not inside):
            return False
        words = [w.lower() for w in re.findall(r"[^\W\d_]+", block.text)]
        rich = words and sum(w in html_text.STOP_WORDS for w in words) / len(words) >= 0.2
        linked = block.linked > 0.5 * len(block.text)
        return True if rich and len(block.text) >= 70 and not block.heading and not linked else None

    sizes = [len(b.text) * (first(b, False) is True) for b in found]
    where = None
    for scope in ("in_article", "in_main"):
        mine = [getattr(b, scope) for b in found]
        share = sum(s for s, m in zip(sizes, mine) if m)
        if where is None and any(m and not b.hinted for b, m in zip(found, mine)) and 2 * share >= sum(sizes):
            where = mine
    picked = [i for i, b in enumerate(found) if where is None or (where[i] and not b.hinted)]
    marks = {i: first(found[i], where is not None) for i in picked}
    out = [False] * len(found)
    for at, i in enumerate(picked):
        decided = [(abs(at - k), marks[j] is False, k > at) for k, j in enumerate(picked) if marks[j] is not None]
        later = [d for d in decided if d[2]]
        if True not in marks.values():
            out[i] = marks[i] is None
        elif marks[i] is not None:
            out[i] = marks[i]
        else:
            out[i] = not min(later if found[i].heading and later else decided)[1]
    return out


def test_both_passes_decide_on_the_given_pages(spark):
    """How many blocks each pass decides, with hints and without, and both against plain loops."""
    pages = [r["html"] for r in rows(spark.read.parquet(f"{SF}/pages.parquet"))]
    counts = Counter()
    for page in pages:
        found = html_text.blocks(page or "")
        assert html_text.labels(found) == plain_labels(found)
        bare = [dataclasses.replace(b, hinted=False, in_article=False, in_main=False) for b in found]
        assert html_text.labels(bare) == plain_labels(bare)
        for name, some in (("hints", found), ("bare", bare)):
            for block, label in zip(some, html_text.labels(some)):
                counts[name, html_text.first_pass(block), label] += 1
    # With hints: boilerplate by hint, content by its words, the rest by its neighbours.
    assert counts["hints", False, False] > 100 and counts["hints", True, True] > 100 and counts["hints", None, True] > 100
    # Without hints links and neighbours still find boilerplate.
    assert counts["bare", False, False] > 0 and counts["bare", None, False] > 0


@pytest.mark.parametrize("page", ["<" * 100_000, "<a " * 50_000, '<a "' * 50_000 + ">", "<p>" * 50_000, "<div>" * 20_000])
def test_malformed_pages_take_linear_time(page):
    start = time.time()
    main_text(page)
    assert time.time() - start < 20


def test_extract_keeps_every_page(spark):
    pages = spark.createDataFrame(
        [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (None, None, None, None)], "page_id long, url string, html string, text string"
    )
    found = rows(extract_text(pages))
    assert len(found) == 3 and found[0] == found[1] and (found[2]["text"], found[2]["n_chars"]) == ("", 0)
    assert rows(extract_text(pages.limit(0))) == []


def test_token_bytes_are_the_tokenizers(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokens, library = TokenBytes(), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [*ODD, *(t for _, t in frames.TEXTS if t), "it's we'll  DON'T 1234 ... !! \n\n x", "²½ x_y", "a \nb\n c"]
    texts += ["a<|endoftext|>b", "<|endoftext|>", "end <|endoftext|> of <|endof", " lead", "x ", "  two  ", " 'tis don't  ab12cd,"]
    texts += [r["text"] for r in rows(spark.read.parquet(f"{SF}/documents.parquet"))]
    for text in texts:
        ids = library.encode(text, add_special_tokens=False).ids
        assert tokens.encode(text) == array("I", ids).tobytes(), text


def test_differencing():
    rng = np.random.default_rng(2)
    sizes = rng.integers(1, 128, 200).tolist()
    sets = difference(sizes, 16)
    assert sorted(i for s in sets for i in s) == list(range(200))
    sums = [sum(sizes[i] for i in s) for s in sets]
    assert max(sums) - min(sums) < 20
    assert all(sum(s) <= 10 for s in ([[7, 7, 7][i] for i in chosen] for chosen in divide([7, 7, 7], 10, 0)))
    assert divide([], 10, 0) == []


@pytest.mark.parametrize("capacity", [1024, 16, 1])
def test_pieces_cover_every_token_once(spark, capacity):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(40).select("doc_id", "text")
    docs = docs.union(spark.createDataFrame([(-1, None), (-2, ""), (-3, "x " * 5000)], "doc_id long, text string")).repartition(3)
    if capacity < 1024:
        docs = docs.where("length(text) < 3000 or text is null")
    tokens = TokenBytes()
    ids = {r["doc_id"]: tokens.encode(r["text"]) + bytes(4) for r in rows(docs)}
    pieces = rows(pack_documents(docs, capacity, with_ids=True), "doc_id", "start")
    at = dict.fromkeys(ids, 0)
    used = {}
    for p in pieces:
        part = ids[p["doc_id"]][4 * p["start"] : 4 * (p["start"] + p["length"])]
        assert p["start"] == at[p["doc_id"]] and zlib.crc32(part) == p["ids_crc32"] and array("I", part).tolist() == p["ids"]
        assert p["doc_tokens"] == len(ids[p["doc_id"]]) // 4
        at[p["doc_id"]] += p["length"]
        used.setdefault(p["sequence_id"], []).append((p["offset"], p["length"]))
    assert at == {d: len(b) // 4 for d, b in ids.items()}
    lengths = []
    for parts in used.values():
        end = 0
        for offset, length in sorted(parts):
            assert offset == end
            end += length
        lengths.append(end)
    padding = sum(0 if n & (n - 1) == 0 else capacity - n for n in lengths)
    assert max(lengths) <= capacity and padding <= 0.02 * sum(lengths)
    assert rows(pack_documents(docs.limit(0))) == []


def github(body):
    left, value = zlib.crc32(body.encode()), ""
    while left:
        left, digit = divmod(left, 62)
        value = BASE62[digit] + value
    return f"ghp_{body}{value.rjust(6, '0')}"


def test_secret_kinds():
    words = automaton()
    token = github("a1B2" * 7 + "zz")
    text = f'é PassWord = "abcdefghijkl" AKIA{"A" * 14} AKIA12 {token} {token[:-1]}! 4111111111111111 4111111111111112 token:short'
    kinds = [(k, text[a:b]) for k, a, b in scan(text, words)]
    assert kinds == [
        ("assign", 'PassWord = "abcdefghijkl'), ("access", "AKIA" + "A" * 14), ("github", token),
        ("hex", "4111111111111111"), ("card", "4111111111111111"), ("hex", "4111111111111112"),
    ]
    assert scan("token=secret=abcdefghijkl", words) == [("assign", 0, 25)]
    assert scan(None, words) == scan("", words) == []


def test_base_secrets_against_whole_patterns(spark):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    docs = [*frames.TEXTS, (50, "apikey='" + "Z" * 12 + "' " * 3 + "deadbeef" * 4), (51, "ſecret=abcdefghijklmnop TOKEN : 0123456789abcdef")]
    found = {r["doc_id"]: r for r in rows(scan_secrets(frames.documents(spark, docs)))}
    for i, text in docs:
        text = text or ""
        spans = [("assign", *m.span()) for m in assign.finditer(text) if len(m[2]) >= 12]
        spans += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
        spans += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
        spans.sort(key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))
        assert found[i]["n_assign"] + found[i]["n_access"] + found[i]["n_hex"] == len(spans)
        if i is not None:
            assert found[i]["base_sha256"] == hashlib.sha256(",".join(f"{k}:{a}:{b}" for k, a, b in spans).encode()).hexdigest()
    masked = rows(mask_secrets(frames.documents(spark, docs)))
    assert {r["doc_id"]: r["text"] for r in masked}[51] == "ſecret=abcdefghijklmnop [SECRET]"
    assert set(frames.CLASH) <= set(masked[0]) and rows(scan_secrets(frames.documents(spark, []))) == []


def toxic_frames(spark, n=800):
    rng = np.random.default_rng(1)
    docs, labels = [], []
    for i in range(n):
        words = [f"w{rng.integers(500)}" for _ in range(60)]
        toxic = int(i % 4 == 0)
        if toxic:
            words[10], words[40] = "moron", "stupid"
        docs.append((i, " ".join(words)))
        labels.append((i, toxic, 1))
    labels += [(None, 1, 1), (5, None, 1)]
    return frames.documents(spark, [*docs, (None, None), (n, "")]), spark.createDataFrame(labels, "doc_id long, toxic int, score int")


def test_toxicity_on_held_out_rows(spark):
    docs, labels = toxic_frames(spark)
    found = rows(toxicity.toxicity_scores(docs, labels))
    assert len(found) == 802 and all(0 <= r["score"] <= 1 for r in found)
    held = [r for r in found if r["held_out"]]
    assert {r["doc_id"] for r in held} == {i for i in range(801) if zlib.crc32(str(i).encode()) % 4 == 2}
    right = sum(r["predicted"] == (r["doc_id"] % 4 == 0) for r in held if r["doc_id"] < 800)
    assert right >= 0.97 * sum(r["doc_id"] < 800 for r in held)
    assert all(r["predicted"] == 0 for r in found if r["doc_id"] in (None, 800))
    model = toxicity.fit(docs, labels)
    assert 0 < len(model.index) < 2000


def test_clean_rows_stay_clean_when_the_sample_is_cut(spark, monkeypatch):
    """Both kinds are cut to their share at different hashes; the rows learnt from must stay mixed."""
    monkeypatch.setattr(toxicity, "SAMPLE_TOXIC", 120)
    monkeypatch.setattr(toxicity, "SAMPLE_CLEAN", 120)
    docs, labels = toxic_frames(spark, 1600)
    sample = rows(toxicity.training_rows(docs, labels), "order")
    assert sum(r["toxic"] for r in sample) == 120 and 45 <= sum(r["toxic"] for r in sample[:120]) <= 75
    found = rows(toxicity.toxicity_scores(docs, labels))
    clean = [r for r in found if r["doc_id"] is not None and r["doc_id"] < 1600 and r["doc_id"] % 4]
    assert sum(r["predicted"] for r in clean) <= 0.01 * len(clean)


def test_toxicity_fits_one_row_of_an_id(spark):
    docs, labels = toxic_frames(spark, 200)
    once = rows(toxicity.training_rows(docs, labels), "order")
    many = docs
    for _ in range(3):
        many = many.union(docs)
    found = rows(toxicity.training_rows(many, labels), "order")
    assert len(once) == len({r["order"] for r in once}) > 100 and found == once


def test_ftrl_against_plain_loops():
    """The published update, one coordinate after the other, with the bias free of the L1 penalty."""
    rng = np.random.default_rng(4)
    model = toxicity.Ftrl(bits=5, alpha=0.3, beta=1.0, l1=0.4, l2=0.5)
    z, n = [0.0] * 33, [0.0] * 33

    def weight(i):
        l1 = 0.0 if i == 32 else 0.4
        if abs(z[i]) <= l1:
            return 0.0
        return -(z[i] - math.copysign(l1, z[i])) / ((1.0 + math.sqrt(n[i])) / 0.3 + 0.5)

    for _ in range(200):
        index = np.unique(rng.integers(0, 32, rng.integers(0, 9))).astype(np.int32)
        label = int(rng.random() < (0.8 if 3 in index else 0.2))
        model.learn(index, label)
        active = [*index.tolist(), 32]
        weights = {i: weight(i) for i in active}
        gradient = 1 / (1 + math.exp(-sum(weights.values()))) - label
        for i in active:
            sigma = (math.sqrt(n[i] + gradient**2) - math.sqrt(n[i])) / 0.3
            z[i] += gradient - sigma * weights[i]
            n[i] += gradient**2
    found = model.weights(np.arange(33))
    assert np.allclose(found, [weight(i) for i in range(33)], atol=1e-9)
    assert (found[:32] == 0).any() and found[3] > 0 > found[32]


def test_toxicity_without_labels(spark):
    docs, labels = toxic_frames(spark, 20)
    for none in (labels.limit(0), labels.where("toxic = 0")):
        assert {r["predicted"] for r in rows(toxicity.toxicity_scores(docs, none))} == {0}
    assert rows(toxicity.toxicity_scores(docs.limit(0), labels)) == []


def test_pipeline(spark):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "line_dedup", "simhash_near_dedup", "secret_scan", "packing"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        kept = saved(stage(spark, docs, SF), name)
        if name != "packing":
            assert kept.columns == columns
            assert 0 < kept.count() <= docs.count()
        docs = kept
    assert corpus_pipeline.run(spark, SF).agg({"length": "sum"}).first()[0] == docs.agg({"length": "sum"}).first()[0]


def test_pipeline_stages_on_odd_rows(spark):
    docs = frames.documents(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert set(frames.CLASH) <= set(docs.columns), name
    assert sorted(r["doc_id"] for r in rows(docs)) == [1, 3, 6, 7, 8]
