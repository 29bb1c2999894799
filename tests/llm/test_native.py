"""Quality rules, URL filters and line dedup on small frames."""

import hashlib

import compare
import duckdb
import frames

from conftest import rows
from tickermood.llm.line_dedup import LineRuns, batch_counts, dedup_lines
from tickermood.llm.quality_rules import quality_verdicts
from tickermood.llm.queries import ORACLE, QUERIES
from tickermood.llm.url_filters import pattern_hits, pattern_index, url_verdicts


def test_measures(spark):
    found = {(r["doc_id"], r["n_words"]): r for r in rows(quality_verdicts(frames.documents(spark)))}
    assert len(rows(quality_verdicts(frames.documents(spark)))) == len(frames.TEXTS)
    assert found[3, 0]["base_failed"] and found[4, 0]["n_repeat_words"] == 0
    assert found[6, 30_000]["n_repeat_words"] == 30_000
    assert found[7, 3]["n_dup_lines"] == 0
    assert found[8, 4]["word_chars"] == 14
    assert found[None, 6]["n_words"] == 6


def test_repeated_windows_cover_words_once(spark):
    text = "a b c d a b c d x y a b c"
    docs = spark.createDataFrame([(1, text, "s")], "doc_id long, text string, source string")
    # "a b c" thrice and "b c d" twice: places 0-3, 4-7 and 10-12.
    assert rows(quality_verdicts(docs))[0]["n_repeat_words"] == 11


def test_bad_host_condemns_its_documents(spark):
    good = " ".join(f"w{i}" for i in range(60))
    docs = [(i, "short", "bad") for i in range(95)] + [(100 + i, good, "bad") for i in range(5)]
    docs += [(200 + i, good, f"host{i % 5}") for i in range(200)] + [(500, "short", "lone"), (501, good, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    found = {r["doc_id"]: r for r in rows(quality_verdicts(frame))}
    assert not found[100]["kept"] and not found[100]["base_failed"]
    assert found[200]["kept"] and found[501]["kept"]


def test_hosts_decide_in_the_query(spark, tmp_path):
    """A bad host, a suspect one, trusted ones and none, through query and SQL."""
    good = " ".join(f"w{i}" for i in range(60))
    marked = " ".join(f"w{i}##" for i in range(60))
    twice = "\n".join([good, good, good])
    docs = [(i, "short", "bad") for i in range(95)] + [(100 + i, good, "bad") for i in range(5)]
    docs += [(1000 + i, marked if i % 100 < 2 else good, f"host{i // 100}") for i in range(2000)]
    docs += [(200 + i, marked if i < 30 else good, "suspect") for i in range(100)]
    docs += [(4000, marked, None), (4001, twice, None), (4002, good, None), (4003, None, None), (4004, marked, "new"), (4005, good, "new")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    frame.write.parquet(str(tmp_path / "documents.parquet"))
    df = QUERIES["op1_quality_rules"](spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{tmp_path}/documents.parquet/*.parquet'")
    assert compare.spark_rows(df) == compare.oracle_rows(con, ORACLE["op1_quality_rules"])
    kept = {r["doc_id"]: r["kept"] for r in rows(df)}
    assert not kept[100]  # a good document of a bad host
    assert not kept[200] and kept[230]  # symbols reject in a suspect host
    assert kept[1000]  # and not in a trusted one
    assert [kept[i] for i in range(4000, 4004)] == [False, False, True, False]


def test_empty_tables(spark):
    empty = frames.documents(spark, [])
    assert rows(quality_verdicts(empty)) == [] and rows(dedup_lines(empty)) == []
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    assert rows(url_verdicts(pages)) == []


def test_url_parts_and_longest_rule(spark):
    urls = [
        "http://A.Example.NET/en/x?q#f", "https://example.net/de/", "http://badnet/", "http://example.com/de/1",
        "http://example.com?x=/de/", "no scheme", None, "http://spam-farm.example.org/en/", "ftp://x.org/fr/?a",
        "http://a.b/free-download", "http://a.b/freedownload", "http://example.net",
    ]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(urls)], "page_id long, url string, host string")
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in rows(url_verdicts(pages))}
    assert found[0] == ("a.example.net", "/en/x", "example.net/en/", "allow")
    assert found[1] == ("example.net", "/de/", "net/", "block")
    assert found[2] == ("badnet", "/", None, "allow")
    assert found[3] == ("example.com", "/de/1", "example.com/de/", "block")
    assert found[4] == ("example.com", "", None, "allow")
    assert found[5] == ("", "", None, "allow") == found[6]
    assert found[7][2:] == (None, "block") and found[8][2:] == ("org/fr/", "allow")
    assert found[9][3] == "block" and found[10][3] == "allow" and found[11][2] is None


def test_rules_are_indexed_by_their_rarest_token(spark):
    tokens = spark.createDataFrame([("free",), ("free",), ("download",)], "token string")
    index = {r["name"]: r["token"] for r in rows(pattern_index(spark, tokens, [("f", "free-download", ["free", "download"])]))}
    assert index == {"f": "download"}
    urls = spark.createDataFrame([("http://x/a",), ("http://x/a",), ("http://y/b",)], "url string")
    hits = rows(pattern_hits(urls, [("r1", "x/a", ["a"]), ("r2", "x/", ["x"])]))
    assert hits == [{"url": "http://x/a", "pattern_rule": "r1"}]


def brute_lines(docs, min_docs):
    def key(line):
        return "".join(c.lower() if "A" <= c <= "Z" else c for c in line.strip(" \t\n\x0b\x0c\r"))

    counts = {}
    for _, text in docs:
        for k in {key(line) for line in (text or "").split("\n")}:
            counts[k] = counts.get(k, 0) + 1
    result = []
    for i, text in docs:
        lines = (text or "").split("\n")
        kept = [line for line in lines if not key(line) or counts[key(line)] < min_docs]
        result.append((i, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return sorted(result, key=repr)


def test_lines_against_brute_force(spark):
    docs = [(i, f"Shared LINE {i % 3}\n own {i}\n\tshared line 1 \n" + "\n".join(["again"] * (i % 4))) for i in range(40)]
    docs += frames.TEXTS
    for fanout in (2, 5):
        found = dedup_lines(frames.documents(spark, docs), min_docs=10, fanout=fanout, counts=True)
        assert set(frames.CLASH) <= set(found.columns)
        got = [
            (r["doc_id"], r["n_lines"], r["n_dropped"], hashlib.sha256((r["text"] or "").encode()).hexdigest())
            for r in rows(found)
        ]
        assert sorted(got, key=repr) == brute_lines(docs, 10)


def test_runs_settle_frequent_hashes(spark):
    runs = LineRuns(spark, min_docs=3, fanout=2)
    for batch in ([(b"a", 2), (b"b", 1)], [(b"a", 1), (b"c", 1)], [(b"a", 9), (b"b", 1)], [(b"b", 1), (b"d", 3)]):
        runs.add(spark.createDataFrame([(bytearray(h), n) for h, n in batch], "hash binary, n_docs long"))
    assert {bytes(r["hash"]) for r in rows(runs.frequent())} == {b"a", b"b", b"d"}
    assert runs.levels[0] == [] and len(runs.levels) == 3


def test_runs_merge_without_moving(spark):
    """Runs lie in buckets: a merge of runs has no exchange, a batch moves its counts once."""
    frame = lambda items: spark.createDataFrame([(bytearray(h), n) for h, n in items], "hash binary, n_docs long")
    runs = LineRuns(spark, min_docs=3, fanout=3)
    runs.add(frame([(b"a", 2), (b"b", 1)]))
    runs.add(frame([(b"a", 4)]))
    plan = lambda df: df._jdf.queryExecution().executedPlan().toString()
    merged = runs.merged(runs.levels[0])
    assert "SortMergeJoin" in plan(merged) and "Exchange" not in plan(merged)
    assert {(bytes(r["hash"]), r["n_docs"]) for r in rows(merged)} == {(b"a", 6), (b"b", 1)}
    runs.add(frame([(b"c", 1)]))
    assert len(runs.settled) == 1
    entries = spark.createDataFrame([(bytearray(b"a"), 0), (bytearray(b"d"), 0), (bytearray(b"d"), 0)], "hash binary, batch int")
    fresh = runs.unsettled(batch_counts(entries, 0))
    assert "SortMergeJoin" in plan(fresh) and plan(fresh).count("Exchange hashpartitioning") == 1
    assert [(bytes(r["hash"]), r["n_docs"]) for r in rows(fresh)] == [(b"d", 2)]
