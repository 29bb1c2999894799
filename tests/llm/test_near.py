"""Near-duplicates of texts and vectors, and components, against brute force."""

import re

import frames
import numpy as np
import pytest
import xxhash

from conftest import rows
from tickermood.llm import embedding_dedup, queries, simhash
from tickermood.llm.components import connected_components


def brute_components(n, near):
    root = list(range(n))
    changed = True
    while changed:
        changed = False
        for i in range(n):
            for j in range(n):
                if near(i, j) and root[j] < root[i]:
                    root[i], changed = root[j], True
    return root


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(50)] + [(200, 100 + i) for i in range(40)] + [(7, 7), (300, 301), (301, 300)]
    found = {r["node"]: r["root"] for r in rows(connected_components(spark.createDataFrame(links, "a long, b long")))}
    expected = {i: 0 for i in range(1, 51)} | {i: 100 for i in [*range(101, 140), 200]} | {301: 300}
    assert found == expected
    assert rows(connected_components(spark.createDataFrame([], "a long, b long"))) == []


@pytest.mark.parametrize("parities", [3, 8])
def test_bucket_links_connect_what_is_within_the_radius(spark, parities):
    rng = np.random.default_rng(3)
    fps = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    for _ in range(160):
        flips = rng.integers(0, 64, rng.integers(1, 6))
        fps = np.append(fps, fps[rng.integers(len(fps))] ^ np.bitwise_or.reduce(np.uint64(1) << flips.astype(np.uint64)))
    fps = np.unique(fps)
    frame = spark.createDataFrame([(int(f),) for f in fps.view(np.int64)], "fp long")
    links = rows(simhash.fingerprint_links(frame, parities))
    assert all((r["a"] ^ r["b"]) for r in links)
    expected = brute_components(len(fps), lambda i, j: (fps[i] ^ fps[j]).bit_count() <= 4)
    at = {int(f): i for i, f in enumerate(fps.view(np.int64))}
    pairs = {(at[r["a"]], at[r["b"]]) for r in links}
    assert brute_components(len(fps), lambda i, j: (i, j) in pairs or (j, i) in pairs) == expected
    # Two parity bits: every fingerprint reaches every bucket.
    for bucket in range(4):
        whole, sliced = simhash.bucket_links(fps, bucket, 2, 4), simhash.bucket_links(fps, bucket, 2, 4, step=5000)
        assert whole.tolist() == sliced.tolist()


def test_fingerprints_of_odd_texts(spark):
    found = rows(simhash.near_duplicates(frames.documents(spark)))
    assert len(found) == len(frames.TEXTS)
    by = {(r["doc_id"], r["fp"] == 0): r["component_id"] for r in found}
    assert by[3, True] == by[4, True] == by[5, True] == 3 == by[None, True]
    assert by[1, False] == by[2, False] == by[None, False] == 1
    assert simhash.fingerprint(simhash.shingle_hashes("ONE two")) == simhash.fingerprint(simhash.shingle_hashes("one\x0bTWO"))
    assert rows(simhash.near_duplicates(frames.documents(spark, []))) == []


def edited(rng, words, share):
    return [f"x{rng.integers(10**6)}" if rng.random() < share else w for w in words]


def brute_fingerprint(text):
    """Written from the contract, without the operator's helpers."""
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def test_query_against_brute_force(spark):
    """Fingerprints and components of every row of the given table."""
    found = {r["doc_id"]: r for r in rows(queries.op4_simhash(spark, "/root/testdata/sf0.001"))}
    table = rows(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), "doc_id")
    prints = [brute_fingerprint(r["text"]) for r in table]
    roots = brute_components(len(table), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    assert len(found) == len(table)
    for r, fp, root in zip(table, prints, roots):
        assert found[r["doc_id"]]["fingerprint"] == f"{fp:016x}"
        assert found[r["doc_id"]]["component_id"] == table[root]["doc_id"]


def test_one_document_of_each_group_stays(spark):
    kept = rows(simhash.without_duplicates(frames.documents(spark)))
    # 1, 2 and a row without id are copies, 3, 4, 5 and another one have no words.
    assert sorted(r["doc_id"] for r in kept) == [1, 3, 6, 7, 8]
    assert set(frames.CLASH) <= set(kept[0])
    assert rows(simhash.without_duplicates(frames.documents(spark, []))) == []


def test_rows_of_one_id_are_judged_apart(spark):
    texts = ["one two three four five", "six seven eight nine ten", "eleven twelve thirteen fourteen"]
    docs = [(1, texts[0]), (2, texts[0]), (2, texts[1]), (2, texts[1]), (None, texts[2]), (None, texts[2])]
    kept = rows(simhash.without_duplicates(frames.documents(spark, docs)))
    assert sorted((r["doc_id"] or 0, r["text"]) for r in kept) == [(0, texts[2]), (1, texts[0]), (2, texts[1])]


def test_a_group_keeps_one_document_whatever_its_size(spark):
    rng = np.random.default_rng(2)
    base = [f"w{i}" for i in range(400)]
    docs = []
    for i in range(300):
        words = list(base)
        if i % 3:
            words[rng.integers(400)] = f"x{i}"
        docs.append((i, " ".join(words)))
    docs += [(1000 + i, " ".join(f"y{i}z{j}" for j in range(50))) for i in range(20)]
    prints = [brute_fingerprint(t) for _, t in docs]
    roots = brute_components(len(docs), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    kept = rows(simhash.without_duplicates(frames.documents(spark, docs)))
    assert sorted(r["doc_id"] for r in kept) == sorted(docs[i][0] for i in set(roots))


def brute_vectors(vectors, threshold):
    def fine(v):
        return v is not None and None not in v and np.isfinite(v).all() and any(v)

    def link(i, j):
        (a, u, la), (b, v, lb) = vectors[i], vectors[j]
        if i == j or None in (a, b, la, lb) or la != lb or not fine(u) or not fine(v) or len(u) != len(v):
            return False
        u, v = np.array(u, float), np.array(v, float)
        return u @ v / np.sqrt(u @ u) / np.sqrt(v @ v) >= threshold

    n = len(vectors)
    links = [sum(link(i, j) for j in range(n)) for i in range(n)]
    root = brute_components(n, link)
    return sorted(
        (repr(v[0]), links[i], repr(min(vectors[j][0] for j in range(n) if root[j] == root[i]) if v[0] is not None else None))
        for i, v in enumerate(vectors)
    )


def test_vectors_against_brute_force(spark, monkeypatch):
    rng = np.random.default_rng(9)
    vectors = []
    for at in range(60):
        base = rng.normal(size=8)
        for _ in range(rng.integers(1, 6)):
            copy = (base + rng.normal(size=8) * rng.choice([0, 0.1, 0.3])).astype(np.float32)
            vectors.append((len(vectors), [float(x) for x in copy], int(at % 2)))
    n = len(vectors)
    one = vectors[0][1]
    vectors += [
        (n, None, 1), (n + 1, [0.0] * 8, 1), (n + 2, [float("nan")] * 8, 1), (n + 3, [None] * 8, 0), (n + 4, one, None),
        (n + 5, one[:4], 0), (n + 6, [float("inf")] * 8, 0), (None, one, 0), (n + 7, [2 * x for x in one], 0), (n + 8, [], 0),
    ]
    frame = spark.createDataFrame([(*v, "x") for v in vectors], "vec_id long, embedding array<float>, label int, cell string")
    expected = brute_vectors(vectors, 0.93)
    for cells, block in ((1, 4096), (5, 4096), (5, 7)):
        monkeypatch.setattr(embedding_dedup, "cell_count", lambda n, cells=cells: cells)
        monkeypatch.setattr(embedding_dedup.embedding_links, "__defaults__", (0.93, block))
        found = rows(embedding_dedup.near_duplicates(frame))
        assert sorted((repr(r["vec_id"]), r["n_links"], repr(r["component_id"])) for r in found) == expected
        assert all(r["kept"] == (None if r["vec_id"] is None else r["vec_id"] == r["component_id"]) for r in found)
    assert rows(embedding_dedup.near_duplicates(frame.limit(0))) == []
