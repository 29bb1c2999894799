"""SimHash near-duplicates by meet-in-the-middle ball hashing (operator 4).

Two fingerprints that differ in at most ``radius`` bits have a common variant that
is at most half the radius away from each. Every distinct fingerprint therefore
emits all its variants within half the radius, variants are shuffled, and equal ones
meet. Equal variants are gathered by bucket: 12 or more parity bits of the variant,
each over its own share of the 64 bits. A fingerprint is sent once to each bucket that
holds one of its variants (79 buckets of 4,096 for half radius 2) instead of once for
each of its 2,081 variants, and the task of a bucket makes those variants again.
Flipping a bit changes one parity, so copies around a centre spread over buckets too.

All fingerprints that share a variant are within the radius of each other. In a bucket
each is verified against the smallest one it meets and joined to it, so the number
of links follows the fingerprints, not the pairs. Components run over distinct
fingerprints; exact copies of a text are never paired.

Cases: a null or empty text has fingerprint 0 and is linked like any other. Rows with
a null id get a result too; the component is named by the smallest id that is not
null, if there is one. Repeated rows are returned as often as they come. A very long
text is hashed whole, its bits added in parts. An empty table gives an empty table.
"""

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from tickermood.llm.common import saved, unused
from tickermood.llm.components import connected_components

SHINGLE = 4
RADIUS = 4
SEED = 42
MIN_PARITIES = 12
VARIANTS_PER_BUCKET = 4_000_000
SLICE_ROWS = 2_000_000


def shingle_hashes(text: str | None, shingle=SHINGLE) -> np.ndarray:
    """XXH64 of the space-joined shingles of the A-Z lower-cased words, repeats included."""
    words = (text or "").encode().lower().split()
    if not words:
        return np.empty(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) >= shingle:
        starts, ends = starts[: len(words) - shingle + 1], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    return np.fromiter(
        (digest(joined[s:e], SEED) for s, e in zip(starts.tolist(), ends.tolist())), np.uint64, len(starts)
    )


def fingerprint(hashes: np.ndarray) -> int:
    """The 64-bit SimHash: a bit is 1 if it is set in over half of the hashes."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65_536):
        part = hashes[at : at + 65_536].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    bits = (2 * ones > len(hashes)).astype(np.uint8)
    return int(np.packbits(bits, bitorder="little").view("<u8")[0])


def marked_fingerprints(docs: DataFrame, shingle=SHINGLE) -> DataFrame:
    """``(doc_id, mark, fp)`` for every row of ``docs(doc_id, text, mark)``; ``fp`` is the fingerprint as a signed long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = (fingerprint(shingle_hashes(text.as_py(), shingle)) for text in batch.column(2))
            fps = np.fromiter(found, np.uint64, batch.num_rows).view(np.int64)
            yield pa.record_batch([*batch.columns[:2], pa.array(fps)], names=["doc_id", "mark", "fp"])

    rows = docs.select(F.col("doc_id").cast("long"), "mark", "text")
    return rows.mapInArrow(run, "doc_id long, mark long, fp long")


def fingerprints(docs: DataFrame, shingle=SHINGLE) -> DataFrame:
    """``(doc_id, fp)`` for every row."""
    marked = docs.select("doc_id", "text", F.lit(0).cast("long").alias("mark"))
    return marked_fingerprints(marked, shingle).select("doc_id", "fp")


def parity_masks(parities: int, bits=64) -> list[int]:
    return [sum(1 << bit for bit in range(group, bits, parities)) for group in range(parities)]


def parity_count(n_fingerprints: int, radius=RADIUS, bits=64, least=MIN_PARITIES) -> int:
    """Parity bits that keep the variants of an average bucket in memory."""
    ball = sum(math.comb(bits, k) for k in range(radius // 2 + 1))
    wanted = max(1, n_fingerprints * ball // VARIANTS_PER_BUCKET)
    return min(bits // 2, max(least, wanted.bit_length()))


def bit_flips(parities: int, radius: int, bits=64) -> dict[int, np.ndarray]:
    """Bucket change -> the flips of at most half the radius that cause it."""
    if radius % 2:
        raise ValueError("the radius must be even, to be met in the middle")
    found: dict[int, list[int]] = {}
    for k in range(radius // 2 + 1):
        for places in itertools.combinations(range(bits), k):
            change, flip = 0, 0
            for bit in places:
                change ^= 1 << (bit % parities)
                flip |= 1 << bit
            found.setdefault(change, []).append(flip)
    return {change: np.array(flips, np.uint64) for change, flips in found.items()}


def home_buckets(fps: np.ndarray, parities: int, bits=64) -> np.ndarray:
    out = np.zeros(len(fps), np.int64)
    for group, mask in enumerate(parity_masks(parities, bits)):
        out |= (np.bitwise_count(fps & np.uint64(mask)).astype(np.int64) & 1) << group
    return out


def variant_slices(fps: np.ndarray, homes: np.ndarray, bucket: int, flips, step: int) -> Iterator[tuple]:
    """The variants in ``bucket`` of all fingerprints, as ``(variant, index)`` arrays of bounded size.

    A slice takes the variants of one residue of a hash, so that equal ones are in one slice.
    """
    changes = homes ^ bucket
    order = np.argsort(changes, kind="stable")
    values, first = np.unique(changes[order], return_index=True)
    classes = list(zip(values.tolist(), np.split(order, first[1:]), strict=True))
    total = sum(len(rows) * len(flips[change]) for change, rows in classes)
    n = -(-total // step)
    for part in range(n):
        found, index = [], []
        for change, rows in classes:
            size = max(1, step // len(flips[change]))
            for at in range(0, len(rows), size):
                some = rows[at : at + size]
                variants = (fps[some][:, None] ^ flips[change][None, :]).ravel()
                owners = np.repeat(some, len(flips[change]))
                if n > 1:
                    mine = (variants * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(33)) % np.uint64(n) == part
                    variants, owners = variants[mine], owners[mine]
                found.append(variants)
                index.append(owners)
        yield np.concatenate(found), np.concatenate(index)


def collisions(variants: np.ndarray, owners: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``(group, owner)`` of the variants that come more than once, groups numbered from 0."""
    ordered = np.sort(variants)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    if not len(twice):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    at = np.searchsorted(twice, variants)
    at[at == len(twice)] = 0
    hit = np.flatnonzero(twice[at] == variants)
    return at[hit], owners[hit]


def bucket_links(fps: np.ndarray, bucket: int, parities: int, radius: int, flips=None, step=SLICE_ROWS) -> np.ndarray:
    """Links ``(fp, smaller fp)`` that join what meets in a bucket; ``fps`` are distinct."""
    fps = np.sort(fps)
    flips = flips or bit_flips(parities, radius)
    homes = home_buckets(fps, parities)
    root = np.arange(len(fps))
    for variants, owners in variant_slices(fps, homes, bucket, flips, step):
        group, owner = collisions(variants, owners)
        if not len(group):
            continue
        least = np.full(group.max() + 1, len(fps))
        np.minimum.at(least, group, owner)
        partner = least[group]
        near = np.bitwise_count(fps[owner] ^ fps[partner]) <= radius
        pairs = np.unique(np.stack([owner[near], partner[near]], 1), axis=0)
        while True:
            a, b = root[pairs[:, 0]], root[pairs[:, 1]]
            if (a == b).all():
                break
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (root[root] != root).any():
                root = root[root]
    moved = np.flatnonzero(root != np.arange(len(fps)))
    return np.stack([fps[moved], fps[root[moved]]], 1)


def by_bucket(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Each run of equal first columns with its other columns; rows come sorted by the first."""
    now, held = None, []
    for batch in batches:
        bucket, *rest = (column.to_numpy() for column in batch.columns)
        cuts = (np.flatnonzero(bucket[1:] != bucket[:-1]) + 1).tolist()
        for start, end in itertools.pairwise([0, *cuts, len(bucket)]):
            if start == end:
                continue
            if bucket[start] != now and held:
                yield now, [np.concatenate(parts) for parts in zip(*held, strict=True)]
                held = []
            now = int(bucket[start])
            held.append([column[start:end] for column in rest])
    if held:
        yield now, [np.concatenate(parts) for parts in zip(*held, strict=True)]


def fingerprint_links(distinct: DataFrame, parities: int, radius=RADIUS) -> DataFrame:
    """``(a, b)``: links that connect exactly what pairs within ``radius`` connect; ``distinct(fp)`` has no repeats."""
    flips = bit_flips(parities, radius)
    home = F.lit(0)
    for group, mask in enumerate(parity_masks(parities)):
        signed = mask - (1 << 64) if mask >> 63 else mask
        parity = F.bit_count(F.col("fp").bitwiseAND(F.lit(signed).cast("long"))) % 2
        home = home.bitwiseOR(F.shiftleft(parity.cast("int"), group))
    changes = F.array(*[F.lit(c) for c in sorted(flips)])
    sent = distinct.select("fp", home.alias("home")).select("fp", "home", F.explode(changes).alias("change")).select(
        F.col("home").bitwiseXOR(F.col("change")).alias("bucket"), "fp"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, (fps,) in by_bucket(batches):
            found = bucket_links(fps.view(np.uint64), bucket, parities, radius, flips)
            found = np.ascontiguousarray(found).view(np.int64)
            yield pa.record_batch({"a": pa.array(found[:, 0]), "b": pa.array(found[:, 1])})

    return sent.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(run, "a long, b long")


def fingerprint_roots(classes: DataFrame, radius=RADIUS) -> DataFrame:
    """``classes(fp, ...)``, one row per fingerprint, with ``root``, one fingerprint of its component."""
    parities = parity_count(classes.count(), radius)
    roots = connected_components(fingerprint_links(classes.select("fp"), parities, radius))
    met = classes.join(roots, classes["fp"] == roots["node"], "left")
    return met.select(*[classes[c] for c in classes.columns], F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, shingle=SHINGLE, radius=RADIUS) -> DataFrame:
    """``(doc_id, fp, component_id)`` for every row; the component is the smallest id linked to it."""
    prints = saved(fingerprints(docs, shingle), "fingerprints")
    classes = saved(prints.groupBy("fp").agg(F.min("doc_id").alias("first_id")), "fingerprint-classes")
    rooted = fingerprint_roots(classes, radius)
    named = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    by_print = rooted.select("fp", F.col("root").alias("of")).join(named, F.col("of") == F.col("root"))
    by_print = by_print.select(F.col("fp").alias("known"), "component_id")
    return prints.join(by_print, F.col("fp") == F.col("known"), "left").select("doc_id", "fp", "component_id")


def text_mark(text: Column) -> Column:
    return F.xxhash64(text)


def without_duplicates(docs: DataFrame, shingle=SHINGLE, radius=RADIUS) -> DataFrame:
    """``docs`` with one row of each component; all columns stay.

    The row of smallest id stays, a null id coming last; of rows that share it, the text of
    smallest hash, and of equal rows any one. A row is told by its id and the hash of its text,
    so rows of one id and different texts are judged apart.
    """
    marked = docs.select("doc_id", "text", text_mark(F.col("text")).alias("mark"))
    prints = saved(marked_fingerprints(marked, shingle), "marked-fingerprints")
    order = F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "mark")
    keys = prints.groupBy("fp", "doc_id", "mark").agg(F.count(F.lit(1)).alias("n"))
    classes = saved(prints.groupBy("fp").agg(F.min(order).alias("least")), "fingerprint-classes")
    rooted = fingerprint_roots(classes, radius)
    chosen = rooted.groupBy("root").agg(F.min("least").alias("stays"))
    by_print = rooted.select("fp", F.col("root").alias("of")).join(chosen, F.col("of") == F.col("root"))
    judged = keys.join(by_print.select(F.col("fp").alias("known"), "stays"), F.col("fp") == F.col("known"))
    stays = F.col("stays")["doc_id"].eqNullSafe(F.col("doc_id")) & (F.col("stays")["mark"] == F.col("mark"))
    judged = saved(
        judged.select(F.col("doc_id").alias("judged_id"), F.col("mark").alias("judged_mark"), "n", stays.alias("stays")),
        "judged-rows",
    )
    same = docs["doc_id"].cast("long").eqNullSafe(F.col("judged_id")) & (text_mark(docs["text"]) == F.col("judged_mark"))
    others = judged.where("not stays or n > 1").select("judged_id", "judged_mark").distinct()
    repeated = judged.where("stays and n > 1").select("judged_id", "judged_mark")
    mark = unused(docs.columns, "mark")
    one_each = docs.join(repeated, same, "left_semi").withColumn(mark, text_mark(F.col("text")))
    return docs.join(others, same, "left_anti").unionByName(one_each.dropDuplicates(["doc_id", mark]).drop(mark))
