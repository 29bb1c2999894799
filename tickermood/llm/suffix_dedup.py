"""Remove passages that start earlier in the corpus too (operator 11).

A byte goes if a string of ``window`` bytes over it also starts earlier: in a document of
smaller id, or further ahead in the same one. What decides is which suffixes agree on
their first ``window`` bytes, so the suffix array is sorted to that depth. It is built
block by block with a difference cover, and no task holds more than one block of text or
one bucket of suffixes:

1. The texts are written once as blocks of some MB, bucketed by block, so that the later
   passes join small marks to them without moving text.
2. Cover sample. Positions whose offset modulo ``v`` lies in a difference cover are ranked
   by the ``window - v + 1`` bytes that follow. Two equal windows have an offset below
   ``v`` at which both hold a sample; the ranks of the two are equal. Each block sends its
   ranks to buckets, a bucket is sorted by itself, and blocks learn which ranks are shared.
3. Long ties. Samples of equal rank are sorted by the bytes around them (every window
   through the sample). Those that agree there agree on all their windows, so all but the
   earliest are settled by their rank, however long the passage is. Only where a rank
   comes with different surroundings, at the ends of a passage, do windows go on.
4. Suffix buckets. These windows are sorted one bucket at a time; equal ones become
   neighbours, and all but the earliest are marked.
5. Marks return to their block, which cuts the marked bytes out.

The order within a bucket is that of digests of the compared bytes and not that of the
bytes; equal windows are neighbours in either, and digests deal hot prefixes out evenly.
Ranks have 64 bits and only propose; what decides a mark has 128 bits. A block sends each
rank, surrounding and window once, so a passage that every document holds adds an entry
for each block and not for each document; ranks held by many blocks are split further by
their surroundings.

Cases: a null text is an empty one; an empty or short text loses nothing. Rows that share
an id are documents of their own, the earlier in the table first; a null id comes after
all others. Repeated rows lose all but the first copy. A very long text is a block of its
own. Matches never cross documents. Bytes that are no UTF-8 are compared like any others.
An empty table gives an empty table; other columns are not read.
"""

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tickermood.llm.common import bucketed, saved

WINDOW = 100
BLOCK_BYTES = 8 << 20
BUCKET_ENTRIES = 1 << 20
HOT_BLOCKS = 256

# Perfect difference sets. Each residue but 0 is the difference of one pair.
COVERS = {
    7: (0, 1, 3),
    13: (0, 1, 3, 9),
    31: (0, 1, 3, 8, 12, 18),
    57: (0, 1, 3, 13, 32, 36, 43, 52),
}

LAST_ID = np.iinfo(np.int64).max
# Kinds of marks: runs of window starts, samples that are no first, samples that split.
RUNS, LATER, SPLIT = 0, 1, 2

_FOLD = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


@dataclass(frozen=True)
class Cover:
    """A difference cover that serves windows of ``window`` bytes."""

    window: int
    modulus: int

    @classmethod
    def of(cls, window: int) -> "Cover":
        fitting = [v for v in COVERS if v <= 0.6 * window and window - v + 1 >= 8]
        if not fitting:
            raise ValueError("windows have at least 14 bytes")
        return cls(window, max(fitting))

    @property
    def depth(self) -> int:
        """Bytes by which samples are ranked: those that lie in every window through the sample."""
        return self.window - self.modulus + 1

    @property
    def before(self) -> int:
        return self.modulus - 1

    def places(self, size: int) -> np.ndarray:
        """Offsets of the samples of a text of ``size`` bytes."""
        members = np.array(COVERS[self.modulus])
        rounds = np.arange(size // self.modulus + 1) * self.modulus
        found = (rounds[:, None] + members).ravel()
        return found[: np.searchsorted(found, size - self.depth, "right")]


def digest(words: np.ndarray, at: np.ndarray, length: int, seed: int) -> np.ndarray:
    """64-bit digest of the ``length`` bytes (8 or more) at each position; ``words`` has one word for each byte."""
    found = np.full(len(at), seed, np.uint64)
    for step in (*range(0, length - 8, 8), length - 8):
        found ^= words[at + step]
        found *= _FOLD
        found ^= found >> np.uint64(32)
    found *= _MIX
    return found ^ (found >> np.uint64(29))


def firsts(*keys: np.ndarray) -> np.ndarray:
    """Marks where any of the sorted ``keys`` changes."""
    new = np.ones(len(keys[0]), bool)
    if len(new):
        new[1:] = False
        for key in keys:
            new[1:] |= key[1:] != key[:-1]
    return new


def runs_of(flags: np.ndarray) -> np.ndarray:
    """(n, 2) start and end of each run of true flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
    return edges.reshape(-1, 2)


class Block:
    """The texts of one block in one buffer, a gap after each."""

    def __init__(self, ids: np.ndarray, sizes: np.ndarray, data: bytes, cover: Cover):
        self.cover, self.sizes = cover, sizes.astype(np.int64)
        self.ids = ids
        gap = cover.before + cover.window
        before = np.concatenate([[0], np.cumsum(self.sizes)])
        self.starts = before[:-1] + gap * np.arange(1, len(sizes) + 1)
        self.length = int(before[-1] + gap * (len(sizes) + 1))
        self.bytes = np.full(self.length, 255, np.uint8)
        source = np.frombuffer(data, np.uint8)
        for start, size, begin in zip(self.starts.tolist(), self.sizes.tolist(), before.tolist()):
            self.bytes[start : start + size] = source[begin : begin + size]
        self.words = np.ndarray((max(0, self.length - 7),), "<u8", self.bytes.data, strides=(1,))

    def owner(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.starts, at, "right") - 1

    def samples(self) -> np.ndarray:
        long = np.flatnonzero(self.sizes >= self.cover.window)
        if not len(long):
            return np.empty(0, np.int64)
        places = self.cover.places(int(self.sizes[long].max()))
        ends = np.searchsorted(places, self.sizes[long] - self.cover.depth, "right")
        return np.concatenate([places[:n] + start for n, start in zip(ends.tolist(), self.starts[long].tolist())])

    def ranks(self, at: np.ndarray) -> np.ndarray:
        return digest(self.words, at, self.cover.depth, 11)

    def surroundings(self, at: np.ndarray) -> np.ndarray:
        """Digest of all bytes of the windows through each sample, and of where the text ends among them."""
        cover, doc = self.cover, self.owner(at)
        found = digest(self.words, at - cover.before, cover.before + cover.window, 23)
        left = np.minimum(at - self.starts[doc], cover.before)
        right = np.minimum(self.starts[doc] + self.sizes[doc] - at, cover.window)
        found ^= (left * 65_536 + right).astype(np.uint64)
        found *= _FOLD
        return found ^ (found >> np.uint64(31))

    def through(self, at: np.ndarray) -> np.ndarray:
        """Flags of the window starts whose window goes through one of the samples."""
        doc = self.owner(at)
        low = np.maximum(at - self.cover.before, self.starts[doc])
        high = np.minimum(at, self.starts[doc] + self.sizes[doc] - self.cover.window) + 1
        fine = low < high
        return self.between(low[fine], high[fine])

    def between(self, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        steps = np.zeros(self.length + 1, np.int32)
        np.add.at(steps, low, 1)
        np.subtract.at(steps, high, 1)
        return np.cumsum(steps, out=steps)[: self.length] > 0


def pack_ints(values: np.ndarray) -> bytes:
    """Whole numbers as their least and the differences to it in as few bytes as they need."""
    least = int(values.min())
    width = np.min_scalar_type(int(values.max()) - least) if least > -(2**62) else np.dtype(np.uint64)
    offsets = (values.astype(np.uint64) - np.array(least, np.int64).astype(np.uint64)).astype(width)
    return np.int64(least).tobytes() + bytes([width.itemsize]) + offsets.tobytes()


def unpack_ints(data: bytes) -> np.ndarray:
    offsets = np.frombuffer(data, f"<u{data[8]}", offset=9).astype(np.uint64)
    return (offsets + np.frombuffer(data, np.uint64, 1)).view(np.int64)


def blocks_of(docs: DataFrame, cover: Cover, block_bytes: int) -> DataFrame:
    """The texts of ``docs(doc_id, text)`` as a table of blocks, bucketed by block."""

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, count = [], 0, TaskContext.get().partitionId() << 32

        def block():
            held.sort(key=lambda row: row[0] is None or row[0])
            held.sort(key=lambda row: row[0] is None)
            return pa.record_batch({
                "block_id": pa.array([count], pa.int64()),
                "ids": pa.array([[i for i, _ in held]], pa.list_(pa.int64())),
                "sizes": pa.array([[len(t) for _, t in held]], pa.list_(pa.int32())),
                "n_bytes": pa.array([size], pa.int64()),
                "data": pa.array([b"".join(t for _, t in held)], pa.binary()),
            })

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                text = text.as_py() or b""
                if held and size + len(text) > block_bytes:
                    yield block()
                    held, size, count = [], 0, count + 1
                held.append((doc_id.as_py(), text))
                size += len(text)
        if held:
            yield block()

    rows = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    found = rows.mapInArrow(gather, "block_id long, ids array<long>, sizes array<int>, n_bytes long, data binary")
    return bucketed(found, "block_id", "text-blocks")


def each_block(batches: Iterator[pa.RecordBatch], cover: Cover) -> Iterator[tuple[int, Block, list]]:
    """(id, block, marks) of the rows of ``block_id, ids, sizes, data`` and, if there is one, ``marks``."""
    for batch in batches:
        for row in range(batch.num_rows):
            block_id, ids, sizes, data, *marks = (batch.column(i)[row] for i in range(batch.num_columns))
            ids = ids.values.fill_null(LAST_ID).to_numpy()
            block = Block(ids, sizes.values.to_numpy(), data.as_buffer(), cover)
            yield block_id.as_py(), block, (marks[0].as_py() or []) if marks else []


def _cuts(keys: np.ndarray, bits: int) -> tuple[np.ndarray, list[int]]:
    """Buckets of sorted keys that hold some, and where each begins (and the last ends)."""
    bucket = (keys >> np.uint64(64 - bits)).astype(np.int64)
    start = np.flatnonzero(firsts(bucket))
    return bucket[start], [*start.tolist(), len(keys)]


def shared_ranks(blocks: DataFrame, cover: Cover, bits: int) -> DataFrame:
    """``(block_id, marks)``: for each bucket bit maps of the block's sorted ranks, of the shared and of the hot ones."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block_id, block, _ in each_block(batches, cover):
            ranks = np.sort(block.ranks(block.samples()))
            ranks = ranks[firsts(ranks)]
            rest = (ranks >> np.uint64(32 - bits)).astype(np.uint32)
            buckets, cuts = _cuts(ranks, bits)
            yield pa.record_batch({
                "bucket": pa.array(buckets, pa.int64()),
                "block_id": pa.array(np.full(len(buckets), block_id), pa.int64()),
                "data": pa.array([rest[a:b].tobytes() for a, b in zip(cuts, cuts[1:])], pa.binary()),
            })

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for bucket, rows in _buckets(batches):
            parts = [np.frombuffer(data, np.uint32) for _, data in rows]
            _, place, counts = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
            counts = np.split(counts[place], np.cumsum([len(p) for p in parts])[:-1])
            told = [(block, c) for (block, _), c in zip(rows, counts) if (c > 1).any()]
            yield pa.record_batch({
                "block_id": pa.array([block for block, _ in told], pa.int64()),
                "bucket": pa.array([bucket] * len(told), pa.int64()),
                "shared": pa.array([np.packbits(c > 1).tobytes() for _, c in told], pa.binary()),
                "hot": pa.array([np.packbits(c > HOT_BLOCKS).tobytes() for _, c in told], pa.binary()),
            })

    sent = blocks.select("block_id", "ids", "sizes", "data").mapInArrow(send, "bucket long, block_id long, data binary")
    told = _sorted_buckets(sent).mapInArrow(sort, "block_id long, bucket long, shared binary, hot binary")
    return saved(told, "shared-ranks")


def _sorted_buckets(sent: DataFrame) -> DataFrame:
    return sent.repartition("bucket").sortWithinPartitions("bucket", "block_id")


def _buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[tuple]]]:
    """Each bucket with its rows, which come one after the other."""
    now, held = None, []
    for batch in batches:
        for bucket, *row in zip(*(column.to_pylist() for column in batch.columns)):
            if bucket != now and held:
                yield now, held
                held = []
            now = bucket
            held.append(tuple(row))
    if held:
        yield now, held


def with_marks(blocks: DataFrame, marks: DataFrame, how: str) -> DataFrame:
    """Blocks with all their marks; the marks move and the texts do not."""
    fields = [c for c in marks.columns if c != "block_id"]
    told = marks.groupBy("block_id").agg(F.collect_list(F.struct(*fields)).alias("marks"))
    return blocks.join(told, "block_id", how).select("block_id", "ids", "sizes", "data", "marks")


_ENTRIES = "bucket long, block_id long, kind int, keys binary, others binary, ids binary, places binary"


def _entries(block_id: int, block: Block, kind: int, route, keys, others, at, bits: int) -> pa.RecordBatch:
    """Rows of ``_ENTRIES``, one for each bucket of ``route``."""
    order = np.argsort(route, kind="stable")
    keys, others, at = keys[order], others[order], at[order]
    ids = block.ids[block.owner(at)]
    buckets, cuts = _cuts(route[order], bits)
    pairs = list(zip(cuts, cuts[1:]))
    return pa.record_batch({
        "bucket": pa.array(buckets, pa.int64()),
        "block_id": pa.array(np.full(len(buckets), block_id), pa.int64()),
        "kind": pa.array(np.full(len(buckets), kind), pa.int32()),
        "keys": pa.array([keys[a:b].tobytes() for a, b in pairs], pa.binary()),
        "others": pa.array([others[a:b].tobytes() for a, b in pairs], pa.binary()),
        "ids": pa.array([pack_ints(ids[a:b]) for a, b in pairs], pa.binary()),
        "places": pa.array([at[a:b].astype(np.uint32).tobytes() for a, b in pairs], pa.binary()),
    })


def _passed_on(block_id: int, flags: np.ndarray, bits: int) -> pa.RecordBatch:
    """What a block knows by itself: runs of window starts that are no firsts."""
    runs = runs_of(flags).astype(np.uint32)
    schema = pa.schema([("bucket", pa.int64()), ("block_id", pa.int64()), ("kind", pa.int32()),
                        *[(name, pa.binary()) for name in ("keys", "others", "ids", "places")]])
    rows = [{"bucket": (block_id * 40_503) % (1 << bits), "block_id": block_id, "kind": -1, "places": runs.tobytes()}]
    return pa.RecordBatch.from_pylist(rows if len(runs) else [], schema)


def _marks(batches: Iterator[pa.RecordBatch], later: int, always_split: bool | None) -> Iterator[pa.RecordBatch]:
    """Sort one bucket after the other; ``(block_id, kind, places)`` of what is no first and of what splits.

    ``always_split`` None: nothing splits; the entries are windows.
    """
    for _, rows in _buckets(batches):
        told = [(block, RUNS, places) for block, kind, _, _, _, places in rows if kind < 0]
        for hot in (0, 1):
            held = [row for row in rows if row[1] == hot]
            if not held:
                continue
            keys, others = (np.concatenate([np.frombuffer(row[i], np.uint64) for row in held]) for i in (2, 3))
            ids = np.concatenate([unpack_ints(row[4]) for row in held])
            places = [np.frombuffer(row[5], np.uint32) for row in held]
            block = np.repeat(np.arange(len(held)), [len(p) for p in places])
            order = np.lexsort((block, ids, others, keys))
            first = firsts(keys[order], others[order])
            is_first = np.empty(len(order), bool)
            is_first[order] = first
            split = np.zeros(len(order), bool)
            if always_split is not None:
                group = np.cumsum(firsts(keys[order])) - 1
                split[order] = first & (hot == 1 or (np.bincount(group, first)[group] > 1))
            cuts = np.cumsum([len(p) for p in places])[:-1]
            for row, place, f, s in zip(held, places, np.split(is_first, cuts), np.split(split, cuts)):
                if not f.all():
                    told.append((row[0], later, place[~f].tobytes()))
                if s.any():
                    told.append((row[0], SPLIT, place[s].tobytes()))
        yield pa.record_batch({
            "block_id": pa.array([t[0] for t in told], pa.int64()),
            "kind": pa.array([t[1] for t in told], pa.int32()),
            "places": pa.array([t[2] for t in told], pa.binary()),
        })


def settled_samples(blocks: DataFrame, ranks: DataFrame, cover: Cover, bits: int) -> DataFrame:
    """``(block_id, kind, places)``: what the ranks of the cover samples settle, and the samples they leave open."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block_id, block, marks in each_block(batches, cover):
            at = block.samples()
            ranks, place, counts = np.unique(block.ranks(at), return_inverse=True, return_counts=True)
            shared, hot = counts > 1, np.zeros(len(ranks), bool)
            buckets, cuts = _cuts(ranks, bits)
            spans = dict(zip(buckets.tolist(), zip(cuts, cuts[1:])))
            for mark in marks:
                a, b = spans[mark["bucket"]]
                for flags, name in ((shared, "shared"), (hot, "hot")):
                    flags[a:b] |= np.unpackbits(np.frombuffer(mark[name], np.uint8), count=b - a).astype(bool)
            some = shared[place]
            at, rank, hot = at[some], ranks[place[some]], hot[place[some]]
            around = block.surroundings(at)
            order = np.lexsort((at, around, rank))
            first = firsts(rank[order], around[order])
            yield _passed_on(block_id, block.through(at[order[~first]]), bits)
            at, rank, around, hot = (x[order[first]] for x in (at, rank, around, hot))
            for kind, mine in ((0, ~hot), (1, hot)):
                if mine.any():
                    route = rank[mine] if kind == 0 else (rank[mine] ^ around[mine]) * _MIX
                    yield _entries(block_id, block, kind, route, rank[mine], around[mine], at[mine], bits)

    sent = with_marks(blocks, ranks, "left").mapInArrow(send, _ENTRIES)
    marks = _sorted_buckets(sent).mapInArrow(lambda b: _marks(b, LATER, False), "block_id long, kind int, places binary")
    return saved(marks, "sample-marks")


def _known(block: Block, marks: list) -> np.ndarray:
    """Flags of the window starts that the marks tell to be no firsts."""
    found = np.zeros(block.length, bool)
    runs = [np.frombuffer(m["places"], np.uint32).reshape(-1, 2) for m in marks if m["kind"] == RUNS]
    if runs:
        runs = np.concatenate(runs).astype(np.int64)
        found |= block.between(runs[:, 0], runs[:, 1])
    later = [np.frombuffer(m["places"], np.uint32) for m in marks if m["kind"] == LATER]
    if later:
        found |= block.through(np.concatenate(later).astype(np.int64))
    return found


def settled_windows(blocks: DataFrame, marks: DataFrame, cover: Cover, bits: int) -> DataFrame:
    """``(block_id, kind, places)``: the windows through open samples that are no firsts, as runs."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block_id, block, marks in each_block(batches, cover):
            open_at = [np.frombuffer(m["places"], np.uint32) for m in marks if m["kind"] == SPLIT]
            if not open_at:
                continue
            wanted = block.through(np.concatenate(open_at).astype(np.int64)) & ~_known(block, marks)
            at = np.flatnonzero(wanted)
            keys, others = (digest(block.words, at, cover.window, seed) for seed in (37, 41))
            order = np.lexsort((at, others, keys))
            first = firsts(keys[order], others[order])
            again = np.zeros(block.length, bool)
            again[at[order[~first]]] = True
            yield _passed_on(block_id, again, bits)
            mine = order[first]
            if len(mine):
                yield _entries(block_id, block, 0, keys[mine], keys[mine], others[mine], at[mine], bits)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _marks(batches, SPLIT, None):
            # Positions of windows become runs of one.
            rows = batch.to_pylist()
            for row in rows:
                if row["kind"] == SPLIT:
                    at = np.sort(np.frombuffer(row["places"], np.uint32))
                    ends = np.flatnonzero(np.diff(at) != 1)
                    low, high = at[np.concatenate([[0], ends + 1])], at[np.concatenate([ends, [len(at) - 1]])] + 1
                    row |= {"kind": RUNS, "places": np.stack([low, high], 1).astype(np.uint32).tobytes()}
            yield pa.RecordBatch.from_pylist(rows, batch.schema)

    sent = with_marks(blocks, marks, "inner").mapInArrow(send, _ENTRIES)
    return saved(_sorted_buckets(sent).mapInArrow(sort, "block_id long, kind int, places binary"), "window-marks")


def cut_texts(blocks: DataFrame, marks: DataFrame, cover: Cover) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)`` of every document."""
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, block, marks in each_block(batches, cover):
            starts = runs_of(_known(block, marks))
            gone = block.between(starts[:, 0], starts[:, 1] + cover.window - 1)
            spans = runs_of(gone)
            doc = block.owner(spans[:, 0])
            offsets = np.searchsorted(doc, np.arange(len(block.ids) + 1))
            spans = spans - block.starts[doc][:, None]
            kept = []
            for start, size, a, b in zip(block.starts.tolist(), block.sizes.tolist(), offsets, offsets[1:]):
                text = block.bytes[start : start + size]
                kept.append((text if a == b else text[~gone[start : start + size]]).tobytes())
            lists = pa.ListArray.from_arrays(
                pa.array(offsets, pa.int32()),
                pa.StructArray.from_arrays([pa.array(spans[:, 0], pa.int64()), pa.array(spans[:, 1], pa.int64())], fields=list(span)),
            )
            ids = pa.array(block.ids, mask=block.ids == LAST_ID)
            yield pa.record_batch([ids, pa.array(block.sizes), lists, pa.array(kept, pa.binary())],
                                  names=["doc_id", "n_bytes", "spans", "kept"])

    schema = "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary"
    return with_marks(blocks, marks, "left").mapInArrow(cut, schema)


def without_repeats(docs: DataFrame, window=WINDOW, block_bytes=BLOCK_BYTES) -> DataFrame:
    """``(doc_id, n_bytes, spans, kept)`` of every row of ``docs(doc_id, text)``.

    ``spans`` are the maximal runs of removed bytes, ``kept`` the other bytes.
    """
    cover = Cover.of(window)
    blocks = blocks_of(docs, cover, block_bytes)
    n_bytes = blocks.agg(F.sum("n_bytes")).first()[0] or 0
    samples = n_bytes * len(COVERS[cover.modulus]) // cover.modulus
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    bits = min(30, max(samples // BUCKET_ENTRIES, 2 * partitions).bit_length())
    ranks = shared_ranks(blocks, cover, bits)
    samples_marked = settled_samples(blocks, ranks, cover, bits)
    windows_marked = settled_windows(blocks, samples_marked, cover, bits)
    marks = samples_marked.where(F.col("kind") != SPLIT).unionByName(windows_marked)
    return cut_texts(blocks, marks, cover)
