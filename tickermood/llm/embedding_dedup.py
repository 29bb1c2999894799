"""Near-duplicates among embeddings (operator 6).

Equal vectors of one label form a class and are compared once. Spherical k-means,
fitted on a bounded sample, assigns every class to its nearest cell. A class is also
a guest in each later cell that could hold a vector near enough: if x lies by more
than the largest linking distance on its own side of the plane between two centres,
nothing beyond that plane links to x. The comparison is therefore exact, whatever
the sample. Cells are cut into blocks of bounded size; a task holds one block and
streams all that must be compared with it past it, as blocked matrix products.

Rows link if their labels are equal and the cosine in double precision reaches the
threshold. Links are counted with all copies. From each product only as many links
are kept as connect the same vectors; components run on these.

Cases: a vector that is null, all zero, or holds a null or a component that is not
finite links with nothing, as does a row without label or without id; it is its
own component (null for a null id). Vectors of different length never link.
Repeated rows are vectors like any other; rows of one id are one node. Pairs at the very threshold
link. An empty table gives an empty table.
"""

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tickermood.llm.common import saved
from tickermood.llm.components import connected_components

THRESHOLD = 0.93
SAMPLE_ROWS = 20_000
MAX_CELLS = 512
BLOCK_ROWS = 4096
PROBE_ROWS = 1024
EPSILON = 1e-9


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & F.coalesce(fine & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(vectors: np.ndarray) -> np.ndarray:
    vectors = vectors.astype(np.float64)
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.sqrt((vectors * vectors).sum(1, keepdims=True))


def cell_count(n: int) -> int:
    """Cells grow with the root of the vectors, so that the centres stay a small table."""
    return min(MAX_CELLS, max(1, math.isqrt(n) // 16))


def spherical_kmeans(vectors: np.ndarray, cells: int, rounds=15, seed=7) -> np.ndarray:
    """Unit centres of the cells; ``vectors`` are unit rows."""
    rng = np.random.default_rng(seed)
    centres = vectors[rng.choice(len(vectors), min(cells, len(vectors)), replace=False)]
    for _ in range(rounds):
        home = (vectors @ centres.T).argmax(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, home, vectors)
        norms = np.sqrt((sums * sums).sum(1))
        full = norms > 1e-12
        centres = np.where(full[:, None], sums / np.where(full, norms, 1)[:, None], centres)
    return centres


def _matrix(batch: pa.RecordBatch, name: str) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(name))
    return column.flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)


def fit_centres(classes: DataFrame, n: int) -> np.ndarray:
    """Centres from at most ``SAMPLE_ROWS`` classes, in one task; at most ``MAX_CELLS`` rows reach the driver."""
    dims = classes.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if dims is None:
        return np.zeros((0, 0))
    cells = cell_count(n)
    sample = (
        classes.where(F.col("dim") == dims["dim"]).select("id", "embedding")
        .orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).coalesce(1)
    )

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = [_matrix(batch, "embedding") for batch in batches if batch.num_rows]
        if parts:
            centres = spherical_kmeans(unit_rows(np.concatenate(parts)), cells)
            yield pa.record_batch({"centre": pa.array(centres.tolist(), pa.list_(pa.float64()))})

    return np.array([row["centre"] for row in sample.mapInArrow(fit, "centre array<double>").collect()])


def assigned(classes: DataFrame, centres: np.ndarray, threshold=THRESHOLD) -> DataFrame:
    """Each class in its cell (side 0) and as a guest (side 1) in later cells it may reach."""
    reach = math.sqrt(max(0.0, 2 - 2 * threshold)) + EPSILON
    apart = np.sqrt(((centres[:, None] - centres[None]) ** 2).sum(2)) if centres.size else np.zeros((0, 0))
    vector = classes.schema["embedding"].dataType.simpleString()
    schema = f"label string, dim int, id long, n long, embedding {vector}, cell int, side int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                dims = part.column("dim").to_numpy()
                home, rows, cells = np.full(len(dims), -1), [], []
                inside = np.flatnonzero(dims == centres.shape[1]) if centres.size else np.empty(0, int)
                if len(inside):
                    units = unit_rows(_matrix(part.take(pa.array(inside)), "embedding"))
                    near = units @ centres.T
                    best = near.argmax(1)
                    home[inside] = best
                    margin = near[np.arange(len(best)), best][:, None] - near
                    guest = (margin <= reach * apart[best] + EPSILON) & (np.arange(len(centres)) > best[:, None])
                    row, cell = np.nonzero(guest)
                    rows, cells = inside[row], cell
                for take, cell, side in ((np.arange(len(dims)), home, 0), (np.asarray(rows, int), np.asarray(cells, int), 1)):
                    for start in range(0, len(take), 8192):
                        some = part.take(pa.array(take[start : start + 8192]))
                        size = some.num_rows
                        yield pa.record_batch(
                            [*some.columns, pa.array(cell[start : start + 8192], pa.int32()), pa.array(np.full(size, side), pa.int32())],
                            names=[*some.schema.names, "cell", "side"],
                        )

    return classes.select("label", "dim", "id", "n", "embedding").mapInArrow(run, schema)


class _Block:
    """The block a task holds: counts its links and joins what is linked."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray, units: np.ndarray, threshold: float):
        self.ids, self.weights, self.units, self.threshold = ids, weights, units, threshold
        self.counts = np.zeros(len(ids), np.int64)
        self.root = np.arange(len(ids))

    def _join(self, a: np.ndarray, b: np.ndarray) -> None:
        while True:
            low, high = np.minimum(self.root[a], self.root[b]), np.maximum(self.root[a], self.root[b])
            if (low == high).all():
                return
            np.minimum.at(self.root, high, low)
            while (self.root[self.root] != self.root).any():
                self.root = self.root[self.root]

    def among(self) -> None:
        for at in range(0, len(self.ids), PROBE_ROWS):
            linked = self.units[at : at + PROBE_ROWS] @ self.units.T >= self.threshold
            linked[np.arange(len(linked)), np.arange(at, at + len(linked))] = False
            self.counts[at : at + PROBE_ROWS] += linked @ self.weights
            row, other = np.nonzero(linked)
            self._join(row + at, other)

    def meet(self, ids, weights, units) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probes past the block: (probe id, its links, one block id it links to) of those that link."""
        linked = units @ self.units.T >= self.threshold
        self.counts += weights @ linked
        counts = linked @ self.weights
        hit = np.flatnonzero(linked.any(1))
        first = linked[hit].argmax(1)
        row, other = np.nonzero(linked[hit])
        self._join(first[row], other)
        return ids[hit], counts[hit], self.ids[first]

    def result(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return self.ids, self.counts, self.ids[self.root]


def _compare(threshold: float):
    keys = ["label", "dim", "cell", "block"]

    def rows(ids, counts, others):
        keep = (counts > 0) | (ids != others)
        return pa.record_batch({"id": pa.array(ids[keep]), "links": pa.array(counts[keep]), "other": pa.array(others[keep])})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, block = None, [], None

        def closed() -> _Block:
            ids, weights, vectors = (np.concatenate(x) for x in zip(*held, strict=True))
            made = _Block(ids, weights, unit_rows(vectors), threshold)
            made.among()
            return made

        for batch in batches:
            codes = [batch.column(k).to_pylist() for k in [*keys, "side"]]
            marks = list(zip(*codes, strict=True))
            start = 0
            while start < len(marks):
                end = start
                while end < len(marks) and marks[end] == marks[start] and end - start < PROBE_ROWS:
                    end += 1
                part = batch.slice(start, end - start)
                ids, weights = part.column("id").to_numpy(), part.column("n").to_numpy()
                vectors = _matrix(part, "embedding")
                *unit, side = marks[start]
                if unit != now:
                    if held:
                        yield rows(*(block or closed()).result())
                    now, held, block = unit, [], None
                if side == 0:
                    held.append((ids, weights, vectors))
                elif held:
                    block = block or closed()
                    yield rows(*block.meet(ids, weights, unit_rows(vectors)))
                start = end
        if held:
            yield rows(*(block or closed()).result())

    return run


def embedding_links(classes: DataFrame, threshold=THRESHOLD, block_rows=BLOCK_ROWS) -> DataFrame:
    """``(id, links, other)``: partial link counts, and links that connect the same classes."""
    n = classes.count()
    placed = saved(assigned(classes, fit_centres(classes, n), threshold), "cells")
    keys = ["label", "dim", "cell"]
    blocks = (
        placed.where("side = 0").groupBy(*[F.col(k).alias(f"of_{k}") for k in keys])
        .agg(F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"))
    )
    met = placed.join(blocks, [placed[k] == blocks[f"of_{k}"] for k in keys])
    own = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    # A member of block i is held by block i and streams past the later blocks.
    target = F.expr(
        "transform(filter(sequence(0, blocks - 1), b -> side = 1 or b >= own),"
        " b -> struct(b as block, if(side = 0 and b = own, 0, 1) as role))"
    )
    units = met.withColumn("own", own).select(*keys, "id", "n", "embedding", F.inline(target))
    units = units.select(*keys, "block", F.col("role").alias("side"), "id", "n", "embedding")
    return (
        units.repartition(*keys, "block").sortWithinPartitions(*keys, "block", "side")
        .mapInArrow(_compare(threshold), "id long, links long, other long")
    )


def near_duplicates(vectors: DataFrame, threshold=THRESHOLD) -> DataFrame:
    """``(vec_id, n_links, component_id, kept)`` for every row of ``vectors(vec_id, embedding, label)``."""
    fine = usable(F.col("embedding")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull()
    rows = vectors.select(
        F.col("vec_id").cast("long"),
        F.when(fine, F.col("label").cast("string")).alias("label"),
        F.when(fine, F.col("embedding")).alias("embedding"),
    )
    classes = saved(
        rows.where(F.col("embedding").isNotNull()).groupBy("label", "embedding")
        .agg(F.min("vec_id").alias("id"), F.count(F.lit(1)).alias("n"))
        .withColumn("dim", F.size("embedding")),
        "vector-classes",
    )
    found = saved(embedding_links(classes, threshold), "vector-links")
    roots = connected_components(found.where("id <> other").select(F.col("id").alias("a"), F.col("other").alias("b")))
    counts = found.groupBy(F.col("id").alias("of")).agg(F.sum("links").alias("links"))
    known = (
        classes.join(counts, F.col("id") == F.col("of"), "left").join(roots, F.col("id") == F.col("node"), "left")
        .select(
            F.col("label").alias("l"), F.col("embedding").alias("e"),
            (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"),
            F.coalesce("root", "id").alias("component_id"),
        )
    )
    met = rows.join(known, (rows["label"] == known["l"]) & (rows["embedding"] == known["e"]), "left")
    component = F.coalesce("component_id", "vec_id")
    return met.select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"), (F.col("vec_id") == component).alias("kept"),
    )
