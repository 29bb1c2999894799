"""k nearest neighbours within a symbol, by pivots and the triangle inequality."""

from pyspark.sql import Column, DataFrame, Window, functions as F

# Cells a symbol's train rows are dealt into.
PIVOTS = 24
# Room for rounding when bounds of distances are compared.
SLACK = 1e-9


def _squared_distance(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (x - y) * (x - y))
    return F.aggregate(squares, F.lit(0.0), lambda s, x: s + x)


def _distance(a: Column, b: Column) -> Column:
    return F.sqrt(_squared_distance(a, b))


def pivot_points(train: DataFrame, by: str, order: str, pivots: int) -> DataFrame:
    """``(by, _pivots)``: for each symbol an array of a few of its train points, picked by a hash of their day."""
    hashed = F.xxhash64(order)
    first = F.row_number().over(Window.partitionBy(by).orderBy(hashed, order))
    some = train.withColumn("_place", first).where(F.col("_place") <= pivots)
    listed = F.sort_array(F.collect_list(F.struct("_place", "_x")))
    return some.groupBy(by).agg(F.transform(listed, lambda p: p["_x"]).alias("_pivots"))


def _nearest_cell(point: Column) -> Column:
    """struct<d, cell> of the pivot next to a point; null where a distance is null."""
    near = F.transform("_pivots", lambda p, i: F.struct(_distance(p, point).alias("d"), i.alias("cell")))
    return F.array_min(F.filter(near, lambda c: c["d"].isNotNull() & ~F.isnan(c["d"])))


def train_cells(points: DataFrame, pivots: DataFrame, by: str, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """Train points with their cell and block, and ``(by, _cells)``: what is known of each cell.

    A cell knows the least and largest distance of its points to its pivot, their number, and into how
    many blocks of about ``block_rows`` they are cut. Points without a distance are cell -1.
    """
    placed = points.join(pivots, by).withColumn("_near", _nearest_cell(F.col("_x"))).drop("_pivots")
    placed = placed.withColumn("_cell", F.coalesce(F.col("_near.cell"), F.lit(-1))).withColumn("_r", F.col("_near.d")).drop("_near")
    cells = placed.groupBy(by, "_cell").agg(
        F.min("_r").alias("inner"), F.max("_r").alias("outer"), F.count(F.lit(1)).alias("n"),
        F.ceil(F.count(F.lit(1)) / block_rows).cast("int").alias("blocks"),
    )
    known = F.struct(F.col("_cell").alias("cell"), "inner", "outer", "n", "blocks")
    listed = cells.groupBy(by).agg(F.collect_list(known).alias("_cells"))
    sizes = cells.select(F.col(by).alias("_by"), F.col("_cell").alias("_of"), "blocks")
    met = placed.join(sizes, (F.col(by) == F.col("_by")) & (F.col("_cell") == F.col("_of")))
    return met.withColumn("_block", F.pmod(F.xxhash64("day"), F.col("blocks")).cast("int")).drop("_by", "_of", "blocks"), listed


def reachable(k: int) -> Column:
    """The (cell, block) pairs that can hold one of the ``k`` nearest of ``_x``, from ``_pivots`` and ``_cells``.

    The points of a cell lie between ``d - outer`` and ``d + outer`` from a row at distance ``d`` of its pivot,
    and not nearer than ``inner - d``. Cells in order of ``d + outer`` that hold ``k`` points together bound the
    distance of the k-th nearest; a cell whose least distance is above that bound holds none of them.
    """
    apart = lambda c: _distance(F.get("_pivots", c["cell"]), F.col("_x"))
    far = F.transform("_cells", lambda c: F.struct(F.nullif(apart(c), F.lit(float("nan"))).alias("d"), c.alias("c")))
    uppers = F.sort_array(F.transform(
        F.filter(far, lambda f: f["d"].isNotNull()), lambda f: F.struct((f["d"] + f["c"]["outer"]).alias("upper"), f["c"]["n"].alias("n"))
    ))
    bound = F.aggregate(
        uppers, F.struct(F.lit(0).cast("long").alias("seen"), F.lit(None).cast("double").alias("upper")),
        lambda s, u: F.when(s["seen"] >= k, s).otherwise(F.struct((s["seen"] + u["n"]).alias("seen"), u["upper"].alias("upper"))),
        lambda s: F.when(s["seen"] >= k, s["upper"]),
    )

    def near(f: Column, most: Column) -> Column:
        least = F.greatest(f["d"] - f["c"]["outer"], f["c"]["inner"] - f["d"])
        return F.coalesce(least <= most * (1 + SLACK) + SLACK, F.lit(True))

    # An array of one, so that the bound is computed once for a row.
    chosen = F.flatten(F.transform(F.array(bound), lambda most: F.filter(far, lambda f: near(f, most))))
    blocks = F.transform(chosen, lambda f: F.transform(
        F.sequence(F.lit(0), f["c"]["blocks"] - 1), lambda b: F.struct(f["c"]["cell"].alias("cell"), b.alias("block"))
    ))
    return F.flatten(blocks)


def knn_classify(
    train: DataFrame, test: DataFrame, features, k=7, label="label", by="symbol", order="date", out="prediction",
    block_rows=1024, pivots=PIVOTS,
) -> DataFrame:
    """Majority label of the ``k`` nearest train rows of the same symbol; exact.

    Equal distances go to the earlier day, equal votes to the smaller label. A symbol's
    train rows are dealt into cells around ``pivots`` of them, and cells into blocks of about
    ``block_rows`` by a hash of their day. A test row meets only the cells that can hold a
    neighbour (``reachable``), block by block, compares inside the row, and keeps the
    ``k`` nearest of each; the nearest of those are its neighbours. The join is by symbol,
    cell and block, so a hot symbol is many keys, and what a task holds is one block. A test
    row of a symbol without train rows gets null.
    """
    point = F.array(*[F.col(c).cast("double") for c in features])
    points = train.select(by, point.alias("_x"), F.col(order).alias("day"), F.col(label).alias("y"))
    chosen = pivot_points(points, by, "day", pivots)
    placed, cells = train_cells(points, chosen, by, block_rows)
    shelf = placed.groupBy(F.col(by).alias("_by"), "_cell", "_block").agg(
        F.collect_list(F.struct(F.col("_x").alias("x"), "day", "y")).alias("_shelf")
    )
    distances = F.transform(
        "_shelf", lambda t: F.struct(_squared_distance(t["x"], F.col("_x")).alias("d"), t["day"].alias("day"), t["y"].alias("y"))
    )
    # Equal rows are answered once and come back as often as they came.
    rows = test.groupBy(*test.columns).agg(F.count(F.lit(1)).cast("int").alias("_copies"))
    rows = rows.select(F.struct(*test.columns).alias("_row"), by, "_copies", point.alias("_x"))
    known = chosen.join(cells, by)
    asked = rows.join(known, by, "left").select("_row", by, "_copies", "_x", F.explode_outer(reachable(k)).alias("_to"))
    at = (F.col(by) == F.col("_by")) & (F.col("_to.cell") == F.col("_cell")) & (F.col("_to.block") == F.col("_block"))
    near = asked.join(shelf, at, "left").select("_row", "_copies", F.slice(F.sort_array(distances), 1, k).alias("_near"))
    merged = near.groupBy("_row", "_copies").agg(F.slice(F.sort_array(F.flatten(F.collect_list("_near"))), 1, k).alias("_near"))
    votes = merged.withColumn("_votes", F.when(F.size("_near") > 0, F.transform("_near", lambda n: n["y"])))
    counted = F.transform(
        F.array_distinct("_votes"),
        lambda y: F.struct((-F.size(F.filter("_votes", lambda v: v == y))).alias("n"), y.alias("y")),
    )
    called = votes.select("_row", F.array_min(counted)["y"].alias(out), F.array_repeat(F.lit(1), F.col("_copies")).alias("_each"))
    return called.withColumn("_each", F.explode("_each")).select("_row.*", out)


def compared_share(train: DataFrame, test: DataFrame, features, k=7, by="symbol", order="date", pivots=PIVOTS) -> DataFrame:
    """``(by, pairs, compared)``: pairs of test and train rows of each symbol, and how many of them the cells leave."""
    point = F.array(*[F.col(c).cast("double") for c in features])
    points = train.select(by, point.alias("_x"), F.col(order).alias("day"), F.lit(0).alias("y"))
    chosen = pivot_points(points, by, "day", pivots)
    placed, cells = train_cells(points, chosen, by, 1)
    sizes = placed.groupBy(by).agg(F.count(F.lit(1)).alias("n"))
    asked = test.select(by, point.alias("_x")).join(chosen.join(cells, by), by)
    # One block per point: the pairs that are met are the points themselves.
    met = asked.select(by, F.size(reachable(k)).alias("met"))
    return met.groupBy(by).agg(F.count(F.lit(1)).alias("asked"), F.sum("met").alias("compared")).join(sizes, by).select(
        by, (F.col("asked") * F.col("n")).alias("pairs"), "compared"
    )
