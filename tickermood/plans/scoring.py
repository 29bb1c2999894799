"""Fitted models as tables of numbers, and their scores as expressions.

A model that is a table can be kept, compared and read by any engine, and what it says of
a row needs no ML runtime: the tables become constants of an expression that works where
the row is, on a batch and on a stream. What goes to the driver is one model, whose size
its depth, trees or layers fix.

Inputs are named in the order of the model's feature vector.
"""

import json

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tickermood.functions.columns import feature_columns
from tickermood.schemas import LINEAR_MODEL, PERCEPTRON, TREE_NODES
from tickermood.session import scratch_path
from tickermood.sources.local import small_frame


def _literal(value, kind: str) -> str:
    return f"from_json('{json.dumps(value)}', '{kind}')"


def _inputs(inputs) -> str:
    return "array(" + ", ".join(f"cast(`{c}` as double)" for c in inputs) + ")"


# --- trees ------------------------------------------------------------------


def tree_nodes(model: PipelineModel) -> DataFrame:
    """The nodes of a fitted forest or boosted ensemble, one row each.

    ``(tree, weight, node, feature, threshold, left_node, right_node, down, up)``: a row of
    features goes left where its ``feature`` is at most ``threshold``; a leaf has feature -1 and says how
    much it adds to both classes. Nodes of a tree are numbered from 0, the root.
    """
    spark, last = SparkSession.active(), model.stages[-1]
    path = scratch_path(spark, "trees")
    last.write().save(path)
    weights = spark.createDataFrame(list(enumerate(map(float, last.treeWeights))), "tree int, weight double")
    node = spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*")
    leaf = F.col("leftChild") < 0
    boosted = "GBT" in type(last).__name__
    share = lambda k: F.col("impurityStats")[k] / F.aggregate("impurityStats", F.lit(0.0), lambda s, x: s + x)
    down, up = (-F.col("prediction"), F.col("prediction")) if boosted else (share(0), share(1))
    rows = node.select(
        F.col("treeID").alias("tree"), F.col("id").alias("node"), F.when(leaf, -1).otherwise(F.col("split.featureIndex")).alias("feature"),
        F.when(~leaf, F.get("split.leftCategoriesOrThreshold", F.lit(0))).alias("threshold"),
        F.col("leftChild").alias("left_node"), F.col("rightChild").alias("right_node"),
        F.when(leaf, down).alias("down"), F.when(leaf, up).alias("up"),
    )
    return rows.join(weights, "tree").select(*[f.name for f in TREE_NODES.fields])


def tree_votes(nodes: DataFrame, inputs) -> Column:
    """struct<down, up>: the weighted sum of what the leaves of all trees say of a row."""
    trees: dict = {}
    for n in sorted(nodes.collect(), key=lambda n: (n["tree"], n["node"])):
        at = trees.setdefault(n["tree"], [])
        if n["node"] != len(at):
            raise ValueError(f"the nodes of tree {n['tree']} are not numbered from 0 without gaps")
        at.append([n["feature"], n["threshold"], n["left_node"], n["right_node"], n["down"], n["up"], n["weight"]])
    fields = ["f", "t", "l", "r", "down", "up", "w"]
    listed = [[dict(zip(fields, n)) for n in tree] for tree in trees.values()]
    kind = "array<array<struct<f:int,t:double,l:int,r:int,down:double,up:double,w:double>>>"
    depth = max((_depth(tree) for tree in listed), default=0)
    leaf = f"""aggregate(sequence(0, {depth}), n[0],
        (c, step) -> if(c.f < 0, c, n[if(x[c.f] <= c.t, c.l, c.r)]))"""
    # The row's inputs and the leaves are arrays of one, so that each is computed once.
    leaves = f"flatten(transform(array({_inputs(inputs)}), x -> transform({_literal(listed, kind)}, n -> {leaf})))"
    return F.expr(
        f"""aggregate({leaves}, named_struct('down', 0D, 'up', 0D),
        (s, c) -> named_struct('down', s.down + c.w * c.down, 'up', s.up + c.w * c.up))"""
    )


def _depth(tree: list[dict]) -> int:
    depth = [0] * len(tree)
    for at in reversed(range(len(tree))):
        if tree[at]["f"] >= 0:
            depth[at] = 1 + max(depth[tree[at]["l"]], depth[tree[at]["r"]])
    return depth[0] if tree else 0


# --- perceptrons ------------------------------------------------------------


def perceptron_weights(model: PipelineModel) -> DataFrame:
    """``(layer, unit, input, weight)`` of a fitted perceptron; input -1 is the unit's bias."""
    last = model.stages[-1]
    sizes, flat = last.getOrDefault("layers"), last.weights.toArray().tolist()
    rows, at = [], 0
    for layer, (n_in, n_out) in enumerate(zip(sizes, sizes[1:])):
        # Column after column of the matrix, then the biases.
        for k in range(n_in * n_out):
            rows.append((layer, k % n_out, k // n_out, flat[at + k]))
        at += n_in * n_out
        rows += [(layer, unit, -1, flat[at + unit]) for unit in range(n_out)]
        at += n_out
    return small_frame(SparkSession.active(), rows, PERCEPTRON)


def perceptron_probabilities(weights: DataFrame, x: str) -> Column:
    """array<double>: the probability of each class for the array of inputs ``x``, SQL text.

    A layer is a product of a matrix and a vector; units of inner layers have the logistic
    function, the last layer a softmax.
    """
    layers: dict = {}
    for r in weights.collect():
        layers.setdefault(r["layer"], {}).setdefault(r["unit"], {})[r["input"]] = r["weight"]
    value, last = x, max(layers)
    for layer in range(last + 1):
        units = [layers[layer][u] for u in range(len(layers[layer]))]
        rows = [{"b": u.get(-1, 0.0), "w": [u[i] for i in range(len(u) - (-1 in u))]} for u in units]
        matrix = _literal(rows, "array<struct<b:double,w:array<double>>>")
        product = "u.b + aggregate(zip_with(u.w, v, (a, b) -> a * b), 0D, (s, p) -> s + p)"
        unit = product if layer == last else f"1D / (1D + exp(-({product})))"
        value = f"flatten(transform(array({value}), v -> transform({matrix}, u -> {unit})))"
    top = f"transform(array({value}), z -> transform(z, a -> exp(a - array_max(z))))"
    return F.expr(f"flatten(transform({top}, e -> transform(e, a -> a / aggregate(e, 0D, (s, b) -> s + b))))")


# --- linear models ----------------------------------------------------------


def linear_rows(model: PipelineModel, emotion: bool) -> DataFrame:
    """``(input, mean, deviation, coefficient)`` of a fitted pipeline, scaler included; input '' is the intercept."""
    last = model.stages[-1]
    scaler = next((s for s in model.stages if type(s).__name__ == "StandardScalerModel"), None)
    rows = [("", 0.0, 1.0, float(last.intercept))]
    for name, coefficient in zip(feature_columns(emotion), last.coefficients.toArray().tolist()):
        scaled = scaler is not None and name == "volume_percent_change"
        mean, deviation = (float(scaler.mean[0]), float(scaler.std[0])) if scaled else (0.0, 1.0)
        rows.append((name, mean, deviation, coefficient))
    return small_frame(SparkSession.active(), rows, LINEAR_MODEL)


def linear_score(rows: DataFrame) -> Column:
    """The intercept and the sum of coefficient times scaled input. An input without deviation counts as 0."""
    total = F.lit(0.0)
    for r in sorted(rows.collect(), key=lambda r: r["input"]):
        if not r["input"]:
            total += F.lit(r["coefficient"])
        elif r["deviation"]:
            total += F.lit(r["coefficient"]) * (F.col(r["input"]).cast("double") - r["mean"]) / r["deviation"]
    return total


def called(score: Column) -> Column:
    """1 where a score is above zero, else 0: the prediction of a linear classifier."""
    return F.when(score > 0, 1.0).otherwise(0.0)
