"""Trees of ``boosting`` as a model of Spark ML. Apart from them, so that tasks that count histograms need not import Spark ML."""

from __future__ import annotations

import json
import time
import uuid

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.sql import SparkSession

from showroom.plans.boosting import STEP, Head, Node
from showroom.session import ensure_shared_folder


def _listed(tree: list[Node], head: Head) -> list[tuple]:
    """Nodes as Spark ML stores them, each before its children and the left ones first."""
    out: list = []

    def add(i: int) -> int:
        place, node = len(out), tree[i]
        out.append(None)
        split, children, gain = (-1, [], -1), (-1, -1), -1.0
        if node.split is not None:
            children, gain = (add(node.left), add(node.right)), node.gain
            split = (node.split[0], [float(head.borders[node.split[0]][node.split[1]])], -1)
        stats = [node.sums[1], node.sums[2], node.sums[3]]
        out[place] = (place, node.value, node.variance, stats, int(round(node.sums[0])), gain, *children, split)
        return place

    add(0)
    return out


_TREES = """treeID int, nodeData struct<id:int, prediction:double, impurity:double, impurityStats:array<double>, rawCount:bigint, gain:double,
leftChild:int, rightChild:int, split:struct<featureIndex:int, leftCategoriesOrThreshold:array<double>, numCategories:int>>"""


def as_model(spark: SparkSession, trees: list[list[Node]], head: Head, estimator: GBTClassifier) -> GBTClassificationModel:
    """The trees in the format of a saved model, loaded by Spark ML. Leaves that no pass has counted have a variance of 0."""
    path = f"{ensure_shared_folder(spark)}/boosted/{uuid.uuid4().hex}"
    given = {p.name: x for p, x in estimator.extractParamMap().items() if estimator.isSet(p)}
    about = {"timestamp": int(time.time() * 1000), "sparkVersion": spark.version, "defaultParamMap": {"impurity": "variance"}}
    own = about | {
        "class": "org.apache.spark.ml.classification.GBTClassificationModel", "uid": estimator.uid, "paramMap": given,
        "numFeatures": len(head.columns), "numTrees": len(trees)}
    spark.createDataFrame([(json.dumps(own),)], "value string").coalesce(1).write.text(f"{path}/metadata")
    of_tree = lambda i: about | {
        "class": "org.apache.spark.ml.regression.DecisionTreeRegressionModel", "uid": f"{estimator.uid}_{i}",
        "paramMap": {k: x for k, x in given.items() if k in ("featuresCol", "labelCol", "weightCol", "maxDepth", "seed")}}
    rows = [(i, json.dumps(of_tree(i)), STEP if i else 1.0) for i in range(len(trees))]
    spark.createDataFrame(rows, "_1 int, _2 string, _3 double").coalesce(1).write.parquet(f"{path}/treesMetadata")
    nodes = [(i, node) for i, tree in enumerate(trees) for node in _listed(tree, head)]
    spark.createDataFrame(nodes, _TREES).coalesce(1).write.parquet(f"{path}/data")
    return GBTClassificationModel.load(path)
