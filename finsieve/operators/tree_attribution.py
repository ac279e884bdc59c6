"""Path-dependent Shapley values of boosted trees over raw features, from the trees and their training counts.

What a model expects of a row of which only the features S are known: along every tree, a split on a known
feature sends the row its way and a split on another sends it both ways, in proportion to the training weight
of the two sides. No background rows are needed. A leaf's part in that is a product with one factor a raw
feature, so its contributions depend on nothing but which features' splits the row passes on the way to the leaf.
They are tabulated once per leaf; explaining a row is then a walk over the nodes and a look-up at each leaf.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import combinations
from math import factorial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.classification import GBTClassificationModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame

from finsieve.constants import MODEL_FEATURES
from finsieve.operators.attribution import NoMarginError, margin
from finsieve.session import new_path

#: A leaf's table has two to the number of features entries.
MOST_FEATURES = 12
ROWS = 2048


class Node(NamedTuple):
    """A node of a tree: a leaf has no children and a row in the tables; a split sends ``lows`` left."""

    slot: int
    group: int
    lows: tuple[float, ...] | None
    threshold: float
    left: int
    right: int
    leaf: int


class Trees(NamedTuple):
    """Compiled trees: their nodes, the contributions of each leaf by passed features, and the expectation of no feature known."""

    trees: list[list[Node]]
    tables: np.ndarray
    base: float


def slot_groups(model: PipelineModel, features: Sequence[str], attributes: dict) -> list[int]:
    """The raw feature of every slot of the assembled vector, by the names that the assembler gave its slots."""
    inputs = next(s for s in reversed(model.stages) if isinstance(s, VectorAssembler)).getInputCols()
    names = {a["idx"]: a["name"] for kind in attributes["ml_attr"]["attrs"].values() for a in kind}
    out = []
    for k in range(attributes["ml_attr"]["num_attrs"]):
        source = max((c for c in inputs if names[k] == c or names[k].startswith(c + "_")), key=len)
        out.append(features.index(source.removesuffix("_oh").removesuffix("_bin")))
    return out


def contributions(values: np.ndarray, shares: np.ndarray) -> np.ndarray:
    """(leaf, passed, feature): Shapley values of a leaf's value times a factor a feature, 1 or 0 where known and its share where not.

    ``passed`` is a set of features as bits.
    """
    m = shares.shape[1]
    passed = (np.arange(1 << m)[:, None] >> np.arange(m) & 1).astype(float)
    out = np.zeros((len(values), 1 << m, m))
    for f in range(m):
        others = [g for g in range(m) if g != f]
        for size in range(m):
            weight = factorial(size) * factorial(m - size - 1) / factorial(m)
            for known in combinations(others, size):
                unknown = [g for g in others if g not in known]
                rest = values * np.prod(shares[:, unknown], axis=1) * weight
                out[:, :, f] += rest[:, None] * np.prod(passed[:, list(known)], axis=1)
        out[:, :, f] *= passed[None, :, f] - shares[:, f, None]
    return out


def compile_trees(model: PipelineModel, attributes: dict, spark, features: Sequence[str] = MODEL_FEATURES) -> Trees:
    """Read the boosted stage's own tables: one row a node, with its split, prediction and training weight."""
    last = model.stages[-1]
    if not isinstance(last, GBTClassificationModel):
        raise NoMarginError(f"{type(last).__name__} is not boosted trees")
    if len(features) > MOST_FEATURES:
        raise ValueError(f"at most {MOST_FEATURES} features can be tabulated")
    groups = slot_groups(model, features, attributes)
    path = new_path(spark, "trees")
    last.write().save(path)
    nodes: dict[int, dict[int, object]] = {}
    # As many rows as the model has nodes.
    for r in spark.read.parquet(f"{path}/data").collect():
        nodes.setdefault(r.treeID, {})[r.nodeData.id] = r.nodeData
    trees, values, shares = [], [], []
    for k in sorted(nodes):
        tree, own = [], nodes[k]
        places = {number: at for at, number in enumerate(sorted(own))}

        def walk(number: int, share: np.ndarray, tree=tree, own=own, places=places, k=k) -> None:
            node = own[number]
            if node.leftChild < 0:
                tree[places[number]] = Node(-1, -1, None, 0.0, -1, -1, len(values))
                # A margin is twice what the trees add up to.
                values.append(2.0 * last.treeWeights[k] * node.prediction)
                shares.append(share)
                return
            slot, cut = node.split.featureIndex, node.split.leftCategoriesOrThreshold
            lows = None if node.split.numCategories < 0 else tuple(cut)
            group = groups[slot]
            tree[places[number]] = Node(slot, group, lows, cut[0] if lows is None else 0.0, places[node.leftChild], places[node.rightChild], -1)
            for child in (node.leftChild, node.rightChild):
                part = share.copy()
                part[group] *= own[child].impurityStats[0] / node.impurityStats[0]
                walk(child, part)

        tree.extend([None] * len(own))
        walk(min(own), np.ones(len(features)))
        trees.append(tree)
    values, shares = np.array(values), np.array(shares)
    return Trees(trees, contributions(values, shares), float((values * shares.prod(1)).sum()))


def explain(compiled: Trees, x: np.ndarray) -> np.ndarray:
    """Contributions of the rows of ``x``, assembled features, to each raw feature."""
    out = np.zeros((len(x), compiled.tables.shape[2]))
    all_bits = (1 << out.shape[1]) - 1
    for tree in compiled.trees:
        todo = [(0, np.full(len(x), all_bits, np.int64))]
        while todo:
            at, passed = todo.pop()
            node = tree[at]
            if node.leaf >= 0:
                out += compiled.tables[node.leaf][passed]
                continue
            column = x[:, node.slot]
            left = column <= node.threshold if node.lows is None else np.isin(column, node.lows)
            blocked = passed & ~(1 << node.group)
            todo += [(node.left, np.where(left, passed, blocked)), (node.right, np.where(left, blocked, passed))]
    return out


def tree_attribution(model: PipelineModel, rows: DataFrame, features: Sequence[str] = MODEL_FEATURES) -> DataFrame:
    """Exact Shapley values, wide: row_id, base, margin, phi_<feature>; base plus the contributions is the margin.

    Rows stay where they are. The compiled trees travel with the task; they are as large as the model.
    """
    scored = margin(model)(rows)
    compiled = compile_trees(model, scored.schema["features"].metadata, rows.sparkSession, features)
    picked = scored.select("row_id", "margin", vector_to_array("features").alias("x"))
    names = ["row_id", "base", "margin", *[f"phi_{f}" for f in features]]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS):
                part = batch.slice(start, ROWS)
                x = np.asarray(part.column("x").flatten(), float).reshape(part.num_rows, -1)
                phi = explain(compiled, x)
                base = pa.array(np.full(part.num_rows, compiled.base))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row_id"), base, part.column("margin"), *[pa.array(np.ascontiguousarray(c)) for c in phi.T]], names=names
                )

    kind = picked.schema["row_id"].dataType.simpleString()
    return picked.mapInArrow(run, f"row_id {kind}, base double, margin double, " + ", ".join(f"`phi_{f}` double" for f in features))
