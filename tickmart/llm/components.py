"""Connected components by repeated joins."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickmart.session import materialize


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars with the same components as the given links: each node but the least with the least."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[x], label[y])
        before = label.copy()
        np.minimum.at(label, label[x], low)
        np.minimum.at(label, label[y], low)
        label = label[label]
        if np.array_equal(label, before):
            break
    others = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[label[others]], nodes[others]


def thin_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The links of each batch as stars."""
    for batch in batches:
        a, b = forest(batch.column(0).to_numpy(), batch.column(1).to_numpy())
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node, label): each node of ``links`` (a, b: bigint) with the least node of its component.

    Every node takes the least label among its neighbours and then its label's label, until nothing
    changes: a number of rounds about logarithmic in the length of the longest chain. Each round is
    written, so a lost executor repeats one round at most. Nothing is collected but the number of
    changed labels; a node of very many links is split by adaptive execution, as the joins are
    plain ones.
    """
    thin = links.select("a", "b").mapInArrow(thin_links, "a bigint, b bigint").where("a <> b").distinct()
    both = materialize(thin.select("a", "b").union(thin.select("b", "a")), "links")
    labels = both.groupBy(F.col("a").alias("node")).agg(F.least(F.min("b"), F.col("node")).alias("label"))
    labels = materialize(labels, "labels")
    while True:
        of_neighbour = labels.select(F.col("node").alias("b"), F.col("label").alias("theirs"))
        near = both.join(of_neighbour, "b").groupBy(F.col("a").alias("node")).agg(F.min("theirs").alias("theirs"))
        met = labels.join(near, "node").select("node", "label", F.least("label", "theirs").alias("nearer"))
        of_label = labels.select(F.col("node").alias("nearer"), F.col("label").alias("further"))
        jumped = met.join(of_label, "nearer").select("node", F.least("nearer", "further").alias("new"), "label")
        jumped = materialize(jumped, "labels")
        changed = jumped.where("new <> label").limit(1).count()
        labels = jumped.select("node", F.col("new").alias("label"))
        if not changed:
            return labels
