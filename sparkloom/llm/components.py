"""Distributed connected components, and spanning edges of a block of links."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..store import drop_path, scratch_path, written


#: A node's links are dealt over so many tasks by their other ends.
SALTS = 64
#: So few links, once the rounds have left no more, are solved by the driver at once: every round writes and deals a table.
FEW_LINKS = 500_000


def with_least(links: DataFrame) -> DataFrame:
    """``links`` (u, v) with m, the least v of each u.

    Minima are taken by (u, salt of v) first, and meet the links again by both: a hub's links are never in one task, and
    at most SALTS rows of a node are.
    """
    salted = links.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)))
    parts = salted.groupBy("u", "salt").agg(F.min("v").alias("m"))
    whole = parts.groupBy("u").agg(F.min("m").alias("m"))
    return salted.join(parts.select("u", "salt").join(whole, "u"), ["u", "salt"]).drop("salt")


def beside(rows: DataFrame, told: DataFrame, key: str, other: str) -> DataFrame:
    """``rows`` joined with ``told``, which has one row for each ``key``; a frequent key's rows are dealt by ``other``."""
    salted = rows.withColumn("salt", F.pmod(F.xxhash64(other), F.lit(SALTS)))
    return salted.join(salted.select(key, "salt").distinct().join(told, key), [key, "salt"]).drop("salt")


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows (node, component) for every node of ``edges`` (u, v: long or string); component is the smallest node reachable.

    Alternating large-star and small-star rounds: each node's links move to its smallest neighbour until all point at
    the root, or until FEW_LINKS are left, which ``solved`` follows to the end. Every round is a table in the shared
    folder. A hub's links are dealt over several tasks and never gathered in one row. Null ends and loops are ignored; no
    edges give no rows.
    """
    spark = edges.sparkSession

    def save(df: DataFrame) -> tuple[DataFrame, str, tuple]:
        path = scratch_path(spark, "components")
        df = written(df, "components", path)
        mark = df.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v")), F.sum(F.xxhash64("v", "u").bitwiseAND(F.lit(0xFFFFFFFF)))).first()
        return df, path, tuple(mark)

    links = edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    links, path, mark = save(links)
    while mark[0] > FEW_LINKS:
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = with_least(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        small = with_least(large).select("u", "v", "m")
        moved = small.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        following, at, now = save(moved.unionByName(small.select("u", F.col("m").alias("v"))).distinct())
        drop_path(spark, path)
        links, path, before, mark = following, at, mark, now
        if now == before:
            break
    else:
        return solved(links)
    roots = links.select(F.col("v").alias("node")).distinct()
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots.select("node", F.col("node").alias("component")))


def solved(links: DataFrame) -> DataFrame:
    """(node, component) of a bounded number of ``links`` (u, v), by the driver. Rounds keep every node in some link."""
    held = links.toArrow()
    ends = [held.column(x).to_numpy() for x in ("u", "v")]
    nodes, place = np.unique(np.concatenate(ends), return_inverse=True)
    root = spanning_labels(place[: len(ends[0])], place[len(ends[0]) :], len(nodes))
    kind = held.schema.field("u").type
    out = pa.table({"node": pa.array(nodes, kind), "component": pa.array(nodes[root], kind)})
    return written(links.sparkSession.createDataFrame(out), "components-solved")


def spanning_labels(left: np.ndarray, right: np.ndarray, n: int) -> np.ndarray:
    """Smallest index reachable from each of n indices over the links left[i]-right[i]."""
    label = np.arange(n)
    while len(left):
        low = np.minimum(label[left], label[right])
        new = label.copy()
        np.minimum.at(new, left, low)
        np.minimum.at(new, right, low)
        np.minimum.at(new, label[left], low)
        np.minimum.at(new, label[right], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label
