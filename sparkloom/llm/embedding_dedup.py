"""Near-duplicates of vectors: spherical k-means cells, and blocked cosine products within them."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..store import written
from .blocks import block_of, blocks_for
from .components import connected_components, spanning_labels
from .tokens import group_edges, tidy, whole_groups

#: The cells are fitted on distinct vectors, the first by hash, of so many components at most; every vector is assigned.
SAMPLE_VALUES, ROUNDS, MOST_CELLS = 1 << 22, 8, 4096
#: Vectors meant for a cell. On vectors without clusters the cells that a vector visits grow faster with their number than
#: the products within a cell fall, so cells are large.
CELL = 8192
#: Vectors in a block of a cell and visitors that meet a block in one task, at most, and components of either.
BLOCK, GUESTS, BLOCK_VALUES = 16_384, 16_384, 1 << 21
SLACK = 1e-6


def unit_rows(column: pa.Array, dim: int) -> np.ndarray:
    """(rows, dim) unit vectors in double precision from a list column without nulls; shorter ones are filled with zeros."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    lengths = np.diff(column.offsets.to_numpy())
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    out = np.zeros((len(column), dim))
    if len(column):
        out[np.arange(dim)[None, :] < lengths[:, None]] = values
        out /= np.abs(out).max(axis=1, keepdims=True)  # so that squares neither vanish nor overflow
        out /= np.sqrt((out * out).sum(axis=1, keepdims=True))
    return out


def spherical_kmeans(x: np.ndarray, k: int, rounds: int = ROUNDS) -> np.ndarray:
    """(k or fewer, dim) unit centroids; starts from rows spread over the sample, empty cells go."""
    if not len(x):
        return x
    centres = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)]
    for _ in range(rounds):
        nearest = np.concatenate([np.argmax(x[i : i + 4096] @ centres.T, axis=1) for i in range(0, len(x), 4096)])
        order = np.argsort(nearest, kind="stable")
        used, first = np.unique(nearest[order], return_index=True)
        sums = np.add.reduceat(x[order], first, axis=0)
        norms = np.sqrt((sums * sums).sum(axis=1))
        centres = sums[norms > 1e-12] / norms[norms > 1e-12][:, None]
        if not len(used):
            break
    return centres


def margin(x: np.ndarray, home: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How much nearer each row is to its own centroid than to another; the same for the same row wherever it is computed."""
    return (x * (home - other)).sum(axis=1)


def visits(x: np.ndarray, centres: np.ndarray, reach: float) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The home cell of each row; and (row, cell, margin) of the other cells that may hold a partner whose margin is no less.

    If x of cell a and y of cell b are linked, |x - y| <= reach, and their margins to each other's cell add up to
    (x - y)(a - b) <= reach |a - b|. So the lesser of them is at most half of that, and its vector visits the other's cell.
    """
    home, rows, cells = [], [], []
    gaps = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 0)) * (reach / 2) + SLACK
    for i in range(0, len(x), 1024):
        near = x[i : i + 1024] @ centres.T
        own = np.argmax(near, axis=1)
        found = near[np.arange(len(own)), own][:, None] - near <= gaps[own]
        found[np.arange(len(own)), own] = False
        r, c = np.nonzero(found)
        home.append(own)
        rows.append(r + i)
        cells.append(c)
    home, rows, cells = np.concatenate(home), np.concatenate(rows), np.concatenate(cells)
    return home, rows, cells, margin(x[rows], centres[home[rows]], centres[cells])


def linked_pairs(x: np.ndarray, left: np.ndarray, right: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a left and a right row whose product is ``least`` or more in double precision; single precision finds them."""
    single = x.astype(np.float32)
    floor = np.float32(least - 1e-5 - 2e-7 * x.shape[1])
    lefts, rights = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for i in range(0, len(left), 512):
        for j in range(0, len(right), 4096):
            p, q = np.nonzero(single[left[i : i + 512]] @ single[right[j : j + 4096]].T >= floor)
            for k in range(0, len(p), 65_536):
                a, b = left[i + p[k : k + 65_536]], right[j + q[k : k + 65_536]]
                sure = (x[a] * x[b]).sum(axis=1) >= least
                lefts.append(a[sure])
                rights.append(b[sure])
    return np.concatenate(lefts), np.concatenate(rights)


def link_cells(table: pa.Table, dim: int, centres: np.ndarray, least: float) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each task of ``table`` the ids that have links in it, how many rows they link with, and a spanning neighbour.

    A task compares block bi of a cell's own vectors with block bj of them, or, where bj is negative, with visitors.
    """
    edges = group_edges(table, ["cell", "bi", "bj"])
    columns = {c: table.column(c).to_numpy() for c in ("cell", "bi", "bj", "own", "home", "margin", "node", "copies", "size")}
    vectors = table.column("embedding").combine_chunks()
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        g = {c: v[a:b] for c, v in columns.items()}
        cell, bi, bj = g["cell"][0], g["bi"][0], g["bj"][0]
        left = np.flatnonzero(g["own"] == bi)
        right = np.flatnonzero(g["own"] == (bj if bj >= 0 else -1))
        if b - a < 2 or not len(left) or not len(right):
            continue
        x = unit_rows(vectors.slice(a, b - a), dim)
        p, q = linked_pairs(x, left, right, least)
        keep = g["size"][p] == g["size"][q]
        if bj < 0:  # a pair from two cells is met where the vector with the lesser margin visits
            away = g["home"][q]
            back = margin(x[p], centres[np.full(len(p), cell)], centres[away])
            keep &= (g["margin"][q] < back) | ((g["margin"][q] == back) & (away < cell))
        elif bi == bj:
            keep &= p < q
        p, q = p[keep], q[keep]
        if not len(p):
            continue
        linked = np.bincount(p, weights=g["copies"][q], minlength=b - a) + np.bincount(q, weights=g["copies"][p], minlength=b - a)
        order = np.argsort(g["node"], kind="stable")
        place = np.empty(b - a, np.int64)
        place[order] = np.arange(b - a)
        root = spanning_labels(place[p], place[q], b - a)
        some = np.flatnonzero(linked > 0)
        yield g["node"][some], linked[some].astype(np.int64), g["node"][order][root[place[some]]]


def cell_tasks(placed: DataFrame, dim: int) -> DataFrame:
    """Each vector once for every task that needs it: its cell's own blocks in pairs, and each own block with each block of
    visitors. Visitors are not compared with each other.
    """
    guest = F.col("cell") != F.col("home")
    sizes = placed.groupBy("cell").agg(F.count_if(~guest).alias("own_members"), F.count_if(guest).alias("guest_members")).where("own_members > 0")
    rows = placed.join(F.broadcast(sizes), "cell")  # one row per cell: at most MOST_CELLS
    bound = max(1, BLOCK_VALUES // dim)
    blocks = blocks_for(F.col("own_members"), min(BLOCK, bound))
    halls = F.ceil(F.col("guest_members") / F.lit(min(GUESTS, bound))).cast("int")
    block = block_of(F.col("node"), blocks)
    hall = block_of(F.col("node"), F.greatest(halls, F.lit(1))) + 1
    inside = F.transform(F.sequence(F.lit(0), blocks - 1), lambda o: F.struct(F.least(block, o).alias("bi"), F.greatest(block, o).alias("bj")))
    hosting = F.when(halls > 0, F.transform(F.sequence(F.lit(1), F.greatest(halls, F.lit(1))), lambda h: F.struct(block.alias("bi"), (-h).alias("bj")))).otherwise(F.array().cast("array<struct<bi:int,bj:int>>"))
    visiting = F.transform(F.sequence(F.lit(0), blocks - 1), lambda o: F.struct(o.alias("bi"), (-hall).alias("bj")))
    rows = rows.withColumn("own", F.when(guest, F.lit(-1)).otherwise(block)).withColumn("task", F.explode(F.when(guest, visiting).otherwise(F.concat(inside, hosting))))
    return rows.select("cell", "task.bi", "task.bj", "own", "home", "margin", "node", "copies", F.size("embedding").alias("size"), "embedding")


def near_duplicates(vectors: DataFrame, least: float = 0.95, cells: int | None = None) -> DataFrame:
    """(vec_id, n_links, component_id, kept, class_id) for each row of ``vectors`` (vec_id, embedding).

    Two rows are linked if their cosine in double precision is ``least`` or more. n_links: other rows linked directly;
    component_id: smallest vec_id reachable over links; kept: whether that is the row's own; class_id: smallest vec_id of
    equal vectors, which are compared once. Vectors that are null, zero or hold null or non-finite components, vectors
    of different lengths, and rows without an id link with nothing and stand alone. Rows that repeat an id count as rows.
    An empty table gives no rows; other columns are not read. Every pair of linked vectors is found: a vector also
    visits each cell that can hold a partner (see ``visits``), and a pair counts once.
    """
    spark = vectors.sparkSession
    sound = F.size("embedding") > 0
    sound &= ~F.exists("embedding", lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf"))) & F.exists("embedding", lambda v: v != 0)
    kind = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"))
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False)) & F.col("vec_id").isNotNull())
    digest = [F.when(F.col("sound"), F.xxhash64("embedding")).alias("h1"), F.when(F.col("sound"), F.xxhash64(F.lit(7), "embedding")).alias("h2")]
    keyed = rows.select("vec_id", "embedding", *digest)
    classes = keyed.where("h1 IS NOT NULL").groupBy("h1", "h2").agg(F.min("vec_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("embedding").alias("embedding"))
    classes = written(classes, "vector-classes")
    count, dim = classes.agg(F.count(F.lit(1)), F.max(F.size("embedding"))).first()
    dim = dim or 1
    sample = classes.orderBy(F.xxhash64("h1"), "h2").limit(max(1, SAMPLE_VALUES // dim)).select("embedding").toArrow()
    k = cells or min(MOST_CELLS, max(1, ceil(count / CELL)))
    centres = spherical_kmeans(unit_rows(sample.column(0), dim), k)
    reach = sqrt(max(0.0, 2 - 2 * least))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            home, guests, abroad, margins = visits(unit_rows(batch.column("embedding"), dim), centres, reach)
            at = np.concatenate([np.arange(len(home)), guests])
            taken = batch.take(pa.array(at))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate([home, abroad])), pa.array(home[at]), pa.array(np.concatenate([np.zeros(len(home)), margins])), taken.column("node"), taken.column("copies"), taken.column("embedding")],
                ["cell", "home", "margin", "node", "copies", "embedding"],
            )

    schema = f"cell long, home long, margin double, node long, copies long, embedding {kind}"
    placed = written(classes.select("node", "copies", "embedding").mapInArrow(tidy(assign), schema), "vector-cells")
    tasks = cell_tasks(placed, dim).repartition("cell", "bi", "bj").sortWithinPartitions("cell", "bi", "bj")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in whole_groups(batches, ["cell", "bi", "bj"]):
            for node, linked, root in link_cells(groups, dim, centres, least):
                yield pa.RecordBatch.from_arrays([pa.array(node), pa.array(linked), pa.array(root)], ["node", "linked", "root"])

    found = written(tasks.mapInArrow(tidy(compare), "node long, linked long, root long"), "vector-links")
    counts = found.groupBy("node").agg(F.sum("linked").alias("linked"))
    component = connected_components(found.select(F.col("node").alias("u"), F.col("root").alias("v")))
    linked = counts.join(component, "node").withColumnRenamed("node", "linked_node")
    told = classes.select(F.col("h1").alias("c1"), F.col("h2").alias("c2"), "node", "copies").join(linked, F.col("node") == F.col("linked_node"), "left")
    told = told.select("c1", "c2", "node", "copies", F.coalesce("linked", F.lit(0)).alias("linked"), F.coalesce("component", "node").alias("component"))
    out = keyed.select("vec_id", "h1", "h2").join(told, (F.col("h1") == F.col("c1")) & (F.col("h2") == F.col("c2")), "left")
    component_id = F.coalesce("component", "vec_id")
    return out.select(
        "vec_id",
        F.coalesce(F.col("linked") + F.col("copies") - 1, F.lit(0)).cast("long").alias("n_links"),
        component_id.alias("component_id"),
        F.coalesce(F.col("vec_id") == component_id, F.lit(True)).alias("kept"),
        F.coalesce("node", "vec_id").alias("class_id"),
    )
