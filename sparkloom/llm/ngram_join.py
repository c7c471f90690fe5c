"""Similarity join of documents by n-gram Jaccard: MinHash bands find candidates, whole n-gram sets decide."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from math import ceil, log, sqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from ..store import written
from .blocks import blocks_for, crossing_blocks, own_blocks, paired_blocks
from .components import connected_components, spanning_labels
from .tokens import PLAIN, SPACE, Slice, bounds, group_edges, mix, slices, span_hashes, tidy, whole_groups

#: Members of a block when signatures and when whole sets are compared, and bytes of the latter.
SIGNATURE_BLOCK, SET_BLOCK, SET_BYTES = 4096, 512, 32 << 20
#: Members of either side of one product within a block.
PART = 256
#: Rows of ids, with what is known of them, that are broadcast to the texts; more are joined by a shuffle of both.
BROADCAST_ROWS = 500_000
#: n-grams that are columns of one product.
COLUMNS = 8192


@dataclass(frozen=True)
class Bands:
    """Bands of ``rows`` values each, as many as find a pair at the threshold with the target probability."""

    threshold: float = 0.8
    recall: float = 0.99999
    rows: int = 4

    @property
    def bands(self) -> int:
        return max(1, ceil(log(1 - self.recall) / log(1 - self.threshold**self.rows)))

    @property
    def size(self) -> int:
        return self.bands * self.rows

    @property
    def least_equal(self) -> int:
        """Equal signature values below which a pair is not at the threshold: six deviations under it."""
        t = self.threshold
        return max(1, int(self.size * (t - 6 * sqrt(t * (1 - t) / self.size))))


def gram_hashes(part: Slice, n: int) -> tuple[np.ndarray, np.ndarray]:
    """n-grams of words as hashes, and their ascending rows. A text of fewer words has all its words as its one gram."""
    starts, ends, rows = part.spans(SPACE)
    words = span_hashes(part.data, starts, ends, PLAIN)
    salts = mix(np.arange(1, n + 1, dtype=np.uint64)) | np.uint64(1)
    count = max(0, len(words) - n + 1)
    long = np.flatnonzero(rows[n - 1 :] == rows[:count]) if count else np.zeros(0, np.int64)
    grams = np.zeros(len(long), np.uint64)
    for k in range(n):
        grams += mix(words[long + k] * salts[k])
    edges = bounds(rows, part.rows)
    lengths = np.diff(edges)
    short = np.flatnonzero((lengths > 0) & (lengths < n))
    if len(short):
        sums = mix(lengths[short].astype(np.uint64))
        for k in range(n - 1):
            there = lengths[short] > k
            sums[there] += mix(words[edges[:-1][short[there]] + k] * salts[k])
        grams, at = np.concatenate([grams, sums]), np.concatenate([rows[long], short])
        order = np.argsort(at, kind="stable")
        return mix(grams[order]), at[order]
    return mix(grams), rows[long]


def signatures(grams: np.ndarray, edges: np.ndarray, size: int) -> np.ndarray:
    """(texts, size) 32-bit minima, for texts that all have grams."""
    factors = mix(np.arange(1, size + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
    out = np.empty((len(edges) - 1, size), np.uint32)
    for i, factor in enumerate(factors):
        out[:, i] = np.minimum.reduceat(grams * factor, edges[:-1]) >> np.uint64(32)
    return out


def band_keys(sig: np.ndarray, bands: Bands) -> np.ndarray:
    keys = np.empty((len(sig), bands.bands), np.uint64)
    for b in range(bands.bands):
        key = np.full(len(sig), b + 1, np.uint64)
        for r in range(bands.rows):
            key = mix(key * np.uint64(0x9FB21C651E98DF25) + sig[:, b * bands.rows + r])
        keys[:, b] = key
    return keys.view(np.int64)


def content_digest(text: bytes) -> bytes:
    return hashlib.blake2b(b" ".join(text.split()), digest_size=16).digest()


def texts_of(part: Slice) -> list[bytes]:
    content = part.data.tobytes()
    return [content[a:b] for a, b in zip(part.offsets[:-1], part.offsets[1:], strict=True)]


def sign_documents(docs: DataFrame, n: int, bands: Bands) -> DataFrame:
    """(doc_id, digest, grams, keys, sig); all but the first are null for texts without words and rows without an id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch.column(1)):
                ids = batch.column(0).slice(part.first, part.rows)
                grams, rows = gram_hashes(part, n)
                edges = bounds(rows, part.rows)
                full = np.flatnonzero((np.diff(edges) > 0) & ids.is_valid().to_numpy(zero_copy_only=False))
                digests, counts, keys, sigs = ([None] * part.rows for _ in range(4))
                some = np.flatnonzero(np.diff(edges) > 0)
                if len(some):
                    sig = signatures(grams, np.r_[edges[:-1][some], len(grams)], bands.size)
                    key = band_keys(sig, bands)
                    place = np.zeros(part.rows, np.int64)
                    place[some] = np.arange(len(some))
                    texts = texts_of(part)
                    for row in full:
                        digests[row], counts[row], keys[row], sigs[row] = content_digest(texts[row]), edges[row + 1] - edges[row], key[place[row]], sig[place[row]].tobytes()
                yield pa.RecordBatch.from_arrays([ids, pa.array(digests, pa.binary()), pa.array(counts, pa.int64()), pa.array(keys, pa.list_(pa.int64())), pa.array(sigs, pa.binary())], ["doc_id", "digest", "grams", "keys", "sig"])

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(tidy(run), "doc_id long, digest binary, grams long, keys array<long>, sig binary")


def rows_to_links(node: np.ndarray, copies: np.ndarray, p: np.ndarray, q: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The linked nodes, with how many rows each links, and the least node each reaches."""
    n = len(node)
    linked = np.bincount(p, weights=copies[q], minlength=n) + np.bincount(q, weights=copies[p], minlength=n)
    order = np.argsort(node, kind="stable")
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    root = spanning_labels(place[p], place[q], n)
    some = np.flatnonzero(linked > 0)
    return node[some], linked[some].astype(np.int64), node[order][root[place[some]]]


def linked_parts(left: np.ndarray, right: np.ndarray, n: int, compare: Callable[[np.ndarray, np.ndarray], np.ndarray], every: bool) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of the members ``left`` and ``right`` (the same array: of one block) that ``compare`` links, part by part.

    Without ``every`` the pairs only connect what is linked: parts whose members are all connected are not compared, so a
    group of copies takes work in proportion to its size.
    """
    label, lefts, rights = np.arange(n), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    same = left is right
    for i in range(0, len(left), PART):
        for j in range(i if same else 0, len(right), PART):
            x, y = left[i : i + PART], right[j : j + PART]
            if not every and (label[x] == label[x[0]]).all() and (label[y] == label[x[0]]).all():
                continue
            p, q = np.nonzero(compare(x, x if same and i == j else y))
            p, q = x[p], y[q]
            keep = p < q if same and i == j else p != q
            p, q = p[keep], q[keep]
            lefts.append(p)
            rights.append(q)
            if not every and len(p):
                label = spanning_labels(label[p], label[q], n)[label]
    return np.concatenate(lefts), np.concatenate(rights)


def alike(groups: pa.Table, bands: Bands) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Spanning neighbours of the members of each task whose signatures are near enough."""
    columns = {c: groups.column(c).to_numpy() for c in ("bi", "bj", "own", "node")}
    sig = np.frombuffer(b"".join(groups.column("sig").to_pylist()), np.uint32).reshape(-1, bands.size)
    edges = group_edges(groups, ["band", "bi", "bj"])
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b - a < 2:
            continue
        own, bi, bj, s = columns["own"][a:b], columns["bi"][a], columns["bj"][a], sig[a:b]
        left = np.flatnonzero(own == bi)
        right = left if bi == bj else np.flatnonzero(own == bj)
        p, q = linked_parts(left, right, b - a, lambda x, y: (s[x][:, None, :] == s[y][None, :, :]).sum(axis=2) >= bands.least_equal, False)  # noqa: B023
        if len(p):
            found, _, root = rows_to_links(columns["node"][a:b], np.ones(b - a), p, q)
            yield found, root


def shared_counts(sets: list[np.ndarray], cut: int = 0) -> np.ndarray:
    """How many members each pair of sorted unique sets shares, as products over the members that two or more have; with
    ``cut`` of each of the first ``cut`` sets with each of the others."""
    every = np.concatenate(sets)
    values, inverse, counts = np.unique(every, return_inverse=True, return_counts=True)
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    several = counts > 1
    place = np.cumsum(several) - 1
    keep = several[inverse]
    rows, columns = rows[keep], place[inverse[keep]]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    total = np.zeros((cut, len(sets) - cut) if cut else (len(sets), len(sets)), np.float64)
    width = int(several.sum())
    cuts = np.searchsorted(columns, np.arange(0, width + COLUMNS, COLUMNS))
    for start, (a, b) in zip(range(0, width, COLUMNS), zip(cuts[:-1], cuts[1:], strict=True), strict=False):
        held = np.zeros((len(sets), min(COLUMNS, width - start)), np.float32)
        held[rows[a:b], columns[a:b] - start] = 1
        total += held[:cut] @ held[cut:].T if cut else held @ held.T
    return total


def similar(groups: pa.Table, threshold: float, every: bool) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Links of each task's members by the Jaccard similarity of their whole sets, all of them or what connects them."""
    columns = {c: groups.column(c).to_numpy() for c in ("bi", "bj", "own", "node", "copies")}
    grams = groups.column("grams").to_pylist()
    edges = group_edges(groups, ["cluster", "bi", "bj"])
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        _, first = np.unique(columns["node"][a:b], return_index=True)  # rows that repeat an id and its text are one
        if len(first) < 2:
            continue
        at = a + first
        own, bi, bj = columns["own"][at], columns["bi"][a], columns["bj"][a]
        sets = [np.frombuffer(grams[i], np.uint64) for i in at]
        sizes = np.array([len(s) for s in sets], np.float64)

        def compare(x: np.ndarray, y: np.ndarray) -> np.ndarray:
            if x is y:
                both = shared_counts([sets[i] for i in x])  # noqa: B023
            else:
                both = shared_counts([sets[i] for i in (*x, *y)], len(x))  # noqa: B023
            return both / (sizes[x][:, None] + sizes[y][None, :] - both) >= threshold  # noqa: B023

        left = np.flatnonzero(own == bi)
        p, q = linked_parts(left, left if bi == bj else np.flatnonzero(own == bj), len(at), compare, every)
        if len(p):
            yield rows_to_links(columns["node"][at], columns["copies"][at], p, q)


def small(rows: DataFrame, tag: str) -> DataFrame:
    """``rows`` as a table, marked for broadcast if its checked size allows."""
    rows = written(rows, tag)
    return F.broadcast(rows) if rows.count() <= BROADCAST_ROWS else rows


def ngram_join(docs: DataFrame, threshold: float = 0.8, n: int = 5, recall: float = 0.99999) -> DataFrame:
    """(doc_id, class_id, n_links, component_id, kept) for each row of ``docs`` (doc_id, text).

    Two documents are linked if the Jaccard similarity of their sets of ``n`` words is ``threshold`` or more; words are
    `[^\\x20\\x09-\\x0D]+` as they stand. class_id: smallest doc_id with the same words in the same order; such copies are
    compared once. n_links: other rows linked directly, copies counted. component_id: smallest doc_id reachable; kept:
    whether it is the row's own. Texts without words (null, empty) and rows without an id link with nothing and are kept.
    Rows that repeat an id and text count as rows. An empty table gives no rows; other columns are not read.

    Bands are chosen so that a pair at the threshold is a candidate with probability ``recall``. Classes in the same
    bucket are compared by signature in blocks, which leaves spanning links of likely pairs; the members of a component of
    those are then all compared by their whole sets, in blocks. No pair is a row: a task gives a row per member.
    """
    return judged_rows(docs, threshold, n, recall).drop("digest")


def likely_components(classes: DataFrame, bands: Bands) -> DataFrame:
    """(node, component) of classes connected by likely pairs.

    A bucket's members are first compared within blocks, dealt anew in each band, so that a group of near copies is connected
    over its bands; then, in buckets of several blocks, what is not connected yet is compared across them.
    """
    held = classes.select("node", F.explode("keys").alias("band"))
    buckets = held.groupBy("band").agg(F.count(F.lit(1)).alias("members"), F.min("node").alias("least"), F.bit_xor(F.xxhash64("node")).alias("mark")).where("members > 1")
    buckets = buckets.groupBy("members", "least", "mark").agg(F.min("band").alias("band")).select("band", blocks_for(F.col("members"), SIGNATURE_BLOCK).alias("blocks"))  # bands that hold the same classes
    buckets = written(buckets, "ngram-buckets")  # without an aggregate beside it, a bucket that is in every row is dealt over several tasks
    members = held.join(buckets, "band").join(classes.select("node", "sig"), "node")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in whole_groups(batches, ["band", "bi", "bj"]):
            for found, root in alike(groups, bands):
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(root)], ["u", "v"])

    def compared(rows: DataFrame) -> DataFrame:
        rows = rows.select("band", "bi", "bj", "own", "node", "sig").repartition("band", "bi", "bj").sortWithinPartitions("band", "bi", "bj")
        return rows.mapInArrow(tidy(near), "u long, v long")

    links = written(compared(own_blocks(members, "band", "node", "blocks")), "ngram-near")
    found = connected_components(links)
    if buckets.where("blocks > 1").isEmpty():
        return found
    known = written(found, "ngram-near-components").withColumnRenamed("node", "known")
    wide = members.where("blocks > 1").join(known, F.col("node") == F.col("known"), "left").withColumn("component", F.coalesce("component", "node"))
    return connected_components(links.unionByName(compared(crossing_blocks(wide, "band", "node", "component", SIGNATURE_BLOCK))))


def judged_rows(docs: DataFrame, threshold: float, n: int, recall: float, count_links: bool = True) -> DataFrame:
    """The rows of ``ngram_join`` with the digest of their words; n_links is null without ``count_links``, which spares the
    comparison of members that are connected already."""
    bands = Bands(threshold, recall)
    signed = written(sign_documents(docs, n, bands), "ngram-signatures")
    some = signed.where("digest IS NOT NULL")
    classes = some.groupBy("digest").agg(F.min("doc_id").alias("node"), F.count(F.lit(1)).alias("copies"), F.first("grams").alias("grams"), F.first("keys").alias("keys"), F.first("sig").alias("sig"))
    classes = written(classes, "ngram-classes")

    likely = written(likely_components(classes, bands), "ngram-likely")
    joined = likely.join(classes.select("node", "copies", "grams", "digest"), "node")
    sizes = joined.groupBy("component").agg(F.greatest(blocks_for(F.count(F.lit(1)), SET_BLOCK), blocks_for(F.sum("grams") * 8, SET_BYTES)).alias("blocks"))
    chosen = joined.join(written(sizes, "ngram-sizes"), "component")
    chosen = small(chosen.select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"), "blocks", "copies", "digest"), "ngram-chosen")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def gram_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "cluster", "blocks", "copies"]
        for batch in batches:
            digests = batch.column("digest").to_pylist()
            for part in slices(batch.column("text")):
                grams, rows = gram_hashes(part, n)
                edges = bounds(rows, part.rows)
                own = [i for i, text in enumerate(texts_of(part)) if content_digest(text) == digests[part.first + i]]  # not another text under the same id
                sets = [np.unique(grams[edges[i] : edges[i + 1]]).tobytes() for i in own]
                at = pa.array([part.first + i for i in own], pa.int64())
                yield pa.RecordBatch.from_arrays([*[batch.column(c).take(at) for c in names], pa.array(sets, pa.binary())], ["node", "cluster", "blocks", "copies", "grams"])

    def sets_of(some: DataFrame) -> DataFrame:
        rows = texts.join(some, "doc_id").select("doc_id", "cluster", "blocks", "copies", "digest", "text")
        return rows.mapInArrow(tidy(gram_sets), "node long, cluster long, blocks int, copies long, grams binary")

    def exact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in whole_groups(batches, ["cluster", "bi", "bj"]):
            for found, linked, root in similar(groups, threshold, count_links):
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(linked), pa.array(root)], ["node", "linked", "root"])

    def compared(rows: DataFrame) -> DataFrame:
        rows = rows.select("cluster", "bi", "bj", "own", "node", "copies", "grams").repartition("cluster", "bi", "bj").sortWithinPartitions("cluster", "bi", "bj")
        return rows.mapInArrow(tidy(exact), "node long, linked long, root long")

    def components(links: DataFrame) -> DataFrame:
        return connected_components(links.select(F.col("node").alias("u"), F.col("root").alias("v")))

    if count_links:
        links = written(compared(paired_blocks(sets_of(chosen), "node", "blocks")), "ngram-links")
        component = components(links)
    else:
        links = written(compared(own_blocks(sets_of(chosen), "cluster", "node", "blocks", turns=2)), "ngram-links")
        component = components(links)
        if not chosen.where("blocks > 1").isEmpty():
            known = written(component, "ngram-first").select(F.col("node").alias("known"), "component")
            wide = sets_of(chosen.where("blocks > 1")).join(known, F.col("node") == F.col("known"), "left").withColumn("component", F.coalesce("component", "node"))
            more = compared(crossing_blocks(written(wide, "ngram-wide"), "cluster", "node", "component", SET_BLOCK))
            links = links.unionByName(written(more, "ngram-more"))
            component = components(links)
    told = links.groupBy("node").agg(F.sum("linked").alias("linked")).join(component, "node").withColumnRenamed("node", "linked_node")
    told = classes.select(F.col("digest").alias("d"), "node", "copies").join(told, F.col("node") == F.col("linked_node"), "left")
    told = told.select("d", "node", F.coalesce("linked", F.lit(0)).alias("linked"), "copies", F.coalesce("component", "node").alias("component"))
    out = signed.select("doc_id", "digest").join(told, F.col("digest") == F.col("d"), "left")
    component_id = F.coalesce("component", "doc_id")
    return out.select(
        "doc_id",
        F.coalesce("node", "doc_id").alias("class_id"),
        (F.coalesce(F.col("linked") + F.col("copies") - 1, F.lit(0)) if count_links else F.lit(None)).cast("long").alias("n_links"),
        component_id.alias("component_id"),
        F.coalesce(F.col("doc_id") == component_id, F.lit(True)).alias("kept"),
        "digest",
    )


def with_digests(docs: DataFrame) -> DataFrame:
    """``docs`` with the digest of each text's words, null without any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [(t or "").encode() for t in batch.column(batch.schema.get_field_index("text")).to_pylist()]
            digests = [content_digest(t) if t.split() else None for t in texts]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(digests, pa.binary())], [*batch.schema.names, "digest"])

    return docs.mapInArrow(tidy(run), StructType([*docs.schema.fields, StructField("digest", BinaryType())]))


def one_of_each(docs: DataFrame, threshold: float = 0.8, n: int = 5, recall: float = 0.99999) -> DataFrame:
    """The rows of ``docs`` that ``ngram_join`` keeps, with all their columns, whatever their names.

    Of rows that repeat an id and text, one stays; where an id has several texts only the rows judged copies go. Texts
    without words (null, empty) and rows without an id stay; very long texts are compared whole; an empty table gives no
    rows. Which of a group stays does not depend on its size or order: the smallest id.
    """
    judged = written(judged_rows(docs, threshold, n, recall, count_links=False), "ngram-judged")
    gone = judged.where(~F.col("kept")).select(F.col("doc_id").alias("gone"), F.col("digest").alias("words")).distinct()
    if judged.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").limit(1).count():
        out = docs.where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id", "text"]).unionByName(docs.where(F.col("doc_id").isNull()))
        out = with_digests(out)
        return out.join(gone, (out["doc_id"] == gone["gone"]) & (out["digest"] == gone["words"]), "left_anti").drop("digest")
    gone = small(gone.select("gone"), "ngram-gone")
    return docs.join(gone, docs["doc_id"] == gone["gone"], "left_anti")
