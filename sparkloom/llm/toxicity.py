"""Toxicity by a linear-chain conditional random field over tokens, whose marginals give spans and document scores."""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..store import written
from .tokens import LOWER, NOT_ALNUM, SLICE, Slice, bounds, give_back, mix, slices, span_hashes, tidy

FOLDS, HELD_OUT = 5, 0
#: A token of a toxic document is labelled toxic if it stands between so many different neighbours in them,
#: and so many times more often than in clean ones.
LEAST_CONTEXTS, LEAST_LIFT = 5, 20.0
WINDOW, STEPS = 12, 80


@dataclass(frozen=True)
class Fit:
    """The bounds of the sample that the classifier is fitted on; all texts are scored, and classes are counted over all labels.

    ``toxic`` and ``clean``: so many labelled documents of either class at most, the first by the checksum of their id.
    ``bytes``: so much text at most, half for either class; a text that does not fit is passed over.
    ``background``: this share of the tokens that are not labelled toxic starts a window of its own, besides the windows round
    toxic ones; the chain needs examples of ordinary text, and more of the same do not change its weights.
    ``beside``: a feature that stands beside fewer toxic tokens in the windows has no weight, so that a word that a toxic
    text holds once does not count against other texts.
    """

    toxic: int = 1200
    clean: int = 1800
    bytes: int = 24 << 20
    background: float = 1 / 200
    beside: int = 3


#: Features of a token: itself, the one before and the one after.
ROLES = 3
ROLE_SALT = np.array([0, 0x8CB92BA72F3D8DD7, 0x1B03738712FAD5D5], np.uint64)
EDGE = np.uint64(0x7F4A7C159E3779B9)


@dataclass
class Model:
    """Feature keys (sorted) and weights, bias, transitions and the document's logistic weights (bias, log1p sum, max)."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float
    moves: np.ndarray
    document: np.ndarray


def fold_of(doc_id) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS


def tokens_of(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, rows and hashes of runs of letters and digits, in lower case as far as ASCII goes."""
    starts, ends, rows = part.spans(NOT_ALNUM)
    return starts, ends, rows, span_hashes(part.data, starts, ends, LOWER)


def neighbours(hashes: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    before, after = np.full(len(hashes), EDGE), np.full(len(hashes), EDGE)
    same = rows[1:] == rows[:-1]
    before[1:][same] = hashes[:-1][same]
    after[:-1][same] = hashes[1:][same]
    return before, after


def feature_keys(hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """(tokens, ROLES) keys."""
    before, after = neighbours(hashes, rows)
    return np.stack([hashes, mix(before + ROLE_SALT[1]), mix(after + ROLE_SALT[2])], axis=1) if len(hashes) else np.zeros((0, ROLES), np.uint64)


def logits(model: Model, hashes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Log odds that a token gives by itself."""
    out = np.full(len(hashes), model.bias)
    if len(hashes) and len(model.keys):
        keys = feature_keys(hashes, rows)
        at = np.minimum(np.searchsorted(model.keys, keys), len(model.keys) - 1)
        out += np.where(model.keys[at] == keys, model.weights[at], 0.0).sum(axis=1)
    return out


def marginals(odds: np.ndarray, edges: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """P(toxic) of each token by forward and backward passes over whole texts; text i has tokens edges[i]:edges[i+1].

    Two states need only the ratio of their messages. Texts are taken by falling length, so each step covers those that
    still have a token.
    """
    e = np.exp(np.clip(odds, -50, 50))
    m = np.exp(moves)
    lengths = np.diff(edges)
    order = np.argsort(-lengths, kind="stable")
    first, lengths = edges[:-1][order], lengths[order]
    most = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(most), side="left")
    forward, backward = np.empty(len(odds)), np.ones(len(odds))
    for t in range(most):
        at = first[: active[t]] + t
        forward[at] = e[at] if t == 0 else e[at] * (m[0, 1] + m[1, 1] * forward[at - 1]) / (m[0, 0] + m[1, 0] * forward[at - 1])
    for t in range(most - 2, -1, -1):
        at = first[: active[t + 1]] + t
        ahead = e[at + 1] * backward[at + 1]
        backward[at] = (m[1, 0] + m[1, 1] * ahead) / (m[0, 0] + m[0, 1] * ahead)
    joint = forward * backward
    return joint / (1 + joint)


def document_measures(p: np.ndarray, rows: np.ndarray, edges: np.ndarray, n: int) -> np.ndarray:
    """(n, 3): one, log of one plus the expected number of toxic tokens above the usual, and the greatest marginal."""
    total = np.bincount(rows, weights=np.where(p > 0.05, p, 0.0), minlength=n)
    highest = np.zeros(n)
    full = np.flatnonzero(np.diff(edges) > 0)
    if len(full):
        highest[full] = np.maximum.reduceat(p, edges[:-1][full])
    return np.stack([np.ones(n), np.log1p(total), highest], axis=1)


def text_slices(texts: list[str]) -> list[Slice]:
    return list(slices(pa.array(texts, pa.large_string()), SLICE))


def seed_tokens(parts: list[tuple], toxic: np.ndarray) -> np.ndarray:
    """Hashes of tokens that stand between many neighbours in toxic texts and hardly in clean ones.

    Different neighbours are counted, not occurrences, so the words of a text that is copied many times do not count again.
    """
    seen: dict[bool, tuple[np.ndarray, np.ndarray]] = {}
    for label in (True, False):
        pairs, tokens, sizes = [], [], 0
        for first, (_, _, rows, hashes) in parts:
            pick = toxic[first + rows] == label
            before, after = neighbours(hashes, rows)
            pairs.append(mix(hashes + mix(before + mix(after + ROLE_SALT[1])))[pick])
            tokens.append(hashes[pick])
            sizes += int(pick.sum())
        _, firsts = np.unique(np.concatenate(pairs), return_index=True)
        values, counts = np.unique(np.concatenate(tokens)[firsts], return_counts=True)
        seen[label] = values, counts / max(1, sizes), counts
    values, rate, counts = seen[True]
    clean_values, clean_rate, _ = seen[False]
    floor = 0.5 / max(1, sum(len(h) for _, (_, _, _, h) in parts))
    other = np.full(len(values), floor)
    if len(clean_values):
        at = np.minimum(np.searchsorted(clean_values, values), len(clean_values) - 1)
        other = np.maximum(other, np.where(clean_values[at] == values, clean_rate[at], 0.0))
    return values[(counts >= LEAST_CONTEXTS) & (rate >= LEAST_LIFT * other)]


def fit_chain(keys: np.ndarray, rows: np.ndarray, labels: np.ndarray, beside: int = Fit.beside) -> tuple[np.ndarray, np.ndarray, float, np.ndarray]:
    """Weights by gradient ascent (Adam) on the conditional likelihood of labelled windows.

    keys: (tokens, ROLES); rows: ascending window of each token; labels: 0 or 1. Features beside fewer than ``beside``
    toxic tokens are left out.
    """
    vocabulary, inverse, counts = np.unique(keys, return_inverse=True, return_counts=True)
    inverse = inverse.reshape(keys.shape)
    near = np.bincount(inverse[labels == 1].ravel(), minlength=len(vocabulary))
    useful = near >= beside
    place = np.cumsum(useful) - 1
    used = useful[inverse]
    column = np.where(used, place[inverse], 0)
    size = int(useful.sum())
    edges = bounds(rows, int(rows[-1]) + 1 if len(rows) else 0)
    inner = np.ones(len(rows), dtype=bool)
    inner[edges[:-1][np.diff(edges) > 0]] = False
    theta = np.zeros(size + 1 + 3)
    theta[size] = -3.0
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    observed = np.zeros_like(theta)
    observed[:size] = np.bincount(column[used], weights=np.repeat(labels, ROLES).reshape(used.shape)[used], minlength=size)[:size]
    observed[size] = labels.sum()
    inside = np.flatnonzero(inner)
    here, ahead = labels[inside], labels[inside - 1]
    observed[size + 1 :] = [((ahead == 0) & (here == 1)).sum(), ((ahead == 1) & (here == 0)).sum(), ((ahead == 1) & (here == 1)).sum()]
    n = max(1, len(np.unique(rows)))
    for step in range(1, STEPS + 1):
        moves = np.array([[0.0, theta[size + 1]], [theta[size + 2], theta[size + 3]]])
        odds = np.where(used, theta[column], 0.0).sum(axis=1) + theta[size]
        p = marginals(odds, edges, moves)
        expected = np.zeros_like(theta)
        expected[:size] = np.bincount(column[used], weights=np.repeat(p, ROLES).reshape(used.shape)[used], minlength=size)[:size]
        expected[size] = p.sum()
        expected[size + 1 :] = pair_marginals(odds, p, inside, moves)
        gradient = (observed - expected) / n - 1e-4 * theta
        first = 0.9 * first + 0.1 * gradient
        second = 0.999 * second + 0.001 * gradient**2
        theta += 0.3 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return vocabulary[useful], theta[:size], float(theta[size]), np.array([[0.0, theta[size + 1]], [theta[size + 2], theta[size + 3]]])


def pair_marginals(odds: np.ndarray, p: np.ndarray, inside: np.ndarray, moves: np.ndarray) -> list[float]:
    """Expected numbers of moves clean-toxic, toxic-clean and toxic-toxic, from the marginals of neighbours.

    For two states the pair (a, b) is told by P(a), P(b) and the cross ratio of the moves, which messages do not change.
    """
    q, r = p[inside - 1], p[inside]
    cross = np.exp(np.clip(moves[1, 1] + moves[0, 0] - moves[0, 1] - moves[1, 0], -30, 30))
    if abs(cross - 1) < 1e-9:
        both = q * r
    else:
        a, b, c = cross - 1, -((cross - 1) * (q + r) + 1), cross * q * r
        both = (-b - np.sqrt(np.maximum(b * b - 4 * a * c, 0))) / (2 * a)
    return [float((r - both).sum()), float((q - both).sum()), float(both.sum())]


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Newton steps on the weighted, slightly damped likelihood."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (y - p)) - 0.01 * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.01 * np.eye(len(w))
        step = np.linalg.solve(hessian, gradient)
        w += step
        if np.abs(step).max() < 1e-9:
            break
    return w


def fit(texts: list[str], toxic: np.ndarray, totals: tuple[float, float], bounds_: Fit = Fit()) -> Model:
    """The model of labelled texts; ``totals`` are the toxic and clean rows of which the texts are a part."""
    none = Model(np.zeros(0, np.uint64), np.zeros(0), -10.0, np.zeros((2, 2)), np.zeros(3))
    if not len(texts) or not toxic.any() or toxic.all():
        share = 0.5 / (len(texts) + 1) if not toxic.any() else 1 - 0.5 / (len(texts) + 1)
        none.document[0] = np.log(share / (1 - share))
        return none
    parts = []
    for s in text_slices(texts):
        _, _, rows, hashes = tokens_of(s)
        parts.append((s.first, (None, None, rows.astype(np.int32), hashes)))
    seeds = np.sort(seed_tokens(parts, toxic))
    keys, windows, labels, last = [], [], [], 0
    rng = np.random.default_rng(0)
    for first, (_, _, rows, hashes) in parts:
        if not len(hashes):
            continue
        isin = np.isin(hashes, seeds) & toxic[first + rows]
        centre = np.union1d(np.flatnonzero(isin), np.flatnonzero(rng.random(len(hashes)) < bounds_.background))
        near = np.zeros(len(hashes) + 1, np.int64)
        np.add.at(near, np.maximum(centre - WINDOW, 0), 1)
        np.add.at(near, np.minimum(centre + WINDOW + 1, len(hashes)), -1)
        pick = np.flatnonzero(np.cumsum(near[:-1]) > 0)
        change = np.r_[True, (np.diff(pick) > 1) | (np.diff(rows[pick]) > 0)] if len(pick) else np.zeros(0, dtype=bool)
        keys.append(feature_keys(hashes, rows)[pick])
        windows.append(last + np.cumsum(change))
        labels.append(isin[pick].astype(float))
        last += int(change.sum())
    if not keys or not sum(x.sum() for x in labels):
        share = totals[0] / max(1.0, sum(totals))
        none.document[0] = np.log(share / (1 - share))
        return none
    rows = np.concatenate(windows)
    keys_, weights, bias, moves = fit_chain(np.concatenate(keys), rows - rows[0], np.concatenate(labels), bounds_.beside)
    heavy = np.abs(weights) > 1e-3
    model = Model(keys_[heavy], weights[heavy], bias, moves, np.zeros(3))
    x = np.zeros((len(texts), 3))
    for first, (_, _, rows, hashes) in parts:
        n = int(rows[-1]) + 1 if len(rows) else 0
        edges = bounds(rows, n)
        x[first : first + n] = document_measures(marginals(logits(model, hashes, rows), edges, moves), rows, edges, n)
    x[:, 0] = 1
    weight = np.where(toxic, totals[0] / toxic.sum(), totals[1] / (~toxic).sum())
    model.document = fit_logistic(x, toxic.astype(float), weight)
    return model


def train(docs: DataFrame, labels: DataFrame, bounds_: Fit = Fit()) -> Model:
    """Fits the model on labelled rows outside the held-out fold; label rows with nulls are left out, a doc_id with
    several labels is toxic if any says so, and one with several texts gives one of them. The sample is bounded (see
    ``Fit``) and read in one pass; the classes' totals are counted over all rows.
    """
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg((F.max("toxic") > 0).alias("toxic"))
    marks = marks.where(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(FOLDS)) != HELD_OUT)
    count = {bool(r[0]): r[1] for r in marks.groupBy("toxic").count().collect()}
    order = (F.crc32(F.col("doc_id").cast("string").cast("binary")), "doc_id")
    first = [r for label, most in ((True, bounds_.toxic), (False, bounds_.clean)) for r in marks.where(F.col("toxic") == label).orderBy(*order).limit(most).collect()]
    asked = docs.sparkSession.createDataFrame([(r["doc_id"], r["toxic"], i) for i, r in enumerate(first)], "doc_id long, toxic boolean, place int")
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = texts.join(F.broadcast(asked), "doc_id").groupBy("place", "toxic").agg(F.min_by("text", F.sha2("text", 256)).alias("text"))  # at most the ids of ``asked``
    texts = written(texts, "toxicity-sample")
    left, chosen = {True: bounds_.bytes // 2, False: bounds_.bytes // 2}, []
    for r in texts.select("place", "toxic", F.octet_length("text").alias("n")).orderBy("place").collect():
        if r["n"] <= left[r["toxic"]]:
            left[r["toxic"]] -= r["n"]
            chosen.append(r["place"])
    rows = texts.where(F.col("place").isin(chosen)).orderBy("place").collect()
    model = fit([r["text"] for r in rows], np.array([r["toxic"] for r in rows], dtype=bool), (float(count.get(True, 0)), float(count.get(False, 0))), bounds_)
    del rows
    give_back()
    return model


def score_slice(model: Model, part: Slice) -> tuple[np.ndarray, tuple]:
    starts, ends, rows, hashes = tokens_of(part)
    edges = bounds(rows, part.rows)
    p = marginals(logits(model, hashes, rows), edges, model.moves)
    x = document_measures(p, rows, edges, part.rows)
    return 1 / (1 + np.exp(-np.clip(x @ model.document, -30, 30))), (starts, ends, rows, p)


def toxic_spans(part: Slice, found: tuple, least: float = 0.5) -> list[list[dict]]:
    """Offending offsets of each row: runs of tokens whose marginal is ``least`` or more, as code points of the text."""
    starts, ends, rows, p = found
    out: list[list[dict]] = [[] for _ in range(part.rows)]
    hit = np.flatnonzero(p >= least)
    if not len(hit):
        return out
    lead = np.zeros(len(part.data) + 1, np.int64)
    np.cumsum((part.data & 0xC0) != 0x80, out=lead[1:])
    change = np.r_[True, (np.diff(hit) > 1) | (np.diff(rows[hit]) > 0)]
    for run in np.split(hit, np.flatnonzero(change)[1:]):
        row = int(rows[run[0]])
        base = lead[part.offsets[row]]
        out[row].append({"start": int(lead[starts[run[0]]] - base), "end": int(lead[ends[run[-1]]] - base), "p": float(p[run].max())})
    return out


def score_documents(docs: DataFrame, labels: DataFrame, least: float = 0.5, model: Model | None = None, bounds_: Fit = Fit()) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): held_out, score, predicted and spans (start, end, p in code points).

    Reads no other column. Null and empty texts get the score of a text without toxic tokens; a null doc_id hashes as an
    empty one; repeated rows score alike; an empty table gives no rows. Without labels of both classes every text gets
    the same score. Whole texts are scored, whatever their length.
    """
    model = model or train(docs, labels, bounds_)
    schema = "doc_id long, held_out boolean, score double, predicted int, spans array<struct<start:int,end:int,p:double>>"

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("p", pa.float64())]))
        for batch in batches:
            for part in slices(batch.column(1), 2 * SLICE):
                score, found = score_slice(model, part)
                ids = batch.column(0).slice(part.first, part.rows)
                held = [fold_of(i) == HELD_OUT for i in ids.to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(held), pa.array(score), pa.array((score >= least).astype(np.int32)), pa.array(toxic_spans(part, found, least), kind)],
                    ["doc_id", "held_out", "score", "predicted", "spans"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tidy(run), schema)


def clean_documents(docs: DataFrame, labels: DataFrame, least: float = 0.5, bounds_: Fit = Fit()) -> DataFrame:
    """The rows of ``docs`` that ``score_documents`` does not predict toxic, with all their columns, whatever their names.

    Each row is judged by its own text: null and empty texts as texts without toxic tokens, null and repeated ids, ties and
    repeated rows alike; very long texts whole. An empty table gives no rows; without labels of both classes all rows stay
    or, where all labels are toxic, go.
    """
    model = train(docs, labels, bounds_)
    text = docs.columns.index("text")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = [score_slice(model, part)[0] for part in slices(batch.column(text), 2 * SLICE)]
            if scores:
                yield batch.filter(pa.array(np.concatenate(scores) < least))

    return docs.mapInArrow(tidy(run), T.StructType(docs.schema.fields))
