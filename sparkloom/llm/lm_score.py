"""Scores of texts under a log-bilinear neural language model trained by noise-contrastive estimation."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from math import log10

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..store import written
from .tokens import LOWER, SLICE, SPACE, Slice, mix, separators, slices, span_hashes, tidy

FOLDS, HELD_OUT = 7, 2
#: At most so many words, the most frequent, ties by hash, have vectors of their own and counts that every worker holds.
HEAD = 131_072
#: The other words, and those not seen in training, share the vectors of a bucket by hash, ending and kind of letters.
SHAPES, BUCKETS = 4, 1024
#: Levels of the tree of outputs; records of a worker's model have so many rows at most.
DEPTH, BLOCK = 3, 8192
DIM, NOISE, BATCH, RATE = 24, 32, 4096, 0.08
#: (word, count) rows that a worker holds before it passes them on.
HELD = 2_000_000
CLOSING = separators(b".,;:!?")
WIDE = separators(bytes(range(128, 256)))
LN10 = float(np.log(10))
#: Frequent words are looked up from where their keys' first bits begin among them.
KEY_BITS = 18
#: The size of a logit up to which its exp is a normal float32 either way.
SAFE = 80.0
#: So many models are averaged by one task, and so many averages again.
RADIX = 64


def fold_of(doc_id) -> int:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % FOLDS


END = np.uint64(mix(np.array([0x656E64], np.uint64))[0] & ~np.uint64(SHAPES - 1))


def token_stream(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Keys of the tokens of a slice, each text's words and then its end; each text's first position and the total.

    A key's low bits are the word's shape, the others its hash with A-Z read as a-z.
    """
    starts, ends, rows = part.spans(SPACE)
    keys = span_hashes(part.data, starts, ends, LOWER) & ~np.uint64(SHAPES - 1)
    if len(starts):
        wide = np.zeros(len(part.data) + 1, np.int64)
        np.cumsum(WIDE[part.data], out=wide[1:])
        keys |= (CLOSING[part.data[ends - 1]] * 2 + (wide[ends] > wide[starts])).astype(np.uint64)
    stops = np.searchsorted(rows, np.arange(part.rows), side="right")
    stream = np.insert(keys, stops, END)
    edges = np.r_[0, stops + np.arange(1, part.rows + 1)]
    return stream, edges, np.repeat(np.arange(part.rows), np.diff(edges))


def is_training(ids: pa.Array) -> np.ndarray:
    return np.array([fold_of(i) != HELD_OUT for i in ids.to_pylist()], dtype=bool)


def counted(docs: DataFrame) -> DataFrame:
    """(h, c): the count of each token in the training texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            values, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            return values, np.bincount(inverse, weights=np.concatenate(counts), minlength=len(values)).astype(np.int64)

        for batch in batches:
            learn = is_training(batch.column(0))
            for part in slices(batch.column(1), 4 * SLICE):
                stream, _, rows = token_stream(part)
                found, n = np.unique(stream[learn[part.first + rows]], return_counts=True)
                keys.append(found)
                counts.append(n)
                held += len(found)
                if held > HELD:
                    k, c = merged()
                    keys, counts, held = [k], [c], len(k)
                    if held > HELD // 2:
                        yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c)], ["h", "c"])
                        keys, counts, held = [], [], 0
        if keys:
            k, c = merged()
            yield pa.RecordBatch.from_arrays([pa.array(k.view(np.int64)), pa.array(c)], ["h", "c"])

    return docs.mapInArrow(tidy(run), "h long, c long").groupBy("h").agg(F.sum("c").alias("c"))


@dataclass
class Vocabulary:
    """What is known of the training tokens: totals, the frequent ones (sorted by key), and the buckets of the others.

    Outputs of the model are the frequent tokens and then the buckets, dealt anew by falling count.
    """

    total: int
    distinct: int
    head: np.ndarray
    head_counts: np.ndarray
    bucket_total: np.ndarray
    bucket_distinct: np.ndarray

    def __post_init__(self):
        counts = np.concatenate([self.head_counts, self.bucket_total]) + 1.0
        order = np.argsort(-counts, kind="stable")
        self.output_counts = counts[order]
        self.place = np.empty(len(counts), np.int64)
        self.place[order] = np.arange(len(counts))
        self.bucket_at = np.where(order >= len(self.head), order - len(self.head), -1)
        self.begins = np.searchsorted(self.head, np.arange(1 << KEY_BITS, dtype=np.uint64) << np.uint64(64 - KEY_BITS))

    @property
    def outputs(self) -> int:
        return len(self.place)

    def known(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Outputs of tokens, and their training counts; -1 where a token is not among the frequent."""
        last = len(self.head) - 1
        at = np.minimum(self.begins.take(keys >> np.uint64(64 - KEY_BITS)), last)
        late = np.flatnonzero(self.head.take(at) < keys)
        while len(late := late[at[late] < last]):
            at[late] += 1
            late = late[self.head[at[late]] < keys[late]]
        own = self.head[at] == keys
        bucket = len(self.head) + (keys & np.uint64(BUCKETS - 1)).astype(np.int64)
        return self.place[np.where(own, at, bucket)], np.where(own, self.head_counts[at], -1)


def vocabulary_of(counts: DataFrame) -> Vocabulary:
    head = counts.orderBy(F.col("c").desc(), "h").limit(HEAD).toArrow()
    keys, n = head.column("h").to_numpy().view(np.uint64), head.column("c").to_numpy()
    if END not in keys:
        ends = counts.where(F.col("h") == F.lit(int(END.view(np.int64)))).agg(F.sum("c")).first()[0]
        keys, n = np.append(keys, END), np.append(n, ends or 0)
    order = np.argsort(keys)
    by_bucket = {r[0]: (r[1], r[2]) for r in counts.groupBy(F.col("h").bitwiseAND(F.lit(BUCKETS - 1).cast("long"))).agg(F.sum("c"), F.count(F.lit(1))).collect()}
    total = np.array([by_bucket.get(b, (0, 0))[0] for b in range(BUCKETS)], np.int64)
    distinct = np.array([by_bucket.get(b, (0, 0))[1] for b in range(BUCKETS)], np.int64)
    bucket = (keys & np.uint64(BUCKETS - 1)).astype(int)
    rest, others = total.copy(), distinct.copy()
    np.subtract.at(rest, bucket, n)
    np.subtract.at(others, bucket, (n > 0).astype(np.int64))
    return Vocabulary(int(total.sum()), int(distinct.sum()), keys[order], n[order].astype(np.int64), rest, others)


class LogBilinear:
    """Vectors of the two words before (with a start), two matrices, and vectors and biases of the next word.

    With ``depth`` over 1 the outputs are leaves of a tree whose nodes have vectors and biases too, each level trained
    like the leaves. Brothers stand together: node i of a level lies under node i // branch of the level above.
    """

    def __init__(self, counts: np.ndarray, seed: int = 7, depth: int = 1):
        rng = np.random.default_rng(seed)
        n = len(counts)
        self.branch = next(b for b in range(1, n + 1) if b**depth >= n)
        self.before = (rng.standard_normal((n + 1, DIM)) * 0.1).astype(np.float32)
        self.first = np.eye(DIM, dtype=np.float32) * np.float32(0.6)
        self.second = np.eye(DIM, dtype=np.float32) * np.float32(0.4)
        self.levels, self.noise = [], []
        for level in range(depth):
            mass = np.add.reduceat(counts, np.arange(0, n, self.branch**level))
            self.noise.append(mass / mass.sum())
            self.levels.append((f"after{level or ''}", f"bias{level or ''}"))
            after, bias = self.levels[-1]
            setattr(self, after, (rng.standard_normal((len(mass), DIM)) * 0.1).astype(np.float32))
            setattr(self, bias, np.log(self.noise[-1]).astype(np.float32))
        self.NAMES = ("before", "first", "second", *[x for pair in self.levels for x in pair])
        self.used = {x: np.zeros(len(getattr(self, x)), np.int64) for x in ("before", *[a for a, _ in self.levels])}
        self.seen = 0

    def train(self, one: np.ndarray, two: np.ndarray, word: np.ndarray, rng: np.random.Generator, squares: dict[str, np.ndarray]) -> None:
        """One pass over (previous output, the one before it, next output), in batches with shared noise; Adagrad on what a batch meets."""
        chances = [np.log(NOISE * x).astype(np.float32) for x in self.noise]
        cumulative = [np.cumsum(x) for x in self.noise]

        def step(name: str, rows, grad: np.ndarray, scale: np.float32) -> None:
            grad = grad / scale
            table, square = getattr(self, name), squares[name]
            power = grad * grad
            power += square if rows is None else square.take(rows, axis=0)
            square[... if rows is None else rows] = power
            np.sqrt(power, out=power)
            power += np.float32(1e-6)
            grad *= np.float32(RATE)
            grad /= power
            if rows is None:
                table += grad
            else:
                table[rows] = table.take(rows, axis=0) + grad

        for i in range(0, len(word), BATCH):
            a, b, w = one[i : i + BATCH], two[i : i + BATCH], word[i : i + BATCH]
            scale = np.float32(len(w)) ** np.float32(0.5)
            ra, rb = self.before.take(a, axis=0), self.before.take(b, axis=0)
            q = ra @ self.first + rb @ self.second
            dq, steps = np.zeros_like(q), []
            for level, (after, bias) in enumerate(self.levels):
                vectors, offsets, chance = getattr(self, after), getattr(self, bias), chances[level]
                node = w // self.branch**level
                noise = np.minimum(np.searchsorted(cumulative[level], rng.random(NOISE)), len(chance) - 1)
                own, other = vectors.take(node, axis=0), vectors[noise]
                true = np.einsum("ij,ij->i", q, own) + offsets.take(node) - chance.take(node)
                false = q @ other.T
                false += offsets[noise] - chance[noise]
                up, down = sigmoid(-true), sigmoid(false)
                np.negative(down, out=down)
                dq += up[:, None] * own + down @ other
                grad = np.empty((len(w) + NOISE, DIM + 1), np.float32)
                np.multiply(up[:, None], q, out=grad[: len(w), :DIM])
                grad[len(w) :, :DIM] = down.T @ q
                grad[: len(w), DIM], grad[len(w) :, DIM] = up, down.sum(axis=0)
                rows, grad, times = summed(np.concatenate([node, noise]), grad)
                self.used[after][rows] += times
                steps += [(after, rows, grad[:, :DIM]), (bias, rows, grad[:, DIM])]
            rows, grad, times = summed(np.concatenate([a, b]), np.concatenate([dq @ self.first.T, dq @ self.second.T]))
            self.used["before"][rows] += times
            for x in (*steps, ("before", rows, grad), ("first", None, ra.T @ dq), ("second", None, rb.T @ dq)):
                step(*x, scale)
            self.seen += len(w)

    def tables(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """What an output adds after each previous one and after each one before it, and the log normaliser of each pair, without a tree."""
        q1, q2 = self.before @ self.first, self.before @ self.second
        s1, s2 = q1 @ self.after.T + self.bias, q2 @ self.after.T
        norm = np.empty((len(q1), len(q1)), np.float32)
        for i in range(len(q1)):
            both = s2 + s1[i]
            top = both.max(axis=1)
            norm[i] = top + np.log(np.exp(both - top[:, None]).sum(axis=1))
        return s1.astype(np.float32), s2.astype(np.float32), norm

    def log_chances(self, one: np.ndarray, two: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Natural logs of the probabilities of outputs after the two before: at each level, of a node among its brothers.

        Biases count from the family's largest. Where the lengths of the vectors bound the rest by SAFE, a softmax needs no
        largest logit taken off: none overflows, and the sum does not vanish.
        """
        order = np.argsort(word, kind="stable")
        leaf = word[order]
        q = self.first.T @ self.before.take(one[order], axis=0).T  # a column for each token: what is summed lies side by side
        q += self.second.T @ self.before.take(two[order], axis=0).T
        lengths = np.sqrt(np.einsum("ij,ij->j", q, q))
        logs, places, ones = np.zeros(len(leaf)), np.arange(BATCH), np.ones(self.branch, np.float32)
        for level, (after, bias) in enumerate(self.levels):
            node = leaf // self.branch**level
            family = node // self.branch
            edges = np.r_[0, np.flatnonzero(np.diff(family)) + 1, len(leaf)] if len(leaf) else np.zeros(1, np.int64)
            table = getattr(self, after)
            longest = np.sqrt(np.maximum.reduceat(np.einsum("ij,ij->i", table, table), np.arange(0, len(table), self.branch)))
            reach = np.maximum.reduceat(lengths, edges[:-1]) * longest[family[edges[:-1]]] if len(leaf) else lengths
            for lo, hi, far in zip(edges[:-1].tolist(), edges[1:].tolist(), reach.tolist(), strict=True):
                base = int(family[lo]) * self.branch
                vectors, offsets = table[base : base + self.branch], getattr(self, bias)[base : base + self.branch, None]
                offsets = offsets - offsets.max()
                for i in range(lo, hi, BATCH):
                    j = min(i + BATCH, hi)
                    z = vectors @ q[:, i:j]
                    z += offsets
                    if not far < SAFE:
                        z -= z.max(axis=0)
                    own = z[node[i:j] - base, places[: j - i]]
                    logs[i:j] += own - np.log(ones[: len(z)] @ np.exp(z, out=z))
        out = np.empty_like(logs)
        out[order] = logs
        return out

    def records(self) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
        """(kind, block, rows in the block, weights, values) of what was trained; an output's bias stands behind its vector."""
        for kind, (weights, tables) in enumerate(self.parts()):
            rows = np.flatnonzero(weights)
            for block in np.unique(rows // BLOCK).tolist():
                own = rows[rows // BLOCK == block]
                values = np.concatenate([getattr(self, t)[own].reshape(len(own), -1) for t in tables], axis=1)
                yield kind, block, own - block * BLOCK, weights[own], values

    def parts(self) -> list[tuple[np.ndarray, tuple[str, ...]]]:
        whole = np.full(DIM, self.seen, np.int64)
        return [(self.used["before"], ("before",)), (whole, ("first",)), (whole, ("second",)), *[(self.used[a], (a, b)) for a, b in self.levels]]

    def take(self, kind: int, block: int, rows: np.ndarray, values: np.ndarray) -> None:
        at, place = rows + block * BLOCK, 0
        for name in self.parts()[kind][1]:
            table = getattr(self, name)
            width = table[0].size
            table[at] = values[:, place : place + width].reshape((len(at), *table.shape[1:]))
            place += width


def sigmoid(x: np.ndarray) -> np.ndarray:
    """1 / (1 + exp(-x)); below -SAFE, where it is 0 to 34 digits, as at -SAFE, so that it cannot overflow."""
    out = np.minimum(-x, np.float32(SAFE))
    np.exp(out, out=out)
    out += 1
    return np.reciprocal(out, out=out)


def summed(index: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different indices, the sums of their rows, and how many these are. Indices are below 2**40, rows fewer than 2**23."""
    both = np.sort(index << 23 | np.arange(len(index)))  # equal indices stay in their order
    order, index = both & ((1 << 23) - 1), both >> 23
    first = np.flatnonzero(np.r_[True, index[1:] != index[:-1]])
    times = np.diff(np.r_[first, len(index)])
    sums = values.take(order.take(first), axis=0)
    several = times > 1
    n = times[several]
    if len(n):
        sums[several] = np.add.reduceat(values.take(order[np.repeat(several, times)], axis=0), np.cumsum(n) - n, axis=0)
    return index[first], sums, times


def contexts(word: np.ndarray, edges: np.ndarray, start: int) -> tuple[np.ndarray, np.ndarray]:
    """The output before each token and the one before that, ``start`` outside the text. Every text has its end."""
    one, two = np.empty_like(word), np.empty_like(word)
    one[1:], two[2:] = word[:-1], word[:-2]
    first = edges[:-1]
    one[first] = start
    two[first] = start
    longer = first[np.diff(edges) > 1]
    two[longer + 1] = start
    return one, two


def trained(docs: DataFrame, vocabulary: Vocabulary) -> LogBilinear:
    """The model after a pass over all training texts: each partition trains from the same start on its own texts, and each
    row is averaged by how often partitions trained it, RADIX models at a time and then RADIX averages. What a task holds
    and what comes to the driver does not grow with the number of partitions (up to RADIX**3 of them).
    """
    model = LogBilinear(vocabulary.output_counts, depth=DEPTH)
    schema = "part int, kind int, block int, pid int, at binary, weights binary, vals binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = LogBilinear(vocabulary.output_counts, depth=DEPTH)
        pid = TaskContext.get().partitionId()
        rng = np.random.default_rng(pid)
        squares = {n: np.full(getattr(own, n).shape, 0.1, np.float32) for n in own.NAMES}
        for batch in batches:
            learn = is_training(batch.column(0))
            for part in slices(batch.column(1), SLICE):
                stream, edges, rows = token_stream(part)
                word, _ = vocabulary.known(stream)
                one, two = contexts(word, edges, vocabulary.outputs)
                pick = np.flatnonzero(learn[part.first + rows])
                pick = pick[rng.permutation(len(pick))]
                own.train(one[pick], two[pick], word[pick], rng, squares)
        for kind, block, at, weights, values in own.records():
            row = [pid // RADIX, kind, block, pid, at.astype(np.int32).tobytes(), weights.astype(np.float64).tobytes(), values.astype(np.float32).tobytes()]
            kinds = [pa.int32()] * 4 + [pa.binary()] * 3
            yield pa.RecordBatch.from_arrays([pa.array([x], t) for x, t in zip(row, kinds, strict=True)], ["part", "kind", "block", "pid", "at", "weights", "vals"])

    def average(pdf):
        pdf = pdf.sort_values(["part", "pid"])
        weight, total = np.zeros(BLOCK), None
        for at, w, v in zip(pdf["at"], pdf["weights"], pdf["vals"], strict=True):
            at, w = np.frombuffer(at, np.int32), np.frombuffer(w, np.float64)
            v = np.frombuffer(v, np.float32).reshape(len(at), -1)
            total = np.zeros((BLOCK, v.shape[1])) if total is None else total
            total[at] += v * w[:, None]
            weight[at] += w
        at = np.flatnonzero(weight)
        values = (total[at] / weight[at][:, None]).astype(np.float32)
        first = pdf.iloc[:1]
        return type(pdf)({"part": first["part"] // RADIX, "kind": first["kind"], "block": first["block"], "pid": first["pid"], "at": [at.astype(np.int32).tobytes()], "weights": [weight[at].tobytes()], "vals": [values.tobytes()]})

    parts = docs.mapInArrow(tidy(run), schema)
    for _ in range(2):
        parts = parts.groupBy("part", "kind", "block").applyInPandas(average, schema)
    for r in parts.groupBy("kind", "block").applyInPandas(average, schema).collect():  # one model
        at = np.frombuffer(r["at"], np.int32)
        model.take(r["kind"], r["block"], at, np.frombuffer(r["vals"], np.float32).reshape(len(at), -1))
    return model


def score_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row of ``docs`` (doc_id, text).

    Tokens are words `[^\\x20\\x09-\\x0D]+`, A-Z as a-z, and an end; null texts are the end alone; a null doc_id hashes as an
    empty one and so learns. ``score``: log10 probability under the model, a normalised distribution after the two tokens
    before over the frequent words, each with vectors of its own, and the buckets of the others, and within a bucket
    add-one over its training words. Repeated rows count and score as rows; an empty table gives no rows; without
    training texts outputs are as likely as each other. Words are known by 62-bit hashes and their shape. The frequent
    words' counts and vectors go to every worker; the counts of the rest are joined.
    """
    docs = docs.select(F.monotonically_increasing_id().alias("rid"), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    counts = written(counted(docs.select("doc_id", "text")), "lm-counts")
    vocabulary = vocabulary_of(counts)
    model = trained(docs.select("doc_id", "text"), vocabulary)
    held = docs.sparkSession.sparkContext.broadcast((vocabulary, model))  # bounded by HEAD and the buckets
    total, distinct = vocabulary.total, vocabulary.distinct

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, model = held.value
        within = np.where(known.bucket_at >= 0, np.log10(known.bucket_total + known.bucket_distinct + 1.0)[known.bucket_at], 0.0)
        for batch in batches:
            for part in slices(batch.column(2), 2 * SLICE):
                stream, edges, rows = token_stream(part)
                word, c = known.known(stream)
                one, two = contexts(word, edges, known.outputs)
                logs = np.log10(np.maximum(c, 0) + 1.0)
                model_part = model.log_chances(one, two, word) / LN10 - within[word]
                far = np.flatnonzero(c < 0)
                pairs = np.lexsort((stream[far], rows[far]))
                far = far[pairs]
                new = np.r_[True, (np.diff(rows[far]) > 0) | (np.diff(stream[far]) != 0)] if len(far) else np.zeros(0, dtype=bool)
                first = np.flatnonzero(new)
                times = np.diff(np.r_[first, len(far)])
                offsets = pa.array(np.searchsorted(rows[far[first]], np.arange(part.rows + 1)), pa.int32())
                ids = batch.column(1).slice(part.first, part.rows)
                total_of = lambda x: np.bincount(rows, weights=x, minlength=part.rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(part.first, part.rows),
                        ids,
                        pa.array(~is_training(ids)),
                        pa.array(np.diff(edges).astype(np.int64)),
                        pa.array(total_of(c > 0).astype(np.int64)),
                        pa.array(total_of(logs)),
                        pa.array(total_of(model_part)),
                        pa.ListArray.from_arrays(offsets, pa.array(stream[far[first]].view(np.int64))),
                        pa.ListArray.from_arrays(offsets, pa.array(times.astype(np.int32))),
                    ],
                    ["rid", "doc_id", "held_out", "n_tokens", "near_known", "near_logs", "near_score", "far", "times"],
                )

    schema = "rid long, doc_id long, held_out boolean, n_tokens long, near_known long, near_logs double, near_score double, far array<long>, times array<int>"
    rows = written(docs.mapInArrow(tidy(run), schema), "lm-rows")
    far = rows.select("rid", F.explode(F.arrays_zip("far", "times")).alias("x")).select("rid", F.col("x.far").alias("h"), F.col("x.times").alias("n"))
    found = far.join(counts, "h").groupBy("rid").agg(F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("far_logs"), F.sum("n").alias("far_known"))
    joined = rows.drop("far", "times").join(found, "rid", "left")
    logs = F.coalesce("far_logs", F.lit(0.0))
    return joined.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("near_known") + F.coalesce("far_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("near_logs") + logs - F.col("n_tokens") * F.lit(log10(total + distinct + 1))).alias("base_score"),
        (F.col("near_score") + logs).alias("score"),
    )
