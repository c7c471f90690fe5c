"""Quality rules as weak supervision: votes, expectation-maximisation over vote patterns, posterior probabilities."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..store import written
from .tokens import PLAIN, SPACE, Slice, bounds, mix, separators, slices, span_hashes, tidy

SYMBOLS = separators(b"#*$%&|<>")
LINE_END = separators(b"\n")
UPPERCASE = separators(bytes(range(65, 91)))
LOWERCASE = separators(bytes(range(97, 123)))
MARKS = separators(b"!?")
LETTERS = UPPERCASE | LOWERCASE | separators(bytes(range(128, 256)))
CLOSING = separators(b".,;:?!'\")")
#: Fixed limits: texts of fewer words, or with a greater share of repeated words, fail whatever the votes.
LEAST_WORDS, MOST_REPEATED = 50, 0.5

BAD, GOOD = 2, 1
#: The rules: name, measure (see ``measures``), whether the measure has to reach the limit or stay within it, and the vote; else a rule abstains.
VOTES = (
    ("symbols", "symbols_per_word", ">=", 0.15, BAD),
    ("repetition", "repeated_share", ">=", 0.30, BAD),
    ("lines", "duplicate_line_share", ">=", 0.30, BAD),
    ("capitals", "capital_word_share", ">=", 0.30, BAD),
    ("shouting", "shouted_share", ">=", 0.20, BAD),
    ("word_length", "length_oddity", ">=", 2.0, BAD),
    ("plain_words", "plain_word_share", ">=", 0.85, GOOD),
    ("variety", "repeated_share", "<=", 0.25, GOOD),
)
PATTERNS = 3 ** len(VOTES)
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
LINE_BASE = np.uint64(0xA0761D6478BD642F)


def row_sums(per_byte: np.ndarray, part: Slice) -> np.ndarray:
    total = np.zeros(len(part.data) + 1, np.int64)
    np.cumsum(per_byte, out=total[1:])
    return total[part.offsets[1:]] - total[part.offsets[:-1]]


def measures(part: Slice) -> tuple[dict[str, np.ndarray], dict[str, np.ndarray]]:
    """The counts of the contract and the measures that the rules vote on, for each row of a slice."""
    data, n = part.data, part.rows
    starts, ends, rows = part.spans(SPACE)
    words = np.bincount(rows, minlength=n).astype(np.int64)
    lead = (data & 0xC0) != 0x80
    chars = row_sums(lead & ~SPACE[data], part)
    symbols = row_sums(SYMBOLS[data], part)
    hashes = span_hashes(data, starts, ends, PLAIN)

    repeated = np.zeros(n, np.int64)
    if len(starts) >= 3:
        whole = rows[2:] == rows[:-2]
        triples = mix(hashes[:-2] * np.uint64(3) + hashes[1:-1] * np.uint64(0x9FB21C651E98DF25) + mix(hashes[2:] + rows[2:].astype(np.uint64)))
        order = np.argsort(triples[whole], kind="stable")
        values = triples[whole][order]
        twin = np.zeros(len(values), dtype=bool)
        equal = values[1:] == values[:-1]
        twin[1:] |= equal
        twin[:-1] |= equal
        at = np.flatnonzero(whole)[order[twin]]
        covered = np.zeros(len(starts), dtype=bool)
        for step in range(3):
            covered[at + step] = True
        repeated = np.bincount(rows[covered], minlength=n).astype(np.int64)

    line_starts, line_ends, line_rows = part.spans(LINE_END)
    inked = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~SPACE[data], out=inked[1:])
    full = inked[line_ends] > inked[line_starts]
    line_starts, line_ends, line_rows = line_starts[full], line_ends[full], line_rows[full]
    lines = np.bincount(line_rows, minlength=n)
    keys = mix(span_hashes(data, line_starts, line_ends, PLAIN) + LINE_BASE * line_rows.astype(np.uint64))
    _, firsts = np.unique(keys, return_index=True)
    duplicates = lines - np.bincount(line_rows[firsts], minlength=n)

    upper = np.zeros(len(data) + 1, np.int64)
    np.cumsum(UPPERCASE[data], out=upper[1:])
    lower = np.zeros(len(data) + 1, np.int64)
    np.cumsum(LOWERCASE[data], out=lower[1:])
    capitals = (upper[ends] - upper[starts] >= 2) & (lower[ends] == lower[starts])
    shouted = MARKS[data[ends - 1]] if len(ends) else np.zeros(0, dtype=bool)
    odd = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~LETTERS[data], out=odd[1:])
    plain = odd[ends] - odd[starts] <= (CLOSING[data[ends - 1]] if len(ends) else 0)
    some = np.maximum(words, 1)
    mean = chars / some
    counts = dict(zip(COUNTS, (words, chars, symbols, duplicates.astype(np.int64), repeated), strict=True))
    return counts, {
        "symbols_per_word": symbols / some,
        "repeated_share": repeated / some,
        "duplicate_line_share": duplicates / np.maximum(lines, 1),
        "capital_word_share": np.bincount(rows[capitals], minlength=n) / some,
        "shouted_share": np.bincount(rows[shouted], minlength=n) / some,
        "length_oddity": np.where(words > 0, np.maximum(3.0 / np.maximum(mean, 0.1), mean / 10.0), 9.0),
        "plain_word_share": np.bincount(rows[plain], minlength=n) / some,
    }


def vote_pattern(values: dict[str, np.ndarray]) -> np.ndarray:
    """Base 3 digits of the votes: 0 abstains, 1 good, 2 bad."""
    pattern = np.zeros(len(next(iter(values.values()))), np.int64)
    for _, measure, way, limit, vote in VOTES:
        met = values[measure] >= limit if way == ">=" else values[measure] <= limit
        pattern = pattern * 3 + np.where(met, vote, 0)
    return pattern


def votes_of(patterns: np.ndarray) -> np.ndarray:
    return np.stack([patterns // 3 ** (len(VOTES) - 1 - i) % 3 for i in range(len(VOTES))], axis=1) if len(patterns) else np.zeros((0, len(VOTES)), np.int64)


def failed(counts: dict[str, np.ndarray]) -> np.ndarray:
    return (counts["n_words"] < LEAST_WORDS) | (100 * counts["n_repeat_words"] > int(100 * MOST_REPEATED) * counts["n_words"])


def measured_batches(batches: Iterable[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, dict, np.ndarray]]:
    for batch in batches:
        parts = [measures(part) for part in slices(batch.column(text))]
        if not parts:
            continue
        counts = {c: np.concatenate([p[0][c] for p in parts]) for c in COUNTS}
        yield batch, counts, np.concatenate([vote_pattern(p[1]) for p in parts])


def measure_documents(docs: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, pattern) for each row."""
    fields = "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS) + ", base_failed boolean, pattern int"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, counts, pattern in measured_batches(batches, 1):
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *[pa.array(counts[c]) for c in COUNTS], pa.array(failed(counts)), pa.array(pattern.astype(np.int32))],
                ["doc_id", *COUNTS, "base_failed", "pattern"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(tidy(run), fields)


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100, smoothing: float = 1.0) -> tuple[np.ndarray, np.ndarray]:
    """Expectation-maximisation over vote patterns and how many texts have each.

    Returns the probability that a text of each pattern is good, and the accuracies (rule, class bad/good, vote). The
    start takes a text with any bad vote for bad, which tells the classes apart; each class's votes are smoothed.
    """
    votes = votes_of(patterns)
    onehot = np.stack([votes == v for v in range(3)], axis=2).astype(float)
    good = np.where((votes == 2).any(axis=1), 0.1, 0.9)
    accuracy = np.full((len(VOTES), 2, 3), 1 / 3)
    for _ in range(rounds):
        mass = np.stack([(1 - good) * counts, good * counts])
        prior = (mass.sum(axis=1) + smoothing) / (counts.sum() + 2 * smoothing)
        for k in range(2):
            tally = np.einsum("p,pjv->jv", mass[k], onehot) + smoothing
            accuracy[:, k] = tally / tally.sum(axis=1, keepdims=True)
        loglik = np.log(prior)[:, None] + np.einsum("pjv,jkv->kp", onehot, np.log(accuracy))
        now = 1 / (1 + np.exp(np.clip(loglik[0] - loglik[1], -500, 500)))
        if np.abs(now - good).max(initial=0) < 1e-10:
            good = now
            break
        good = now
    return good, accuracy


def posterior_by_pattern(measured: DataFrame) -> dict[int, float]:
    """Probability of good quality of each vote pattern; the statistics are counts over all rows, at most ``PATTERNS``."""
    rows = measured.groupBy("pattern").count().orderBy("pattern").collect()
    good, _ = fit_votes(np.array([r[0] for r in rows], np.int64), np.array([r[1] for r in rows], float))
    return {r[0]: float(p) for r, p in zip(rows, good, strict=True)}


def judge_quality(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """For each row of ``docs`` (doc_id, text): the counts, base_failed, p_good and kept.

    kept is false where base_failed holds, otherwise whether p_good is ``least`` or more. Null and empty texts have no
    words and so fail. Rows are judged one by one, so repeated rows and ids are judged alike and null ids stay; an
    empty table gives no rows; other columns are not read.
    """
    spark = docs.sparkSession
    measured = written(measure_documents(docs), "quality")
    known = posterior_by_pattern(measured)
    table = spark.createDataFrame(list(known.items()), "pattern int, p_good double")
    rows = measured.join(F.broadcast(table), "pattern")  # one row per pattern: at most PATTERNS
    return rows.select("doc_id", *COUNTS, "base_failed", "p_good", (~F.col("base_failed") & (F.col("p_good") >= least)).alias("kept"))


def good_documents(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that ``judge_quality`` keeps, with all their columns, whatever their names.

    Each row is judged by its own text: null and empty texts go, null and repeated ids, ties and repeated rows are judged
    alike, very long texts whole; an empty table gives no rows. Texts are measured twice, once for the statistics of all and
    once to filter, and never shuffled: a table of the measures would have to be joined with the texts again.
    """
    known = posterior_by_pattern(measure_documents(docs))
    table = np.zeros(PATTERNS)
    table[list(known)] = list(known.values())
    text = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, counts, pattern in measured_batches(batches, text):
            yield batch.filter(pa.array(~failed(counts) & (table[pattern] >= least)))

    return docs.mapInArrow(tidy(run), T.StructType(docs.schema.fields))
