"""Packing by minimum bin slack over the histogram of remaining lengths."""

from __future__ import annotations

import itertools
import json
import os
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..store import written
from .tokens import KEPT, LOWER, NOT_ALNUM, PLAIN, SPACE, Slice, mix, separators, slices, span_hashes, tidy

#: Units that a worker remembers by 64-bit hashes; the memory is emptied when it is full.
REMEMBERED = 2_000_000
#: Units that the tokenizer encodes at once; its results take much more room than their ids.
BATCH = 2_000
#: What is cut from a word's end, a unit of its own. Without quotes, which begin contractions, and without the signs that
#: end special tokens.
CLOSING = separators(b".,;:!?*#$%&|")
#: Letters and digits of ASCII and all bytes beyond.
ALNUM = ~NOT_ALNUM
#: Whole texts that another tokenizer encodes at once.
WHOLE = 64
#: The second bytes of the letters of Latin-1 in UTF-8, whose first is LATIN.
LATIN, LATIN_LETTERS = 0xC3, separators(bytes(x for x in range(0x80, 0xC0) if x not in (0x97, 0xB7)))
#: Tells units that are hashed as they stand from those hashed in lower case.
AS_IT_STANDS = np.uint64(0x517CC1B727220A95)
#: The steps of a tokenizer file whose ids are those of the words one after the other.
NORMALIZER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]}
PRE_TOKENIZER = {
    "type": "Sequence",
    "pretokenizers": [
        {"type": "Split", "pattern": {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}, "behavior": "Removed", "invert": True},
        {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": False},
    ],
}
#: Ranks within a length are counted in so many parts, so that a common length is not one task.
RANK_PARTS = 256

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # executors share a machine
_encoder: dict[str, tuple] = {}
OWNER = "packing"


class Memory:
    """Ids of units by hash: sorted keys, and where each unit's ids begin and how many there are in one array of ids."""

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.keys, self.first, self.count = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.ids, self.used = np.zeros(1 << 16, "<u4"), 0

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Places of sorted keys, -1 for those that are not there."""
        if not len(self.keys):
            return np.full(len(keys), -1)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, at, -1)

    def add(self, keys: np.ndarray, found: list[list[int]]) -> None:
        """Sorted new keys and their ids."""
        count = np.fromiter(map(len, found), np.int64, len(found))
        total = int(count.sum())
        if self.used + total > len(self.ids):
            self.ids = np.concatenate([self.ids[: self.used], np.zeros(max(total, len(self.ids)), "<u4")])
        self.ids[self.used : self.used + total] = np.fromiter(itertools.chain.from_iterable(found), "<u4", total)
        first = self.used + np.cumsum(count) - count
        self.used += total
        at = np.searchsorted(self.keys, keys)
        self.keys, self.first, self.count = np.insert(self.keys, at, keys), np.insert(self.first, at, first), np.insert(self.count, at, count)


_memory = Memory()


def forget() -> None:
    _memory.clear()
    _encoder.clear()


KEPT[OWNER] = forget


def encoder(path: str):
    """The tokenizer of a file, and whether its ids can be found word by word."""
    if path not in _encoder:
        from tokenizers import Tokenizer

        forget()
        model = Tokenizer.from_file(path)
        model.no_truncation()
        model.no_padding()
        _encoder[path] = model, by_words(path)
    return _encoder[path]


def by_words(path: str) -> bool:
    """Whether a tokenizer file reads the words between white space one by one, in lower case.

    That holds for BPE within the pre-tokens of NORMALIZER and PRE_TOKENIZER, which drop white space and never span it, and
    for special tokens that are found as they stand and hold ``<|`` and no white space. Others encode whole texts.
    """
    with open(path, encoding="utf-8") as f:
        content = f.read()

    def step(name: str):  # the vocabulary is not parsed: its objects would take many times its size
        found = re.search(rf'"{name}"\s*:\s*', content)
        return json.JSONDecoder().raw_decode(content, found.end())[0] if found else None

    head = re.search(r'"model"\s*:\s*\{(.*?)"vocab"', content, re.DOTALL)
    model = json.loads("{" + head[1].rstrip().rstrip(",") + "}") if head else {}
    plain = all("<|" in t["content"] and not t["content"].split()[1:] and not any(t[k] for k in ("normalized", "single_word", "lstrip", "rstrip")) for t in step("added_tokens") or [])
    return plain and model.get("type") == "BPE" and not model.get("dropout") and step("normalizer") == NORMALIZER and step("pre_tokenizer") == PRE_TOKENIZER


def units_of(part: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends, rows and keys of the units of a slice: its words, each without its closing signs, and these.

    The tokenizer gives a run of CLOSING after a letter or digit a pre-token of its own. Only words of ASCII and Latin-1
    letters are cut and known by their lower case: no letter of theirs composes with another, and each has one letter as its
    lower case. All others, and those that may hold special tokens, are units as they stand.
    """
    data = part.data
    starts, ends, rows = part.spans(SPACE)
    if not len(starts):
        return starts, ends, rows, np.zeros(0, np.uint64)
    follows = np.append(data[1:], np.uint8(0))
    letter = (data == LATIN) & LATIN_LETTERS[follows]
    other = (data > 127) & ~letter & ~np.append(False, letter[:-1])
    other |= (data == ord("<")) & (follows == ord("|"))
    bad = np.zeros(len(data) + 1, np.int32)
    np.cumsum(other, out=bad[1:])
    plain = bad[ends] == bad[starts]
    last = np.maximum.accumulate(np.where(CLOSING[data], -1, np.arange(len(data))))[ends - 1] + 1
    cut = plain & (last > starts) & (last < ends)
    cut[cut] = ALNUM[data[last[cut] - 1]]
    tails = np.flatnonzero(cut)
    at = np.arange(len(starts)) + np.cumsum(cut) - cut  # a word's unit, with its tail behind it
    n = len(starts) + len(tails)
    unit_starts, unit_ends, unit_rows, lower = np.empty(n, np.int64), np.empty(n, np.int64), np.empty(n, np.int64), np.ones(n, bool)
    unit_starts[at], unit_ends[at], unit_rows[at], lower[at] = starts, np.where(cut, last, ends), rows, plain
    unit_starts[at[tails] + 1], unit_ends[at[tails] + 1], unit_rows[at[tails] + 1] = last[tails], ends[tails], rows[tails]
    keys = span_hashes(data, unit_starts, unit_ends, LOWER)
    rest = np.flatnonzero(~lower)
    if len(rest):
        keys[rest] = mix(span_hashes(data, unit_starts[rest], unit_ends[rest], PLAIN) ^ AS_IT_STANDS)
    return unit_starts, unit_ends, unit_rows, keys


def slice_ids(part: Slice, path: str, end: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The token ids of a slice's texts, ``end`` after each, one after the other, and where each text's begin and the last's end.

    Where the tokenizer works within words (see ``by_words``) the ids of a text are those of its units one after the other.
    White space neither composes with what follows it nor lets marks change places across it, so a unit's ids do not
    depend on its neighbours; they are encoded once and remembered.
    """
    model, within = encoder(path)
    encode = lambda some: [found.ids for found in model.encode_batch_fast(some, add_special_tokens=False)]
    content = part.data.tobytes()
    if not within:
        texts = [content[a:b].decode() for a, b in zip(part.offsets[:-1], part.offsets[1:], strict=True)]
        found = [ids + end for at in range(0, len(texts), WHOLE) for ids in encode(texts[at : at + WHOLE])]
        return np.fromiter(itertools.chain.from_iterable(found), "<u4"), np.cumsum([0, *map(len, found)])
    starts, ends, rows, keys = units_of(part)
    known, first, back = np.unique(keys, return_index=True, return_inverse=True)
    if len(_memory.keys) > REMEMBERED:
        _memory.clear()
    new = np.flatnonzero(_memory.find(known) < 0)
    if len(new):
        units = [content[a:b].decode() for a, b in zip(starts[first[new]].tolist(), ends[first[new]].tolist(), strict=True)]
        _memory.add(known[new], [ids for at in range(0, len(units), BATCH) for ids in encode(units[at : at + BATCH])])
    place = _memory.find(known)
    begin, count = (_memory.first[place][back], _memory.count[place][back]) if len(place) else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    before = np.cumsum(count) - count
    ids = _memory.ids[np.repeat(begin - before, count) + np.arange(int(count.sum()))]
    stops = np.searchsorted(rows, np.arange(part.rows), side="right")
    edges = np.append(0, np.cumsum(count))[np.append(0, stops)]
    if end:
        ids = np.insert(ids, np.repeat(edges[1:], len(end)), np.tile(np.array(end, "<u4"), part.rows))
        edges = edges + np.arange(part.rows + 1) * len(end)
    return ids, edges


def encode(texts: list[bytes], path: str) -> list[bytes]:
    """Token ids of each text as little-endian unsigned 32-bit integers."""
    out = []
    for part in slices(pa.array(texts, pa.large_binary())):
        ids, edges = slice_ids(part, path, [])
        out += [ids[a:b].tobytes() for a, b in zip(edges[:-1], edges[1:], strict=True)]
    return out


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def document_pieces(docs: DataFrame, capacity: int, end_id: int, tokenizer: str | None) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens): whole windows of a document, then what remains."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = tokenizer or default_tokenizer()
        for batch in batches:
            for part in slices(batch.column(1)):
                ids, edges = slice_ids(part, path, [int(end_id)])
                totals = np.diff(edges)
                pieces = -(-totals // capacity)
                row = np.repeat(np.arange(part.rows), pieces)
                start = (np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * capacity
                length = np.minimum(totals[row] - start, capacity)
                content, at = memoryview(ids.tobytes()), 4 * (edges[row] + start)
                crc = [zlib.crc32(content[a:b]) for a, b in zip(at.tolist(), (at + 4 * length).tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(part.first, part.rows).take(pa.array(row)), *map(pa.array, (start, length, np.array(crc, np.int64), totals[row]))],
                    ["doc_id", "start", "length", "ids_crc32", "doc_tokens"],
                )

    picked = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(tidy(run, OWNER), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def fullest(counts: dict[int, int], capacity: int) -> dict[int, int]:
    """The multiset of lengths, each at most as often as counted, whose sum is closest to ``capacity`` from below.

    Reachable sums are bits of one integer. Each length is added in binary portions; the sums before each portion are kept
    for the way back. Long lengths come first, so that the way back prefers them.
    """
    full = (1 << (capacity + 1)) - 1
    sums, steps = 1, []
    for length in sorted(counts, reverse=True):
        left, portion = min(counts[length], capacity // length), 1
        while left:
            portion = min(portion, left)
            left -= portion
            following = (sums | sums << (length * portion)) & full
            if following != sums:
                steps.append((length, portion, sums))
                sums = following
            portion *= 2
        if sums >> capacity & 1:
            break
    at, chosen = sums.bit_length() - 1, {}
    for length, portion, before in reversed(steps):
        if not before >> at & 1:
            chosen[length] = chosen.get(length, 0) + portion
            at -= length * portion
    return chosen


def plan_bins(counts: dict[int, int], capacity: int) -> list[tuple[int, dict[int, int]]]:
    """Patterns of lengths and how many bins each fills, together every piece once.

    Each bin takes the longest length left, which is the hardest to place, and the multiset that leaves the least slack
    beside it. A pattern is repeated while its lengths last, so each one exhausts a length: the plan's size depends on
    the capacity and not on the number of pieces.
    """
    left = {length: n for length, n in counts.items() if n}
    plan = []
    while left:
        longest = max(left)
        pattern = fullest({k: n - (k == longest) for k, n in left.items() if k <= capacity - longest}, capacity - longest)
        pattern[longest] = pattern.get(longest, 0) + 1
        times = min(left[length] // n for length, n in pattern.items())
        plan.append((times, pattern))
        for length, n in pattern.items():
            left[length] -= times * n
            if not left[length]:
                del left[length]
    return plan


def plan_tables(plan: list[tuple[int, dict[int, int]]]) -> dict[int, np.ndarray]:
    """By length: rows (first rank, copies per bin, first bin, offset in the bin) in order of rank."""
    seen: dict[int, int] = {}
    rows: dict[int, list] = {}
    first_bin = 0
    for times, pattern in plan:
        offset = 0
        for length in sorted(pattern, reverse=True):
            rows.setdefault(length, []).append((seen.get(length, 0), pattern[length], first_bin, offset))
            seen[length] = seen.get(length, 0) + times * pattern[length]
            offset += length * pattern[length]
        first_bin += times
    return {length: np.array(r, np.int64) for length, r in rows.items()}


def pack(docs: DataFrame, capacity: int = 2048, end_id: int = 1, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset) for each piece of each row of ``docs`` (doc_id, text).

    A document's ids are those of its text (null: none) and ``end_id``. Whole windows are sequences of their own; the
    remaining lengths are counted, and bins are planned from the counts alone: at most ``capacity`` lengths go to the
    driver, and as many patterns come back. Repeated rows are packed each on its own; texts without words are the end id
    alone; an empty table gives no rows; other columns are not read.
    """
    pieces = written(document_pieces(docs, capacity, end_id, tokenizer), "pieces")
    part = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(RANK_PARTS)).cast("int")
    parted = pieces.withColumn("part", part)
    tally = parted.groupBy("length", "part").count()
    starts = tally.select("length", "part", (F.sum("count").over(Window.partitionBy("length").orderBy("part")) - F.col("count")).alias("before"))
    totals = {r[0]: r[1] for r in tally.groupBy("length").agg(F.sum("count")).collect()}
    tables = plan_tables(plan_bins(totals, capacity))
    ranked = parted.withColumn("rank", F.row_number().over(Window.partitionBy("length", "part").orderBy("doc_id", "start", "ids_crc32")))
    ranked = ranked.join(starts, ["length", "part"]).select(*pieces.columns, (F.col("rank") - 1 + F.col("before")).alias("rank"))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, ranks = batch.column(2).to_numpy(), batch.column(5).to_numpy()
            bins, offsets = np.zeros(len(ranks), np.int64), np.zeros(len(ranks), np.int64)
            order = np.argsort(lengths, kind="stable")
            edges = np.flatnonzero(np.r_[True, np.diff(lengths[order]) != 0, True]) if len(order) else []
            for a, b in zip(edges[:-1], edges[1:], strict=True):
                rows = order[a:b]
                table = tables[int(lengths[rows[0]])]
                entry = table[np.searchsorted(table[:, 0], ranks[rows], side="right") - 1]
                within = ranks[rows] - entry[:, 0]
                bins[rows] = entry[:, 2] + within // entry[:, 1]
                offsets[rows] = entry[:, 3] + within % entry[:, 1] * lengths[rows]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(bins), pa.array(offsets)], [*batch.schema.names[:5], "sequence_id", "offset"])

    return ranked.mapInArrow(tidy(place, OWNER), "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long")
