"""The rules for one document as plain Python: chunks, topics, scores, contexts and evidence of a text, and how tables meet them.

Expressions over long texts and arrays in arrays are interpreted a value at a time and computed again wherever they are used; the
same rules over a string are one pass. What Python's strings and patterns read as white space, letters and words of Unicode is what
the expressions in ``text``, ``tokens`` and the operators read; patterns with ``re.A`` are those that know ASCII only.
"""

import re
import unicodedata
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..lexicon import BAD_ENDINGS, MISREAD_PATTERN, STOPWORDS
from .text import MARKER

# White space of ASCII, as Java's patterns read it, and the patterns of the expressions.
BLANK = "[ \\t\\n\\x0b\\f\\r]"
BLANKS, WIDE_BLANKS, NEWLINES = re.compile(BLANK + "+"), re.compile("[ \\t]{2,}|\\t"), re.compile("\\n{3,}")
KEYWORD = re.compile("[A-Za-zÀ-ÿ][A-Za-zÀ-ÿ0-9_-]{3,}")
THREE_LETTERS, SIX_LETTERS = re.compile("[A-Za-zÀ-ÿ]{3,}"), re.compile("[A-Za-zÀ-ÿ]{6,}")
LATIN_RUN = re.compile("[A-Za-zÀ-ÖØ-öø-ÿ]+")
LINES, EDGE_MARKS = re.compile("\\r\\n|[\\n\\x0b\\f\\r\\x85\\u2028\\u2029]"), re.compile("^[-*#]+|[-*#]+\\Z")
AFTER_SENTENCE, NAME_WORD = re.compile("(?<=[.!?])" + BLANK + "+"), re.compile("[\\w-]+")
NUMBERED = re.compile("[0-9A-Z][0-9.]*" + BLANK + "+[A-Za-z]")
TABLE = re.compile(f"(?:\\A|{BLANK})---{BLANK}*---")
CUT_START = ("uld ", "lic ", "sary ", "tions ", "tive ")
HYPHENS = re.compile("\\b\\w+-\\s+\\w+")
FIRST_WORD = re.compile("[^ \\t\\n\\x0b\\f\\r]+")
NEXT_SENTENCE = re.compile("(?<=[.!?])" + BLANK + "+(?=[\"'(\\[]?[A-Z0-9])")
SENTENCE = re.compile("[.!?)](?:\\r\\n|[\\n\\r\\x85\\u2028\\u2029])?\\Z")
UNSIGNED = re.compile("[^\\w\\s]")
CUT_OPENING = re.compile("[a-z]{1,3}" + BLANK + "[^\\n.!?]*[.!?]" + BLANK + "*")
LAYOUT = re.compile(f"\\b(?:references|bibliography|acknowledg(?:e)?ments)\\b|\\b(?:fig|figure|table)\\.?{BLANK}*[0-9]+\\b|\\b(?:isbn|doi|arxiv|copyright|permission from)\\b")
ADDRESS = re.compile("\\b[A-Za-z0-9_.-]+@[A-Za-z0-9_.-]+\\b")
LOWER_START = re.compile("[a-z]{3,}\\b")
DANGLING = re.compile(f"\\.{BLANK}+[A-Z]\\.{BLANK}*\\Z")
HELD_MARKER, MISREAD = re.compile(MARKER, re.A), re.compile(MISREAD_PATTERN)
# One of these words or signs stands in each trace that rejects an item.
TRACE_SIGNS = ("omitted", "picture", "<", "fuctuation", "cuts", "[the", "riskadjusted", "computer", "medical", "process", "memory", "device", "system", "\ufffd", "dof", "section", "fig", "?")
# These and the signs of traces; a sentence without any has none of what rejects a window by its words.
REJECTING = (*TRACE_SIGNS, "references", "bibliography", "acknowledg", "table", "isbn", "doi", "arxiv", "copyright", "permission", "forthcoming", "@", "---", "-chunk-")
STOP, ENDINGS = frozenset(STOPWORDS), frozenset(BAD_ENDINGS)


def collapse_space(s: str) -> str:
    if "\r" in s:
        s = s.replace("\r\n", "\n").replace("\r", "\n")
    s = WIDE_BLANKS.sub(" ", s) if "  " in s or "\t" in s else s
    return (NEWLINES.sub("\n\n", s) if "\n\n\n" in s else s).strip()


def category(c: str) -> str:
    return unicodedata.category(c)


def chunks(raw: str | None, size: int = 3500, overlap: int = 350, most: int | None = None) -> list[str]:
    """Windows of ``size`` characters every ``size - overlap``, cut at white space where a word would be split late in the
    window, stripped, those of 120 characters or more."""
    clean, step, out = collapse_space(raw or ""), max(1, size - overlap), []
    n, late = len(clean), max(max(1, size - overlap), int(size * 0.6))
    for k in range(max(-(-(n - size) // step), 0) + 1):
        if most is not None and len(out) >= most:
            break
        at = k * step
        part = clean[at : at + size]
        if at + size < n and all(category(c)[0] in "LN" for c in clean[at + size - 1 : at + size + 1]):
            edge = max(part.rfind(" "), part.rfind("\n"))
            part = part[:edge] if edge >= late else part
        part = part.strip()
        if len(part) >= 120:
            out.append(part)
    return out


def keywords(s: str, k: int = 8) -> list[str]:
    return [w for w, _ in Counter(w for w in KEYWORD.findall(s.lower()) if w not in STOP).most_common(k)]


def truncate(s: str, limit: int) -> str:
    if len(s) <= limit:
        return s
    part = s[: max(limit, 0)]
    end = max(part.rfind(". "), part.rfind("\n"))
    return part[: end + 1] if end > int(limit * 0.6) else part


def valid_name(name: str) -> bool:
    if len(name) < 5:
        return False
    real = len(THREE_LETTERS.findall(name))
    if NUMBERED.match(name):
        return real >= 1
    return name[0].isalpha() and real >= 1 and (real >= 2 or bool(SIX_LETTERS.search(name))) and name.count("/") <= 2


def name_from_chunk(chunk: str, index: int, unnamed: str) -> str:
    """A readable name: a heading-like first line, else the first sentence of four words, else words, else a number."""
    first = next((x for x in (EDGE_MARKS.sub("", line.strip()) for line in LINES.split(chunk)) if len(x) >= 8), None)
    if first is not None and len(first) <= 90 and valid_name(first):
        return first
    clean = collapse_space(chunk)
    for part in AFTER_SENTENCE.split(clean):
        words = NAME_WORD.findall(part)
        if len(words) < 4:
            continue
        sentence = part.strip()
        if category(sentence[0]) == "Ll":
            title = LATIN_RUN.sub(lambda m: m[0][0].upper() + m[0][1:], " / ".join(keywords(clean, 4)))
            if title:
                return title
        return truncate(" ".join(words[:10]) if len(sentence) > 90 else sentence, 90).rstrip(" .,:;")
    words = NAME_WORD.findall(clean)[:8]
    return " ".join(words) if words else f"{unnamed}{index + 1}"


def summary(chunk: str) -> str:
    return truncate(chunk, 220).replace("\n", " ")


def topic_places(n: int, count: int = 8) -> list[int]:
    """The chunks, of ``n``, from which topics are made: at even steps."""
    want = min(count, n)
    return [i * max(1, n // max(want, 1)) for i in range(want)]


def cut_word(c: str) -> bool:
    """Whether a text begins inside a word that a capital follows."""
    word = FIRST_WORD.match(c)
    if word is None or not (gap := BLANKS.match(c, word.end())) or gap.end() >= len(c) or category(c[gap.end()]) != "Lu":
        return False
    kinds = {category(x) for x in word[0]}
    return "Lu" not in kinds and "Ll" in kinds


def letter_share(c: str) -> float:
    return sum(map(str.isalpha, c)) / max(len(c), 1)


def noisy(raw: str | None) -> bool:
    """Whether a chunk is mostly tables or cut words."""
    c = (raw or "").strip()
    if "---" in c and TABLE.search(c) or c[:6].lower().startswith(CUT_START) or cut_word(c) and len(FIRST_WORD.match(c)[0]) >= 4:
        return True
    return "-" in c and len(HYPHENS.findall(c)) >= 4 or len(c) >= 500 and letter_share(c) < 0.45


def signature(c: str) -> str:
    return UNSIGNED.sub("", " ".join(c.lower().split()))


class Topics:
    """A document's topics: how much each string that may occur counts for each of them.

    ``words`` hold no blank and so stand in a run of sentences where they stand in one of them; ``phrases`` may cross.
    """

    def __init__(self, ids: list[str], phrases: list[list[str]]):
        self.ids, self.phrases = ids, phrases
        words, runs = {}, {}
        for t, own in enumerate(phrases):
            for phrase in own:
                p = phrase.lower().strip()
                if p:
                    for s, weight in [(p, 4), *[(w, 1) for w in BLANKS.split(p) if len(w) > 3]]:
                        into = words if " " not in s else runs
                        into.setdefault(s, [0] * len(ids))[t] += weight
        self.words, self.runs = list(words), list(runs)
        self.word_weights = np.array(list(words.values()), np.int64).reshape(len(words), len(ids))
        self.run_weights = np.array(list(runs.values()), np.int64).reshape(len(runs), len(ids))
        self.siblings = [[o for o in range(len(ids)) if ids[o] != ids[t]] for t in range(len(ids))]

    def raws(self, hay: str) -> list[int]:
        """4 for each phrase of a topic that occurs and 1 for each of its words that does."""
        out = np.zeros(len(self.ids), np.int64)
        for strings, weights in ((self.words, self.word_weights), (self.runs, self.run_weights)):
            if strings:
                out += np.array([s in hay for s in strings], np.int64) @ weights
        return out.tolist()

    def scores(self, raws: list[int], penalty: float = 0.35) -> list[float]:
        """Raw mentions after the strongest sibling's share."""
        out = []
        for t, others in enumerate(self.siblings):
            best = max((raws[o] for o in others), default=None)
            out.append(float(raws[t]) if best is None else max(0.0, float(round(raws[t] - best * penalty))))
        return out

    def score_column(self, raws: np.ndarray, topic: int, penalty: float = 0.35) -> np.ndarray:
        """The scores of one topic from many rows of raw mentions."""
        own, others = raws[:, topic], self.siblings[topic]
        return np.maximum(0.0, np.rint(own - raws[:, others].max(axis=1) * penalty)) if others else own.astype(float)

    def signs(self) -> list[list[str]]:
        return [list(dict.fromkeys(x for x in map(signature, own) if x)) for own in self.phrases]


def selected(blocks: list[int], low: list[str] | None, scores: list[float], name: str, budget: int) -> list[tuple[int, int, int | None]]:
    """(place in the lists, rank, limit) of one topic's chunks in its context; see ``retrieval.selected_chunks``."""
    wanted = name.lower().strip()
    hits = [i for i, text in enumerate(low) if wanted in text] if wanted and low is not None else []
    if len(hits) == 1 or len(hits) == 2 and hits[1] - hits[0] == 1:
        out, left = [], budget
        for i in range(hits[0], min(hits[0] + 2, len(blocks))):
            if blocks[i] <= left:
                out.append((i, i - hits[0] + 1, None))
            elif left >= 500:
                out.append((i, i - hits[0] + 1, left))
            left -= blocks[i]
        if out:
            return out
    best, out, upto = max(scores, default=0.0), [], 0
    for rank, i in enumerate(sorted((i for i, s in enumerate(scores) if s > 0 or best <= 0), key=lambda i: -scores[i]), 1):
        upto += blocks[i]
        if upto > budget:
            break
        out.append((i, rank, None))
    return out


def block_text(chunk_id: str, body: str, limit: int | None) -> str:
    """A chunk's text in a context, cut where its block, marker and all, is longer than ``limit``."""
    return body if limit is None else truncate(f"[{chunk_id}] {body}", limit)[len(chunk_id) + 3 :]


def opened(body: str) -> str:
    """A context's first block without what a chunk's cut left before its first sentence."""
    cut = CUT_OPENING.match(body)
    return body if cut is None else body[cut.end() :]


def sentences(c: str) -> list[str]:
    return [s for s in (x.strip(" ") for x in NEXT_SENTENCE.split(collapse_space(c).replace("\n", " "))) if SENTENCE.search(s)]


def last_word(c: str) -> str:
    """The last run of ASCII letters, if nothing but signs and blanks follows it."""
    end = len(c)
    while end and not (c[end - 1].isalnum() or c[end - 1] == "_"):
        end -= 1
    begin = end
    while begin and c[begin - 1].isascii() and c[begin - 1].isalpha():
        begin -= 1
    return c[begin:end]


def truncated(c: str) -> bool:
    """Whether a window of evidence begins or ends inside a word or clause."""
    c = collapse_space(c)
    if not c:
        return False
    if len(c) > 120 and c[-1] not in ".;:!?)]" or LOWER_START.match(c) or cut_word(c):
        return True
    return len(c) > 40 and last_word(c).lower() in ENDINGS


def traced(low: str, traces: re.Pattern) -> bool:
    return any(s in low for s in TRACE_SIGNS) and bool(traces.search(low))


def closing_topic(name: str, traces: re.Pattern) -> bool:
    low = name.lower()
    return traced(" " + low, traces) or low.strip().endswith("references")


def usable_window(w: str, low: str, traces: re.Pattern) -> bool:
    """Whether a window can stand as evidence, whatever the topic; ``low`` is the window in lower case."""
    if len(w) < 60 or len(THREE_LETTERS.findall(w)) < 10 or LAYOUT.search(low) or "forthcoming" in low:
        return False
    if "---" in w and TABLE.search(w) or "@" in w and ADDRESS.search(w) or len(w) >= 120 and letter_share(w) < 0.45 or truncated(w):
        return False
    if traced(f"placeholder question placeholder answer {low} {low} ", traces) or MISREAD.search(w) or "-chunk-" in w and HELD_MARKER.search(w):
        return False
    return not DANGLING.search(collapse_space(w))


class Sentence:
    """What windows are told by of one of their sentences; ``plainly`` where all of it adds up over sentences."""

    def __init__(self, s: str):
        self.s, self.low, self.signed = s, s.lower(), signature(s)
        self.words, self.letters = len(THREE_LETTERS.findall(s)), sum(map(str.isalpha, s))
        even = "  " not in s and s.isprintable() and s == s.strip()
        self.plainly = even and " " in s and self.words > 0 and s[-1] in ".!?)" and (s.isascii() or not MISREAD.search(s)) and not any(x in self.low for x in REJECTING)
        self.cut = self.plainly and (LOWER_START.match(s) is not None or cut_word(s))
        self.ending = last_word(s).lower() if self.plainly else ""


def usable_run(run: list[Sentence], window: str, low: str, traces: re.Pattern) -> bool:
    """``usable_window``, by what is known of its sentences."""
    if len(window) < 60 or sum(s.words for s in run) < 10:
        return False
    if not all(s.plainly for s in run):
        return usable_window(window, low, traces)
    if run[0].cut or len(window) >= 120 and sum(s.letters for s in run) / len(window) < 0.45 or run[-1].ending in ENDINGS:
        return False
    return not (window[-1] == "." and "A" <= window[-2] <= "Z" and window[-4:-2] == ". ")


def windows(body: str, topics: Topics, signs: list[list[str]], traces: re.Pattern, unsound: bool = True) -> list[tuple]:
    """(sentence_start, sentence_count, window, in lower case, sound, score for each topic) of runs of one to three sentences.

    What holds no blank is looked for once in each sentence, and only phrases in whole windows.
    """
    parts = [Sentence(s) for s in sentences(body)]
    kept = []
    for i in range(len(parts)):
        for k in range(1, min(3, len(parts) - i) + 1):
            run = parts[i : i + k]
            window, low = " ".join([s.s for s in run]), " ".join([s.low for s in run])
            sound = usable_run(run, window, low, traces)
            if sound or unsound:
                kept.append((i, k, window, low, sound))
    if not kept:
        return []
    at, count = np.array([w[0] for w in kept]), np.array([w[1] for w in kept])

    def over_windows(held: np.ndarray) -> np.ndarray:
        """Whether any sentence of a window holds each string, from whether each sentence does."""
        out = held[at]
        for j in (1, 2):
            more = count > j
            out[more] |= held[at[more] + j]
        return out

    def tally(strings: list[str], weights: np.ndarray, texts: list[str], whole: list[str]) -> np.ndarray:
        every = " ".join(texts)
        there = [j for j, s in enumerate(strings) if s in every]
        single = [j for j in there if " " not in strings[j]]
        held = np.array([[strings[j] in x for j in single] for x in texts], bool).reshape(len(texts), len(single))
        out = over_windows(held).astype(np.int64) @ weights[single]
        for j in there:
            if " " in strings[j]:
                out += np.array([strings[j] in x for x in whole], np.int64)[:, None] * weights[j]
        return out

    raws = tally(topics.words + topics.runs, np.concatenate([topics.word_weights, topics.run_weights]), [s.low for s in parts], [w[3] for w in kept])
    each = [(s, t) for t, own in enumerate(signs) for s in own]
    one = np.array([[t == o for o in range(len(signs))] for _, t in each], np.int64).reshape(len(each), len(signs))
    signed = [s.signed for s in parts]
    direct = tally([s for s, _ in each], one, signed, [" ".join(signed[w[0] : w[0] + w[1]]) for w in kept])
    scores = np.stack([topics.score_column(raws, t) for t in range(len(signs))], axis=1) + 0.25 * direct
    return [(*w, s) for w, s in zip(kept, scores.tolist(), strict=True)]


def per_row(rows: DataFrame, each: Callable, schema: str, types: list[pa.DataType]) -> DataFrame:
    """What ``each`` gives for every row's values, a list of tuples, as rows of ``schema``; they leave in small batches."""
    names = [c.split()[0] for c in schema.split(", ")]

    def batch_of(held: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(column, kind) for column, kind in zip(zip(*held, strict=True), types, strict=True)], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                got = each(*row)
                held += got
                size += len(got) * 200 + sum(len(x) for r in got for x in r if isinstance(x, str))
                if size >= 4_000_000:
                    yield batch_of(held)
                    held, size = [], 0
        if held:
            yield batch_of(held)

    return rows.toDF(*[f"c{i}" for i in range(len(rows.columns))]).mapInArrow(run, schema)


def applied(function: Callable, kind: str, arrow: pa.DataType, *columns: Column) -> Column:
    """A column of what ``function`` gives for each row's values."""

    def run(*arrays: pa.Array) -> pa.Array:
        return pa.array(list(map(function, *(a.to_pylist() for a in arrays))), arrow)

    return F.arrow_udf(run, kind)(*columns)
