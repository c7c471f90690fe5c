"""Word sets, n-grams and their measures as Column expressions."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..lexicon import STOPWORDS
from . import plain
from .text import bound as let
from .text import collapse_space, fold, text


# Words of several kinds, and where sentences are told apart.
CONTENT_WORD = "[A-Za-zÀ-ÿ]{4,}"
TERM, PHRASE = "[A-Za-z][A-Za-z-]{3,}", "[A-Za-z]+(?:-[A-Za-z]+)+"
ANSWER_TOKEN = "[A-Za-zÀ-ÿ0-9]{3,}"
NEXT_SENTENCE = "(?<=[.!?])\\s+(?=[\"'(\\[]?[A-Z0-9])"


def is_in(values):
    """A test for membership in a fixed list, for array functions."""
    fixed = list(values)
    return lambda t: t.isin(fixed)


def found(c: Column, pattern: str) -> Column:
    return F.regexp_extract_all(c, F.lit(pattern), F.lit(0))


def without(tokens: Column, dropped: list[str] | tuple[str, ...]) -> Column:
    return F.filter(tokens, lambda w: ~w.isin(list(dropped)))


def content_words(c: Column) -> Column:
    """Folded words of four letters or more that are no stop words, repeats included."""
    return without(found(fold(c), CONTENT_WORD), STOPWORDS)


def content_terms(c: Column) -> Column:
    return F.array_distinct(content_words(c))


def terms(c: Column) -> Column:
    """Distinct folded words of four signs or more, hyphens allowed, without stop words, and all hyphenated phrases."""
    folded = fold(c)
    return F.array_union(without(found(folded, TERM), STOPWORDS), found(folded, PHRASE))


def pairs(tokens: Column) -> Column:
    """Distinct neighbours joined by a blank; a single token stands for itself."""

    def joined(t: Column) -> Column:
        n = F.size(t)
        both = F.zip_with(F.slice(t, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(t, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: F.concat_ws(" ", a, b))
        return F.array_distinct(F.when(n < 2, t).otherwise(both))

    return let(tokens, joined)


def answer_tokens(c: Column) -> Column:
    return found(F.lower(text(c)), ANSWER_TOKEN)


def answer_pairs(c: Column) -> Column:
    return pairs(answer_tokens(c))


def question_pairs(c: Column) -> Column:
    return pairs(without(found(F.lower(text(c)), CONTENT_WORD), STOPWORDS))


def overlap(a: Column, b: Column) -> Column:
    """Overlap coefficient of two sets: shared members over those of the smaller; 0 where either is empty."""
    least = F.least(F.size(a), F.size(b))
    return F.when(least > 0, F.size(F.array_intersect(a, b)) / least).otherwise(F.lit(0.0))


def keywords(c: Column, k: int = 8) -> Column:
    """The ``k`` most frequent words of four signs or more, stop words left out; ties by first appearance."""
    return plain.applied(lambda s: plain.keywords(s, k), "array<string>", pa.list_(pa.string()), text(c))


def cosine(a: Column, b: Column) -> Column:
    """Cosine of two vectors in double precision over their common length; 0 where a norm is 0."""
    n = F.least(F.size(a), F.size(b))

    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda u, v: u.cast("double") * v.cast("double")), F.lit(0.0), lambda s, v: s + v)

    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(norms == 0, F.lit(0.0)).otherwise(dot(F.slice(a, F.lit(1), n), F.slice(b, F.lit(1), n)) / norms)


def sentences(c: Column) -> Column:
    """Sentences of a text, split before a capital or digit; those that end in . ! ? or a bracket."""
    flat = F.replace(collapse_space(c), F.lit("\n"), F.lit(" "))
    parts = F.transform(F.split(flat, NEXT_SENTENCE), lambda s: F.trim(s))  # F.trim itself would take a sentence's place for what to trim
    return F.filter(parts, lambda s: s.rlike("[.!?)]$"))


def letter_share(c: Column) -> Column:
    return F.length(F.regexp_replace(c, "[^\\p{L}]", "")) / F.greatest(F.length(c), F.lit(1))
