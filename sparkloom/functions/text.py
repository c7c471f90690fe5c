"""Cleaning of text as Column expressions; null reads as empty."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..lexicon import JOINED_WORDS, MISREAD_PAIRS, TWICE_MISREAD, VOICE, folded_letters

# Chunk markers and white space. Groups repeat possessively or a fixed number of times in all patterns here:
# others are matched by recursion, which long texts would drive too deep.
MARKER = "\\[[^\\]]+-chunk-\\d{4,}\\]"
WHITE = "[\\s\\x1c-\\x1f]"
SENTENCE_END = "[.!?](?:\\s+|$)"


def text(c: Column) -> Column:
    return F.coalesce(c.cast("string"), F.lit(""))


def sub(c: Column, *rules: tuple[str, str]) -> Column:
    """Regular expressions and replacements, one after the other."""
    for pattern, replacement in rules:
        c = F.regexp_replace(c, pattern, replacement)
    return c


def bound(value: Column, body) -> Column:
    """``body`` of ``value``, which is computed once however often the body and its inner functions use it."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def strip(c: Column) -> Column:
    """Without white space, Unicode's included, at both ends."""
    return F.regexp_replace(c, f"(?U)^{WHITE}++|(?<!{WHITE}){WHITE}++$", "")


def collapse_space(c: Column) -> Column:
    """Line ends as LF, runs of blanks as one, at most one empty line, no white space at the ends."""
    return strip(sub(text(c), ("\\r\\n?", "\n"), ("[ \\t]+", " "), ("\\n{3,}", "\n\n")))


def replaced(c: Column, pairs: tuple[tuple[str, str], ...]) -> Column:
    for bad, good in pairs:
        c = F.replace(c, F.lit(bad), F.lit(good))
    return c


def repair_encoding(c: Column) -> Column:
    return F.regexp_replace(replaced(text(c), MISREAD_PAIRS), "[\\x01-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]", "")


def fold(c: Column) -> Column:
    """Lower case without accents, for Latin letters; stays in generated code. ``fold_all`` covers all of Unicode."""
    marked, plain = folded_letters()
    return F.translate(F.regexp_replace(F.lower(text(c)), "\\p{Mn}+", ""), marked, plain)


def fold_all(c: Column) -> Column:
    """Lower case, compatibility decomposition, no combining marks, by Arrow batches."""
    @F.pandas_udf("string")
    def run(values: pd.Series) -> pd.Series:
        return values.map(lambda v: "".join(x for x in unicodedata.normalize("NFKD", v.lower()) if not unicodedata.combining(x)))

    return run(text(c))


def signature(c: Column) -> Column:
    """What questions are compared by: lower case, single blanks, then only letters, digits, underscores and blanks."""
    return sub(F.lower(strip(text(c))), (f"(?U){WHITE}+", " "), ("[^\\p{L}\\p{N}_\\s]", ""))


def repair_joined_words(c: Column) -> Column:
    return sub(c, *((f"(?iU)\\b{joined}\\b", apart) for joined, apart in JOINED_WORDS))


# A line that is only a heading of a closing section.
TAIL_HEADING = "(?imd)^\\s*(?:references|bibliography|code availability|data availability|acknowledgements|acknowledgments)\\s*$"


def drop_tail_sections(c: Column) -> Column:
    """Cut at the first line that is only a heading of references and the like, if it begins after a fifth of the text.

    Lines are found where they stand: what lies between them and they themselves add up to their places.
    """

    def cut(t: Column) -> Column:
        between, lines = F.split(t, TAIL_HEADING, -1), F.regexp_extract_all(t, F.lit(TAIL_HEADING), F.lit(0))
        none = F.struct(F.lit(0).alias("at"), F.lit(-1).alias("cut"))

        def step(acc: Column, x: Column) -> Column:
            place = acc["at"] + F.coalesce(F.length(x["between"]), F.lit(0))
            hit = (acc["cut"] < 0) & x["line"].isNotNull() & (place > F.length(t) * 0.2)
            return F.struct((place + F.coalesce(F.length(x["line"]), F.lit(0))).alias("at"), F.when(hit, place).otherwise(acc["cut"]).alias("cut"))

        found = F.aggregate(F.arrays_zip(between.alias("between"), lines.alias("line")), none, step)["cut"]
        return F.when(t.rlike(TAIL_HEADING), bound(found, lambda at: F.when(at >= 0, F.substring(t, F.lit(1), at)).otherwise(t))).otherwise(t)

    return bound(c, cut)


# Traces of pictures, breaks, tags and cut words, and what stands for them.
PICTURE = ("(?i)==\\s*picture\\s+\\d+\\s+x\\s+\\d+\\s+intentionally omitted\\s*<==", " ")
BREAK = ("(?i)<\\s*br\\b\\s*/?\\s*>?", " ")
TAG = ("<[^>]+>", " ")
HYPHEN = ("(?U)(\\w)-\\s+(\\w)", "$1$2")


# A number between white space; a row of words between slashes; lines of four numbers or more.
NUMBER = "[-+]?(?:\\d++(?:\\.\\d++)?|\\.\\d++)"
SLASHED = ("(?U)\\b\\w+\\b\\s*/\\s*\\b\\w+\\b\\s*/\\s*\\w+\\b(?:\\s*/\\s*\\w+\\b)*+", " ")
REST_OF_LINE = f"(?:[^\\S\\n]++{NUMBER})*+[^\\S\\n]*+$"
AFTER_BLANK_LINE = "(?<!\\n[^\\S\\n]{0,100}\\n)"  # what begins at a blank line begins at the first of several
NUMBER_LINES = (f"(?md)^{AFTER_BLANK_LINE}(?=\\s*+{NUMBER}(?:\\s++{NUMBER}){{3}}{REST_OF_LINE})\\s*+{NUMBER}{REST_OF_LINE}(?:\\s++{NUMBER}{REST_OF_LINE})*+\\s*$", " ")


def lone_numbers(least: int) -> tuple[str, str]:
    return (f"(?<![A-Za-z/.\\d-])\\b\\d{{{least},3}}\\b(?![A-Za-z/.\\d%-])", " ")


def clean_markup(c: Column) -> Column:
    """Without markup, links, lone numbers, slash tables, rows of numbers and closing sections."""
    c = sub(
        replaced(text(c), TWICE_MISREAD),
        PICTURE,
        BREAK,
        TAG,
        ("\\[([^\\]]+)\\]\\((https?://[^\\)]+)\\)", "$1"),
        ("https?://\\S+", " "),
        ("\\[\\[\\d+\\]\\]", " "),
        lone_numbers(1),
        ("[~`*_#>{}\\[\\]|]+", " "),
        SLASHED,
        NUMBER_LINES,
    )
    return collapse_space(drop_tail_sections(repair_joined_words(c)))


def clean_generated(c: Column) -> Column:
    """Questions and answers without extraction traces, the first letter in upper case."""
    c = collapse_space(repair_joined_words(sub(replaced(text(c), TWICE_MISREAD), PICTURE, BREAK, TAG, HYPHEN, lone_numbers(2))))
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substring(c, F.lit(2), F.length(c)))


def clean_context(c: Column) -> Column:
    return collapse_space(
        sub(
            text(c),
            BREAK,
            TAG,
            ("(?i)==\\s*picture\\b.*?intentionally omitted\\s*<==", " "),
            ("(?i)-----\\s*Start of picture text\\s*-----", " "),
            ("(?i)-----\\s*End of picture text\\s*-----", " "),
            HYPHEN,
        )
    )


def last_index(c: Column, char: str) -> Column:
    """Position from 0 of the last ``char``, -1 without one."""
    found = F.instr(F.reverse(c), char)
    return F.when(found > 0, F.length(c) - found).otherwise(F.lit(-1))


def truncate(c: Column, limit: Column | int) -> Column:
    """At most ``limit`` characters, cut after the last sentence or line end past three fifths of it."""
    limit = F.lit(limit) if isinstance(limit, int) else limit
    return bound(c, lambda whole: _truncated(whole, limit))


def _truncated(c: Column, limit: Column) -> Column:
    part = F.substring(c, F.lit(1), limit)
    back = F.instr(F.reverse(part), " .")
    sentence = F.when(back > 0, F.length(part) - back - 1).otherwise(F.lit(-1))
    end = F.greatest(sentence, last_index(part, "\n"))
    return F.when(F.length(c) <= limit, c).when(end > F.floor(limit * 0.6), F.substring(part, F.lit(1), end + 1)).otherwise(part)


def at_word(c: Column, limit: Column | int) -> Column:
    limit = F.lit(limit) if isinstance(limit, int) else limit
    part = F.substring(c, F.lit(1), limit)
    space = last_index(part, " ")
    return F.rtrim(F.when(space > F.floor(limit * 0.6), F.substring(part, F.lit(1), space)).otherwise(part), F.lit(" ,;:"))


def excerpt(c: Column, limit: Column | int) -> Column:
    """A cleaned beginning of at most ``limit`` characters that does not end inside a word."""
    limit = F.lit(limit) if isinstance(limit, int) else limit
    cleaned = clean_context(c)
    short = strip(truncate(cleaned, limit))
    return F.when(F.length(cleaned) <= limit, cleaned).when(~short.rlike("(?U)\\w$"), F.rtrim(short, F.lit(" ,;:"))).otherwise(at_word(cleaned, limit))


def context_fallback(c: Column, most: int = 700) -> Column:
    """A readable beginning of a context: to the first sentence end after 80 characters, else to a word's end."""
    clean = strip(F.regexp_replace(collapse_space(c), "^" + MARKER + "\\s*", ""))
    part = F.substring(clean, F.lit(1), F.lit(most))
    sentence = strip(F.regexp_extract(part, f"^((?s:.){{78,}}?{SENTENCE_END})", 1))
    return F.when(F.length(clean) <= most, clean).when(sentence != "", sentence).otherwise(at_word(clean, most))


def now_iso() -> Column:
    """The time of the query in UTC, as ISO text."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")


def paper_voice(c: Column) -> Column:
    """Answers that open in the authors' voice, in the paper's."""
    out = c
    for opening, instead in reversed(VOICE):
        out = F.when(F.startswith(c, F.lit(opening)), F.concat(F.lit(instead), F.substring(c, F.lit(len(opening) + 1), F.length(c)))).otherwise(out)
    return out


def distinct_in_order(values: Column) -> Column:
    """Stripped values without blanks, the first of those that differ only in case."""
    clean = F.filter(F.transform(values, strip), lambda v: v != "")
    lower = F.transform(clean, F.lower)
    return F.filter(clean, lambda v, i: F.array_position(lower, F.lower(v)) == i + 1)
