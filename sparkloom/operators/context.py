"""Fragments of topic contexts: verified sources, the chunks they come from, and excerpts round them.

A context is text with markers ``[{chunk}]`` before its chunks' texts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.text import MARKER, SENTENCE_END, clean_context, collapse_space, excerpt, strip, text, truncate
from ..functions.tokens import found, let

#: The first characters of a fragment by which its place is found.
PROBE = 80


def place_of(whole: Column, part: Column) -> Column:
    """Where ``part`` stands in ``whole`` whatever the case, from 0; -1 without it."""
    return F.call_function("locate", F.lower(part), F.lower(whole)) - 1


def sentence_window(whole: Column, start: Column, end: Column, most: int = 700) -> Column:
    """The sentences round whole[start:end], from 0: back to the last sentence end or marker within ``most`` characters, and on
    to the next sentence end; longer than ``most``, from the match itself on."""
    floor = F.greatest(F.lit(0), start - most)
    left = F.substring(whole, floor + 1, start - floor)
    by_sentence = F.length(F.regexp_extract(left, f"(?s)^(.*{SENTENCE_END})", 1))
    by_marker = F.length(F.regexp_extract(left, f"(?s)^(.*{MARKER})", 1))
    begin = floor + F.greatest(by_sentence, F.when(by_marker > 0, by_marker + 1).otherwise(F.lit(0)))

    def to_sentence_end(limit: Column) -> Column:
        return end + F.length(F.regexp_extract(F.substring(whole, end + 1, F.greatest(limit - end, F.lit(0))), f"(?s)^(.*?{SENTENCE_END})", 1))

    wide = to_sentence_end(F.least(F.length(whole), end + most))
    narrow = to_sentence_end(F.least(F.length(whole), start + most))
    inside = wide - begin <= most
    first, last = F.when(inside, begin).otherwise(start), F.when(inside, wide).otherwise(narrow)
    return strip(F.substring(whole, (first + 1).cast("int"), (last - first).cast("int")))


def verified_source(source: Column, context: Column, most: int = 700) -> Column:
    """struct(text, verified): the sentences round a source that stands in the context word for word, whatever its case; else an
    empty text and false. White space is evened out on both sides first."""

    def verify(x: Column) -> Column:
        start = place_of(x["context"], x["source"])
        held = (x["source"] != "") & (start >= 0)
        window = sentence_window(x["context"], start, start + F.length(x["source"]), most)
        return F.struct(F.when(held, window).otherwise("").alias("text"), held.alias("verified"))

    return let(F.struct(collapse_space(context).alias("context"), collapse_space(source).alias("source")), verify)


def marked_spans(whole: Column) -> Column:
    """(chunk_id, start, body, stop) of each marker of a context: where it begins and ends, and where the next one begins."""
    markers, between = found(whole, MARKER), F.split(whole, MARKER, -1)
    none = F.struct(F.length(F.get(between, F.lit(0))).alias("at"), F.array().cast("array<struct<chunk_id:string,start:int,body:int,stop:int>>").alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        body = (acc["at"] + F.length(x["marker"])).cast("int")
        stop = (body + F.length(x["after"])).cast("int")
        span = F.struct(F.substring(x["marker"], F.lit(2), F.length(x["marker"]) - 2).alias("chunk_id"), acc["at"].cast("int").alias("start"), body.alias("body"), stop.alias("stop"))
        return F.struct(stop.alias("at"), F.concat(acc["spans"], F.array(span)).alias("spans"))

    after = F.slice(between, F.lit(2), F.greatest(F.size(between) - 1, F.lit(0)))
    return F.aggregate(F.arrays_zip(markers.alias("marker"), after.alias("after")), none, step)["spans"]


def fragment_chunks(context: Column, fragment: Column) -> Column:
    """Ids of the chunks whose stretch of the context a fragment overlaps, in order; the first chunk where it is not found."""

    def involved(x: Column) -> Column:
        ids = lambda spans: F.array_distinct(F.transform(spans, lambda s: s["chunk_id"]))
        first = F.slice(ids(x["spans"]), 1, 1)
        start = place_of(x["context"], F.substring(x["fragment"], 1, PROBE))
        end = start + F.length(x["fragment"])
        over = ids(F.filter(x["spans"], lambda s: (s["start"] < end) & (s["stop"] > start)))
        return F.when((x["fragment"] == "") | (start < 0) | (F.size(over) == 0), first).otherwise(over)

    whole = let(clean_context(context), lambda c: F.struct(c.alias("context"), marked_spans(c).alias("spans"), collapse_space(fragment).alias("fragment")))
    return let(whole, involved)


def anchored_excerpt(context: Column, fragment: Column, most: int = 500) -> Column:
    """At most ``most`` characters of a context from the marker before a fragment, later where the fragment stands deep in its
    chunk; the context's beginning where the fragment is not found."""

    def anchored(x: Column) -> Column:
        whole = x["context"]
        start = F.when(x["fragment"] == "", -1).otherwise(place_of(whole, F.substring(x["fragment"], 1, PROBE)))
        span = F.try_element_at(F.filter(x["spans"], lambda s: s["start"] <= start), F.lit(-1))
        return let(F.struct(start.alias("at"), F.coalesce(span["start"], F.lit(0)).alias("start"), F.coalesce(span["body"], F.lit(0)).alias("body")), lambda p: built(whole, p))

    def built(whole: Column, p: Column) -> Column:
        marker = F.substring(whole, p["start"] + 1, p["body"] - p["start"])
        body_at = p["body"] + F.when(F.substring(whole, p["body"] + 1, F.lit(1)) == " ", 1).otherwise(0)
        body = F.substring(whole, body_at + 1, F.length(whole))
        room = F.lit(most) - F.length(marker) - 1
        deep = F.greatest(F.lit(0), p["at"] - body_at)
        far = deep > F.greatest(F.lit(80), F.floor(room / 4))
        back = F.greatest(F.lit(0), deep - F.greatest(F.lit(60), F.floor(room / 5))).cast("int")
        space = F.instr(F.reverse(F.substring(body, F.lit(1), back)), " ")
        boundary = back - space
        begin = F.when(~far, 0).when((space > 0) & (boundary > 0), boundary + 1).otherwise(back)

        def cut(q: Column) -> Column:
            return F.concat(q["prefix"], excerpt(F.substring(body, q["begin"] + 1, F.length(body)), F.lit(most) - F.length(q["prefix"])))

        prefix = F.when(begin > 0, F.concat(marker, F.lit(" ... "))).otherwise(F.concat(marker, F.lit(" ")))
        whole_cut = let(F.struct(prefix.alias("prefix"), begin.cast("int").alias("begin")), cut)
        return F.when(p["at"] < 0, excerpt(whole, most)).when(room <= 0, excerpt(marker, most)).otherwise(whole_cut)

    whole = let(clean_context(context), lambda c: F.struct(c.alias("context"), marked_spans(c).alias("spans"), clean_context(fragment).alias("fragment")))
    return F.when(text(context) == "", "").otherwise(let(whole, anchored))


def compact_context(context: Column, most: int) -> Column:
    """A context of at most about ``most`` characters in which all its chunks keep a share, for shorter prompts."""
    blocks = F.filter(F.transform(F.split(context, f"(?={MARKER})"), strip), lambda b: b != "")

    def kept(b: Column) -> Column:
        share = F.greatest(F.lit(800), F.floor(F.lit(most) / F.size(b))).cast("int")
        none = F.struct(F.lit(0).alias("total"), F.array().cast("array<string>").alias("kept"))

        def step(acc: Column, block: Column) -> Column:
            left = F.lit(most) - acc["total"]
            part = truncate(block, F.least(share, left))
            return F.when(left < 500, acc).otherwise(F.struct((acc["total"] + F.length(part) + 2).alias("total"), F.concat(acc["kept"], F.array(part)).alias("kept")))

        return F.when(F.size(b) <= 1, truncate(context, most)).otherwise(F.array_join(F.aggregate(b, none, step)["kept"], "\n\n"))

    return F.when(F.length(context) <= most, context).otherwise(let(blocks, kept))
