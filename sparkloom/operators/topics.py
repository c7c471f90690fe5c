"""Topics of documents: headings, names, fallbacks, files and model replies."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import plain
from ..functions.text import collapse_space, distinct_in_order, text, truncate
from ..functions.tokens import found, keywords
from ..lexicon import BLOCKED_HEADINGS, GENERIC_NAMES
from ..store import numbered


# Line ends, the summary of a section's topic, and the name of a topic without words.
LINE_END = "\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x85\\u2028\\u2029]"
SECTION_SUMMARY = ("Questions grounded in the '", "' section of the document.")
UNNAMED = "Topico "


def headings(raw: Column) -> Column:
    """Short lines of a text that read like section headings, the first of those that differ only in case."""
    lines = F.transform(F.split(text(raw), LINE_END), lambda s: F.replace(collapse_space(s), F.lit("Histor y"), F.lit("History")))

    def reads(line: Column) -> Column:
        tokens = F.split(F.regexp_replace(line, "\\s+", " "), " ")
        small = F.size(F.filter(tokens, lambda w: w.rlike("^\\p{Ll}") & ~F.lower(w).isin("and", "or", "of", "in", "for", "to", "the")))
        return (
            F.length(line).between(3, 80)
            & ~line.rlike("https?://|ISBN|\\[\\d+\\]|\\d{4}|@")
            & ~line.rlike("^\\d[A-Za-z]")
            & (F.size(tokens) <= 8)
            & line.rlike("[A-Za-z]")
            & ~line.rlike("[.,]$")
            & ~line.rlike("(?i)\\b(?:University|Department|Institute|Laboratory|College|School)\\b")
            & (small <= F.greatest(F.lit(1), F.floor(F.size(tokens) / 2)))
        )

    return distinct_in_order(F.filter(lines, reads))


def section_topics(docs: DataFrame, count: int = 8, document: str = "doc_id", raw: str = "text") -> DataFrame:
    """(document, topic_id, topic_index, name, summary, keywords) from headings, spread over all of a document's."""
    useful = F.filter(headings(F.col(raw)), lambda h: ~F.lower(h).isin(list(BLOCKED_HEADINGS)) & ~F.startswith(F.lower(h), F.lit("list of ")))
    rows = docs.select(F.col(document).cast("string").alias("document"), useful.alias("h"))
    n = F.size("h")
    spread = F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda i: F.get(F.col("h"), F.floor(i * n / count).cast("int")))
    rows = rows.select("document", F.posexplode(F.when(n <= count, F.col("h")).otherwise(spread)).alias("topic_index", "name"))
    return rows.select(
        "document",
        F.format_string("topic-%02d", "topic_index").alias("topic_id"),
        "topic_index",
        "name",
        F.concat(F.lit(SECTION_SUMMARY[0]), F.col("name"), F.lit(SECTION_SUMMARY[1])).alias("summary"),
        keywords(F.col("name")).alias("keywords"),
    )


def valid_name(name: Column) -> Column:
    """Whether a name reads like a topic and not like a piece of text or a table."""
    numbered = name.rlike("^[\\dA-Z][\\d.]*\\s+[A-Za-z]")
    real = F.size(found(name, "[A-Za-zÀ-ÿ]{3,}"))
    plain = name.rlike("^\\p{L}") & (real >= 1) & ((real >= 2) | name.rlike("[A-Za-zÀ-ÿ]{6,}")) & (F.length(name) - F.length(F.replace(name, F.lit("/"), F.lit(""))) <= 2)
    return F.when(name.isNull() | (F.length(name) < 5), F.lit(False)).when(numbered, real >= 1).otherwise(plain)


def general_name(name: Column) -> Column:
    hit = F.lit(False)
    for phrase in GENERIC_NAMES:
        hit = hit | F.contains(F.lower(name), F.lit(phrase))
    return hit


def topic_map_quality(topics: DataFrame, by: str = "document") -> DataFrame:
    """Per document: topics, those with general and with invalid names, and whether these are at least half (and two)."""
    counted = topics.groupBy(by).agg(F.count(F.lit(1)).alias("topics"), F.count_if(general_name(F.col("name"))).alias("general"), F.count_if(~valid_name(F.col("name"))).alias("invalid"))
    floor = F.greatest(F.lit(2).cast("long"), F.floor(F.col("topics") / 2))
    return counted.select("*", (F.col("general") >= floor).alias("too_general"), (F.col("invalid") >= floor).alias("mostly_invalid"))


def name_from_chunk(chunk: Column, index: Column) -> Column:
    """A readable name: a heading-like first line, else the first sentence of four words, else words, else a number."""
    return plain.applied(lambda c, i: plain.name_from_chunk(c or "", i, UNNAMED), "string", pa.string(), chunk, index.cast("int"))


def fallback_topics(chunks: DataFrame, count: int = 8) -> DataFrame:
    """(document, topic_id, topic_index, name, summary, keywords) from chunks at even steps through each document.

    One pass where the chunks come with chunk_count; else they are counted by a shuffle.
    """
    n = F.col("chunk_count").cast("long") if "chunk_count" in chunks.columns else F.count(F.lit(1)).over(Window.partitionBy("document"))
    want = F.greatest(F.lit(1).cast("long"), F.least(F.lit(count).cast("long"), n))
    step = F.greatest(F.lit(1).cast("long"), F.floor(n / want))
    rows = chunks.withColumns({"want": want, "step": step}).where((F.col("chunk_index") % F.col("step") == 0) & (F.col("chunk_index") / F.col("step") < F.col("want")))
    rows = rows.withColumn("topic_index", (F.col("chunk_index") / F.col("step")).cast("int"))
    return rows.select("document", F.format_string("topic-%02d", "topic_index").alias("topic_id"), "topic_index", *[c.alias(k) for k, c in topic_of(F.col("text"), F.col("topic_index")).items()])


def topic_of(chunk: Column, index: Column) -> dict[str, Column]:
    """What a chunk's text gives a topic: name, summary and keywords."""
    return {"name": name_from_chunk(chunk, index), "summary": F.replace(truncate(chunk, 220), F.lit("\n"), F.lit(" ")), "keywords": keywords(chunk, 8)}


def first_topics(sources: list[DataFrame]) -> DataFrame:
    """The topics of the first of several frames that has any for a document."""
    every = None
    for i, df in enumerate(sources):
        tagged = df.withColumn("__order", F.lit(i))
        every = tagged if every is None else every.unionByName(tagged)
    return every.withColumn("__least", F.min("__order").over(Window.partitionBy("document"))).where("__order = __least").drop("__order", "__least")


def given_topics(docs: DataFrame, given: list) -> DataFrame:
    """Each document with each of the user's topics, a file's few, in their order."""
    each = F.array(*[F.struct(F.lit(t["topic_id"]).alias("topic_id"), F.lit(t["topic_index"]).cast("int").alias("topic_index"), F.lit(t["name"]).alias("name"), F.lit(t["summary"]).alias("summary"), F.array(*map(F.lit, t["keywords"])).cast("array<string>").alias("keywords")) for t in given])
    return docs.select("document", F.inline(each))


def question_topics(questions: DataFrame, question: str = "question", seq: str = "seq") -> DataFrame:
    """Each seed question as a topic of its own, numbered in the order of ``seq``."""
    rows = numbered(questions, seq, name="topic_index").withColumn("topic_index", F.col("topic_index").cast("int"))
    return rows.select(F.format_string("seed-%02d", "topic_index").alias("topic_id"), "topic_index", F.col(question).alias("name"), F.col(question).alias("summary"), keywords(F.col(question), 6).alias("keywords"))
