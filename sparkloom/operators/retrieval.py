"""Chunks for topics: lexical, semantic and hybrid scores, and contexts under a size budget."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import plain
from ..functions.text import signature, strip, text, truncate
from ..functions.tokens import cosine, let, letter_share, sentences

TOPIC = ("topic_id", "topic_index", "name", "summary", "keywords")
# The marks of tables and cut words.
TABLE_RULE = "(?:^|\\s)---\\s*---"
CUT_WORD = "^[^\\s\\p{Lu}\\p{Ll}]*+\\p{Ll}[^\\s\\p{Lu}]*+\\s+\\p{Lu}"


def prepared(phrases: Column) -> Column:
    """Phrases in lower case, each with its words of more than three letters, so that they are taken apart once."""
    low = F.filter(F.transform(phrases, lambda p: strip(F.lower(p))), lambda p: p != "")
    return F.transform(low, lambda p: F.struct(p.alias("phrase"), F.filter(F.split(p, "\\s+"), lambda w: F.length(w) > 3).alias("words")))


def mentions(haystack: Column, phrases: Column) -> Column:
    """4 for each of the prepared ``phrases`` that occurs and 1 for each of its words that does."""

    def score(h: Column, p: Column) -> Column:
        return F.when(F.contains(h, p["phrase"]), 4).otherwise(0) + F.size(F.filter(p["words"], lambda w: F.contains(h, w)))

    return let(haystack, lambda h: F.aggregate(phrases, F.lit(0), lambda s, p: s + score(h, p)))


def phrases_of(name: Column, summary: Column, keys: Column) -> Column:
    return F.concat(F.array(text(name), text(summary)), F.coalesce(keys, F.array().cast("array<string>")))


def noisy(raw: Column) -> Column:
    """Whether a chunk is mostly tables or cut words."""
    return plain.applied(plain.noisy, "boolean", pa.bool_(), raw.cast("string"))


def usable_chunks(chunks: DataFrame) -> DataFrame:
    """Chunks that are not noisy, or all where a document has no other."""
    rows = chunks.withColumn("bad", noisy(F.col("text")))
    return rows.withColumn("any_good", F.max(~F.col("bad")).over(Window.partitionBy("document"))).where("NOT bad OR NOT any_good").drop("bad", "any_good")


def without_excluded(scored: DataFrame, excluded: DataFrame) -> DataFrame:
    """``scored`` without the chunks ``excluded`` (document, topic_id, chunk_id) for a topic, unless that leaves the topic none."""
    gone = excluded.select("document", "topic_id", "chunk_id", F.lit(True).alias("gone")).distinct()
    rows = scored.join(gone, ["document", "topic_id", "chunk_id"], "left")
    left = F.max(F.col("gone").isNull()).over(Window.partitionBy("document", "topic_id"))
    return rows.withColumn("any_left", left).where("gone IS NULL OR NOT any_left").drop("gone", "any_left")


def prepared_topic(topic_index: Column, topic_id: Column, name: Column, summary: Column, keys: Column) -> Column:
    """A topic as one struct, with its phrases taken apart and normalised, so that neither is done again for every chunk."""
    phrases = phrases_of(name, summary, keys)
    signs = F.array_distinct(F.filter(F.transform(phrases, signature), lambda p: p != ""))
    return F.struct(
        topic_index.alias("topic_index"), topic_id.alias("topic_id"), name.alias("name"), summary.alias("summary"), keys.alias("keywords"), prepared(phrases).alias("phrases"), signs.alias("signs")
    )


def topic_lists(topics: DataFrame) -> DataFrame:
    """(document, topics): a document's topics, a few, as one array in order."""
    rows = topics.select("document", prepared_topic(F.col("topic_index"), F.col("topic_id"), F.col("name"), F.col("summary"), F.col("keywords")).alias("t"))
    return rows.groupBy("document").agg(F.array_sort(F.collect_list("t")).alias("topics"))


def topic_scores(haystack: Column, topics: Column, penalty: float = 0.35) -> Column:
    """For each topic of an array (see ``topic_lists``): raw mentions, and the score after the strongest sibling's share."""

    def scored(raws: Column) -> Column:
        def one(own: Column) -> Column:
            sibling = F.array_max(F.transform(F.filter(raws, lambda o: o["id"] != own["id"]), lambda o: o["raw"]))
            return let(sibling, lambda s: F.struct(own["raw"].alias("raw"), F.when(s.isNull(), own["raw"].cast("double")).otherwise(F.greatest(F.lit(0.0), F.bround(own["raw"] - s * F.lit(penalty)))).alias("score")))

        return F.transform(raws, one)

    return let(haystack, lambda h: let(F.transform(topics, lambda t: F.struct(t["topic_id"].alias("id"), mentions(h, t["phrases"]).alias("raw"))), scored))


def scored_topics(rows: DataFrame, penalty: float = 0.35) -> DataFrame:
    """``rows`` (document, text, topics) once for each topic, with its columns, raw mentions and score."""
    haystack = F.concat(F.lower(F.col("text")), F.lit(" "), F.lower(F.col("document")))
    each = rows.withColumn("x", F.explode(F.arrays_zip(F.col("topics").alias("t"), topic_scores(haystack, F.col("topics"), penalty).alias("s"))))
    return each.select(*[c for c in rows.columns if c != "topics"], *[F.col(f"x.t.{c}").alias(c) for c in TOPIC], "x.s.raw", "x.s.score")


def lexical_scores(chunks: DataFrame, topics: DataFrame, penalty: float = 0.35) -> DataFrame:
    """Every chunk with every topic of its document: raw mentions, and the score after the strongest sibling's share.

    A document's few topics are one row, and meet its chunks on ``document``; a chunk's scores are told from that row alone.
    """
    return scored_topics(chunks.join(topic_lists(topics), "document"), penalty)


def semantic_scores(scored: DataFrame, chunk_vector: str = "chunk_vector", topic_vector: str = "topic_vector", hybrid: bool = False) -> DataFrame:
    """Scores by cosine, or by 0.4 of the lexical share of the topic's best and 0.6 of the cosine; lexical without a topic vector."""
    near = F.greatest(F.lit(0.0), cosine(F.coalesce(F.col(chunk_vector), F.array().cast("array<double>")), F.col(topic_vector)))
    top = F.max("score").over(Window.partitionBy("document", "topic_id"))
    mixed = F.lit(0.4) * F.when(top > 0, F.col("score") / top).otherwise(0.0) + F.lit(0.6) * near if hybrid else near
    return scored.withColumn("score", F.when(F.coalesce(F.size(topic_vector), F.lit(0)) > 0, mixed).otherwise(F.col("score")))


def selected_chunks(scored: DataFrame, budget: int = 24_000) -> DataFrame:
    """(document, topic_id, rank, chunk_id, chunk_index, limit): the chunks of each topic's context, in order; ``limit`` is the
    number of characters to which a block is cut, null where it is whole.

    A topic whose name stands in one chunk, or in two neighbours, takes that chunk and the next; one that overflows
    is cut if 500 characters are left. Otherwise chunks follow by score, those above 0 unless none is, until one does
    not fit. A block counts its marker. Texts do not travel: only their lengths and whether they name the topic.
    """
    low = strip(F.lower(F.col("name")))
    rows = scored.select(
        "document",
        "topic_id",
        "chunk_id",
        "chunk_index",
        "score",
        ((low != "") & F.contains(F.lower(F.col("text")), low)).alias("hit"),
        (F.length("chunk_id") + F.length("text") + 3).alias("block"),
    )
    topic = Window.partitionBy("document", "topic_id")
    rows = rows.withColumn("place", F.row_number().over(topic.orderBy("chunk_index")))
    at = F.when(F.col("hit"), F.col("place"))
    rows = rows.withColumns({"hits": F.count_if("hit").over(topic), "first_hit": F.min(at).over(topic), "last_hit": F.max(at).over(topic), "best": F.max("score").over(topic)})
    literal = (F.col("hits") == 1) | ((F.col("hits") == 2) & (F.col("last_hit") - F.col("first_hit") == 1))
    rows = rows.withColumn("named", F.coalesce(literal, F.lit(False)) & (F.col("place") >= F.col("first_hit")) & (F.col("place") <= F.col("first_hit") + 1))
    before = F.coalesce(F.sum(F.when(F.col("named"), F.col("block"))).over(topic.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumn("left", F.lit(budget) - before)
    rows = rows.withColumn("fits", F.col("named") & (F.col("block") <= F.col("left")))
    rows = rows.withColumn("cut", F.col("named") & (F.col("block") > F.col("left")) & (F.col("left") >= 500))
    rows = rows.withColumn("literal", F.max(F.col("fits") | F.col("cut")).over(topic))
    rows = rows.withColumn("ranked", ~F.col("literal") & ((F.col("score") > 0) | (F.col("best") <= 0)))
    order = topic.orderBy(F.col("ranked").desc(), F.col("score").desc(), "chunk_index")
    rows = rows.withColumns({"order": F.row_number().over(order), "upto": F.sum(F.when(F.col("ranked"), F.col("block"))).over(order.rowsBetween(Window.unboundedPreceding, 0))})
    rows = rows.where((F.col("literal") & (F.col("fits") | F.col("cut"))) | (F.col("ranked") & (F.col("upto") <= budget)))
    rank = F.when(F.col("literal"), F.col("place") - F.col("first_hit") + 1).otherwise(F.col("order"))
    return rows.select("document", "topic_id", rank.alias("rank"), "chunk_id", "chunk_index", F.when(F.col("cut"), F.col("left")).cast("int").alias("limit"))


def block_text(chunk_id: Column, body: Column, limit: Column) -> Column:
    """A chunk's text in a context, cut where its block, marker and all, is longer than ``limit``."""
    cut = F.substring(truncate(F.concat(F.lit("["), chunk_id, F.lit("] "), body), limit), F.length(chunk_id) + 4, F.length(body))
    return F.when(limit.isNotNull(), cut).otherwise(body)


def topic_contexts(scored: DataFrame, chunks: DataFrame, budget: int = 24_000) -> DataFrame:
    """(document, topic_id, rank, chunk_id, chunk_index, text): the texts of ``selected_chunks``."""
    chosen = selected_chunks(scored, budget)
    rows = chosen.join(chunks.select("document", "chunk_id", "text"), ["document", "chunk_id"])
    return rows.select("document", "topic_id", "rank", "chunk_id", "chunk_index", block_text(F.col("chunk_id"), F.col("text"), F.col("limit")).alias("text"))


def render_context(contexts: DataFrame) -> DataFrame:
    """(document, topic_id, context): blocks ``[chunk_id] text`` with an empty line between, for prompts; a block without
    an id is its text."""
    block = F.struct("rank", F.when(F.col("chunk_id").isNull(), F.col("text")).otherwise(F.concat(F.lit("["), "chunk_id", F.lit("] "), "text")).alias("block"))
    blocks = F.array_sort(F.collect_list(block))  # at most the budget's characters
    return contexts.groupBy("document", "topic_id").agg(F.array_join(F.transform(blocks, lambda b: b["block"]), "\n\n").alias("context"))


def window_array(c: Column) -> Column:
    """Runs of one to three sentences of a text: (sentence_start, sentence_count, window)."""

    def runs(s: Column) -> Column:
        n = F.size(s)
        each = lambda i, k: F.struct(i.alias("sentence_start"), F.lit(k).alias("sentence_count"), F.array_join(F.slice(s, i + 1, k), " ").alias("window"))
        by_start = F.transform(F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0))), lambda i: F.filter(F.array(*[each(i, k) for k in (1, 2, 3)]), lambda w: w["sentence_start"] + w["sentence_count"] <= n))
        return F.flatten(by_start)

    return let(sentences(c), runs)


def sentence_windows(contexts: DataFrame) -> DataFrame:
    """Runs of one to three sentences of each chunk: (.., sentence_start, sentence_count, window)."""
    return contexts.select("*", F.inline(window_array(F.col("text"))))


def direct_hits(window: Column, signs: Column) -> Column:
    """How many of a topic's normalised phrases a window holds."""
    return let(signature(window), lambda low: F.size(F.filter(signs, lambda p: F.contains(low, p))))
