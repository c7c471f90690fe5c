"""Documents to a dataset of items: the stages of a run as transformations, saved between where they are used twice."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import prompts
from ..config import LEAST_CONTEXT, Settings
from ..functions.text import collapse_space, truncate
from ..operators import chunking, generation, quality, retrieval, splits, topics
from ..sources.models import Embedder, Model, embedded, replies
from ..store import written

Save = Callable[[DataFrame], DataFrame]
# An opening that a chunk's cut left at the start of a context.
CUT_OPENING = "^[a-z]{1,3}\\s[^\\n.!?]*[.!?]\\s*"


def dry_run(docs: DataFrame, settings: Settings = Settings(), document: str = "doc_id", raw: str = "text", given: int | None = None) -> DataFrame:
    """One row: documents, characters, chunks, and the topics, calls and items that a run would come to.

    ``given`` topics of the user take the place of those that a model would be asked for.
    """
    count = chunking.chunk_count(F.col(raw), settings.chunk_size, settings.chunk_overlap, settings.max_chunks)
    measured = docs.select(F.length(F.coalesce(F.col(raw), F.lit(""))).alias("chars"), count.alias("chunks"))
    total = measured.agg(F.count(F.lit(1)).alias("documents"), F.sum("chars").alias("chars"), F.sum("chunks").alias("chunks"))
    wanted = F.col("documents") * (settings.topics if given is None else given)
    calls = F.col("documents") + wanted if given is None else wanted
    return total.withColumns({"estimated_topics": wanted, "estimated_calls": calls, "estimated_items": wanted * settings.questions_per_topic})


def documents_of(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """(document, document_stem, raw_text, language, document_language, full) of ``docs`` (document, document_stem, raw_text): the language
    to write in and its code, and the text up to the document budget."""
    raw = F.col("raw_text")
    return docs.select("document", "document_stem", "raw_text", chunking.prompt_language(settings.language, raw).alias("language"), chunking.document_language(settings.language, raw).alias("document_language"), truncate(raw, settings.document_budget).alias("full"))


def topic_map(docs: DataFrame, chunks: DataFrame, settings: Settings = Settings(), model: Model | None = None, given: list | None = None, save: Save = written) -> DataFrame:
    """(document, topic_id, topic_index, name, summary, keywords, strategy) for each document with chunks.

    The user's topics, for every document; else those that a model finds in the whole text, or in excerpts; topics of which
    too many are general or no names give way to the sections', where there are any. Without a model, or without topics
    from it, sections and then chunks stand in. Each reply is saved before it is read.
    """
    some = save(docs.join(chunks.select("document").distinct(), "document", "left_semi"))
    columns = ["document", *retrieval.TOPIC]
    if given is not None:
        return topics.given_topics(some, given).withColumn("strategy", F.lit("user_file"))
    sections = topics.section_topics(some, settings.topics, "document", "raw_text").select(*columns)
    by_chunks = topics.fallback_topics(chunks, settings.topics).select(*columns)
    found = []
    if model is not None:
        asked = some.select("document", "language", F.lit(settings.topics).alias("wanted"), F.col("full").alias("context"), F.lit(settings.seed).alias("seed"))
        ask = lambda rows, prompt: save(generation.topics_from_reply(save(replies(rows, model, prompt, settings.temperature, settings.retries, settings.backoff)), most=settings.topics))
        whole = ask(asked, prompts.topic_map).select(*columns)
        missed = asked.drop("context").join(whole, "document", "left_anti")
        excerpts = missed.join(chunking.representative_context(chunks, min(settings.document_budget, 18_000)), "document").withColumnRenamed("sample", "context")
        sampled = ask(excerpts, prompts.topic_map_of_excerpts).select(*columns)
        found = [whole.withColumn("strategy", F.lit("llm")), sampled.withColumn("strategy", F.lit("llm_compact"))]
    headed = save(sections)
    if found:
        named = found[0].unionByName(found[1])
        poor = topics.topic_map_quality(named).where("too_general OR mostly_invalid").select("document").join(headed, "document", "left_semi")
        told = named.select("document", "strategy").distinct()
        refined = headed.join(poor, "document", "left_semi").join(told.select("document", F.concat("strategy", F.lit("_section_refined")).alias("strategy")), "document")
        found = [refined, named]
    return topics.first_topics([*found, headed.withColumn("strategy", F.lit("fallback_section_headings")), by_chunks.withColumn("strategy", F.lit("fallback_from_chunks"))])


def vectors_of(chunks: DataFrame, topic_rows: DataFrame, embedder: Embedder, model: str = "", cache: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(chunk_id, chunk_vector) and (document, topic_id, topic_vector); chunks' vectors are kept by their ids in ``cache``."""
    prompt = F.concat(F.coalesce("name", F.lit("")), F.lit(". "), F.coalesce("summary", F.lit("")), F.lit(". "), F.array_join("keywords", " "))
    asked = topic_rows.select("document", "topic_id", F.md5(prompt).alias("key"), prompt.alias("prompt"))
    by_key = embedded(asked, embedder, "key", "prompt", model).withColumnRenamed("vector", "topic_vector")
    of_chunks = embedded(chunks, embedder, "chunk_id", "text", model, cache).withColumnRenamed("vector", "chunk_vector")
    return of_chunks, asked.join(by_key, "key").select("document", "topic_id", "topic_vector")


def scored_chunks(chunks: DataFrame, topic_rows: DataFrame, how: str = "lexical", vectors: tuple[DataFrame, DataFrame] | None = None, excluded: DataFrame | None = None) -> DataFrame:
    """Every usable chunk with every topic of its document, scored as ``how`` says; lexically where a topic has no vector.

    ``excluded`` (document, topic_id, chunk_id) are left out, unless a topic would have no chunk.
    """
    scored = retrieval.lexical_scores(retrieval.usable_chunks(chunks), topic_rows)
    if excluded is not None:
        scored = retrieval.without_excluded(scored, excluded)
    if how == "lexical" or vectors is None:
        return scored
    of_chunks, of_topics = vectors
    joined = scored.join(of_chunks, "chunk_id", "left").join(of_topics, ["document", "topic_id"], "left")
    return retrieval.semantic_scores(joined, hybrid=how == "hybrid").drop("chunk_vector", "topic_vector")


def contexts_of(scored: DataFrame, chunks: DataFrame, docs: DataFrame | None = None, settings: Settings = Settings()) -> DataFrame:
    """(document, topic_id, rank, chunk_id, chunk_index, text): the context of each topic, block by block.

    Where the gate is not strict, a context shorter than LEAST_CONTEXT is the document's text itself, if that is longer; such
    a block has no chunk.
    """
    contexts = retrieval.topic_contexts(scored, chunks, settings.context_budget)
    if settings.gate == "strict" or docs is None:
        return contexts
    contexts = written(contexts, "contexts")
    sizes = contexts.groupBy("document", "topic_id").agg((F.sum(F.length("chunk_id") + F.length("text") + 3) + 2 * (F.count(F.lit(1)) - 1)).alias("size"))
    wide = sizes.where(F.col("size") < LEAST_CONTEXT).join(docs.select("document", "full"), "document").where(F.length("full") > F.col("size"))
    none = F.lit(None).cast("string")
    whole = wide.select("document", "topic_id", F.lit(1).alias("rank"), none.alias("chunk_id"), F.lit(0).alias("chunk_index"), truncate(F.col("full"), settings.context_budget).alias("text"))
    return contexts.join(wide, ["document", "topic_id"], "left_anti").unionByName(whole)


def opened(contexts: DataFrame) -> DataFrame:
    """Contexts without what a chunk's cut left before the first sentence of their first block."""
    cut = (F.col("rank") == 1) & F.col("chunk_id").isNotNull()
    return contexts.withColumn("text", F.when(cut, F.regexp_replace("text", CUT_OPENING, "")).otherwise(F.col("text")))


def evidence_rows(contexts: DataFrame, topic_rows: DataFrame, used: DataFrame | None = None) -> DataFrame:
    """Every window of the topics' contexts, with its score for the topic and whether it is ``usable``.

    A block that stands in several topics' contexts is taken apart once, scored for all topics of its document at once, and
    told to those that hold it. ``literal``: whether the window stands in the block word for word. ``used`` (document,
    topic_id, window) are not usable again, whatever their case.
    """
    held = opened(contexts).groupBy("document", "chunk_id", "text").agg(F.collect_list(F.struct("topic_id", "rank")).alias("members"))  # a document's few topics
    rows = held.join(retrieval.topic_lists(topic_rows), "document")
    rows = rows.select("document", "chunk_id", "members", "topics", F.lower(collapse_space(F.col("text"))).alias("low"), F.inline(retrieval.window_array(F.col("text"))))
    rows = rows.withColumns({"sound": quality.usable_evidence(F.col("window")), "scores": retrieval.topic_scores(F.concat(F.lower("window"), F.lit(" ")), F.col("topics"))})
    each = F.transform("topics", lambda t, i: F.struct(t.alias("t"), F.get(F.col("scores"), i).alias("s")))
    mine = F.transform("members", lambda m: F.struct(m["rank"].alias("rank"), F.get(F.filter(each, lambda x: x["t"]["topic_id"] == m["topic_id"]), F.lit(0)).alias("x")))
    rows = rows.select("document", "chunk_id", "sentence_start", "sentence_count", "window", "sound", F.contains(F.col("low"), F.lower("window")).alias("literal"), F.explode(mine).alias("m"))
    topic = [F.col(f"m.x.t.{c}").alias(c) for c in retrieval.TOPIC]
    score = F.col("m.x.s.score") + F.lit(0.25) * retrieval.direct_hits(F.col("window"), F.col("m.x.t.signs"))
    rows = rows.where("m.x IS NOT NULL").select("document", "chunk_id", F.col("m.rank").alias("rank"), *topic, "sentence_start", "sentence_count", "window", "literal", "sound", score.alias("score"))
    usable = F.col("sound") & ~quality.closing_topic(F.col("name"))
    if used is not None:
        gone = used.select(F.col("document").alias("gd"), F.col("topic_id").alias("gt"), F.lower(collapse_space(F.col("window"))).alias("gone")).distinct()
        rows = rows.join(gone, (F.col("document") == F.col("gd")) & (F.col("topic_id") == F.col("gt")) & (F.lower("window") == F.col("gone")), "left")
        return rows.withColumn("usable", usable & F.col("gone").isNull()).drop("sound", "gd", "gt", "gone")
    return rows.withColumn("usable", usable).drop("sound")


def asked_rows(ranked: DataFrame, docs: DataFrame) -> DataFrame:
    """Ranked evidence as ``generate_items`` takes it."""
    rows = ranked.select("document", "topic_id", "topic_index", F.col("name").alias("topic"), F.col("summary").alias("topic_summary"), F.col("keywords").alias("topic_keywords"), "evidence_id", "chunk_id", "evidence_rank", F.col("window").alias("evidence"), "literal")
    return rows.join(docs.select("document", "language", "document_language"), "document")


def gated(items: DataFrame, topic_rows: DataFrame, settings: Settings = Settings(), save: Save = written) -> DataFrame:
    """``items`` after reassignment and gate: action, their topic afterwards, and rejection_reason."""
    moved = save(quality.reassign_topics(items, topic_rows))
    lost = moved.where("action = 'topic_mismatch_reassign'").withColumn("rejection_reason", F.col("action"))
    return save(quality.quality_gate(moved.where("action <> 'topic_mismatch_reassign'"), settings.gate).unionByName(lost, allowMissingColumns=True))


def unfillable(topic_rows: DataFrame, accepted: DataFrame, least: int = 2) -> DataFrame:
    """(document, topic_id, topic_name, accepted) of topics that stay below ``least`` items."""
    short = splits.deficits(accepted, topic_rows, least)
    return short.join(topic_rows.select("document", "topic_id", F.col("name").alias("topic_name")), ["document", "topic_id"]).select("document", "topic_id", "topic_name", "accepted")
