"""A whole run: documents to items, splits, rejected and judged rows, debug rows and metadata, as folders of JSON lines."""

from __future__ import annotations

from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import Settings
from ..functions.text import now_iso
from ..operators import chunking, dedup, generation, judge, quality, retrieval, splits, topics
from ..sources import files, sinks
from ..sources.models import Embedder, Model
from ..store import path_exists, written
from . import pipeline

#: Items below which a topic counts as unfillable, and rounds of filling.
LEAST_ITEMS, ROUNDS = 2, 2


@dataclass(frozen=True)
class Models:
    """What a run asks: a language model, an embedder, and a judge (by default the model)."""

    model: Model
    embedder: Embedder | None = None
    judge: Model | None = None


@dataclass(frozen=True)
class Prepared:
    """Documents, chunks and topics of a run, saved: all that does not depend on generation."""

    docs: DataFrame
    chunks: DataFrame
    topics: DataFrame
    vectors: tuple[DataFrame, DataFrame] | None
    seed_mode: bool


def user_topics(spark: SparkSession, settings: Settings) -> list | None:
    """The topics of the user's file, or those of the user's questions; None without either."""
    if settings.topics_file:
        return files.topics_file(spark, settings.topics_file).orderBy("topic_index").collect()  # a file's few topics
    if settings.questions_file:
        return topics.question_topics(files.questions_file(spark, settings.questions_file)).orderBy("topic_index").collect()
    return None


def prepared(docs: DataFrame, models: Models, settings: Settings = Settings(), given: list | None = None) -> Prepared:
    """Chunks, topics and vectors of ``docs`` (document, document_stem, raw_text)."""
    docs = written(pipeline.documents_of(docs, settings), "documents")
    chunks = written(chunking.chunk_documents(docs, settings.chunk_size, settings.chunk_overlap, settings.max_chunks, "document", "raw_text", counted=True, stem="document_stem"), "chunks")
    found = written(pipeline.topic_map(docs, chunks, settings, models.model, given), "topics")
    vectors = None
    if settings.retrieval != "lexical" and models.embedder is not None:
        cache = f"{settings.debug}/vectors" if settings.debug else None
        vectors = pipeline.vectors_of(chunks, found, models.embedder, settings.embedding_model, cache)
    return Prepared(docs, chunks, found, vectors, bool(settings.questions_file))


@dataclass(frozen=True)
class Step:
    """One generation: its items, the contexts and windows it used, attempts and counters."""

    items: DataFrame
    contexts: DataFrame
    attempts: DataFrame
    stats: dict


def generated(p: Prepared, models: Models, wanted: DataFrame | int, settings: Settings, how: str, topic_rows: DataFrame, existing: DataFrame | None = None, used: DataFrame | None = None, excluded: DataFrame | None = None, offset: int = 0, seed: int | None = None) -> Step:
    """Items for ``topic_rows`` from contexts retrieved as ``how`` says; all topics of a document count as siblings."""
    scored = pipeline.scored_chunks(p.chunks, p.topics, how, p.vectors, excluded).join(topic_rows.select("document", "topic_id"), ["document", "topic_id"], "left_semi")
    contexts = written(pipeline.contexts_of(scored, p.chunks, p.docs, settings), "contexts")
    return generated_from(p, models, wanted, settings, contexts, existing, used, offset, seed)


def generated_from(p: Prepared, models: Models, wanted: DataFrame | int, settings: Settings, contexts: DataFrame, existing: DataFrame | None = None, used: DataFrame | None = None, offset: int = 0, seed: int | None = None) -> Step:
    rows = written(pipeline.evidence_rows(contexts, p.topics, used), "windows")
    ranked = quality.rank_evidence(rows.where("usable"))
    found = generation.generate_items(pipeline.asked_rows(ranked, p.docs), retrieval.render_context(pipeline.opened(contexts)), models.model, wanted, existing, settings.temperature, settings.seed if seed is None else seed, p.seed_mode, offset)
    unusable = rows.where("NOT usable").count()
    return Step(found.items, contexts, found.attempts, found.stats | {"discarded_windows": found.stats["discarded_windows"] + unusable})


def backfilled(p: Prepared, models: Models, settings: Settings, first: Step, gated: DataFrame) -> tuple[DataFrame, DataFrame, list[Step], DataFrame, list[dict]]:
    """(gated rows with those of the rounds, items of the rounds, the rounds, unfillable topics, log of the rounds).

    Topics with fewer accepted items than wanted are tried again: first from the same contexts without the windows that
    were used, then from contexts by another retrieval without the chunks that were. What comes is reassigned and gated.
    """
    alternative = "hybrid" if settings.retrieval == "semantic" else "semantic"
    with_contexts = first.contexts.select("document", "topic_id").distinct()
    topic_rows = written(p.topics.join(with_contexts, ["document", "topic_id"], "left_semi"), "topics-tried")
    steps, every, log = [first], gated, []
    for attempt in range(1, ROUNDS + 1):
        accepted = every.where("rejection_reason IS NULL")
        short = written(splits.deficits(accepted, topic_rows, settings.questions_per_topic), "deficits")
        if short.isEmpty():
            break
        wanted = short.select("document", "topic_id", F.col("missing").cast("int").alias("wanted"))
        items = steps[0].items if len(steps) == 1 else steps[0].items.unionByName(steps[1].items)
        used = items.select("document", "topic_id", F.col("context_source").alias("window"))
        for step in steps:
            used = used.unionByName(step.attempts.select("document", "topic_id", F.col("evidence").alias("window")))
        options = {"existing": items, "used": written(used.distinct(), "windows-used"), "offset": settings.questions_per_topic * attempt, "seed": settings.seed + 1000 * attempt}
        if attempt == 1:
            contexts = first.contexts.join(short.select("document", "topic_id"), ["document", "topic_id"], "left_semi")
            step = generated_from(p, models, wanted, settings, contexts, **options)
        else:
            gone = first.contexts.where("chunk_id IS NOT NULL").select("document", "topic_id", "chunk_id")
            step = generated(p, models, wanted, settings, alternative, short, excluded=gone, **options)
        more = pipeline.gated(step.items, topic_rows, settings)
        log.append({"attempt": attempt, "strategy": "primary" if attempt == 1 else f"alt:{alternative}", "topics": short.count(), "generated": step.items.count(), "evidence_first": step.stats})
        steps.append(step)
        every = written(every.unionByName(more, allowMissingColumns=True), "gated")
    lost = written(pipeline.unfillable(topic_rows, every.where("rejection_reason IS NULL"), LEAST_ITEMS), "unfillable")
    extra = steps[1].items if len(steps) == 2 else steps[1].items.unionByName(steps[2].items) if len(steps) == 3 else first.items.limit(0)
    return every, extra, steps[1:], lost, log


def resumed(spark: SparkSession, settings: Settings) -> DataFrame | None:
    """Items of earlier runs from the checkpoint, None without any."""
    at = f"{settings.debug}/items"
    if not settings.resume or not path_exists(spark, at):
        return None
    items = written(files.checkpoint_items(spark, at), "resumed")
    return None if items.isEmpty() else items


def run(spark: SparkSession, docs: DataFrame, models: Models, settings: Settings = Settings()) -> dict:
    """Writes a dataset of ``docs`` (document, document_stem, raw_text) under ``settings.output`` and gives its metadata.

    Folders of JSON lines: ``{output}.jsonl``, ``_train``, ``_val``, ``_test``, ``.rejected``, ``.judged``, and the file ``.meta.json``;
    under ``settings.debug`` each document's items, topics and attempts, and vectors of chunks.
    """
    settings = settings.validated(lambda path: path_exists(spark, path))
    given = user_topics(spark, settings)
    docs = written(docs.select("document", "document_stem", F.coalesce("raw_text", F.lit("")).alias("raw_text")), "sources")
    old = resumed(spark, settings)
    fresh = docs if old is None else docs.join(old.select("document").distinct(), "document", "left_anti")
    p = prepared(fresh, models, settings, given)
    valid = p.topics if p.seed_mode else p.topics.where(topics.valid_name(F.col("name")))
    first = generated(p, models, settings.questions_per_topic, settings, settings.retrieval, valid)
    tried = valid.join(first.contexts.select("document", "topic_id").distinct(), ["document", "topic_id"], "left_semi")
    items = first.items if old is None else first.items.unionByName(old, allowMissingColumns=True)
    gated = pipeline.gated(items, tried, settings)
    extra, steps, log, lost = first.items.limit(0), [], [], None
    if not p.seed_mode:
        gated, extra, steps, lost, log = backfilled(p, models, settings, first, gated)
    sinks.write_checkpoint(first.items.unionByName(extra), f"{settings.debug}/items")

    order = F.xxhash64("document", "topic_id", "id")
    candidates = written(gated.where("rejection_reason IS NULL").drop("rejection_reason").withColumn("seq", order), "candidates")
    deduped = written(dedup.deduplicate_items(candidates), "deduplicated")
    unique = deduped.where("duplicate_reason IS NULL").drop("duplicate_reason")
    rejected = gated.where("rejection_reason IS NOT NULL")
    final, judged, judge_stats = unique, None, {"mode": settings.judge, "model": settings.judge_model, "judged_items": 0}
    if settings.judge != "off":
        judged = written(judge.judge_by_document(unique, models.judge or models.model, settings.judge_model, settings.seed), "judged")
        judge_stats |= judge.judge_stats(judged).first().asDict() | {"reason_counts": {r["reason"]: r["items"] for r in judge.reason_counts(judged).orderBy("reason").collect()}}
        sinks.write_jsonl(judged.drop("seq"), f"{settings.output}.judged.jsonl")
        if settings.judge == "filter":
            told = judge.judge_filter(judged)
            final = unique.join(told.where("rejection_reason IS NULL").select("id"), "id", "left_semi")
            rejected = rejected.unionByName(told.where("rejection_reason IS NOT NULL"), allowMissingColumns=True)
    final = written(splits.split_rows(final.drop("seq"), settings.split, settings.seed), "final")
    rejected = written(rejected.drop("seq"), "rejected")
    sinks.write_dataset(final, rejected, settings.output)
    debug_rows = debug_documents(p, first, steps)
    sinks.write_jsonl(debug_rows, f"{settings.debug}/documents")

    done = written(p.docs.select("document", "document_language").unionByName(docs.join(p.docs.select("document"), "document", "left_anti").select("document", F.lit(None).cast("string").alias("document_language"))), "languages")
    stats = generation.merged_stats(first.stats, *[s.stats for s in steps])
    meta = metadata(settings, done, p, items, candidates, deduped, final, rejected, judge_stats, log, lost, stats, tried, old, given)
    sinks.write_metadata(spark, meta, f"{settings.output}.meta.json")
    return meta


def debug_documents(p: Prepared, first: Step, steps: list[Step]) -> DataFrame:
    """One row for each document: languages, chunks, how its topics were found, the topics with their contexts' sizes and items, and all attempts."""
    sizes = first.contexts.groupBy("document", "topic_id").agg(F.sum(F.length("text")).alias("topic_context_chars"))
    counts = first.items.groupBy("document", "topic_id").agg(F.count(F.lit(1)).alias("generated_items"))
    rows = p.topics.join(sizes, ["document", "topic_id"], "left").join(counts, ["document", "topic_id"], "left").na.fill(0, ["topic_context_chars", "generated_items"])
    told = F.struct("topic_index", "topic_id", F.col("name").alias("topic_name"), F.col("keywords").alias("topic_keywords"), "topic_context_chars", "generated_items")
    listed = rows.groupBy("document").agg(F.max("strategy").alias("topic_map_strategy"), F.array_sort(F.collect_list(told)).alias("topics"))  # a document's few topics
    attempts = first.attempts
    for step in steps:
        attempts = attempts.unionByName(step.attempts)
    tries = attempts.groupBy("document").agg(F.collect_list(F.struct("topic_id", "evidence_id", "attempt", F.col("reason").alias("rejection_reason"), "raw_content")).alias("attempts"))  # bounded by topics, windows and ATTEMPTS
    chunks = p.chunks.groupBy("document").agg(F.max("chunk_count").alias("chunk_count"))
    base = p.docs.select("document", F.col("document_language").alias("language"), F.col("language").alias("language_prompt"), chunking.language_scores(F.col("raw_text")).alias("language_scores"))
    return base.join(chunks, "document", "left").join(listed, "document", "left").join(tries, "document", "left").withColumn("topic_count", F.size(F.coalesce("topics", F.array())))


def metadata(settings: Settings, docs: DataFrame, p: Prepared, items: DataFrame, candidates: DataFrame, deduped: DataFrame, final: DataFrame, rejected: DataFrame, judge_stats: dict, log: list[dict], lost: DataFrame | None, stats: dict, tried: DataFrame, old: DataFrame | None, given: list | None, listed: int = 1000) -> dict:
    """What a run did, from aggregates; documents and topics are named up to ``listed`` of a kind."""
    count = lambda df, *c: {r[0]: r[1] for r in df.groupBy(*c).count().collect()}
    total, verified = final.count(), final.where("context_source_verified").count()
    actions = count(items_actions(candidates, rejected), "action")
    duplicates = {r["reason"]: r["items"] for r in dedup.duplicate_counts(deduped).collect()}
    names = ("duplicate_exact", "duplicate_semantic_question", "duplicate_semantic_qa", "duplicate_semantic_answer")
    before = candidates.agg(F.count(F.lit(1)), F.count_if("context_source_verified")).first()
    quality_stats = {
        "gate": settings.gate,
        "accepted_items": total,
        "rejected_items": rejected.count(),
        "verified_items": verified,
        "verified_ratio": round(verified / total, 4) if total else 0.0,
        "rejection_reasons": count(rejected, "rejection_reason"),
        "topic_reassignments": {"reassigned": actions.get("reassigned", 0), "rejected_no_match": actions.get("topic_mismatch_reassign", 0), "kept_as_is": actions.get("kept", 0)},
        "backfill_generated_items": sum(x["generated"] for x in log),
        "backfill_attempts": log,
        "unfillable_topics": [] if lost is None else [r.asDict() for r in lost.orderBy("document", "topic_id").limit(listed).collect()],
        "evidence_first": stats,
        "accepted_items_before_dedup": before[0],
        "verified_items_before_dedup": before[1],
        "duplicate_items_removed_after_quality": sum(duplicates.values()),
        "dedup_breakdown": {n: duplicates.get(n, 0) for n in names},
    }
    old_documents = 0 if old is None else old.select("document").distinct().count()
    resumed_counts = None if old is None else files.resume_counts(old).agg(F.sum("chunks"), F.sum("topics")).first()
    split = count(final, "split")
    params = {k: v for k, v in asdict(settings).items() if k not in ("server", "timeout", "retries", "backoff", "dry_run", "skip_model_check")}
    return {
        "created_at": final.sparkSession.sql("SELECT 1").select(now_iso()).first()[0],
        "model": settings.model,
        "language": settings.language,
        "document_languages": {r["document"]: r["document_language"] for r in docs.orderBy("document").limit(listed).collect()},
        "output": settings.output,
        "document_count": docs.count(),
        "chunk_count": p.chunks.count() + (resumed_counts[0] if resumed_counts else 0),
        "topic_count": p.topics.count() + (resumed_counts[1] if resumed_counts else 0),
        "generated_items": items.count() + quality_stats["backfill_generated_items"],
        "deduplicated_items": before[0] - quality_stats["duplicate_items_removed_after_quality"],
        "accepted_items": total,
        "rejected_items": quality_stats["rejected_items"],
        "context_source_verified_items": verified,
        "quality": quality_stats,
        "judge": judge_stats,
        "audit": splits.dataset_audit(final, rejected, tried),
        "resumed_documents": old_documents,
        "split": {s: split.get(s, 0) for s in ("train", "val", "test")},
        "params": params | {"user_topics": None if given is None else len(given)},
        "runtime": sinks.run_info(final.sparkSession),
    }


def items_actions(candidates: DataFrame, rejected: DataFrame) -> DataFrame:
    """What reassignment did with each item that was generated."""
    return candidates.select("id", "action").unionByName(rejected.select("id", "action")).where("action IS NOT NULL")


def read_sources(spark: SparkSession, settings: Settings, extract=None) -> DataFrame:
    """The documents of ``settings.source``: PDF files of a folder, those that ``only_document`` names."""
    found = files.only_documents(files.pdf_files(spark, settings.source), settings.only_document)
    return files.extracted(found, extract)


def dry_run(spark: SparkSession, docs: DataFrame, settings: Settings = Settings()) -> dict:
    """What a run would come to, without a model."""
    given = user_topics(spark, settings)
    return pipeline.dry_run(docs, settings, "document", "raw_text", None if given is None else len(given)).first().asDict()
