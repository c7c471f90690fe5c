"""Registered queries without SQL, on small tables."""

import random

import pytest
from pyspark.sql import functions as F

from sparkloom.config import Settings
from sparkloom.functions import plain
from sparkloom.operators import chunking, quality, retrieval, topics, whole
from sparkloom.plans import pipeline, queries

THEMES = ("glacier", "harbour", "orchard", "furnace", "library", "meadow", "volcano", "compass", "lantern", "granary")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Documents 1 and 2 of ten themes each, and a vector for the first alone."""
    at = str(tmp_path_factory.mktemp("tables"))
    text = " ".join(" ".join(f"The {t} number {i} stands near another {t} today." for i in range(24)) for t in THEMES)
    spark.createDataFrame([(1, text), (2, text)], "doc_id long, text string").write.parquet(f"{at}/documents.parquet")
    rows = [(1, [1.0, 0.2, 0.0], 0), (90, [0.0, 1.0, 0.0], 1), (91, [0.0, 0.0, 1.0], 2), (92, [1.0, 1.0, 1.0], 3)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{at}/embeddings.parquet")
    return at


@pytest.mark.parametrize("name", ["q_lexical_score", "q_budget_context", "q_literal_context", "q_hybrid_score", "q_evidence"])
def test_queries_take_all_eight_topics(spark, folder, name):
    got = queries.QUERIES[name](spark, folder).where("document = '1'").select("topic_id").distinct().collect()
    assert sorted(r.topic_id for r in got) == [f"topic-{i:02d}" for i in range(8)]
    summaries = queries.whole_topics(spark, folder).select("summary", "keywords").collect()
    assert all(r.summary for r in summaries) and max(len(r.keywords) for r in summaries) > 4


def test_hybrid_scores_need_no_vector_and_tell_topics_apart(spark, folder):
    got = queries.QUERIES["q_hybrid_score"](spark, folder).collect()
    scores = {(r.document, r.topic_id, r.chunk_index): r.score for r in got}
    lexical = queries.retrieval.lexical_scores(queries.chunks_of(spark, folder), queries.whole_topics(spark, folder)).collect()
    assert len(got) == len(scores) == len(lexical)
    top = {}
    for r in lexical:
        top[r.document, r.topic_id] = max(top.get((r.document, r.topic_id), 0.0), r.score)
    centres = ([1.0, 0.2, 0.0], [0.0, 1.0, 0.0], [0.0, 0.0, 1.0], [1.0, 1.0, 1.0])
    cosine = lambda a, b: sum(x * y for x, y in zip(a, b, strict=True)) / (sum(x * x for x in a) * sum(y * y for y in b)) ** 0.5
    for r in lexical:
        want, best = r.score, top[r.document, r.topic_id]
        if r.document == "1" and r.topic_index < len(centres):
            want = 0.4 * (r.score / best if best > 0 else 0.0) + 0.6 * max(0.0, cosine(centres[0], centres[r.topic_index]))
        assert scores[r.document, r.topic_id, r.chunk_index] == pytest.approx(want, abs=1e-5)


def test_short_passages_are_verified(spark, tmp_path):
    spark.createDataFrame([(1, "The Kernel  runs tasks in turn."), (2, "Nothing here.")], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, "kernel runs"), (2, " "), (3, None), (4, "the kernel runs tasks in turn.")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = queries.QUERIES["q_verified_source"](spark, str(tmp_path)).collect()
    assert sorted((r.doc_id, r.item_id) for r in got) == [(1, 1), (1, 4)]


@pytest.mark.parametrize("name", ["q_chunk_rows", "q_chunk_overlap_join", "q_noisy_chunks", "q_representative_chunks", "q_fallback_topics", "q_fallback_names", "q_lexical_score", "q_budget_context", "q_literal_context", "q_evidence"])
def test_documents_are_taken_apart_in_one_pass(spark, folder, name):
    plan = queries.QUERIES[name](spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan and "regexp_extract_all" not in plan


WORDS = ["kernel", "The", "Memory", "schedules", "pages", "of", "with", "états", "Été", "Figure 3 shows", "see figure , it", "table 12", "--- ---", "a@b.org", "<br>", "[d-chunk-0001]", "â€™", "dof", "forthcoming", "A. B.", "X.", "high- low", "system", "44 system", "?? =", "\n\n", "\t", "\u00a0", "We", "123 456", "(so).", '"Quoted."', "References"]


def test_one_pass_gives_the_rows_of_the_tables(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(WORDS[:8] if rng.random() < 0.9 else WORDS) + rng.choice(["", "", "", "", ".", ". ", "!", ","]) for _ in range(rng.randint(0, 900))) for _ in range(60)] + ["", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4).cache()
    chunks = chunking.chunk_documents(docs, 600, 80, counted=True).cache()
    found = topics.fallback_topics(chunks).cache()
    scored = retrieval.lexical_scores(chunks, found)
    both = lambda a, b, *c: sorted(map(tuple, a.select(*c).collect())) == sorted(map(tuple, b.select(*c).collect()))
    assert both(whole.lexical_scores(docs, 600, 80, True), scored, "document", "chunk_index", "topic_id", "raw", "score")
    usable = pipeline.scored_chunks(chunks, found).cache()
    assert both(whole.contexts(docs, 600, 80, True, 1500), retrieval.selected_chunks(usable, 1500), "document", "topic_id", "rank", "chunk_id")
    contexts = pipeline.contexts_of(usable, chunks, None, Settings(context_budget=1500))
    want = quality.rank_evidence(pipeline.evidence_rows(contexts, found).where("usable"), 20)
    got = whole.evidence(docs, 600, 80, 1500, 20)
    assert got.count() > 200 and both(got, want, "document", "topic_id", "evidence_id", "evidence_rank", "score")


def test_signs_stand_in_every_trace():
    for trace in ("intentionally omitted", "== picture", "<br", "<b>", "fuctuation", "text cuts off", "[the text", "riskadjusted", "12 memory", "\ufffd", "( dof )", "- = dof", "section )", "figure ,", "fig. :", "shown in figure 3", "a??", "? = x"):
        assert quality.TRACE_PATTERN.search(trace) and plain.traced(trace, quality.TRACE_PATTERN)


def test_spans_meet_the_chunks_that_a_join_gives(spark, folder):
    step, n = queries.SIZE - queries.OVERLAP, queries.docs_of(spark, folder).select("doc_id", chunking.chunk_count(F.col("text"), queries.SIZE, queries.OVERLAP).alias("n")).collect()
    want = [(str(r.doc_id), x, y) for r in n for x in range(r.n) for y in range(r.n) if y * step < x * step + 600 and y * step + queries.SIZE > x * step + 100]
    assert sorted(map(tuple, queries.QUERIES["q_chunk_overlap_join"](spark, folder).collect())) == sorted(want)
