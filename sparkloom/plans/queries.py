"""Queries over the tables of a folder, each with SQL that gives the same rows where SQL can."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import tokens as tk
from ..lexicon import BLOCKED_HEADINGS, LANGUAGES, MISREAD_PAIRS, MISREAD_PATTERN
from ..operators import chunking, dedup, judge, quality, retrieval, splits, topics, whole
from ..operators.topics import SECTION_SUMMARY
from ..store import written
from . import oracle as o
from . import pipeline

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}
SIZE, OVERLAP = 1200, 150
#: Labels whose centroids stand in a plan.
MOST_LABELS = 1000


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f"q_{f.__name__}"] = f
        if sql:
            ORACLE_SQL[f"q_{f.__name__}"] = sql
        return f

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def docs_of(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "documents")


def items_of(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(o.ITEMS, conversations=table(spark, folder, "conversations"), benchmark=table(spark, folder, "benchmark"))


def topics_of(spark: SparkSession, folder: str) -> DataFrame:
    return spark.sql(o.ITEM_TOPICS, benchmark=table(spark, folder, "benchmark"))


def chunks_of(spark: SparkSession, folder: str, counted: bool = False) -> DataFrame:
    return chunking.chunk_documents(docs_of(spark, folder), SIZE, OVERLAP, counted=counted)


CHUNKS = "WITH " + o.chunks_cte(SIZE, OVERLAP)
DEFAULT_CHUNKS = "WITH " + o.chunks_cte(3500, 350)


@query(DEFAULT_CHUNKS + " SELECT document, count(*) AS chunks, sum(length(text))::BIGINT AS chars, min(length(text)) AS shortest, max(length(text)) AS longest FROM chunks GROUP BY document")
def chunk_stats(spark, folder):
    rows = chunking.chunk_documents(docs_of(spark, folder))
    n = F.length("text")
    return rows.groupBy("document").agg(F.count(F.lit(1)).alias("chunks"), F.sum(n).alias("chars"), F.min(n).cast("long").alias("shortest"), F.max(n).cast("long").alias("longest"))


@query(CHUNKS + " SELECT document, format('{}-chunk-{:04d}', document, chunk_index) AS chunk_id, chunk_index, text FROM chunks")
def chunk_rows(spark, folder):
    return chunks_of(spark, folder)


@query(CHUNKS + " SELECT document, count(*) AS chunks FROM chunks WHERE chunk_index < 3 GROUP BY document")
def chunk_cap(spark, folder):
    counted = docs_of(spark, folder).select(F.col("doc_id").cast("string").alias("document"), chunking.chunk_count(F.col("text"), SIZE, OVERLAP, 3).alias("n"))
    return counted.where("n > 0").groupBy("document").agg(F.sum("n").alias("chunks"))


@query(
    CHUNKS
    + ", counted AS (SELECT *, count(*) OVER (PARTITION BY document) AS n FROM chunks), chosen AS (SELECT * FROM counted WHERE n <= 3 OR chunk_index IN (0, 1, n // 2, n - 2, n - 1))"
    + ", shares AS (SELECT *, greatest(1200, 110000 // count(*) OVER (PARTITION BY document)) AS share FROM chosen) SELECT document, chunk_index, least(length(text), share)::INT AS kept FROM shares"
)
def representative_chunks(spark, folder):
    return chunking.representative_chunks(chunks_of(spark, folder, counted=True)).select("document", "chunk_index", F.length("text").alias("kept"))


@query(
    "SELECT count(*) AS documents, sum(chars)::BIGINT AS chars, sum(chunks)::BIGINT AS chunks, count(*) * 8 AS estimated_topics, count(*) * 9 AS estimated_calls, count(*) * 48 AS estimated_items FROM ("
    + DEFAULT_CHUNKS
    + " SELECT doc_id, length(coalesce(text, '')) AS chars, (SELECT count(*) FROM chunks c WHERE c.document = d.doc_id::VARCHAR) AS chunks FROM documents d)"
)
def dry_run_totals(spark, folder):
    return pipeline.dry_run(docs_of(spark, folder))


_SAMPLE = f"lower({o.collapse_space('substr(text, 1, 60000)')})"
_LANGUAGES = (
    f"WITH s AS (SELECT doc_id, lang, {_SAMPLE} AS sample FROM documents), w AS (SELECT *, list_transform(regexp_extract_all(sample, '[a-zÀ-ÿ]{{2,}}'), lambda x: {o.fold('x')}) AS tokens FROM s), "
    + "scores AS (SELECT doc_id, lang, "
    + ", ".join(f"{o.language_score(c, 'sample', 'tokens')}::INT AS {c}" for c, _, _ in LANGUAGES)
    + " FROM w), best AS (SELECT *, CASE WHEN greatest(en, es, ca, fr, pt) <= 0 OR en = greatest(en, es, ca, fr, pt) THEN 'en' WHEN es = greatest(en, es, ca, fr, pt) THEN 'es' WHEN ca = greatest(en, es, ca, fr, pt) THEN 'ca' WHEN fr = greatest(en, es, ca, fr, pt) THEN 'fr' ELSE 'pt' END AS detected FROM scores)"
)


def _languages(spark, folder):
    scores = F.array(F.struct(chunking.language_scores(F.col("text")).alias("scores")))
    rows = docs_of(spark, folder).select("doc_id", "lang", F.inline(scores))  # a generator's columns are not computed again where they are used
    return rows.withColumn("detected", chunking.best_language(F.col("scores")))


@query(_LANGUAGES + " SELECT doc_id, en, es, ca, fr, pt, detected FROM best")
def language_scores(spark, folder):
    return _languages(spark, folder).select("doc_id", *[F.col("scores")[c].alias(c) for c, _, _ in LANGUAGES], "detected")


@query(_LANGUAGES + " SELECT lang, detected, count(*) AS documents FROM best GROUP BY lang, detected")
def language_confusion(spark, folder):
    return _languages(spark, folder).groupBy("lang", "detected").agg(F.count(F.lit(1)).alias("documents"))


@query(
    f"WITH t AS (SELECT doc_id, unnest({o.without(o.found('lower(coalesce(text, chr(32)))', '[A-Za-zÀ-ÿ][A-Za-zÀ-ÿ0-9_-]{3,}'))}) AS w, generate_subscripts({o.without(o.found('lower(coalesce(text, chr(32)))', '[A-Za-zÀ-ÿ][A-Za-zÀ-ÿ0-9_-]{3,}'))}, 1) AS pos FROM documents), "
    "c AS (SELECT doc_id, w, count(*) AS n, min(pos) AS pos FROM t GROUP BY doc_id, w), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, pos) AS place FROM c) "
    "SELECT doc_id, string_agg(w, ',' ORDER BY place) AS keywords FROM r WHERE place <= 8 GROUP BY doc_id"
)
def keywords_topk(spark, folder):
    found = F.array(F.struct(F.array_join(tk.keywords(F.col("text")), ",").alias("keywords")))
    return docs_of(spark, folder).select("doc_id", F.inline(F.filter(found, lambda x: x["keywords"] != "")))


@query(f"SELECT conv_id, turn, {o.signature('text')} AS signature FROM conversations")
def sanitize_text(spark, folder):
    return table(spark, folder, "conversations").select("conv_id", "turn", tx.signature(F.col("text")).alias("signature"))


@query(f"SELECT doc_id, md5({o.collapse_space('text')}) AS digest, length({o.collapse_space('text')}) AS chars FROM documents")
def normalize_whitespace(spark, folder):
    c = tx.collapse_space(F.col("text"))
    return docs_of(spark, folder).select("doc_id", F.md5(c).alias("digest"), F.length(c).cast("long").alias("chars"))


@query(f"SELECT conv_id, turn, {o.fold('text')} AS folded FROM conversations")
def fold_accents(spark, folder):
    return table(spark, folder, "conversations").select("conv_id", "turn", tx.fold(F.col("text")).alias("folded"))


@query(f"SELECT page_id, {o.collapse_space(o.sub('html', ('(?i)<\\s*br\\b\\s*/?\\s*>?', ' '), ('<[^>]+>', ' '), ('(?i)==\\s*picture\\b.*?intentionally omitted\\s*<==', ' '), ('([\\p{L}\\p{N}_])-\\s+([\\p{L}\\p{N}_])', '\\1\\2')))} AS plain FROM pages")
def strip_html(spark, folder):
    return table(spark, folder, "pages").select("page_id", tx.clean_context(F.col("html")).alias("plain"))


@query()
def clean_markup(spark, folder):
    return table(spark, folder, "pages").select("page_id", tx.clean_markup(F.col("html")).alias("plain"))


@query()
def clean_generated(spark, folder):
    return table(spark, folder, "conversations").select("conv_id", "turn", tx.clean_generated(F.col("text")).alias("clean"))


_DAMAGED = "coalesce(text, '') || ' ' || [" + ", ".join(o.quoted(bad) if bad != "\x00" else "chr(0)" for bad, _ in MISREAD_PAIRS) + f"][1 + (coalesce(doc_id, 0) % {len(MISREAD_PAIRS)})::INT] || ' ' || chr(7)"
_REPAIRED = "damaged"
for _bad, _good in MISREAD_PAIRS:
    _REPAIRED = f"replace({_REPAIRED}, {o.quoted(_bad) if _bad != chr(0) else 'chr(0)'}, {o.quoted(_good)})"
_REPAIRED = o.sub(_REPAIRED, ("[\\x01-\\x08\\x0b\\x0c\\x0e-\\x1f\\x7f]", ""))


@query(
    f"WITH d AS (SELECT doc_id, {_DAMAGED} AS damaged FROM documents), r AS (SELECT doc_id, damaged, {_REPAIRED} AS repaired FROM d) "
    f"SELECT doc_id, regexp_matches(damaged, '{MISREAD_PATTERN}') AS misread, regexp_matches(repaired, '{MISREAD_PATTERN}') AS after, md5(repaired) AS digest FROM r"
)
def misread_text(spark, folder):
    """Every text with one wrongly decoded character and a control character behind it, before and after repair."""
    traces = F.array(*[F.lit(bad) for bad, _ in MISREAD_PAIRS])
    trace = F.get(traces, (F.coalesce("doc_id", F.lit(0)) % len(MISREAD_PAIRS)).cast("int"))
    damaged = F.concat(F.coalesce("text", F.lit("")), F.lit(" "), trace, F.lit(" \x07"))
    rows = docs_of(spark, folder).select("doc_id", damaged.alias("damaged"))
    repaired = tx.repair_encoding(F.col("damaged"))
    return rows.select("doc_id", F.col("damaged").rlike(MISREAD_PATTERN).alias("misread"), repaired.rlike(MISREAD_PATTERN).alias("after"), F.md5(repaired).alias("digest"))


_CUT = "(CASE WHEN strpos(reverse(substr(text, 1, 400)), ' .') > 0 THEN 400 - strpos(reverse(substr(text, 1, 400)), ' .') - 1 ELSE -1 END)"
_LF = "(CASE WHEN strpos(reverse(substr(text, 1, 400)), chr(10)) > 0 THEN 400 - strpos(reverse(substr(text, 1, 400)), chr(10)) ELSE -1 END)"


@query(f"SELECT doc_id, CASE WHEN length(text) <= 400 THEN text WHEN greatest({_CUT}, {_LF}) > 240 THEN substr(text, 1, greatest({_CUT}, {_LF}) + 1) ELSE substr(text, 1, 400) END AS shortened FROM documents")
def truncate(spark, folder):
    return docs_of(spark, folder).select("doc_id", tx.truncate(F.col("text"), 400).alias("shortened"))


@query(f"SELECT conv_id, turn, list_sort(list_distinct({o.content_words('text')})) AS content, list_sort({o.terms('text')}) AS terms, list_sort({o.pairs(o.answer_tokens('text'))}) AS pairs FROM conversations")
def token_sets(spark, folder):
    c = F.col("text")
    return table(spark, folder, "conversations").select("conv_id", "turn", F.array_sort(tk.content_terms(c)).alias("content"), F.array_sort(tk.terms(c)).alias("terms"), F.array_sort(tk.answer_pairs(c)).alias("pairs"))


_HEADINGS = f"""
WITH lines AS (SELECT doc_id, list_transform(regexp_split_to_array(coalesce(text, ''), '\\r\\n|[\\n\\r\\x0b\\x0c\\x1c-\\x1e\\x{{85}}\\x{{2028}}\\x{{2029}}]'), lambda x: replace({o.collapse_space("x")}, 'Histor y', 'History')) AS ls FROM documents),
words AS (SELECT doc_id, list_transform(ls, lambda x: {{'h': x, 'w': regexp_split_to_array(x, '\\s+')}}) AS ws FROM lines),
kept AS (SELECT doc_id, list_transform(list_filter(ws, lambda x: length(x.h) BETWEEN 3 AND 80 AND NOT regexp_matches(x.h, 'https?://|ISBN|\\[\\d+\\]|\\d{{4}}|@') AND NOT regexp_matches(x.h, '^\\d[A-Za-z]')
  AND len(x.w) <= 8 AND regexp_matches(x.h, '[A-Za-z]') AND NOT regexp_matches(x.h, '[.,]$') AND NOT regexp_matches(x.h, '(?i)\\b(?:University|Department|Institute|Laboratory|College|School)\\b')
  AND len(list_filter(x.w, lambda w: regexp_matches(w, '^\\p{{Ll}}') AND lower(w) NOT IN ('and', 'or', 'of', 'in', 'for', 'to', 'the'))) <= greatest(1, len(x.w) // 2)), lambda x: x.h) AS hs FROM words),
headings AS (SELECT doc_id, list_filter(hs, lambda h, i: list_position(list_transform(hs, lambda y: lower(y)), lower(h)) = i) AS hs FROM kept)"""


@query(_HEADINGS + " SELECT doc_id, unnest(hs) AS heading FROM headings")
def headings(spark, folder):
    return docs_of(spark, folder).select("doc_id", F.explode(topics.headings(F.col("text"))).alias("heading"))


@query(
    _HEADINGS
    + f", useful AS (SELECT doc_id::VARCHAR AS document, list_filter(hs, lambda h: NOT list_contains({o.listed(BLOCKED_HEADINGS)}, lower(h)) AND NOT starts_with(lower(h), 'list of ')) AS hs FROM headings)"
    + ", spread AS (SELECT document, CASE WHEN len(hs) <= 8 THEN hs ELSE list_transform(range(0, 8), lambda i: hs[(i * len(hs) // 8) + 1]) END AS hs FROM useful)"
    + ", placed AS (SELECT document, unnest(hs) AS name, (generate_subscripts(hs, 1) - 1)::INT AS topic_index FROM spread)"
    + f" SELECT document, format('topic-{{:02d}}', topic_index) AS topic_id, topic_index, name, '{SECTION_SUMMARY[0].replace(chr(39), chr(39) * 2)}' || name || '{SECTION_SUMMARY[1].replace(chr(39), chr(39) * 2)}' AS summary, {o.keywords('name')} AS keywords FROM placed"
)
def section_topics(spark, folder):
    return topics.section_topics(docs_of(spark, folder))


@query(f"SELECT p_partkey, {o.valid_name('p_name')} AS valid FROM part")
def valid_topic_name(spark, folder):
    return table(spark, folder, "part").select("p_partkey", topics.valid_name(F.col("p_name")).alias("valid"))


@query(
    "SELECT p_brand AS document, count(*) AS topics, count(*) FILTER (regexp_matches(lower(p_name), 'concept|theory|references|literature')) AS general, "
    f"count(*) FILTER (NOT {o.valid_name('p_name')}) AS invalid, count(*) FILTER (regexp_matches(lower(p_name), 'concept|theory|references|literature')) >= greatest(2, count(*) // 2) AS too_general, "
    f"count(*) FILTER (NOT {o.valid_name('p_name')}) >= greatest(2, count(*) // 2) AS mostly_invalid FROM part GROUP BY p_brand"
)
def generic_topics(spark, folder):
    return topics.topic_map_quality(table(spark, folder, "part").select(F.col("p_brand").alias("document"), F.col("p_name").alias("name")))


_FALLBACK = (
    CHUNKS
    + ", counted AS (SELECT *, count(*) OVER (PARTITION BY document) AS n FROM chunks), stepped AS (SELECT *, greatest(1, n // greatest(1, least(8, n))) AS step, greatest(1, least(8, n)) AS want FROM counted)"
    + ", picked AS (SELECT document, (chunk_index // step)::INT AS topic_index, text FROM stepped WHERE chunk_index % step = 0 AND chunk_index // step < want)"
)


@query(_FALLBACK + " SELECT document, format('topic-{:02d}', topic_index) AS topic_id, topic_index, array_to_string(" + o.keywords("text") + ", ',') AS keywords FROM picked")
def fallback_topics(spark, folder):
    rows = topics.fallback_topics(chunks_of(spark, folder, counted=True))
    return rows.select("document", "topic_id", "topic_index", F.array_join("keywords", ",").alias("keywords"))


@query()
def fallback_names(spark, folder):
    return topics.fallback_topics(chunks_of(spark, folder, counted=True)).select("document", "topic_id", "name", "summary")


@query(CHUNKS + f" SELECT document, chunk_index, {o.noisy('text')} AS noisy FROM chunks")
def noisy_chunks(spark, folder):
    return chunks_of(spark, folder).select("document", "chunk_index", retrieval.noisy(F.col("text")).alias("noisy"))


#: All topics of every document, named by their keywords, which SQL can say.
_OWN = _FALLBACK + ", topics AS (SELECT document, format('topic-{:02d}', topic_index) AS topic_id, topic_index, " + o.keywords("text") + " AS keywords FROM picked)"
_RAW = _OWN + ", scored AS (SELECT c.document, c.chunk_index, c.text, t.topic_id, array_to_string(t.keywords, ' ') AS name, " + o.mentions("lower(c.text) || ' ' || lower(c.document)", "list_concat([array_to_string(t.keywords, ' '), ''], t.keywords)") + " AS raw FROM chunks c JOIN topics t ON c.document = t.document)"
_SCORED = _RAW + (
    ", sibling AS (SELECT a.document, a.chunk_index, a.topic_id, max(b.raw) AS best FROM scored a LEFT JOIN scored b ON a.document = b.document AND a.chunk_index = b.chunk_index AND a.topic_id <> b.topic_id GROUP BY ALL)"
    ", final AS (SELECT s.*, CASE WHEN best IS NULL THEN raw ELSE greatest(0, round_even(raw - 0.35::DOUBLE * best, 0)) END::DOUBLE AS score FROM scored s JOIN sibling USING (document, chunk_index, topic_id))"
)


def whole_topics(spark, folder):
    """Up to eight topics for every document, with names, summaries and eight keywords."""
    return topics.fallback_topics(chunks_of(spark, folder, counted=True))


@query(_SCORED + " SELECT document, chunk_index, topic_id, raw, score FROM final")
def lexical_score(spark, folder):
    return whole.lexical_scores(docs_of(spark, folder), SIZE, OVERLAP, False).select("document", "chunk_index", "topic_id", "raw", "score")


@query(
    _SCORED
    + ", ranked AS (SELECT document, topic_id, chunk_index, score, length(document) + 11 + length(text) + 3 AS block, max(score) OVER (PARTITION BY document, topic_id) AS best FROM final)"
    + ", running AS (SELECT *, row_number() OVER w AS rank, sum(block) OVER w AS upto FROM ranked WHERE score > 0 OR best <= 0 WINDOW w AS (PARTITION BY document, topic_id ORDER BY score DESC, chunk_index ROWS UNBOUNDED PRECEDING))"
    + " SELECT document, topic_id, rank::INT AS rank, chunk_index FROM running WHERE upto <= 6000"
)
def budget_context(spark, folder):
    return whole.contexts(docs_of(spark, folder), SIZE, OVERLAP, False, 6000).select("document", "topic_id", "rank", "chunk_index")


@query()
def literal_context(spark, folder):
    return whole.contexts(docs_of(spark, folder), SIZE, OVERLAP, True).select("document", "topic_id", "rank", "chunk_id")


_CENTRES = "centres AS (SELECT label, list(m ORDER BY i) AS centre FROM (SELECT label, i, avg(v::DOUBLE) AS m FROM (SELECT label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM embeddings) GROUP BY label, i) GROUP BY label)"


def centres_of(spark, folder):
    rows = table(spark, folder, "embeddings").select("label", F.posexplode("embedding").alias("i", "v"))
    means = rows.groupBy("label", "i").agg(F.avg(F.col("v").cast("double")).alias("m"))
    return means.groupBy("label").agg(F.transform(F.array_sort(F.collect_list(F.struct("i", "m"))), lambda s: s["m"]).alias("centre"))  # one entry per dimension


@query("WITH " + _CENTRES + " SELECT e.vec_id, c.label AS topic, round(list_cosine_similarity(e.embedding::DOUBLE[], c.centre), 6) AS similarity FROM embeddings e, centres c")
def cosine_to_topic(spark, folder):
    """Every vector with the centroid of every label: a label is one row, and the few of them are one literal of the plan."""
    centres = centres_of(spark, folder).orderBy("label").limit(MOST_LABELS + 1).collect()
    if len(centres) > MOST_LABELS:
        raise ValueError(f"more than {MOST_LABELS} labels")
    each = F.array(*[F.struct(F.lit(r["label"]).alias("topic"), F.array(*map(F.lit, r["centre"])).alias("centre")) for r in centres])
    rows = table(spark, folder, "embeddings").select("vec_id", "embedding", F.inline(each))
    return rows.select("vec_id", "topic", F.round(tk.cosine(F.col("embedding"), F.col("centre")), 6).alias("similarity"))


@query()
def hybrid_score(spark, folder):
    """Lexical scores where a document has no vector; a topic's vector is the centroid of the label of its place."""
    vectors = table(spark, folder, "embeddings").select(F.col("vec_id").cast("string").alias("document"), F.col("embedding").alias("chunk_vector"))
    place = F.row_number().over(Window.orderBy("label")) - 1  # a few labels
    centres = centres_of(spark, folder).select(place.alias("topic_index"), F.col("centre").alias("of_place"))
    scored = whole.lexical_scores(docs_of(spark, folder), SIZE, OVERLAP, True)
    scored = scored.join(vectors, "document", "left").join(F.broadcast(centres), "topic_index", "left")
    scored = scored.withColumn("topic_vector", F.when(F.col("chunk_vector").isNotNull(), F.col("of_place")))
    return retrieval.semantic_scores(scored, hybrid=True).select("document", "topic_id", "chunk_index", F.round("score", 6).alias("score"))


_SENTENCES = f"WITH flat AS (SELECT conv_id, turn, replace({o.collapse_space('text')}, chr(10), ' ') AS t FROM conversations), parts AS (SELECT conv_id, turn, list_filter(list_transform(string_split(regexp_replace(t, '([.!?])\\s+([\"''(\\[]?[A-Z0-9])', '\\1' || chr(1) || '\\2', 'g'), chr(1)), lambda x: trim(x)), lambda x: regexp_matches(x, '[.!?)]$')) AS p FROM flat)"


@query(_SENTENCES + " SELECT conv_id, turn, unnest(p) AS sentence, (generate_subscripts(p, 1) - 1)::INT AS place FROM parts")
def sentences(spark, folder):
    return table(spark, folder, "conversations").select("conv_id", "turn", F.posexplode(tk.sentences(F.col("text"))).alias("place", "sentence"))


@query()
def evidence(spark, folder):
    return whole.evidence(docs_of(spark, folder), SIZE, OVERLAP)


@query("SELECT d.doc_id, b.item_id FROM documents d JOIN benchmark b ON contains(lower(" + o.collapse_space("d.text") + "), lower(" + o.collapse_space("b.text") + ")) WHERE " + o.collapse_space("b.text") + " <> ''")
def verified_source(spark, folder):
    """Passages meet texts on a hash of four words in a row, or of one word where they have fewer, and only then as a whole."""
    text = F.lower(tx.collapse_space(F.col("text")))
    runs = lambda c: F.filter(F.split(c, "[^\\p{L}\\p{N}]+"), lambda w: w != "")
    passages = table(spark, folder, "benchmark").select("item_id", text.alias("passage")).where("passage <> ''")
    passages = written(passages.select("item_id", "passage", runs(F.col("passage")).alias("w")), "passages")
    whole = F.slice("w", F.lit(2), F.greatest(F.size("w") - 2, F.lit(0)))  # the first and the last word may stand within others
    grams = passages.select("item_id", F.when(F.size("w") >= 6, F.xxhash64(F.array_join(F.slice(whole, 1, 4), " "))).when(F.size("w") >= 3, F.xxhash64(F.array_max(F.transform(whole, lambda x: F.struct(F.length(x).alias("n"), x.alias("x"))))["x"])).alias("key"))

    def keys(words):
        n = F.size(words)
        four = F.transform(F.sequence(F.lit(1), F.greatest(n - 3, F.lit(1))), lambda i: F.xxhash64(F.array_join(F.slice(words, i, 4), " ")))
        return F.array_distinct(F.concat(F.when(n >= 4, four).otherwise(F.array().cast("array<bigint>")), F.transform(words, lambda x: F.xxhash64(x))))

    docs = docs_of(spark, folder)
    near = docs.select("doc_id", F.explode(tk.let(runs(text), keys)).alias("key")).join(grams.where("key IS NOT NULL"), "key").select("doc_id", "item_id").distinct()
    hits = docs.select("doc_id", text.alias("body")).join(near, "doc_id").join(passages.select("item_id", "passage"), "item_id").where(F.contains("body", "passage"))
    few = docs.select("doc_id", text.alias("body")).join(passages.where(F.size("w") < 3).select("item_id", "passage"), F.contains("body", "passage"))
    return hits.select("doc_id", "item_id").unionByName(few.select("doc_id", "item_id")).distinct()


@query(CHUNKS + f", spans AS (SELECT document, chunk_index, chunk_index * {SIZE - OVERLAP} AS a, chunk_index * {SIZE - OVERLAP} + {SIZE} AS b FROM chunks) SELECT x.document, x.chunk_index AS fragment, y.chunk_index FROM spans x JOIN spans y ON x.document = y.document AND y.a < x.a + 600 AND y.b > x.a + 100")
def chunk_overlap_join(spark, folder):
    """Chunks begin at even steps, so those that a span meets are a range of places, and no chunk meets another by a join."""
    step, n = SIZE - OVERLAP, chunking.chunk_count(F.col("text"), SIZE, OVERLAP)
    counted = docs_of(spark, folder).where("doc_id IS NOT NULL").select(F.col("doc_id").cast("string").alias("document"), n.alias("n")).where("n > 0")
    rows = counted.select("document", "n", F.explode(F.sequence(F.lit(0), F.col("n") - 1)).alias("fragment"))
    first = F.greatest(F.lit(0).cast("long"), F.floor((F.col("fragment") * step + 100 - SIZE) / step) + 1)
    last = F.least(F.col("n") - 1, F.ceil((F.col("fragment") * step + 600) / step) - 1)
    return rows.select("document", "fragment", F.explode(F.sequence(first.cast("int"), last.cast("int"))).alias("chunk_index"))


def _rule(name: str):
    def run(spark, folder):
        rows = quality.complete(items_of(spark, folder))
        return rows.select("id", quality.rule_columns()[name].alias("holds"))

    run.__name__ = f"rule_{name}"
    return query("WITH " + o.ITEMS_CTE + f" SELECT id, {o.rules()[name]} AS holds FROM items")(run)


for _name in quality.REASONS:
    _rule(_name)

_GATED = "WITH " + o.ITEMS_CTE + f", gated AS (SELECT *, {o.first_reason()} AS rejection_reason FROM items)"


def gated_items(spark, folder, gate="strict"):
    return quality.quality_gate(items_of(spark, folder), gate)


@query(_GATED + " SELECT id, rejection_reason FROM gated")
def quality_gate(spark, folder):
    return gated_items(spark, folder).select("id", "rejection_reason")


@query(_GATED + " SELECT rejection_reason, count(*) AS items FROM gated GROUP BY rejection_reason")
def gate_reasons(spark, folder):
    return gated_items(spark, folder).groupBy("rejection_reason").agg(F.count(F.lit(1)).alias("items"))


@query(
    _GATED
    + " SELECT count(*) FILTER (rejection_reason IS NULL) AS accepted_items, count(*) FILTER (rejection_reason IS NOT NULL) AS rejected_items, count(*) FILTER (rejection_reason IS NULL AND context_source_verified) AS verified_items, "
    "CASE WHEN count(*) FILTER (rejection_reason IS NULL) > 0 THEN round_even(count(*) FILTER (rejection_reason IS NULL AND context_source_verified) / count(*) FILTER (rejection_reason IS NULL), 4) ELSE 0.0 END AS verified_ratio FROM gated"
)
def verified_ratio(spark, folder):
    return quality.gate_counts(gated_items(spark, folder))


_ALIGNED = (
    "WITH " + o.ITEMS_CTE + ", " + o.TOPICS_CTE + ", body AS (SELECT *, coalesce(question, '') || ' ' || coalesce(answer, '') || ' ' || coalesce(context_source, '') AS b, lower(coalesce(question, '') || ' ' || coalesce(answer, '')) AS qa FROM items)"
    ", pairs AS (SELECT i.id, i.topic_id, t.topic_id AS to_id, t.topic_index, "
    f"{o.alignment('t.name', 't.summary', 'array_to_string(t.keywords, chr(32))')} AS own, {o.terms('i.b')} AS it, list_filter(list_distinct(t.keywords), lambda k: contains(lower(i.b), lower(k))) AS kw, length(t.name) >= 5 AND contains(i.qa, lower(t.name)) AS named FROM body i JOIN topics t ON i.document = t.document)"
    ", scores AS (SELECT id, topic_id, to_id, topic_index, CASE WHEN len(own) > 0 AND len(it) > 0 THEN len(list_intersect(own, it)) + 0.5 * len(kw) + CASE WHEN named THEN 1 ELSE 0 END ELSE 0 END::DOUBLE AS score FROM pairs)"
)


@query(_ALIGNED + " SELECT id, to_id, score FROM scores")
def topic_alignment(spark, folder):
    return quality.item_topic_scores(quality.complete(items_of(spark, folder)), topics_of(spark, folder)).select("id", "to_id", "score")


_MOVED = _ALIGNED + (
    ", best AS (SELECT id, any_value(topic_id) AS topic_id, arg_max(to_id, score * 1000 - topic_index) AS to_id, max(score) AS best, max(score) FILTER (to_id = topic_id) AS now FROM scores GROUP BY id)"
    ", moved AS (SELECT i.id, CASE WHEN best IS NULL THEN 'kept' WHEN best < 1 THEN 'topic_mismatch_reassign' WHEN (now IS NOT NULL AND best - now < 1.5) OR to_id = i.topic_id THEN 'kept' ELSE 'reassigned' END AS action, to_id, i.topic_id FROM items i LEFT JOIN best b ON i.id = b.id)"
)


@query(_MOVED + " SELECT id, action, CASE WHEN action = 'reassigned' THEN to_id ELSE topic_id END AS topic_id FROM moved")
def reassign(spark, folder):
    return quality.reassign_topics(items_of(spark, folder), topics_of(spark, folder)).select("id", "action", "topic_id")


@query(_MOVED + " SELECT action, count(*) AS items FROM moved GROUP BY action")
def reassign_stats(spark, folder):
    return quality.reassign_topics(items_of(spark, folder), topics_of(spark, folder)).groupBy("action").agg(F.count(F.lit(1)).alias("items"))


@query(f"WITH k AS (SELECT doc_id, {o.signature('text')} AS s FROM documents) SELECT doc_id, s = '' OR row_number() OVER (PARTITION BY s ORDER BY doc_id) > 1 AS duplicate FROM k")
def dedup_exact(spark, folder):
    rows = docs_of(spark, folder).withColumn("seq", F.col("doc_id"))
    return dedup.exact_duplicates(rows.select("doc_id", "seq", "text"), F.col("text")).select("doc_id", "duplicate")


_SETS = "WITH " + o.ITEMS_CTE + f", sets AS (SELECT seq, {o.pairs(o.question_tokens('question'))} AS qp, list_distinct({o.content_words('question')}) AS qt, list_distinct({o.content_words('answer')}) AS at, list_distinct({o.content_words('question || chr(32) || answer')}) AS qa, {o.signature('question')} AS qs, {o.signature('answer')} AS asig FROM items)"


def _near(a: str, least: float) -> str:
    return f"(len(x.{a}) > 0 AND len(y.{a}) > 0 AND len(list_intersect(x.{a}, y.{a})) / least(len(x.{a}), len(y.{a})) >= {least})"


@query(_SETS + f" SELECT x.seq AS earlier, y.seq AS later FROM sets x JOIN sets y ON x.seq < y.seq WHERE {_near('at', 0.78)}")
def dedup_pairs(spark, folder):
    return dedup.similar_pairs(dedup.with_sets(items_of(spark, folder)), "answer_terms", 0.78).select("earlier", "later")


_LINKS = _SETS + (
    ", links AS (SELECT x.seq AS earlier, y.seq AS later, CASE WHEN x.qs = y.qs AND x.qs <> '' THEN 1 WHEN x.asig = y.asig AND length(x.asig) >= 12 THEN 2 "
    f"WHEN {_near('qp', 0.78)} THEN 3 WHEN {_near('qt', 0.75)} THEN 4 WHEN {_near('qa', 0.8)} THEN 5 WHEN {_near('at', 0.78)} THEN 6 END AS place FROM sets x JOIN sets y ON x.seq < y.seq)"
)


@query(_LINKS + " SELECT earlier, later, place FROM links WHERE place IS NOT NULL")
def dedup_links(spark, folder):
    return dedup.duplicate_links(items_of(spark, folder)).select("earlier", "later", "place")


@query()
def dedup_kept(spark, folder):
    return dedup.deduplicate_items(items_of(spark, folder)).select("id", "seq", "duplicate_reason")


@query("WITH " + o.ITEMS_CTE + " SELECT CASE WHEN s = 'train' THEN (SELECT count(*) FROM items) - greatest(0, (SELECT count(*) FROM items) - floor((SELECT count(*) FROM items) * 0.8)::BIGINT) WHEN s = 'val' THEN floor((SELECT count(*) FROM items) * 0.1)::BIGINT ELSE (SELECT count(*) FROM items) - floor((SELECT count(*) FROM items) * 0.8)::BIGINT - floor((SELECT count(*) FROM items) * 0.1)::BIGINT END AS items, s AS split FROM (VALUES ('train'), ('val'), ('test')) v(s)")
def split_sizes(spark, folder):
    return splits.split_rows(items_of(spark, folder)).groupBy("split").agg(F.count(F.lit(1)).alias("items"))


_H = "md5('{}:' || {})".format
_SPLIT = "WITH " + o.ITEMS_CTE + f"""
, n AS (SELECT count(*) AS n, floor(count(*) * 0.8)::BIGINT AS tr, floor(count(*) * 0.1)::BIGINT AS nv, count(*) - floor(count(*) * 0.8)::BIGINT - floor(count(*) * 0.1)::BIGINT AS nt FROM items)
, per AS (SELECT topic_id, count(*) AS c, arg_min(id, {_H(42, "id")}) AS a, arg_min(id, {_H(44, "id")}) AS b, arg_max(id, {_H(44, "id")}) AS z FROM items GROUP BY topic_id)
, vals AS (SELECT topic_id, a FROM (SELECT topic_id, a, row_number() OVER (ORDER BY {_H(42, "topic_id")}, topic_id) AS p FROM per WHERE c >= 3), n WHERE p <= nv)
, tests AS (SELECT CASE WHEN took AND a = b THEN z ELSE b END AS id FROM (SELECT per.*, v.topic_id IS NOT NULL AS took, row_number() OVER (ORDER BY {_H(42, "per.topic_id")}, per.topic_id) AS p
  FROM per LEFT JOIN vals v USING (topic_id) WHERE c - CASE WHEN v.topic_id IS NULL THEN 0 ELSE 1 END >= 2), n WHERE p <= nt)
, firsts AS (SELECT a AS id, 'val' AS split FROM vals UNION ALL SELECT id, 'test' FROM tests)
, rest AS (SELECT id, row_number() OVER (ORDER BY {_H(43, "id")}, id) - 1 AS p FROM items WHERE id NOT IN (SELECT id FROM firsts))
, more AS (SELECT nv - (SELECT count(*) FROM firsts WHERE split = 'val') AS mv, nt - (SELECT count(*) FROM firsts WHERE split = 'test') AS mt FROM n)
, placed AS (SELECT id, split FROM firsts UNION ALL SELECT id, CASE WHEN p < mv THEN 'val' WHEN p < mv + mt THEN 'test' ELSE 'train' END FROM rest, more)"""


@query(_SPLIT + " SELECT i.id, i.topic_id, p.split FROM items i JOIN placed p ON i.id = p.id")
def split_members(spark, folder):
    return splits.split_rows(items_of(spark, folder)).select("id", "topic_id", "split")


_AUDIT = _GATED + ", " + o.TOPICS_CTE + ", counted AS (SELECT document, topic_id, count(*) FILTER (rejection_reason IS NULL) AS accepted, count(*) FILTER (rejection_reason IS NOT NULL) AS rejected FROM gated GROUP BY document, topic_id), audit AS (SELECT document, topic_id, coalesce(accepted, 0) AS accepted, coalesce(rejected, 0) AS rejected FROM counted FULL JOIN (SELECT DISTINCT document, topic_id FROM topics) USING (document, topic_id))"


def audit_of(spark, folder):
    return splits.topic_audit(gated_items(spark, folder), topics_of(spark, folder))


@query(_AUDIT + " SELECT * FROM audit")
def audit_topics(spark, folder):
    return audit_of(spark, folder)


@query(
    _AUDIT + " SELECT count(*) AS topics, count(*) FILTER (accepted = 0) AS empty_topics, count(*) FILTER (accepted = 1) AS low_topics, sum(accepted)::BIGINT AS accepted_rows, round_even(count(*) FILTER (accepted > 0) / count(*), 4) AS coverage_ratio, count(*) > 0 AND count(*) FILTER (accepted = 0) <= greatest(1, count(*) // 5) AS pipeline_success FROM audit"
)
def coverage(spark, folder):
    return splits.coverage(audit_of(spark, folder))


@query(_AUDIT + " SELECT document, topic_id, accepted, 6 - accepted AS missing FROM audit WHERE accepted < 6 AND (document, topic_id) IN (SELECT (document, topic_id) FROM topics)")
def backfill_deficit(spark, folder):
    return splits.deficits(gated_items(spark, folder).where("rejection_reason IS NULL"), topics_of(spark, folder))


@query(
    "WITH " + o.ITEMS_CTE + f", asked AS (SELECT concat('conv-', conv_id % 10) AS document, {o.signature('text')} AS s, conv_id * 100 + turn AS seq FROM conversations WHERE role = 'user')"
    + f" SELECT i.id FROM items i WHERE NOT EXISTS (SELECT 1 FROM asked a WHERE a.document = i.document AND a.s = {o.signature('i.question')} AND a.seq < i.seq)"
)
def anti_existing(spark, folder):
    """Items whose question has not been asked before in their document, by any user's turn of the whole table."""
    items = items_of(spark, folder).withColumn("s", tx.signature(F.col("question")))
    turns = table(spark, folder, "conversations").where("role = 'user'")
    asked = turns.select(F.concat(F.lit("conv-"), F.col("conv_id") % 10).alias("d"), tx.signature(F.col("text")).alias("k"), (F.col("conv_id") * 100 + F.col("turn")).alias("at"))
    first = asked.groupBy("d", "k").agg(F.min("at").alias("first"))
    return items.join(first, (F.col("document") == F.col("d")) & (F.col("s") == F.col("k")) & (F.col("first") < F.col("seq")), "left_anti").select("id")


_A, _C = o.answer_tokens("answer"), o.answer_tokens("context_source")
_PRE = f"CASE WHEN regexp_matches(context_source || ' ' || answer, '{MISREAD_PATTERN}') OR regexp_matches(context_source, {o.quoted(o.MARKER)}) THEN 'extraction_artifact' WHEN len({_A}) >= 6 AND len({_C}) >= 8 AND {o.covered('answer', 'context_source')} >= 0.7 THEN 'overly_extractive' END"


@query("WITH " + o.ITEMS_CTE + f" SELECT id, {_PRE} AS reason FROM items")
def judge_prechecks(spark, folder):
    return items_of(spark, folder).select("id", judge.precheck(F.col("answer"), F.col("context_source"))["reasons"][0].alias("reason"))


def judged_items(spark, folder):
    n = F.col("seq") % 11 / F.lit(10.0)
    reply = F.format_string('{"context_quality": %s, "answer_support": "%s", "question_quality": 0.9, "overall_score": %s, "reasons": ["%s"]}', n.cast("string"), n.cast("string"), n.cast("string"), F.when(F.col("seq") % 7 == 0, "The answer is not supported").otherwise("factual"))
    return judge.judge_items(items_of(spark, folder), reply)


_JUDGED = "WITH " + o.ITEMS_CTE + f", p AS (SELECT id, seq, {_PRE} AS pre, (seq % 11) / 10.0 AS n, seq % 7 = 0 AS bad FROM items)" + (
    ", j AS (SELECT id, CASE pre WHEN 'extraction_artifact' THEN 0.1 WHEN 'overly_extractive' THEN 0.35 ELSE CASE WHEN bad AND n >= 0.45 THEN least(n, 0.35) WHEN n < 0.6 THEN least(n, 0.39) WHEN n < 0.8 THEN least(n, 0.79) ELSE n END END::DOUBLE AS judge_score, "
    "CASE WHEN pre IS NOT NULL THEN 'fail' WHEN bad AND (n >= 0.45 OR n = 0) THEN 'fail' WHEN n < 0.6 THEN 'fail' WHEN n < 0.8 THEN 'review' ELSE 'pass' END AS judge_decision, "
    "CASE WHEN pre IS NOT NULL THEN pre WHEN bad THEN 'unsupported_detail' ELSE 'factual' END AS reason FROM p)"
)


@query(_JUDGED + " SELECT id, judge_score, judge_decision, reason FROM j")
def judge_normalize(spark, folder):
    return judged_items(spark, folder).select("id", "judge_score", "judge_decision", F.col("judge_reasons")[0].alias("reason"))


@query(_JUDGED + " SELECT count(*) AS judged_items, count(*) FILTER (judge_decision = 'pass') AS pass_items, count(*) FILTER (judge_decision = 'review') AS review_items, count(*) FILTER (judge_decision = 'fail') AS fail_items, round_even(avg(judge_score), 4) AS average_score FROM j")
def judge_stats(spark, folder):
    return judge.judge_stats(judged_items(spark, folder)).select("judged_items", "pass_items", "review_items", "fail_items", "average_score")


@query(_JUDGED + " SELECT reason, count(*) AS items FROM j GROUP BY reason")
def judge_reasons(spark, folder):
    return judge.reason_counts(judged_items(spark, folder))


@query(_JUDGED + " SELECT id, CASE WHEN judge_decision <> 'pass' THEN 'judge_fail:' || CASE WHEN reason = 'factual' THEN judge_decision ELSE reason END END AS rejection_reason FROM j")
def judge_filter(spark, folder):
    return judge.judge_filter(judged_items(spark, folder)).select("id", "rejection_reason")
