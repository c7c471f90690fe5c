"""Documents, topics, questions and checkpoints from files."""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import clean_markup, repair_encoding
from ..functions.tokens import keywords
from ..store import path_exists

TOPIC = "topic_id string, topic_index int, name string, summary string, keywords array<string>"
ITEM = (
    "id string, question string, answer string, type string, difficulty string, context_source string, context_source_verified boolean, "
    "topic string, topic_id string, topic_keywords array<string>, document string, document_language string, source_chunk_ids array<string>, "
    "created_at string, context_excerpt string, topic_summary string, rejection_reason string"
)


def pdf_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, name, stem, content) of the PDF files directly in a folder, whatever the suffix's case, by path."""
    if not path_exists(spark, folder):
        raise FileNotFoundError(f"no folder {folder}")
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.[pP][dD][fF]").load(folder)
    name = F.element_at(F.split("path", "/"), -1)
    return files.select("path", name.alias("name"), F.regexp_replace(name, "\\.[^.]*$", "").alias("stem"), "content").orderBy("path")


def only_documents(files: DataFrame, wanted: str | None) -> DataFrame:
    """Files whose name or stem is in a comma list, in its order; names that are missing are an error."""
    targets = [t.strip().lower() for t in (wanted or "").split(",") if t.strip()]
    if not targets:
        return files
    asked = files.sparkSession.createDataFrame([(t, i) for i, t in enumerate(dict.fromkeys(targets))], "target string, place int")
    fits = (F.lower("name") == F.col("target")) | (F.lower("stem") == F.col("target"))
    missing = [r["target"] for r in asked.join(files, fits, "left_anti").collect()]
    if missing:
        raise ValueError(f"no such documents: {', '.join(missing)}")
    chosen = files.join(asked, fits).groupBy("path").agg(F.min("place").alias("place"))
    return files.join(chosen, "path").orderBy("place", "path").drop("place")


def extracted(files: DataFrame, extract: Callable[[bytes], str] | None = None) -> DataFrame:
    """(document, document_stem, raw_text); a file that cannot be read gives an empty text.

    ``extract`` turns a file's bytes into text; by default the text as markdown where pymupdf4llm is there and can read the
    file, else the pages that pypdf can read. Wrongly decoded characters are repaired and markup is cleaned away.
    """

    def marked_down(content: bytes) -> str:
        import pymupdf
        import pymupdf4llm

        with pymupdf.open(stream=content, filetype="pdf") as document:
            return pymupdf4llm.to_markdown(document)

    def default(content: bytes) -> str:
        import io

        try:
            return marked_down(content)
        except Exception:  # noqa: BLE001  absent, or a file that it cannot read
            pass
        import pypdf

        pages = []
        for page in pypdf.PdfReader(io.BytesIO(content)).pages:
            try:
                found = page.extract_text() or ""
            except Exception:  # noqa: BLE001  a page may be broken
                continue
            if found.strip():
                pages.append(found)
        return "\n\n".join(pages)

    read = extract or default

    def run(batches: Iterator) -> Iterator:
        for pdf in batches:
            texts = []
            for content in pdf["content"]:
                try:
                    texts.append(read(bytes(content)))
                except Exception:  # noqa: BLE001
                    texts.append("")
            yield pdf.assign(raw_text=texts)[["document", "document_stem", "raw_text"]]

    picked = files.select(F.col("name").alias("document"), F.col("stem").alias("document_stem"), "content")
    rows = picked.mapInPandas(run, "document string, document_stem string, raw_text string")
    return rows.withColumn("raw_text", clean_markup(repair_encoding(F.col("raw_text"))))


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(seq, line) of a small file: stripped lines, without blank ones and those that begin with #."""
    whole = spark.read.text(path, wholetext=True)
    lines = whole.select(F.posexplode(F.split("value", "\r\n|\n|\r")).alias("seq", "line")).withColumn("line", F.trim("line"))
    return lines.where((F.col("line") != "") & ~F.startswith("line", F.lit("#")))


def topics_file(spark: SparkSession, path: str) -> DataFrame:
    """Topics from lines, or from YAML with a list ``topics`` of name, summary and keywords; none is an error."""
    if path.lower().endswith((".yaml", ".yml")):
        import yaml

        content = spark.read.text(path, wholetext=True).first()[0]
        data = yaml.safe_load(content) or {}
        rows = []
        for i, entry in enumerate(data.get("topics", []) if isinstance(data, dict) else []):
            name = str(entry.get("name", "")).strip() if isinstance(entry, dict) else ""
            if name:
                given = entry.get("keywords")
                rows.append((f"user-{i:02d}", i, name, str(entry.get("summary", name)).strip() or name, [str(k) for k in given if k] if isinstance(given, list) else []))
        topics = spark.createDataFrame(rows, TOPIC)
        topics = topics.withColumn("keywords", F.when(F.size("keywords") > 0, F.col("keywords")).otherwise(keywords(F.col("name"), 6)))
    else:
        lines = [r["line"] for r in text_lines(spark, path).orderBy("seq").collect()]
        topics = spark.createDataFrame([(f"user-{i:02d}", i, t, t, []) for i, t in enumerate(lines)], TOPIC).withColumn("keywords", keywords(F.col("name"), 6))
    if topics.isEmpty():
        raise ValueError(f"no topics in {path}")
    return topics


def questions_file(spark: SparkSession, path: str) -> DataFrame:
    """(seq, question) of a file of questions; none is an error."""
    questions = text_lines(spark, path).withColumnRenamed("line", "question")
    if questions.isEmpty():
        raise ValueError(f"no questions in {path}")
    return questions


def checkpoint_items(spark: SparkSession, path: str) -> DataFrame:
    """Items of earlier runs from JSON lines; lines that are no JSON are left out; none where there is no file or an empty one."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], ITEM)
    lines = spark.read.text(path)
    is_object = F.startswith(F.schema_of_variant(F.try_parse_json("value")), F.lit("OBJECT"))
    return lines.where(is_object).select(F.from_json("value", ITEM).alias("x")).select("x.*")


def resume_counts(items: DataFrame, debug: DataFrame | None = None, chunks: DataFrame | None = None) -> DataFrame:
    """(document, chunks, topics) of documents with items: from a debug table (document, chunk_count, topic_count) where it
    counts any, else from ``chunks`` (document) made anew, else from what the items name."""
    seen = items.select("document", F.explode_outer("source_chunk_ids").alias("c")).groupBy("document").agg(F.countDistinct(F.nullif(F.trim("c"), F.lit(""))).alias("seen_chunks"))
    topics = items.groupBy("document").agg(F.countDistinct(F.nullif(F.trim("topic_id"), F.lit(""))).alias("seen_topics"))
    rows, none = seen.join(topics, "document"), F.lit(None).cast("long")
    rows = rows.join(debug.select("document", "chunk_count", "topic_count"), "document", "left") if debug is not None else rows.withColumns({"chunk_count": none, "topic_count": none})
    made = None if chunks is None else chunks.groupBy("document").agg(F.count(F.lit(1)).alias("made"))
    rows = rows.withColumn("made", none) if made is None else rows.join(made, "document", "left")
    positive = lambda c: F.when(F.col(c) > 0, F.col(c))
    return rows.select("document", F.coalesce(positive("chunk_count"), "made", "seen_chunks").alias("chunks"), F.coalesce(positive("topic_count"), "seen_topics").alias("topics"))
