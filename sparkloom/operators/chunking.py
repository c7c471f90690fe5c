"""Documents to chunks, windows of sentences, and languages."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import plain
from ..functions.text import collapse_space, text, truncate
from ..functions.tokens import found, is_in, let
from ..lexicon import LANGUAGES, folded_letters


def chunk_count(raw: Column, size: int = 3500, overlap: int = 350, most: int | None = None) -> Column:
    """How many chunks a text has."""
    return plain.applied(lambda s: len(plain.chunks(s, size, overlap, most)), "int", pa.int32(), raw.cast("string"))


def chunk_documents(docs: DataFrame, size: int = 3500, overlap: int = 350, most: int | None = None, document: str = "doc_id", raw: str = "text", counted: bool = False, stem: str | None = None) -> DataFrame:
    """(document, chunk_id, chunk_index, text); chunk_id is ``{stem}-chunk-{0000}``, by default of the document. One pass, no shuffle.

    Chunks are windows of ``size`` characters every ``size - overlap`` (see ``plain.chunks``). With ``counted`` also
    chunk_count, the document's chunks, so that nobody has to count them by a shuffle.
    """

    def each(whole: str | None) -> list[dict]:
        found = plain.chunks(whole, size, overlap, most)
        return [{"text": c, "n": len(found)} for c in found]

    kind = pa.list_(pa.struct([("text", pa.string()), ("n", pa.int32())]))
    chunks = plain.applied(each, "array<struct<text:string,n:int>>", kind, F.col(raw).cast("string"))
    rows = docs.select(F.col(document).cast("string").alias("document"), F.col(stem or document).cast("string").alias("stem"), F.posexplode(chunks).alias("chunk_index", "chunk"))
    columns = ["document", F.format_string("%s-chunk-%04d", "stem", "chunk_index").alias("chunk_id"), "chunk_index", F.col("chunk.text").alias("text")]
    return rows.select(*columns, F.col("chunk.n").alias("chunk_count")) if counted else rows.select(*columns)


def representative_chunks(chunks: DataFrame, budget: int = 110_000) -> DataFrame:
    """The first two, the middle and the last two chunks of each document (all of up to three), each cut to its share.

    A document of n chunks keeps n of them and 5 at most. One pass where the chunks come with chunk_count; else they are counted by a shuffle.
    """
    counted = chunks.withColumn("n", F.col("chunk_count") if "chunk_count" in chunks.columns else F.count(F.lit(1)).over(Window.partitionBy("document")))
    middle = F.floor(F.col("n") / 2)
    chosen = counted.where((F.col("n") <= 3) | F.col("chunk_index").isin(0, 1) | (F.col("chunk_index") == middle) | (F.col("chunk_index") >= F.col("n") - 2))
    share = F.greatest(F.lit(1200), F.floor(F.lit(budget) / F.least("n", F.lit(5)))).cast("int")
    return chosen.withColumn("text", truncate(F.col("text"), share)).drop("n")


def language_scores(raw: Column) -> Column:
    """map of language to score: marker words among the first 60,000 characters, and bonuses for tell-tale letters.

    The words are found and folded once for all languages.
    """
    sample = F.lower(collapse_space(F.substring(text(raw), 1, 60_000)))
    marked, plain = folded_letters()

    def scores(s: Column) -> Column:
        bonus = {
            "es": F.when(s["sample"].rlike("[ñ¿¡]"), 8).otherwise(0),
            "fr": F.when(s["sample"].rlike(" l'| d'| qu'|[àèç]"), 4).otherwise(0),
            "ca": F.when(s["sample"].rlike(" l'| d'| qu'|[àèç]"), 2).otherwise(0),
            "pt": F.when(s["sample"].rlike("ção|ões|ã|õ"), 6).otherwise(0),
        }
        return F.create_map(*[x for code, _, marks in LANGUAGES for x in (F.lit(code), F.size(F.filter(s["words"], is_in(marks))) + bonus.get(code, F.lit(0)))])

    every = [w for _, _, marks in LANGUAGES for w in marks]
    words = lambda s: F.filter(F.split(F.translate(F.array_join(found(s, "[a-zÀ-ÿ]{2,}"), " "), marked, plain), " "), is_in(every))
    return let(let(sample, lambda s: F.struct(s.alias("sample"), words(s).alias("words"))), scores)


def best_language(scores: Column) -> Column:
    """The language of the greatest score, the first of equals; English if none is above 0."""
    ranked = F.array_sort(F.array(*[F.struct((-scores[code]).alias("s"), F.lit(i).alias("i"), F.lit(code).alias("code")) for i, (code, _, _) in enumerate(LANGUAGES)]))
    return F.when(ranked[0]["s"] < 0, ranked[0]["code"]).otherwise(F.lit("en"))


def prompt_language(requested: str | None, raw: Column) -> Column:
    """The language to write in: the one asked for, or the document's own by name and code."""
    if requested and requested.strip().lower() != "auto":
        return F.lit(requested.strip())
    code = best_language(language_scores(raw))
    names = F.create_map(*[x for code_, name, _ in LANGUAGES for x in (F.lit(code_), F.lit(name))])
    return F.concat(names[code], F.lit(" ("), code, F.lit("), the same language as the source document"))


def document_language(requested: str | None, raw: Column) -> Column:
    """The language that items are marked with: the one asked for, or the document's own by code."""
    if requested and requested.strip().lower() != "auto":
        return F.lit(requested.strip())
    return best_language(language_scores(raw))


def representative_context(chunks: DataFrame, budget: int = 18_000) -> DataFrame:
    """(document, sample): the representative chunks of each document as one text of at most ``budget`` characters.

    Each block is the chunk's marker and its share; a block that overflows is cut if 500 characters are left, and
    nothing follows it.
    """
    by = Window.partitionBy("document").orderBy("chunk_index")
    rows = representative_chunks(chunks, budget).withColumn("block", F.concat(F.lit("["), "chunk_id", F.lit("]\n"), "text"))
    rows = rows.withColumn("upto", F.sum(F.length("block")).over(by)).withColumn("left", F.lit(budget) - F.col("upto") + F.length("block"))
    first_over = F.min(F.when(F.col("upto") > budget, F.col("chunk_index"))).over(Window.partitionBy("document"))
    rows = rows.withColumn("over", first_over).where((F.col("upto") <= budget) | (F.col("chunk_index") == F.col("over")) & (F.col("left") >= 500))
    block = F.when(F.col("upto") <= budget, F.col("block")).otherwise(truncate(F.col("block"), F.col("left").cast("int")))
    ordered = F.array_sort(F.collect_list(F.struct("chunk_index", block.alias("block"))))  # five at most
    return rows.groupBy("document").agg(F.array_join(F.transform(ordered, lambda b: b["block"]), "\n\n").alias("sample"))
