"""Documents taken apart in one pass each: chunks, topics from them, scores, contexts and evidence, without a shuffle or a saved table.

The same as ``chunk_documents``, ``fallback_topics``, ``usable_chunks``, ``lexical_scores``, ``selected_chunks``, ``evidence_rows`` and
``rank_evidence`` in a row, for documents whose ids are their own: nothing of a document meets another's.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import plain
from .quality import TRACE_PATTERN
from .topics import UNNAMED

STRING, INT, DOUBLE = pa.string(), pa.int32(), pa.float64()


def topic_id(place: int) -> str:
    return f"topic-{place:02d}"


class Parts:
    """A document's chunks and up to ``count`` topics, named as ``fallback_topics`` names them, or by their keywords alone."""

    def __init__(self, document: str, text: str | None, size: int, overlap: int, named: bool, count: int = 8):
        self.document, self.chunks = document, plain.chunks(text, size, overlap)
        places = plain.topic_places(len(self.chunks), count)
        keys = [plain.keywords(self.chunks[p]) for p in places]
        self.names = [plain.name_from_chunk(self.chunks[p], t, UNNAMED) if named else " ".join(keys[t]) for t, p in enumerate(places)]
        about = [plain.summary(self.chunks[p]) if named else "" for p in places]
        self.topics = plain.Topics([topic_id(t) for t in range(len(places))], [[n, s, *k] for n, s, k in zip(self.names, about, keys, strict=True)])
        self.low = [c.lower() for c in self.chunks]

    def chunk_id(self, place: int) -> str:
        return f"{self.document}-chunk-{place:04d}"

    def scored(self, places: list[int] | range) -> Iterator[tuple[int, list[int], list[float]]]:
        """(chunk, raw mentions, scores for each topic)."""
        behind = " " + self.document.lower()
        for i in places:
            raws = self.topics.raws(self.low[i] + behind)
            yield i, raws, self.topics.scores(raws)

    def usable(self) -> list[int]:
        good = [i for i, c in enumerate(self.chunks) if not plain.noisy(c)]
        return good or list(range(len(self.chunks)))

    def contexts(self, places: list[int] | range, budget: int, literal: bool = True) -> Iterator[tuple[int, list[tuple[int, int, int | None]]]]:
        """(topic, [(chunk, rank, limit)]) of each topic's context."""
        scores = [s for _, _, s in self.scored(places)]
        blocks, low = [len(self.chunk_id(i)) + len(self.chunks[i]) + 3 for i in places], [self.low[i] for i in places] if literal else None
        for t, name in enumerate(self.names):
            yield t, [(places[i], rank, limit) for i, rank, limit in plain.selected(blocks, low, [s[t] for s in scores], name, budget)]


def of_documents(docs: DataFrame, each: Callable[[Parts], Iterator[tuple]], schema: str, types: list[pa.DataType], size: int, overlap: int, named: bool) -> DataFrame:
    """What ``each`` gives for every document (doc_id, text) with an id, behind its id."""

    def run(document: str, text: str | None) -> list[tuple]:
        return [(document, *row) for row in each(Parts(document, text, size, overlap, named))]

    rows = docs.where("doc_id IS NOT NULL").select(F.col("doc_id").cast("string"), F.col("text").cast("string"))
    return plain.per_row(rows, run, "document string, " + schema, [STRING, *types])


def lexical_scores(docs: DataFrame, size: int, overlap: int, named: bool) -> DataFrame:
    """(document, chunk_index, topic_id, topic_index, raw, score): every chunk with every topic of its document."""

    def each(p: Parts) -> Iterator[tuple]:
        for i, raws, scores in p.scored(range(len(p.chunks))):
            for t, (raw, score) in enumerate(zip(raws, scores, strict=True)):
                yield i, topic_id(t), t, raw, score

    return of_documents(docs, each, "chunk_index int, topic_id string, topic_index int, raw int, score double", [INT, STRING, INT, INT, DOUBLE], size, overlap, named)


def contexts(docs: DataFrame, size: int, overlap: int, named: bool, budget: int = 24_000) -> DataFrame:
    """(document, topic_id, rank, chunk_id, chunk_index): the chunks of each topic's context. Topics named by keywords take all
    chunks by score; others the usable ones, and those first that hold the topic's name."""

    def each(p: Parts) -> Iterator[tuple]:
        for t, chosen in p.contexts(p.usable() if named else range(len(p.chunks)), budget, named):
            for i, rank, _ in chosen:
                yield topic_id(t), rank, p.chunk_id(i), i

    return of_documents(docs, each, "topic_id string, rank int, chunk_id string, chunk_index int", [STRING, INT, STRING, INT], size, overlap, named)


def evidence(docs: DataFrame, size: int, overlap: int, budget: int = 24_000, most: int = 80) -> DataFrame:
    """(document, topic_id, evidence_id, evidence_rank, score): the ``most`` best windows of each topic's context.

    A block that stands in several contexts is taken apart once.
    """

    def each(p: Parts) -> Iterator[tuple]:
        signs, known = p.topics.signs(), {}
        for t, chosen in p.contexts(p.usable(), budget):
            if plain.closing_topic(p.names[t], TRACE_PATTERN):
                continue
            found = []
            for i, rank, limit in chosen:
                text = plain.block_text(p.chunk_id(i), p.chunks[i], limit)
                text = plain.opened(text) if rank == 1 else text
                if (i, text) not in known:
                    known[i, text] = plain.windows(text, p.topics, signs, TRACE_PATTERN, unsound=False)
                found += [(-w[5][t], rank, w[0], w[1], i) for w in known[i, text]]
            for place, (score, _, start, count, i) in enumerate(sorted(found)[:most], 1):
                yield topic_id(t), f"{p.chunk_id(i)}-sent-{start:04d}-{count}", place, -score

    return of_documents(docs, each, "topic_id string, evidence_id string, evidence_rank int, score double", [STRING, STRING, INT, DOUBLE], size, overlap, True)
