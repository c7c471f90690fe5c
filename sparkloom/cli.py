"""Command line: ``python -m sparkloom.cli --source-dir papers --output output/dataset`` or the same under spark-submit."""

from __future__ import annotations

import argparse
import json
import sys
from dataclasses import replace
from pathlib import Path

from .config import Settings
from .lexicon import GATES, JUDGE_MODES, RETRIEVAL
from .sources import sinks
from .sources.models import Server, check_model

# Flags, the settings they set, and what they take.
FLAGS = (
    ("--source-dir", "source", str, "folder with PDF files"),
    ("--output", "output", str, "path of the dataset, without its suffix or with it"),
    ("--debug-dir", "debug", str, "folder of checkpoints, vectors and debug rows"),
    ("--server", "server", str, "address of the model server"),
    ("--model", "model", str, "model that writes items"),
    ("--language", "language", str, "language to write in; auto: the document's own"),
    ("--chunk-size", "chunk_size", int, "characters of a chunk"),
    ("--chunk-overlap", "chunk_overlap", int, "characters that neighbouring chunks share"),
    ("--num-topics", "topics", int, "topics of a document at most"),
    ("--questions-per-topic", "questions_per_topic", int, "items of a topic"),
    ("--split", "split", str, "shares of train,val,test"),
    ("--seed", "seed", int, "seed of splits and calls"),
    ("--temperature", "temperature", float, "temperature of the model"),
    ("--max-chunks", "max_chunks", int, "chunks of a document at most"),
    ("--max-doc-context-chars", "document_budget", int, "characters of a document that a topic map is made from"),
    ("--max-topic-context-chars", "context_budget", int, "characters of a topic's context"),
    ("--only-doc", "only_document", str, "names or stems of the documents to take, separated by commas"),
    ("--embedding-model", "embedding_model", str, "model of vectors for semantic and hybrid retrieval"),
    ("--judge-model", "judge_model", str, "model of the judge"),
    ("--topics-file", "topics_file", str, "topics, as lines or YAML, in place of a topic map"),
    ("--questions-file", "questions_file", str, "questions, as lines, to be answered from each document"),
)
CHOICES = (("--quality-gate", "gate", GATES), ("--retrieval", "retrieval", RETRIEVAL), ("--judge", "judge", JUDGE_MODES))
SWITCHES = (("--skip-model-check", "skip_model_check", "do not ask the server for its models"), ("--resume", "resume", "take documents with items in the debug folder as done"), ("--dry-run", "dry_run", "only count what a run would come to"))


def parser() -> argparse.ArgumentParser:
    out = argparse.ArgumentParser(description="Question-answer datasets from PDF files.")
    for flag, name, kind, told in FLAGS:
        out.add_argument(flag, dest=name, type=kind, default=argparse.SUPPRESS, help=told)
    for flag, name, choices in CHOICES:
        out.add_argument(flag, dest=name, choices=choices, default=argparse.SUPPRESS)
    for flag, name, told in SWITCHES:
        out.add_argument(flag, dest=name, action="store_true", default=argparse.SUPPRESS, help=told)
    out.add_argument("--clean", action="store_true", help="delete generated files and end")
    out.add_argument("--clean-dry-run", action="store_true", help="count the files that --clean would delete")
    return out


def settings_of(arguments: list[str] | None = None, environment: dict | None = None) -> tuple[Settings, argparse.Namespace]:
    told = parser().parse_args(arguments)
    values = {k: v for k, v in vars(told).items() if k not in ("clean", "clean_dry_run")}
    settings = replace(Settings.from_environment(environment), **values)
    return replace(settings, output=settings.output.removesuffix(".jsonl")), told


def main(arguments: list[str] | None = None) -> int:
    settings, told = settings_of(arguments)
    if told.clean or told.clean_dry_run:
        print(json.dumps(sinks.clean_outputs([str(Path(settings.output).parent), settings.debug], str(Path.cwd()), told.clean_dry_run)))
        return 0
    if errors := settings.errors():
        print("\n".join(errors), file=sys.stderr)
        return 1
    from pyspark.sql import SparkSession

    from .plans import run

    spark = SparkSession.builder.appName("sparkloom").getOrCreate()
    docs = run.read_sources(spark, settings)
    if settings.dry_run:
        print(json.dumps(run.dry_run(spark, docs, settings)))
        return 0
    model, embedder, judge = (Server(settings.server, name, settings.timeout) for name in (settings.model, settings.embedding_model, settings.judge_model))
    if not settings.skip_model_check:
        check_model(model.listing, settings.model)
        if settings.retrieval != "lexical":
            check_model(embedder.listing, settings.embedding_model)
        if settings.judge != "off":
            check_model(judge.listing, settings.judge_model)
    print(json.dumps(run.run(spark, docs, run.Models(model, embedder.embed, judge), settings), indent=2, ensure_ascii=False, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
