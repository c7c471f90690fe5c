"""Settings of a run, from defaults, the environment and a command line, and their validation."""

from __future__ import annotations

import os
from dataclasses import dataclass, fields, replace

from .lexicon import GATES, JUDGE_MODES, RETRIEVAL
from .operators.splits import parse_split

#: Contexts shorter than this are widened to the document where the gate is not strict.
LEAST_CONTEXT = 9000
# Environment variables that set defaults, by setting; the first that is set counts.
ENVIRONMENT = {
    "model": ("OLLAMA_DATASET_MODEL", "OLLAMA_RAG_MODEL"),
    "language": ("DATASET_LANGUAGE",),
    "chunk_size": ("DATASET_CHUNK_SIZE",),
    "chunk_overlap": ("DATASET_CHUNK_OVERLAP",),
    "topics": ("DATASET_NUM_TOPICS",),
    "questions_per_topic": ("DATASET_QUESTIONS_PER_TOPIC",),
    "split": ("DATASET_SPLIT",),
    "temperature": ("DATASET_TEMPERATURE",),
    "seed": ("DATASET_SEED",),
    "document_budget": ("DATASET_MAX_DOC_CONTEXT_CHARS",),
    "context_budget": ("DATASET_MAX_TOPIC_CONTEXT_CHARS",),
    "gate": ("DATASET_QUALITY_GATE",),
    "timeout": ("OLLAMA_TIMEOUT_SECS",),
    "retries": ("OLLAMA_MAX_RETRIES",),
    "backoff": ("OLLAMA_RETRY_BACKOFF_SECS",),
    "embedding_model": ("OLLAMA_EMBEDDING_MODEL",),
    "retrieval": ("DATASET_RETRIEVAL",),
    "judge": ("DATASET_JUDGE",),
    "judge_model": ("OLLAMA_JUDGE_MODEL",),
}


@dataclass(frozen=True)
class Settings:
    source: str = "input"
    output: str = "output/dataset"
    debug: str = "run_logs"
    server: str = "http://localhost:11434"
    model: str = "gemma4:e4b"
    embedding_model: str = "embeddinggemma:latest"
    judge_model: str = "gemma4:e4b"
    timeout: float = 300.0
    retries: int = 3
    backoff: float = 2.0
    chunk_size: int = 3500
    chunk_overlap: int = 350
    topics: int = 8
    questions_per_topic: int = 6
    split: str = "0.8,0.1,0.1"
    temperature: float = 0.2
    seed: int = 42
    document_budget: int = 110_000
    context_budget: int = 24_000
    gate: str = "strict"
    retrieval: str = "hybrid"
    judge: str = "off"
    language: str = "auto"
    max_chunks: int | None = None
    only_document: str | None = None
    topics_file: str | None = None
    questions_file: str | None = None
    resume: bool = False
    dry_run: bool = False
    skip_model_check: bool = False

    @classmethod
    def from_environment(cls, environment: dict | None = None) -> Settings:
        """The defaults, as far as the environment does not set them; the judge is the model unless it is named."""
        found, kinds = os.environ if environment is None else environment, {f.name: f.type for f in fields(cls)}
        read = {"int": int, "float": float}
        values = {name: read.get(kinds[name], str)(v) for name, keys in ENVIRONMENT.items() for v in [next((found[k] for k in keys if found.get(k)), None)] if v is not None}
        return replace(cls(), **({"judge_model": values["model"]} if "model" in values else {}) | values)

    def errors(self) -> list[str]:
        """Everything that is wrong, at once."""
        found = []
        checks = (
            (self.chunk_size > 0 and 0 <= self.chunk_overlap < self.chunk_size, "the overlap must be less than the chunk size"),
            (self.topics >= 1, "at least one topic"),
            (self.questions_per_topic >= 1, "at least one question per topic"),
            (0 <= self.temperature <= 2, "the temperature lies between 0 and 2"),
            (self.gate in GATES, f"the gate is one of {GATES}"),
            (self.retrieval in RETRIEVAL, f"retrieval is one of {RETRIEVAL}"),
            (self.judge in JUDGE_MODES, f"the judge is one of {JUDGE_MODES}"),
            (not (self.topics_file and self.questions_file), "topics or questions from a file, not both"),
            (self.retrieval == "lexical" or self.embedding_model.strip(), f"{self.retrieval} retrieval needs an embedding model"),
            (self.judge == "off" or self.judge_model.strip(), "the judge needs a model"),
        )
        found += [text for ok, text in checks if not ok]
        try:
            parse_split(self.split)
        except ValueError as error:
            found.append(str(error))
        return found

    def validated(self, exists=None) -> Settings:
        """The settings, or an error with all that is wrong; ``exists`` tells whether a file that they name is there."""
        found = self.errors()
        found += [f"no file {path}" for path in (self.topics_file, self.questions_file) if path and exists is not None and not exists(path)]
        if found:
            raise ValueError("; ".join(found))
        return self
