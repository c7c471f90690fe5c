"""What models are asked, as messages from the fields of a request."""

from __future__ import annotations

import json
import random
from collections.abc import Sequence

from .lexicon import DIFFICULTIES, REASONS, TYPES

JSON_ONLY = "Answer with one JSON object and nothing else: no markdown, no other keys."
TOPIC_SHAPE = '{"topics": [{"name": "...", "summary": "...", "keywords": ["...", "..."]}]}'
ITEM_SHAPE = json.dumps({"items": [{"question": "...", "answer": "...", "type": "|".join(TYPES), "difficulty": "|".join(DIFFICULTIES)}]})
JUDGE_SHAPE = '{"context_quality": 0.0, "answer_support": 0.0, "question_quality": 0.0, "overall_score": 0.0, "decision": "pass|review|fail", "reasons": ["..."], "explanation": "..."}'


def messages(system: str, *parts: str) -> list[dict]:
    return [{"role": "system", "content": system}, {"role": "user", "content": "\n\n".join(p for p in parts if p)}]


def quoted(name: str, content: str) -> str:
    return f'{name}:\n"""\n{content}\n"""'


def sampled_questions(existing: Sequence[str], limit: int) -> list[str]:
    """At most ``limit`` questions: the last half of them, and before these some older ones, the same for the same number."""
    if len(existing) <= limit:
        return list(existing)
    recent = list(existing[-max(1, limit // 2) :])
    older = list(existing[: -len(recent)])
    left = min(limit - len(recent), len(older))
    return (random.Random(len(existing)).sample(older, left) if left > 0 else []) + recent


def topic_map(request: dict) -> list[dict]:
    """The topics of a whole document: ``document``, ``language``, ``wanted`` and ``context``."""
    return messages(
        f"You map the contents of documents for the makers of training data. {JSON_ONLY}",
        f"Name at most {request['wanted']} topics of the document below, each of another part of it, none twice and as little overlapping as can be.",
        f"Write names, summaries and keywords in {request['language']}, whatever language this request is in. A summary has one or two sentences; keywords are specific.",
        f"Shape of the answer: {TOPIC_SHAPE}",
        f"Document: {request['document']}",
        quoted("Text", request["context"]),
    )


def topic_map_of_excerpts(request: dict) -> list[dict]:
    """As ``topic_map``, from excerpts and in fewer words, for models with little room."""
    return messages(
        JSON_ONLY,
        f"Name at most {request['wanted']} different topics of these excerpts, in {request['language']}. Use only the excerpts; names are readable and no cut sentences.",
        f"Shape of the answer: {TOPIC_SHAPE}",
        quoted("Excerpts", request["context"]),
    )


def item(request: dict) -> list[dict]:
    """One question and answer from one passage: ``document``, ``topic``, ``topic_summary``, ``topic_keywords``, ``evidence``, ``language``,
    ``existing`` questions and the ``feedback`` to an attempt that was rejected."""
    existing = [q for q in request.get("existing") or [] if q]
    asked = "\n".join(f"- {q}" for q in sampled_questions(existing, max(40, len(existing))))
    return messages(
        f"You write question-answer pairs for training data, each from one given passage. {JSON_ONLY}",
        f"Write exactly one pair on the topic below, in {request['language']}, whatever language this request is in.",
        f"Shape of the answer: {ITEM_SHAPE}",
        "The passage alone is the source: no knowledge from elsewhere, no terms, numbers, names or conclusions that it lacks.",
        "The answer is short, follows strictly from the passage and says it in other words. Leave figures, tables, references and damaged notation alone.",
        "Do not ask again what has been asked. If the passage says little, ask for the one narrow fact that it supports.",
        f"Mend the last attempt: {request['feedback']}" if request.get("feedback") else "",
        f"Document: {request['document']}\nTopic: {request['topic']}\nSummary: {request['topic_summary']}\nKeywords: {', '.join(request.get('topic_keywords') or [])}",
        f"Questions already asked:\n{asked or '- none'}",
        quoted("Passage", request["evidence"]),
    )


def seed_answer(request: dict) -> list[dict]:
    """An answer to a given question, the topic's name, from one passage."""
    return messages(
        f"You answer a given question from one given passage. {JSON_ONLY}",
        f"Answer in {request['language']}. The question field repeats the question word for word.",
        f"Shape of the answer: {ITEM_SHAPE}",
        "The passage alone is the source; the answer is short and follows strictly from it. Where it does not answer the question, say that it does not tell.",
        f"Mend the last attempt: {request['feedback']}" if request.get("feedback") else "",
        f"Document: {request['document']}\nQuestion: {request['topic']}",
        quoted("Passage", request["evidence"]),
    )


def judgement(request: dict) -> list[dict]:
    """Whether an answer follows from its source; only ``question``, ``answer`` and ``context_source`` are told."""
    told = {k: request.get(k) or "" for k in ("question", "answer", "context_source")}
    return messages(
        f"You check strictly whether answers in training data are supported by their sources. {JSON_ONLY}",
        "Scores: 1.0 fully supported; 0.8 to 0.9 one small overstatement; 0.5 to 0.7 key terms or conclusions that the source lacks; below 0.5 contradicted, from elsewhere, or a damaged source.",
        "Decide fail where the answer holds terms, numbers or conclusions that the source lacks or contradicts it, or where the source has wrongly decoded characters, a chunk marker, or begins or ends within a sentence.",
        "Decide review where the answer needs a step beyond the source, copies it almost word for word, or the question can be read in several ways. Decide pass otherwise.",
        f"Reasons are some of: {', '.join(r for r in REASONS if r != 'judge_error')}.",
        f"Shape of the answer: {JUDGE_SHAPE}",
        "Item:\n" + json.dumps(told, ensure_ascii=False, indent=2),
    )
