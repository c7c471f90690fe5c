"""Judgements of items: checks before a model is asked, normalised replies, statistics and the filter."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import prompts
from ..functions.text import collapse_space, text, truncate
from ..functions.tokens import answer_pairs, answer_tokens, let
from ..lexicon import BLOCKING_REASONS, DECISIONS, MISREAD_PATTERN, REASONS
from ..sources.models import Model, replies
from ..store import written
from .generation import json_object
from .quality import has_marker

PAYLOAD = "context_quality string, answer_support string, question_quality string, overall_score string, score string, decision string, reasons array<string>, explanation string"
# Parts of a free reason and the reason they stand for, in order.
READINGS = (
    (("unsupported", "not_supported", "halluc"), "unsupported_detail"),
    (("trunc", "cut", "incomplete"), "truncated_context"),
    (("contrad",), "unsupported_detail"),
    (("artifact", "formula", "symbol"), "extraction_artifact"),
    (("extractive", "verbatim", "copy"), "overly_extractive"),
    (("context", "evidence"), "weak_context"),
    (("unclear", "ambig"), "unclear_question"),
)


def payload(context: float, answer: float, question: float, overall: float, decision: str, reason: str, explanation: str) -> Column:
    values = (("context_quality", context), ("answer_support", answer), ("question_quality", question), ("overall_score", overall))
    return F.struct(
        *[F.lit(str(v)).alias(k) for k, v in values],
        F.lit(None).cast("string").alias("score"),
        F.lit(decision).alias("decision"),
        F.array(F.lit(reason)).alias("reasons"),
        F.lit(explanation).alias("explanation"),
    )


def copied(answer: Column, source: Column, most: float = 0.70) -> Column:
    a, s = answer_tokens(answer), answer_tokens(source)
    own = answer_pairs(answer)
    return (F.size(a) >= 6) & (F.size(s) >= 8) & (F.size(F.array_intersect(own, answer_pairs(source))) / F.greatest(F.size(own), F.lit(1)) >= most)


def precheck(answer: Column, source: Column) -> Column:
    """A payload where no model need be asked, else null."""
    a, s = text(answer), text(source)
    return (
        F.when(F.concat_ws(" ", s, a).rlike(MISREAD_PATTERN), payload(0.1, 0.5, 0.5, 0.1, "fail", "extraction_artifact", "Wrongly decoded text in the context or the answer."))
        .when(has_marker(s), payload(0.1, 0.5, 0.5, 0.1, "fail", "extraction_artifact", "A chunk marker stands in the context."))
        .when(copied(a, s), payload(0.8, 0.9, 0.4, 0.55, "review", "overly_extractive", "The answer copies the context."))
    )


def score(value: Column) -> Column:
    """A number between 0 and 1 to four places; what is none is 0."""
    number = value.try_cast("double")
    return F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.bround(F.when(number.isNull() | F.isnan(number), 0.0).otherwise(number), 4)))


def reason(value: Column) -> Column:
    """One of the known reasons for a free one."""
    c = F.translate(F.lower(collapse_space(value)), " -", "__")
    out = F.lit("weak_context")
    for parts, name in reversed(READINGS):
        out = F.when(c.rlike("|".join(parts)), name).otherwise(out)
    out = F.when(F.contains(c, F.lit("supported")) & ~F.contains(c, F.lit("not")) & ~F.contains(c, F.lit("un")), "factual").otherwise(out)
    return F.when(c.isin(list(REASONS)), c).when(c == "", "judge_error").otherwise(out)


def normalised(payload_: Column, model: Column) -> Column:
    """The judge columns as one struct from a payload struct."""
    return let(payload_, lambda p: _normalised(p, model))


def _normalised(p: Column, model: Column) -> Column:
    fallback = F.coalesce(p["score"], F.lit("0"))
    said = F.lower(F.trim(F.coalesce(p["decision"], F.lit(""))))
    reasons = F.array_distinct(F.transform(F.coalesce(p["reasons"], F.array().cast("array<string>")), lambda r: reason(r)))
    names = ("context_quality", "answer_support", "question_quality", "overall_score")
    read = F.struct(*[score(F.coalesce(p[k], fallback)).alias(k) for k in names], said.alias("said"), reasons.alias("reasons"), collapse_space(p["explanation"]).alias("explained"))
    return let(read, lambda r: let(_decided(r), lambda d: _limited(r, d, model)))


def _decided(r: Column) -> Column:
    """The first decision, the lowest part score, and the reasons."""
    overall = r["overall_score"]
    by_score = F.when(overall >= 0.8, "pass").when(overall >= 0.45, "review").when(overall > 0, "fail").otherwise("review")
    first = F.when(r["said"].isin(list(DECISIONS)), r["said"]).otherwise(by_score)
    least = F.least(r["context_quality"], r["answer_support"], r["question_quality"])

    def reasons(x: Column) -> Column:
        given = F.when(F.size(r["reasons"]) > 0, r["reasons"]).otherwise(F.array(F.when(x["first"] == "pass", "factual").otherwise("judge_error")))
        mild = F.forall(given, lambda v: v.isin("factual", "judge_error", "weak_context"))
        praised = (x["first"] == "pass") & (x["least"] >= 0.8) & mild
        return F.struct(x["first"].alias("first"), x["least"].alias("least"), F.when(praised, F.array(F.lit("factual"))).otherwise(given).alias("reasons"))

    return let(F.struct(first.alias("first"), least.alias("least")), reasons)


def _limited(r: Column, d: Column, model: Column) -> Column:
    """Blocking reasons and weak parts limit decision and score."""
    blocked = F.exists(d["reasons"], lambda v: v.isin(list(BLOCKING_REASONS))) & d["first"].isin("pass", "review")

    def judged(x: Column) -> Column:
        weak, fair = d["least"] < 0.6, (d["least"] < 0.8) & (x["decision"] == "pass")
        return F.struct(
            F.when(weak, F.least(x["score"], F.lit(0.39))).when(fair, F.least(x["score"], F.lit(0.79))).otherwise(x["score"]).alias("judge_score"),
            r["context_quality"].alias("judge_context_quality"),
            r["answer_support"].alias("judge_answer_support"),
            r["question_quality"].alias("judge_question_quality"),
            F.when(weak, "fail").when(fair, "review").otherwise(x["decision"]).alias("judge_decision"),
            F.slice(d["reasons"], 1, 5).alias("judge_reasons"),
            truncate(F.when(r["explained"] == "", "The judge gave no explanation.").otherwise(r["explained"]), 280).alias("judge_explanation"),
            model.alias("judge_model"),
        )

    after = F.when(blocked, F.least(r["overall_score"], F.lit(0.35))).otherwise(r["overall_score"])
    return let(F.struct(F.when(blocked, "fail").otherwise(d["first"]).alias("decision"), after.alias("score")), judged)


def judge_items(items: DataFrame, reply: Column, model: str = "stub") -> DataFrame:
    """``items`` with the judge columns, from the checks or else from ``reply``, JSON text; none is a judge error."""
    checked = precheck(F.col("answer"), F.col("context_source"))
    parsed = F.from_json(reply, PAYLOAD)
    empty = reply.isNull() | F.try_parse_json(reply).isNull() | ~reply.rlike("^\\s*\\{") | F.trim(reply).isin("", "{}", '{"items": []}')
    rows = items.withColumn("checked", checked)
    error = F.from_json(F.lit('{"decision":"review","reasons":["judge_error"],"explanation":"The judge call failed or gave no valid JSON."}'), PAYLOAD)
    answer = normalised(F.coalesce(F.col("checked"), F.when(~empty, parsed), error), F.when(F.col("checked").isNotNull(), f"{model}:precheck").otherwise(model))
    failed = F.col("checked").isNull() & empty
    rows = rows.withColumn("j", answer).withColumn("failed", failed).withColumn("raw", F.when(failed, F.coalesce(reply, F.lit(""))))
    rows = rows.withColumn("j", F.when(F.col("failed"), F.col("j").withField("judge_decision", F.lit("review")).withField("judge_score", F.lit(0.0))).otherwise(F.col("j")))
    return rows.select(*items.columns, "j.*", F.col("raw").alias("judge_raw_content"))


def judge_by_document(items: DataFrame, model: Model, name: str = "stub", seed: int = 42, seq: str = "seq", save: Callable[[DataFrame], DataFrame] = written) -> DataFrame:
    """``items`` with the judge columns. Each document's items are judged in the order of ``seq`` with seeds from ``seed`` on; those
    that a check settles are not asked, and a model's reply is saved before it is read. Items are known by ``id``."""
    by = Window.partitionBy("document").orderBy(seq)
    checked = precheck(F.col("answer"), F.col("context_source"))
    asked = items.withColumn("seed", F.lit(seed) + F.row_number().over(by) - 1).where(checked.isNull())
    asked = asked.select("id", text(F.col("question")).alias("question"), text(F.col("answer")).alias("answer"), text(F.col("context_source")).alias("context_source"), "seed")
    told = save(replies(asked, model, prompts.judgement, temperature=0.0))
    rows = items.join(told.select("id", json_object(F.col("reply")).alias("judge_reply")), "id", "left")
    return judge_items(rows, F.col("judge_reply"), name).drop("judge_reply")


def judge_stats(judged: DataFrame) -> DataFrame:
    """One row: judged items, each decision's count and the four averages to four places; 0 without items."""
    average = {f"average_{name}": F.coalesce(F.bround(F.avg(f"judge_{name}"), 4), F.lit(0.0)) for name in ("score", "context_quality", "answer_support", "question_quality")}
    counts = [F.count_if(F.col("judge_decision") == d).alias(f"{d}_items") for d in DECISIONS]
    return judged.agg(F.count(F.lit(1)).alias("judged_items"), *counts, *[c.alias(k) for k, c in average.items()])


def reason_counts(judged: DataFrame) -> DataFrame:
    return judged.select(F.explode("judge_reasons").alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("items"))


def judge_filter(judged: DataFrame) -> DataFrame:
    """``judged`` with rejection_reason: null where passed, else ``judge_fail:`` and the first reason that is no praise."""
    other = F.get(F.filter("judge_reasons", lambda r: r != "factual"), F.lit(0))
    return judged.withColumn("rejection_reason", F.when(F.col("judge_decision") != "pass", F.concat(F.lit("judge_fail:"), F.coalesce(other, F.col("judge_decision")))))
