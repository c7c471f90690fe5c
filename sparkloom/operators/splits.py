"""Train, validation and test splits, and the audit of a dataset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..store import numbered, written


def parse_split(ratios: str) -> tuple[float, float, float]:
    """Three non-negative shares of 1 from ``train,val,test``."""
    parts = [float(p) for p in ratios.split(",")]
    if len(parts) != 3 or min(parts) < 0 or sum(parts) <= 0:
        raise ValueError("a split has three non-negative values, not all 0: train,val,test")
    return tuple(p / sum(parts) for p in parts)


def shuffled(seed: int, *keys: Column | str) -> Column:
    """A hash to order by; the same wherever it is computed."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *keys))


def split_rows(rows: DataFrame, ratios: str = "0.8,0.1,0.1", seed: int = 42, key: str = "id", topic: str = "topic_id") -> DataFrame:
    """``rows`` with split. Validation and test take int(n * share) and the rest; first at most one row of each topic with
    three and with two rows, so that topics are seen, then others in hashed order. Without the column ``topic`` the
    hashed order alone decides.

    A topic's rows are told by their first and last hash in one aggregate, and numbers come from ranges of the hashed order,
    so neither a topic nor the whole table is one task.
    """
    train, val, _ = parse_split(ratios)
    rows = written(rows, "split-rows")
    n = rows.count()
    train_end = int(n * train)
    n_val = min(int(n * val), n - train_end)
    n_test = n - train_end - n_val
    more_val, more_test, first = n_val, n_test, None
    if topic in rows.columns:
        mine = [F.struct(shuffled(seed + i, key).alias("h"), F.col(key).cast("string").alias("k")) for i in (0, 2)]
        topics = rows.groupBy(topic).agg(F.count(F.lit(1)).alias("n"), F.min(mine[0]).alias("a"), F.min(mine[1]).alias("b"), F.max(mine[1]).alias("c"))
        order = (shuffled(seed, topic), topic)
        vals = numbered(topics.where("n >= 3"), *order).where(F.col("place") < n_val)
        took = topics.join(vals.select(F.col(topic).alias("t"), F.lit(1).alias("took")), F.col(topic).eqNullSafe(F.col("t")), "left").drop("t")
        tests = numbered(took.where(F.col("n") - F.coalesce("took", F.lit(0)) >= 2), *order).where(F.col("place") < n_test)
        taken = F.when(F.col("took").isNotNull() & (F.col("a.k") == F.col("b.k")), F.col("c.k")).otherwise(F.col("b.k"))
        first = written(vals.select(F.col("a.k").alias("k"), F.lit("val").alias("s")).unionByName(tests.select(taken.alias("k"), F.lit("test").alias("s"))), "split-first")
        counted = {r["s"]: r["count"] for r in first.groupBy("s").count().collect()}
        more_val, more_test = n_val - counted.get("val", 0), n_test - counted.get("test", 0)
    rest = rows if first is None else rows.join(first, F.col(key).cast("string") == F.col("k"), "left_anti")
    rest = numbered(rest, shuffled(seed + 1, key), key, name="__place")
    filled = rest.withColumn("split", F.when(F.col("__place") < more_val, "val").when(F.col("__place") < more_val + more_test, "test").otherwise("train")).drop("__place")
    if first is None:
        return filled
    return rows.join(first, F.col(key).cast("string") == F.col("k")).drop("k").withColumnRenamed("s", "split").unionByName(filled)


def topic_audit(rows: DataFrame, expected: DataFrame | None = None) -> DataFrame:
    """(document, topic_id, accepted, rejected) of rows with rejection_reason, expected topics without rows included."""
    counted = rows.groupBy("document", "topic_id").agg(F.count_if(F.col("rejection_reason").isNull()).alias("accepted"), F.count_if(F.col("rejection_reason").isNotNull()).alias("rejected"))
    if expected is None:
        return counted
    wanted = expected.select("document", "topic_id").distinct()
    joined = counted.join(wanted, ["document", "topic_id"], "full_outer")
    return joined.select("document", "topic_id", F.coalesce("accepted", F.lit(0)).alias("accepted"), F.coalesce("rejected", F.lit(0)).alias("rejected"))


def coverage(audit: DataFrame) -> DataFrame:
    """One row: topics, those without and with fewer than two accepted rows, coverage to four places, success."""
    empty = F.count_if(F.col("accepted") == 0)
    out = audit.agg(F.count(F.lit(1)).alias("topics"), empty.alias("empty_topics"), F.count_if(F.col("accepted").between(1, 1)).alias("low_topics"), F.coalesce(F.sum("accepted"), F.lit(0)).alias("accepted_rows"))
    ratio = F.when(F.col("topics") > 0, F.bround((F.col("topics") - F.col("empty_topics")) / F.col("topics"), 4)).otherwise(0.0)
    allowed = F.greatest(F.lit(1).cast("long"), F.floor(F.col("topics") / 5))
    return out.withColumns({"coverage_ratio": ratio, "pipeline_success": (F.col("topics") > 0) & (F.col("empty_topics") <= allowed)})


def deficits(accepted: DataFrame, topics: DataFrame, wanted: int = 6) -> DataFrame:
    """(document, topic_id, accepted, missing) of topics with fewer than ``wanted`` accepted rows."""
    have = accepted.groupBy("document", "topic_id").agg(F.count(F.lit(1)).alias("accepted"))
    joined = topics.select("document", "topic_id").distinct().join(have, ["document", "topic_id"], "left").withColumn("accepted", F.coalesce("accepted", F.lit(0)))
    return joined.where(F.col("accepted") < wanted).withColumn("missing", F.lit(wanted) - F.col("accepted"))


def dataset_audit(rows: DataFrame, rejected: DataFrame, expected: DataFrame | None = None, least: int = 2, listed: int = 1000) -> dict:
    """What a dataset covers: ``rows`` (document, topic_id, split), ``rejected`` rows and ``expected`` topics (document, topic_id).

    Counts cover all topics; of the topics themselves at most ``listed`` of a kind are named, the first by name, and the
    counts by topic are a table of their own (``topic_audit``).
    """
    reason = F.lit(None).cast("string")
    every = rows.select("document", "topic_id", reason.alias("rejection_reason")).unionByName(rejected.select("document", "topic_id", F.lit("rejected").alias("rejection_reason")))
    audit = written(topic_audit(every, expected).withColumn("key", F.concat_ws("::", F.coalesce("document", F.lit("__missing__")), F.coalesce("topic_id", F.lit("__missing__")))), "audit")

    def named(condition: Column) -> list[str]:
        return [r["key"] for r in audit.where(condition).select("key").orderBy("key").limit(listed).collect()]

    total = coverage(audit).first()
    empty, low = named(F.col("accepted") == 0), named((F.col("accepted") > 0) & (F.col("accepted") < least))
    by_split = {r["split"]: r for r in rows.groupBy("split").agg(F.count(F.lit(1)).alias("rows"), F.countDistinct("document", "topic_id").alias("topics"), F.countDistinct("document").alias("documents")).collect()}
    warnings = [f"topics_without_accepted: {', '.join(empty)}"] if empty else []
    warnings += [f"topics_below_{least}_items: {', '.join(low)}"] if low else []
    warnings += [f"{s}_split_has_single_topic" for s in ("val", "test") if s in by_split and by_split[s]["topics"] == 1 and total["topics"] > 1]
    return {
        "topics": total["topics"],
        "topics_without_accepted": empty,
        "low_accepted_topics": low,
        "coverage_ratio": float(total["coverage_ratio"]),
        "multi_doc_in_splits": {s: s in by_split and by_split[s]["documents"] > 1 for s in ("train", "val", "test")},
        "split_topics": {s: by_split[s]["topics"] if s in by_split else 0 for s in ("train", "val", "test")},
        "pipeline_success": total["topics"] > 0 and total["empty_topics"] <= max(1, total["topics"] // 5),
        "warnings": warnings,
    }
