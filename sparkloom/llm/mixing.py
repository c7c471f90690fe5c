"""Mixing sources to target weights by nested hash-threshold histograms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..store import free_prefix, numbered, written

#: Bits of a hash, refined so many bits at a time: a source has at most 2**LEVEL_BITS buckets in a pass.
HASH_BITS, LEVEL_BITS = 60, 10
#: One row per source is broadcast up to so many sources; beyond, it is joined by source.
BROADCAST_SOURCES = 50_000
#: The level of the targets is sought among so many parts of a range at a time.
PARTS = 1024
WORD = "[^\\x20\\x09-\\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def document_hash(doc_id: Column, seed: str) -> Column:
    """The first 60 bits of md5(seed:doc_id); null reads as empty."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, HASH_BITS // 4), 16, 10).cast("long")


def text_hash(text: Column) -> Column:
    """60 bits of a text, for documents whose ids are null or the same."""
    return F.xxhash64(F.coalesce(text, F.lit(""))).bitwiseAND(F.lit((1 << HASH_BITS) - 1))


def water_level(caps: DataFrame, total: float) -> tuple[float, float]:
    """(ratio, level) for rows (cap, w): the least ratio cap / w that is no less than what is left for it by weight, and that.

    Rows of lesser ratios take their caps, the others share the rest by weight. The ratio is sought among PARTS parts
    of a range at a time, each pass in the part that holds it; without any, both are infinite.
    """
    caps = caps.withColumn("ratio", F.col("cap") / F.col("w"))
    least, most, weights = caps.agg(F.min("ratio"), F.max("ratio"), F.sum("w")).first()
    found = float("inf"), float("inf")
    if least is None:
        return found
    cap_before, w_before, above = 0.0, 0.0, None
    while True:
        inside = F.col("ratio") >= least if above is None else (F.col("ratio") >= least) & (F.col("ratio") < above)
        part = F.floor((F.col("ratio") - F.lit(least)) / F.lit(most - least) * PARTS) if most > least else F.lit(0)
        parts = caps.where(inside).groupBy(part.alias("part")).agg(F.min("ratio").alias("lo"), F.max("ratio").alias("hi"), F.sum("cap").alias("cap"), F.sum("w").alias("w")).orderBy("part").collect()
        last, cap, w = None, cap_before, w_before
        for r in parts:
            level = (total - cap) / (weights - w)
            if level <= r["lo"]:
                found, above = (r["lo"], level), r["lo"]
                break
            last, cap_before, w_before = r, cap, w
            cap, w = cap + r["cap"], w + r["w"]
        if last is None or last["lo"] == last["hi"]:
            return found
        least, most = last["lo"], last["hi"]


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, share: float = 1.0) -> DataFrame:
    """(source, source_size) to (source, source_size, target): ``share`` of all words by repeating weights.

    Sources stand in code point order, null last. A target stops at ``most`` times its source's size; the excess is
    dealt again by weight until none is above, which is the level at which the sorted caps cross their share.
    """
    ranked = numbered(sizes.select("source", "source_size"), F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.pmod("place", F.lit(len(weights))) + 1).cast("int"))
    caps = ranked.select("source", "source_size", weight.alias("w"), (F.col("source_size") * F.lit(most)).cast("double").alias("cap"))
    ratio, level = water_level(caps, (sizes.agg(F.sum("source_size")).first()[0] or 0) * share)
    target = F.when(F.col("cap") / F.col("w") < F.lit(ratio), F.col("cap")).otherwise(F.lit(level) * F.col("w"))
    return caps.select("source", "source_size", target.alias("target"))


def refined(state: DataFrame, sized: DataFrame, key: str, within: Column, few: bool) -> tuple[DataFrame, int]:
    """``state`` with the leading bits of the hash ``key`` at which a source's running words cross its budget, and how many
    bits follow those.

    Words are summed by source and leading bits of the hash; the bucket that crosses the budget is refined by its next
    bits alone, until every source's holds one row or is a single hash. ``within`` tells the rows that are in question.
    """
    hint = F.broadcast if few else (lambda df: df)
    state = state.withColumn("prefix", F.lit(0).cast("long"))
    for done in range(0, HASH_BITS, LEVEL_BITS):
        left = HASH_BITS - done - LEVEL_BITS
        known = state.select(F.col("source").alias("s"), F.col("prefix").alias("p"), "cut", "budget", F.col("used").alias("start"))
        inside = sized.join(hint(known), F.col("source").eqNullSafe(F.col("s")) & (F.shiftright(key, left + LEVEL_BITS) == F.col("p")) & within)
        sums = inside.groupBy("source", F.shiftright(key, left).alias("bucket")).agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("rows"))
        running = F.sum("words").over(Window.partitionBy("source").orderBy("bucket")) + F.col("start")
        crossing = (
            sums.join(hint(known), F.col("source").eqNullSafe(F.col("s")))
            .withColumn("upto", running)
            .where("upto > budget")
            .groupBy("source")
            .agg(F.min(F.struct("bucket", "upto", "words", "rows")).alias("b"))
            .select(F.col("source").alias("s"), F.col("b.bucket").alias("next"), (F.col("b.upto") - F.col("b.words")).alias("before"), "b.words", "b.rows")
        )
        state = (
            state.join(crossing, F.col("source").eqNullSafe(F.col("s")), "left")
            .withColumns({"prefix": F.coalesce("next", F.lit(0)), "used": F.coalesce("before", "used"), "within": F.coalesce("words", F.lit(0)), "members": F.coalesce("rows", F.lit(0))})
            .drop("s", "next", "before", "words", "rows")
        )
        state = written(state, "mix-state")
        if state.where("members > 1").isEmpty():
            break
    return state, left


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, source_size, target, copies, cut, cut_bits, text_cut, text_bits, tied, ties): documents are taken once more than
    ``copies`` if their hash without its last ``cut_bits`` is below ``cut``, or if it is ``cut`` and their text's hash
    without ``text_bits`` is below ``text_cut`` (null: any text); of the ``tied`` rows with both, ``ties`` are.

    ``sized`` holds (source, size, h, t). Only rows of one id, or of none, share a hash; the text's hash then goes on, and
    rows that share that too are the same, so their number alone matters. What is taken of them is what brings the
    source nearest to its target.
    """
    few = targets.count() <= BROADCAST_SOURCES
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0))
    state = targets.withColumn("copies", whole.cast("long")).withColumn("budget", F.col("target") - F.col("copies") * F.col("source_size"))
    state = state.withColumns({"used": F.lit(0).cast("long"), "cut": F.lit(None).cast("long")})
    state, left = refined(state, sized, "h", F.lit(True), few)
    state = state.withColumns({"cut": F.when(F.col("within") > 0, F.col("prefix")).otherwise(F.lit(0)), "cut_bits": F.lit(left), "text_cut": F.lit(None).cast("long"), "text_bits": F.lit(0)})
    if not state.where("members > 1").isEmpty():
        alone = F.col("members") <= 1
        several, left = refined(state.where(~alone), sized, "t", F.col("h") == F.col("cut"), few)
        state = state.where(alone).unionByName(several.withColumns({"text_cut": F.col("prefix"), "text_bits": F.lit(left)}))
    exact = (F.col("budget") - F.col("used")) * F.col("members") / F.col("within")
    nearest = F.floor(exact) + (exact - F.floor(exact) > 0.5).cast("long")
    ties = F.when(F.col("within") > 0, F.least(nearest, F.col("members"))).otherwise(F.lit(0)).cast("long")
    return state.select("source", "source_size", "target", "copies", "cut", "cut_bits", "text_cut", "text_bits", F.col("members").alias("tied"), ties.alias("ties"))


def with_copies(rows: DataFrame, plan: DataFrame, hashes: tuple[Column, Column], x: str) -> DataFrame:
    """``rows`` (with their source's ``plan`` under the prefix ``x``) with {x}n, how often the mix takes each.

    The rows that share the last hash taken are numbered by the partitions of a table of them, and the first are taken;
    where no source has more than one such row there is none to number.
    """
    first, second = (F.call_function("shiftright", h, F.col(x + bits)) for h, bits in zip(hashes, ("cut_bits", "text_bits"), strict=True))
    cut, text_cut = F.col(f"{x}cut"), F.col(f"{x}text_cut")
    beside = (first < cut) | (first == cut) & F.coalesce(second < text_cut, F.lit(False))
    last = (first == cut) & F.coalesce(second == text_cut, F.lit(True))
    number = F.col(f"{x}copies")
    if plan.where(f"{x}tied > 1").isEmpty():
        return rows.withColumn(f"{x}n", number + (beside | last & (F.col(f"{x}ties") > 0)).cast("long"))
    at = f"{x}at"
    tied = written(rows.where(last).withColumn(at, F.monotonically_increasing_id()).withColumn(f"{x}part", F.shiftright(at, 33)), "mix-ties")
    by = [f"{x}source", f"{x}part"]
    starts = tied.groupBy(by).agg(F.count(F.lit(1)).alias(f"{x}rows"))
    starts = starts.withColumn(f"{x}before", F.sum(f"{x}rows").over(Window.partitionBy(f"{x}source").orderBy(f"{x}part")) - F.col(f"{x}rows"))
    starts = starts.select(F.col(by[0]).alias(f"{x}s"), F.col(by[1]).alias(f"{x}p"), f"{x}before")
    ranked = tied.withColumn(f"{x}rank", F.row_number().over(Window.partitionBy(by).orderBy(at)))
    ranked = ranked.join(starts, F.col(by[0]).eqNullSafe(F.col(f"{x}s")) & (F.col(by[1]) == F.col(f"{x}p")))
    ranked = ranked.withColumn(f"{x}n", number + (F.col(f"{x}before") + F.col(f"{x}rank") <= F.col(f"{x}ties")).cast("long"))
    others = rows.where(~last).withColumn(f"{x}n", number + beside.cast("long"))
    return others.unionByName(ranked.select(others.columns))


def mixing_plan(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, share: float = 1.0, seed: str = "mix") -> tuple[DataFrame, DataFrame]:
    """The sized rows (doc_id, source, size, h, t) of ``docs`` and the thresholds of its sources."""
    sized = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), document_hash(F.col("doc_id"), seed).alias("h"), text_hash(F.col("text")).alias("t"))
    sized = written(sized, "mix-sizes")
    sizes = written(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sources")
    return sized, written(thresholds(sized, written(source_targets(sizes, weights, most, share), "mix-targets")), "mix-plan")


def with_plan(rows: DataFrame, plan: DataFrame, source: str, hashes: tuple[Column, Column], prefix: str) -> DataFrame:
    """``rows`` with the columns of their source's plan, named with ``prefix``, and {prefix}n, how often each is taken."""
    plan = plan.select([F.col(c).alias(prefix + c) for c in plan.columns])
    near = F.broadcast(plan) if plan.count() <= BROADCAST_SOURCES else plan
    return with_copies(rows.join(near, rows[source].eqNullSafe(near[f"{prefix}source"])), plan, hashes, prefix)


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, share: float = 1.0, seed: str = "mix") -> DataFrame:
    """How much of each document the mix takes: (doc_id, size, source_size, target, taken, copies).

    Reads doc_id, source and text alone, so other columns cannot clash. Size is the number of words; null text: 0.
    A null source is a source of its own. A document is taken whole, ``copies`` times, at most ``most``. Rows of one id, or
    without an id, are told apart by their texts; of rows alike in both some may be taken once more than the others, and
    reruns take as many. A source comes within half a document's words of its target. Documents without words take
    nothing; an empty table gives no rows.
    """
    sized, plan = mixing_plan(docs, weights, most, share, seed)
    copies = F.col("plan_n")
    return with_plan(sized, plan, "source", (F.col("h"), F.col("t")), "plan_").select(
        "doc_id", "size", F.col("plan_source_size").alias("source_size"), F.col("plan_target").alias("target"), (F.col("size") * copies).alias("taken"), copies.alias("copies")
    )


def mixed_documents(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), most: int = 3, share: float = 1.0, seed: str = "mix") -> DataFrame:
    """The documents themselves, each as often as ``mix`` takes it, with all their columns, whatever their names.

    Documents without words (null and empty texts) are left out: the mix takes no words of them. Null and repeated ids,
    ties and repeated rows are taken as ``mix`` takes them; an empty table gives no rows.
    """
    _, plan = mixing_plan(docs, weights, most, share, seed)
    x = free_prefix(docs.columns)
    rows = with_plan(docs, plan, "source", (document_hash(F.col("doc_id"), seed), text_hash(F.col("text"))), x)
    times = F.when(F.col("text").rlike(WORD), F.col(f"{x}n")).otherwise(F.lit(0)).cast("int")
    rows = rows.withColumn(f"{x}times", times).where(F.col(f"{x}times") > 0)
    return rows.withColumn(f"{x}time", F.explode(F.sequence(F.lit(1), F.col(f"{x}times")))).select(*[F.col(f"`{c}`") for c in docs.columns])


ORACLE = """
WITH sized AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5('mix:' || coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
sizes AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (
  SELECT source, source_size, sum(source_size) OVER ()::DOUBLE AS total,
         CASE (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS w
  FROM sizes),
levels AS (
  SELECT *, row_number() OVER byc AS place,
         (total - coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
         / sum(w) OVER (ORDER BY 3 * source_size / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS lev
  FROM weighed WINDOW byc AS (ORDER BY 3 * source_size / w, source NULLS LAST)),
chosen AS (SELECT min(place) AS p, arg_min(lev, place) AS lev FROM levels WHERE lev * w <= 3 * source_size),
targets AS (
  SELECT source, source_size, CASE WHEN place < p THEN (3 * source_size)::DOUBLE ELSE chosen.lev * w END AS target FROM levels, chosen),
budgets AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS copies FROM targets),
running AS (
  SELECT s.doc_id, s.size, b.source_size, b.target, b.copies, b.target - b.copies * b.source_size AS budget,
         sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h) AS upto,
         sum(s.size) OVER (PARTITION BY s.source, s.h) AS same
  FROM sized s JOIN budgets b ON s.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, size, source_size, target,
       (size * (copies + CASE WHEN upto <= budget OR upto - budget < budget - (upto - same) THEN 1 ELSE 0 END))::BIGINT AS taken,
       (copies + CASE WHEN upto <= budget OR upto - budget < budget - (upto - same) THEN 1 ELSE 0 END)::BIGINT AS copies
FROM running
"""
