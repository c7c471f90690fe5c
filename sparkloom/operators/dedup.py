"""Duplicates among items: exact signatures, similar pairs through shared tokens, and the ordered choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import signature, text
from ..functions.tokens import content_terms, overlap, question_pairs
from ..store import written

# Measure, threshold and the reason it gives, in the order of the checks.
MEASURES = (
    ("question_pairs", 0.78, "duplicate_semantic_question"),
    ("question_terms", 0.75, "duplicate_semantic_question"),
    ("qa_terms", 0.80, "duplicate_semantic_qa"),
    ("answer_terms", 0.78, "duplicate_semantic_answer"),
)


def with_sets(items: DataFrame) -> DataFrame:
    q, a = F.col("question"), F.col("answer")
    return items.withColumns(
        {
            "question_signature": signature(q),
            "answer_signature": signature(a),
            "question_pairs": question_pairs(q),
            "question_terms": content_terms(q),
            "qa_terms": content_terms(F.concat_ws(" ", q, a)),
            "answer_terms": content_terms(a),
        }
    )


def exact_duplicates(rows: DataFrame, key: Column, seq: str = "seq") -> DataFrame:
    """``rows`` with duplicate: whether an earlier row has the same non-empty signature, or the signature is empty.

    The first of each signature are met again by ``seq``, so a signature of very many rows is no task of its own.
    """
    keyed = rows.withColumn("duplicate_key", signature(key))
    firsts = keyed.where("duplicate_key <> ''").groupBy("duplicate_key").agg(F.min(seq).alias("first_seq")).select("first_seq")
    return keyed.join(firsts, F.col(seq) == F.col("first_seq"), "left").withColumn("duplicate", F.col("first_seq").isNull()).drop("duplicate_key", "first_seq")


def set_pairs(sets: DataFrame, least: float) -> DataFrame:
    """(a, b) of different ``sets`` (sid, s) that overlap by ``least`` or more of the smaller, each pair once with a < b.

    Candidates share one of a set's rarest tokens: of m tokens, m - ceil(least * m) + 1 are enough for the smaller side
    of a pair to meet the other, so each set sends its rare prefix and is looked up with all its tokens.
    """
    tokens = sets.select("sid", F.size("s").alias("size"), F.explode("s").alias("token"))
    ranked = tokens.join(tokens.groupBy("token").count(), "token")
    place = F.row_number().over(Window.partitionBy("sid").orderBy("count", "token"))
    prefix = ranked.withColumn("place", place).where(F.col("place") <= F.col("size") - F.ceil(F.col("size") * F.lit(least) - F.lit(1e-9)) + 1).select("sid", "size", "token")
    probe = tokens.select(F.col("sid").alias("other"), F.col("size").alias("other_size"), "token")
    near = prefix.join(probe, "token").where((F.col("other") != F.col("sid")) & (F.col("size") <= F.col("other_size")))
    pairs = near.select(F.least("sid", "other").alias("a"), F.greatest("sid", "other").alias("b")).distinct()
    a, b = sets.select(F.col("sid").alias("a"), F.col("s").alias("sa")), sets.select(F.col("sid").alias("b"), F.col("s").alias("sb"))
    return pairs.join(a, "a").join(b, "b").where(overlap(F.col("sa"), F.col("sb")) >= least).select("a", "b")


def alike_sets(rows: DataFrame, column: str, least: float, seq: str, *carried: str) -> tuple[DataFrame, DataFrame]:
    """((seq, carried, sid, n), (a, b)): rows with the number of their set in ``column`` and how many have it, and the pairs of
    different sets that overlap by ``least`` or more. Rows of one set are compared as one; a set is named by its first row."""
    base = rows.select(seq, *carried, F.array_sort(column).alias("s")).where(F.size("s") > 0)
    sets = written(base.groupBy("s").agg(F.min(seq).alias("sid"), F.count(F.lit(1)).alias("n")), "dedup-sets")
    members = base.join(sets, "s").select(seq, *carried, "sid", "n")
    return written(members, "dedup-members"), written(set_pairs(sets.select("sid", "s"), least), "dedup-set-pairs")


#: Members of one key that a task pairs with all of the other's.
BLOCK = 2000


def paired(left: DataFrame, right: DataFrame, on: list[str], seq: str, keep: Column) -> DataFrame:
    """``left`` (seq, n, ..) and ``right`` (seq_, ..) of equal keys, in tasks of at most about BLOCK of the left: no pair is shuffled."""
    blocks = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("n") / F.lit(BLOCK))).cast("int")
    dealt = left.withColumn("block", F.pmod(F.xxhash64(seq), blocks).cast("int"))
    met = right.withColumn("block", F.explode(F.sequence(F.lit(0), F.ceil(F.col("n_") / F.lit(BLOCK)).cast("int") - 1)))
    return dealt.join(met, [*on, "block"]).where(keep)


def expanded(members: DataFrame, pairs: DataFrame, seq: str, *carried: str, same: bool = True) -> DataFrame:
    """(earlier, later) and the carried columns of both, with _ behind the second's, of the rows of alike sets; of one set too with ``same``."""
    other = members.select(F.col(seq).alias(f"{seq}_"), *[F.col(c).alias(f"{c}_") for c in carried], F.col("sid").alias("sid_"))
    sizes = members.select("sid", "n").distinct()
    told = pairs.join(sizes.withColumnRenamed("sid", "a"), "a").select("a", "b", "n")
    if same:
        told = told.unionByName(sizes.where("n > 1").select(F.col("sid").alias("a"), F.col("sid").alias("b"), "n"))
    # the rows of b come to the pair, and then meet those of a block by block
    right = other.join(told.withColumnRenamed("b", "sid_").withColumnRenamed("n", "n_"), "sid_").withColumnRenamed("a", "sid")
    met = paired(members.select(seq, *carried, "sid", "n"), right, ["sid"], seq, (F.col("sid") != F.col("sid_")) | (F.col(seq) < F.col(f"{seq}_")))
    return met.select(F.least(seq, f"{seq}_").alias("earlier"), F.greatest(seq, f"{seq}_").alias("later"), *carried, *[f"{c}_" for c in carried])


def similar_pairs(rows: DataFrame, column: str, least: float, seq: str = "seq") -> DataFrame:
    """(earlier, later) of rows whose sets in ``column`` overlap by ``least`` or more of the smaller.

    The pairs of equal sets grow with the square of the rows that have one; they are made where they are given, and neither
    shuffled nor kept.
    """
    members, pairs = alike_sets(rows, column, least, seq)
    return expanded(members, pairs, seq).select("earlier", "later")


#: Rules by equal signatures: column, its least length, place among the checks, and reason.
EXACT = (("question_signature", 1, 1, "duplicate_exact"), ("answer_signature", 12, 2, "duplicate_semantic_answer"))


def similar_links(sets: DataFrame, seq: str = "seq") -> tuple[DataFrame, DataFrame]:
    """(earlier, later, place, reason) of rows of similar, different sets, once for each measure, and (node, key, place, reason) of
    rows whose set others have: each is similar to all of its key."""
    links = groups = None
    for place, (column, least, reason) in enumerate(MEASURES, 3):
        members, pairs = alike_sets(sets, column, least, seq)
        told = (F.lit(place).alias("place"), F.lit(reason).alias("reason"))
        linked = expanded(members, pairs, seq, same=False).select("earlier", "later", *told)
        alike = members.where("n > 1").select(F.col(seq).alias("node"), F.concat(F.lit(f"{place}:"), F.col("sid").cast("string")).alias("key"), *told)
        links, groups = (linked, alike) if links is None else (links.unionByName(linked), groups.unionByName(alike))
    return links, groups


def duplicate_links(items: DataFrame, seq: str = "seq") -> DataFrame:
    """(earlier, later, place, reason): for each pair the first check by which the later would fall to the earlier.

    Every pair of equal signatures is a row; ``deduplicate_items`` needs none of those. Rows carry the numbers of their
    signatures, by which a pair tells at once whether an equal signature comes first; only pairs without one meet to find
    their first check.
    """
    sets = with_sets(items)
    for key, least, place, _ in EXACT:
        firsts = sets.where(F.length(key) >= least).groupBy(key).agg(F.min(seq).alias(f"k{place}"), F.count(F.lit(1)).alias(f"n{place}"))
        sets = sets.join(firsts, key, "left")
    sets = written(sets.select(seq, "k1", "k2", "n1", "n2", *[m[0] for m in MEASURES]), "dedup-keyed")
    apart = F.coalesce(F.col("k1") != F.col("k1_"), F.lit(True))
    exact = None
    for _, _, place, reason in EXACT:
        left = sets.where(F.col(f"n{place}") > 1).select(seq, "k1", F.col(f"k{place}").alias("k"), F.col(f"n{place}").alias("n"))
        right = left.select(F.col(seq).alias(f"{seq}_"), F.col("k1").alias("k1_"), "k", F.col("n").alias("n_"))
        later = F.col(seq) < F.col(f"{seq}_")
        pairs = paired(left, right, ["k"], seq, later & apart if place > 1 else later)
        pairs = pairs.select(F.col(seq).alias("earlier"), F.col(f"{seq}_").alias("later"), F.lit(place).alias("place"), F.lit(reason).alias("reason"))
        exact = pairs if exact is None else exact.unionByName(pairs)
    links = None
    for place, (column, least, _) in enumerate(MEASURES, 3):
        pairs = expanded(*alike_sets(sets, column, least, seq, "k1", "k2"), seq, "k1", "k2")
        pairs = pairs.where(apart & F.coalesce(F.col("k2") != F.col("k2_"), F.lit(True))).select("earlier", "later", F.lit(place).alias("place"))
        links = pairs if links is None else links.unionByName(pairs)
    reasons = F.element_at(F.create_map(*[x for i, m in enumerate(MEASURES, 3) for x in (F.lit(i), F.lit(m[2]))]), F.col("place"))
    return exact.unionByName(links.groupBy("earlier", "later").agg(F.min("place").alias("place")).withColumn("reason", reasons))


def ordered_choice(links: DataFrame, groups: DataFrame) -> DataFrame:
    """(node) of the rows that fall: a row falls to an earlier one that itself stays.

    ``links`` (earlier, later, ..) are pairs; ``groups`` (node, key, ..) are rows of which each links with every later one of its
    key. The choice depends on order and is not transitive, so rows are settled in rounds: one without open earlier
    neighbours stays, and its later neighbours fall. A round joins tables in the shared folder; a group is told by its
    least open and its staying row, and no row meets the driver.
    """
    fallen = links.sparkSession.createDataFrame([], "node long")
    while not (links.isEmpty() and groups.isEmpty()):
        firsts = groups.groupBy("key").agg(F.min("node").alias("first"))
        waits = links.select(F.col("later").alias("node")).unionByName(groups.join(firsts, "key").where("node > first").select("node")).distinct()
        open_rows = links.select(F.col("earlier").alias("node")).unionByName(groups.select("node")).distinct()
        stays = written(open_rows.join(waits, "node", "left_anti"), "dedup-stays")
        by_link = links.join(stays.withColumnRenamed("node", "earlier"), "earlier", "left_semi").select(F.col("later").alias("node"))
        kept_keys = groups.join(stays, "node", "left_semi").select("key", F.col("node").alias("kept"))
        by_group = groups.join(kept_keys, "key").where("node > kept").select("node")
        now = written(by_link.unionByName(by_group).distinct(), "dedup-fallen")
        fallen = fallen.unionByName(now)
        settled = written(now.unionByName(stays), "dedup-settled")
        links = links.join(settled.withColumnRenamed("node", "later"), "later", "left_anti").join(settled.withColumnRenamed("node", "earlier"), "earlier", "left_anti")
        links, groups = written(links, "dedup-links"), written(groups.join(settled, "node", "left_anti"), "dedup-groups")
    return written(fallen, "dedup-all-fallen")


def deduplicate_items(items: DataFrame, seq: str = "seq") -> DataFrame:
    """``items`` with duplicate_reason, null where the item stays; compared in the order of ``seq`` with those that stay.

    Items whose question and answer are the same text are one to all others, and the later ones fall whatever becomes of the
    first, so only the first is compared; items that share a signature or a set are a group and not pairs. An item's reason is the
    first check that any earlier staying item meets.
    """
    sets = with_sets(items.select(seq, text(F.col("question")).alias("question"), text(F.col("answer")).alias("answer")))
    sets = written(sets.withColumn("same", F.md5(F.concat_ws("\u0000", "question", "answer"))), "dedup-sets")
    firsts = written(sets.groupBy("same").agg(F.min(seq).alias("head")), "dedup-firsts")
    named = written(sets.where("question_signature <> ''").join(firsts, "same").select(F.col(seq).alias("node"), "head"), "dedup-named")
    heads = written(sets.join(named.where("node = head").select(F.col("node").alias(seq)), seq, "left_semi"), "dedup-heads")
    links, groups = similar_links(heads, seq)
    for key, least, place, reason in EXACT:
        rows = heads.where(F.length(key) >= least).select(F.col(seq).alias("node"), F.concat(F.lit(f"{place}:"), key).alias("key"), F.lit(place).alias("place"), F.lit(reason).alias("reason"))
        groups = groups.unionByName(rows)
    groups = written(groups, "dedup-groups")
    several = written(groups.groupBy("key").count().where("count > 1").select("key"), "dedup-keys")
    groups, links = written(groups.join(several, "key"), "dedup-groups"), written(links, "dedup-links")
    fallen = ordered_choice(links, groups)
    kept = written(named.where("node = head").join(fallen, "node", "left_anti").select(F.col("node").alias("kept")), "dedup-kept")

    asked = named.join(kept, F.col("node") == F.col("kept"), "left_anti")
    both = links.select(F.col("later").alias("head"), F.col("earlier").alias("kept"), "place", "reason").unionByName(links.select(F.col("earlier").alias("head"), F.col("later").alias("kept"), "place", "reason"))
    by_link = asked.join(both.join(kept, "kept", "left_semi"), "head").where("kept < node").select("node", "place", "reason")
    kept_keys = groups.join(kept, F.col("node") == F.col("kept")).select("key", "kept")
    by_group = asked.join(groups.withColumnRenamed("node", "head"), "head").join(kept_keys, "key").where("kept < node").select("node", "place", "reason")
    by_head = asked.join(kept, F.col("head") == F.col("kept"), "left_semi").select("node", F.lit(1).alias("place"), F.lit("duplicate_exact").alias("reason"))
    told = by_link.unionByName(by_group).unionByName(by_head).groupBy("node").agg(F.min(F.struct("place", "reason")).alias("x")).select("node", F.col("x.reason").alias("duplicate_reason"))
    blank = sets.where("question_signature = ''").select(F.col(seq).alias("node"), F.lit("duplicate_exact").alias("duplicate_reason"))
    return items.join(written(told.unionByName(blank), "dedup-reasons"), F.col(seq) == F.col("node"), "left").drop("node")


def duplicate_counts(deduplicated: DataFrame) -> DataFrame:
    """(reason, items) of the items that fell, by reason."""
    return deduplicated.where("duplicate_reason IS NOT NULL").groupBy(F.col("duplicate_reason").alias("reason")).agg(F.count(F.lit(1)).alias("items"))
