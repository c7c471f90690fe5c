"""Comparison of the members of groups in blocks, so that no group is ever one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import beside


def blocks_for(count: Column, size: int) -> Column:
    return F.greatest(F.lit(1).cast("long"), F.ceil(count / F.lit(size))).cast("int")


def block_of(key: Column, blocks: Column, *salts: Column) -> Column:
    return F.pmod(F.xxhash64(key, *salts), blocks).cast("int")


def paired_blocks(members: DataFrame, key: str, blocks: str) -> DataFrame:
    """Each member once for every pair of blocks of its group that holds its own.

    ``blocks`` is the number of blocks of the group. Adds ``bi`` <= ``bj`` (the task) and ``own`` (the member's block), so
    that a task compares bi with bj, or bi with itself.
    """
    return (
        members.withColumn("own", block_of(F.col(key), F.col(blocks)))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col(blocks) - 1)))
        .withColumn("bi", F.least("own", "other"))
        .withColumn("bj", F.greatest("own", "other"))
        .drop("other")
    )


def own_blocks(members: DataFrame, group: str, key: str, blocks: str, turns: int = 1) -> DataFrame:
    """Each member once in a block of its group, dealt by group and key; in groups of several blocks, dealt anew ``turns``
    times. Adds ``bi``, ``bj`` and ``own``, all the block."""
    turn = F.explode(F.sequence(F.lit(0), F.when(F.col(blocks) > 1, F.lit(turns - 1)).otherwise(F.lit(0))))
    dealt = members.withColumn("turn", turn).withColumn("own", F.col("turn") * F.col(blocks) + block_of(F.col(key), F.col(blocks), F.col(group), F.col("turn")))
    return dealt.withColumns({"bi": F.col("own"), "bj": F.col("own")}).drop("turn")


def crossing_blocks(members: DataFrame, group: str, key: str, component: str, size: int) -> DataFrame:
    """Members of groups that hold several components, in tasks that compare every pair of different components.

    A group's largest component meets the others block by block and not itself, so a member of it is sent as often as the
    others have blocks, which is once as a rule. Adds ``bi``, ``bj`` (negative for blocks of the others) and ``own``.
    """
    sizes = members.groupBy(group, component).agg(F.count(F.lit(1)).alias("n"))
    split = sizes.groupBy(group).agg(F.max(F.struct("n", component)).alias("top"), F.sum("n").alias("all"), F.count(F.lit(1)).alias("components")).where("components > 1")
    split = split.select(group, F.col(f"top.{component}").alias("main"), blocks_for(F.col("top.n"), size).alias("mains"), blocks_for(F.col("all") - F.col("top.n"), size).alias("others"))
    rows = beside(members, split, group, key)
    main = F.col(component) == F.col("main")
    own = F.when(main, block_of(F.col(key), F.col("mains"))).otherwise(-1 - block_of(F.col(key), F.col("others")))
    meets = F.transform(F.sequence(F.lit(1), F.col("others")), lambda o: F.struct(own.alias("bi"), (-o).cast("int").alias("bj")))
    visits = F.transform(F.sequence(F.lit(0), F.col("mains") - 1), lambda m: F.struct(m.alias("bi"), own.alias("bj")))
    among = F.transform(F.sequence(F.lit(1), F.col("others")), lambda o: F.struct(F.least(own, -o).cast("int").alias("bi"), F.greatest(own, -o).cast("int").alias("bj")))
    tasks = F.explode(F.when(main, meets).otherwise(F.concat(visits, among)))
    return rows.withColumn("own", own).withColumn("task", tasks).withColumns({"bi": F.col("task.bi"), "bj": F.col("task.bj")}).drop("task", "main", "mains", "others")
