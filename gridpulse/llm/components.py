"""Connected components of a link table, by hooking, pointer jumping and contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from gridpulse.sources.scratch import cut, remove


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id that has a link.

    ``links`` has columns a and b, each link in any direction. A round hooks every vertex to its smallest neighbour
    (combined map-side, so an id with very many links costs one partial row per task), follows the hooks to their ends
    by pointer jumping, and contracts the graph: links inside a tree of hooks vanish, so later rounds see few rows.
    Rounds are written tables: a lost executor costs a task, never the loop. An empty table gives an empty result.
    """
    spark = links.sparkSession
    edges = cut(_between(links.select("a", "b")))
    ends = edges.select(F.col("a").alias("id")).unionAll(edges.select(F.col("b"))).distinct()
    labels = cut(ends.select("id", F.col("id").alias("component")))
    while not edges.isEmpty():
        both = edges.select("a", "b").unionAll(edges.select(F.col("b"), F.col("a")))
        hooks = _followed(cut(both.groupBy(F.col("a").alias("id")).agg(F.least(F.min("b"), F.col("a")).alias("to"))))
        moves = hooks.select(F.col("id").alias("component"), "to")
        renamed = cut(labels.join(moves, "component", "left").select("id", F.coalesce("to", "component").alias("component")))
        one = hooks.select(F.col("id").alias("a"), F.col("to").alias("_a"))
        two = hooks.select(F.col("id").alias("b"), F.col("to").alias("_b"))
        left = cut(_between(edges.join(one, "a").join(two, "b").select(F.col("_a").alias("a"), F.col("_b").alias("b"))))
        for old in (labels, edges, hooks):
            _forget(spark, old)
        labels, edges = renamed, left
    _forget(spark, edges)
    return labels


def extended(found: DataFrame, links: DataFrame) -> DataFrame:
    """Components of ``found`` with further links, which may have new ids.

    An id of ``found`` stands for its links by one to its component: the work grows with the ids, not with the links before.
    """
    if links.isEmpty():
        return found
    return components(found.select(F.col("id").alias("a"), F.col("component").alias("b")).unionAll(links.select("a", "b")))


def _between(links: DataFrame) -> DataFrame:
    """Links between different ids, once each, the smaller id first."""
    return links.where("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _followed(hooks: DataFrame) -> DataFrame:
    """(id, to) with ``to`` replaced by the end of the chain of hooks; halves the chains until none is left."""
    spark = hooks.sparkSession
    while True:
        ends = hooks.select(F.col("id").alias("to"), F.col("to").alias("end"))
        jumped = cut(hooks.join(ends, "to").select("id", F.col("end").alias("to"), (F.col("end") != F.col("to")).alias("moved")))
        _forget(spark, hooks)
        hooks = jumped
        if hooks.where("moved").isEmpty():
            return hooks.select("id", "to")


def _forget(spark, table: DataFrame) -> None:
    files = table.inputFiles()
    if files:
        remove(spark, files[0].rpartition("/")[0])
