"""Connected components of a link table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketloom.llm.common import staged


def components(links: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node it is linked to, from links ``a``, ``b`` of different nodes.

    Alternates two star steps: every node hands the smallest node it knows to its
    larger neighbours, then to its smaller ones. Links then point at ever smaller
    nodes until each points at its root, after about log(nodes) rounds. Each
    round is written to the shared folder, so lineage stays short. So are the
    smallest nodes known in a step, before they meet the links: a join of two
    written tables may split a hub, a node of very many links, over tasks. Nodes
    without a link are not returned.
    """
    a, b = F.col("a"), F.col("b")
    edges = staged(
        links.where(a != b).select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).distinct(),
        "links",
    )
    before = None
    while before != (now := _fingerprint(edges)):
        before = now
        edges = staged(_to_smaller(_to_larger(edges)), "links")
    return edges.select(a.alias("node"), b.alias("root")).unionAll(
        edges.select(b.alias("node"), b.alias("root")).distinct()
    )


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(
        edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))
        ).first()
    )


def _to_larger(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the smallest node it knows."""
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = staged(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m")), "links")
    return (
        both.join(least, "a")
        .where("b > a")
        .select(F.col("b").alias("a"), F.col("m").alias("b"))
        .distinct()
    )


def _to_smaller(edges: DataFrame) -> DataFrame:
    """Every node links its smaller neighbours, and itself, to the smallest of them."""
    least = staged(edges.groupBy("a").agg(F.min("b").alias("m")), "links")
    joined = edges.join(least, "a")
    return (
        joined.select(F.col("b").alias("a"), F.col("m").alias("b"))
        .unionAll(least.select("a", F.col("m").alias("b")))
        .where("a != b")
        .distinct()
    )
