"""Connected components of a table of links: alternating stars, DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rowsmith.sources.shared import removed, stored


def components(links: DataFrame, a: str, b: str) -> DataFrame:
    """(node, component): each linked node with the smallest node it can reach.

    Each round hangs every node on the smallest neighbour its neighbours know (first the larger neighbours, then
    the smaller), until the links no longer change; the number of rounds follows the logarithm of the longest
    chain. Minima are aggregated before they are shuffled, so a node linked to a third of all others is one row
    per task; the links themselves join by plain equi-joins, which adaptive execution splits. Links with a null
    end and links of a node with itself are ignored. Repeated links count once.
    """
    u, v = F.greatest(a, b).cast("bigint"), F.least(a, b).cast("bigint")
    edges = links.filter(F.col(a) != F.col(b)).select(u.alias("u"), v.alias("v")).distinct()
    edges = stored(edges, "links")
    known = _figure(edges)
    while known[0]:
        before, edges = edges, stored(_smaller(_larger(edges)), "links")
        removed(before)
        now = _figure(edges)
        if now == known:
            break
        known = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _larger(edges: DataFrame) -> DataFrame:
    """Larger neighbours of each node, linked with the smallest of the node and its neighbours."""
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return _links(edges.select(F.col("v").alias("u"), F.col("u").alias("w")).join(least, "u"), F.col("w"), F.col("m"))


def _smaller(edges: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours, linked with the smallest of them."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    others = edges.join(least, "u").select(F.col("v").alias("u"), "m")
    return _links(others.unionByName(least), F.col("u"), F.col("m"))


def _links(rows: DataFrame, u: Column, v: Column) -> DataFrame:
    return rows.filter(u != v).select(F.greatest(u, v).alias("u"), F.least(u, v).alias("v")).distinct()


def _figure(edges: DataFrame) -> tuple:
    """Number of links and a checksum of them; equal figures mean that nothing changed."""
    one = F.xxhash64("u", "v")
    row = edges.agg(F.count(F.lit(1)), F.sum(one % 1_000_000_007), F.bit_xor(one)).first()
    return tuple(row)
