"""Linking rows that share k of n attributes, and connected components."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F

from fundlens.operators.groups import with_group_totals
from fundlens.session import Step


def shared_attribute_groups(df: DataFrame, attributes: list[str]) -> DataFrame:
    """Per attribute and shared value: rows that have it, and the pairs they make.

    The pairs are counted, not listed: one common value would list a square of
    its rows. :func:`k_of_n_links` finds the linked rows without any pair list.
    """
    entries = F.array(
        *[F.struct(F.lit(a).alias("attribute"), F.col(a).cast("string").alias("value")) for a in attributes]
    )
    flat = df.select(F.inline(entries)).where(F.col("value").isNotNull())
    counted = flat.groupBy("attribute", "value").agg(F.count(F.lit(1)).alias("members"))
    n = F.col("members")
    pairs = ((n * (n - 1)) / 2).cast("bigint")
    return counted.where(n > 1).select("attribute", "value", "members", pairs.alias("pairs"))


def _subset_key(attributes: tuple[str, ...]) -> Column:
    """Digest of one attribute subset; NULL (no key) if any attribute is missing."""
    parts = [F.concat(F.length(F.col(a).cast("string")), F.lit(":"), F.col(a).cast("string")) for a in attributes]
    return F.unhex(F.sha2(F.concat(F.lit("|".join(attributes)), *parts), 256))


def k_of_n_links(df: DataFrame, attributes: list[str], k: int, node: str = "row_id") -> DataFrame:
    """Edges (src > dst) whose components equal those of "at least k attributes shared".

    Two rows share k of n attributes exactly when they agree on some subset of k
    of them. Each row gets one key per subset, and every row links to the least
    row of its key: at most C(n, k) edges per row however many rows share a key.
    """
    keys = F.array(*[_subset_key(c) for c in combinations(attributes, k)])
    keyed = df.select(F.col(node).alias("src"), F.explode(keys).alias("key")).where(F.col("key").isNotNull())
    linked = with_group_totals(keyed, ["key"], {"dst": F.min("src")}, nullable_keys=False)
    return linked.where(F.col("src") != F.col("dst")).select("src", "dst").distinct()


def connected_components(edges: DataFrame, nodes: DataFrame, node: str = "row_id") -> DataFrame:
    """(node, component): the least node that each node is connected to.

    Alternates the large-star and small-star steps of Kiveris et al.,
    "Connected Components in MapReduce and Beyond" (SoCC 2014). Only edges are
    kept between rounds, they never grow in number, and a round is one write to
    the shared folder, after which the round before it is removed. The write
    observes a fingerprint of its edges, and the search ends with the first round
    that leaves them as they were. Every step is a grouped minimum carried back to
    the rows, so a hub with very many edges is split, not gathered in one task.
    """
    fingerprint = {"edges": F.count(F.lit(1)), "bits": F.bit_xor(F.xxhash64("src", "dst")), "sum": F.sum(F.hash("dst", "src").cast("long"))}
    ordered = edges.where(F.col("src") != F.col("dst")).select(
        F.greatest("src", "dst").alias("src"), F.least("src", "dst").alias("dst")
    )
    current, settled = Step(ordered.distinct(), "edges", **fingerprint), False
    while not settled:
        step = Step(_small_star(_large_star(current.frame)), "components", **fingerprint)
        settled = step.seen == current.seen
        current.remove()
        current = step
    labels = current.frame.select(F.col("src").alias(node), F.col("dst").alias("_least"))
    return nodes.select(node).join(labels, node, "left").select(node, F.coalesce("_least", node).alias("component"))


def _large_star(edges: DataFrame) -> DataFrame:
    """Each larger neighbour of a node links to the least node around it."""
    both = edges.unionByName(edges.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    around = with_group_totals(both, ["src"], {"least": F.min("dst")}, nullable_keys=False)
    return around.where(F.col("dst") > F.col("src")).select(F.col("dst").alias("src"), F.least("least", "src").alias("dst")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """A node and its smaller neighbours all link to the least of them."""
    below = with_group_totals(edges, ["src"], {"least": F.min("dst")}, nullable_keys=False)
    # An edge to the least stays as it is; the target of any other one goes over to it.
    source = F.when(F.col("dst") != F.col("least"), F.col("dst")).otherwise(F.col("src"))
    return below.select(source.alias("src"), F.col("least").alias("dst")).distinct()
