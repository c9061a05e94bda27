"""Connected components and cluster tables over edge DataFrames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.operators.ordering import numbered
from strandline.session import discard, materialise, release


def star_edges(edges: DataFrame, src: str = "source", dst: str = "target", max_rounds: int = 50) -> DataFrame:
    """``(u, v)``: every node that has an edge, but the smallest of its component, with that smallest node.

    Alternates the large-star and small-star steps: every round is two shuffles on the node, edges only ever
    point to smaller nodes, and the number of rounds is logarithmic in the number of edges. A hub costs one
    row per edge and its group is reduced by a partial ``min``, never gathered. The state of each round is
    written to the shared folder, so lineage stays short and a lost executor costs one round at most. A count by
    node tells whether the edges are stars, so no round is run to see that it changes nothing.
    Null ends and self loops are ignored. Any orderable node type works.
    """
    e = edges.select(F.greatest(src, dst).alias("u"), F.least(src, dst).alias("v"))
    e = materialise(e.filter(F.col(src).isNotNull() & F.col(dst).isNotNull() & (F.col("u") > F.col("v"))).distinct())
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        ends = both.groupBy("u").agg(F.count_if(F.col("v") < F.col("u")).alias("down"), F.count_if(F.col("v") > F.col("u")).alias("up"))
        if not ends.filter("down > 1 or down = 1 and up > 0").limit(1).count():
            return e
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.filter("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        small_low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(small_low, "u").select(F.explode(F.array(F.struct("u", "m"), F.struct(F.col("v").alias("u"), "m"))).alias("x"))
        small = small.select(F.col("x.u").alias("u"), F.col("x.m").alias("v")).filter("u <> v").distinct()
        e, old = materialise(small), e
        discard(old)
    raise RuntimeError(f"labels did not settle in {max_rounds} rounds")


def min_labels(edges: DataFrame, src: str = "source", dst: str = "target", max_rounds: int = 50) -> DataFrame:
    """``(node, label)``: the smallest node reachable from every node that has an edge (see ``star_edges``)."""
    stars = star_edges(edges, src, dst, max_rounds)
    return stars.select(F.col("u").alias("node"), F.col("v").alias("label")).unionByName(stars.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())


def components(nodes: DataFrame, links: DataFrame, node: str = "sample_id", src: str = "source", dst: str = "target") -> DataFrame:
    """``(node, root)`` for every listed node and every link end; isolates are their own root."""
    ends = links.select(F.col(src).alias(node)).unionByName(links.select(F.col(dst).alias(node)))
    every = nodes.select(node).unionByName(ends).filter(F.col(node).isNotNull()).distinct()
    labels = min_labels(links, src, dst).withColumnRenamed("node", node)
    release(nodes.sparkSession)
    return every.join(labels, node, "left").select(node, F.coalesce("label", node).alias("root"))


def cluster_name(rank: Column) -> Column:
    """``C0001``; the width grows beyond 9999 instead of truncating."""
    return F.concat(F.lit("C"), F.lpad(rank.cast("string"), F.greatest(F.lit(4), F.length(rank.cast("string"))), F.lit("0")))


def number_clusters(found: DataFrame, group: list[str] | None = None, node: str = "sample_id") -> DataFrame:
    """Add ``cluster_no``, ``cluster_id`` and ``cluster_size`` to ``(group..., node, root)``.

    Clusters are numbered by their smallest node as a string, within ``group``. Sizes come from a partial
    count per root. Only one row per cluster, not per node, takes part in the numbering, which is by ranges.
    """
    group = group or []
    sizes = found.groupBy(*group, "root").agg(F.count("*").cast("int").alias("cluster_size"))
    ids = numbered(sizes, ["root"], "cluster_no", group).withColumn("cluster_no", F.col("cluster_no").cast("int"))
    ids = ids.withColumn("cluster_id", cluster_name(F.col("cluster_no")))
    return found.join(ids, [*group, "root"]).select(*group, node, "cluster_no", "cluster_id", "cluster_size")


def cluster_stats(clusters: DataFrame, group: list[str] | None = None) -> DataFrame:
    """Nodes, clusters, multi-member clusters, singletons and the largest size."""
    multi = F.col("cluster_size") > 1
    return clusters.groupBy(*(group or [])).agg(
        F.count("*").alias("n_nodes"),
        F.count_distinct("cluster_id").alias("n_clusters"),
        F.count_distinct(F.when(multi, F.col("cluster_id"))).alias("n_multi"),
        F.count_if(~multi).alias("n_singletons"),
        F.max("cluster_size").alias("largest"),
    )


def hide_singletons(nodes: DataFrame, links: DataFrame, node: str = "sample_id") -> tuple[DataFrame, DataFrame]:
    """Nodes of clusters with at least two members, and the links with both ends among them."""
    kept = nodes.filter("cluster_size > 1")
    return kept, valid_links(kept, links, node)


def valid_links(nodes: DataFrame, links: DataFrame, node: str = "sample_id") -> DataFrame:
    """Links whose two ends are listed nodes."""
    ids = nodes.select(node).distinct()
    out = links.join(ids.withColumnRenamed(node, "source"), "source", "left_semi")
    return out.join(ids.withColumnRenamed(node, "target"), "target", "left_semi").select(links.columns)
