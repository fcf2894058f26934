"""Connected components of a link table by alternating star contractions.

Every round links each node's larger neighbours to its smallest neighbour
(large star), then its smaller neighbours (small star), until the edges no
longer change; they then point from each node to the smallest of its
component. Rounds are written to the shared folder, which cuts the lineage.
Only two sums per round reach the driver. Links of a node with itself and
repeated links change nothing; ends are never null; no links give no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farecast.session import scratch_path


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges (u, v) with u > v.

    The smallest neighbours are written before the edges meet them: edges are then shuffled for that
    join alone, and those of a node with very many can be split over tasks."""
    spark = edges.sparkSession
    both = edges.union(edges.select(F.col("v"), F.col("u"))) if large else edges
    least, path = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), scratch_path(spark, "components-least")
    least.write.parquet(path)
    least = spark.read.schema(least.schema).parquet(path)
    got = both.join(least, "u")
    if large:  # larger neighbours go to the smallest
        return got.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    # smaller neighbours, and the node itself, go to the smallest
    return got.select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).where("u > v")


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, comp) for every node of a link that is not its component's smallest."""
    spark = links.sparkSession

    def save(df: DataFrame) -> tuple[DataFrame, tuple]:
        path = scratch_path(spark, "components")
        df.distinct().write.parquet(path)
        out = spark.read.schema(df.schema).parquet(path)
        row = out.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        return out, tuple(row)

    edges, seen = save(
        links.where(F.col(a) != F.col(b)).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
    )
    while seen[0]:
        edges, now = save(_star(_star(edges, True), False))
        if now == seen:
            break
        seen = now
    return edges.select(F.col("u").alias("node"), F.col("v").alias("comp"))
