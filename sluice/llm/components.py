"""Connected components of an edge table, by alternating large and small stars.

Each step is a grouped minimum, which tasks combine before the shuffle, and a join that
adaptive execution splits at hot nodes; no neighbourhood is ever gathered. The edges of
each round are written to the shared folder, which also cuts the lineage, and the rounds
end when the edges no longer change, after about log(n) of them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from sluice.session import shared_folder


def landed(df: DataFrame, name: str) -> DataFrame:
    """The rows written to, and read from, a new folder that all executors share."""
    folder = shared_folder(df.sparkSession, name)
    df.write.parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def _minima(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("u").agg(F.min("v").alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u")).distinct()
    least = _minima(both).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct()
    least = _minima(down)
    others = down.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return others.union(least.select("u", F.col("m").alias("v"))).distinct()


def _mark(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """Columns node and component, the least node reachable, for every end of an edge.

    `edges` has two columns of one orderable type. Edges with a null end are ignored; loops
    and repeated edges change nothing, except that the node of a loop is listed.
    """
    u, v = edges.columns
    start = landed(edges.select(F.col(u).alias("u"), F.col(v).alias("v")).where("u IS NOT NULL AND v IS NOT NULL"), "edges")
    stars = landed(_small_star(start), "stars")
    mark = _mark(stars)
    while mark[0]:
        stars = landed(_small_star(_large_star(stars)), "stars")
        last, mark = mark, _mark(stars)
        if mark == last:
            break
    nodes = start.select(F.col("u").alias("node")).union(start.select("v")).distinct()
    found = stars.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("m"))
    return nodes.join(found, "node", "left_outer").select("node", F.coalesce("m", "node").alias("component"))
