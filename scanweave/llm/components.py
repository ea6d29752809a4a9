"""Connected components of a link table."""

from pyspark.sql import DataFrame, functions as F

from scanweave.llm.tables import landed


def components(links: DataFrame) -> DataFrame:
    """`node` and `component` (its smallest node) for every node of the links (`one`, `other`).

    Large-star and small-star rounds: every node points its larger, then its smaller neighbours at the
    smallest node it sees, until nothing changes. Each round is two aggregations with map-side combining
    and two joins, cut by written tables; no neighbourhood is ever gathered, so a node with very many
    links costs no more than the links themselves. Loops and repeated links do no harm; no links give
    no rows.
    """
    stars = landed(
        links.where("one <> other")
        .select(F.greatest("one", "other").alias("node"), F.least("one", "other").alias("centre"))
        .distinct(),
        "components",
    )
    before = None
    while True:
        state = stars.agg(F.count("*"), F.sum(F.xxhash64("node", "centre").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
        stars = landed(_small_star(_large_star(stars)), "components")
    return stars.select("node", F.col("centre").alias("component")).union(
        stars.select(F.col("centre").alias("node"), F.col("centre").alias("component")).distinct()
    )


def _large_star(stars: DataFrame) -> DataFrame:
    both = stars.union(stars.select(F.col("centre").alias("node"), F.col("node").alias("centre")))
    smallest = both.groupBy("node").agg(F.least(F.min("centre"), F.first("node")).alias("least"))
    # Larger neighbours of `node` move to the smallest node it sees.
    return (
        both.where("centre > node")
        .join(smallest, "node")
        .select(F.col("centre").alias("node"), F.col("least").alias("centre"))
        .distinct()
    )


def _small_star(stars: DataFrame) -> DataFrame:
    smallest = stars.groupBy("node").agg(F.min("centre").alias("least"))
    moved = stars.join(smallest, "node").select(F.col("centre").alias("node"), F.col("least").alias("centre"))
    return (
        moved.where("node <> centre")
        .union(smallest.select("node", F.col("least").alias("centre")))
        .distinct()
    )
