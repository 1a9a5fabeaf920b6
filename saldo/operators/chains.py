"""Chains of replaced cards: fixed-length tests and full closure."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from saldo.operators.guards import require_unique
from saldo.session import scratch_path, staged


def chain_of(edges: DataFrame, hops: int) -> DataFrame:
    """Cards from which a chain of at least ``hops`` replacements starts: the first hop's date and
    the number of such chains.

    Chains are counted backwards. Every step joins the edges to one row per card and sums again per
    card, so neither side fans out, whatever the number of chains through a card. The counts of a
    step are staged, so that a card which very many edges lead to is split in the next join.
    """
    steps = edges.select(F.col("old_card").alias("card"), F.col("new_card").alias("next"), "dt")
    reach = None
    for _ in range(hops):
        if reach is None:
            counted = steps.withColumn("n", F.lit(1).cast("decimal(38,0)"))
        else:
            ahead = staged(reach, "reach").select(F.col("card").alias("next"), F.col("chains").alias("n"))
            counted = steps.join(ahead, "next")
        reach = counted.groupBy("card").agg(
            F.min("dt").alias("dt"), F.sum("n").cast("decimal(38,0)").alias("chains")
        )
    return reach


def change_decision(cards: DataFrame, edges: DataFrame, hops: int = 5, months: int = 12,
                    on_many: str = "error") -> DataFrame:
    """For every card: may it be changed now, and if not, from which date.

    More than one chain from a card is an error, as for a scalar lookup, or with ``first`` the
    earliest first hop counts.
    """
    if on_many not in ("error", "first"):
        raise ValueError("on_many is error or first")
    held = chain_of(edges, hops)
    start = F.col("dt")
    if on_many == "error":
        message = F.concat(F.lit("several chains from card "), F.col("card").cast("string"))
        start = F.when(F.col("chains") > 1, F.raise_error(message)).otherwise(start)
    return cards.join(held, "card", "left").select(
        "card",
        F.col("dt").isNull().alias("allowed"),
        F.add_months(start, months).alias("next_date"),
    )


def chain_closure(edges: DataFrame) -> DataFrame:
    """Length and last card of the chain that starts at every card; ``cyclic``, without length and last card, where
    the chain is a ring or runs into one.

    Pointer doubling: after round r a pointer spans 2^r hops and knows the least card among them. The next 2^r hops, which a
    round joins to it, are other cards unless the chain comes round; so a least card that is in both halves tells a ring,
    and on a ring of at most 2^r cards both halves hold its least card. A pointer that lands on a cyclic card is
    cyclic. So the number of rounds is the logarithm of the longest chain, ring or tail, whatever the number of
    cards. A round joins and writes only pointers that can still move.
    """
    spark = edges.sparkSession
    hops = require_unique(
        edges.select(F.col("old_card").alias("card"), F.col("new_card").alias("last")), ["card"]
    ).withColumns({"length": F.lit(1).cast("long"), "least": F.col("last"), "cyclic": F.lit(False)})
    # a pointer to a card that was never replaced has arrived
    olds = hops.select(F.col("card").alias("last"), F.lit(True).alias("moves"))
    linked = hops.join(olds, "last", "left").withColumn("moves", F.coalesce("moves", F.lit(False)))
    columns = ["card", "last", "length", "least", "cyclic", "moves"]
    written = []
    moved = linked.select(*columns)
    while True:
        path = scratch_path(spark, "pointers")
        moved.write.parquet(path)
        written.append(path)
        # every round's folder in one scan; a card arrives in one of them
        arrived = spark.read.schema(moved.schema).parquet(*written).filter("not moves")
        moving = spark.read.schema(moved.schema).parquet(path).filter("moves")
        if moving.isEmpty():
            break
        ahead = arrived.unionByName(moving).select(
            F.col("card").alias("last"), F.col("last").alias("far"), F.col("length").alias("more"),
            F.col("least").alias("other"), F.col("moves").alias("on"), F.col("cyclic").alias("round"),
        )
        ring = F.col("round") | (F.col("on") & (F.col("least") == F.col("other")))
        moved = moving.join(ahead, "last").select(
            "card", F.col("far").alias("last"), (F.col("length") + F.col("more")).alias("length"),
            F.least("least", "other").alias("least"), ring.alias("cyclic"), (F.col("on") & ~ring).alias("moves"),
        )
    return arrived.select(
        "card",
        F.when(~F.col("cyclic"), F.col("length")).alias("length"),
        F.when(~F.col("cyclic"), F.col("last")).alias("last_card"),
        "cyclic",
    )
