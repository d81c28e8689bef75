"""Connected components by label hooking and pointer doubling."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tabloom.session import stash

LABEL_SALTS = 16


def _follow(table: DataFrame, key: str, mapping: DataFrame) -> DataFrame:
    """Replace key by mapping(lab -> to); _open tells whether it was mapped.

    Labels get hot as components grow, so both sides are salted.
    """
    salts = F.explode(F.sequence(F.lit(0), F.lit(LABEL_SALTS - 1)))
    spread = mapping.select(F.col("lab").alias("_from"), F.col("to").alias("_to"), salts.alias("_s2"))
    salted = table.withColumn("_s1", F.pmod(F.xxhash64("node"), F.lit(LABEL_SALTS)).cast("int"))
    on = (F.col(key) == F.col("_from")) & (F.col("_s1") == F.col("_s2"))
    joined = salted.join(spread, on, "left").withColumns({"_open": F.col("_to").isNotNull(), key: F.coalesce("_to", F.col(key))})
    return joined.drop("_s1", "_s2", "_from", "_to")


def _to_the_end(moves: DataFrame) -> DataFrame:
    """Follow chains of moves to their last label; the reach doubles with every step."""
    while True:
        step = stash(_follow(moves.withColumn("node", F.col("lab")), "to", moves).drop("node"))
        if step.filter("_open").isEmpty():
            return moves
        moves = step.drop("_open")


def connected_components(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """(node, lab): the smallest node of each component. nodes has node; edges has u, v, each pair once."""
    both = stash(edges.select("u", "v").union(edges.select("v", "u")))
    labels = stash(nodes.select("node", F.col("node").alias("lab")))
    while True:
        seen = both.join(labels, both["v"] == labels["node"]).groupBy("u").agg(F.min("lab").alias("_near"))
        hooked = labels.join(seen, labels["node"] == seen["u"], "left").select("node", "lab", F.least("lab", F.coalesce("_near", "lab")).alias("_new"))
        # Every label moves to the smallest label any of its nodes touches.
        moves = stash(hooked.groupBy("lab").agg(F.min("_new").alias("to")).filter(F.col("to") < F.col("lab")))
        if moves.isEmpty():
            return labels
        labels = stash(_follow(labels, "lab", _to_the_end(moves)).drop("_open"))
