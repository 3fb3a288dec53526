"""Connected components of a link table, as DataFrame rounds.

Every round takes the smallest label among a node's neighbours and then the
label of that label (path halving), so labels travel ever longer steps. Labels
of few nodes (by count) are broadcast; of many, those of hubs and of large
components are (few by count), and the rest is joined by shuffle. Each round is
checkpointed into the shared folder, in as many files as its rows need; nothing
is collected but counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionlens import runtime
from sessionlens.llm.common import BROADCAST_ROWS, HEAVY, joined, parts_of


def components(links: DataFrame) -> DataFrame:
    """(node, label) for each node of ``links`` (a, b): the smallest node that
    it reaches. Nulls and self links are ignored."""
    runtime.shared_dir(links.sparkSession)
    links = links.where(F.col("a") != F.col("b")).select(F.col("a").cast("long").alias("a"), F.col("b").cast("long").alias("b"))
    parts = parts_of(2 * links.count())
    edges = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().coalesce(parts).checkpoint()
    met = edges.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"), F.count("*").alias("degree")).coalesce(parts).checkpoint()
    n, ends = met.agg(F.count("*"), F.coalesce(F.sum("degree"), F.lit(0))).first()
    degree = met.select(F.col("node").alias("b"), "degree")
    labels = met.select("node", F.least("node", "m").alias("label"))
    while True:
        # The labels of a node's neighbours and its own; a hub has a large part
        # of the edges.
        given = labels.select(F.col("node").alias("b"), "label")
        if n <= BROADCAST_ROWS:
            told = edges.join(F.broadcast(given), "b")
        else:
            told = joined(edges, given.join(degree, "b"), ["b"], F.col("degree") >= ends / HEAVY)
        own = labels.select("node", "label", F.col("label").alias("old"))
        told = told.select(F.col("a").alias("node"), "label", F.lit(None).cast("long").alias("old")).unionByName(own)
        stepped = told.groupBy("node").agg(F.min("label").alias("label"), F.max("old").alias("old")).coalesce(parts).checkpoint()
        # The label's own label; a large component's label has many rows.
        further = stepped.select(F.col("node").alias("label"), F.col("label").alias("further"))
        if n <= BROADCAST_ROWS:
            moved = stepped.join(F.broadcast(further), "label")
        else:
            held = stepped.groupBy("label").agg(F.count("*").alias("held"))
            moved = joined(stepped, further.join(held, "label"), ["label"], F.col("held") >= n / HEAVY)
        moved = moved.select("node", "old", F.least("label", "further").alias("label")).coalesce(parts).checkpoint()
        labels = moved.select("node", "label")
        if moved.where(F.col("old") != F.col("label")).isEmpty():
            return labels
