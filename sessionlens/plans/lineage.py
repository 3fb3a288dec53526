"""Lineage: the ``ref()`` edges of models and checks, and what follows from them.

An edge says that a node (a model or a check) reads another one. The closure of
the edges is a recursive query over that table; it walks each path once, stops
where a path would meet a node again, and reports a model that reaches itself
as part of a cycle. The edges are metadata (one row per declared reference), so
the closure is bounded by the declarations, not by the data.

A check is attributed to the first *model* among the things it reads, in the
order in which it reads them (a source in front of it is passed over); the
models below that one are what its failure may have spoiled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionlens import config as C
from sessionlens.plans.checks import Check
from sessionlens.plans.governance import owner_of

SOURCE = "source.events"
# What each model reads, in order (the ``ref()`` and ``source()`` calls).
MODEL_REFS = (
    ("stg_ga4__events", (SOURCE,)),
    ("fct_sessions", ("stg_ga4__events",)),
    ("funnel_conversion", ("fct_sessions",)),
    ("retention_cohorts", ("fct_sessions",)),
    ("rfm_segments", ("fct_sessions",)),
    ("session_quality_flags", ("fct_sessions",)),
)
EDGE = "node string, kind string, ref string, place int"


def edge_rows(suite: tuple[Check, ...], model_refs=MODEL_REFS) -> list[tuple[str, str, str, int]]:
    nodes = [(m, "model", refs) for m, refs in model_refs] + [(c.name, "check", c.refs or (c.model,)) for c in suite]
    return [(node, kind, ref, place) for node, kind, refs in nodes for place, ref in enumerate(refs, 1)]


def edges(spark: SparkSession, suite: tuple[Check, ...], model_refs=MODEL_REFS) -> DataFrame:
    """(node, kind, ref, place): one row per declared reference."""
    return spark.createDataFrame(edge_rows(suite, model_refs), EDGE)


def closure(edges: DataFrame) -> DataFrame:
    """(model, descendant, distance) for every model or source and each model
    that reads it, directly or not; ``distance`` counts the references on the
    shortest way. A node on a cycle is its own descendant."""
    return edges.sparkSession.sql(
        """
        with recursive walk(model, node, distance, path, closed) as (
            select ref, node, 1, array(ref, node), node = ref from {refs}
            union all
            select w.model, e.node, w.distance + 1, array_append(w.path, e.node), e.node = w.model
            from walk w join {refs} e on e.ref = w.node
            where not w.closed and (e.node = w.model or not array_contains(w.path, e.node))
        )
        select model, node as descendant, cast(min(distance) as bigint) as distance from walk group by model, node
        """,
        refs=edges.where(F.col("kind") == "model").select("node", "ref"),
    )


def cycles(edges: DataFrame) -> DataFrame:
    """(model, length) of each model that reaches itself; empty when the
    references are a graph without cycles, as they have to be."""
    return closure(edges).where(F.col("model") == F.col("descendant")).select("model", F.col("distance").alias("length"))


def attributed(edges: DataFrame) -> DataFrame:
    """(check, model): the first model that each check reads, null if none."""
    models = edges.where(F.col("kind") == "model").select(F.col("node").alias("ref")).distinct().withColumn("is_model", F.lit(True))
    # Both tables have a row per declared reference.
    read = edges.where(F.col("kind") == "check").join(F.broadcast(models), "ref", "left")
    return read.groupBy(F.col("node").alias("check")).agg(F.min_by("ref", F.when(F.col("is_model"), F.col("place"))).alias("model"))


def _listed(column: str):
    return F.array_join(F.array_sort(F.collect_set(column)), ", ")


def alert_impact(results: DataFrame, edges: DataFrame, registry: DataFrame) -> DataFrame:
    """Each open check of a run, attributed to its model through the edges, with
    that model's owner, the models downstream of it and their owners."""
    owners = owner_of(registry).withColumnRenamed("alert_owner", "owner")
    below = closure(edges).join(F.broadcast(owners.select(F.col("model").alias("descendant"), "owner")), "descendant", "left")
    below = below.where(F.col("descendant") != F.col("model")).groupBy("model").agg(
        F.count(F.lit(1)).alias("n_downstream"), _listed("descendant").alias("downstream"), _listed("owner").alias("downstream_owners")
    )
    open_checks = results.where(F.col("status").isin(*C.ALERT_STATUSES)).select("run_id", "check", "status", "failures")
    # The joined tables have a row per check or per model.
    out = open_checks.join(F.broadcast(attributed(edges)), "check", "left")
    out = out.join(F.broadcast(owners), "model", "left").join(F.broadcast(below), "model", "left")
    return out.select(
        "run_id", "check", "status", "failures", "model", F.coalesce("owner", F.lit(C.UNOWNED)).alias("owner"),
        F.coalesce("n_downstream", F.lit(0)).cast("long").alias("n_downstream"), F.coalesce("downstream", F.lit("")).alias("downstream"),
        F.coalesce("downstream_owners", F.lit("")).alias("downstream_owners"),
    )


def model_lineage(results: DataFrame, edges: DataFrame, registry: DataFrame) -> DataFrame:
    """Each registered model with what it is built from, the checks of this run
    that are open on it and on its ancestors, and whether it is on a cycle. A
    model with an open check above it is tainted, however healthy its own
    checks are."""
    open_on = results.where(F.col("status").isin(*C.ALERT_STATUSES)).join(F.broadcast(attributed(edges)).withColumnRenamed("model", "on"), "check")
    open_on = F.broadcast(open_on.groupBy("on").agg(F.count(F.lit(1)).alias("open")))
    walked = closure(edges)
    above = walked.where(F.col("descendant") != F.col("model")).join(open_on, F.col("model") == F.col("on"), "left")
    above = above.groupBy(F.col("descendant").alias("model")).agg(
        F.count(F.lit(1)).alias("n_upstream"), _listed("model").alias("upstream"), F.sum(F.coalesce("open", F.lit(0))).alias("open_upstream")
    )
    looped = walked.where(F.col("model") == F.col("descendant")).select("model", F.lit(True).alias("in_cycle"))
    out = registry.select("model", "layer").join(F.broadcast(above), "model", "left").join(F.broadcast(looped), "model", "left")
    out = out.join(open_on, F.col("model") == F.col("on"), "left")
    zero = F.lit(0)
    return out.select(
        "model", "layer", F.coalesce("n_upstream", zero).cast("long").alias("n_upstream"), F.coalesce("upstream", F.lit("")).alias("upstream"),
        F.coalesce("open", zero).cast("long").alias("open_checks"), F.coalesce("open_upstream", zero).cast("long").alias("open_upstream"),
        (F.coalesce("open_upstream", zero) > 0).alias("tainted"), F.coalesce("in_cycle", F.lit(False)).alias("in_cycle"),
    )
