"""Attribution, descendants and cycles over hand-made reference edges."""

from __future__ import annotations

from conftest import SF0001

import __spark_entry__ as E
from sessionlens.plans import lineage as LN
from sessionlens.plans.checks import Check
from sessionlens.plans.governance import MODELS, model_registry
from sessionlens.schemas import CHECK_RESULT

REFS = (("stg", ("source.x",)), ("fct", ("stg", "dim")), ("dim", ("stg",)), ("mart", ("fct", "dim")), ("alone", ("source.x",)))
SUITE = (
    Check("first_is_a_source", "stg", "volume", refs=("source.x", "fct", "stg")),
    Check("on_dim", "dim", "not_null", "k"),
    Check("only_a_source", "?", "volume", refs=("source.x",)),
    Check("passes", "mart", "volume"),
)
OWNERS = [("stg", "staging", None, None, "d"), ("fct", "marts", "team a", "@a", "d"), ("dim", "marts", "team b", "", "d"), ("mart", "marts", None, None, "d"),
          ("alone", "marts", "team b", None, "d")]


def results(spark, *open_checks):
    rows = [("r", c.name, c.model, c.column, "error", 1 if c.name in open_checks else 0, "fail" if c.name in open_checks else "pass", "") for c in SUITE]
    return spark.createDataFrame(rows, CHECK_RESULT)


def test_descendants_by_shortest_way(spark):
    got = {(r.model, r.descendant): r.distance for r in LN.closure(LN.edges(spark, SUITE, REFS)).collect()}
    assert got == {
        ("source.x", "stg"): 1, ("source.x", "alone"): 1, ("source.x", "fct"): 2, ("source.x", "dim"): 2, ("source.x", "mart"): 3,
        ("stg", "fct"): 1, ("stg", "dim"): 1, ("stg", "mart"): 2, ("dim", "fct"): 1, ("dim", "mart"): 1, ("fct", "mart"): 1,
    }
    assert LN.cycles(LN.edges(spark, SUITE, REFS)).count() == 0


def test_cycles_are_reported_and_the_walk_ends(spark):
    looped = LN.edges(spark, (), (("a", ("d", "s")), ("b", ("a",)), ("c", ("b",)), ("d", ("b", "d")), ("e", ("c",))))
    assert {(r.model, r.length) for r in LN.cycles(looped).collect()} == {("a", 3), ("b", 3), ("d", 1)}
    assert {r.descendant for r in LN.closure(looped).where("model = 's'").collect()} == set("abcde")


def test_first_model_read_is_the_subject(spark):
    got = {r.check: r.model for r in LN.attributed(LN.edges(spark, SUITE, REFS)).collect()}
    assert got == {"first_is_a_source": "fct", "on_dim": "dim", "only_a_source": None, "passes": "mart"}


def test_impact_names_everyone_downstream(spark):
    impact = LN.alert_impact(
        results(spark, "first_is_a_source", "on_dim", "only_a_source"), LN.edges(spark, SUITE, REFS), model_registry(spark, OWNERS)
    )
    got = {r.check: (r.model, r.owner, r.n_downstream, r.downstream, r.downstream_owners) for r in impact.collect()}
    assert got == {
        "first_is_a_source": ("fct", "@a", 1, "mart", "unowned"),
        "on_dim": ("dim", "team b", 2, "fct, mart", "@a, unowned"),
        "only_a_source": (None, "unowned", 0, "", ""),
    }


def test_a_model_below_an_open_check_is_tainted(spark):
    lineage = LN.model_lineage(results(spark, "on_dim"), LN.edges(spark, SUITE, REFS), model_registry(spark, OWNERS))
    got = {r.model: (r.upstream, r.open_checks, r.open_upstream, r.tainted, r.in_cycle) for r in lineage.collect()}
    assert got == {
        "stg": ("source.x", 0, 0, False, False), "dim": ("source.x, stg", 1, 0, False, False), "fct": ("dim, source.x, stg", 0, 1, True, False),
        "mart": ("dim, fct, source.x, stg", 0, 1, True, False), "alone": ("source.x", 0, 0, False, False),
    }


def test_declared_references_cover_the_registry(spark):
    assert {m for m, _ in LN.MODEL_REFS} == {m[0] for m in MODELS}
    impact = {r.check: r for r in E.queries()["alert_impact"](spark, SF0001).collect()}
    assert impact["duplicate_param_keys_stg_ga4__events"].n_downstream == 5
    assert impact["duplicate_param_keys_stg_ga4__events"].model == "stg_ga4__events"
