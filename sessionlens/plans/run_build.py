"""Build, test and report in one run (the reference's ``build`` command).

Marts are written once as Parquet tables (a new version that replaces the old
one when it is complete, see sources/publish.py) and read back; staging and
observability models are registered as temp views (recomputed on read). Checks
that the writes can measure are measured by them, the rest of the suite runs
against the written tables; the results, the owner-tagged alerts and the
governance gate are written next to them. The
check-results table is partitioned by run id and appended to, so it keeps the
history of runs.

    python -m sessionlens.plans.run_build --sf /root/testdata/sf0.01 --out <shared folder>
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from sessionlens.build import Build
from sessionlens.config import DEFAULT, Params
from sessionlens.plans import checks as CK
from sessionlens.plans import governance as GV
from sessionlens.plans import observed as OB
from sessionlens.sources.publish import publish

MARTS = ("fct_sessions", "funnel_conversion", "retention_cohorts", "rfm_segments")
VIEWS = ("stg_ga4__events", "session_quality_flags")


def register_views(models, names=VIEWS, suffix: str = "") -> dict[str, str]:
    """Staging and observability models as temp views for SQL users: model ->
    view name. A ``suffix`` keeps builds of one session apart."""
    views = {name: f"{name}{suffix}" for name in names}
    for name, view in views.items():
        models[name].createOrReplaceTempView(view)
    return views


def build_and_test(spark: SparkSession, sf_dir: str, out_dir: str, params: Params = DEFAULT) -> dict[str, DataFrame]:
    out = out_dir.rstrip("/")
    b = Build(spark, sf_dir, params)
    built = b.models()
    tables: dict[str, DataFrame] = {}
    measured: dict[str, int] = {}
    suite = CK.default_suite(params.flag_rate_max, params.volume_min, params.volume_max)
    # Sessions first: every other mart is computed from the written table. A mart
    # is written as a new version, which its readers get when it is complete.
    for name in MARTS:
        src = built[name] if name == "fct_sessions" else _from_sessions(b, tables["fct_sessions"], name)
        found: list[OB.Written] = []
        publish(spark, f"{out}/{name}", lambda p, src=src, name=name: found.append(OB.write_measured(GV.document(src, name), p, name, suite)))
        tables[name] = found[0].table
        measured |= found[0].failures
    flags = _from_sessions(b, tables["fct_sessions"], "session_quality_flags")
    models = {"stg_ga4__events": b.staged, "session_quality_flags": flags, **tables}
    register_views(models)

    results = CK.check_results(models, suite, params.run_id, raw=b.raw, measured=measured)
    # Dynamic overwrite replaces this run's partition only; history stays.
    results.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").parquet(
        f"{out}/check_results"
    )
    results = spark.read.parquet(f"{out}/check_results").where(f"run_id = '{params.run_id}'")

    registry = GV.model_registry(spark)
    alerts = GV.owner_alerts(results, registry)
    gaps = GV.governance_gaps(registry, results)
    alerts.write.mode("overwrite").parquet(f"{out}/owner_alerts")
    gaps.write.mode("overwrite").parquet(f"{out}/governance_gaps")
    return {**models, "check_results": results, "owner_alerts": alerts, "governance_gaps": gaps}


def _from_sessions(b: Build, sessions: DataFrame, name: str) -> DataFrame:
    from sessionlens.operators import funnel, quality_flags, retention, rfm

    p = b.params
    if name == "funnel_conversion":
        return funnel.funnel_conversion(sessions)
    if name == "retention_cohorts":
        return retention.retention_cohorts(sessions, p.retention_weeks, (p.start_day, p.end_day))
    if name == "rfm_segments":
        return rfm.rfm_segments(sessions, p.as_of, p.n_tiles, p.ntile_method)
    if name == "session_quality_flags":
        return quality_flags.session_quality_flags(sessions)
    raise KeyError(name)


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__)
    ap.add_argument("--sf", required=True, help="folder with the driver tables")
    ap.add_argument("--out", required=True, help="output folder (shared storage on a cluster)")
    ap.add_argument("--run-id", default=DEFAULT.run_id)
    args = ap.parse_args(argv)
    from dataclasses import replace

    from sessionlens.runtime import CLUSTER_SETTINGS, configure, drop_tables

    spark = configure(SparkSession.builder.config(map=CLUSTER_SETTINGS).getOrCreate())
    res = build_and_test(spark, args.sf, args.out, replace(DEFAULT, run_id=args.run_id))
    for row in res["owner_alerts"].select("alert").collect():  # one row per alert: bounded by the suite
        print(row.alert)
    gaps = res["governance_gaps"].where("not compliant").count()
    print(f"governance: {gaps} governed model(s) miss standards")
    drop_tables(spark)


if __name__ == "__main__":
    main()
