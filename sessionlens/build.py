"""One build over one input folder: the DAG of models as lazy DataFrames.

``Build(spark, sf_dir)`` wires source -> staged -> sessions -> marts the way
the reference's ``ref()`` graph does. Everything is lazy; the sessions mart
is the only model several consumers read, so ``materialize_sessions=True``
writes it once to the shared folder (the reference materialises it as a
table) and every consumer then scans that table.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

from sessionlens.config import DEFAULT, Params
from sessionlens.operators import funnel, quality_flags, retention, rfm, sessions, staging
from sessionlens.runtime import configure, materialize
from sessionlens.sources import driver_tables


class Build:
    def __init__(
        self,
        spark: SparkSession,
        sf_dir: str,
        params: Params = DEFAULT,
        materialize_sessions: bool = False,
    ) -> None:
        self.spark = configure(spark)
        self.sf_dir = sf_dir
        self.params = params
        self.materialize_sessions = materialize_sessions

    # -- sources ----------------------------------------------------------
    @cached_property
    def raw(self) -> DataFrame:
        """Raw nested events of the window (the source)."""
        p = self.params
        return driver_tables.raw_events(self.spark, self.sf_dir, p.start_day, p.end_day)

    def table(self, name: str) -> DataFrame:
        return driver_tables.table(self.spark, self.sf_dir, name)

    # -- models -----------------------------------------------------------
    @cached_property
    def staged(self) -> DataFrame:
        p = self.params
        return staging.stage_events(self.raw, p.start_day, p.end_day)

    @cached_property
    def sessions(self) -> DataFrame:
        df = sessions.build_sessions(self.staged)
        return materialize(df, "fct_sessions") if self.materialize_sessions else df

    @cached_property
    def core(self) -> DataFrame:
        """Sessions for the marts that use no attribute: the written table if
        there is one, else the rollup without attributes."""
        return self.sessions if self.materialize_sessions else sessions.session_core(self.staged)

    @cached_property
    def funnel(self) -> DataFrame:
        return funnel.funnel_conversion(self.core)

    @cached_property
    def retention(self) -> DataFrame:
        p = self.params
        return retention.retention_cohorts(self.core, p.retention_weeks, (p.start_day, p.end_day))

    @cached_property
    def rfm_scored(self) -> DataFrame:
        p = self.params
        return rfm.rfm_scored(self.core, p.as_of, p.n_tiles, p.ntile_method)

    @cached_property
    def rfm(self) -> DataFrame:
        return rfm.with_segment(self.rfm_scored)

    @cached_property
    def flags(self) -> DataFrame:
        return quality_flags.session_quality_flags(self.core)

    def models(self) -> "Models":
        """The models by name; each is built on first access only."""
        return Models(self)


class Models(Mapping):
    """Read-only name -> DataFrame view of a build, built on first access
    (a check suite over two models does not build the other four)."""

    _ATTR = {
        "stg_ga4__events": "staged",
        "fct_sessions": "sessions",
        "funnel_conversion": "funnel",
        "retention_cohorts": "retention",
        "rfm_segments": "rfm",
        "session_quality_flags": "flags",
    }

    def __init__(self, build: Build) -> None:
        self._build = build

    def __getitem__(self, name: str) -> DataFrame:
        return getattr(self._build, self._ATTR[name])

    def __iter__(self):
        return iter(self._ATTR)

    def __len__(self) -> int:
        return len(self._ATTR)
