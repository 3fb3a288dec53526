from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from sessionlens.runtime import local_session  # noqa: E402
from sessionlens.schemas import RAW_EVENT  # noqa: E402

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = local_session("sessionlens-tests", cores="*", shuffle_partitions=8)
    s.sparkContext.setLogLevel("ERROR")
    yield s


def micros(ts: str) -> int:
    """'YYYY-MM-DD HH:MM:SS' (UTC) -> epoch microseconds."""
    from datetime import datetime, timezone

    return int(datetime.strptime(ts, "%Y-%m-%d %H:%M:%S").replace(tzinfo=timezone.utc).timestamp() * 1_000_000)


_NEXT = [0]


def ev(
    user: str,
    sid: int | None,
    name: str | None,
    ts: str,
    day: str | None = None,
    page: str | None = "/home",
    revenue: float | None = None,
    params: list | None = None,
    device: str = "desktop",
    country: str = "Canada",
    medium: str = "organic",
    source: str = "google",
    event_id: int | None = None,
):
    """One raw event row in RAW_EVENT order. ``params`` overrides the two
    default params ((key, (string_value, int_value)) tuples)."""
    if event_id is None:
        _NEXT[0] += 1
        event_id = _NEXT[0]
    if params is None:
        params = []
        if sid is not None:
            params.append(("ga_session_id", (None, sid)))
        if page is not None:
            params.append(("page_location", (page, None)))
    day = day or ts[:10].replace("-", "")
    return (
        event_id,
        day,
        micros(ts),
        name,
        user,
        params,
        (device,),
        (country,),
        (medium, source),
        (revenue,),
        [],
    )


def raw_df(spark, rows):
    return spark.createDataFrame(rows, RAW_EVENT)
