"""The driver contract in __spark_entry__.py."""

import os

import pytest

import __spark_entry__ as E


@pytest.mark.skipif(not os.path.isdir(E.SMOKE_DIR), reason="driver test data not present")
def test_entry_runs_flagship(spark):
    df = E.entry(spark)
    assert df.columns[:8] == ["province", "city", "district", "device_type", "release_channel", "app_version",
                              "os_name", "hour_segment"]
    assert {"session_cnt", "pv_cnt", "time_long", "uv_cnt", "grouping_id", "dy"} <= set(df.columns)
    assert df.count() > 0


def test_oracles_cover_registered_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    work = {k for k in q if k.startswith("w")}
    assert work <= set(o)
    assert all(callable(f) for f in q.values())
    # every work item W01..W37 has at least one registered query
    ids = {name.split("_")[0] for name in work}
    assert ids == {f"w{i:02d}" for i in range(1, 38)}
