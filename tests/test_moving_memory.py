"""However long a chunk is, a task computes on a few batches and the rows that they look back on."""

import numpy as np
import pandas as pd
import pytest

from seriesmill.operators import moving as M

KEYS, ORDER, BATCH, AT_ONCE = ["asset"], ["ts", "event_id"], 50, 100


@pytest.mark.parametrize("n, lag", [(1, 0), (12, 0), (12, 1), (400, 1)])
def test_no_task_computes_on_a_whole_chunk(spark, monkeypatch, n, lag):
    monkeypatch.setattr(M, "ROWS_AT_ONCE", AT_ONCE, raising=False)
    df = spark.range(4000).selectExpr("if(id % 10 < 7, 'hot', 'cold') AS asset", "id AS ts", "id AS event_id", "sin(id) AS y")

    def seen(mean, s, x, at):
        return {"at_once": np.full(len(at), float(len(at)))}

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH))
    try:
        out = M.moving(df, ["y"], n, seen, ["at_once"], KEYS, ORDER, lag, rows_per_chunk=1000).toPandas()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    back = n - 1 + lag
    assert sorted(out["event_id"]) == list(range(4000))
    assert out["at_once"].isna().sum() == 2 * back  # the first rows of either asset, and no others
    assert out["at_once"].max() <= BATCH + max(back, AT_ONCE) + back


@pytest.mark.parametrize("least", [0, 1, 30, 100, 10_000])
def test_batches_are_joined_up_to_the_window(least):
    rows = pd.DataFrame({"v": np.arange(500)})
    batches = [rows[i : i + 30] for i in range(0, 500, 30)]
    got = list(M._at_least(iter([rows[:0], *batches, rows[:0]]), least))
    assert pd.concat(got)["v"].tolist() == list(range(500))
    assert all(max(least, 1) <= len(g) < least + 30 + 1 for g in got[:-1])
    assert list(M._at_least(iter([]), least)) == []
