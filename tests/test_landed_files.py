"""Landed files of every shape: folders, patterns, broken files and records; the stream gives the rows of the batch."""

import json
import os

import pytest
from pyspark.sql import functions as F

from seriesmill.sources import landed as L
from seriesmill.streaming import engine as E

DOCS = {
    "points": {
        "a/one.json": '[{"date": "2024-01-01", "value": 1.5}, {"date": "2024-01-02", "price": "2"}, {"date": "1/3/2024", "value": 3}, {"date": "2024-01-04", "value": "n/a"}, {"value": 1}]',
        "a/b/one.json": '[{"date": "2024-02-01", "value": 7}]', "a/empty.json": " \n", "a/no byte.json": "", "a/no list.json": '{"x": 1}', "a/broken+.json": '[{"date": "2024-01-01", "va', "a/none.json": "[]",
    },
    "pairs": {"p.json": '[["2024-01-01", 1], ["2024-01-02", "x"], ["2024-01-03"], ["?", 2]]', "q.json": "[[", "r.json": "[]"},
    "series": {"s.json": json.dumps({"Results": {"series": [{"seriesID": "A", "data": [{"year": "2024", "period": "M01", "value": "1"}, {"year": "2024", "period": "M13", "value": "2"},
               {"year": "2024", "period": "M02", "value": "NaN"}]}, {"seriesID": "B", "data": []}]}}), "t.json": '{"Results": {}}'},
    "parallel": {"x.json": '{"labels": ["a", "b"], "datasets": [{"label": "s", "data": [1, null]}, {"label": "t", "data": [1]}]}', "y.json": '{"labels": []}'},
    "quotes": {"q1.json": '{"chart": {"result": [{"meta": {"regularMarketPrice": 2.5, "chartPreviousClose": 2}}]}}', "q2.json": '{"chart": {"result": []}}',
               "q3.json": '{"chart": {"result": [{"meta": {}}]}}', "q4.json": "{"},
    "cards": {"c.json": '{"FX": [{"name": "Euro", "ticker": "E", "price": 1.1, "trend": [1, 2]}, {"name": "Yen"}], "Gold": []}', "d.json": "{}"},
}
WANT = {
    "points": [("one.json", "2024-01-01", 1.5, None), ("one.json", "2024-01-02", 2.0, None), ("one.json", None, 3.0, "no date: 1/3/2024"), ("one.json", "2024-01-04", None, "no number: n/a"),
               ("one.json", None, 1.0, "no date: nothing"), ("one.json", "2024-02-01", 7.0, None), ("empty.json", None, None, "no document"), ("no list.json", None, None, "no point in document"),
               ("broken+.json", None, None, "malformed document"), ("none.json", None, None, "no point in document")],
    "pairs": [("p.json", "2024-01-01", 1.0, None), ("p.json", "2024-01-02", None, "no number: x"), ("p.json", "2024-01-03", None, "no number: nothing"), ("p.json", None, 2.0, "no date: ?"),
              ("q.json", None, None, "malformed document"), ("r.json", None, None, "no pair in document")],
    "series": [("s.json", "2024-01-01", 1.0, None), ("s.json", None, 2.0, "no date: 2024 M13"), ("s.json", "2024-02-01", None, "no number: NaN"), ("s.json", None, None, "no point in series"),
               ("t.json", None, None, "no series in document")],
    "parallel": [("x.json", "a", 1.0, None), ("x.json", "b", None, None), ("x.json", "a", 1.0, "1 values for 2 labels"), ("x.json", "b", None, "1 values for 2 labels"), ("y.json", None, None, "no series in document")],
    "quotes": [("q1.json", None, 2.5, None), ("q2.json", None, None, "no result in document"), ("q3.json", None, None, "no price in document"), ("q4.json", None, None, "malformed document")],
    "cards": [("c.json", "Euro", 1.1, None), ("c.json", "Yen", None, "no price on card"), ("c.json", None, None, "no price on card"), ("d.json", None, None, "no card in document")],
}
NAME = {"points": "date", "pairs": "date", "series": "date", "parallel": "label", "quotes": None, "cards": "name"}
VALUE = {"quotes": "price", "cards": "price"}


def land(folder, kind):
    for name, text in DOCS[kind].items():
        path = folder / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_text(text)


def rows_of(df, kind):
    out = []
    for r in df.collect():
        name = r[NAME[kind]] if NAME[kind] else None
        out.append((r.file.rsplit("/", 1)[-1], None if name is None else str(name), r[VALUE.get(kind, "value")], r.reason))
    return sorted(out, key=str)


@pytest.mark.parametrize("kind", sorted(DOCS))
def test_batch_and_stream_give_the_same_rows(spark, tmp_path, kind):
    src = tmp_path / "in"
    land(src, kind)
    batch = L.read_landed(spark, [str(src)], kind)
    assert rows_of(batch, kind) == sorted(WANT[kind], key=str)
    out, cp = str(tmp_path / "out"), str(tmp_path / "cp")
    stream = lambda: E.run_to_table(L.stream_landed(spark, str(src), kind, 1), kind, out, cp)
    everything = lambda df: sorted(map(str, df.collect()))
    assert everything(stream()) == everything(batch)
    assert everything(stream()) == everything(batch), "a restarted stream reads no file again"
    assert sum(r.records for r in L.bad(batch).collect()) + L.good(batch).count() == len(WANT[kind])


def test_patterns_several_folders_and_the_newest(spark, tmp_path):
    for folder, when, text in (("x", 1_700_000_000, '[{"date": "2024-01-01", "value": 1}, {"date": "2024-01-02", "value": 1}]'), ("y", 1_600_000_000, '[{"date": "2024-01-01", "value": 2}, {"date": "2024-01-03", "value": 2}]')):
        (tmp_path / folder).mkdir()
        (tmp_path / folder / "same.json").write_text(text)
        os.utime(tmp_path / folder / "same.json", (when, when))
    both = L.read_landed(spark, [str(tmp_path / "x"), str(tmp_path / "y"), str(tmp_path / "*")], "points")
    assert both.count() == 4, "a file that two paths reach comes once"
    got = L.newest(both, ["date"], ["value"]).collect()
    assert sorted((str(r.date), r.value) for r in got) == [("2024-01-01", 1.0), ("2024-01-02", 1.0), ("2024-01-03", 2.0)]
    assert L.read_landed(spark, [str(tmp_path / "[x]")], "points").count() == 2


def test_what_lands_later_comes_with_the_next_run(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    (src / "1.json").write_text('[{"date": "2024-01-01", "value": 1}]')
    run = lambda: E.run_to_table(L.stream_landed(spark, str(src), "points"), "later", str(tmp_path / "o"), str(tmp_path / "c")).count()
    assert run() == 1
    (src / "2.json").write_text('[{"date": "2024-01-02", "value": 1}, {"date": "2024-01-03", "value": 1}]')
    assert run() == 3


def test_plans_are_narrow(spark, tmp_path):
    land(tmp_path, "points")
    plan = L.PARSERS["points"](L._bodies(spark.read.format("text").options(**L._WHOLE).load(str(tmp_path))))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan
