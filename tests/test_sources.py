"""Records of many shapes, and fallback for each key."""

from pyspark.sql import functions as F

from dealspark.operators import fallback
from dealspark.operators.shapes import Field, Shapes, split_records

SHAPES = Shapes([Field("name", aliases=("案例名称", "Title"), required=True), Field("n", "int"), Field("day", "date"), Field("done", "boolean", default=False), Field("kind", default="other")])


def test_three_shapes_lose_nothing(spark):
    texts = [
        ("array", '[{"name": "a", "n": 1, "day": "2024/02/29", "x": {"y": 1}}, {"Title": "b", "n": "1,200", "done": "是"}, 7, {"n": "many"}]'),
        ("list", '{"requested": 3, "rows": [{" NAME ": " c ", "day": "2024-13-01"}, null]}'),
        ("single", ' {"案例名称": "d", "name": "", "kind": "own", "done": "NO"}'),
        ("broken", '{"name": "e"'),
        ("half", '[{"name": "f"}, {"na'),
        ("empty list", "[]"),
        ("empty", ""),
        (None, None),
        ("text", "hello"),
    ]
    records = split_records(spark.createDataFrame(texts, "file string, body string"), "file", "body")
    good = {r["name"]: r for r in SHAPES.good(records).collect()}
    assert set(good) == {"a", "b", "d"}
    assert good["a"]["n"] == 1 and str(good["a"]["day"]) == "2024-02-29" and good["a"]["rest"] == {"x": '{"y":1}'} and good["a"]["done"] is False and good["a"]["kind"] == "other"
    assert good["b"]["n"] == 1200 and good["b"]["done"] is True and good["d"]["kind"] == "own" and good["d"]["done"] is False
    bad = {(r["source"], r["place"]): r["reasons"] for r in SHAPES.quarantine(records).collect()}
    assert bad[("array", 2)] == ["no object"] and bad[("array", 3)] == ["missing name", "bad n"] and bad[("list", 0)] == ["bad day"]
    assert bad[("broken", 0)] == ["no object"] and bad[("text", 0)] == ["no object"] and ("half", 0) in bad
    assert records.count() == len(good) + len(bad)
    missing = {(r["source"], r["field"]) for r in SHAPES.missing_columns(records).collect()}
    assert ("list", "n") in missing and ("list", "name") not in missing and ("array", "day") not in missing and {("text", f.name) for f in SHAPES.fields} <= missing


def test_fallback_by_key(spark):
    sources = spark.createDataFrame([("a", 1, "x", False), ("b", 2, "y", True), ("c", 3, "x", False), ("d", 4, "y", False), ("e", 5, None, None)], "source string, rank int, family string, failed boolean")
    assert {r["source"]: r["status"] for r in fallback.source_status(sources).collect()} == {"a": "live", "b": "failed", "c": "live", "d": "skipped", "e": "live"}
    items = [("k1", "c", "u1", 1), ("k1", "e", "u2", 2), ("k1", "e", "u1", 3), ("k2", "d", "u3", 4), ("k2", "b", "u3", 5), ("k3", "a", None, 6), ("k3", "a", None, 7), ("k3", "c", "u4", 8), (None, "a", "u5", 9), ("k4", "zz", "u6", 10), ("k1", "e", "u2", 11)]
    df = spark.createDataFrame(items, "key string, source string, address string, id int")
    assert sorted(r["id"] for r in fallback.first_source_by_key(df, sources).collect()) == [1, 6, 7]
    assert sorted(r["id"] for r in fallback.extended_by_key(df, sources, F.col("id")).collect()) == [1, 2, 6, 7, 8]
    assert fallback.first_source_by_key(df.limit(0), sources).count() == 0
