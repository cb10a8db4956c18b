"""Resumed and published runs that stop half-way."""

import pytest
from pyspark.sql import functions as F

from dealspark.operators import ledger, publish


class Stopped(RuntimeError):
    pass


def test_a_stopped_run_is_continued(spark, tmp_path):
    orders = spark.createDataFrame([(i, float(i)) for i in range(200)] + [(5, 5.0)], "key long, price double")
    book = lambda: ledger.Ledger(spark, f"{tmp_path}/book", "key long, status string, price double")
    done = []

    def work(batch):
        rows = [r["key"] for r in batch.collect()]
        if len(done) >= 3 and not done[-1] == "resumed":
            raise Stopped
        done.append(rows)
        return batch.withColumn("status", F.when(F.col("key") % 10 == 0, "failed").otherwise("accepted"))

    with pytest.raises(Stopped):
        book().run(orders, work, batch_rows=20)
    kept = book().outputs().count()
    assert 0 < kept < 180 and {r["key"] for r in book().open_work(orders).collect()} >= set(range(200)) - {k for rows in done for k in rows}
    tried = {k for rows in done for k in rows}
    done.append("resumed")
    seen = []

    def rest(batch):
        seen.extend(r["key"] for r in batch.collect())
        return batch.withColumn("status", F.when(F.col("key") % 10 == 0, "failed").otherwise("accepted"))

    out = book().run(orders, rest, batch_rows=20)
    assert sorted(r["key"] for r in out.collect()) == [k for k in range(200) if k % 10]
    assert len(seen) == len(set(seen)) and not set(seen) & {k for k in tried if k % 10}
    for _ in range(3):
        book().run(orders, rest)
    assert book().open_work(orders).count() == 0 and book().attempts().where("status = 'failed'").groupBy("key").count().agg(F.max("count")).first()[0] == 3


def test_a_batch_without_its_mark_does_not_count(spark, tmp_path):
    book = ledger.Ledger(spark, f"{tmp_path}/book", "key long, status string")
    df = spark.createDataFrame([(1,), (2,)], "key long")
    book.run(df, lambda b: b.withColumn("status", F.lit("accepted")), batch_rows=1)
    marks = sorted((tmp_path / "book").glob("run=*/batch=*/_SUCCESS"))
    assert len(marks) == 2
    lost = book.attempts().where("batch = 0").count()
    marks[0].unlink()
    assert book.open_work(df).count() == lost
    assert book.run(df, lambda b: b.withColumn("status", F.lit("accepted"))).count() == 2
    with pytest.raises(ValueError):
        book.run(spark.createDataFrame([(None,)], "key long"), lambda b: b)
    with pytest.raises(ValueError):
        ledger.Ledger(spark, str(tmp_path), "key long")


def test_an_empty_ledger(spark, tmp_path):
    book = ledger.Ledger(spark, f"{tmp_path}/none", "key long, status string")
    df = spark.createDataFrame([], "key long")
    assert book.run(df, lambda b: b.withColumn("status", F.lit("accepted"))).count() == 0 and book.attempts().count() == 0


@pytest.mark.parametrize(
    "rows, said",
    [
        ([("a", "r/1", True), ("a", "r/2", True)], "identity"),
        ([("a", "r/1", True), ("b", "r/1", True)], "repeated or missing output"),
        ([("a", "r/../1", True)], "scope"),
        ([("a", "/r/1", True)], "scope"),
        ([("a", None, True)], "output"),
        ([("a", "r/1", None)], "not right"),
        ([], "no rows"),
        ([(str(i), f"r/{i}", True) for i in range(4)], "more rows"),
    ],
)
def test_earlier_outputs_come_back_all_or_none(spark, rows, said):
    df = spark.createDataFrame(rows, "id string, output string, ok boolean")
    with pytest.raises(ValueError, match=said):
        ledger.restored(df, F.col("id"), F.col("output"), [("not right", F.col("ok"))], requested=3, scope="r")


def test_good_outputs_come_back(spark):
    df = spark.createDataFrame([("a", "r/1", True), ("b", "r/x/2", True)], "id string, output string, ok boolean")
    assert ledger.restored(df, F.col("id"), F.col("output"), [("not right", F.col("ok"))], requested=2, scope="r/").count() == 2


def test_windows_are_replaced_as_a_whole_or_not_at_all(spark, tmp_path):
    own = publish.WindowTable(spark, f"{tmp_path}/t", "week")
    rows = lambda *r: spark.createDataFrame(list(r), "week string, kind string, n long")
    metrics, fine = {"total": F.sum("n")}, {"some": lambda m: m["total"] > 0}
    with pytest.raises(publish.PublishError):
        own.read()
    assert own.publish("one", rows(("w1", "a", 1), ("w1", "b", 2), ("w2", "a", 3)), metrics, fine, unique=["kind"]) == {"rows": 3, "without_window": 0, "total": 6}
    seen = lambda: sorted(tuple(r) for r in own.read().collect())
    first = seen()
    for run, df in (("bad", rows(("w1", "a", -9))), ("empty", rows()), ("null", rows((None, "a", 5))), ("twice", rows(("w1", "a", 5), ("w1", "a", 6)))):
        with pytest.raises(publish.PublishError):
            own.publish(run, df, metrics, {} if run == "empty" else fine, unique=["kind"])
        assert seen() == first
    own.publish("two", rows(("w1", "c", 7)), metrics, fine)
    assert seen() == [("w1", "c", 7), ("w2", "a", 3)]
    own.publish("two", rows(("w1", "d", 8)), metrics, fine)  # replayed: nothing is done
    assert seen() == [("w1", "c", 7), ("w2", "a", 3)] and own.history().count() == 3


def test_a_lost_writer_and_a_second_one(spark, tmp_path, monkeypatch):
    own = publish.WindowTable(spark, f"{tmp_path}/t", "week")
    df = spark.createDataFrame([("w1", 1)], "week string, n long")
    own.publish("one", df, {}, {})

    def lost(*_):
        raise Stopped

    with monkeypatch.context() as m:
        m.setattr(publish.WindowTable, "_commit", lost)
        with pytest.raises(Stopped):
            own.publish("two", df.withColumn("n", F.lit(2).cast("long")), {}, {})
    assert own.read().first()["n"] == 1
    real = own._commits
    with monkeypatch.context() as m:
        m.setattr(own, "_commits", lambda: real()[:0])  # a writer that hasn't seen the commit
        with pytest.raises(publish.PublishError, match="another writer"):
            own.publish("three", df, {}, {})
    own.publish("two", df.withColumn("n", F.lit(2).cast("long")), {}, {})
    assert own.read().first()["n"] == 2
