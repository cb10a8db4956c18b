"""Weekly windows over many micro-batches, with rows that come too late."""

import datetime as dt

from dealspark.streaming.windows import Weeks


def test_late_rows_get_a_table_of_their_own(spark, tmp_path):
    day = lambda n: dt.datetime(2024, 1, 5, 6) + dt.timedelta(days=n)
    files = [
        [(1, day(0), "a"), (2, day(1), "a"), (2, day(1), "a")],
        [(3, day(8), "a"), (1, day(0), "a"), (4, day(6), "b")],
        [(5, day(30), "a")],
        [(6, day(2), "a"), (7, day(21), "b"), (8, day(60), "a")],
        [(9, day(3), "b"), (10, day(61), "a")],
    ]
    folder = str(tmp_path / "events")
    for k, rows in enumerate(files[:4]):
        spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, event_type string").coalesce(1).write.mode("append").parquet(folder)
    weeks = Weeks(spark, folder, base=str(tmp_path / "own"), files=1).run()
    spark.createDataFrame(files[4], "event_id long, ts timestamp_ntz, event_type string").coalesce(1).write.mode("append").parquet(folder)
    weeks = Weeks(spark, folder, base=str(tmp_path / "own"), files=1).run()  # goes on where it stopped
    closed = [(str(r["start"]), r["event_type"], r["n"]) for r in weeks.closed().collect()]
    assert len(closed) == len({c[:2] for c in closed})
    assert set(closed) == {("2024-01-05 05:00:00", "a", 2), ("2024-01-05 05:00:00", "b", 1), ("2024-01-12 05:00:00", "a", 1), ("2024-01-26 05:00:00", "b", 1), ("2024-02-02 05:00:00", "a", 1)}
    assert {r["event_id"] for r in weeks.late().collect()} == {6, 9}
    again = {(str(r["start"]), r["event_type"], r["n"]) for r in weeks.recount(spark.read.parquet(folder)).collect()}
    assert again == {("2024-01-05 05:00:00", "a", 3), ("2024-01-05 05:00:00", "b", 2)}
