import datetime as dt

from tillcast.sinks.tables import append_events
from tillcast.sources import events as EV


def log(spark, n=5):
    rows = [(dt.datetime(2024, 1, d), "train" if d % 2 else "predict", d) for d in range(1, n + 1)]
    return spark.createDataFrame(rows, "ts timestamp, kind string, number int")


def test_append_read_filter_order_limit(spark, tmp_path):
    path = str(tmp_path / "log")
    append_events(log(spark), path)
    table = EV.read_event_log(spark, path)
    assert table.count() == 5 and EV.read_event_log(spark, path, "train").count() == 3
    newest = [r["ts"].day for r in EV.query_log(table, limit=2).collect()]
    assert newest == [5, 4]
    kept = EV.query_log(table, start="2024-01-01", end="2024-01-02").collect()
    assert [r["ts"].day for r in kept] == [2, 1]


def test_flat_files_skip_broken_lines(spark, tmp_path):
    assert EV.read_log_files(spark, str(tmp_path)).count() == 0
    (tmp_path / "predict-2024-01.log").write_text('{"timestamp": "2024-01-01T00:00:00+00:00", "kind": "predict"}\n\nnot json\n')
    (tmp_path / "predict-x-2024-01.log").write_text('{"timestamp": "2024-01-01T00:00:00+00:00", "kind": "predict-x"}\n')
    assert EV.read_log_files(spark, str(tmp_path), "predict").count() == 1


def test_late_events_count_and_replays_do_not(spark, tmp_path):
    from tillcast.streaming import events as SE

    source, target, checkpoint = (str(tmp_path / n) for n in ("in", "out", "check"))
    for day in (10, 20, 10):
        rows = [(dt.datetime(2024, 1, day), "predict")]
        spark.createDataFrame(rows, "ts timestamp, kind string").coalesce(1).write.mode("append").parquet(source)
        for _ in range(2):
            stream = spark.readStream.schema("ts timestamp, kind string").parquet(source)
            SE.stream_event_counts(stream, target, checkpoint).awaitTermination()
    counts = {r.window_start.day: r.n_events for r in SE.current_counts(spark, target).collect()}
    assert counts == {10: 2, 20: 1}


def test_names_that_differ_by_case_answer_once(spark):
    from tillcast.plans.scoring import resolve_series

    trained = spark.createDataFrame([("EIRE",), ("Eire",), ("France",)], "series string")
    asked = spark.createDataFrame([("eire ", "2024-01-01"), ("nowhere", "2024-01-01")], "country string, date string")
    rows = {r.country: r.series for r in resolve_series(asked, trained).collect()}
    assert rows == {"eire ": "Eire", "nowhere": None} and resolve_series(asked, trained).count() == 2
