from datetime import datetime

from gridloom.streaming.cycles import by_cycle, complete_cycles, publish_new


def test_complete_cycles_only(spark):
    rows = spark.createDataFrame([("c1", s) for s in (0, 3, 3)] + [("c2", s) for s in (0, 3, 6)], "cycle string, step_h int")
    assert [r["cycle"] for r in complete_cycles(rows, 3).collect()] == ["c2"]


def test_counts_by_cycle(spark):
    rows = spark.createDataFrame([(datetime(2026, 7, 13, h),) for h in (0, 5, 6, 23)], "ts timestamp")
    assert sorted(r["n"] for r in by_cycle(rows).collect()) == [1, 1, 2]


def test_available_now_publishes_each_cycle_once(spark, tmp_path):
    done = []
    known = lambda: spark.createDataFrame([(c,) for c in done], "cycle string")

    def run():
        stream = spark.readStream.schema("cycle string, step_h int").json(str(tmp_path / "in"))
        publish_new(stream, known, lambda df: done.extend(r["cycle"] for r in df.collect()), str(tmp_path / "check"), 2, str(tmp_path / "seen")).awaitTermination()

    spark.createDataFrame([("a", 0)], "cycle string, step_h int").write.json(str(tmp_path / "in"))
    run()
    assert done == []
    spark.createDataFrame([("a", 3), ("b", 0)], "cycle string, step_h int").write.mode("append").json(str(tmp_path / "in"))
    run()
    run()
    assert done == ["a"]
