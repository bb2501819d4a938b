from datetime import datetime, timedelta

from tessera import streaming
from tessera.operators.contracts import ResponseFields


def drain(stream, name, spark, mode="append"):
    query = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    query.awaitTermination(60)
    return spark.table(name).collect()


def test_stream_of_records(spark, tmp_path):
    t = datetime(2025, 1, 1)
    rows = [(0, "a", "p", "r", t), (1, "a", "p", "r", t + timedelta(hours=1)), (2, "b", " ", "r", t), (3, None, "p", "r", t)]
    schema = "row_index bigint, id string, prompt string, response string, at timestamp"
    spark.createDataFrame(rows, schema).write.parquet(str(tmp_path / "in"))
    read = lambda: spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    fields = ResponseFields(metadata=None)
    got = drain(streaming.checked_stream(read(), fields), "checked", spark)
    assert {r.row_index: r.violation for r in got} == {0: None, 1: None, 2: "prompt", 3: "id"}
    first = drain(streaming.first_deliveries(read(), "id", "at"), "first", spark)
    assert sorted(str(r.id) for r in first) == ["None", "a", "b"]


def test_windowed_losses(spark, tmp_path):
    t = datetime(2025, 1, 1)
    rows = [("x", t, 1.0), ("x", t + timedelta(minutes=1), 3.0), ("x", t + timedelta(minutes=2), float("nan")), ("x", t + timedelta(minutes=11), 5.0)]
    spark.createDataFrame(rows, "run string, at timestamp, loss double").write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("run string, at timestamp, loss double").parquet(str(tmp_path / "in"))
    got = drain(streaming.windowed_losses(stream, "at", ["run"], "loss"), "losses", spark, "complete")
    assert sorted((r.n_events, r.loss) for r in got) == [(1, 5.0), (3, 2.0)]
