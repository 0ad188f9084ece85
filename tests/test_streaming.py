import datetime as dt
import json

from pyspark.sql import functions as F

from docsift.operators import classify as C
from docsift.plans.registry import naive_bayes, vector_model, vector_predictions
from docsift.streaming import history as H
from docsift.streaming import scoring as SS

T0 = dt.datetime(2024, 1, 1, 12, 0)


def land(folder, name, rows):
    folder.mkdir(exist_ok=True)
    with open(folder / name, "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")


def row(i, text, filename="cv.txt"):
    at = (T0 + dt.timedelta(minutes=i)).isoformat()
    return {"doc_id": i, "filename": filename, "text": text, "received": at}


def test_stream_scores_and_quarantines_once(spark, small, tmp_path):
    model, classes = naive_bayes(spark, small), vector_model(spark, small).classes
    advanced = vector_predictions(spark, small).drop("y_true")
    paths = [str(tmp_path / x) for x in ("history", "quarantine", "state")]

    def run():
        stream = SS.score_stream(
            SS.landing_rows(spark, str(tmp_path / "in")), model, lambda checked: advanced, classes, *paths
        )
        stream.awaitTermination()

    land(tmp_path / "in", "1.json", [row(1, "the tionerly ander with thenes"), row(2, "x", "bad.exe"), row(3, "  ")])
    run()
    land(tmp_path / "in", "2.json", [row(4, "another text about ander tionerly")])
    run()
    run()
    history = H.read_history(spark, paths[0])
    assert sorted(r["id"] for r in history.collect()) == [1, 4]
    assert [r["id"] for r in H.latest(history, n=1).collect()] == [4]
    rejected = spark.read.option("recursiveFileLookup", True).parquet(paths[1])
    assert {r["doc_id"]: r["reason"] for r in rejected.collect()} == {2: "unsupported_extension", 3: "empty_text"}


def test_a_repeated_batch_replaces_itself(spark, tmp_path):
    path = str(tmp_path / "h")
    entries = spark.createDataFrame([], H.ENTRY_SCHEMA)
    entries = entries.unionByName(
        spark.range(3).select(F.col("id"), F.timestamp_seconds("id").alias("timestamp")), allowMissingColumns=True
    )
    H.append_batch(entries, path, 7)
    H.append_batch(entries, path, 7)
    H.append_batch(entries, path, 8)
    assert H.read_history(spark, path).count() == 6
    H.clear(spark, path)
    assert H.read_history(spark, path).count() == 0


def test_landing_files(spark, tmp_path):
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.txt").write_bytes("café noir".encode("latin-1"))
    query = (
        SS.landing_files(spark, str(tmp_path / "f"))
        .writeStream.format("memory").queryName("landed").trigger(availableNow=True).start()
    )
    query.awaitTermination()
    got = spark.table("landed").first()
    assert (got["filename"], got["text"]) == ("a.txt", "café noir")


def test_windows_drop_late_rows(spark, tmp_path):
    folder = tmp_path / "w"

    def event(minute, agreement):
        return {"timestamp": (T0 + dt.timedelta(minutes=minute)).isoformat(), "agreement": agreement}

    def run():
        rows = spark.readStream.schema("timestamp TIMESTAMP, agreement BOOLEAN").json(str(folder))
        query = (
            H.agreement_by_window(rows, "timestamp", "agreement", "10 minutes", late="5 minutes")
            .writeStream.outputMode("append").format("parquet").option("path", str(tmp_path / "out"))
            .option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start()
        )
        query.awaitTermination()

    land(folder, "1.json", [event(1, True), event(2, False), event(31, True)])
    run()
    land(folder, "2.json", [event(3, True), event(60, True)])
    run()
    got = {r["window_start"]: (r["n"], r["agreement_rate"]) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got[T0] == (2, 0.5)


def test_centroid_model_is_small(spark, small):
    model = vector_model(spark, small)
    assert isinstance(model, C.NearestCentroid) and model.table.count() == len(model.classes)
