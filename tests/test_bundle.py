"""A pipeline of the own stages: fitted, saved, loaded in another session, equal predictions."""

import subprocess
import sys

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from docsift.operators import linear as LN
from docsift.plans import bundle as B
from docsift.plans import fits as FT

CONFIG = {"max_features": 50, "low": 1, "high": 2, "min_df": 1, "max_df": 1.0, "sublinear": True}
LOAD = """
import sys
from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
rows = spark.read.parquet(sys.argv[2])
for r in PipelineModel.load(sys.argv[1]).transform(rows).orderBy("doc_id").collect():
    print("ROW", r["doc_id"], r["y_pred"], [s.hex() for s in r["scores"]])
"""


def rows_of(spark):
    rows = [(i, "ab"[i % 2], ("red apple tree" if i % 2 else "blue sky cloud") + f" word{i % 5}") for i in range(40)]
    rows += [(40, "a", None), (41, "b", ""), (42, None, "red apple"), (43, "a", "unknown words only")]
    return spark.createDataFrame(rows, "doc_id long, category string, clean string")


def shown(df):
    return [f"ROW {r['doc_id']} {r['y_pred']} {[s.hex() for s in r['scores']]}" for r in df.orderBy("doc_id").collect()]


def test_saved_pipeline_predicts_the_same_in_a_fresh_session(spark, tmp_path):
    rows = rows_of(spark)
    stages = [B.TermVectorizer(config=CONFIG), B.LinearClassifier(width=50)]
    model = Pipeline(stages=stages).fit(rows.filter("doc_id < 40"))
    model.write().overwrite().save(str(tmp_path / "bundle"))
    rows.write.parquet(str(tmp_path / "rows"))
    want = shown(model.transform(rows))
    assert len(want) == 44
    by_id = {int(w.split()[1]): w.split()[2] for w in want}
    assert all(by_id[i] == "ab"[i % 2] for i in range(40)) and by_id[42] == "b"
    done = subprocess.run(
        [sys.executable, "-c", LOAD, str(tmp_path / "bundle"), str(tmp_path / "rows")],
        capture_output=True, text=True, timeout=240, check=False,
    )
    got = [line for line in done.stdout.splitlines() if line.startswith("ROW")]
    assert got == want, done.stderr[-2000:]


def test_params_and_loss_survive(spark, tmp_path):
    rows = rows_of(spark).withColumnRenamed("doc_id", "own").withColumnRenamed("clean", "body")
    first = B.TermVectorizer(rowId="own", inputCol="body", pattern="word2", config=CONFIG)
    model = Pipeline(stages=[first, B.LinearClassifier(loss=LN.HINGE, c=0.5, balanced=False, width=50)]).fit(rows)
    model.save(str(tmp_path / "svm"))
    loaded = PipelineModel.load(str(tmp_path / "svm"))
    assert loaded.stages[0].tfidf() == model.stages[0].tfidf() and loaded.stages[0].getOrDefault("rowId") == "own"
    assert loaded.stages[1].getOrDefault("loss") == LN.HINGE and loaded.stages[1].classes == ["a", "b"]
    a, b = (m.transform(rows).select("own", "scores", "y_pred") for m in (model, loaded))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()
    assert loaded.transform(rows.limit(0)).count() == 0


def test_library_classifier_in_the_same_bundle(spark, tmp_path):
    rows = rows_of(spark).filter("category is not null").withColumn("label", (F.col("category") == "b").cast("double"))
    first = B.TermVectorizer(config=CONFIG, vectors=True)
    forest = FT.random_forest(trees=3, depth=4).setWeightCol("one")
    model = Pipeline(stages=[first, forest]).fit(rows.withColumn("one", F.lit(1.0)))
    model.save(str(tmp_path / "forest"))
    loaded = PipelineModel.load(str(tmp_path / "forest"))
    a, b = ({r["doc_id"]: r["prediction"] for r in m.transform(rows).collect()} for m in (model, loaded))
    assert a == b and len(a) == rows.count()
