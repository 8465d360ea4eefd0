"""What a stage of the pipeline leaves on disk beside its tables, and how often it asks for the classes of its pairs."""

import os
import random
import tempfile
import time
from glob import glob

import corpus_pipeline
from webcapture.llm import jaccard_join


def shuffled(spark):
    root = os.environ.get("SPARK_LOCAL_DIRS") or spark.conf.get("spark.local.dir", tempfile.gettempdir())
    return {f for top in root.split(",") for f in glob(f"{top}/**/blockmgr-*/*/shuffle_*.data", recursive=True)}


def documents(spark):
    rng = random.Random(6)
    texts = [" ".join(rng.choices(["alpha", "beta", "gamma", "delta", "omega", "kappa", "sigma"], k=60)) for _ in range(40)]
    texts += [text + " more" for text in texts[:20]]
    return spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long")


def test_shuffles_go_with_their_job(spark, tmp_path):
    path = str(tmp_path / "documents")
    documents(spark).write.parquet(path)
    before = shuffled(spark)
    for name, stage in corpus_pipeline.STAGES[1:3]:
        stage(spark, spark.read.parquet(path), "").write.parquet(str(tmp_path / name))
    kept = spark.read.parquet(str(tmp_path / "near_duplicates"))
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == list(range(40))
    for _ in range(20):  # they go in the background
        if not shuffled(spark) - before:
            break
        time.sleep(0.5)
    assert not shuffled(spark) - before


def test_classes_are_asked_for_once(spark, monkeypatch):
    written = []

    def saved(df, name, own=jaccard_join.saved):
        written.append((name, df._jdf.queryExecution().toString().count("explode(")))
        return own(df, name)

    monkeypatch.setattr(jaccard_join, "saved", saved)
    found = {r.doc_id: r.component_id for r in jaccard_join.jaccard_components(documents(spark)).collect()}
    assert found == {i: i % 40 for i in range(60)}
    assert "classes" in [name for name, _ in written]
    assert all(not plans for name, plans in written if name == "sets")
