import numpy as np
from pyspark.sql import functions as F

from ledgerwell.llm import language, quality, queries

SMALL = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = queries.op3_quality(spark, SMALL).toPandas()
    labels = spark.read.parquet(f"{SMALL}/labels.parquet").toPandas()
    assert len(found) == spark.read.parquet(f"{SMALL}/documents.parquet").count()
    both = found[found.held_out].merge(labels, on="doc_id")
    assert found.score.between(0, 1).all() and (found.predicted == (found.score >= 0.3)).all()
    assert (both.predicted == both.quality).mean() > 0.93


def test_odd_rows(spark):
    rows = [(i, "good words and more of them here" if i % 2 else "BAD!! BAD!! BAD!!", i) for i in range(80)]
    rows += [(100, None, 0), (101, "", 0), (None, "x", 0), (3, "y", 0), (102, "long text, word. " * 100_000, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score long")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(80)] + [(1, None, 1), (None, 1, 0)], "doc_id long, quality int, text int")
    out = quality.classify(docs, labels, language.remainder(F.col("doc_id"), 5) != 0).toPandas()
    assert len(out) == len(rows) and out.score.between(0, 1).all()
    good = out[out.doc_id.isin(range(1, 80, 2)) & (out.doc_id != 3)]
    assert (good.predicted == 1).all() and (out[out.doc_id.isin(range(0, 80, 2))].predicted == 0).all()
    assert quality.classify(docs.limit(0), labels, F.lit(True)).count() == 0
    unlabelled = quality.classify(docs, labels.limit(0), F.lit(True)).toPandas()
    assert (unlabelled.score == 0).all() and (unlabelled.predicted == 0).all()


def test_normal_equations_do_not_depend_on_partitions(spark):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(size=len(quality.STATISTICS)).tolist(), int(i % 3 == 0)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, statistics array<double>, quality int")
    one = quality.fit(df.coalesce(1), "doc_id", "quality")
    many = quality.fit(df.repartition(5), "doc_id", "quality", settings=quality.Settings(rows_per_task=50))
    assert np.allclose(one.weight, many.weight)


def test_isotonic_levels_rise():
    edges, levels = quality.isotonic(np.array([0.0, 1, 2, 3]), np.array([4.0, 4, 4, 4]), np.array([1.0, 0, 4, 3]))
    assert len(edges) == 2 and (np.diff(levels) >= 0).all() and np.allclose(levels, [1 / 8, 7 / 8], atol=0.01)
