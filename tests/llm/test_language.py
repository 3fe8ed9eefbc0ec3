import zlib

import numpy as np
import pyarrow as pa

from ledgerwell.llm import language, queries, texts

SMALL = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    found = queries.op7_language(spark, SMALL).toPandas()
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "lang", "text").toPandas()
    both = found.merge(docs, on="doc_id")
    assert len(both) == len(docs) == len(found)
    assert (both.held_out == [zlib.crc32(str(i).encode()) % 4 == 2 for i in both.doc_id]).all()
    assert both.score.between(0, 1).all()
    assert (both[both.held_out].lang_pred == both[both.held_out].lang).mean() > 0.98


def test_odd_texts(spark):
    rows = [(1, "der und die das ich nicht", "de"), (2, "the of and is was the", "en")] * 30
    rows = [(i, t, y) for i, (_, t, y) in enumerate(rows)]
    learn = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(learn, "text", "lang", "doc_id")
    odd = [(1, None), (2, ""), (3, "123 !? \n"), (4, "the and of the"), (4, "the and of the"), (5, "die und das nicht " * 200_000)]
    df = spark.createDataFrame(odd, "doc_id long, text string").selectExpr("*", "'x' AS score", "1 AS _has_letter")
    out = language.predict(df, model).orderBy("doc_id").collect()
    assert [r["lang_pred"] for r in out] == ["und", "und", "und", "en", "en", "de"]
    assert [r["rejected"] for r in out[:3]] == [True] * 3 and out[0]["score"] == 0.0 and out[5]["score"] > 0.9
    assert out[0]["_has_letter"] == 1
    assert language.predict(df.limit(0), model).count() == 0


def test_nothing_to_learn_from(spark):
    empty = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    model = language.fit(empty, "text", "lang", "doc_id")
    row = language.predict(empty, model).first()
    assert (row["lang_pred"], row["score"], row["rejected"]) == ("und", 0.0, True)


def test_blocks_of_a_long_text_count_as_one(monkeypatch):
    data = np.frombuffer(("Straße ÉTÉ über the " * 40).encode(), dtype=np.uint8)
    whole = language.counts(data)
    monkeypatch.setattr(language, "BLOCK", 64)
    assert (language.counts(data) == whole).all()


def test_scores_do_not_depend_on_the_batch():
    rng = np.random.default_rng(0)
    model = language.Model(("a", "b"), rng.normal(size=(language.BUCKETS, 2)).astype(np.float32), np.zeros(2, np.float32), 0.5)
    model.table[0] = 0
    words = ["Der", "", "étude et", "x", "one two three"]
    together = language._scores(*texts.flat(pa.array(words)), model)
    for k, word in enumerate(words):
        alone = language._scores(*texts.flat(pa.array([word])), model)
        assert np.allclose(together[0][k], alone[0][0], atol=1e-4) and together[1][k] == alone[1][0]
