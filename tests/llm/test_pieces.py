"""Prefix-table encoding against the library that reads the model."""

import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from ledgerwell.llm import pieces, queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def model():
    return queries.model_file(public_tokenizers.path("piece_bpe_32k.model"))


@pytest.fixture(scope="module")
def library(model):
    return sentencepiece.SentencePieceProcessor(model_proto=model)


def texts(library):
    rng = random.Random(3)
    letters = "abthe  \n\tné🦊日▁<s>.,!0123THE ing"
    vocabulary = [library.id_to_piece(i) for i in range(259, 32000)]
    fixed = ["", " ", "  a  b ", "\n", "\r\n", "▁x▁", "\x00a", "<s> </s> <unk> <0x0A>", "ﬁ Ａ é", " " * 999, "a" * 3000]
    fixed += ["   the   日  🦊     🦊x  \n   y", " " * 37 + "\n" + " " * 53 + "é"]
    loose = ["".join(rng.choice(letters) for _ in range(rng.randint(1, 120))) for _ in range(400)]
    joined = ["".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 20))) for _ in range(400)]
    return fixed + loose + joined


def test_ids_and_texts_equal_the_library(model, library):
    known, outputs = pieces.Vocabulary(model), pieces.Outputs(model)
    for text in texts(library):
        want = library.encode(text)
        assert np.frombuffer(known.encode(text), dtype=np.int32).tolist() == want
        assert outputs.decode(want) == library.decode(want)


def test_forgetting_words_and_pairs_changes_nothing(model, library):
    known = pieces.Vocabulary(model, remembered=4)
    for text in texts(library)[:60]:
        assert np.frombuffer(known.encode(text), dtype=np.int32).tolist() == library.encode(text)


def test_rows_nulls_and_clashing_columns(spark, model, library):
    rows = [(1, None, "x"), (2, "", "x"), (3, "to be or\nnot", None), (3, "to be or\nnot", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    out = pieces.decode(pieces.encode(df, model), model, text="ids_text").orderBy("doc_id").collect()
    assert [r["doc_id"] for r in out] == [1, 2, 3, 3]
    assert out[0]["ids"] == [] and out[1]["ids"] == [] and out[0]["ids_text"] == ""
    assert out[2]["ids"] == library.encode("to be or\nnot") and out[2]["ids_text"] == "to be or\nnot"
    assert pieces.encode(df.limit(0), model).count() == 0


def test_query_over_the_table(spark, library):
    import hashlib

    got = {r["doc_id"]: r for r in queries.op4_sentencepiece(spark, SMALL).collect()}
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").collect()
    assert len(got) == len(docs)
    for row in docs:
        ids = library.encode(row["text"] or "")
        mine = got[row["doc_id"]]
        assert mine["n_tokens"] == len(ids)
        assert mine["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert mine["decoded_sha256"] == hashlib.sha256(library.decode(ids).encode()).hexdigest()
