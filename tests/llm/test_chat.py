import hashlib

import pytest
from pyspark.sql import functions as F

from ledgerwell.llm import chat, queries

SMALL = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, message long, parent long, role string, text string, score double"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_query_over_the_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    want = {}
    for conv, _, role, text in sorted(rows, key=lambda r: r[:2]):
        want.setdefault(conv, []).append((role, text or ""))
    got = {r["conv_id"]: r for r in queries.op2_chat(spark, SMALL).collect()}
    assert set(got) == set(want)
    for conv, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        mine = got[conv]
        assert mine["n_turns"] == len(turns)
        assert mine["turns_sha256"] == sha("".join(f"{r}\n{t}\n" for r, t in turns))
        assert (mine["loss_chars"], mine["loss_sha256"]) == (len(loss), sha(loss))


@pytest.mark.parametrize(
    "text",
    ["", "</s>[INST] ok [/INST]", "<\\s>", "<\\\\|im_end|>\n", "<|im_end|>", "\\", "[\\INST][INST]", "<<SYS>><s<s>", "é🦊<|im_start|>", "$1\\1"],
)
def test_escape_is_reversible(spark, text):
    df = spark.range(1).select(F.lit(text).alias("t"))
    there = df.select(chat.escaped(F.col("t")).alias("e"), chat.escaped_role(F.col("t")).alias("r"))
    row = there.select("*", chat.unescaped(F.col("e")).alias("back"), chat.unescaped_role(F.col("r")).alias("role")).first()
    assert row["back"] == text and row["role"] == text
    assert not any(c + rest in row["e"] for c, tails in chat.CONTROL.items() for rest in tails) and "\n" not in row["r"]


def formatted(spark, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS leaf", "2 AS tree", "3 AS node")
    out = chat.format_trees(df, score="score", **options)
    out = out.withColumns({"turns": chat.read_back(F.col("formatted")), "loss": chat.masked(F.col("formatted"), F.col("spans"))})
    return {(r["conv_id"], r["leaf"]): r for r in out.collect()}


def test_branches_ranks_and_odd_rows(spark):
    rows = [
        (1, 1, None, "user", "q", None),
        (1, 2, 1, "assistant", "a", 1.0),
        (1, 3, 1, "assistant", "b", 5.0),
        (1, 4, 2, "user", "more", 4.0),
        (1, 4, 2, "user", "more", 4.0),
        (None, 1, None, None, None, None),
        (2, 5, 99, "assistant", "parent unknown", None),
        (3, 1, 2, "user", "circle", None),
        (3, 2, 1, "user", "circle", None),
        (3, None, None, "user", "no id", None),
    ]
    got = formatted(spark, rows)
    assert set(got) == {(1, 3), (1, 4), (None, 1), (2, 5)}
    assert [(t["role"], t["text"]) for t in got[1, 4]["turns"]] == [("user", "q"), ("assistant", "a"), ("user", "more")]
    # Equal sums: the smaller leaf ranks first.
    assert (got[1, 3]["branch_rank"], got[1, 4]["branch_rank"]) == (1, 2) and got[1, 4]["branch_score"] == 5.0
    assert got[1, 3]["loss"] == "b" and got[None, 1]["turns"][0]["text"] == ""
    assert set(formatted(spark, rows, branches=1)) == {(1, 3), (None, 1), (2, 5)}
    assert formatted(spark, rows[:0]) == {}


def test_long_path(spark):
    rows = [(1, k, k - 1 if k else None, "assistant" if k % 2 else "user", f"t{k}" * (1 + 20_000 * (k == 7)), 1.0) for k in range(70)]
    row = formatted(spark, rows)[1, 69]
    assert [t["text"] for t in row["turns"]] == [r[4] for r in rows]
    assert row["loss"] == "".join(r[4] for r in rows if r[3] == "assistant")
