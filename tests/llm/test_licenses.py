import re

from ledgerwell.llm import licenses, queries

SMALL = "/root/testdata/sf0.01"


def words(text):
    return re.findall(r"[^\W_]+", (text or "").lower())


def runs(found, size):
    return {tuple(found[k : k + size]) for k in range(len(found) - size + 1)}


def brute(docs, templates, least=0.8):
    out = {}
    for doc, text in docs:
        own = words(text)
        for template, notice in templates:
            wanted = words(notice)
            if not wanted:
                continue
            size, n = min(5, len(wanted)), len(wanted)
            stride = max(1, n // 4)
            for start in range(0, max(1, len(own)), stride):
                window = own[start : start + n + stride - 1]
                share = len(runs(window, size) & runs(wanted, size)) / len(runs(wanted, size))
                if share >= least and share > out.get((doc, template), (0,))[0]:
                    out[doc, template] = (share, start)
    return {k: (round(a, 6), b) for k, (a, b) in out.items()}


def test_query_over_the_table(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = brute(docs, [(k, t) for k, (_, t) in enumerate(licenses.TEMPLATES)])
    rows = queries.op8_licenses(spark, SMALL).collect()
    assert {(r["doc_id"], r["template"]): (r["containment"], r["start_word"]) for r in rows} == want and want
    assert all(r["license"] == licenses.TEMPLATES[r["template"]][0] for r in rows)


def test_odd_rows(spark):
    notice = "use copy modify merge publish distribute sublicense and sell copies of the software to anyone"
    docs = [
        (1, "x " * 30 + notice + " y" * 50),
        (2, notice.upper().replace(" ", ", ")),
        (3, "x " * 7 + notice.rsplit(" ", 2)[0] + " z" * 9),
        (4, " ".join(notice.split()[:8])),
        (5, None),
        (6, ""),
        (None, "All rights; reserved"),
        (1, "x " * 30 + notice + " y" * 50),
        (7, "w " * 300_000 + notice),
    ]
    templates = [(1, notice), (2, "all rights reserved"), (3, None), (4, "--")]
    left = spark.createDataFrame(docs, "doc_id long, text string").selectExpr("*", "1 AS start", "2 AS name")
    right = spark.createDataFrame(templates, "template int, notice string").selectExpr("*", "'x' AS text")
    rows = licenses.scan(left, right).collect()
    want = brute(docs, templates)
    assert {(r["doc_id"], r["template"]): r["containment"] for r in rows} == {k: a for k, (a, _) in want.items()}
    # Of windows that hold as much, the first that is aligned with a shared run.
    starts = {(r["doc_id"], r["template"]): r["start_word"] for r in rows}
    assert starts.pop((3, 1)) == 6 and starts == {k: b for k, (_, b) in want.items() if k != (3, 1)}
    assert licenses.scan(left.limit(0), right).count() == 0 and licenses.scan(left, right.limit(0)).count() == 0


def test_inserted_words_at_any_place(spark):
    """A notice with inserted words is found wherever it begins, as by trying every start."""
    notice = licenses.TEMPLATES[8][1]
    inserted = notice.replace("GNU General", "GNU Lesser General").split()
    assert len(words(" ".join(inserted))) == 25
    docs = [(k, " ".join([f"x{j}" for j in range(k)] + inserted + ["end"] * 40)) for k in range(14)]
    docs += [(20, notice), (21, " ".join(inserted[:12])), (22, " ".join(f"{w} and" for w in notice.split()))]
    left = spark.createDataFrame(docs, "doc_id long, text string")
    right = spark.createDataFrame([(1, notice)], "template int, notice string")
    wanted, want = words(notice), {}
    for doc, text in docs:
        own = words(text)
        windows = (own[k : k + 24 + 5] for k in range(len(own)))
        share = max(len(runs(w, 5) & runs(wanted, 5)) / len(runs(wanted, 5)) for w in windows)
        if share >= 0.8:
            want[doc] = round(share, 6)
    assert {r["doc_id"]: r["containment"] for r in licenses.scan(left, right).collect()} == want
    assert want == {k: 0.8 for k in range(14)} | {20: 1.0}
