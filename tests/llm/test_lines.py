import random

import pytest
from pyspark.sql import functions as F

from ledgerwell.llm import lines, queries

SMALL = "/root/testdata/sf0.001"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
    return row[-1]


def near(a, b, edits):
    """Whether the distance is small; equal ends do not count."""
    if abs(len(a) - len(b)) > edits:
        return False
    k = 0
    while k < min(len(a), len(b)) and a[k] == b[k]:
        k += 1
    a, b = a[k:], b[k:]
    while a and b and a[-1] == b[-1]:
        a, b = a[:-1], b[:-1]
    return len(set(a) - set(b)) <= edits and distance(a, b) <= edits


def near_words(a, b, most=1):
    """The same by words, for long lines only."""
    one, two = a.split(" "), b.split(" ")
    long = min(len(a), len(b)) >= 60 and min(len(one), len(two)) >= 10
    return long and near(one, two, most)


def word_groups(known):
    """Long lines that can be one word apart: equal in the first or in the last half of the words of the shorter one."""
    found = {}
    for line in known:
        words = line.split(" ")
        for size in (len(words) - 1, len(words)):
            found.setdefault((size, 0, *words[: size // 2]), []).append(line)
            found.setdefault((size, 1, *words[len(words) - (size - size // 2) :]), []).append(line)
    return found.values()


def brute(rows, least=20, edits=2):
    first = {}
    for doc, text in sorted(rows):
        for k, line in enumerate(text.split("\n")):
            if line.strip(" "):
                first.setdefault(line.strip(" "), (doc, k))
    parent = {line: line for line in first}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    known = sorted((line for line in first if len(line) >= least), key=len)
    for k, a in enumerate(known):
        for b in known[k + 1 :]:
            if len(b) - len(a) > edits:
                break
            if near(a, b, edits):
                parent[find(a)] = find(b)
    for group in word_groups([line for line in known if len(line) >= 60]):
        for k, a in enumerate(group):
            for b in group[k + 1 :]:
                if find(a) != find(b) and near_words(a, b):
                    parent[find(a)] = find(b)
    kept = {}
    for line, place in first.items():
        kept[find(line)] = min(kept.get(find(line), place), place)
    stays = lambda doc, k, line: not line or kept[find(line)] == (doc, k)
    return {doc: "\n".join(x for k, x in enumerate(text.split("\n")) if stays(doc, k, x.strip(" "))) for doc, text in rows}


def test_query_over_the_table(spark):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = {r["doc_id"]: r["text"] for r in queries.op5_line_dedup(spark, SMALL).collect()}
    assert got == brute(rows)


def test_edited_lines(spark):
    rng = random.Random(5)
    letters = "abcdé 🦊"
    rows, base = [], ["".join(rng.choice(letters) for _ in range(rng.randint(20, 45))) for _ in range(40)]
    for k in range(160):
        text = list(rng.choice(base))
        for _ in range(rng.randint(0, 3)):
            at = rng.randrange(len(text))
            text[at : at + rng.randint(0, 1)] = [rng.choice(letters)] * rng.randint(0, 1)
        rows.append((k, "".join(text) + "\nshort\n" + "".join(rng.choice(letters) for _ in range(30))))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert {r["doc_id"]: r["text"] for r in lines.deduplicate(df).collect()} == brute(rows)


def test_long_lines_that_differ_in_one_word(spark):
    rng = random.Random(9)
    vocabulary = ["".join(rng.choice("abcdefg") for _ in range(rng.randint(3, 11))) for _ in range(300)]
    rows, base = [], [[rng.choice(vocabulary) for _ in range(rng.randint(9, 25))] for _ in range(12)]
    for k in range(150):
        words = list(rng.choice(base))
        for _ in range(rng.randint(0, 2)):
            at = rng.randrange(len(words))
            words[at : at + rng.randint(0, 1)] = rng.choice([[], ["sanctuary"], [""], [rng.choice(vocabulary)]])
        rows.append((k, " ".join(words)))
    same = "one sentence of rather many words in which the sixteenth and only that one is {} here and there"
    rows += [(200, same.format("extraordinary")), (201, same.format("plain")), (202, same.format("very plain")), (203, same.format("").replace("  ", " "))]
    rows += [(210, "few but long wordsthatcount sixtycharacters andmoretogether extraordinary"), (211, "few but long wordsthatcount sixtycharacters andmoretogether plain")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r["doc_id"]: r["text"] for r in lines.deduplicate(df).collect()}
    assert got == brute(rows)
    assert [got[k] == "" for k in (200, 201, 202, 203, 210, 211)] == [False, True, True, True, False, False]
    rest = {r["doc_id"]: r["text"] for r in lines.deduplicate(df, word_edits=0).collect()}
    assert rest[201] == rows[151][1]


@pytest.mark.parametrize("edits", [1, 2, 3])
def test_automaton_is_the_edit_distance(spark, edits):
    rng = random.Random(edits)
    pairs = [("", ""), ("", "ab"), ("ab", ""), ("abc", "abc"), ("🦊b", "b🦊")]
    for _ in range(300):
        a = "".join(rng.choice("ab") for _ in range(rng.randint(0, 9)))
        b = "".join(rng.choice("ab") for _ in range(rng.randint(0, 9)))
        pairs.append((a, b))
    chars = lambda c: F.filter(F.split(c, ""), lambda x: x != "")
    df = spark.createDataFrame(pairs, "a string, b string")
    arrays = df.select("a", "b", lines.padded(chars("a"), edits).alias("one"), chars("b").alias("two"))
    rows = arrays.select("a", "b", lines.within(F.col("one"), F.col("two"), edits).alias("w")).collect()
    assert all(r["w"] == (distance(r["a"], r["b"]) <= edits) for r in rows)


def test_odd_rows(spark):
    line, other = "a line that is long enough to count", "another line, long enough as well"
    rows = [
        (2, f"{line}\nkept\n{other}", 1),
        (1, f"  {line} ", 2),
        (3, f"{line}\n{line}", 3),
        (4, None, 4),
        (5, "", 5),
        (None, other, 6),
        (6, "x" * 200_000 + "\n" + other, 7),
        (6, "x" * 200_000 + "\n" + other, 7),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_chars long").selectExpr("*", "1 AS row", "2 AS a", "3 AS _gone", "4 AS _row", "5 AS n_removed")
    out = lines.deduplicate(df, report=True)
    assert out.columns == [*df.columns[:-1], "n_lines", "n_removed"]
    assert {(r["row"], r["a"], r["_gone"], r["_row"]) for r in out.collect()} == {(1, 2, 3, 4)}
    got = sorted(((r["doc_id"] or 0), r["text"], r["n_lines"], r["n_removed"], r["n_chars"]) for r in out.filter("doc_id <> 4 OR doc_id IS NULL").collect())
    assert got == [
        (0, other, 1, 0, 6),
        (1, f"  {line} ", 1, 0, 2),
        (2, "kept", 3, 2, 1),
        (3, "", 2, 2, 3),
        (5, "", 1, 0, 5),
        (6, "x" * 200_000, 2, 1, 7),
        (6, "x" * 200_000, 2, 1, 7),
    ]
    assert out.filter("doc_id = 4").first()["text"] is None
    assert lines.deduplicate(df.limit(0)).count() == 0


def test_short_lines_go_as_exact_repeats(spark):
    rows = [(1, "Les.\n\nend\nshort line 1"), (2, " Les. \n\nmore\nshort line 2\nend"), (3, "Les.\n \nLes.\nlast\nlast")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in lines.deduplicate(df, report=True).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("\nmore\nshort line 2", 2), 3: (" \nlast", 3)}


def test_texts_of_very_many_lines(spark):
    """Removal stays linear in the lines of one text."""
    text = "the same line that stands here again\n" * 300_000 + "end"
    out = lines.deduplicate(spark.createDataFrame([(1, text), (2, "end")], "doc_id long, text string"), report=True)
    got = {r["doc_id"]: (r["text"], r["n_removed"]) for r in out.collect()}
    assert got == {1: ("the same line that stands here again\nend", 299_999), 2: ("", 1)}


def test_a_line_has_few_keys(spark):
    line = "a line of forty words stands here " * 6
    rows = spark.createDataFrame([(1, line[:200]), (2, "é" + line[:200])], "doc_id long, text string")
    signed = lines._signed(lines._lines(rows, "doc_id", "text", 20), 2, 1)
    assert max(r["count"] for r in signed.groupBy("a").count().collect()) <= 9


def test_near_lines_across_the_sizes_of_segments(spark):
    rng = random.Random(3)
    letters, vocabulary = "abcdefgé", ["".join(rng.choice("abcdefg") for _ in range(6)) for _ in range(200)]
    known = set()
    for size in (20, 31, 32, 33, 63, 64, 66, 72, 127, 128, 129, 144, 257):
        for _ in range(3):
            base = [rng.choice(letters) for _ in range(size)]
            known.add("".join(base))
            for _ in range(8):
                text = list(base)
                for _ in range(2):
                    at = rng.randrange(len(text))
                    text[at : at + rng.randint(0, 1)] = [rng.choice(letters)] * rng.randint(0, 1)
                known.add("".join(text))
    for size in (10, 11, 15, 16, 17, 18, 31, 32, 33, 36):
        base = [rng.choice(vocabulary) for _ in range(size)]
        known.add(" ".join(base))
        for at in (0, size // 2 - 1, size // 2, size // 2 + 1, size - 1):
            known |= {" ".join([*base[:at], *new, *base[at + cut :]]) for new, cut in ((["x" * 9], 1), ([], 1), (["y" * 9], 0))}
    known = sorted(line for line in known if len(line) >= 20 and line == line.strip(" "))
    df = spark.createDataFrame(list(enumerate(known)), "doc_id long, text string").repartition(3)
    names = lines._lines(df, "doc_id", "text").select("id", "a")
    found = lines.links(df).join(names.toDF("x", "a"), "a").join(names.toDF("y", "other"), "other")
    got = {tuple(sorted((known[r["x"]], known[r["y"]]))) for r in found.collect()}
    pairs = ((a, b) for k, a in enumerate(known) for b in known[k + 1 :] if abs(len(a) - len(b)) < 12)
    assert got == {(a, b) for a, b in pairs if near(a, b, 2) or near_words(a, b)}
