"""Alignment of two tokenizers against the libraries and plain loops."""

import hashlib
import random
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from ledgerwell.llm import alignment, queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def files():
    return queries.tokenizer_files()


@pytest.fixture(scope="module")
def plain(files):
    """Tokens of both as (id, bytes) by the libraries that own the files."""
    first = Tokenizer.from_str(files.bytes_file.decode())
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_proto=files.pieces_file)
    alphabet = {c: bytes([b]) for c, b in alignment._alphabet().items()}
    names = {i: b"".join(alphabet.get(c, b"?") for c in t) for t, i in first.get_vocab().items()}

    def piece(i):
        name = second.id_to_piece(i)
        return bytes([int(name[3:5], 16)]) if second.is_byte(i) else name.replace("▁", " ").encode()

    def tokens(text):
        a = [(i, names[i]) for i in first.encode(" " + text, add_special_tokens=False).ids]
        b = [(i, piece(i)) for i in second.encode(text)]
        whole = (" " + text).encode()
        if not text or b"".join(x for _, x in a) != whole or b"".join(x for _, x in b) != whole:
            return [], []
        return a, b

    return tokens


def spans(tokens):
    out, at = [], 0
    for i, content in tokens:
        out.append((i, at, at + len(content)))
        at += len(content)
    return out


def overlaps(a, b):
    """All pairs whose ranges overlap, by comparing every token with every other one nearby."""
    found, low = [], 0
    for i, s, e in a:
        while low < len(b) and b[low][2] <= s:
            low += 1
        k = low
        while k < len(b) and b[k][1] < e:
            found.append((i, b[k][0]))
            k += 1
    return found


def spelled(a, b):
    ends = sorted({e for *_, e in a} & {e for *_, e in b})
    parts, low = [], 0
    for end in ends:
        sides = [",".join(str(i) for i, s, e in side if low <= s and e <= end) for side in (a, b)]
        parts.append("|".join(sides))
        low = end
    return ";".join(parts)


def expected(texts, plain):
    rows = [tuple(map(spans, plain(t or ""))) for t in texts]
    links = [overlaps(a, b) for a, b in rows]
    counts = Counter(x for found in links for x in found)
    best = {}
    for (_, b), n in counts.items():
        best[b] = max(best.get(b, 0), n)
    out = []
    for (a, b), found in zip(rows, links):
        whole = spelled(a, b) if a else ""
        groups = len({e for *_, e in a} & {e for *_, e in b})
        digest = hashlib.sha256(whole.encode()).hexdigest() if a else ""
        numbers = (len(a), len(b), groups, len(found), sum(counts[x] == best[x[1]] for x in found), sum(counts[x] for x in found))
        out.append((*numbers, digest, whole))
    return out


NAMES = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def odd_texts():
    rng = random.Random(5)
    letters = "abthe  \n\t\r né🦊日<s>.;{}(),!0123THE ing'’"
    fixed = [None, "", " ", "  ", "\n", "\r\n x", "a\r\n\r\nb", "\t\tx  y", "▁x", "so ▁ far", "<|endoftext|> <s></s> <unk> <0x0A>", " " * 70 + "x"]
    fixed += ["the " * 3000, "a" * 4000, "don't we'll it's", "x );\r\n\t}\r y", " wide　 space", "日本語 テスト", "to be", "to be"]
    return fixed + ["".join(rng.choice(letters) for _ in range(rng.randint(1, 90))) for _ in range(300)]


@pytest.mark.parametrize("most", [4_000_000, 300])
def test_odd_texts_in_one_and_in_several_rounds(spark, files, plain, most):
    texts = odd_texts()
    rows = [(k, t, "mine", 1) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_a string, shard int").repartition(3)
    out = alignment.align(df, files, most=most, spell="spelled").orderBy("doc_id").collect()
    want = expected(texts, plain)
    assert [tuple(r[c] for c in (*NAMES, "spelled")) for r in out] == want
    assert all(r["shard"] == 1 and r["text"] == t for r, t in zip(out, texts))


def test_query_over_the_table(spark, plain):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    want = {k: row[:-1] for (k, _), row in zip(docs, expected([t for _, t in docs], plain))}
    out = queries.op12_alignment(spark, SMALL).collect()
    assert len(out) == len(docs)
    assert {r["doc_id"]: tuple(r[c] for c in NAMES) for r in out} == want


def test_empty_tables_and_tables_without_tokens(spark, files):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(empty, files).count() == 0
    none = spark.createDataFrame([(1, None), (None, ""), (None, "")], "doc_id long, text string")
    assert [tuple(r[c] for c in NAMES) for r in alignment.align(none, files).collect()] == [(0, 0, 0, 0, 0, 0, "")] * 3


def test_perfect_hash_gives_every_key_its_own_place():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 1 << 40, 20_000)) // alignment.BASE * alignment.BASE + 7
    keys = np.unique(keys)
    place = alignment.Places({7: alignment.perfect_hash(keys)})
    assert sorted(place(keys)) == list(range(len(keys)))
    assert (alignment.Places({})(keys) == -1).all()


def test_small_slices_change_nothing(files, monkeypatch):
    aligner = alignment.aligner_of(files)
    texts = odd_texts()
    whole = aligner.align(texts)
    for k, text in enumerate(texts):
        one = aligner.align([text])
        for name in ("n_a", "n_b", "n_groups", "n_links"):
            assert one.per_text(getattr(one, name))[0] == whole.per_text(getattr(whole, name))[k]
