"""Phrase mining against counting by text."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from ledgerwell.llm import phrases
from ledgerwell.llm.phrases import Mining


def plain(rows, mining):
    lower = {c: c + 32 for c in range(65, 91)}
    counts = Counter()
    totals = Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", (text or "").translate(lower)):
            words = [w for w in re.split("[ \t]+", piece) if w]
            totals[lang] += len(words)
            for n in range(1, mining.words + 1):
                for k in range(len(words) - n + 1):
                    counts[lang, tuple(words[k : k + n])] += 1
    out = []
    frequent = {x: a for x, a in counts.items() if a >= mining.least and len(x[1]) > 1}
    longest = Counter()
    for (lang, words), a in frequent.items():
        for n in range(2, len(words)):
            for k in range(len(words) - n + 1):
                longest[lang, words[k : k + n]] = max(longest[lang, words[k : k + n]], a)
    for (lang, words), a in frequent.items():
        if longest[lang, words] and 100 * longest[lang, words] >= mining.inside * a:
            continue
        cuts = [(k, counts[lang, words[:k]], counts[lang, words[k:]]) for k in range(1, len(words))]
        score, _, l, r = min((2_000_000 * a // (l + r), k, l, r) for k, l, r in cuts)
        out.append((lang, " ".join(words), a, l, r, totals[lang], score))
    best = []
    for lang in sorted({x[0] for x in out}):
        own = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))
        best += [(lang, rank, *x[1:]) for rank, x in enumerate(own[: mining.top], 1)]
    return best


def corpus():
    rng = random.Random(4)
    words = "the The of and x é Ébc 日本 a-b 'tis \x00 wide　one".split(" ")
    rows = []
    for _ in range(300):
        size = rng.randint(0, 40)
        text = "".join(rng.choice(words) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "\r\n"]) for _ in range(size))
        rows.append((text, rng.choice(["en", "en", "fr", None, "und"])))
    rows += [(None, "en"), ("", None), (" \t\n.", "de"), ("na na na na na na na na", "fr")] * 8
    return rows + [("over and over " * 3000, "en")]


@pytest.mark.parametrize(
    "mining", [Mining(least=30), Mining(least=5, top=7), Mining(words=3, least=2, inside=50), Mining(words=2), Mining(least=3, mask=63)]
)
def test_collocations_of_odd_texts(spark, mining):
    rows = corpus()
    df = spark.createDataFrame([(t, l, "mine", 1) for t, l in rows], "text string, lang string, phrase string, row int").repartition(3)
    out = phrases.collocations(df, mining=mining).collect()
    assert sorted(tuple(r) for r in out) == sorted(plain(rows, mining))


def test_portions_change_nothing(spark, monkeypatch):
    rows = corpus()[:120]
    monkeypatch.setattr(phrases, "PORTION", 50)
    df = spark.createDataFrame(rows, "text string, lang string").coalesce(1)
    mining = Mining(least=4)
    assert sorted(tuple(r) for r in phrases.collocations(df, mining=mining).collect()) == sorted(plain(rows, mining))


def test_no_texts(spark):
    empty = spark.createDataFrame([], "text string, lang string")
    assert phrases.collocations(empty).count() == 0
    assert phrases.collocations(spark.createDataFrame([(None, "en"), ("", None)], "text string, lang string")).count() == 0


def test_fingerprints_do_not_depend_on_the_place():
    data = np.frombuffer(b"one two. one two three one two", dtype=np.uint8)
    words = phrases.find_words(data, np.array([0, len(data)]))
    hashes = phrases.FIRST.words(words.data, words.firsts, words.lasts)
    at = words.runs(2)
    keys = phrases.keys_of(words, 2, at, phrases.FIRST, hashes, np.zeros(1, dtype=np.uint64))
    assert at.tolist() == [0, 2, 3, 4, 5] and keys[0] == keys[1] == keys[4] and len(set(keys.tolist())) == 3
