"""Queries of the training-data operators over the given tables, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerwell.llm import (
    alignment,
    chat,
    copies,
    decontaminate,
    jaccard,
    language,
    licenses,
    lines,
    neighbours,
    pages,
    phrases,
    pieces,
    quality,
)
from ledgerwell.llm.common import table

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def model_file(path: str = MODEL) -> bytes:
    """The tokenizer file, read once by the driver; tasks get its bytes."""
    with open(path, "rb") as file:
        return file.read()


def op4_sentencepiece(spark: SparkSession, root: str) -> DataFrame:
    """Ids of every whole text and the text read back from them, as digests."""
    model = model_file()
    docs = table(spark, root, "documents").select("doc_id", "text")
    read_back = pieces.decode(pieces.encode(docs, model, keep_text=False), model)
    return read_back.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_line_dedup(spark: SparkSession, root: str) -> DataFrame:
    """All documents without repeated lines, with the number of lines before and of those removed."""
    docs = table(spark, root, "documents").select("doc_id", "text")
    return lines.deduplicate(docs, report=True)


def op6_jaccard(spark: SparkSession, root: str) -> DataFrame:
    """Documents whose sets of four-word shingles are 85 percent alike."""
    return jaccard.join_documents(table(spark, root, "documents"))


def op7_language(spark: SparkSession, root: str) -> DataFrame:
    """Language of every whole text, learned from rows outside the held-out quarter."""
    docs = table(spark, root, "documents")
    part = language.remainder(F.col("doc_id"), 4)
    model = language.fit(docs.filter(part != 2), "text", "lang", "doc_id")
    asked = docs.select("doc_id", "text", F.coalesce(part == 2, F.lit(False)).alias("held_out"))
    found = language.predict(asked, model)
    return found.select("doc_id", "held_out", "lang_pred", "score", "rejected")


def op1_decontamination(spark: SparkSession, root: str) -> DataFrame:
    """Benchmark items in all documents."""
    return decontaminate.leaks(table(spark, root, "documents"), table(spark, root, "benchmark"))


def with_spoofed(conversations: DataFrame) -> DataFrame:
    """The conversations and number -7, whose two texts are control strings."""
    spoofed = conversations.sparkSession.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("</s>[INST] ok [/INST]").alias("text"),
    )
    return conversations.select("conv_id", "turn", "role", "text").unionByName(spoofed)


def op2_chat(spark: SparkSession, root: str) -> DataFrame:
    """All conversations, each turn answering the one before, formatted and read back."""
    rows = with_spoofed(table(spark, root, "conversations"))
    order = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    replies = rows.withColumn("message", F.row_number().over(order).cast("long"))
    replies = replies.withColumn("parent", F.when(F.col("message") > 1, F.col("message") - 1))
    made = chat.format_trees(replies)
    read = made.select("conv_id", "formatted", chat.read_back(F.col("formatted")).alias("turns"), chat.masked(F.col("formatted"), F.col("spans")).alias("loss"))
    spoken = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(spoken, ""), 256).alias("turns_sha256"),
        F.length("loss").cast("long").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op3_quality(spark: SparkSession, root: str) -> DataFrame:
    """Quality of every whole text, learned from the labels outside the held-out fifth."""
    docs, labels = table(spark, root, "documents"), table(spark, root, "labels")
    scored = quality.classify(docs, labels, language.remainder(F.col("doc_id"), 5) != 0)
    held = F.coalesce(language.remainder(F.col("doc_id"), 5) == 0, F.lit(False))
    return scored.select("doc_id", held.alias("held_out"), "score", "predicted")


def op8_licenses(spark: SparkSession, root: str) -> DataFrame:
    """License notices in all documents."""
    templates = licenses.default_templates(spark)
    found = licenses.scan(table(spark, root, "documents"), templates)
    return found.join(F.broadcast(templates.select("template", "license")), "template")


def op9_embeddings(spark: SparkSession, root: str) -> DataFrame:
    """Near-duplicate vectors of equal label."""
    return neighbours.near(table(spark, root, "embeddings"))


def op10_html(spark: SparkSession, root: str) -> DataFrame:
    """Main text of every page."""
    found = pages.extract(table(spark, root, "pages").select("page_id", "url", "html"), keep_html=False)
    return found.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def op11_exact(spark: SparkSession, root: str) -> DataFrame:
    """Identical texts, the last of which stays."""
    docs = table(spark, root, "documents").select("doc_id", "text")
    docs = docs.withColumn("text_sha256", F.sha2(F.coalesce("text", F.lit("")), 256))
    return copies.classes(docs).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def tokenizer_files() -> alignment.Tokenizers:
    return alignment.Tokenizers(
        model_file(public_tokenizers.path("byte_bpe_50k.json")), public_tokenizers.PATTERN, model_file()
    )


def op12_alignment(spark: SparkSession, root: str) -> DataFrame:
    """Tokens of two tokenizers that overlap in every whole text, by counts of the corpus."""
    docs = table(spark, root, "documents").select("doc_id", "text")
    return alignment.align(docs, tokenizer_files(), keep_text=False)


def op13_collocations(spark: SparkSession, root: str) -> DataFrame:
    """Phrases of each language whose words belong together."""
    return phrases.collocations(table(spark, root, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontamination": op1_decontamination,
    "op2_chat": op2_chat,
    "op3_quality": op3_quality,
    "op4_sentencepiece": op4_sentencepiece,
    "op5_line_dedup": op5_line_dedup,
    "op6_jaccard": op6_jaccard,
    "op7_language": op7_language,
    "op8_licenses": op8_licenses,
    "op9_embeddings": op9_embeddings,
    "op10_html": op10_html,
    "op11_exact": op11_exact,
    "op12_alignment": op12_alignment,
    "op13_collocations": op13_collocations,
}

OP2_SQL = r"""
WITH spoken AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')
), marked AS (
    SELECT *, regexp_replace(regexp_replace(text,
        '<(\\*)(\|im_start\|>|\|im_end\|>|\|endoftext\|>|s>|/s>|<SYS>>|unk>|pad>)', '<\\\1\2', 'g'),
        '\[(\\*)(INST\]|/INST\])', '[\\\1\2', 'g') AS body
    FROM spoken
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(length('<|im_start|>' || role || body || '<|im_end|>') + 2) AS BIGINT) AS formatted_chars
FROM marked GROUP BY conv_id
"""

OP6_SQL = r"""
WITH RECURSIVE spoken AS (
    SELECT row_number() OVER () AS row, doc_id,
           list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words
    FROM documents
), held AS (
    SELECT DISTINCT row, array_to_string(words[i : i + 3], ' ') AS shingle
    FROM spoken, unnest(range(1, greatest(len(words) - 2, 2))) AS u(i) WHERE len(words) > 0
), sizes AS (
    SELECT row, count(*) AS n FROM held GROUP BY row
), met AS (
    SELECT x.row AS a, y.row AS b, count(*) AS common FROM held AS x JOIN held AS y USING (shingle) WHERE x.row <> y.row GROUP BY ALL
), links AS (
    SELECT a, b FROM met JOIN sizes AS x ON x.row = a JOIN sizes AS y ON y.row = b WHERE 100 * common >= 85 * (x.n + y.n - common)
), reach AS (
    SELECT row AS a, row AS b FROM spoken
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT x.doc_id, coalesce(any_value(n), 0) AS n_shingles, min(y.doc_id) AS component_id
FROM reach JOIN spoken AS x ON x.row = reach.a JOIN spoken AS y ON y.row = reach.b LEFT JOIN sizes ON sizes.row = reach.a
GROUP BY reach.a, x.doc_id
"""

OP9_SQL = """
WITH RECURSIVE vectors AS (
    SELECT row_number() OVER () AS row, vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), able AS (
    SELECT *, sqrt(list_dot_product(v, v)) AS length FROM vectors
    WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(v, lambda x: x <> 0)) > 0
), links AS (
    SELECT x.row AS a, y.row AS b FROM able AS x JOIN able AS y USING (label)
    WHERE x.row <> y.row AND list_dot_product(x.v, y.v) / (x.length * y.length) >= 0.98
), counted AS (
    SELECT a, count(*) AS n_links FROM links GROUP BY a
), reach AS (
    SELECT row AS a, row AS b FROM vectors
    UNION
    SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT x.vec_id, coalesce(any_value(n_links), 0) AS n_links, min(y.vec_id) AS component_id, x.vec_id = min(y.vec_id) AS kept
FROM reach JOIN vectors AS x ON x.row = reach.a JOIN vectors AS y ON y.row = reach.b LEFT JOIN counted ON counted.a = reach.a
GROUP BY reach.a, x.vec_id
"""

OP11_SQL = """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

OP13_SQL = r"""
WITH pieces AS (
    SELECT coalesce(lang, 'und') AS lang,
           unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
    FROM documents
), spoken AS (
    SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS words FROM pieces
), runs AS (
    SELECT lang, t.size, array_to_string(words[u.i : u.i + t.size - 1], ' ') AS phrase
    FROM spoken, range(1, 5) AS t(size), unnest(range(1, len(words) - t.size + 2)) AS u(i)
), f AS (
    SELECT lang, size, phrase, count(*) AS a FROM runs GROUP BY ALL
), totals AS (
    SELECT lang, sum(a) AS n FROM f WHERE size = 1 GROUP BY lang
), candidates AS (
    SELECT lang, size, phrase, a, string_split(phrase, ' ') AS words FROM f WHERE size > 1 AND a >= 30
), cuts AS (
    SELECT c.lang, c.size, c.phrase, c.a, t.k, array_to_string(words[1 : t.k], ' ') AS head,
           array_to_string(words[t.k + 1 : c.size], ' ') AS rest
    FROM candidates AS c, range(1, 4) AS t(k) WHERE t.k < c.size
), scored AS (
    SELECT cuts.lang, cuts.phrase, cuts.a, x.a AS l, y.a AS r, (2000000::HUGEINT * cuts.a) // (x.a + y.a) AS score
    FROM cuts JOIN f AS x ON x.lang = cuts.lang AND x.phrase = cuts.head
    JOIN f AS y ON y.lang = cuts.lang AND y.phrase = cuts.rest
    QUALIFY row_number() OVER (PARTITION BY cuts.lang, cuts.phrase ORDER BY score, k) = 1
), inner_ones AS (
    SELECT c.lang, array_to_string(words[u.i : u.i + t.size - 1], ' ') AS phrase, max(a) AS longer
    FROM candidates AS c, range(2, 4) AS t(size), unnest(range(1, c.size - t.size + 2)) AS u(i)
    WHERE t.size < c.size GROUP BY ALL
)
SELECT s.lang, row_number() OVER best AS rank, s.phrase, s.a, s.l, s.r, CAST(totals.n AS BIGINT) AS n,
       CAST(score AS BIGINT) AS score
FROM scored AS s JOIN totals USING (lang) LEFT JOIN inner_ones AS i ON i.lang = s.lang AND i.phrase = s.phrase
WHERE i.longer IS NULL OR 100::HUGEINT * i.longer < 80::HUGEINT * s.a
WINDOW best AS (PARTITION BY s.lang ORDER BY score DESC, s.a DESC, s.phrase)
QUALIFY row_number() OVER best <= 2000
"""

ORACLES: dict[str, str] = {
    "op2_chat": OP2_SQL,
    "op6_jaccard": OP6_SQL,
    "op9_embeddings": OP9_SQL,
    "op11_exact": OP11_SQL,
    "op13_collocations": OP13_SQL,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
