"""Reply trees as training conversations.

Messages point to the one that they answer. Self-joins that double their reach enumerate the path from the root to
each leaf; branches are ranked by score and each chosen path becomes one text with a loss mask. The template
marks turns by control strings; where a text itself holds one, a backslash goes after its first character, and
one more where there are some already, so that every text can be read back as it was.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerwell.llm.common import checkpointed

BEGIN, BREAK, END = "<|im_start|>", "\n", "<|im_end|>\n"
#: Control strings of common chat templates, without their first character. Fixed values.
CONTROL = {
    "<": ["|im_start|>", "|im_end|>", "|endoftext|>", "s>", "/s>", "<SYS>>", "</SYS>>", "unk>", "pad>"],
    "[": ["INST]", "/INST]"],
}


def _quoted(text: str) -> str:
    return "".join(f"\\{c}" if c in "\\|[]<>/." else c for c in text)


_ALTERNATIVES = {first: "(?:" + "|".join(map(_quoted, rest)) + ")" for first, rest in CONTROL.items()}


def escaped(text: Column) -> Column:
    """Text in which no control string is left."""
    for first, rest in _ALTERNATIVES.items():
        text = F.regexp_replace(text, rf"{_quoted(first)}(\\*)(?={rest})", f"\\{first}$1\\\\")
    return text


def unescaped(text: Column) -> Column:
    """The inverse of ``escaped``."""
    for first, rest in _ALTERNATIVES.items():
        text = F.regexp_replace(text, rf"{_quoted(first)}\\(\\*)(?={rest})", f"\\{first}$1")
    return text


def escaped_role(role: Column) -> Column:
    """A role on one line: backslash and line break become two characters."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\b")), F.lit("\n"), F.lit("\\n")))


def unescaped_role(role: Column) -> Column:
    return F.replace(F.replace(unescaped(role), F.lit("\\n"), F.lit("\n")), F.lit("\\b"), F.lit("\\"))


def _key(column: str) -> Column:
    """A column as text that is never NULL, so that NULL is a value of its own."""
    return F.when(F.col(column).isNull(), F.lit("")).otherwise(F.concat(F.lit("="), F.col(column).cast("string")))


def answered(messages: DataFrame) -> DataFrame:
    """Messages whose ``parent`` is NULL where it is no message of the tree: those are roots."""
    known = messages.select("tree", F.col("node").alias("parent"), F.lit(True).alias("known"))
    joined = messages.join(known, ["tree", "parent"], "left")
    return joined.withColumn("parent", F.when(F.col("known"), F.col("parent"))).drop("known")


def paths(messages: DataFrame) -> DataFrame:
    """Ways from each leaf up to its root, of messages (``tree``, ``node``, ``parent``; the first two not NULL).

    Rows (``tree``, ``leaf``, ``node``, ``back``): back counts the steps from the leaf. Pointers double their reach with
    each join, so the number of joins grows with the logarithm of the longest path. A path that runs in a circle
    never comes to a root.
    """
    up = messages.select("tree", "node", "parent").filter("parent IS NOT NULL")
    longest = messages.groupBy("tree").count().agg(F.max("count")).first()[0] or 0
    jumps = [up]
    # A path has fewer steps than its tree has messages.
    while 1 << len(jumps) < longest:
        last = jumps[-1]
        onward = last.select("tree", F.col("node").alias("parent"), F.col("parent").alias("far"))
        further = last.join(onward, ["tree", "parent"]).select("tree", "node", F.col("far").alias("parent"))
        jumps.append(checkpointed(further))
        if jumps[-1].isEmpty():
            break
    parents = up.select("tree", F.col("parent").alias("node"))
    leaves = messages.select("tree", "node").join(parents, ["tree", "node"], "left_anti")
    found = checkpointed(leaves.select("tree", F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("back")))
    for k in reversed(range(len(jumps))):
        further = found.join(jumps[k], ["tree", "node"])
        step = further.select("tree", "leaf", F.col("parent").alias("node"), (F.col("back") + (1 << k)).alias("back"))
        found = checkpointed(found.unionByName(step))
    return found


def format_trees(
    messages: DataFrame,
    tree: str = "conv_id",
    node: str = "message",
    parent: str = "parent",
    role: str = "role",
    text: str = "text",
    score: str | None = None,
    branches: int | None = None,
    learned: tuple[str, ...] = ("assistant",),
) -> DataFrame:
    """One row per chosen root-to-leaf path: its text under the template and where the loss applies.

    Columns: ``tree`` under its own name, ``leaf``, ``branch_rank``, ``branch_score``, ``formatted``, ``spans`` (array of
    ``start``, ``length`` in code points, one per learned turn, in order). Branches of a tree rank by the sum of
    ``score`` along the path (NULL counts 0), then by leaf; the first ``branches`` are chosen, all if None. NULL
    roles and texts count as empty; a NULL tree is a tree of its own; messages without an id are left out, and so are
    those that lead into a circle; one whose parent is NULL or unknown is a root; of
    several messages with one id the one with the least parent, role and text stays. Other columns are ignored.
    """
    points = F.coalesce(F.col(score).cast("double"), F.lit(0.0)) if score else F.lit(0.0)
    given = messages.select(
        _key(tree).alias("tree"),
        F.col(tree).alias("name"),
        F.col(node).alias("node"),
        F.struct(
            F.col(parent).alias("parent"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
            points.alias("points"),
        ).alias("m"),
    ).filter("node IS NOT NULL")
    single = given.groupBy("tree", "node").agg(F.first("name").alias("name"), F.min("m").alias("m"))
    single = checkpointed(answered(single.select("tree", "node", "name", "m.*")))
    found = paths(single)
    scored = found.join(single.select("tree", "node", "parent", "points"), ["tree", "node"])
    ranked = scored.groupBy("tree", "leaf").agg(
        F.sum("points").alias("branch_score"), F.max(F.col("parent").isNull()).alias("rooted")
    )
    order = Window.partitionBy("tree").orderBy(F.col("branch_score").desc(), "leaf")
    ranked = ranked.filter("rooted").drop("rooted").withColumn("branch_rank", F.row_number().over(order))
    if branches is not None:
        ranked = ranked.filter(F.col("branch_rank") <= branches)
    chosen = checkpointed(found.join(ranked, ["tree", "leaf"]))
    steps = chosen.join(single.drop("parent", "points"), ["tree", "node"])
    branch = ["tree", "leaf", "branch_rank", "branch_score"]
    head = F.concat(F.lit(BEGIN), escaped_role(F.col("role")), F.lit(BREAK))
    turns = steps.select(*branch, "name", "back", "role", head.alias("head"), escaped(F.col("text")).alias("body"))
    before = Window.partitionBy("tree", "leaf").orderBy(F.col("back").desc())
    turns = turns.withColumn("whole", F.concat("head", "body", F.lit(END)))
    turns = turns.withColumn("until", F.sum(F.length("whole")).over(before))
    start = F.col("until") - F.length("whole") + F.length("head")
    span = F.when(F.col("role").isin(*learned), F.struct(start.alias("start"), F.length("body").cast("long").alias("length")))
    turn = F.struct((-F.col("back")).alias("step"), "whole", span.alias("span"))
    joined = turns.groupBy(*branch).agg(F.first("name").alias("name"), F.sort_array(F.collect_list(turn)).alias("turns"))
    return joined.select(
        F.col("name").alias(tree),
        "leaf",
        "branch_rank",
        "branch_score",
        F.array_join("turns.whole", "").alias("formatted"),
        F.filter("turns.span", lambda s: s.isNotNull()).alias("spans"),
    )


def read_back(formatted: Column) -> Column:
    """Turns of a formatted text: array of ``role`` and ``text``, unescaped."""
    pieces = F.split(formatted, _quoted(END.strip()) + "\n")
    pieces = F.slice(pieces, 1, F.size(pieces) - 1)

    def turn(piece: Column) -> Column:
        rest = F.substring(piece, len(BEGIN) + 1, 2**31 - 1)
        role = F.substring_index(rest, BREAK, 1)
        body = F.substr(rest, F.length(role) + 2)
        return F.struct(unescaped_role(role).alias("role"), unescaped(body).alias("text"))

    return F.transform(pieces, turn)


def masked(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped and joined."""
    parts = F.transform(spans, lambda s: unescaped(F.substr(formatted, (s["start"] + 1).cast("int"), s["length"].cast("int"))))
    return F.array_join(parts, "")
