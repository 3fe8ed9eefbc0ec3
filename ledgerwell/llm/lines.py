"""Repeated and nearly repeated lines: an edit-distance join by segments.

If two lines differ by at most T edits and one is cut into T + 1 segments, one segment stands unchanged in the other,
near its own place. So every line files its segments under its length and looks up the substrings of the lengths and
places that can match. Pairs that also agree in two parity sketches, which T edits can change in few bits only, are
verified by a banded bit-parallel automaton. Long lines are joined a second time by the same method with words in the
place of characters, so that a replaced word counts as one edit however long it is. All of it is built-in functions.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerwell.llm.common import checkpointed, components, fresh

EDITS = 2
#: Lines of at least so many characters and words may also differ in so many words.
LONG, WORDS, WORD_EDITS = 60, 10, 1
#: Tables of at most this many short rows are broadcast; larger ones are joined by shuffle.
BROADCAST_ROWS = 500_000


def _small(df: DataFrame) -> DataFrame:
    """A checkpointed table of short rows, broadcast if they are few."""
    return F.broadcast(df) if df.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else df


def _positions(edits: int) -> list[tuple[int, int, int, bool]]:
    """Where substrings are looked up: (difference in length, segment, shift, same as filed)."""
    out = []
    for longer in range(edits + 1):
        for segment in range(1, edits + 2):
            low = max(-(segment - 1), longer - (edits + 1 - segment))
            high = min(segment - 1, longer + (edits + 1 - segment))
            out += [(longer, segment, shift, longer == 0 and shift == 0) for shift in range(low, high + 1)]
    return out


def _grade(size: Column) -> Column:
    """The size rounded down to one of eight steps between powers of two; sizes below 16 stay as they are."""
    bits = F.greatest(F.length(F.bin(size)) - 4, F.lit(0)).cast("int")
    return F.call_function("shiftleft", F.call_function("shiftright", size, bits), bits)


def _signed(lines_: DataFrame, edits: int, word_edits: int) -> DataFrame:
    """Keys of lines: ``a``, ``line``, ``key``, ``filed`` (its own segments; these are looked up as well), ``by_word``.

    Lines of one grade share the size of their segments: all but the last are cut from the start, the last from the
    end, and what is left over before it belongs to none. So the places for shorter lines are tried only where some of
    those have another grade; otherwise the places for a line of the same length hold them. The places are a table that
    lines are multiplied by, not an expression for each place: so much code would run uncompiled. Grades are found
    before, once for a line, and lines of one byte a character are cut by bytes, as characters have to be counted.
    """
    names = ("longer", "segment", "shift", "filed", "parts", "by_word")

    def grades(size: Column, most: int) -> Column:
        return F.array(*(_grade(size - longer) for longer in range(most + 1)))

    def places(most: int, by_word: bool, alike: bool) -> list[Column]:
        rows = [(*place, most + 1, by_word) for place in _positions(most) if not alike or place[0] == 0]
        return [F.struct(*(F.lit(v).alias(n) for n, v in zip(names, row))) for row in rows]

    sized = lines_.select("a", "line", F.length("line").alias("letters"), F.size(_words(F.col("line"))).alias("words"))
    graded = sized.withColumns(
        {
            "fine": grades(F.col("letters"), edits),
            "coarse": grades(F.col("words"), word_edits),
            "bytes": F.when(F.octet_length("line") == F.col("letters"), F.col("line").cast("binary")),
        }
    )
    fine_alike, coarse_alike = F.col("fine")[edits] == F.col("fine")[0], F.col("coarse")[word_edits] == F.col("coarse")[0]

    def chosen(fine: bool) -> Column:
        letters = places(edits, False, fine)
        both = (F.array(*letters, *places(word_edits, True, coarse)) for coarse in (True, False))
        return F.when(~_is_long(), F.array(*letters)).when(coarse_alike, next(both)).otherwise(next(both))

    spread = graded.withColumn("p", F.explode(F.when(fine_alike, chosen(True)).otherwise(chosen(False))))
    size = F.when(F.col("p.by_word"), F.col("words")).otherwise(F.col("letters")).alias("size")
    grade = F.when(F.col("p.by_word"), F.col("coarse")[F.col("p.longer")]).otherwise(F.col("fine")[F.col("p.longer")])
    cut = spread.select("a", "line", "bytes", size, grade.alias("grade"), "p.*")
    count = F.floor(F.col("grade") / F.col("parts")).cast("int")
    cut = cut.withColumns({"length": F.col("size") - F.col("longer"), "count": count})
    last = F.col("segment") == F.col("parts")
    start = F.when(last, F.col("length") - F.col("count")).otherwise((F.col("segment") - 1) * F.col("count")) + F.col("shift")
    fits = cut.withColumn("start", start).filter((F.col("start") >= 0) & (F.col("start") + F.col("count") <= F.col("size")))
    begin, count = F.col("start") + 1, F.col("count")
    words = F.call_function("substring_index", "line", F.lit(" "), F.col("start") + count)
    words = F.call_function("substring_index", words, F.lit(" "), -count).cast("binary")
    letters = F.coalesce(F.substring("bytes", begin, count), F.substring("line", begin, count).cast("binary"))
    piece = F.when(F.col("by_word"), words).otherwise(letters)
    return fits.select("a", "line", F.xxhash64("grade", "segment", "by_word", piece).alias("key"), "filed", "by_word")


def _words(line: Column) -> Column:
    """What stands between single spaces; two spaces in a row have an empty word between them."""
    return F.split(line, " ")


def _is_long() -> Column:
    return (F.col("letters") >= LONG) & (F.col("words") >= WORDS)


def _letters(line: Column) -> Column:
    return F.filter(F.split(line, ""), lambda c: c != "")


def _parity(items: Column, number: Callable[[Column], Column] = F.xxhash64) -> Column:
    """64 bits, each telling whether an odd number of items fall on it."""
    def flip(mask: Column, item: Column) -> Column:
        return mask.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(number(item), F.lit(64)).cast("int")))

    return F.aggregate(items, F.lit(0).cast("long"), flip)


def _sketches(df: DataFrame) -> DataFrame:
    """Parities of characters and of words (an edit changes at most 2 bits) and of pairs of characters (at most 4).

    Lines have those of the ways in which they share a key; the others are NULL and are never looked at.
    """
    def neighbours(k: Column) -> Column:
        return F.xxhash64(F.col("letters")[k - 1], F.col("letters")[k])

    by_letter, by_word = F.exists("keys", lambda k: ~k["by_word"]), F.exists("keys", lambda k: k["by_word"])
    none = F.lit(0).cast("long")
    pairs = F.when(F.size("letters") > 1, _parity(F.sequence(F.lit(1), F.size("letters") - 1), neighbours)).otherwise(none)
    letters = df.withColumn("letters", F.when(by_letter, _letters(F.col("line"))))
    return letters.withColumns(
        {
            "one": F.when(by_letter, _parity(F.col("letters"))),
            "two": F.when(by_letter, pairs),
            "three": F.when(by_word, _parity(_words(F.col("line")))),
        }
    ).drop("letters")


def padded(letters: Column, edits: int = EDITS, blank: str = "") -> Column:
    """Characters or words with room for the band before and after them, filled with what none of them is."""
    blank = F.array_repeat(F.lit(blank), edits)
    return F.concat(blank, letters, blank, blank)


def within(one: Column, other: Column, edits: int = EDITS) -> Column:
    """Whether two arrays of characters or words are at most ``edits`` edits apart; ``one`` is ``padded``.

    A banded automaton: for each number of edits one word whose bits are the diagonals of the band. Reading a
    character of ``other`` moves all diagonals at once by shifts and logical operations. Both have to be columns or variables,
    not expressions, or they would be computed again for every character.
    """
    width = 2 * edits + 1
    full = (1 << width) - 1
    longer = F.size(one) - 3 * edits - F.size(other)

    def matches(character: Column, place: Column) -> Column:
        bits = [F.when(one[place + k] == character, F.lit(1 << k)).otherwise(F.lit(0)) for k in range(width)]
        total = bits[0]
        for b in bits[1:]:
            total = total.bitwiseOR(b)
        return total

    # At the start the first d characters of ``one`` cost d edits.
    start = F.array(*(F.lit(sum(1 << (edits + k) for k in range(d + 1))) for d in range(edits + 1)))

    def step(state: Column, match: Column) -> Column:
        rows = [state[0].bitwiseAND(match)]
        for d in range(1, edits + 1):
            same = state[d].bitwiseAND(match)
            moved = state[d - 1].bitwiseOR(F.shiftright(state[d - 1], 1)).bitwiseOR(F.shiftleft(rows[-1], 1))
            rows.append(same.bitwiseOR(moved).bitwiseAND(F.lit(full)))
        return F.array(*rows)

    last = F.aggregate(F.transform(other, matches), start, step)
    reached = F.call_function("shiftright", last[edits], longer + edits).bitwiseAND(F.lit(1)) == 1
    return F.when(F.abs(longer) <= edits, reached).otherwise(F.lit(False))


def _lines(docs: DataFrame, key: str, text: str, least: int = 1) -> DataFrame:
    """Lines of ``least`` characters or more: ``row`` (a hash of key and text), ``id``, ``place``, ``line``, ``a``, ``b``."""
    rows = docs.select(F.xxhash64(key, text).alias("row"), F.col(key).alias("id"), F.col(text).alias("text"))
    split = rows.select("row", "id", F.posexplode(F.split("text", "\n")).alias("place", "raw"))
    trimmed = split.select("row", "id", "place", F.trim("raw").alias("line")).filter(F.length("line") >= least)
    return trimmed.select("*", F.xxhash64("line").alias("a"), F.xxhash64(F.lit(1), "line").alias("b"))


def links(
    docs: DataFrame, key: str = "doc_id", text: str = "text", least: int = 20, edits: int = EDITS, word_edits: int = WORD_EDITS
) -> DataFrame:
    """Pairs of different lines that are near to each other, as line hashes ``a`` < ``other``.

    Those are lines at most ``edits`` characters apart, and lines of ``LONG`` characters and ``WORDS`` words or more
    that are at most ``word_edits`` words apart.
    """
    found = _lines(docs, key, text, least)
    signed = _signed(found, edits, word_edits)
    # Only keys of two different lines matter; the least and the greatest line combine before the shuffle.
    per_key = signed.groupBy("key").agg(F.min("a").alias("low"), F.max("a").alias("high"))
    keys = checkpointed(per_key.filter("low <> high").select("key"))
    active = signed.join(_small(keys), "key")
    lines_ = active.groupBy("a").agg(F.first("line").alias("line"), F.collect_set(F.struct("key", "filed", "by_word")).alias("keys"))
    known = checkpointed(_sketches(lines_))
    sketches = ("a", "one", "two", "three")
    sizes = F.length("line").alias("letters"), F.size(_words(F.col("line"))).alias("words")
    spread = known.select(*sketches, *sizes, F.explode("keys").alias("s"))
    size = F.when(F.col("s.by_word"), F.col("words")).otherwise(F.col("letters")).alias("size")
    spread = spread.select(*sketches, size, "s.*")
    other = spread.select("key", *(F.col(c).alias(f"other_{c}") for c in ("by_word", "size", *sketches)))

    def flips(name: str) -> Column:
        return F.bit_count(F.col(name).bitwiseXOR(F.col(f"other_{name}")))

    # Looked up is what the shorter line files.
    longer = F.col("other_size") - F.col("size")
    by_letter = ~F.col("by_word") & longer.between(0, edits) & (flips("one") <= 2 * edits) & (flips("two") <= 4 * edits)
    by_words = F.col("by_word") & longer.between(0, word_edits) & (flips("three") <= 2 * word_edits)
    near = (F.col("a") != F.col("other_a")) & (F.col("by_word") == F.col("other_by_word")) & (by_letter | by_words)
    filed = spread.filter("filed").drop("filed").withColumnRenamed("key", "filed_key")
    met = filed.join(other, (F.col("filed_key") == F.col("key")) & near)
    pairs = checkpointed(met.select(F.least("a", "other_a").alias("a"), F.greatest("a", "other_a").alias("other"), "by_word").distinct())
    one, two = known.select("a", F.col("line").alias("one")), known.select(F.col("a").alias("other"), F.col("line").alias("two"))
    both = pairs.join(one, "a").join(two, "other")

    def verified(units: Callable[[Column], Column], most: int, blank: str) -> Column:
        # The variable of the function holds the arrays; as expressions they would be computed at every use.
        split = F.struct(padded(units(F.col("one")), most, blank).alias("one"), units(F.col("two")).alias("two"))
        return F.transform(F.array(split), lambda s: within(s["one"], s["two"], most))[0]

    good = F.when(F.col("by_word"), verified(_words, word_edits, " ")).otherwise(verified(_letters, edits, ""))
    return both.filter(good).select("a", "other").distinct()


def deduplicate(
    docs: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least: int = 20,
    edits: int = EDITS,
    report: bool = False,
    word_edits: int = WORD_EDITS,
) -> DataFrame:
    """Documents without lines that repeat an earlier one, exactly or up to ``edits`` edits or ``word_edits`` words.

    The words count for lines of ``LONG`` characters and ``WORDS`` words or more only: in those one other word is a
    small part. Words stand between single spaces.

    Lines that link directly or through others form a class; its first line by document key and place stays, the others
    go from the text, with their line break. Lines of fewer than ``least`` characters between outer spaces have no near
    lines, but go as exact repeats; empty lines always stay. All rows and columns stay; a document that consists of
    repeated lines keeps an empty text. NULL texts stay NULL. Rows with equal key and text are one document and keep or lose the same lines; a NULL key comes first.
    With ``report`` the columns ``n_lines`` and ``n_removed`` are added (those of these names are replaced).
    """
    found = _lines(docs, key, text)
    place = F.struct("id", "row", "place")
    firsts = found.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    classes = checkpointed(components(links(docs, key, text, least, edits, word_edits), "a", "other"))
    joined = firsts.join(_small(classes).withColumnRenamed("node", "a"), "a", "left")
    repeated = joined.filter(F.col("component").isNotNull() | (F.col("first") != F.col("last")))
    # A line without near ones is a class of its own, known by both hashes.
    one = F.coalesce("component", "a").alias("class"), F.when(F.col("component").isNull(), F.col("b")).otherwise(F.lit(0)).alias("twin")
    repeated = checkpointed(repeated.select("a", "b", "first", *one))
    kept = repeated.groupBy("class", "twin").agg(F.min("first").alias("kept"))
    decided = checkpointed(repeated.join(kept, ["class", "twin"]).select("a", "b", "kept"))
    gone = found.select("row", "id", "place", "a", "b").join(_small(decided), ["a", "b"])
    stays = F.col("id").eqNullSafe(F.col("kept.id")) & (F.col("row") == F.col("kept.row")) & (F.col("place") == F.col("kept.place"))
    gone = gone.filter(~stays)
    row, places, split = fresh("row"), fresh("places"), fresh("split")
    lists = gone.groupBy(F.col("row").alias(row)).agg(F.collect_set("place").alias(places))
    # Texts move as their lines, but are not sorted; the lists, which grow with them, are never broadcast.
    rows = docs.withColumns({row: F.xxhash64(key, text), split: F.split(text, "\n")}).drop(text)
    out = rows.join(lists.hint("shuffle_hash"), row, "left")
    # Set difference and access by number: linear in the lines of a text.
    numbers = F.array_except(F.sequence(F.lit(0), F.size(split) - 1), places)
    left = F.transform(numbers, lambda k: F.col(split)[k])
    cut = F.array_join(F.when(F.col(places).isNull(), F.col(split)).otherwise(left), "\n")
    counts = {}
    if report:
        none = F.lit(0).cast("long")
        counts["n_lines"] = F.when(F.col(split).isNull(), none).otherwise(F.size(split).cast("long"))
        counts["n_removed"] = F.when(F.col(places).isNull(), none).otherwise(F.size(places).cast("long"))
    kept_ = [c for c in docs.columns if c not in counts]
    texts = [cut.alias(c) if c == text else F.col(c) for c in kept_]
    return out.select(*texts, *(column.alias(name) for name, column in counts.items()))
