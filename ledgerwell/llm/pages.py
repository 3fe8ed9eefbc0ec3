"""Main text of web pages: element subtrees that recur on a host's pages are removed, with the usual page furniture.

Each page is parsed once into a small tree, of which its lines are kept with the subtrees they stand in. Spark counts on
how many distinct articles of a host every subtree stands; subtrees on a good part of them are the site's template. Copies of an article count once, and articles
made mostly of recurring subtrees do not count, so a group of copies cannot make its own text a template.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerwell.llm.common import checkpointed, fresh
from ledgerwell.session import shared_folder

#: Templates of at most this many subtrees are broadcast.
BROADCAST_ROWS = 500_000
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    """address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer
    form h1 h2 h3 h4 h5 h6 header hgroup hr html li main menu nav ol p pre section summary table tbody td tfoot th
    thead title tr ul""".split()
)
#: Elements that never hold the article's text.
FURNITURE = frozenset(
    """applet audio aside button canvas datalist dialog embed fieldset footer form head iframe input map menu nav
    noembed noframes noscript object script search select style svg template textarea title video""".split()
)
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
#: Words in class or id that mark furniture.
HINTS = frozenset(
    """ad ads adv advert adverts advertisement advertising banner breadcrumb breadcrumbs consent cookie cookies gdpr
    footer login masthead menu modal nav navbar navigation newsletter notice notices notification overlay pager
    pagination popup promo promotion recommended related share sharing sidebar signup social sponsor sponsored
    subscribe subscription toolbar widget""".split()
)
COMMENTS = frozenset("comment comments commentlist disqus discussion replies reply responses".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: What an opening tag ends, when it is still open, up to the nearest of the second set.
ENDS = {
    "p": (frozenset({"p"}), frozenset("article aside blockquote body div footer header li main nav section td".split())),
    "li": (frozenset({"li"}), frozenset("ol ul menu".split())),
    "dt": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "dd": (frozenset({"dt", "dd"}), frozenset({"dl"})),
    "tr": (frozenset({"tr", "td", "th"}), frozenset({"table"})),
    "td": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "th": (frozenset({"td", "th"}), frozenset({"tr", "table"})),
    "option": (frozenset({"option"}), frozenset({"select", "datalist"})),
}
for _tag in BLOCKS - {"p", "li", "dt", "dd", "tr", "td", "th", "body", "html"}:
    ENDS.setdefault(_tag, ENDS["p"])
WORD = re.compile(r"[a-z0-9]+")
SPACES = re.compile(r"\s+")


class Node:
    __slots__ = ("tag", "names", "hidden", "role", "children", "digest", "own")

    def __init__(self, tag: str, attributes: list[tuple[str, str | None]] = ()):
        given = {k: v or "" for k, v in reversed(attributes)}
        self.tag = tag
        self.names = frozenset(WORD.findall(f"{given.get('class', '')} {given.get('id', '')}".lower()))
        style = given.get("style", "").replace(" ", "").lower()
        self.hidden = "hidden" in given or given.get("aria-hidden", "").lower() == "true" or "display:none" in style
        self.role = given.get("role", "").lower()
        self.children: list[Node | str] = []
        self.digest = 0
        self.own = 0


class Builder(HTMLParser):
    """A tree of a page; tolerant of unclosed and stray tags. Comments and declarations leave nothing."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.open = [self.root]

    def handle_starttag(self, tag, attrs):
        if tag in ENDS:
            ended, until = ENDS[tag]
            for k in range(len(self.open) - 1, 0, -1):
                if self.open[k].tag in ended:
                    del self.open[k:]
                    break
                if self.open[k].tag in until:
                    break
        node = Node(tag, attrs)
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and tag in {"script", "style", "svg", "iframe"}:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k].tag == tag:
                del self.open[k:]
                return
            if tag not in BLOCKS and self.open[k].tag in BLOCKS:
                return

    def handle_data(self, data):
        self.open[-1].children.append(data)


def parse(html: str) -> Node:
    builder = Builder()
    builder.feed(html)
    builder.close()
    return builder.root


def ordered(root: Node) -> list[tuple[Node, int]]:
    """All elements with the place of their parent in the list, parents first; without recursion."""
    out = [(root, -1)]
    place = 0
    while place < len(out):
        out.extend((child, place) for child in out[place][0].children if isinstance(child, Node))
        place += 1
    return out


def prune(root: Node) -> None:
    """Take furniture out of the tree."""
    nodes = ordered(root)
    holds = [False] * len(nodes)
    inside = [False] * len(nodes)
    for k, (node, parent) in enumerate(nodes):
        real = node.tag in ("article", "main") and not node.names & (COMMENTS | HINTS)
        inside[k] = parent >= 0 and (inside[parent] or nodes[parent][0].tag == "article")
        if real and parent >= 0:
            up = parent
            while up >= 0 and not holds[up]:
                holds[up] = True
                up = nodes[up][1]
    dropped = set()
    for k, (node, _) in enumerate(nodes):
        if k == 0:
            continue
        if node.tag in FURNITURE or node.hidden or node.role in ROLES or node.names & COMMENTS:
            dropped.add(id(node))
        elif node.tag == "header" or "header" in node.names:
            if inside[k]:
                kept = [n for n, _ in ordered(node) if n.tag in HEADINGS]
                node.children = list(kept)
            elif not holds[k]:
                dropped.add(id(node))
        elif node.names & HINTS and not holds[k] and node.tag not in ("article", "main", "body"):
            dropped.add(id(node))
    for node, _ in nodes:
        node.children = [c for c in node.children if isinstance(c, str) or id(c) not in dropped]


def digests(root: Node) -> set[int]:
    """Give every element the hash of its subtree: tag, class and id words, text and children in order."""
    found = set()
    for node, _ in reversed(ordered(root)):
        parts = [node.tag, " ".join(sorted(node.names))]
        for child in node.children:
            parts.append(SPACES.sub(" ", child).strip() if isinstance(child, str) else f"\x01{child.digest}")
        node.digest = xxhash.xxh3_64_intdigest("\x00".join(parts)) - (1 << 63)
        if node.tag in BLOCKS and node.tag not in ("html", "body", "article", "main"):
            found.add(node.digest)
    return found


def lengths(root: Node) -> tuple[dict[int, int], int]:
    """Characters of each subtree of the article that are in no smaller block, by hash, and those of the whole article."""
    found: dict[int, int] = {}
    whole = 0
    for top in article_roots(root):
        nodes = ordered(top)
        for node, _ in reversed(nodes):
            node.own = sum(
                len(SPACES.sub(" ", c).strip()) if isinstance(c, str) else 0 if c.tag in BLOCKS else c.own for c in node.children
            )
        for node, _ in nodes:
            if node.tag in BLOCKS or node is top:
                whole += node.own
                if node is not top:
                    found[node.digest] = found.get(node.digest, 0) + node.own
    return found, whole


def article_roots(root: Node) -> list[Node]:
    """The outermost articles, else the main element, else the whole page."""
    for wanted in (lambda n: n.tag == "article", lambda n: n.tag == "main" or n.role == "main"):
        found, stack = [], [root]
        while stack:
            node = stack.pop()
            if wanted(node):
                found.append(node)
            else:
                stack.extend(reversed([c for c in node.children if isinstance(c, Node)]))
        if found:
            return found
    return [root]


def lines(root: Node) -> tuple[list[str], list[list[int]]]:
    """Text of the article, one line per block, and the hashes of the subtrees that each line stands in."""
    found: list[str] = []
    marks: list[list[int]] = []
    current: list[str] = []
    inside: list[int] = []

    def end() -> None:
        line = SPACES.sub(" ", "".join(current)).strip()
        current.clear()
        if line:
            found.append(line)
            marks.append(list(inside))

    for top in article_roots(root):
        stack: list[Node | str | None] = [top]
        while stack:
            item = stack.pop()
            if item is None:
                end()
                inside.pop()
            elif isinstance(item, str):
                current.append(item)
            elif item.tag == "br":
                current.append(" ")
            elif item.tag in BLOCKS:
                end()
                inside.append(0 if item is top else item.digest)
                stack.append(None)
                stack.extend(reversed(item.children))
            else:
                stack.extend(reversed(item.children))
        end()
    return found, marks


def blocks(root: Node) -> str:
    return "\n".join(lines(root)[0])


def host(url: Column) -> Column:
    """Lower-case host of a URL; an empty string where there is none."""
    return F.coalesce(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


_PARSED = (
    "host string, article long, subtrees array<long>, own array<int>, whole int, lines array<string>, marks array<array<long>>"
)


def parsed(df: DataFrame, html: str, name: str, keep: list[str], at: str) -> DataFrame:
    """The pages as trees that are looked at once: columns ``keep``, and in ``at`` what later steps need of a tree.

    Written to the shared folder, compressed, since whole texts are in it.
    """
    struct = T._parse_datatype_string(_PARSED)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.struct(
            [
                ("host", pa.string()),
                ("article", pa.int64()),
                ("subtrees", pa.list_(pa.int64())),
                ("own", pa.list_(pa.int32())),
                ("whole", pa.int32()),
                ("lines", pa.list_(pa.string())),
                ("marks", pa.list_(pa.list_(pa.int64()))),
            ]
        )
        for batch in batches:
            for start in range(0, batch.num_rows, 200):
                part = batch.slice(start, 200)
                rows = []
                for site, page in zip(part.column(name).to_pylist(), part.column(html).to_pylist()):
                    root = parse(page or "")
                    prune(root)
                    found = list(digests(root))
                    text, marks = lines(root)
                    own, whole = lengths(root)
                    article = None if page is None else xxhash.xxh3_64_intdigest("\n".join(text)) - (1 << 63)
                    rows.append((site, article, found, [own.get(s, 0) for s in found], whole, text, marks))
                named = [dict(zip(struct.names, row)) for row in rows]
                columns = [*(part.column(c) for c in keep), pa.array(named, kind)]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, at])

    schema = T.StructType([df.schema[c] for c in keep]).add(at, struct)
    path = shared_folder(df.sparkSession, "pages")
    df.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def templates(
    seen: DataFrame, few: int, several: int, part: float, least: int, share: float, copied: float, wide: int, lift: float
) -> DataFrame:
    """Subtrees (``s``) that are template on a ``host``, of trees with ``host``, ``article``, ``subtrees``, ``own``, ``whole``."""
    # One row per article of a host, whatever the number of its copies; the whole of it counts as subtree NULL.
    parts = seen.select("host", "article", F.explode(F.concat("subtrees", F.array(F.lit(None).cast("long")))).alias("s"))
    standing = parts.distinct().groupBy("host", "s").agg(F.count(F.lit(1)).alias("n"))
    standing = checkpointed(standing.filter("s IS NULL OR n >= %d" % few))
    sizes = standing.filter("s IS NULL").select("host", F.col("n").alias("total"))
    total, n = F.col("total"), F.col("n")
    small = F.least(F.lit(several), F.ceil(total / 2))
    needed = F.greatest(F.lit(few), small, F.ceil(total * part))
    common = standing.filter("s IS NOT NULL").join(sizes, "host").withColumn("needed", needed)
    common = checkpointed(common.filter(n >= F.col("needed")))
    # What stands as often on many other hosts is text that many write, unless most articles of the host hold it.
    everywhere = parts.join(common.select("s").distinct(), "s", "left_semi").distinct()
    everywhere = everywhere.groupBy("s", "host").agg(F.count(F.lit(1)).alias("n"))
    elsewhere = everywhere.groupBy("s").agg(F.sum("n").alias("all_n"), F.count(F.lit(1)).alias("hosts"))
    articles = sizes.agg(F.coalesce(F.sum("total"), F.lit(0))).first()[0]
    others = F.greatest(F.lit(articles) - total, F.lit(1))
    usual = (F.col("hosts") > wide) & (n / total < lift * (F.col("all_n") - n) / others)
    # Votes of the articles that are not mostly made of such subtrees.
    held = seen.select("host", "article", "whole", F.explode(F.arrays_zip("subtrees", "own")).alias("p"))
    held = held.select("host", "article", "whole", F.col("p.subtrees").alias("s"), "p.own").join(common.select("host", "s"), ["host", "s"])
    held = held.groupBy("host", "article", "s").agg(F.max("own").alias("own"), F.max("whole").alias("whole"))
    found = held.groupBy("host", "article").agg(F.collect_list("s").alias("held"), F.sum("own").alias("own"), F.max("whole").alias("whole"))
    voting = found.filter(F.col("own") <= F.col("whole") * copied).select("host", F.explode("held").alias("s"))
    votes = voting.groupBy("host", "s").agg(F.count(F.lit(1)).alias("votes"))
    major = (total >= least) & (n > total * share)
    judged = common.join(votes, ["host", "s"], "left").join(elsewhere, "s")
    return judged.filter(major | ((F.col("votes") >= F.col("needed")) & ~usual)).select("host", "s")


def extract(
    df: DataFrame,
    html: str = "html",
    url: str = "url",
    out: str = "text",
    least: int = 10,
    share: float = 0.5,
    salts: int = 16,
    several: int = 5,
    few: int = 3,
    part: float = 0.25,
    copied: float = 0.75,
    wide: int = 5,
    lift: float = 4.0,
    keep_html: bool = True,
) -> DataFrame:
    """Add the main text of each page in ``out``; all rows and other columns stay, ``html`` itself with ``keep_html``.

    A subtree is part of a host's template if it stands on ``part`` of the host's distinct articles, but on ``several``
    at least; on a host of fewer than twice as many on half of them, and on ``few``. It is not if it stands on more than
    ``wide`` hosts and not ``lift`` times as often here as elsewhere: a stock sentence is no template. An article of which
    more than ``copied`` of the text recurs like that may be a near copy and does not count. A subtree on more than
    ``share`` of a host's articles, if there are ``least``, is template in any case. Pages without a host form no site. NULL
    and empty pages give an empty text. Templates are broadcast if they are few; else they meet the pages by host, those
    of a large host spread over ``salts`` copies.
    """
    kept = [c for c in df.columns if c != out and (keep_html or c != html)]
    name, at, salt, template = (fresh(x) for x in ("host", "parsed", "salt", "template"))
    pages = parsed(df.withColumn(name, host(F.col(url))), html, name, kept, at)
    seen = pages.select(f"{at}.*").filter("host <> '' AND article IS NOT NULL")
    found = checkpointed(templates(seen, few, several, part, least, share, copied, wide, lift))
    lists = found.groupBy(F.col("host").alias(name)).agg(F.collect_set("s").alias(template))
    same = F.col(f"{at}.host") == F.col(name)
    if found.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        joined = pages.join(F.broadcast(lists), same, "left")
    else:
        lists = lists.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
        dealt = F.pmod(F.col(f"{at}.article"), F.lit(salts)).cast("int") == F.col(salt)
        joined = pages.join(lists, same & dealt, "left")
    rest = F.filter(f"{at}.lines", lambda _, k: ~F.arrays_overlap(F.col(f"{at}.marks")[k], F.col(template)))
    text = F.when(F.col(template).isNull(), F.array_join(f"{at}.lines", "\n")).otherwise(F.array_join(rest, "\n"))
    return joined.select(*kept, text.alias(out))
