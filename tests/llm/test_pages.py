import html
import re

from ledgerwell.llm import pages, queries

SMALL = "/root/testdata/sf0.01"


def text_of(page):
    root = pages.parse(page)
    pages.prune(root)
    return pages.blocks(root)


def plain(page):
    """The article of the given tables by plain patterns."""
    body = re.search(r"<article>(.*?)(?:</article>|$)", page, re.S).group(1)
    parts = [re.sub(r"\s+", " ", html.unescape(re.sub(r"<[^>]*>", " ", p))).strip() for p in re.split(r"</?(?:p|h1|footer)\b[^>]*>", body)]
    return "\n".join(p for p in parts if p)


def test_query_over_the_table(spark):
    got = {r["page_id"]: r for r in queries.op10_html(spark, SMALL).collect()}
    rows = spark.read.parquet(f"{SMALL}/pages.parquet").collect()
    assert len(got) == len(rows)
    for row in rows:
        assert got[row["page_id"]]["text"] == plain(row["html"])
        assert got[row["page_id"]]["n_chars"] == len(plain(row["html"]))


def test_no_article_text_is_lost_on_the_larger_tables(spark):
    """Stock sentences that many hosts share are no template."""
    got = {r["page_id"]: r["text"] for r in queries.op10_html(spark, "/root/testdata/sf0.1").collect()}
    rows = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").collect()
    assert [r["page_id"] for r in rows if got[r["page_id"]] != plain(r["html"])] == []


def test_rare_headings_stay_and_blocks_of_a_section_go(spark):
    def page(k):
        parts = [f"<p>article {k} has {k * k} words of its own to tell</p>"]
        parts += ["<h2>Introduction</h2>"] * (k < 6) + ["<p>As is well known.</p>"] * (20 <= k < 26)
        parts += ["<div><p>Read our guide</p></div>"] * (k % 10 < 3)
        return (k, "https://one.example/x", f"<body><article>{''.join(parts)}</article></body>")

    rows = [page(k) for k in range(300)]
    out = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert sum("Introduction" in t for t in out.values()) == 6 and sum("well known" in t for t in out.values()) == 6
    assert not any("guide" in t for t in out.values())
    assert all(out[k].startswith(f"article {k} has") for k in range(300))


def test_both_ways_of_joining_templates_agree(spark, monkeypatch):
    rows = [
        (k, "https://one.example/x", f"<body><article><p>text {k} is new</p><div>More of <b>us</b></div>end {k}</article></body>")
        for k in range(30)
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    monkeypatch.setattr(pages, "BROADCAST_ROWS", 0)
    out = {r["page_id"]: r["text"] for r in pages.extract(df).collect()}
    assert out == {k: f"text {k} is new\nend {k}" for k in range(30)}


def test_furniture_goes():
    page = """<html><head><title>t</title><style>p{}</style></head><body class="with-sidebar"><header><h2>Site</h2></header>
    <div class="cookie-notice">We use cookies</div><aside>side</aside><nav>menu</nav>
    <main><article><header><h1>Head &amp; more</h1><span>by me</span></header><p>One
      <b>two</b>&nbsp;three<br>four<p>five <script>x = "<p>no</p>"</script>six
      <form><p>mail</p></form><ul><li>a<li>b</ul><!-- hidden --></p></article>
    <section id="comments"><article class="comment"><p>first!</p></article></section></main>
    <footer>&copy;</footer></body></html>"""
    assert text_of(page) == "Head & more\nOne two three four\nfive six\na\nb"


def test_odd_pages(spark):
    deep = "<div>" * 5000 + "deep" + "</div>" * 5000
    rows = [(1, None, None), (2, "", ""), (3, "no url", "plain &lt;text&gt;"), (4, "http://a.b/", deep), (4, "http://a.b/", deep)]
    rows += [(5, "http://a.b/", "<article><p>" + "word " * 300_000 + "</p></article>")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'old' AS text", "1 AS _host_", "'mine' AS _host", "2 AS host", "3 AS _salt")
    out = pages.extract(df).orderBy("page_id").collect()
    assert [r["text"] for r in out[:5]] == ["", "", "plain <text>", "deep", "deep"]
    assert len(out[5]["text"]) == 5 * 300_000 - 1
    assert all((r["_host"], r["host"], r["_salt"], r["html"]) == ("mine", 2, 3, x[2]) for r, x in zip(out, rows))
    assert pages.extract(df.limit(0)).count() == 0


def test_template_of_a_host_goes_and_copies_stay(spark):
    def page(k, body):
        return (k, "https://Site.example/x", f"<body><article><p>{body}</p><div><p>Read our guide</p></div></article></body>")

    rows = [page(k, f"text number {k}") for k in range(12)] + [page(100 + k, "the same copy") for k in range(40)]
    rows += [(200, "https://other.example/", "<body><article><div><p>Read our guide</p></div></article></body>")]
    out = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(out[k] == f"text number {k}" for k in range(12))
    assert all(out[100 + k] == "the same copy" for k in range(40))
    assert out[200] == "Read our guide"


def test_blocks_on_a_part_of_a_host_and_on_small_hosts_go(spark):
    def page(k, site, body, block=""):
        return (k, f"https://{site}.example/x", f"<body><article><p>{body}</p>{block and f'<div><p>{block}</p></div>'}</article></body>")

    own = [f"article {k} has {k * k} words of its own to tell" for k in range(200)]
    rows = [page(k, "large", own[k], "Read our guide" if k < 12 else "") for k in range(40)]
    rows += [page(50 + k, "small", own[50 + k], "Ask us" if k < 4 else "") for k in range(5)]
    # Near copies: their common text is no template.
    rows += [page(100 + k, "copies", f"edit {k}", "the long text that all of the near copies share, word for word") for k in range(6)]
    rows += [page(120 + k, "copies", own[120 + k]) for k in range(20)]
    out = {r["page_id"]: r["text"] for r in pages.extract(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert all(out[k] == own[k] for k in [*range(40), *range(50, 55), *range(120, 140)])
    assert all(out[100 + k].endswith("word for word") for k in range(6))
