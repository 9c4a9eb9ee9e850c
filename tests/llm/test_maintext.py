from html.parser import HTMLParser

import pytest

from provena.llm.maintext import Page, host_paths, main_text
from provena.llm.queries import op11_main_text

from ..conftest import SF_MID

BLOCKS = set("p h1 li article div nav footer ul".split())


class Article(HTMLParser):
    """The blocks inside <article>, by Python's own parser: enough for the pages of the test tables."""

    def __init__(self, html):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks, self.held = 0, [], ""
        self.feed(html)
        self.close()

    def edge(self, tag, change):
        if tag in BLOCKS:
            text = " ".join(self.held.split())
            if text and self.inside:
                self.blocks.append(text)
            self.held = ""
        if tag == "article":
            self.inside += change

    def handle_starttag(self, tag, attrs):
        self.held += " " * (tag == "br")
        self.edge(tag, 1)

    def handle_endtag(self, tag):
        self.edge(tag, -1)

    def handle_data(self, data):
        self.held += data


def test_query(spark):
    pages = {r.page_id: r for r in spark.read.parquet(f"{SF_MID}/pages.parquet").collect()}
    got = op11_main_text(spark, SF_MID).collect()
    assert len(got) == len(pages)
    for r in got:
        assert r.text == "\n".join(Article(pages[r.page_id].html).blocks) and r.n_chars == len(r.text) and r.url == pages[r.page_id].url


LONG = "Rivers carry silt from the hills to the sea, and each spring the plain is covered anew by a thin layer of it."
MORE = "Farmers have known this since before there were records, and their calendars still follow the river's year."


@pytest.mark.parametrize("html,text", [
    (f"<div id=page class='with-sidebar'><div class='sidebar'><p>{MORE}</p></div><div class='post-81 entry'><h2>Silt</h2><p>{LONG}</p><p>{MORE}</p>"
     f"<div id='comments'><h3>2 comments</h3><p>{LONG} I agree, and so does everyone here.</p></div></div></div>", f"Silt\n{LONG}\n{MORE}"),
    (f"<header><h1>The Daily</h1></header><main><header><h1>Silt</h1></header><p>{LONG}</p><aside>{MORE}</aside><form><label>Name</label><input>"
     f"<button>Send</button></form></main><footer>{MORE}</footer>", f"Silt\n{LONG}"),
    (f"<div class='cookie-notice'>{LONG} {MORE}</div><article><p>{LONG}</p></article>", LONG),
    (f"<article><p>{LONG}</p></article><section class='comments'><article class='comment'><p>{LONG} {MORE} {LONG}</p></article></section>", LONG),
    ("<p>a<b>b</b>c<br>d&nbsp;&amp;\n e &#233;&lt;p&gt;</p>x<ul><li>one<li>two</ul>", "abc d & e é<p>\nx\none\ntwo"),
    ("<table><tr><td>a<td>b<tr><td>c</table><dl><dt>d<dd>e<dt>f</dl>", "a\nb\nc\nd\ne\nf"),
    (f"<body class='has-comments'><div role=navigation>{MORE}</div><p>{LONG}</p><div style='display: none'>{MORE}</div><p hidden>x</p>", LONG),
    (f"<script>if (a<b) '</p>'</script><style>p > a</style><!-- <p>no --><p>{LONG}</p><textarea><p>no</textarea><svg><text>no</text></svg>", LONG),
    ("no markup at all, 3 < 4", "no markup at all, 3 < 4"),
    ("<p title=\"a > b\">x</p><p a='>'>y</p>", "x\ny"),
    ("<p>x <a title='never closed>y</p>", "x y"),
    ("", ""), ("<nav><p>menu</p></nav>", ""), ("<script>x", ""), ("<!-- x", ""), ("<", "<"), ("</p></div></nope>x", "x"),
])
def test_pages(html, text):
    assert Page(html).extract([])[0] == text


def test_consensus_of_a_host(spark):
    """A page whose longest container is another takes the path that its host's pages agree on; numbers in names differ."""
    def page(i, body, other):
        return f"<html><body><div class='x{i}'><p>{other}</p></div><div class='c-{i * 7}'><p>{body}</p></div></body></html>"

    short = "A short piece."
    rows = [(i, f"https://h.example/{i}", page(i, f"{LONG} {i}", short)) for i in range(8)]
    rows += [(90, "http://u:p@H.example:80/x", page(3, "Tiny but true.", f"{LONG} {MORE}")), (91, "https://other.example/", page(3, short, LONG))]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    paths = {r.host: r for r in host_paths(df).collect()}
    assert paths["h.example"].paths == ["body/div.c-#"] and paths["h.example"].votes == [8]
    got = {r.page_id: r for r in main_text(df).collect()}
    assert got[90].text == "Tiny but true." and got[91].text == LONG and all(got[i].text == f"{LONG} {i}" for i in range(8))
    assert got[90].path == got[0].path


def test_deep_and_long_pages():
    deep = "<div>" * 20_000 + LONG + "</div>" * 20_000
    assert Page(deep).extract([])[0] == LONG
    many = "".join(f"<p>{i} {LONG}" for i in range(20_000))
    assert Page(f"<article>{many}</article>").extract([])[0].count("\n") == 19_999
    assert Page("<a '" * 50_000).extract([])[1] == 0


def test_odd_rows(spark):
    schema = "page_id long, url string, html string, text string, PATH int, host_keys_0 int, host string"
    rows = [(1, None, None), (2, "", ""), (3, "not a url", "plain"), (None, "http:///x", f"<p>{LONG}</p>"), (5, "ftp://é.example/a", " \n "),
            (6, "https://a.example", f"<p>{LONG}</p>"), (6, "https://a.example", f"<p>{LONG}</p>")]
    df = spark.createDataFrame([(*r, "old", 1, 2, "h") for r in rows], schema)
    out = main_text(df)
    assert sorted(out.columns) == sorted(["page_id", "url", "html", "host_keys_0", "host", "text", "n_chars", "path"])
    got = [(r.page_id, r.text, r.n_chars, r.host, r.host_keys_0) for r in out.collect()]
    want = {1: "", 2: "", 3: "plain", None: LONG, 5: "", 6: LONG}
    assert sorted(got, key=str) == sorted([(r[0], want[r[0]], len(want[r[0]]), "h", 2) for r in rows], key=str)
    assert main_text(df.limit(0)).count() == 0
