"""Main text of web pages by paths that the pages of a host agree on.

1. A page is read once into its containers and blocks of text.  Each container is scored: the text of its blocks in full,
   of its inner containers by half for each level, less what stands in links, raised for an article's tags and names.
   The best, widened to what plainly belongs to it, is what the page by itself would take.
2. Each page votes for the generalised tag-class path of its best container (numbers in names stand for any number).
   Votes are added up per task, then per host and path in Spark; the paths with ``SHARE`` of a host's votes win.
3. Each page is read again with its host's winning paths: its own best container counts if its path is among them, else
   the container of the winning path with the most votes that the page has, else its own best.  The paths travel by a
   join on the host, which Spark can split where one host has many pages.

Left out, wherever they stand: navigation, page headers, footers, sidebars, forms and their controls, scripts, styles and
other embedded matter, and what its names call a menu, notice, advert, comment or the like (unless the article stands inside).

Blocks come in page order, joined by one line feed.  In a block character references are decoded first, then white space
(as Python's ``str.split`` has it; ``<br>`` counts as such) becomes one space, and the ends are trimmed.

Defined results: null and empty html, and pages with nothing but what is left out, have the empty text.  Html without
containers is taken whole.  A null url, or one without a host, counts as one host named ''.  Repeated rows are each a page,
and each votes.  Paths with the same votes come in order of their text, then their name.  All columns of the input stay;
one with the name of a new column is replaced.  No text is cut, and no page or path dropped.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections import defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import add_columns, ship, slices, stored, texts_of

#: a path wins that has this share of its host's votes, so five paths at most
SHARE = 0.2
WIDER = 0.25

_TAG = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>", re.S)
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>\"']+)))?")
_NUMBER = re.compile(r"[0-9a-f]*[0-9][0-9a-f]*")
_NAME = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
_HOST = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]*)"

# ---- what html's elements are ------------------------------------------------------------------------------
_RAW = set("script style textarea title iframe noembed noframes xmp".split())  # nothing inside is markup
_CONTAINER = set("article aside center div details dialog fieldset footer form header main nav section td body".split())
_BLOCK = _CONTAINER | set("""address blockquote caption dd dl dt figcaption figure h1 h2 h3 h4 h5 h6 hr legend li menu ol
    p pre summary table tbody tfoot th thead tr ul""".split())
_INLINE_OUT = set("button select datalist svg math template canvas object audio video noscript label".split())
_OUT = set("nav aside footer form dialog menu".split()) | _INLINE_OUT
_ROLES = set("navigation banner contentinfo complementary search dialog alert alertdialog menu menubar form toolbar".split())
#: an opening tag ends an open one of the set, as far out as the tags after it
_ENDS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
         "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"})}
_HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
# ---- what names say ----------------------------------------------------------------------------------------
_NOT_TEXT = set("""ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment comments commentlist commentary
    consent cookie cookies copyright disqus footer gdpr login masthead menu modal nav navbar navigation newsletter notice notices notification
    overlay pager pagination popup promo promoted promotion recommended recommendations related replies reply respond share sharing sidebar
    signup social sponsor sponsored subscribe subscription toolbar widget widgets""".split())
_TEXT = set("article articlebody blog body content entry hentry main post story text".split())
_TITLE = _TEXT | {"title", "headline"}
_NEGATION = set("has no with without".split())


def _words(value: str) -> list[str]:
    return [w.lower() for w in _NAME.findall(value)]


def _says_not_text(words: list[str]) -> bool:
    return any(w in _NOT_TEXT and (i == 0 or words[i - 1] not in _NEGATION) for i, w in enumerate(words))


def _attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for name, a, b, c in _ATTR.findall(text):
        out.setdefault(name.lower(), a or b or c)
    return out


class Page:
    """Containers and blocks of a page.  Node 0 is the page itself; a node's parent has a smaller number."""

    def __init__(self, source: str):
        self.tag, self.parent, self.name, self.weight = ["body"], [-1], [""], [0.5]
        self.hard, self.soft, self.core = [False], [False], [False]
        self.blocks: list[tuple[int, str, int]] = []  # node, text, characters in links
        self._read(source)
        self._settle()

    def _read(self, source: str) -> None:
        stack, held, link = [0], [], 0
        linked = closed = 0  # inside a link; inside inline matter that is left out
        opened: dict[str, int] = defaultdict(int)
        at, n, tag = 0, len(source), self.tag

        def flush():
            nonlocal held, link
            if held:
                text = " ".join("".join(held).split())
                if text:
                    self.blocks.append((stack[-1], text, min(link, len(text))))
                held, link = [], 0

        def pop(depth: int):
            while len(stack) > depth:
                i = stack.pop()
                opened[tag[i]] -= 1
                self.core[self.parent[i]] |= self.core[i]

        def text(a: int, b: int):
            nonlocal link
            if b > a and not closed:
                run = source[a:b]
                if "&" in run:
                    run = entities.unescape(run)
                held.append(run)
                if linked:
                    link += len(run.strip())

        search = _TAG.search
        while at < n:
            m = search(source, at)
            if not m:
                text(at, n)
                break
            text(at, m.start())
            at = m.end()
            name = m[2] or m[5]
            if not name:
                if m[0].startswith("<![CDATA["):
                    text(m.start() + 9, at - 3 if m[0].endswith("]]>") else at)
                continue
            name, end = name.lower(), bool(m[1] or m[4])
            if name in _RAW:
                if not end:
                    close = re.compile(rf"</{name}(?=[\s/>])[^>]*+>?", re.I).search(source, at)
                    at = close.end() if close else n
                continue
            if name == "a":
                linked = not end
                continue
            if name == "br":
                held.append(" ")
                continue
            if name in _INLINE_OUT:
                closed = max(0, closed + (-1 if end else 0 if (m[3] or m[6] or "").endswith("/") else 1))
                continue
            if name == "head":
                if not end:
                    close = re.compile(r"</head\s*>|<body\b", re.I).search(source, at)
                    at = close.start() if close else at
                continue
            if name in ("html", "body"):
                flush()
                continue
            if name not in _BLOCK and "-" not in name:
                continue
            flush()
            linked = closed = 0
            if end:
                alike = _HEADINGS if name in _HEADINGS else {name}
                if any(opened[x] > 0 for x in alike):
                    depth = len(stack) - 1
                    while tag[stack[depth]] not in alike:
                        depth -= 1
                    pop(depth)
                continue
            if opened["p"] and tag[stack[-1]] == "p":
                pop(len(stack) - 1)
            if name in _ENDS:
                ends, bar = _ENDS[name]
                if any(opened[x] > 0 for x in ends):
                    depth = len(stack) - 1
                    while depth and tag[stack[depth]] not in ends and tag[stack[depth]] not in bar:
                        depth -= 1
                    if depth and tag[stack[depth]] in ends:
                        pop(depth)
            if name == "hr":
                continue
            stack.append(self._node(name, m[3] or m[6] or "", stack[-1], opened["article"] + opened["main"] > 0))
            opened[name] += 1
        flush()
        pop(1)

    def _node(self, name: str, attributes: str, parent: int, inside: bool) -> int:
        kind, words, weight, soft = name, [], 1.0, False
        hard = name in _OUT or (name == "header" and not inside)
        if attributes.strip():
            a = _attributes(attributes)
            names = sorted({_NUMBER.sub("#", c.lower()) for c in a.get("class", "").split()})
            ident = _NUMBER.sub("#", a.get("id", "").strip().lower())
            kind += "".join(f".{c}" for c in names) + (f"#{ident}" if ident else "")
            words = _words(f"{a.get('class', '')} {a.get('id', '')}")
            soft = _says_not_text(words) or a.get("role", "").lower() in _ROLES or ("header" in words and not inside and not _TITLE & set(words))
            hard |= "hidden" in a or a.get("aria-hidden", "").lower() == "true" or re.search(r"display\s*:\s*none", a.get("style", ""), re.I) is not None
            if a.get("itemprop", "").lower() == "articlebody" or a.get("role", "").lower() in ("main", "article"):
                weight *= 1.5
        if name in ("article", "main"):
            weight *= 1.5
        if _TEXT & set(words):
            weight *= 1.25
        self.tag.append(name)
        self.parent.append(parent)
        self.name.append(kind)
        self.weight.append(weight)
        self.hard.append(hard)
        self.soft.append(soft)
        self.core.append(name in ("article", "main") and not soft)
        return len(self.tag) - 1

    def _settle(self) -> None:
        n = len(self.tag)
        self.out, self.inside, self.key = [False] * n, [0] * n, [b""] * n
        for i in range(1, n):
            p = self.parent[i]
            self.out[i] = self.out[p] or self.hard[i] or (self.soft[i] and not self.core[i])
            container = self.tag[i] in _CONTAINER or "-" in self.tag[i]
            self.inside[i] = i if container else self.inside[p]  # the container that a node is or is in
            self.key[i] = hashlib.blake2b(self.key[self.inside[p]] + b"/" + self.name[i].encode("utf-8", "replace"), digest_size=12).digest() if container else b""

    def path(self, i: int) -> str:
        """The tag-class path of a container."""
        names = []
        while i:
            names.append(self.name[i])
            i = self.inside[self.parent[i]]
        return "/".join(["body", *reversed(names)])

    def best(self) -> int:
        """The container that the page by itself takes for its article."""
        n = len(self.tag)
        score, size, link = [0.0] * n, [0] * n, [0] * n
        for i, text, links in self.blocks:
            if self.out[i]:
                continue
            i = self.inside[i]
            size[i] += len(text)
            link[i] += links
            part, worth = 1.0, max(0, len(text) - 2 * links)
            for _ in range(4):
                score[i] += part * worth
                part /= 2
                if not i:
                    break
                i = self.inside[self.parent[i]]
        for i in range(n - 1, 0, -1):
            if self.inside[i] == i:
                p = self.inside[self.parent[i]]
                size[p] += size[i]
                link[p] += link[i]
        top, most = 0, score[0] * self.weight[0]
        for i in range(1, n):
            if self.inside[i] == i and not self.out[i] and size[i]:
                s = score[i] * self.weight[i] * (1 - link[i] / size[i])
                if s > most:
                    top, most = i, s
        while top:
            p = self.inside[self.parent[top]]
            if not p or size[p] - size[top] > WIDER * size[top]:
                break
            top = p
        i = top
        while i:
            if self.tag[i] == "article":
                top = i
            i = self.inside[self.parent[i]]
        self.size = size
        return top

    def text(self, chosen: set[int]) -> str:
        """The blocks inside the chosen containers, but for those that are left out."""
        within = [False] * len(self.tag)
        for i in range(len(self.tag)):
            within[i] = i in chosen or (i > 0 and within[self.parent[i]])
        return "\n".join(t for i, t, _ in self.blocks if within[i] and not self.out[i])

    def extract(self, winning: list[bytes]) -> tuple[str, int]:
        """The main text by the winning paths (keys, most votes first), and the first container it is from."""
        own = self.best()
        if self.key[own] in winning:
            winning = [self.key[own], *winning]
        places = defaultdict(list)
        for i in range(len(self.tag)):
            if self.inside[i] == i and not self.out[i] and self.size[i]:
                places[self.key[i]].append(i)
        for key in winning:
            if key in places:
                return self.text(set(places[key])), places[key][0]
        return self.text({own}), own


def host_of(url: str):
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), _HOST, 1)), F.lit(""))


def host_paths(pages: DataFrame, url: str = "url", html: str = "html", share: float = SHARE) -> DataFrame:
    """host, keys (of the winning paths, most votes first), paths (the same, to be read), votes."""
    ship(pages.sparkSession)
    schema = "host string, key binary, path string, votes long, chars long"

    def vote(batches):
        for b in slices(batches, "html"):
            votes: dict = defaultdict(lambda: [0, 0])
            paths = {}
            for host, source in zip(b.column(0).to_pylist(), texts_of(b, "html").to_pylist()):
                page = Page(source)
                top = page.best()
                if page.size[top]:
                    key = (host, page.key[top])
                    votes[key][0] += 1
                    votes[key][1] += page.size[top]
                    if key not in paths:
                        paths[key] = page.path(top)
            cols = zip(*((h, k, paths[h, k], v, c) for (h, k), (v, c) in votes.items()))
            if votes:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.binary(), pa.string(), pa.int64(), pa.int64()))],
                                                 names=["host", "key", "path", "votes", "chars"])

    cast = (pages.select(host_of(url).alias("host"), F.col(html).alias("html")).mapInArrow(vote, schema)
            .groupBy("host", "key").agg(F.min("path").alias("path"), F.sum("votes").alias("votes"), F.sum("chars").alias("chars")))
    cast = stored(cast, "votes")
    all_votes = cast.groupBy("host").agg(F.sum("votes").alias("all"))
    won = cast.join(all_votes, "host").where(F.col("votes") >= share * F.col("all"))
    order = F.sort_array(F.collect_list(F.struct((-F.col("votes")).alias("v"), (-F.col("chars")).alias("c"), "path", "key")))
    return won.groupBy("host").agg(order.alias("won")).select(
        "host", F.col("won.key").alias("keys"), F.col("won.path").alias("paths"), F.transform("won.v", lambda v: -v).alias("votes"))


def main_text(pages: DataFrame, url: str = "url", html: str = "html", name: str = "text", chars: str = "n_chars", path: str = "path") -> DataFrame:
    """All columns plus the main text, its number of code points and the path it was found at (null: none)."""
    paths = stored(host_paths(pages, url, html), "host-paths")
    taken = {c.lower() for c in pages.columns} | {name, chars, path}
    extra = next(x for i in range(len(taken) + 1) if (x := f"host_keys_{i}") not in taken)
    host = f"{extra}_host"
    known = paths.select(F.col("host").alias(host), F.col("keys").alias(extra))
    pages = pages.withColumn(host, host_of(url)).join(known, host, "left").drop(host)
    fields = [T.StructField(name, T.StringType(), False), T.StructField(chars, T.LongType(), False), T.StructField(path, T.StringType())]

    def fn(texts, batch):
        out: tuple[list, list, list] = ([], [], [])
        for source, keys in zip(texts.to_pylist(), batch.column(batch.schema.get_field_index(extra)).to_pylist()):
            page = Page(source)
            text, at = page.extract(keys or [])
            for column, value in zip(out, (text, len(text), page.path(at) if text else None)):
                column.append(value)
        return list(out)

    return add_columns(pages, html, fields, fn).drop(extra)
