"""Main text of web pages by consensus of a host's pages.

1. Every container of a page is scored by the text of its own blocks less that of
   links; containers are named by generalised paths (tags with classes, numbers
   as N).
2. The pages of a host vote, each for its best path; total score, then the path
   itself, break ties.  Votes are summed before they are shuffled.
3. Every page is extracted again from the containers on its host's path; a page
   that has none of them uses its own best container.

Left out everywhere: scripts, styles, menus, headers, footers, sidebars, notices,
adverts, forms and reader comments, by tag, role or class words.

Defined results: null or empty pages, and pages without text, give the empty
text; pages without a host vote together; a tag that never ends runs to the end of
its parent; repeated rows each give a row; further columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import map_texts, small, stored, text_of

TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<![^>]*>|<\?[^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']|"[^"]*"|'[^']*')*)>""", re.S)
ATTRIBUTE = re.compile(r"""(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
RAW = {"script", "style", "template", "textarea", "title", "iframe", "noscript", "svg", "math", "object", "canvas", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
BLOCKS = {"p", "div", "h1", "h2", "h3", "h4", "h5", "h6", "li", "ul", "ol", "dl", "dt", "dd", "table", "thead", "tbody", "tfoot", "tr", "td", "th", "caption", "blockquote",
          "pre", "section", "article", "main", "figure", "figcaption", "address", "details", "summary", "center", "fieldset", "body", "html"}
CONTAINERS = {"", "html", "body", "div", "article", "section", "main", "td", "blockquote", "center"}
SKIP_TAGS = {"nav", "header", "footer", "aside", "form", "button", "select", "menu", "dialog", "head", "label", "option"}
SKIP_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "form"}
SKIP_WORDS = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|nav|navbar|navigation|menu|menubar|breadcrumbs?|sidebar|side|aside|footer|foot|header|masthead|topbar|"
    r"cookies?|consent|gdpr|notices?|alerts?|popup|modal|overlay|newsletter|subscribe|subscription|signup|login|share|sharing|social|related|recommend\w*|trending|"
    r"widgets?|comments?|commentlist|replies|reply|respond|disqus|reviews?|pagination|pager|toolbar|search|form)(?:$|[\s_-]|\d)", re.I)
ABOUT_OTHERS = re.compile(r"(?:has|with|without|no)[-_]\w+", re.I)  # "has-sidebar" says what stands beside
ABOUT_TOPIC = re.compile(r"side-by-side|\w+-by-\w+|(?:form|search|menu|review|comment|share|ad|alert|side)s?[-_](?:guide|tips|tutorial|history|story|facts|open|closed)", re.I)
# Such words say what a page offers, not what a box is, where the box itself tells it is an article.
ARTICLE = re.compile(r"(?:^|[\s_-])(?:post|article|entry|story|content|main|page|hentry|blogposting)(?:$|[\s_-]|\d)", re.I)
HEAD_ONLY = {"title", "meta", "link", "base", "style", "script", "noscript", "template"}
HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|$)|display\s*:\s*none", re.I)
# A new tag of these ends an open one of the second kind.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
END_P = BLOCKS - {"td", "th", "tr", "tbody", "thead", "tfoot", "caption", "body", "html"} | {"form", "nav", "header", "footer", "aside", "hr"}


class Element:
    """An open container: its path, and where its text begins in the page's blocks."""

    __slots__ = ("tag", "path", "skipped", "first", "score", "last")

    def __init__(self, tag: str, path: str, skipped: bool, first: int):
        self.tag, self.path, self.skipped, self.first, self.score, self.last = tag, path, skipped, first, 0.0, None


def _names(attributes: str) -> tuple[str, str, str]:
    """(class, id, role)."""
    found = {"class": "", "id": "", "role": ""}
    for name, a, b, c in ATTRIBUTE.findall(attributes):
        found[name.lower()] = a or b or c
    return found["class"], found["id"], found["role"]


def _is_article(tag: str, kind: str, name: str, titled: bool) -> bool:
    """Whether a box whose names hold a skip word is an article all the same: its tag or its
    first class says so, or the word is only a part of a longer name that says how it looks
    or what it is about ("post review", "side-by-side", "form-guide")."""
    if tag in ("article", "main") or titled:
        return True
    first = kind.split()[:1]
    if first and ARTICLE.search(first[0]) and not SKIP_WORDS.search(ABOUT_OTHERS.sub("", first[0])):
        return True
    return bool(first or name) and all(ABOUT_TOPIC.fullmatch(x) for x in [*kind.split(), *([name] if name else [])] if SKIP_WORDS.search(x))


def parse(html: str) -> tuple[list[str], list[Element]]:
    """The kept text blocks of a page in order, and its containers with their span of blocks."""
    blocks: list[str] = []
    done: list[Element] = []
    root = Element("", "", False, 0)
    stack = [root]
    text: list[str] = []
    linked = at = links = 0

    def flush() -> None:
        nonlocal linked
        if text:
            block = " ".join(unescape("".join(text)).split())
            if block:
                # Text counts for its container, half for the one around it.
                worth, share = max(0, len(block) - 2 * linked), 1.0
                for e in reversed(stack):
                    if e.tag in CONTAINERS:
                        e.score += worth * share
                        share /= 2
                        if share < 0.5:
                            break
                blocks.append(block)
            text.clear()
        linked = 0

    def close(count: int) -> None:
        nonlocal links
        for _ in range(count):
            e = stack.pop()
            links -= e.tag == "a"
            if e.tag in CONTAINERS and not e.skipped:
                e.last = len(blocks)
                done.append(e)

    end = len(html)
    while at < end:
        m = TOKEN.search(html, at)
        stop = m.start() if m else end
        if stop > at and not stack[-1].skipped:
            piece = html[at:stop]
            text.append(piece)
            if links:
                linked += len(piece)
        if not m:
            break
        at = m.end()
        tag = m[2]
        if tag is None:
            continue
        tag = tag.lower()
        if tag == "br" or tag == "hr":
            flush()
            continue
        if m[1]:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag == tag:
                    if tag in BLOCKS or stack[depth].skipped:
                        flush()
                    close(len(stack) - depth)
                    break
                if tag not in BLOCKS and stack[depth].tag in BLOCKS:
                    break  # an inline end tag closes nothing beyond its block
            continue
        if tag in VOID or m[3].endswith("/"):
            continue
        if tag in RAW:
            closing = re.compile(rf"</{tag}\s*>", re.I).search(html, at)
            at = closing.end() if closing else end
            continue
        block = tag in BLOCKS or tag in SKIP_TAGS
        if block:
            flush()
        ended = ENDS.get(tag, ()) or ({"p"} if tag in END_P else ())
        if ended:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].tag in ended:
                    close(len(stack) - depth)
                    break
                if stack[depth].tag in BLOCKS:
                    break
        if tag not in HEAD_ONLY and any(e.tag == "head" for e in stack):
            close(len(stack) - next(i for i, e in enumerate(stack) if e.tag == "head"))  # its end tag may be left out
        above = stack[-1]
        # A header inside an article holds the article's own title.
        titled = tag == "header" and any(e.tag in ("article", "main") for e in stack)
        skipped = above.skipped or (tag in SKIP_TAGS and not titled)
        path = above.path
        if not skipped and block:
            kind, name, role = _names(m[3]) if m[3] else ("", "", "")
            named = ABOUT_OTHERS.sub("", f"{kind} {name}")
            boxed = bool(SKIP_WORDS.search(named)) and not _is_article(tag, kind, name, titled)
            skipped = tag not in ("body", "html") and bool(boxed or role.lower() in SKIP_ROLES or HIDDEN.search(m[3]))
            if tag in CONTAINERS and tag != "html":  # which a page may leave out
                path = f"{path}/{tag}" + "".join(f".{c}" for c in sorted(set(re.sub(r"\d+", "N", kind).split())))
        links += tag == "a"
        stack.append(Element(tag, path, skipped, len(blocks)))
    flush()
    close(len(stack) - 1)
    root.last = len(blocks)
    done.append(root)
    return blocks, done


def containers(html: str) -> dict[str, float]:
    """Path to the sum of its containers' scores."""
    out: dict[str, float] = {}
    for e in parse(html)[1]:
        if e.score > 0:
            out[e.path] = out.get(e.path, 0.0) + e.score
    return out


def extract(html: str, path: str | None) -> str:
    """The text of the containers on ``path``, or of the best-scored path if there are none."""
    blocks, done = parse(html)
    chosen = [e for e in done if path is not None and e.path == path and e.tag]
    if not any(e.last > e.first for e in chosen):
        best = max((e for e in done), key=lambda e: (e.score, e.last - e.first), default=None)
        chosen = [best]
    take = [False] * len(blocks)
    for e in chosen:
        take[e.first : e.last] = [True] * (e.last - e.first)
    return "\n".join(b for b, t in zip(blocks, take, strict=True) if t)


def _host(url: str):
    return F.coalesce(F.lower(F.regexp_extract(url, r"^\s*[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def consensus_paths(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(host, path, votes): the winning path of every host whose pages have any text."""
    source = pages.select(_host(url).alias("host"), text_of(html).alias("html"))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            rows = []
            for host, text in zip(batch.column("host").to_pylist(), batch.column("html").to_pylist(), strict=True):
                found = containers(text)
                best = max(found, key=lambda p: (found[p], p), default=None)
                rows += [(host, p, s, int(p == best)) for p, s in found.items()]
            names = ["host", "path", "score", "vote"]
            types = [pa.string(), pa.string(), pa.float64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], types[i]) for i in range(4)], names=names)

    votes = map_texts(source, score, "host string, path string, score double, vote int")
    votes = votes.groupBy("host", "path").agg(F.sum("vote").alias("votes"), F.sum("score").alias("score"))
    return votes.groupBy("host").agg(F.max(F.struct("votes", "score", "path")).alias("b")).select("host", "b.path", "b.votes")


def main_texts(pages: DataFrame, keep: tuple[str, ...] = ("page_id", "url"), url: str = "url", html: str = "html") -> DataFrame:
    """The ``keep`` columns, ``text`` and ``n_chars`` of every page."""
    paths = stored(consensus_paths(pages, url, html), "host-paths").select(F.col("host").alias("__host"), F.col("path").alias("__path"))
    source = pages.select(*keep, _host(url).alias("__host"), text_of(html).alias("__html")).join(paths, "__host", "left").drop("__host")
    schema = ", ".join([f"`{c}` {t}" for c, t in source.dtypes if c not in ("__html", "__path")] + ["text string", "n_chars bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in small(batches):
            texts = [extract(h, p) for h, p in zip(batch.column("__html").to_pylist(), batch.column("__path").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(texts, pa.string()), pa.array([len(x) for x in texts], pa.int64())],
                                             names=[*keep, "text", "n_chars"])

    return map_texts(source, run, schema)


def op7(spark, sf_dir: str) -> DataFrame:
    return main_texts(spark.read.parquet(f"{sf_dir}/pages.parquet"))
