"""HTML main text by consensus host paths.

1. Every page is parsed and its containers are scored: paragraph text counts
   for its parent in full and for its grandparent by half, less the text of
   links; page furniture (menus, notices, comments, ...) counts for nothing.
   From the best one it goes up to the whole article: an article or main around
   it, else as long as its parent has further parts of the same text.
2. The best container's path -- tags with their classes from the root, digits
   generalised -- is a vote, weighted by nothing but the page. Votes are
   counted per host in Spark; the path with most votes wins (ties: the longer
   supporting text, then the greater path), and others with a good share of its
   votes are further templates of the host.
3. Every page is extracted again by its host's paths (``choose``). A page whose
   host's paths hold next to nothing, or without a host, uses its own best
   container.

Scale: the votes of a host are counts with map-side combine, so a host with a
third of all pages is a handful of rows per task; the window that ranks a
host's paths keeps its first few in each task. Winners are one row per
host, written and counted; they are broadcast up to a checked number and join by
sort with adaptive skew splitting beyond it, so pages are not dealt by host. Pages are parsed a batch at a
time; nothing is collected.

Defined results: null html = empty text; a page without any container with
text = empty text; repeated pages vote and are extracted one by one; a null
host is its own host; broken markup is repaired as far as block elements and
missing end tags go; white space inside a block is one space; other columns
of the input pass through when ``keep`` names them.
"""

from __future__ import annotations

import html as _html
import re

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from kmstream.llm.common import fresh, stored, text_batches

#: Element names by role.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe svg math textarea title select".split())
SKIP = RAW | frozenset("head nav footer aside button dialog menu object canvas audio video".split())
#: Furniture unless it wraps most of the page's text; a header inside an article is the article's.
WRAPPER = frozenset("form label header".split())
#: Elements that no class or id makes furniture.
NEVER = frozenset("html body article main".split())
BLOCK = frozenset("address article aside blockquote body center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
                  "header hr html li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul caption".split())
CONTAINER = frozenset("article body div main section td center blockquote".split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Containers that split an article; a part of another kind belongs to it from 1/FURTHER of the main part's text.
SPLIT, FURTHER = frozenset("section td center blockquote".split()), 10
#: A host's path is passed over on a page where it holds less than 1/FAR of the text of the page's own best container.
FAR = 8
#: An element of this kind ends an open element of the listed kinds (up to the nearest container).
IMPLIED_END = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",)}
#: Class or id words of page furniture: what is never main text, and parts of the layout, which may also name a wrapper.
FOREIGN = frozenset("ad ads advert adverts advertisement advertising comment comments commentlist consent cookie cookies disqus disclaimer modal newsletter "
                    "notice notices popup promo promoted related replies respond sponsor sponsored subscribe".split())
LAYOUT = frozenset("banner breadcrumb breadcrumbs footer header masthead menu nav navbar navigation pagination share sharing sidebar social toolbar widget".split())
#: Places before such a word (site-footer), and parts behind one that leave no doubt (comment-list).
PLACES = frozenset("site page main left right top bottom global primary secondary".split())
PARTS = frozenset("area bar block body box container content form item link links list message overlay posts section slot text thread top unit wrap wrapper".split())

# A quote opens a value behind = only; elsewhere, as in title=Bob's, it is a character like others.
_token = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|"
                    r"<(/?)([A-Za-z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)", re.S)
_attribute = re.compile(r"([^\s\"'>/=]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))")
_parts = re.compile(r"[a-z]+")
_digits = re.compile(r"\d+")
_raw_end = {t: re.compile(rf"</{t}\s*>", re.I) for t in RAW}

HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"


class Node:
    __slots__ = ("tag", "path", "parent", "mark", "skip", "kids", "score", "order")

    def __init__(self, tag, path, parent, mark, order):
        self.tag, self.path, self.parent, self.mark, self.order = tag, path, parent, mark, order
        self.kids: list = []      # nodes and strings, in page order
        self.score, self.skip = 0.0, False


def _marks(name: str) -> int:
    """What a class or id token says: 2 furniture, 1 furniture unless it wraps most of the page's text, 0 nothing."""
    parts = _parts.findall(name.lower())
    while len(parts) > 1 and parts[0] in PLACES:
        del parts[0]
    if not parts or parts[0] not in FOREIGN and parts[0] not in LAYOUT:
        return 0
    return 2 if parts[0] in FOREIGN and (len(parts) == 1 or parts[1] in PARTS) else 1


def _step(tag: str, attributes: str) -> tuple[str, int]:
    """The generalised path step of an element and how far its class or id marks furniture."""
    classes, names = [], []
    if "=" in attributes:
        for kind, a, b, c in _attribute.findall(attributes):
            kind, value = kind.lower(), a or b or c
            if kind in ("class", "id"):
                names += value.split()
            if kind == "class":
                classes += value.split()
    marked = max(map(_marks, names), default=0)
    step = tag + "".join("." + c for c in sorted({_digits.sub("#", c) for c in classes}))
    return step, marked


def parse(source: str) -> list[Node]:
    """The element nodes of a page, in page order; the first is the root, which is the body of a page that names none."""
    root = Node("#root", "", None, False, 0)
    nodes, stack, at = [root], [root], 0
    while True:
        m = _token.search(source, at)
        text = source[at:m.start() if m else len(source)]
        if text:
            stack[-1].kids.append(_html.unescape(text))
        if not m:
            if all(n.tag != "body" for n in nodes):
                root.tag = "body"
            _settle(nodes)
            return nodes
        at = m.end()
        if m[1] is not None:
            stack[-1].kids.append(m[1])
        if not m[3]:
            continue
        tag = m[3].lower()
        if m[2]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    del stack[i:]
                    break
            continue
        if tag in BLOCK:
            _close(stack, ("p",))
            if tag in HEADING and stack[-1].tag in HEADING:
                stack.pop()
        if tag in IMPLIED_END:
            _close(stack, IMPLIED_END[tag])
        step, marked = _step(tag, m[4])
        top = stack[-1]
        if tag in NEVER:
            marked = 0
        elif tag in SKIP:
            marked = 2
        elif tag in WRAPPER and not (tag == "header" and any(x.tag == "article" for x in stack)):
            marked = max(marked, 1)
        node = Node(tag, f"{top.path}/{step}", top, marked, len(nodes))
        nodes.append(node)
        top.kids.append(node)
        if tag in VOID or m[4].endswith("/") and tag not in BLOCK:
            continue
        if tag in RAW:
            end = _raw_end[tag].search(source, at)
            at = end.end() if end else len(source)
            continue
        stack.append(node)


def _settle(nodes: list[Node]) -> None:
    """Mark what is skipped; an element with a weak mark is not if it holds most of the page's text (links and certain furniture apart)."""
    sizes = [0] * len(nodes)
    if any(n.mark == 1 for n in nodes):
        out = [False] * len(nodes)
        for n in nodes:
            out[n.order] = n.mark == 2 or n.tag == "a" or n.parent is not None and out[n.parent.order]
            if not out[n.order]:
                sizes[n.order] = sum(len(k.strip()) for k in n.kids if isinstance(k, str))
        for n in reversed(nodes[1:]):
            sizes[n.parent.order] += sizes[n.order]
    for n in nodes[1:]:
        n.skip = n.parent.skip or n.mark == 2 or n.mark == 1 and 2 * sizes[n.order] <= sizes[0]


def _close(stack: list[Node], tags: tuple) -> None:
    """End the innermost open element of these kinds, unless a container is open inside it."""
    for i in range(len(stack) - 1, 0, -1):
        if stack[i].tag in tags:
            del stack[i:]
            return
        if stack[i].tag in CONTAINER or stack[i].tag in ("table", "ul", "ol", "dl"):
            return


def blocks_of(node: Node) -> list[str]:
    """The text blocks below a node, furniture left out, white space joined, in page order."""
    blocks, run = [], []

    def flush():
        text = " ".join("".join(run).split())
        if text:
            blocks.append(text)
        run.clear()

    todo = [(node, False)]
    while todo:
        x, done = todo.pop()
        if isinstance(x, str):
            run.append(x)
        elif done:
            flush()
        elif x is node or not x.skip:
            if x.tag in ("br", "wbr", "img"):
                run.append(" " if x.tag == "br" else "")
                continue
            if x.tag in BLOCK or x is node:
                flush()
                todo.append((x, True))
            todo.extend((k, False) for k in reversed(x.kids))
    return blocks


def best_container(nodes: list[Node]) -> Node | None:
    """The container with the highest score, or None if none has text."""
    for n in nodes:
        if n.skip:
            continue
        size = sum(len(k) for k in n.kids if isinstance(k, str) and not k.isspace())
        if not size:
            continue
        up, in_link = n, False
        while up.parent is not None and up.tag not in BLOCK:
            in_link |= up.tag == "a"
            up = up.parent
        gain = -size if in_link else size
        holder = up if up.tag in CONTAINER else up.parent
        while holder is not None and holder.tag not in CONTAINER:
            holder = holder.parent
        if holder is None:
            continue
        holder.score += gain
        outer = holder.parent
        while outer is not None and outer.tag not in CONTAINER:
            outer = outer.parent
        if outer is not None:
            outer.score += gain / 2
    best = max((n for n in nodes if n.tag in CONTAINER and not n.skip), key=lambda n: (n.score, -n.order), default=None)
    return _whole(best, nodes) if best is not None and best.score > 0 else None


def _holder(node: Node) -> Node | None:
    """The nearest container around a node."""
    up = node.parent
    while up is not None and up.tag not in CONTAINER:
        up = up.parent
    return up


def _whole(best: Node, nodes: list[Node]) -> Node:
    """The container of the whole article that ``best`` is the main part of."""
    around, up = {}, best
    while up is not None:
        around[up.tag] = up  # the outermost of each kind
        up = up.parent
    if "article" in around or "main" in around:
        return around.get("article") or around["main"]
    sizes, in_link = [0] * len(nodes), [False] * len(nodes)
    for n in nodes[1:]:
        in_link[n.order] = n.tag == "a" or in_link[n.parent.order]
        if not n.skip and not in_link[n.order]:
            sizes[n.order] = sum(len(k.strip()) for k in n.kids if isinstance(k, str))
    for n in reversed(nodes[1:]):
        sizes[n.parent.order] += sizes[n.order]
    parts: dict[int, list[Node]] = {}  # containers and headings with text, by their container
    for n in nodes:
        if sizes[n.order] and (n.tag in CONTAINER or n.tag in HEADING) and (up := _holder(n)) is not None:
            parts.setdefault(up.order, []).append(n)
    while (up := _holder(best)) is not None:
        size = sizes[best.order]
        others = [n for n in parts.get(up.order, ()) if n is not best and n.tag in CONTAINER]
        heading = any(n.tag in HEADING for n in parts.get(up.order, ()))
        direct = sizes[up.order] - size - sum(sizes[n.order] for n in others)
        same = [n for n in others if n.tag in SPLIT or n.path == best.path or up.tag != "body" and FURTHER * sizes[n.order] >= size]
        strange = len(same) < len(others)
        more = bool(same) or FURTHER * direct >= size
        if not (more and (up.tag != "body" or not strange) or heading and not strange):
            break
        best = up
    return best


def extract(nodes: list[Node], paths: list[str] | None = None) -> str:
    """The text of the main part of a page (``choose``)."""
    return choose(nodes, paths or [])[0]


def choose(nodes: list[Node], paths: list[str]) -> tuple[str, str | None]:
    """(text, path) of the main part of a page, by the paths its host agrees on, those with most votes first.

    The page's own best container decides if its path is one of them; else the first path
    whose outermost nodes hold at least a ``FAR``th of the text of that container, so a
    tagline that happens to lie where another template has its article is passed over;
    else (and without paths) the container itself, with no path.
    """
    best = best_container(nodes)
    own = "\n".join(blocks_of(best)) if best is not None else ""
    agreed = [p for p in paths if best is not None and p == best.path] or paths
    for path in agreed:
        text = "\n".join(b for n in nodes if n.path == path and not n.skip for b in blocks_of(n))
        if text and FAR * len(text) >= len(own):
            return text, path
    return own, None


def with_host(pages: DataFrame, url: str = "url", host: str = "host") -> DataFrame:
    """Adds the lower-cased host of a URL (null where there is none)."""
    return pages.withColumn(host, F.nullif(F.lower(F.regexp_extract(F.col(url).cast("string"), HOST, 1)), F.lit("")))


def host_paths(pages: DataFrame, html: str = "html", templates: int = 8, share: int = 5) -> DataFrame:
    """(host, paths): the paths a host's pages agree on, most votes first; ``pages`` has a host column.

    Paths with at least one vote in ``share`` of the winner's, and two at all, are templates of
    the host; the winner always is, and up to ``templates`` count.
    """

    def vote(batches):
        for pdf in batches:
            rows = []
            for host, source in zip(pdf["host"], pdf["html"]):
                best = best_container(parse(source)) if source else None
                if best is not None and isinstance(host, str):
                    rows.append((host, best.path, best.score))
            yield pd.DataFrame(rows, columns=["host", "path", "score"])

    votes = pages.select("host", F.col(html).cast("string").alias("html")).mapInPandas(vote, "host string, path string, score double")
    counted = votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"), F.max("score").alias("score"))
    order = W.partitionBy("host").orderBy(F.desc("votes"), F.desc("score"), F.desc("path"))
    top = counted.withColumn("nth", F.row_number().over(order)).filter(F.col("nth") <= templates)
    listed = top.groupBy("host").agg(F.sort_array(F.collect_list(F.struct("nth", "path", "votes"))).alias("top"))   # at most ``templates``
    agreed = F.filter("top", lambda t: (t["nth"] == 1) | (t["votes"] >= 2) & (share * t["votes"] >= F.col("top")[0]["votes"]))
    return listed.select("host", F.transform(agreed, lambda t: t["path"]).alias("paths"))


def extract_pages(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", keep: tuple = (),
                  broadcast_hosts: int = 50_000) -> DataFrame:
    """(page_id, url, *keep, text, n_chars, path): the main text of every page, and the agreed path it lies on (null: its own).

    The winners are counted first: up to ``broadcast_hosts`` hosts (some MB) travel
    to the pages, beyond that pages and winners meet by host. A kept column that has
    the name of a column of the result gets a number behind its name.
    """
    text_batches(pages.sparkSession)
    kept, taken = {}, ["page_id", "url", "text", "n_chars", "path"]
    for c in keep:
        kept[c] = fresh(c, taken)
        taken.append(kept[c])
    inner = {c: fresh(f"kept_{k}", ["page_id", "url", "html", "host", "paths", "found"]) for k, c in enumerate(keep)}
    given = with_host(pages.select(F.col(page_id).alias("page_id"), F.col(url).alias("url"),
                                   F.col(html).cast("string").alias("html"), *[F.col(c).alias(inner[c]) for c in keep]))
    winners = stored(given.sparkSession, host_paths(given), "page-winners")
    joined = given.join(F.broadcast(winners) if winners.count() <= broadcast_hosts else winners, "host", "left")

    @F.pandas_udf("text string, used string")
    def texts(sources: pd.Series, paths: pd.Series) -> pd.DataFrame:
        rows = [choose(parse(source), list(own) if own is not None else []) if source else ("", None) for source, own in zip(sources, paths)]
        return pd.DataFrame(rows, columns=["text", "used"])

    return (joined.withColumn("found", texts("html", "paths"))
            .select("page_id", "url", *[F.col(inner[c]).alias(kept[c]) for c in keep], F.col("found.text").alias("text"),
                    F.length("found.text").cast("long").alias("n_chars"), F.col("found.used").alias("path")))
