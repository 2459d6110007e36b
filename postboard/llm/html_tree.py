"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree whose nodes are style paths: the tags with their classes below the body.
Over the host's distinct pages, each node has three entropies: of its own layout (the sequence of its children), of its
whole branch's layout, and of its contents. Contents are scaled by the most there could be, so 1 says that all pages
differ and 0 that all show the same. Layout counts as 1 - exp(-entropy): 0 for one layout, near 1 for many. A branch is as
important as its contents times the most varied layout in, at or above it: menus, adverts and footers come in one layout
or with few contents, articles in many. Elements marked as article or main count as varied in layout.

What an element is called weighs in: navigation, adverts, forms or comments by a quarter, ambiguous names by half. Names
count as a whole (`ad-slot`, not `ad-hoc`). What is not shown (noscript, hidden, display: none) is no text at all. A branch below the threshold is cut from the page, with all that is in it. What is outside the page's article, where there
is one, is no main text.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postboard.llm.common import materialise, rows_of

#: An attribute; a value without quotes may hold quotes.
ATTRIBUTE = r"""[^\s/>][^\s/>=]*+(?:\s*+=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"'][^\s>]*+)?+)?+"""
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style|textarea|title|template|iframe|noscript)\b[^>]*>.*?(?:</\1\s*>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|"
    rf"<(/?)([a-zA-Z][^\s/>]*+)((?:[\s/]++|{ATTRIBUTE})*+)>|<[!?/][^>]*>",
    re.S | re.I,
)
SINGLE = re.compile(ATTRIBUTE)
#: What an element says that is not shown, attribute by attribute.
HIDDEN = re.compile(r"""hidden(?:\s*=(?!\s*["']?until-found).*)?|aria-hidden\s*=\s*["']?true["']?|style\s*=.*\bdisplay\s*:\s*none\b.*""", re.S | re.I)
NAMED = re.compile(r"""(?<![^\s/"'])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>"'][^\s>]*))""", re.I)
#: Elements of HTML by what they do.
INLINE = frozenset("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr svg math".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
IN_HEAD = frozenset("base link meta".split())
#: Elements that end a formula or drawing which was left open.
BLOCKS = frozenset("address article aside blockquote div dl dt dd fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr li main nav ol p pre section table td th tr ul".split())
NOISE_TAGS = frozenset("nav footer aside form button select option dialog menu object canvas audio video fieldset head".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())
#: Words of class names and ids that say what an element is, those that may say so, and those beside them that
#: tell where it stands or how it is built. A name counts where all its words are of these: `ad-slot`, but not `ad-hoc`.
NOISE_NAMES = frozenset("ad ads advert adverts advertisement advertising nav navbar navigation menu sidebar breadcrumb breadcrumbs footer comment comments reply replies respond response responses discussion disqus masthead copyright".split())
MAYBE_NAMES = frozenset("banner cookie cookies consent notice notices promo promotion sponsor sponsored share sharing social related newsletter subscribe subscription popup modal widget login signup toolbar gdpr".split())
BESIDE = frozenset("site page main top bottom left right inner outer primary secondary global mobile desktop sticky fixed slot box list bar block area section item items unit container wrapper wrap group row col column panel header head body content links link icons buttons button form thread policy overlay strip card posts articles stories media network news reader user the".split())
CLOSED_BY = {"p": frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p pre section table ul".split()), "li": frozenset(["li"]), "dt": frozenset(["dt", "dd"]), "dd": frozenset(["dt", "dd"]), "tr": frozenset(["tr"]), "td": frozenset(["td", "th", "tr"]), "th": frozenset(["td", "th", "tr"]), "option": frozenset(["option"])}

NEUTRAL, SURE, MAYBE, MOST_LINKS = 0.5, 0.25, 0.5, 0.6
ROOT = 0
#: Per style path: importance of its contents, variety of its branch's layout, and of its own layout.
Scores = dict[int, tuple[float, float, float]]


def mixed(a: int, b: int) -> int:
    return xxhash.xxh3_64_intdigest(a.to_bytes(8, "little"), b)


def prior(tag: str, names: list[str], role: str, in_article: bool) -> float:
    """What an element's tag, role and names say: 1 for nothing. An article is noise only by a whole name that says so."""
    if tag in NOISE_TAGS or role in NOISE_ROLES or tag == "header" and not in_article:
        return SURE
    if tag in ("article", "main"):
        return SURE if any(n.lower() in NOISE_NAMES for n in names) else 1.0
    whole = [{*re.split(r"[-_\s]+", re.sub(r"\d+|([a-z])(?=[A-Z])", r"\1-", n).lower())} - {""} for n in names]
    said = {p for parts in whole if parts <= NOISE_NAMES | MAYBE_NAMES | BESIDE for p in parts}
    return SURE if said & NOISE_NAMES else MAYBE if said & MAYBE_NAMES else 1.0


def hidden(attributes: str) -> bool:
    """Whether a tag's attributes keep its element from being shown."""
    return ("hidden" in attributes or "none" in attributes) and any(HIDDEN.fullmatch(a) for a in SINGLE.findall(attributes))


@dataclass(slots=True)
class Element:
    tag: str
    path: int
    weight: float = 1.0
    article: bool = False  # it or what it is in
    cut: bool = False  # by the tree and names, it or what it is in
    dull: bool = False  # by its contents and names alone
    above: float = 0.0  # the most varied layout above
    own: int = 1
    sub: int = 1
    content: int = 1
    hidden: bool = False
    step: int = 0
    block: Element | None = None  # of an inline element: the block it is in


@dataclass
class Block:
    path: int
    text: str
    article: bool
    cut: bool
    dull: bool


@dataclass
class Page:
    blocks: list[Block] = field(default_factory=list)
    nodes: dict[int, list[int]] = field(default_factory=dict)  # path: digests of own layout, branch layout, contents
    digest: int = 1


def parsed(page: str, scores: Scores | None = None, threshold: float = 0.3) -> Page:
    """Blocks with text in page order, and the digests of each style node.

    Broken markup does no harm: open elements end where their parents do, and a head ends where anything that cannot be
    in it begins. Nesting may be of any depth.
    """
    scores, out = scores or {}, Page()
    unknown = (NEUTRAL, 1.0, 1.0)
    bottom = Element("", ROOT, above=scores.get(ROOT, unknown)[2])
    stack, opened, parts, links, muted = [bottom], Counter(), [], 0, 0

    def flush() -> None:
        nonlocal parts
        if parts:
            raw = "".join(p for p, _ in parts)
            if not raw.isspace() and (text := " ".join(html.unescape(raw).split())):
                top = stack[-1].block or stack[-1]
                top.content = mixed(top.content, xxhash.xxh3_64_intdigest(text))
                linked = not top.article and sum(len(p.strip()) for p, link in parts if link) > MOST_LINKS * len(raw.strip())
                content, sub, _ = scores.get(top.path, unknown)
                importance = content * max(sub, top.above) * top.weight * (MAYBE if linked else 1.0)
                out.blocks.append(Block(top.path, text, top.article, top.cut or importance < threshold, top.dull or linked))
            parts = []

    def close(k: int) -> None:
        nonlocal links, muted
        if any(e.tag not in INLINE for e in stack[k:]):
            flush()
        while len(stack) > k:
            e = stack.pop()
            opened[e.tag] -= 1
            links -= e.tag == "a"
            muted -= e.hidden
            if e.tag not in INLINE:
                up = stack[-1].block or stack[-1]
                up.own, up.sub, up.content = mixed(up.own, e.step), mixed(up.sub, mixed(e.step, e.sub)), mixed(up.content, e.content)
                note(e)

    def note(e: Element) -> None:
        if (seen := out.nodes.get(e.path)) is None:
            out.nodes[e.path] = [e.own, e.sub, e.content]
        else:
            for k, value in enumerate((e.own, e.sub, e.content)):
                seen[k] = mixed(seen[k], value)

    def close_inline() -> None:
        k = len(stack)
        while stack[k - 1].tag in INLINE:
            k -= 1
        if k < len(stack):
            close(k)

    def leave_head() -> None:
        if opened["head"]:
            close(next(k for k, e in enumerate(stack) if e.tag == "head"))

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            text = page[at : m.start()]
            if opened["head"] and not text.isspace():
                leave_head()
            if not muted:
                parts.append((text, links > 0))
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag or tag in ("html", "body"):
            if tag == "body":
                leave_head()
            continue
        if (opened["svg"] or opened["math"]) and tag not in BLOCKS and tag not in ("svg", "math"):
            continue
        if m[2]:
            if tag not in INLINE:
                flush()
            if opened[tag]:
                k = len(stack) - 1
                while stack[k].tag != tag and not (tag in INLINE and stack[k].tag not in INLINE):
                    k -= 1
                if stack[k].tag == tag:
                    close(k)
            continue
        if opened["head"] and tag not in IN_HEAD:
            leave_head()
        if tag in VOID:
            parts.append((" ", False))
            if tag not in INLINE:
                flush()
            continue
        if tag not in INLINE:
            flush()
            close_inline()  # an unclosed inline element does not reach into the next block
            if tag in CLOSED_BY.get(stack[-1].tag, ()):
                close(len(stack) - 1)
        top = stack[-1]
        if tag in INLINE:
            if not m[4].endswith("/"):
                stack.append(Element(tag, top.path, top.weight, top.article, top.cut, top.dull, top.above, hidden=hidden(m[4]), block=top.block or top))
                opened[tag] += 1
                muted += stack[-1].hidden
                links += tag == "a"
            continue
        said = {a[0].lower(): a[1] or a[2] or a[3] for a in NAMED.findall(m[4])} if m[4] else {}
        classes = said.get("class", "").split()
        p = prior(tag, [*classes, said.get("id", "")], said.get("role", "").lower(), top.article)
        step = xxhash.xxh3_64_intdigest(" ".join([tag, *sorted({re.sub(r"\d+", "", c) for c in classes})]))
        e = Element(tag, mixed(top.path, step), min(p, top.weight), step=step, hidden=hidden(m[4]))
        muted += e.hidden
        e.article = top.article or tag in ("article", "main") and p == 1.0
        content, sub, own = scores.get(e.path, unknown)
        above = 1.0 if e.article else top.above
        e.cut = top.cut or content * max(sub, above) * e.weight < threshold
        e.dull = top.dull or content * e.weight < threshold
        e.above = max(above, own if e.path in scores else 0.0)
        stack.append(e)
        opened[tag] += 1
    if at < len(page):
        text = re.sub(r"<[a-zA-Z/!?][^<>]*\Z", "", page[at:])
        if opened["head"] and not text.isspace():
            leave_head()
        if not muted:
            parts.append((text, links > 0))
    flush()
    if len(stack) > 1:
        close(1)
    note(bottom)
    out.digest = bottom.content
    return out


def chosen(page: Page) -> str:
    """The blocks that the tree keeps; where it keeps none, contents and names decide alone. With an article, only that."""
    kept = [b for b in page.blocks if not b.cut] or [b for b in page.blocks if not b.dull]
    if any(b.article for b in kept):
        kept = [b for b in kept if b.article]
    return "\n".join(b.text for b in kept)


def keyed(pages: DataFrame) -> DataFrame:
    """page_id, url, html, host, and two hashes of the row, which name it."""
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:]+)", 1)), F.lit(""))
    return pages.select("page_id", "url", "html", host.alias("host"), F.xxhash64("page_id", "url", "html").alias("k1"), F.xxhash64("html", "page_id", "url").alias("k2"))


def nodes_of(rows: DataFrame) -> DataFrame:
    """(host, k1, k2, page, path, own, sub, content) of each style node of each page."""
    names = ["host", "k1", "k2", "page", "path", "own", "sub", "content"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rows_of(batches, "host", "k1", "k2", "html"):
            out: list[list[object]] = [[] for _ in names]
            for host, k1, k2, page in zip(*batch, strict=True):
                tree = parsed(page or "")
                for path, digests in tree.nodes.items():
                    for column, value in zip(out, (host, k1, k2, tree.digest - 2**63, path - 2**63, *(d - 2**63 for d in digests)), strict=True):
                        column.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if k else pa.string()) for k, c in enumerate(out)], names)

    return rows.select("host", "k1", "k2", "html").mapInArrow(run, "host string, " + ", ".join(f"{n} long" for n in names[1:]))


def style_tree(nodes: DataFrame) -> DataFrame:
    """(host, path, pages, contents, branch, layout): the merged tree of each host over its distinct pages."""
    distinct = nodes.select("host", "page", "path", "own", "sub", "content").distinct()
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(c).alias("digest")) for k, c in enumerate(("content", "sub", "own"))])
    counts = distinct.select("host", "path", F.inline(kinds)).groupBy("host", "path", "kind", "digest").agg(F.count("*").alias("n"))
    total = F.sum(F.when(F.col("kind") == 0, F.col("n")))
    entropy = lambda k: F.log(total) - F.sum(F.when(F.col("kind") == k, F.col("n") * F.log("n"))) / total
    variety = lambda k: 1 - F.exp(-entropy(k))
    content = F.when(total > 1, entropy(0) / F.log(total)).otherwise(1.0)
    return counts.groupBy("host", "path").agg(total.alias("pages"), content.alias("contents"), variety(1).alias("branch"), variety(2).alias("layout"))


def page_scores(nodes: DataFrame, tree: DataFrame, salts: int = 16) -> DataFrame:
    """(k1, k2, scores) of each page with a judged node; the nodes of a hot host are dealt over several tasks."""
    salt = F.pmod("k1", F.lit(salts)).alias("salt")
    score = F.struct("path", "contents", "branch", "layout")
    each = tree.select("host", score.alias("score"), "path", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("salt"))
    found = nodes.select("host", "path", "k1", "k2", salt).join(each, ["host", "path", "salt"])
    return found.groupBy("k1", "k2").agg(F.collect_set("score").alias("scores"))


def main_text(pages: DataFrame, *, threshold: float = 0.3, least_pages: int = 5, use_tree: bool = True) -> DataFrame:
    """Per row: page_id, url, text, n_chars.

    A null html gives the empty text. A node is judged only where at least `least_pages` distinct pages show it, so on
    small sites, and on copies of one page, names decide alone (so they do without `use_tree`). Pages without a host in
    the url are one site. Repeated rows give repeated rows.
    """
    rows = keyed(pages)
    lists: Column = F.lit(None).cast("array<struct<path:long,contents:double,branch:double,layout:double>>")
    if use_tree:
        nodes = materialise(nodes_of(rows), "nodes")
        tree = materialise(style_tree(nodes).filter(F.col("pages") >= least_pages), "styles")
        found = page_scores(nodes, tree).withColumnsRenamed({"k1": "_k1", "k2": "_k2"})
        rows = rows.join(found, (F.col("k1") == F.col("_k1")) & (F.col("k2") == F.col("_k2")), "left")
        lists = F.col("scores")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, urls, htmls, all_scores in rows_of(batches, "page_id", "url", "html", "scores"):
            known = [{s["path"] + 2**63: (s["contents"], s["branch"], s["layout"]) for s in x or ()} for x in all_scores]
            texts = [chosen(parsed(h or "", x, threshold)) for h, x in zip(htmls, known, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(urls, pa.string()), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"]
            )

    return rows.select("page_id", "url", "html", lists.alias("scores")).mapInArrow(run, "page_id long, url string, text string, n_chars long")

