"""Main text of web pages with site-template removal.

Every page is parsed into element subtrees; a subtree's hash covers its tag, text
and children. Spark counts, per host, on how many pages a subtree stands; those
that recur on ``share`` of a host's pages (and on ``least`` pages) are template and
are deleted from every page of that host. Within an article the text blocks
themselves (paragraphs, headings, ...) are content, even if a site repeats them.

Elements that are never the article go as well: by tag (menus, footers, asides,
forms, scripts, styles, ...) and by the words of their class, id and role (adverts,
notices, reader comments, ...). If a page has an article or main element, the text
is what they hold; else what the body holds.

Character references are decoded; white space inside a block becomes one space;
blocks are joined by one space in page order; nothing is capped.

Defined results: null or empty html gives an empty text; a null url belongs to no
host (no template counts); repeated rows count and are extracted each; an empty
table gives no rows; input columns named like the outputs are replaced.
"""

from __future__ import annotations

import re
from html import unescape
from html.parser import HTMLParser

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType
from pyspark.sql.pandas.types import to_arrow_schema

from salesfacts.llm.common import checkpointed, slices

TEMPLATE_SHARE, TEMPLATE_LEAST = 0.5, 8
SMALL_HOSTS = 20_000  # hosts with templates up to which their hashes are broadcast (a host has at most a few hundred)
SALTS = 32  # shares of a host's pages in the join beyond that

# HTML's void, inline and never-content elements, and words that name page furniture.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup "
    "time tt u var wbr".split())
DROPPED = frozenset(
    "aside audio button canvas embed footer form frame frameset head iframe input label menu nav noframes noscript object "
    "option script search select style svg template textarea title video".split())
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 blockquote pre li dt dd td th figcaption ul ol dl table tbody tr".split())
FURNITURE = frozenset(
    "ad ads adv advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent cookie cookies "
    "disqus footer gdpr login menu modal nav navbar navigation newsletter notice notification overlay pagination popup promo "
    "promotion recommended related replies reply share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar "
    "widget".split())
FURNITURE_OUTSIDE = frozenset("header masthead topbar".split())  # page headers; inside an article they hold its heading
FURNITURE_ROLES = frozenset("alert banner complementary contentinfo dialog form menu menubar navigation search".split())
# An open element of the values ends where the key begins, if nothing of the last column stands between.
CLOSED_BY = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
SCOPE = frozenset("article aside body button div footer form header main nav section table td th ul ol li blockquote".split())

_WORD = re.compile(r"[a-z]+")
_COMMENT_END, _SECTION_END, _CONDITION_END = re.compile(r"--!?\s*>"), re.compile(r"\]\s*\]\s*>"), re.compile(r"\]\s*>")
_SECTION_NAME = re.compile(r"<!\[\s*(temp|cdata|ignore|include|rcdata|if|else|endif)\b", re.I)


class Node:
    __slots__ = ("tag", "kids", "dropped", "article", "hash", "has_text")

    def __init__(self, tag: str, dropped: bool, article: bool):
        self.tag, self.kids, self.dropped, self.article, self.hash, self.has_text = tag, [], dropped, article, 0, False


def _furniture(tag: str, attrs, inside: bool) -> bool:
    """An article's own class or id counts by whole names only ("comment", not "comments-open")."""
    for name, value in attrs:
        if value and name in ("class", "id"):
            words = set(value.lower().split()) if tag in ("article", "main") else set(_WORD.findall(value.lower()))
            if words & FURNITURE or (not inside and words & FURNITURE_OUTSIDE):
                return True
        elif value and name == "role" and value.strip().lower() in FURNITURE_ROLES:
            return True
        elif name in ("hidden", "aria-hidden") and (value or "").lower() in (("", "hidden") if name == "hidden" else ("true",)):
            return True
    return False


class _Tree(HTMLParser):
    """Elements and texts of a page; unclosed elements end with what holds them.

    ``at`` holds the places of the open elements by tag, ``scopes`` those of ``SCOPE``,
    ``inside`` the number of open articles and mains: no tag looks at all that is open.
    """

    def __init__(self, html: str):
        super().__init__(convert_charrefs=True)
        self.last = {end: max((m.start() for m in end.finditer(html)), default=-1) for end in (_COMMENT_END, _SECTION_END, _CONDITION_END)}
        self.root = Node("#page", False, False)
        self.open = [self.root]
        self.at: dict[str, list[int]] = {}
        self.scopes: list[int] = []
        self.inside = 0

    def _push(self, node: Node) -> None:
        n = len(self.open)
        self.open.append(node)
        self.at.setdefault(node.tag, []).append(n)
        if node.tag in SCOPE:
            self.scopes.append(n)
        self.inside += node.tag in ("article", "main")

    def _close(self, n: int) -> None:
        while len(self.open) > n:
            tag = self.open.pop().tag
            self.at[tag].pop()
            if tag in SCOPE:
                self.scopes.pop()
            self.inside -= tag in ("article", "main")

    def _last(self, tags) -> int:
        return max((places[-1] for t in tags if (places := self.at.get(t))), default=0)

    def handle_starttag(self, tag, attrs):
        if (tag not in INLINE and tag not in VOID or tag == "hr") and (p := self._last(("p",))) > (self.scopes[-1] if self.scopes else 0):
            self._close(p)
        if tag in CLOSED_BY:
            tags, stop = CLOSED_BY[tag]
            if (n := self._last(tags)) > self._last(stop):
                self._close(n)
        inside = self.inside > 0
        dropped = tag in DROPPED or (tag == "header" and not inside) or (tag not in ("html", "body") and _furniture(tag, attrs, inside))
        node = Node(tag, dropped, tag in ("article", "main") and not dropped)
        self.open[-1].kids.append(node)
        if tag not in VOID:
            self._push(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open[-1].tag == tag:
            self._close(len(self.open) - 1)

    def handle_endtag(self, tag):
        if n := self._last((tag,)):
            self._close(n)

    def handle_data(self, data):
        self.open[-1].kids.append(data)

    def parse_comment(self, i, *args):
        return super().parse_comment(i, *args) if self.last[_COMMENT_END] > i else -1  # -1: never closed, so it is text

    def parse_marked_section(self, i, *args):
        name = _SECTION_NAME.match(self.rawdata, i)
        if not name:
            return self.parse_bogus_comment(i)
        end = _CONDITION_END if name[1].lower() in ("if", "else", "endif") else _SECTION_END
        return super().parse_marked_section(i, *args) if self.last[end] > i else -1


def parse(html: str) -> Node:
    """The element tree; what follows the last ">" cannot end a tag and is text."""
    tree = _Tree(html)
    cut = html.rfind(">") + 1
    tree.feed(html[:cut])
    tree.close()
    if cut < len(html):
        tree.handle_data(unescape(html[cut:]))
    return tree.root


def _order(root: Node) -> list[Node]:
    """All elements, parents first (pages may be nested deeper than Python's stack)."""
    out = [root]
    for node in out:
        out.extend(k for k in node.kids if isinstance(k, Node))
    return out


def hash_subtrees(root: Node) -> list[Node]:
    """Sets the hash of every element; returns those that hold text, parents first."""
    nodes = _order(root)
    for node in reversed(nodes):
        parts = [node.tag.encode()]
        for k in node.kids:
            if isinstance(k, Node):
                node.has_text |= k.has_text
                parts.append(b"\x01%d" % k.hash)
            elif text := " ".join(k.split()):
                node.has_text = True
                parts.append(b"\x02" + text.encode("utf-8", "surrogatepass"))
        node.hash = xxhash.xxh3_64_intdigest(b"\x00".join(parts)) - (1 << 63)
    return [n for n in nodes if n.has_text]


def _pieces(start: Node, templates) -> list[str]:
    """Texts under ``start`` in page order, with a space at each block's edges."""
    out: list[str] = []
    todo: list = [(start, False, start.article)]
    while todo:
        item, done, inside = todo.pop()
        if isinstance(item, str):
            out.append(item)
            continue
        if done:
            out.append(" ")
            continue
        if item is not start and (item.dropped or (item.hash in templates and not (inside and item.tag in TEXT_BLOCKS | INLINE))):
            continue
        inside = inside or item.article
        if item.tag not in INLINE:
            out.append(" ")
            todo.append((item, True, inside))
        todo.extend((k, False, inside) for k in reversed(item.kids))
    return out


def main_text(html: str | None, templates=frozenset()) -> str:
    """The page's main text; ``templates`` holds hashes of subtrees to delete."""
    if not html:
        return ""
    root = parse(html)
    if templates:
        hash_subtrees(root)
    found: list[Node] = []
    wrapped: list[Node] = []  # held by an element that only its class or role makes page furniture
    todo = [(root, False, False)]
    while todo:  # outermost article or main elements
        node, soft, hard = todo.pop()
        hard = hard or (node.dropped and node.tag in DROPPED)
        soft = soft or node.dropped
        if node.article and not hard:
            (wrapped if soft else found).append(node)
        else:
            todo.extend((k, soft, hard) for k in reversed(node.kids) if isinstance(k, Node))
    found = found or wrapped
    held = [part for n in found for part in (_articles(n) or [n] if n.tag == "main" else [n])]
    texts = [" ".join("".join(_pieces(n, templates)).split()) for n in (held or [root])]
    return " ".join(t for t in texts if t)


def _articles(main: Node) -> list[Node]:
    """A main element may hold the article beside other things: its outermost articles that nothing dropped holds, in page order."""
    out: list[Node] = []
    todo = [k for k in reversed(main.kids) if isinstance(k, Node)]
    while todo:
        node = todo.pop()
        if node.dropped:
            continue
        if node.tag == "article":
            out.append(node)
        else:
            todo.extend(k for k in reversed(node.kids) if isinstance(k, Node))
    return out


def host_of(url):
    return F.nullif(F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))


def site_templates(pages: DataFrame, url_col: str, html_col: str, share: float = TEMPLATE_SHARE, least: int = TEMPLATE_LEAST) -> DataFrame:
    """(host, templates): hashes of the subtrees that recur on a host's pages. A host has at most 1 / share times a page's elements."""
    hosts = pages.select(host_of(F.col(url_col)).alias("host"), F.col(html_col).alias("html")).where("host IS NOT NULL")

    def run(batches):
        for batch in batches:
            for part in slices(batch, "html", 2 << 20):
                hosts, hashes = [], []
                for host, html in zip(part.column("host").to_pylist(), part.column("html").to_pylist()):
                    own = {n.hash for n in hash_subtrees(parse(html))} if html else set()
                    hosts += [host] * len(own)
                    hashes += own
                yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(hashes, pa.int64())], names=["host", "hash"])

    counts = hosts.mapInArrow(run, "host string, hash long").groupBy("host", "hash").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    sizes = hosts.groupBy("host").agg(F.count("*").alias("pages")).where(F.col("pages") >= least)
    return counts.join(sizes, "host").where(F.col("n") >= share * F.col("pages")).groupBy("host").agg(F.collect_list("hash").alias("templates"))


def extract(pages: DataFrame, url_col: str = "url", html_col: str = "html", share: float = TEMPLATE_SHARE, least: int = TEMPLATE_LEAST) -> DataFrame:
    """``pages`` plus ``text`` (main text) and ``n_chars`` (its code points)."""
    fields = [StructField("text", StringType()), StructField("n_chars", LongType())]
    found = checkpointed(site_templates(pages, url_col, html_col, share, least)).select(
        F.col("host").alias("_host"), F.col("templates").alias("_templates"))
    rows = pages.drop("text", "n_chars").withColumn("_host", host_of(F.col(url_col)))
    if found.limit(SMALL_HOSTS + 1).count() <= SMALL_HOSTS:
        rows = rows.join(F.broadcast(found), "_host", "left").drop("_host")
    else:  # a host may hold a third of all pages: its pages go to SALTS shares
        rows = rows.withColumn("_salt", F.pmod(F.xxhash64(url_col, html_col), F.lit(SALTS)).cast("int"))
        found = found.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        rows = rows.join(found, ["_host", "_salt"], "left").drop("_host", "_salt")
    schema = StructType([f for f in rows.schema.fields if f.name != "_templates"] + fields)
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            for part in slices(batch, html_col, 2 << 20):
                texts = [main_text(h, frozenset(t or ())) for h, t in zip(part.column(html_col).to_pylist(), part.column("_templates").to_pylist())]
                yield pa.RecordBatch.from_arrays([part.column(f.name) for f in schema.fields[:-2]] + [
                    pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], schema=arrow)

    return rows.mapInArrow(run, schema)
