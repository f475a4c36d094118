"""The main text of web pages, with what a site repeats on its pages taken out.

Every page becomes a tree whose subtrees have hashes. Spark counts, per host, on how many different pages each subtree
stands; one that recurs on many pages of its host is site template and is deleted, with all that lies in it. Parts
that by their element or class are never main text (menus, adverts, forms, scripts, reader comments ...) go too. Inside
an article or main element a subtree counts once for every different article, and what authors quote stays: headings,
quotations, lines, cells and plain paragraphs are no template there by themselves.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_left
from collections.abc import Collection
from html import unescape
from html.parser import HTMLParser
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from meterdw.llm.common import BROADCAST_BYTES, mapped, small, staged, text_slices

# a subtree is template when it stands on this many different pages of its host, and on the square root of their number:
# a fifth of 25 pages, a tenth of 100, a hundredth of 10,000
LEAST_PAGES = 5
# rows of a host that share one copy of its template where the templates are not broadcast
ROWS_A_COPY = 10_000

# fixed values: elements of HTML by what they are
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NEVER = frozenset("""head script style noscript template title nav footer aside form button select option textarea
    input label iframe object svg canvas audio video map dialog menu""".split())
INLINE = frozenset("""a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q s samp small span
    strike strong sub sup time tt u var wbr""".split())
CLOSES_PARAGRAPH = frozenset("""address article aside blockquote details div dl fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul""".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
            "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table select div article section main body html".split())
MAIN = frozenset({"article", "main"})
HEADINGS = frozenset({"h1", "h2", "h3"})
# inside main text: what quotes hold, with all that lies in it, and what is template only with what lies around it
QUOTING = frozenset({"blockquote", "pre"})
LINES = frozenset("h1 h2 h3 h4 h5 h6 li dt dd td th tr thead tbody tfoot caption figcaption".split()) | INLINE
# parts the hashes of subtrees inside main text from those outside
INSIDE = 0x5BD1E9955BD1E995
# fixed values: words in class, id and role that name what is not main text
APART = frozenset("""ad ads advert adverts advertisement advertising adsense banner breadcrumb breadcrumbs comment
    comments disqus respond reply replies cookie cookies consent gdpr notice notices popup modal overlay newsletter
    subscribe subscription signup login promo promotion sponsor sponsored share sharing social related recommended
    adsbygoogle sidebar side widget menu menus nav navbar navigation topbar footer footnav masthead skip pagination pager toolbar
    search searchbox complementary contentinfo alert""".split())
# of these, what an article element may be too
FOREIGN = frozenset("""ad ads advert advertisement comment comments reply replies related recommended promo sponsored
    """.split())
# of these, what main text does not stand in where the page has any other text
COMMENTS = frozenset("comment comments disqus respond reply replies".split())
HEADER = frozenset({"header", "pageheader", "siteheader"})
# words that a name of such a part may have besides; with any other word (has-sidebar, ad-free) it names no such part
BESIDE = frozenset("""area bar block body bottom box button buttons card center container content global google group
    holder icons info inner item items law left link links list main message outer page panel post posts primary reader
    readers right row secondary section site slot text thread toggle top unit user users wrap wrapper x""".split())
# of these, what names main text where a side is named too: content-side, sidebar-page
PLACES = frozenset("body content main page panel post posts primary section text".split())
SIDES = frozenset({"side", "sidebar"})
HIDDEN = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*hidden)", re.I)
# what a head may hold; anything else ends it
IN_HEAD = frozenset("base basefont bgsound link meta noscript script style template title".split())
# where a comment ends, counted from the first - of its beginning: <!--> and <!---> are whole comments
COMMENT_END = re.compile(r"--?->|--.*?--!?>", re.S)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")


class Node:
    __slots__ = ("tag", "apart", "header", "plain", "named", "children", "digest", "main", "quoted")

    def __init__(self, tag: str, apart: bool = False, header: bool = False, plain: bool = True,
                 named: frozenset[str] = frozenset()):
        # named: the words by which the element is named apart
        self.tag, self.apart, self.header, self.plain, self.named, self.children = tag, apart, header, plain, named, []
        # main: the outermost article or main element around the node
        self.digest, self.main, self.quoted = b"", None, False


class Tree(HTMLParser):
    """Builds the tree; end tags that HTML lets one leave out are put in, stray ones are passed over."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("html")
        self.open = [self.root]
        self.names = {"html": 1}
        self.in_comment = False

    def _close(self, depth: int) -> None:
        for node in self.open[depth:]:
            self.names[node.tag] -= 1
        del self.open[depth:]

    def _close_one(self, tags, scopes) -> None:
        if not any(self.names.get(tag) for tag in tags):
            return
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag in tags:
                self._close(depth)
                return
            if self.open[depth].tag in scopes:
                return

    def handle_starttag(self, tag, attrs):
        if tag == "body" or (self.open[-1].tag == "head" and tag not in IN_HEAD):
            self._close_head()
        if tag in ("html", "body"):
            return
        if tag in CLOSES_PARAGRAPH:
            self._close_one({"p"}, SCOPES | {"td", "th", "li", "button"})
        if tag in SIBLINGS:
            self._close_one(SIBLINGS[tag], SCOPES - {"div", "section", "article"} if tag != "li" else SCOPES)
        hidden, header, named = self._named(tag, attrs)
        node = Node(tag, tag in NEVER or hidden, header or tag == "header", not attrs, named)
        self.open[-1].children.append(node)
        if tag not in VOID:
            self.open.append(node)
            self.names[tag] = self.names.get(tag, 0) + 1

    def _close_head(self) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == "head":
                self._close(depth)
                return

    def _named(self, tag, attrs) -> tuple[bool, bool, frozenset[str]]:
        """Whether the element is hidden, whether its attributes name a header, and the words that name it apart.

        Names are compared whole: all words of one must be known.
        """
        apart, header, named = FOREIGN if tag in MAIN else APART, False, set()
        for name, value in attrs:
            if name in ("class", "id", "role") and value:
                for token in value.split():
                    listed = [w.lower() for w in WORDS.findall(token)]
                    words = set(listed)
                    # the last word says what it is: page-sidebar is a side, sidebar-page a page
                    beside = BESIDE - PLACES if words & SIDES and listed[-1] != "sidebar" else BESIDE
                    if words & apart and all(
                            w in apart or w in beside or w in HEADER or w.isdigit() for w in words):
                        named |= words & apart
                    header |= bool(words & HEADER and tag not in MAIN and all(
                        w in BESIDE - {"post"} or w in HEADER or w in APART or w.isdigit() for w in words))
            if name == "hidden" or (name == "aria-hidden" and value == "true") or (
                    name == "style" and value and HIDDEN.search(value)):
                return True, False, frozenset()
        return False, header, frozenset(named)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID and self.open[-1].tag == tag and len(self.open) > 1:
            self._close(len(self.open) - 1)

    def handle_endtag(self, tag):
        if self.names.get(tag) and tag not in ("html", "body"):
            for depth in range(len(self.open) - 1, 0, -1):
                if self.open[depth].tag == tag:
                    self._close(depth)
                    return

    def handle_data(self, data):
        if self.open[-1].tag == "head" and not data.isspace():
            self._close_head()
        self.open[-1].children.append(data)

    def parse_comment(self, i, report=1):
        """A comment without an end goes on to the end of the page."""
        end = COMMENT_END.match(self.rawdata, i + 2)
        self.in_comment = end is None
        return end.end() if end else len(self.rawdata)

    def parse_marked_section(self, i, report=1):
        """A marked section is a comment in HTML, whatever its word: CDATA ends at ]]>, all others at the next >."""
        end = "]]>" if self.rawdata.startswith("<![CDATA[", i) else ">"
        at = self.rawdata.find(end, i + 3)
        return at + len(end) if at >= 0 else -1


def parse(html: str) -> Node:
    # no markup ends behind the last >: what follows is text, and need not be searched for ends again and again
    last = html.rfind(">") + 1
    tree = Tree()
    tree.feed(html[:last])
    tree.close()
    if last < len(html) and not tree.in_comment:
        tree.handle_data(unescape(html[last:]))
    return tree.root


def preorder(root: Node) -> list[Node]:
    out, stack = [], [root]
    while stack:
        node = stack.pop()
        out.append(node)
        stack += [c for c in reversed(node.children) if isinstance(c, Node)]
    return out


def _has_text(root: Node) -> bool:
    """Whether text stands outside everything that is set apart or named so."""
    stack = [root]
    while stack:
        node = stack.pop()
        if not (node.apart or node.named or node.header):
            if any(not isinstance(c, Node) and not c.isspace() for c in node.children):
                return True
            stack += [c for c in node.children if isinstance(c, Node)]
    return False


def _set_apart(root: Node, nodes: list[Node]) -> set[int]:
    """Settles which elements with a name for what is not main text are set apart. Returns the nodes with main text."""
    holding: set[int] = set()
    for node in reversed(nodes):
        if not (node.apart or (node.tag in MAIN and node.named)) and (node.tag in MAIN or any(
                isinstance(c, Node) and id(c) in holding for c in node.children)):
            holding.add(id(node))
    elsewhere, stack = False, [root]
    while stack and not elsewhere:
        node = stack.pop()
        if not node.named & FOREIGN and id(node) in holding:
            elsewhere = node.tag in MAIN
            stack += [c for c in node.children if isinstance(c, Node)]
    # where a page has other text, what is named for comments holds the readers' ones, be they articles or not
    told = any(n.named & COMMENTS and id(n) in holding for n in nodes) and _has_text(root)
    for node in nodes:
        if node.named and (node.tag in MAIN or id(node) not in holding or (told and node.named & COMMENTS)
                           or (elsewhere and node.named & FOREIGN)):
            node.apart = True
    return holding


def hashed(root: Node) -> list[Node]:
    """All nodes from the top, with digests of their subtrees (element, text and children), and what main text is.

    A header without heading or main text is set apart: with a heading, the counts decide. What a name sets apart stays
    if it holds an article or main element, such as a page with its sidebar; under a name for foreign text (FOREIGN),
    only if the page has no such element elsewhere.
    """
    nodes = preorder(root)
    holding = _set_apart(root, nodes)
    headed: set[int] = set()
    for node in reversed(nodes):
        inner = [c for c in node.children if isinstance(c, Node)]
        node.digest = hashlib.blake2b(b"\0".join(
            [node.tag.encode(), *(c.digest if isinstance(c, Node) else " ".join(c.split()).encode("utf-8", "replace")
                                  for c in node.children)]), digest_size=8).digest()
        if node.tag in HEADINGS or any(id(c) in headed for c in inner):
            headed.add(id(node))
        elif node.header and id(node) not in holding:
            node.apart = True
    for node in nodes:
        for child in node.children:
            if isinstance(child, Node):
                child.main = node.main or (node if node.tag in MAIN else None)
                child.quoted = node.quoted or node.tag in QUOTING
    return nodes


def number(digest: bytes) -> int:
    return int.from_bytes(digest, "little", signed=True)


def name_of(node: Node) -> int:
    """The hash under which the host counts the subtree: inside main text another than outside."""
    return number(node.digest) ^ INSIDE if node.main else number(node.digest)


def countable(node: Node) -> bool:
    """Whether the subtree may be template by itself: outside main text any, inside it not what quotes are made of."""
    if node.apart or node.tag in VOID or not node.children:
        return False
    return not node.main or not (node.quoted or node.tag in QUOTING or node.tag in LINES
                                 or node.tag == "p" and node.plain)


def candidates(root: Node) -> list[tuple[int, int]]:
    """Hashes of the subtrees that may be template, each with that of the page or the article that it is counted for.

    None holds an article or main element.
    """
    nodes = hashed(root)
    holds_main: set[int] = set()
    for node in reversed(nodes):
        if node.tag in MAIN or any(isinstance(c, Node) and id(c) in holds_main for c in node.children):
            holds_main.add(id(node))
    return sorted({(name_of(n), number((n.main or root).digest))
                   for n in nodes[1:] if id(n) not in holds_main and countable(n)})


def blocks(root: Node, template: Collection[int]) -> list[str]:
    """The text of the blocks that remain, in page order; white space is one blank, empty blocks are left out."""
    hashed(root)
    out: list[str] = []
    words: list[str] = []

    def end():
        if text := " ".join("".join(words).split()):
            out.append(text)
        words.clear()

    stack: list = [root]
    while stack:
        item = stack.pop()
        if item is None:
            end()
        elif isinstance(item, str):
            words.append(item)
        elif item.apart:
            if item.tag not in INLINE:
                end()
        elif template and countable(item) and name_of(item) in template:
            end()
        else:
            if item.tag not in INLINE:
                end()
                stack.append(None)
            stack += reversed(item.children)
    end()
    return out


def _host(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def templates(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """host and sorted hashes of its template subtrees (an array per host, one host a row).

    A page counts once however often its html recurs on the host, and inside main text an article or main element
    counts once, on however many pages it stands. Every task adds up its own pages before the shuffle.
    """

    def run(batches):
        for batch in text_slices(batches, "html"):
            hosts, found, pages_seen = [], [], []
            for address, page in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
                root = parse(page or "")
                listed = candidates(root)
                host, name = _host(address), number(root.digest)
                hosts += [host] * (len(listed) + 1)
                found += [None, *(subtree for subtree, _ in listed)]
                pages_seen += [name, *(counted for _, counted in listed)]
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(found, pa.int64()),
                                              pa.array(pages_seen, pa.int64())], ["host", "subtree", "page"])

    rows = mapped(pages.select(F.col(url).cast("string").alias("url"), F.col(html).alias("html")), run,
                  "host string, subtree bigint, page bigint")
    counts = staged(rows.distinct().groupBy("host", "subtree").agg(F.count(F.lit(1)).alias("pages")), "subtrees")
    whole = counts.where("subtree is null").select("host", F.col("pages").alias("of_host"))
    often = counts.where("subtree is not null").where(F.col("pages") >= LEAST_PAGES)
    return (often.join(small(whole, 64), "host").where(F.col("pages") >= F.sqrt("of_host"))
            .groupBy("host").agg(F.sort_array(F.collect_list("subtree")).alias("template")))


class Template:
    """The sorted hashes of a host's template, as Arrow holds them."""

    def __init__(self, hashes: pa.Array):
        self.hashes = hashes.to_numpy(zero_copy_only=False)

    def __len__(self):
        return len(self.hashes)

    def __contains__(self, name: int) -> bool:
        at = bisect_left(self.hashes, name)
        return at < len(self.hashes) and self.hashes[at] == name


def _read(batch: pa.RecordBatch, templates: list) -> pa.RecordBatch:
    """key, url, text, n_chars of the pages of a batch, each without the template given for it."""
    out = [" ".join(blocks(parse(page or ""), template))
           for page, template in zip(batch.column("html").to_pylist(), templates)]
    return pa.RecordBatch.from_arrays([batch.column("key"), batch.column("url"), pa.array(out, pa.string()),
                                       pa.array([len(t) for t in out], pa.int64())], ["key", "url", "text", "n_chars"])


def _with_sent(rows: DataFrame, found: DataFrame, schema: str) -> DataFrame:
    """The texts, with all templates sent once to every executor; the caller has measured that they are small."""
    sent = rows.sparkSession.sparkContext.broadcast(found.toArrow())

    def run(batches):
        table = sent.value.combine_chunks()
        of_host = {}
        for piece in table.to_batches():
            hashes = piece.column("template")
            of_host |= {host: Template(hashes[i].values) for i, host in enumerate(piece.column("host").to_pylist())}
        for batch in text_slices(batches, "html"):
            yield _read(batch, [of_host.get(_host(u), ()) for u in batch.column("address").to_pylist()])

    return mapped(rows, run, schema)


def _with_copies(rows: DataFrame, found: DataFrame, schema: str, kinds: dict[str, str]) -> DataFrame:
    """The texts, with the template of a host before every 10,000 rows of it, so that no row carries an array.

    The rows of a host are cut into as many parts as that takes, whatever its share of the table.
    """

    def hosts(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([_host(u) for u in batch.column("address").to_pylist()], pa.string())],
                [*batch.schema.names, "host"])

    def run(batches):
        held, template = None, ()
        for batch in text_slices(batches, "html"):
            parts = zip(batch.column("host").to_pylist(), batch.column("part").to_pylist())
            arrays, chosen = batch.column("template"), []
            for i, part in enumerate(parts):
                if part != held:
                    held, template = part, ()
                if arrays[i].is_valid:
                    template = Template(arrays[i].values)
                chosen.append(template)
            pages = arrays.is_null()
            yield _read(batch.filter(pages), [t for t, page in zip(chosen, pages.to_pylist()) if page])

    named = mapped(rows, hosts, f"key {kinds['key']}, url {kinds['url']}, address string, html string, host string")
    counted = mapped(rows.select("address"), hosts, "address string, host string").groupBy("host").agg(
        F.ceil(F.count(F.lit(1)) / ROWS_A_COPY).cast("long").alias("parts"))
    copies = staged(found.join(counted, "host"), "template-parts")
    parts = copies.select("host", "parts")
    # beyond the broadcast limit there are many hosts; a hot one is no matter to a join whose other side is one row
    cut = (named.withColumn("turn", F.monotonically_increasing_id()).join(small(parts, 64), "host", "left")
           .withColumn("part", F.expr("pmod(xxhash64(turn), coalesce(parts, 1))")))
    first = copies.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)))
    return mapped(cut.select("key", "url", "html", "host", "part")
                  .unionByName(first.select("host", "part", "template"), allowMissingColumns=True)
                  .repartition("host", "part")
                  .sortWithinPartitions("host", "part", F.col("template").isNull()), run, schema)


def main_text(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html",
              limit_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """key, url, text, n_chars of every row.

    Null and empty pages, and pages of nothing but template, have an empty text. Pages with a null or broken address
    are of one host without a name. Rows with equal pages are counted once for the template and all returned. An empty
    table gives no rows. Other columns are not read.

    A host of n pages has at most sqrt(n) times as many templates as a page has subtrees (each stands on sqrt(n) pages
    or more). Up to `limit_bytes` all templates are sent once to every executor; beyond, the rows are shuffled by host in
    parts of 10,000 and every part begins with its template.
    """
    kinds = {"key": pages.schema[key].dataType.simpleString(), "url": pages.schema[url].dataType.simpleString()}
    found = staged(templates(pages, url, html), "templates")
    rows = pages.select(F.col(key).alias("key"), F.col(url).alias("url"), F.col(url).cast("string").alias("address"),
                        F.col(html).alias("html"))
    schema = f"key {kinds['key']}, url {kinds['url']}, text string, n_chars bigint"
    size = found.agg(F.sum(F.size("template") * 8 + F.octet_length("host") + 128)).first()[0] or 0
    out = _with_sent(rows, found, schema) if size <= limit_bytes else _with_copies(rows, found, schema, kinds)
    return out.withColumnsRenamed({"key": key, "url": url})
