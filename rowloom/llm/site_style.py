"""Main text of web pages by site style trees.

The pages of a host are merged into one tree. An element is known by the names (tag, classes, id) on its way from the root;
like-named siblings are one element, and text is a child of its own. On each page an element shows one style, the set of
its children. Importance is entropy:

* of presentation: an element that shows many styles over the pages is important, one that always shows the same is not;
* of content: a text is important as far as its pairs of words and the targets of its links are those of few pages; a menu
  whose entries vary, or a footer with a counter, shares nearly all of them and is not;
* composite: with l children on average, ``(1 - g ** l)`` of an element's own importance and ``g ** l`` of its children's,
  each weighted by how often and beside how many others it stands.

A branch is cut from each page if it and everything in it is below ``threshold``. Only distinct pages count, so copies of a page are no evidence, and a
host needs ``MIN_PAGES`` of them. Names that say what a branch is are used as well: named noise (menus, headers, footers,
side bars, notices, adverts, forms, comments) has importance zero, and ``article``, or else ``main``, and the plain blocks
inside it have importance one. Text outside of them goes by the importance of its branch like any other. Only on a host
with too few pages for that do names and sizes decide: there the text outside goes if the page has an article or a main part
(of a main part with more text outside its articles than in them, all stays), unless it has ``PRIOR`` characters more.

The tree is kept as rows (host, element) and weighed from the leaves; a host's tree is never gathered. Each round doubles the
number of levels that an element has gathered from, so any depth is done in a few rounds. A page gets only those cut elements
that it has.

Defined results: a null or empty page gives the empty text. Pages without a usable address share the host "". Repeated
pages give equal rows. A class or id that says noise ('content-sidebar-wrap') is no more than a prior: the name is set aside
on a page whose text is mostly under it (``PRIOR`` characters more than elsewhere; if the whole name says noise, as 'comments'
does, only where elsewhere is less than ``PRIOR`` too), and it does not reach into the page's only article or main part.
If named noise is all that a page has, names are left aside for that page. Broken markup never fails: unknown end tags are skipped, open
elements end with their parents, a tag that is cut off is dropped. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rowloom.llm.common import map_batches, stored

LONG_NAME = 400  # characters of an element's name beyond which its children have a digest in its place
MIN_PAGES = 3
GAMMA = 0.9
THRESHOLD = 0.2
PRIOR = 200  # characters that a name outweighs where the tree has no say

# Element names of HTML by what they mean for text, and words in names, classes and ids that say noise.
INLINE = frozenset(
    """a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small
    span strike strong sub sup time tt u var wbr
    maction math menclose merror mfenced mfrac mi mmultiscripts mn mo mover mpadded mphantom mprescripts mroot mrow ms mspace
    msqrt mstyle msub msubsup msup mtext munder munderover none semantics""".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("annotation annotation-xml iframe noembed noframes noscript script style svg template textarea title xmp".split())
NOISE_TAGS = frozenset("aside audio button canvas dialog fieldset footer form menu nav object select video".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = frozenset(
    """address article aside blockquote center details dialog div dl dd dt fieldset figcaption figure footer form h1 h2 h3
    h4 h5 h6 header hr li main menu nav ol p pre section summary table ul""".split()
)
SIBLINGS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tr": ({"tr", "td", "th"}, {"table", "tbody", "thead", "tfoot"}),
    "option": ({"option"}, {"select"}),
}
PLAIN = frozenset(
    """blockquote body center dd div dl dt figcaption figure h1 h2 h3 h4 h5 h6 header html li ol p pre section table tbody td
    tfoot th thead tr ul""".split()
)
NOISE_ROLES = frozenset("alertdialog banner complementary contentinfo dialog form menu menubar navigation search".split())
NOISE_WORDS = frozenset(
    """ad adbox ads adsense advert advertisement advertising adverts alert alerts banner breadcrumb breadcrumbs captcha comment commentlist
    comments consent cookie cookies copyright disqus footer gdpr login masthead menu menus modal nav navbar navigation
    newsletter notice notices overlay pager pagination popup promo promoted promotion recommended related replies reply
    respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription toast toolbar
    usercomments widget widgets""".split()
)

TOKEN = re.compile(r"<!--(?s:.*?)(?:--!?>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?>[^>=]|=\s*\"[^\"]*\"|=\s*'[^']*'|=)*+)>?|<[!?/][^>]*>?")
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")  # its value is consumed with it
WORDS = re.compile(r"[a-z]+")
DIGITS = re.compile(r"\d+")


def named(tag: str, attributes: str, inside: bool) -> tuple[str, bool, int]:
    """The name of an element, whether its tag, role or style says that it is noise, and whether its class or id does.

    The last is 2 if a whole class or id says so, 1 if one has other words too. ``inside``: in an article.
    """
    noise = tag in NOISE_TAGS or tag == "header" and not inside
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return tag, noise, 0
    marks, says = [], 0
    for kind, *values in ATTRIBUTE.findall(attributes):
        kind, value = kind.lower(), next(filter(None, values), "").lower()
        if kind not in ("class", "id", "role", "style", "hidden", "aria-hidden"):
            continue
        if kind in ("class", "id"):
            # "/" parts the names of a way; a space is in no class or id
            marks += sorted(("#" if kind == "id" else ".") + DIGITS.sub("0", v).replace("/", " ") for v in value.split())
            if tag not in ("html", "body", "main") and not (kind == "id" and tag in HEADINGS):  # there an id is an anchor
                for words in (WORDS.findall(v) for v in value.split() if not re.match(r"(has|with|no|is)[-_]", v)):
                    bad = [w in NOISE_WORDS or w == "header" and not inside for w in words]
                    says = max(says, 2 if bad and all(bad) else 1 if any(bad) else 0)
        elif kind == "role":
            noise |= value in NOISE_ROLES
        elif kind == "style":
            noise |= bool(re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value))
        else:
            noise |= tag not in ("html", "body") and value != "false"
    return tag + "".join(marks), noise, says


def under(parent: str, name: str) -> str:
    """The element of that name in its parent."""
    if len(parent) > LONG_NAME:
        parent = "~" + hashlib.md5(parent.encode("utf-8", "surrogatepass")).hexdigest()
    return f"{parent}/{name}"


class Page:
    """The blocks of a page in order, each with its element, and the children of every element.

    ``blocks`` has (element, text, noise, part, home, inner). Home is 2 in an article, 1 in a main part, 0 elsewhere. The part is
    the innermost element around whose class or id says noise, and inner tells that an article or main part begins inside it.
    """

    def __init__(self, html: str):
        self.blocks: list[tuple[str, str, bool, str, int, bool]] = []
        self.parts: dict[str, tuple[str, bool]] = {}  # the part around each part, and whether a whole name says noise
        self.children: dict[str, set[str]] = {}
        self.places: dict[str, tuple[str, int]] = {}  # parent and depth of each element, from the root down
        self.protected: set[str] = set()
        self.noisy: set[str] = set()
        # (tag, element, depth, noise, part, home, inner, plain) from the root down
        self.stack: list[tuple[str, str, int, bool, str, int, bool, bool]] = [("", "", 0, False, "", 0, False, True)]
        self.held: list[str] = []
        self.targets: list[str] = []  # of the links of the open block
        self.features: dict[str, set[str]] = {}  # pairs of words, and targets of links, of each text
        self.hidden: list[str] = []  # open inline elements that say noise
        at = 0
        while True:
            token = TOKEN.search(html, at)
            if token is None:
                self.text(html[at:])
                break
            if token.start() > at:
                self.text(html[at : token.start()])
            at = token.end()
            tag = (token[2] or "").lower()
            if not tag:
                continue
            if token[1]:
                self.end(tag)
            elif tag in RAW and not token[3].endswith("/"):
                close = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(html, at)
                at = close.end() if close else len(html)
            else:
                self.start(tag, token[3])
        self.flush()

    def text(self, piece: str) -> None:
        if not self.hidden:
            self.held.append(unescape(piece) if "&" in piece else piece)

    def flush(self) -> None:
        """Close the open block."""
        if self.held:
            text = " ".join("".join(self.held).split())
            self.held = []
            if text:
                _, element, depth, noise, part, home, inner, plain = self.stack[-1]
                own = self.place(element, "#text", depth + 1)
                if home and plain:
                    self.protected.add(own)
                self.blocks.append((own, text, noise, part, home, inner))
                words = text.lower().split()
                pairs = [" ".join(p) for p in zip(words, words[1:], strict=False)]
                self.features.setdefault(own, set()).update(pairs or words, self.targets)
            self.targets = []

    def place(self, parent: str, name: str, depth: int) -> str:
        """The element of that name in its parent, noted."""
        element = under(parent, name)
        self.children.setdefault(parent, set()).add(element)
        self.children.setdefault(element, set())
        self.places[element] = (parent, depth)
        return element

    def start(self, tag: str, attributes: str) -> None:
        if tag in INLINE:
            if tag not in VOID and any(named(tag, attributes, bool(self.stack[-1][5]))[1:]):
                self.hidden.append(tag)
            if tag == "a":
                self.targets += [" " + next(filter(None, v), "") for k, *v in ATTRIBUTE.findall(attributes) if k.lower() == "href"]
            return
        self.flush()
        if tag in VOID:
            return
        self.hidden = []
        if tag in CLOSES_P and self.stack[-1][0] == "p":
            self.stack.pop()
        if tag in SIBLINGS:
            same, barrier = SIBLINGS[tag]
            for i in range(len(self.stack) - 1, 0, -1):
                if self.stack[i][0] in barrier:
                    break
                if self.stack[i][0] in same:
                    del self.stack[i:]
                    break
        _, parent, depth, noise, part, home, inner, plain = self.stack[-1]
        name, hard, says = named(tag, attributes, bool(home))
        noise |= hard
        home = max(home, 2 if tag == "article" else 1 if tag == "main" else 0)
        plain = (tag in ("article", "main") or plain and name in PLAIN) and not noise and not says
        element = self.place(parent, name, depth + 1)
        if home and plain:
            self.protected.add(element)
        if noise:
            self.noisy.add(element)
        if says:
            self.parts[element] = (part, says == 2 or bool(part) and self.parts[part][1])
            part, inner = element, False
        else:
            inner |= bool(part) and tag in ("article", "main")
        self.stack.append((tag, element, depth + 1, noise, part, home, inner, plain))

    def end(self, tag: str) -> None:
        if tag in INLINE:
            if tag in self.hidden:
                del self.hidden[self.hidden.index(tag) :]
            return
        self.flush()
        if tag in VOID:
            return
        for i in range(len(self.stack) - 1, 0, -1):
            if self.stack[i][0] == tag:
                del self.stack[i:]
                self.hidden = []
                return

    def main_text(self, cut: frozenset[str], judged: bool = False) -> str:
        """The blocks that are left: without named noise and the cut elements.

        ``judged``: the host has pages enough for its tree to say what is cut. On others an article or a main part decides.
        """
        gone: set[str] = set()
        for element, (parent, _) in self.places.items() if cut else ():
            if element in cut or parent in gone:
                gone.add(element)
        left = [b for b in self.blocks if b[0] not in gone]
        sound = [b for b in left if not b[2]]
        free = self.set_aside(sound)
        alone = not any(b[4] and b[3] in free for b in sound)
        kept = [b for b in sound if b[3] in free or alone and b[5]] or left
        size = [sum(len(b[1]) for b in kept if b[4] == home) for home in range(3)]
        least = 2 if size[2] and size[2] >= size[1] else 1 if size[1] else 0
        if judged and kept is not left or size[0] > size[1] + size[2] + PRIOR:
            least = 0
        return " ".join(b[1] for b in kept if b[4] >= least)

    def asks(self) -> bool:
        """Whether ``judged`` may change the text: there is sound text in an article or main part, and outside."""
        sound = [b for b in self.blocks if not b[2]]
        if not any(b[4] for b in sound):
            return False
        size: dict[str, int] = {}
        for b in sound:
            part = b[3]
            while part:
                size[part] = size.get(part, 0) + len(b[1])
                part = self.parts[part][0]
        return any(not b[4] and (not b[3] or max(size.values()) > PRIOR) for b in sound)

    def set_aside(self, blocks: list[tuple[str, str, bool, str, int, bool]]) -> set[str]:
        """The parts whose names do not hold, as most of the text is there, and "" for no part."""
        size: dict[str, int] = {"": 0}
        for _, text, _, part, _, _ in blocks:
            size[part] = size.get(part, 0) + len(text)
        best: tuple[int, list[str]] = (0, [])
        for part in size:
            way = []
            while part:
                way.append(part)
                part = self.parts[part][0]
            if way and (size[""] < PRIOR or not self.parts[way[0]][1]):
                best = max(best, (sum(size.get(p, 0) for p in way), way))
        return {"", *best[1]} if best[0] > size[""] + PRIOR else {""}


def hashed(feature: str) -> int:
    data = feature.encode("utf-8", "surrogatepass")
    return zlib.crc32(data) | zlib.crc32(data, 77) << 31


def with_host(pages: DataFrame) -> DataFrame:
    """page_id, url, html, host and a hash of the html, by which copies of a page are told."""
    host = F.regexp_extract(F.lower(F.col("url").cast("string")), r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)
    html = F.coalesce(F.col("html").cast("string"), F.lit(""))
    return pages.select("page_id", "url", html.alias("html"), F.coalesce(host, F.lit("")).alias("host"), F.xxhash64(html).alias("page"))


def elements(pages: DataFrame) -> DataFrame:
    """One row for every element of every page: its style, its share among its siblings and the hashes of its features.

    Features of an element whose name decides are not needed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, digests, htmls = (c.to_pylist() for c in batch.columns)
            for first in range(0, len(hosts), 64):
                rows = []
                for host, digest, html in zip(*(x[first : first + 64] for x in (hosts, digests, htmls)), strict=True):
                    page = Page(html)
                    asks = page.asks()
                    for element, (parent, depth) in page.places.items():
                        own = sorted(page.children[element])
                        style = zlib.crc32("\n".join(own).encode("utf-8", "surrogatepass"))
                        named_as = 2 if element in page.protected else 1 if element in page.noisy else 0
                        rows.append(
                            {
                                "host": host,
                                "page": digest,
                                "element": element,
                                "parent": parent,
                                "depth": depth,
                                "style": style,
                                "n_children": len(own),
                                "share": 1 / len(page.children[parent]),
                                "named": named_as,
                                "asks": asks,
                                "features": [] if named_as else sorted(map(hashed, page.features.get(element, ()))),
                            }
                        )
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema=ELEMENTS)

    schema = "host string, page long, element string, parent string, depth int, style long, n_children int,"
    return map_batches(pages.select("host", "page", "html"), run, f"{schema} share double, named int, asks boolean, features array<long>")


ELEMENTS = pa.schema(
    [("host", pa.string()), ("page", pa.int64()), ("element", pa.string()), ("parent", pa.string())]
    + [("depth", pa.int32()), ("style", pa.int64()), ("n_children", pa.int32()), ("share", pa.float64())]
    + [("named", pa.int32()), ("asks", pa.bool_()), ("features", pa.list_(pa.int64()))]
)


def style_tree(found: DataFrame) -> DataFrame:
    """host, element, parent, depth, pages, named, children, share and the own importance of every element of every host."""
    node = ["host", "element"]
    pages = found.dropDuplicates([*node, "page"])
    sizes = pages.groupBy(*node).agg(
        F.count("*").alias("pages"),
        F.min("parent").alias("parent"),
        F.min("depth").alias("depth"),
        F.max("named").alias("named"),
        F.avg("n_children").alias("children"),
        F.sum("share").alias("shares"),
    )
    styles = pages.groupBy(*node, "style").agg(F.count("*").alias("c"))
    styles = styles.groupBy(*node).agg(F.sum(F.col("c") * F.ln("c")).alias("c_ln_c"))
    shown = pages.select(*node, F.explode("features").alias("feature")).groupBy(*node, "feature").agg(F.count("*").alias("c"))
    shown = shown.groupBy(*node).agg((F.sum(F.col("c") * F.ln("c")) / F.sum("c")).alias("ln_c"))  # as often as pages show it
    tree = sizes.join(styles, node).join(shown, node, "left")
    logs, m = F.ln("pages"), F.col("pages")
    presentation = F.when(m <= 1, 1.0).otherwise((logs - F.col("c_ln_c") / m) / logs)  # the entropy to the base of pages
    content = F.when(m <= 1, 1.0).otherwise(1 - F.col("ln_c") / logs)
    own = F.when(F.col("ln_c").isNotNull(), content).otherwise(presentation)
    above = sizes.select("host", F.col("element").alias("parent"), F.col("pages").alias("parent_pages"))
    tree = tree.withColumn("own", own).join(above, ["host", "parent"], "left")
    share = F.col("shares") / F.coalesce("parent_pages", "pages")
    return tree.select(*node, "parent", "depth", "pages", "named", "children", share.alias("share"), "own")


def cut_elements(tree: DataFrame, threshold: float, gamma: float, min_pages: int) -> DataFrame:
    """host and element of every branch that is below the threshold with all that is in it.

    An element's importance is ``own + part * sum(share * importance of the child)``, so it is the sum of the ``own`` of all
    that is in it, each times the weights on the way up. Round k adds what stands 2 ** k levels below.
    """
    deepest = tree.agg(F.max("depth")).first()[0] or 0
    named, leaf = F.col("named"), F.col("children") == 0
    part = F.when((named > 0) | leaf, 0.0).otherwise(F.pow(F.lit(gamma), F.col("children")))
    own = F.when(named == 1, 0.0).when(named == 2, 1.0).otherwise((1 - F.col("part")) * F.col("own"))
    key, above = F.xxhash64("element").alias("id"), F.when(F.col("depth") > 1, F.xxhash64("parent")).alias("up")
    text = F.col("element").endswith("/#text").alias("texts")
    state = stored(tree.withColumn("part", part).select("host", key, above, "part", "share", own.alias("own"), text), "style-weights")
    parents = state.select("host", F.col("id").alias("up"), F.col("part").alias("up_part"))
    weight = F.coalesce(F.col("share") * F.col("up_part"), F.lit(0.0)).alias("weight")
    state = state.join(parents, ["host", "up"], "left").select("host", "id", "up", "own", "texts", weight)
    rounds = []
    while 2 ** len(rounds) < deepest:  # at most 17 for a page of 100,000 elements in each other
        state = stored(state, "style-round")
        rounds.append(state.select("host", "id", "up"))
        below = state.filter("up IS NOT NULL").groupBy("host", F.col("up").alias("id"))
        below = below.agg(F.sum(F.col("weight") * F.col("own")).alias("inner"), F.max("texts").alias("inner_texts"))
        higher = state.select("host", F.col("id").alias("up"), F.col("up").alias("next"), F.col("weight").alias("more"))
        state = state.join(below, ["host", "id"], "left").join(higher, ["host", "up"], "left").select(
            "host",
            "id",
            F.col("next").alias("up"),
            (F.col("own") + F.coalesce("inner", F.lit(0.0))).alias("own"),
            (F.col("texts") | F.coalesce("inner_texts", F.lit(False))).alias("texts"),
            (F.col("weight") * F.coalesce("more", F.lit(0.0))).alias("weight"),
        )
    best = state.select("host", "id", F.col("own").alias("best"), "texts")
    for ups in rounds:
        best = stored(best, "style-best")
        below = best.select("host", "id", "best").join(ups.filter("up IS NOT NULL"), ["host", "id"])
        below = below.groupBy("host", F.col("up").alias("id")).agg(F.max("best").alias("inner"))
        best = best.join(below, ["host", "id"], "left").withColumn("best", F.greatest("best", "inner")).drop("inner")
    low = best.filter((F.col("best") < threshold) & F.col("texts")).select("host", "id")
    free = tree.filter((F.col("pages") >= min_pages) & (named == 0)).select("host", "element", key)
    return free.join(low, ["host", "id"]).select("host", "element")


def main_texts(
    pages: DataFrame, threshold: float = THRESHOLD, gamma: float = GAMMA, min_pages: int = MIN_PAGES
) -> DataFrame:
    """page_id, url, text and n_chars of every page."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            htmls, cuts, judged = (c.to_pylist() for c in batch.columns[2:])
            found = [Page(h).main_text(frozenset(c or ()), j is True) for h, c, j in zip(htmls, cuts, judged, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.string())], names=names)

    names = ["page_id", "url", "text"]
    keyed = with_host(pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html"))
    found = stored(elements(keyed), "style-elements")
    tree = stored(style_tree(found), "style-tree")
    cut = cut_elements(tree, threshold, gamma, min_pages)
    tops = tree.filter((F.col("depth") == 1) & (F.col("pages") >= min_pages)).select("host", "element")
    cuts = found.select("host", "page", "element").join(cut, ["host", "element"])  # only elements that the page has
    tops = found.filter("asks AND depth = 1").select("host", "page", "element").join(tops, ["host", "element"])
    told = cuts.unionByName(tops.withColumn("element", F.lit(None).cast("string"))).groupBy("host", "page")
    own = told.agg(F.collect_set("element").alias("cut"), F.max(F.col("element").isNull()).alias("judged"))
    own = stored(own, "style-cuts")
    joined = keyed.join(own, ["host", "page"], "left").select("page_id", "url", "html", "cut", "judged")
    texts = map_batches(joined, run, "page_id long, url string, text string")
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
