"""Main text of web pages by wrapper induction: same-host trees are aligned, what stays constant is template."""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docksense.session import cut_lineage

#: A text is constant in a slot if at least this share of a host's different pages that have the slot show it there, and
#: there are at least two to compare. Pages with one main text, or with one longest text that varies, count once, so exact
#: and near copies of an article do not make it a template.
CONSTANT_SHARE = 0.9
LEAST_PAGES = 2
#: A constant text among others that vary, in a slot that a page shows several texts in, may be a sentence that pages share by
#: chance; it is template if so many pages are there to compare.
LEAST_SHARING = 5
#: Elements nested deeper are taken as children of the one at this depth.
MAX_DEPTH = 150
OUTLINE = "skeleton string, n int, nodes array<int>, texts array<long>, sizes array<int>, homes array<int>, main long"

VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
RAW = {"script", "style", "title", "textarea", "noscript", "template", "iframe", "svg", "math", "object", "noframes"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "mark", "q", "ruby", "rb", "rt", "rp", "s", "samp", "small", "span", "strike", "strong", "sub", "sup",
          "time", "tt", "u", "var", "wbr", "br", "img", "nobr"}
#: Elements that an open one of the same kind (or of the listed kinds) ends at.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
#: An open paragraph does not end through these.
SCOPES = {"html", "body", "article", "main", "section", "div", "td", "th", "li", "blockquote", "aside", "nav", "header",
          "footer", "form", "table", "ul", "ol", "dl", "figure", "button", "dd", "caption"}
#: Elements and roles that are never main text, and words of a class or id that speak against it.
NOT_MAIN = {"head", "nav", "footer", "aside", "form", "menu", "button", "select", "dialog", "input"}
NOT_MAIN_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "dialog", "menu"}
NOT_MAIN_WORDS = {
    "ad", "ads", "adsense", "advert", "advertisement", "adverts", "advertising", "alert", "aside", "banner", "breadcrumb",
    "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "copyright", "disqus", "footer", "gdpr", "header",
    "login", "masthead", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "notices", "overlay",
    "pager", "pagination", "popup", "promo", "recommended", "related", "replies", "respond", "search", "share", "sharing",
    "sidebar", "signup", "skip", "social", "sponsor", "sponsored", "subscribe", "tags", "toolbar", "topbar", "widget",
}
#: Of these, what readers write: the words hold however much text there is.
READERS = {"comment", "comments", "disqus", "replies", "respond"}
#: With one of these beside it, a word names what is laid out in an element, and "header" that of the text.
LAYOUT = {"body", "container", "content", "inner", "layout", "main", "page", "wrap", "wrapper"}
HEADED = {"article", "content", "entry", "headline", "page", "post", "story", "title"}
#: First words of a class name that tells what an element has, not what it is.
STATES = {"has", "hide", "no", "with", "without"}
#: The attributes that are read.
ATTRIBUTES = {"class", "id", "role", "hidden", "aria-hidden", "itemprop"}
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>"
    r"|<[!?/][^>]*+(?:>|\Z)|<[a-zA-Z][^>]*+\Z", re.S)
#: One attribute: name, then a quoted (to the end, if the quote stays open) or bare value, or none.
_ATTRIBUTE = re.compile(r"([^\s/>=]++)(?:\s*+=\s*+(?:\"([^\"]*+)\"?|'([^']*+)'?|([^\s>]++)))?")
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>?", re.I) for name in RAW}


class Page:
    """Blocks of text with their place in the page's skeleton.

    The skeleton is the tree of block elements; siblings with one label (name, first class word without digits) are one
    node. ``labels`` and ``parents`` list its nodes in order of appearance. A block is (node, text, elements around it);
    of these only articles and doubtful elements count, those whose class or id has a word of NOT_MAIN_WORDS. ``kinds``
    holds the kind of each (article, layout, readers or other), ``places`` its node.
    """

    def __init__(self, source: str) -> None:
        self.labels, self.parents = [""], [-1]
        self.index: dict[tuple[int, str], int] = {}
        self.blocks: list[tuple[int, str, tuple[int, ...]]] = []
        self.kinds: list[str] = []
        self.places: list[int] = []
        self._parse(source)

    def _node(self, parent: int, label: str) -> int:
        key = (parent, label)
        node = self.index.get(key)
        if node is None:
            node = self.index[key] = len(self.labels)
            self.labels.append(label)
            self.parents.append(parent)
        return node

    def _flush(self, text: list[str], stack: list[tuple[str, int, bool, tuple[int, ...]]]) -> None:
        if text:
            block = " ".join(html.unescape("".join(text)).split())
            text.clear()
            _, node, main, around = stack[-1]
            if block and main:
                self.blocks.append((node, block, around))

    def _parse(self, source: str) -> None:
        # (name, skeleton node, may be main text, articles and doubtful elements); inline elements are not on the stack
        stack: list[tuple[str, int, bool, tuple[int, ...]]] = [("", 0, True, ())]
        hidden: list[tuple[str, int]] = []  # open inline elements that are not main text: name, depth
        text: list[str] = []
        at, end = 0, len(source)
        while at < end:
            m = _TOKEN.search(source, at)
            if m is None:
                if not hidden:
                    text.append(source[at:])
                break
            if m.start() > at and not hidden:
                text.append(source[at:m.start()])
            at = m.end()
            closing, name, attributes = (m[1], m[2], m[3]) if m[2] else (m[4], m[5], m[6])
            if not name:
                continue
            name = name.lower()
            if closing:
                if name in INLINE:
                    if hidden and hidden[-1][0] == name:
                        hidden.pop()
                    continue
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] == name:
                        self._flush(text, stack)
                        del stack[depth:]
                        hidden = [h for h in hidden if h[1] <= depth]
                        break
                continue
            if name in RAW:
                if not attributes.endswith("/"):
                    stop = _RAW_END[name].search(source, at)
                    at = stop.end() if stop else end
                if name not in INLINE:
                    self._flush(text, stack)
                continue
            if name in INLINE:
                if name == "br":
                    text.append(" ")
                elif name not in VOID and (hidden and hidden[-1][0] == name or self._speaks_against(name, attributes)):
                    hidden.append((name, len(stack)))
                continue
            self._flush(text, stack)
            self._end_open(name, stack)
            hidden = [h for h in hidden if h[1] <= len(stack)]
            if name in VOID:
                continue
            word, out, article, doubt = self._role(name, attributes)
            _, parent, main, around = stack[-1]
            inside = any(self.kinds[i] == "article" for i in around)
            if name == "header" and inside:
                out = False
            if name in ("html", "body", "article", "main"):
                # a reader's article among those of readers is not the page's
                own = doubt == "readers" and any(self.kinds[i] == "readers" for i in around)
                out, doubt, article = False, "readers" if own else "", article and not own
            if doubt == "header":
                doubt = "" if inside else "other"
            node = parent if len(stack) > MAX_DEPTH else self._node(parent, name + word)
            for kind in (doubt, "article" if article else ""):
                if kind and main and not out:
                    around = (*around, len(self.kinds))
                    self.kinds.append(kind)
                    self.places.append(node)
            stack.append((name, node, main and not out, around))
        self._flush(text, stack)

    @staticmethod
    def _end_open(name: str, stack: list[tuple[str, int, bool, tuple[int, ...]]]) -> None:
        ends = CLOSES.get(name)
        if ends:
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth][0] in ends:
                    del stack[depth:]
                    return
                if stack[depth][0] in ("ul", "ol", "dl", "table", "select"):
                    return
            return
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth][0] == "p":
                del stack[depth:]
                return
            if stack[depth][0] in SCOPES:
                return

    @staticmethod
    def _doubt(value: str) -> str:
        """What a class or id says against an element: readers, other, header, layout, or nothing; the first that holds."""
        found = set()
        for name in value.split():
            words = re.findall("[a-z]+", name)
            against = NOT_MAIN_WORDS.intersection(words)
            if not against or words[0] in STATES:
                continue
            if not READERS.isdisjoint(against):
                found.add("readers")
            elif against == {"header"}:
                found.add("" if not HEADED.isdisjoint(words) else "header")
            else:
                found.add("layout" if not LAYOUT.isdisjoint(words) else "other")
        return next((x for x in ("readers", "other", "header", "layout") if x in found), "")

    @classmethod
    def _role(cls, name: str, attributes: str) -> tuple[str, bool, bool, str]:
        """Label's second part, whether the element is no main text, whether it is an article, what its names say."""
        out, article, label, names = name in NOT_MAIN or name == "header", name in ("article", "main"), "", []
        if attributes:
            for m in _ATTRIBUTE.finditer(attributes):
                key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
                if key not in ATTRIBUTES:
                    continue
                if key == "role":
                    out |= value in NOT_MAIN_ROLES
                    article |= value in ("main", "article")
                elif key == "itemprop":
                    article |= value == "articlebody"
                    out |= value == "comment"
                elif key == "hidden":
                    out = True
                elif key == "aria-hidden":
                    out |= value == "true"
                else:
                    names.append(value)
                    words = re.findall("[a-z]+", value)
                    if key == "class" and words and not label:
                        label = "." + words[0]
        return label, out, article, cls._doubt(" ".join(names)) if names else ""

    @classmethod
    def _speaks_against(cls, name: str, attributes: str) -> bool:
        """Whether an inline element is no main text."""
        _, out, _, doubt = cls._role(name, attributes)
        return out or doubt != ""

    def home(self, around: tuple[int, ...]) -> int:
        """Node of the outermost article around a block, -1 without one."""
        return next((self.places[i] for i in around if self.kinds[i] == "article"), -1)

    def skeleton(self) -> str:
        """Label and parent of each node, a line each."""
        return "\n".join(f"{p} {x}" for p, x in zip(self.parents[1:], self.labels[1:]))

    def candidates(self, blocks: list[tuple[int, str, tuple[int, ...]]] | None = None) -> list[tuple[int, str]]:
        """Those of the blocks (all, if none are given) that are main text by their place and share of the text.

        The article is the outermost one with most text, of those outside of readers' elements if there are any, and counts
        if it holds at least as much text as lies outside of articles and doubtful elements. Then only articles are main
        text, and doubtful elements around the article or around half of it are none. Without one, doubtful elements around
        half of the text are none. Readers' elements are only cleared around the article.
        """
        blocks = self.blocks if blocks is None else blocks
        kinds = self.kinds
        if not kinds:
            return [(n, t) for n, t, _ in blocks]
        articles: Counter[int] = Counter()
        free = 0
        for _, text, around in blocks:
            first = next((i for i in around if kinds[i] == "article"), None)
            if first is not None:
                articles[first] += len(text)
            elif all(kinds[i] == "layout" for i in around):
                free += len(text)
        over = {i: around[:around.index(i)] for _, _, around in blocks for i in around if i in articles}
        clean = [i for i in articles if all(kinds[j] != "readers" for j in over[i])]
        best = max(clean or articles, key=lambda i: articles[i], default=None)
        if best is not None and articles[best] >= free:
            core = [b for b in blocks if best in b[2]]
            cleared = set(over[best])
            own = [b for b in blocks if any(kinds[i] == "article" for i in b[2])]
        else:
            own = core = [b for b in blocks if all(kinds[i] != "readers" for i in b[2])]
            cleared = set()
        held: Counter[int] = Counter()
        for _, text, around in core:
            for i in around:
                held[i] += len(text)
        half = sum(len(t) for _, t, _ in core) / 2
        cleared.update(i for i, n in held.items() if n >= half and kinds[i] != "readers")
        return [(n, t) for n, t, around in own if all(kinds[i] == "article" or i in cleared for i in around)]


def _tree(skeleton: str) -> tuple[list[str], list[list[int]]]:
    labels, children = [""], [[]]
    for i, line in enumerate(skeleton.split("\n") if skeleton else [], 1):
        parent, _, label = line.partition(" ")
        labels.append(label)
        children.append([])
        children[int(parent)].append(i)
    return labels, children


def simple_tree_matching(a: str, b: str) -> dict[int, int]:
    """Largest order-preserving matching of two skeletons: node of ``a`` -> node of ``b``.

    Two nodes match if their labels and their parents do; a pair's weight is one more than that of the best matching of
    their child sequences, found by dynamic programming.
    """
    la, ca = _tree(a)
    lb, cb = _tree(b)

    def weigh(i: int, j: int) -> tuple[int, list[tuple[int, int]]]:
        if la[i] != lb[j]:
            return 0, []
        x, y = ca[i], cb[j]
        best = [[(0, None)] * (len(y) + 1) for _ in range(len(x) + 1)]
        for p in range(1, len(x) + 1):
            for q in range(1, len(y) + 1):
                up, left = best[p - 1][q][0], best[p][q - 1][0]
                choice = (up, "up") if up >= left else (left, "left")
                if la[x[p - 1]] == lb[y[q - 1]]:
                    w, pairs = weigh(x[p - 1], y[q - 1])
                    if best[p - 1][q - 1][0] + w > choice[0]:
                        choice = (best[p - 1][q - 1][0] + w, pairs)
                best[p][q] = choice
        p, q, found = len(x), len(y), [(i, j)]
        while p and q:
            step = best[p][q][1]
            if isinstance(step, list):
                found += step
                p, q = p - 1, q - 1
            elif step == "up":
                p -= 1
            else:
                q -= 1
        return best[len(x)][len(y)][0] + 1, found

    return dict(weigh(0, 0)[1])


@lru_cache(maxsize=4096)
def slots(skeleton: str, reference: str) -> list[str]:
    """Slot of each node: its partner in the host's reference tree, or its own path if it has none."""
    match = simple_tree_matching(skeleton, reference)
    labels, children = _tree(skeleton)
    paths = [""] * len(labels)
    for i, kids in enumerate(children):
        for k in kids:
            paths[k] = f"{paths[i]}/{labels[k]}"
    return [str(match[i]) if i in match else paths[i] for i in range(len(labels))]


def text_hash(text: str) -> int:
    h = xxhash.xxh3_64_intdigest(text)
    return h - (1 << 64) if h >> 63 else h


def outline(pages: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    """Skeleton of a page; node, hash, length and article of each block; hash of the main text."""
    for sources in pages:
        out = []
        for source in sources:
            page = Page(source or "")
            main = [text_hash(t) for _, t in page.candidates()]
            nodes, texts = [n for n, _, _ in page.blocks], [text_hash(t) for _, t, _ in page.blocks]
            sizes, homes = [len(t) for _, t, _ in page.blocks], [page.home(a) for _, _, a in page.blocks]
            out.append((page.skeleton(), len(page.labels), nodes, texts, sizes, homes, text_hash(repr(main))))
        yield pd.DataFrame(out, columns=["skeleton", "n", "nodes", "texts", "sizes", "homes", "main"])


def aligned(pairs: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    for skeletons, references in pairs:
        yield pd.Series([slots(s, r) for s, r in zip(skeletons, references)], dtype=object)


def content(rows: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
    """Main text of a page, chosen from the blocks whose text is not the constant of their slot."""
    for sources, references, constants in rows:
        out = []
        for source, reference, constant in zip(sources, references, constants):
            page = Page(source or "")
            own = page.blocks
            if constant is not None and len(constant):
                known = set(constant)
                slot = slots(page.skeleton(), reference or "")
                own = [b for b in own if f"{slot[b[0]]}={text_hash(b[1])}" not in known]
            out.append("\n\n".join(t for _, t in page.candidates(own)))
        yield pd.Series(out, dtype=object)


def host(url: Column) -> Column:
    """Host of an address in lower case; empty for a null or odd one."""
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1), F.lit("")))


def wrappers(pages: DataFrame, share: float = CONSTANT_SHARE, least: int = LEAST_PAGES, sharing: int = LEAST_SHARING) -> DataFrame:
    """host, reference, constants: one row per host, from all its pages.

    The reference is the host's tree with most nodes. Every page is aligned to it, and what its slots show is counted over
    different pages, aggregated before each shuffle, so a host with a third of all pages is no single task.

    A slot is judged, not a text alone: a constant text is template where it is the slot's only one on a page, where all that
    the slot shows is constant, or, among texts that vary, if ``sharing`` pages show it. Within an article nothing is
    template as long as any of the article's text varies: a byline and a sentence that articles share belong to them.
    """
    found = cut_lineage(pages.select(host(F.col("url")).alias("host"), F.pandas_udf(outline, OUTLINE)(F.coalesce("html", F.lit(""))).alias("o"))
                        .select("host", "o.*"))
    best = found.groupBy("host").agg(F.max(F.struct("n", "skeleton")).alias("best"))
    best = cut_lineage(best.select("host", F.col("best.skeleton").alias("reference")))
    placed = found.join(best, "host").withColumn("slots", F.pandas_udf(aligned, "array<string>")("skeleton", "reference"))
    each = F.explode(F.arrays_zip("nodes", "texts", "sizes", "homes")).alias("b")
    slot = lambda node: F.when(F.col(node) >= 0, F.get("slots", F.col(node)))
    blocks = placed.select("host", "main", "slots", each).select(
        "host", "main", slot("b.nodes").alias("slot"), F.col("b.texts").alias("value"), F.col("b.sizes").alias("size"),
        slot("b.homes").alias("home"))
    blocks = cut_lineage(blocks.distinct())
    shows = blocks.groupBy("host", "slot", "main").agg(F.count_distinct("value").alias("k"))
    slots_of = shows.groupBy("host", "slot").agg(F.count("*").alias("of"), F.max("k").alias("most"))
    texts_of = blocks.groupBy("host", "slot", "value").agg(F.count_distinct("main").alias("by")).join(slots_of, ["host", "slot"])
    texts_of = cut_lineage(texts_of.select("host", "slot", "value", "most", (F.col("by") < F.col("of") * share).alias("varies")))
    marked = blocks.join(texts_of, ["host", "slot", "value"])
    varying = texts_of.groupBy("host", "slot").agg(F.max("varies").alias("slot_varies"))
    # near copies share their longest text among those that vary, or lie in a slot that does
    known = marked.join(varying, ["host", "slot"])
    sign = known.filter("slot_varies").groupBy("host", "main").agg(F.max(F.struct("size", "value")).alias("longest"))
    known = known.join(sign, ["host", "main"], "left").withColumn("page", F.coalesce("longest.value", F.lit(0)))
    known = cut_lineage(known.select("host", "slot", "value", "home", "most", "varies", "slot_varies", "page"))
    pages_of = known.groupBy("host", "slot").agg(F.count_distinct("page").alias("n"))
    articles = known.filter("home is not null").groupBy("host", "home").agg(F.max("varies").alias("alive"))
    own = known.join(articles, ["host", "home"], "left")
    shown = own.groupBy("host", "slot", "value").agg(
        F.count_distinct("page").alias("c"), F.max(F.coalesce("alive", F.lit(False))).alias("alive"),
        F.first("most").alias("most"), F.first("slot_varies").alias("slot_varies"))
    constant = shown.join(pages_of, ["host", "slot"]).filter(
        (F.col("n") >= least) & (F.col("c") >= F.col("n") * share) & ~F.col("alive")
        & ((F.col("most") == 1) | ~F.col("slot_varies") | (F.col("n") >= sharing)))
    named = constant.groupBy("host").agg(F.collect_list(F.concat_ws("=", "slot", F.col("value").cast("string"))).alias("constants"))
    return cut_lineage(best.join(named, "host", "left"))


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    Blocks of menus, headers, footers, sidebars, notices, adverts, forms and reader comments are ruled out by element or
    role. A block whose text is constant in its slot over the pages of the host, outside of articles that vary, is template
    and goes (see ``wrappers``). Of what varies,
    articles are content if one holds as much text as lies outside, else all of it; elements whose class or id speaks
    against them are none, unless they are wrappers, around the article or most of the text (see ``Page.candidates``). Content is
    in page order, joined by blank lines.
    Scripts, styles and markup never count; character references are decoded; white space in a block is one blank. Null
    and empty pages have an empty text; broken markup is read as far as it goes. Pages without a host form one group.
    Repeated rows are extracted each. An empty table gives an empty table; other columns are ignored. Pages are not
    shuffled while the hosts' wrappers are small enough for Spark to broadcast; else Spark joins by host and splits hot
    ones.
    """
    known = wrappers(pages).withColumnRenamed("host", "_host")
    own = pages.select("page_id", "url", "html", host(F.col("url")).alias("_own"))
    both = own.join(known, F.col("_own") == F.col("_host"), "left")
    text = F.pandas_udf(content, "string")(F.coalesce("html", F.lit("")), "reference", "constants")
    return both.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
