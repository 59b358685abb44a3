"""Main text of web pages by a tree-structured graphical model.

A page's elements and text blocks form a tree. Each node is in one of three
states: structure (holds content somewhere below), content, boilerplate.
Parent-child potentials connect the nodes; each node's tag, class words and
text measures are its evidence: words and tags that name boilerplate (comments,
menus, notices) all but settle it, a page that is one big form does not. One pass upward and one downward of
sum-product messages give every node's marginal, and the text blocks that are
more likely content than not are the page's text, in page order.

The potentials are counts over labelled pages plus fixed pseudo-counts of the
same weight, so layouts that the labelled pages lack keep sensible odds. Labels
come from pages that mark their text with ``article`` or ``main``: what they
hold is content except marked boilerplate inside, what holds them is
structure, all else boilerplate. Learning reads about ``sample_pages`` pages,
chosen by a hash (a documented bound; copies of a page count once); extraction
reads every page whole, in time linear in its length.

A class name of several words is judged as one: an everyday word in it (related,
legal, share) names boilerplate only if the other words name parts of a page,
as in ``share-buttons`` but not in ``share-price``.

Scripts, styles, form controls and embedded objects are never text. Character
references are decoded, white space inside a block is one space, blocks are
joined by two line feeds. A null or empty page has an empty text; repeated
rows give repeated results; unclosed tags, quotes and comments end with the
page; ``head`` ends at the first tag or text that cannot stand in it, and another
skipped element that is not closed at its parent's closing tag or the next block.
Only the page id, url and html columns are read.
"""

from __future__ import annotations

import html
import re
from collections import Counter, defaultdict

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contrail.llm.common import map_arrow

SAMPLE_PAGES = 2000

# Kinds of elements.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q ruby rt s "
                   "samp small span strike strong sub sup time tt u var math mi mn mo ms mtext mspace mrow mfrac msqrt "
                   "mroot mstyle merror mpadded mphantom mfenced menclose msub msup msubsup munder mover munderover "
                   "mmultiscripts mprescripts mtable mtr mtd maction semantics annotation annotation-xml".split())
RAW = frozenset("script style".split())
NEVER = frozenset("head noscript template iframe object svg canvas audio video select textarea button "
                  "datalist map frameset".split())
CLOSES_P = frozenset("address article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main "
                     "nav ol p pre section table ul".split())
SAME_CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
               "th": {"td", "th"}, "option": {"option"}}
SCOPES = frozenset("ul ol dl table".split())
BOILER_TAGS = frozenset("nav header footer aside form menu dialog fieldset".split())
CONTENT_TAGS = frozenset("article main".split())
# What may stand in head: elements with text of their own, and without.
HEAD_TEXT = frozenset("script style title template noscript noframes".split())
HEAD_EMPTY = frozenset("head base basefont bgsound link meta".split())
# Tags that end a skipped element that is not closed.
BLOCKS = CLOSES_P | BOILER_TAGS | CONTENT_TAGS | frozenset("body html li dt dd tr td th tbody thead tfoot caption "
                                                           "figure figcaption hgroup details summary center".split())
TELLING_TAGS = BOILER_TAGS | CONTENT_TAGS | frozenset("html body p h1 blockquote pre".split())
BOILER_WORDS = frozenset("""ad ads adv advert advertisement banner sponsor sponsored promo promotion nav navbar
navigation menu header footer sidebar aside side breadcrumb breadcrumbs cookie cookies consent gdpr notice notification
alert popup modal overlay comment comments disqus reply replies respond discussion related recommended share sharing
social follow subscribe subscription newsletter signup login search form widget tags pagination pager copyright
legal masthead topbar toolbar skip hidden toc""".split())
# Words of ordinary language among them, and words for parts of a page that they may stand with.
EVERYDAY = frozenset("alert discussion follow form legal notice notification related recommended replies reply respond "
                     "search share sharing side skip social subscription tags".split())
PAGE_PARTS = frozenset("""area articles article bar block body bottom box button buttons btn card cards carousel cell
column columns container content control controls count counter cta desktop dropdown entries feed field fields fixed
floating grid group heading holder icon icons info inline inner input item items label labels large layer left link
links list main media message messages meta mobile module modules more news next options outer page pages panel panels
post posts primary results right row rows secondary section sections small stats sticky stories story strip submit tab
tabs text title titles tools top tray ui us view wrap wrapper zone""".split())
CONTENT_WORDS = frozenset("article content post entry story main body text page hentry prose".split())

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?/][^a-zA-Z][^>]*(?:>|\Z)|<[!?][^>]*(?:>|\Z)"
                   r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
                   r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
MARKED = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)
WORDS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")

STRUCTURE, CONTENT, BOILER = 0, 1, 2
# Pseudo-counts of child states by parent state, for children that are marked as
# boilerplate and for others, and of the top node's state.
MOVES = {"marked": ((0.1, 0.1, 30.0), (0.1, 0.1, 30.0), (0.001, 0.001, 100.0)),
         "plain": ((10.0, 5.0, 30.0), (0.001, 100.0, 0.05), (0.001, 0.001, 100.0))}
START = (0.98, 0.01, 0.01)


def raw_end(source: str, tag: str, at: int) -> int | None:
    """Where the text of an element that holds no markup ends, with its closing tag."""
    stop = re.compile(rf"</{tag}\b[^>]*(?:>|\Z)", re.I).search(source, at)
    return stop.end() if stop else None


def closed_at(source: str) -> dict[int, int]:
    """Of each element of ``NEVER`` that is closed inside its parent: where its
    opening tag ends, and where its closing tag does."""
    out: dict[int, int] = {}
    stack: list[tuple[str, int]] = []
    open_: Counter = Counter()
    at, end = 0, len(source)
    while at < end and (m := TOKEN.search(source, at)):
        at = m.end()
        tag = (m.group(2) or m.group(5) or "").lower()
        if not tag or tag == "head" or tag in VOID or tag in INLINE:
            continue
        if not (m.group(1) or m.group(4)):
            if tag in RAW:
                at = raw_end(source, tag, at) or end
            elif tag not in NEVER or not (m.group(3) or m.group(6) or "").endswith("/"):
                stack.append((tag, at))
                open_[tag] += 1
        elif open_[tag]:
            while True:
                name, begin = stack.pop()
                open_[name] -= 1
                if name == tag:
                    break
            if tag in NEVER:
                out[begin] = at
    return out


def class_words(name: str) -> set[str]:
    """The words of a class name; none if an everyday word is part of another notion."""
    words = {w.lower() for w in WORDS.findall(name)}
    bad = words & BOILER_WORDS
    if bad and bad <= EVERYDAY and not words <= BOILER_WORDS | PAGE_PARTS:
        return set()
    return words


class Page:
    """The tree: for each node its parent, evidence and, for a text block, its
    text. Parents come before children; ``marks`` is the hand-made label of an
    element that is marked by tag or class (None: unmarked)."""

    def __init__(self, source: str):
        self.parent: list[int] = []
        self.tag: list[str] = []
        self.evidence: list[tuple] = []
        self.text: list[str | None] = []
        self.marks: list[int | None] = []
        self._parse(source)

    def _node(self, parent: int, tag: str, evidence: tuple, text: str | None, mark: int | None) -> int:
        self.parent.append(parent)
        self.tag.append(tag)
        self.evidence.append(evidence)
        self.text.append(text)
        self.marks.append(mark)
        return len(self.parent) - 1

    def _element(self, parent: int, tag: str, attributes: str) -> int:
        words = set()
        if attributes:
            for m in MARKED.finditer(attributes):
                for name in (m.group(1) or m.group(2) or m.group(3) or "").split():
                    words |= class_words(name)
        good, bad = words & CONTENT_WORDS, words & BOILER_WORDS
        hint = "none" if bool(good) == bool(bad) else "boiler" if bad else "content"
        mark = BOILER if tag in BOILER_TAGS or hint == "boiler" else CONTENT if tag in CONTENT_TAGS else None
        # boxes, lists and tables stand in menus and texts alike: no evidence by themselves
        tells = tag in TELLING_TAGS and not (tag in CONTENT_TAGS and hint == "boiler")
        own = (("tag", tag), ("hint", hint)) if tells else (("hint", hint),)
        return self._node(parent, tag, own, None, mark)

    def _parse(self, source: str) -> None:
        root = self._node(-1, "html", (("tag", "html"), ("hint", "none")), None, None)
        stack: list[tuple[str, int]] = [("html", root)]   # open elements that are nodes
        places: defaultdict[str, list[int]] = defaultdict(list)   # where in it each tag is, but for the root
        inline: list[str] = []
        inside: Counter = Counter()   # its tags, counted
        endless: set[str] = set()   # tags that are not closed from here on
        buffer: list[str] = []
        links = 0
        never = ""    # the element that is skipped: head, or one that is not closed
        closed = closed_at(source)
        linked = [0]

        def flush() -> None:
            if buffer:
                text = " ".join("".join(buffer).split())
                if text:
                    n = len(text.split())
                    size = "short" if n < 4 else "line" if n < 10 else "some" if n < 25 else "long"
                    share = linked[0] / len(text)
                    link = "none" if share == 0 else "part" if share < 0.5 else "most"
                    stop = "stop" if text[-1] in ".!?:;…\"”»" else "open"
                    self._node(stack[-1][1], "#text", (("size", size), ("link", link), ("stop", stop)), text, None)
                buffer.clear()
                linked[0] = 0

        def add(raw: str) -> None:
            if raw and not never:
                raw = html.unescape(raw) if "&" in raw else raw
                buffer.append(raw)
                if links:
                    linked[0] += len(raw.strip())

        def close_to(k: int) -> None:
            nonlocal links
            while len(stack) > k:
                places[stack.pop()[0]].pop()
            inline.clear()
            inside.clear()
            links = 0

        def own_end(tag: str, at: int) -> int | None:
            stop = None if tag in endless else raw_end(source, tag, at)
            if stop is None:
                endless.add(tag)
            return stop

        def last(tags) -> int:
            return max((places[t][-1] for t in tags if places[t]), default=0)

        at, end = 0, len(source)
        while at < end:
            m = TOKEN.search(source, at)
            before = source[at:m.start() if m else end]
            if never == "head" and before.strip():
                never = ""
            add(before)
            if not m:
                break
            at = m.end()
            tag = (m.group(2) or m.group(5) or "").lower()
            if not tag:
                if m.group().startswith("<![CDATA["):
                    add(m.group()[9:].removesuffix("]]>"))
                continue
            closing = bool(m.group(1) or m.group(4))
            attributes = m.group(3) or m.group(6) or ""
            if tag in RAW and not closing:
                at = own_end(tag, at) or end
                continue
            if never == "head":
                if closing:
                    never = "" if tag == "head" else never
                    continue
                if tag in HEAD_TEXT:
                    stop = own_end(tag, at)
                    if stop is None and tag == "title":   # up to the next tag
                        stop = source.find("<", at)
                        stop = end if stop < 0 else stop
                    at = at if stop is None else stop
                    continue
                if tag in HEAD_EMPTY:
                    continue
                never = ""
            elif never:
                if tag == never and closing:
                    never = ""
                    continue
                parent = closing and (inside[tag] or places[tag])
                if not parent and (closing or tag not in BLOCKS):
                    continue
                never = ""
            if tag in NEVER:
                if not closing and tag == "head":
                    never = tag
                elif not closing and not attributes.endswith("/"):
                    if at in closed:
                        at = closed[at]
                    else:
                        never = tag
            elif tag == "br" or tag == "wbr" or tag == "img":
                add(" " if tag == "br" else "")
            elif tag in INLINE:
                if not closing:
                    inline.append(tag)
                    inside[tag] += 1
                    links += tag == "a"
                elif inside[tag]:
                    while True:
                        name = inline.pop()
                        inside[name] -= 1
                        if name == tag:
                            break
                    links = inside["a"]
            elif tag in VOID:
                if tag == "hr":
                    flush()
            elif tag == "html" or tag == "title":
                flush()
            elif closing:
                flush()
                if places[tag]:
                    close_to(places[tag][-1])
            else:
                flush()
                if tag in CLOSES_P:
                    for k in range(len(stack) - 1, max(len(stack) - 4, 0), -1):
                        if stack[k][0] == "p":
                            close_to(k)
                            break
                if tag in SAME_CLOSES:
                    k = last(SAME_CLOSES[tag])
                    if k > last(("table",) if tag in ("tr", "td", "th") else SCOPES):
                        close_to(k)
                places[tag].append(len(stack))
                stack.append((tag, self._element(stack[-1][1], tag, attributes)))
        flush()

    def edge(self, i: int) -> str:
        """The kind of the potential between a node and its parent."""
        return "marked" if self.marks[i] == BOILER else "plain"

    def labels(self) -> list[int] | None:
        """Every node's state by the page's own marks; None if it marks no content."""
        n = len(self.parent)
        label = [BOILER] * n
        if CONTENT not in self.marks:
            return None
        for i in range(n):
            up = label[self.parent[i]] if i else STRUCTURE
            inside = i and up != STRUCTURE
            if self.marks[i] == BOILER or inside and up == BOILER:
                label[i] = BOILER
            elif self.marks[i] == CONTENT or inside:
                label[i] = CONTENT
            else:
                label[i] = STRUCTURE
        holds = [False] * n  # structure is only what holds content
        for i in range(n - 1, -1, -1):
            if label[i] == STRUCTURE and (not holds[i] or self.text[i] is not None):
                label[i] = BOILER
            if i and (holds[i] or label[i] == CONTENT):
                holds[self.parent[i]] = True
        return label


def prior() -> Counter:
    """Pseudo-counts of evidence by state."""
    out: Counter = Counter()
    for tag in TELLING_TAGS:
        odds = ((1e-4, 1e-4, 50) if tag in ("form", "fieldset") else (1e-9, 1e-9, 50) if tag in BOILER_TAGS
                else (0.005, 20, 0.1) if tag == "article" else (0.5, 20, 0.1) if tag == "main" else (20, 0.1, 0.1) if tag in ("html", "body")
                else (0.5, 10, 1) if tag == "h1" else (0.5, 8, 4))
        for state, n in enumerate(odds):
            out["tag", tag, state] = n
    for key, odds in {("hint", "none"): (50, 100, 60), ("hint", "content"): (8, 20, 1), ("hint", "boiler"): (1e-9, 1e-9, 50),
                      ("size", "short"): (1, 15, 40), ("size", "line"): (1, 8, 20), ("size", "some"): (1, 20, 8),
                      ("size", "long"): (1, 40, 3), ("link", "none"): (1, 50, 20), ("link", "part"): (1, 10, 5),
                      ("link", "most"): (1, 2, 40), ("stop", "stop"): (1, 40, 15), ("stop", "open"): (1, 20, 40)}.items():
        for state, n in enumerate(odds):
            out[(*key, state)] = n
    return out


def page_counts(source: str) -> Counter:
    """Counts of moves and evidence by state on a page that marks its content."""
    page, out = Page(source), Counter()
    label = page.labels()
    if label is None:
        return out
    for i, state in enumerate(label):
        for name, value in page.evidence[i]:
            out[name, value, state] += 1
        if i:
            out["move", f"{page.edge(i)} {label[page.parent[i]]}", state] += 1
    return out


def shares(counts: dict) -> dict:
    """Each count's share among its name and state (of a move: its name and parent)."""
    group = {k: (k[0], k[1]) if k[0] == "move" else (k[0], k[2]) for k in counts}
    total: Counter = Counter()
    for k, n in counts.items():
        total[group[k]] += n
    return {k: n / total[group[k]] for k, n in counts.items()}


class Model:
    """Potentials: the mean of the fixed odds and, where any were counted, the
    labelled pages' odds."""

    def __init__(self, counts: Counter | dict):
        fixed = {**prior(), **{("move", f"{kind} {up}", s): rows[up][s] for kind, rows in MOVES.items()
                               for up in range(3) for s in range(3)}}
        fixed, learned = shares(fixed), shares(dict(counts))
        counted = {(k[0], k[1]) if k[0] == "move" else (k[0], k[2]) for k in learned}

        def odds(name: str, value: str, state: int) -> float:
            own, key = fixed[name, value, state], (name, value, state)
            if ((name, value) if name == "move" else (name, state)) in counted:
                own = (own + learned.get(key, 0.0)) / 2
            return max(own, 1e-12)

        self.move = {kind: [tuple(odds("move", f"{kind} {up}", s) for s in range(3)) for up in range(3)]
                     for kind in MOVES}
        self.likely = {(name, value): tuple(odds(name, value, s) for s in range(3))
                       for name, value, _ in fixed if name != "move"}
        for key, (_, *rest) in self.likely.items():
            if key[0] == "size":  # a text block is never structure
                self.likely[key] = (1e-12, *rest)

    def marginals(self, page: Page) -> list[tuple[float, float, float]]:
        """Sum-product: messages from the leaves up, then from the top down."""
        n, parent, likely = len(page.parent), page.parent, self.likely
        moves = [self.move[page.edge(i)] for i in range(n)]
        below: list[list[float]] = []
        for evidence in page.evidence:
            a = b = c = 1.0
            for key in evidence:
                x, y, z = likely[key]
                a, b, c = a * x, b * y, c * z
            below.append([a, b, c])
        up: list[tuple[float, float, float]] = [(1.0, 1.0, 1.0)] * n
        for i in range(n - 1, 0, -1):
            a, b, c = below[i]
            s = a + b + c
            a, b, c = below[i] = [a / s + 1e-30, b / s + 1e-30, c / s + 1e-30]
            x, y, z = (r[0] * a + r[1] * b + r[2] * c for r in moves[i])
            up[i] = (x, y, z)
            q = below[parent[i]]
            q[0] *= x
            q[1] *= y
            q[2] *= z
            s = q[0] + q[1] + q[2]
            if s < 1e-100:
                q[0], q[1], q[2] = q[0] / s + 1e-30, q[1] / s + 1e-30, q[2] / s + 1e-30
        out: list[tuple[float, float, float]] = [(0.0, 0.0, 0.0)] * n
        for i in range(n):
            a, b, c = below[i]
            if i:
                x, y, z = out[parent[i]]
                u, v, w = up[i]
                x, y, z = x / u, y / v, z / w      # the parent's belief without this child
                (r0, r1, r2), (s0, s1, s2), (t0, t1, t2) = moves[i]
                a, b, c = (a * (x * r0 + y * s0 + z * t0), b * (x * r1 + y * s1 + z * t1),
                           c * (x * r2 + y * s2 + z * t2))
            else:
                a, b, c = a * START[0], b * START[1], c * START[2]
            s = a + b + c
            out[i] = (a / s, b / s, c / s)
        return out

    def extract(self, source: str | None) -> str:
        if not source:
            return ""
        page = Page(source)
        belief = self.marginals(page)
        return "\n\n".join(t for t, p in zip(page.text, belief) if t is not None and p[CONTENT] > 0.5)


def train(pages: DataFrame, html_col: str = "html", sample_pages: int = SAMPLE_PAGES) -> Model:
    """Counts over a hash sample of about ``sample_pages`` different pages, added up
    by Spark; the keys are a fixed set of tags, hints and measures."""
    own = pages.select(F.col(html_col).cast("string").alias("html"))
    total = own.agg(F.approx_count_distinct("html")).first()[0]
    scale = 1 << 30
    share = min(scale, -(-scale * sample_pages // max(total, 1)))
    # copies of one page fall together, in each map task first: they count once
    chosen = own.where(F.pmod(F.xxhash64("html"), F.lit(scale)) < share).distinct()

    def run(batches):
        for b in batches:
            total: Counter = Counter()
            for source in b.column(0).to_pylist():
                if source:
                    total.update(page_counts(source))
            rows = [(*k, n) for k, n in total.items()]
            if rows:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows), (pa.string(), pa.string(), pa.int32(), pa.int64()))],
                    ["name", "value", "state", "n"])

    sums = map_arrow(chosen, run, "name string, value string, state int, n bigint")
    sums = sums.groupBy("name", "value", "state").agg(F.sum("n").alias("n")).collect()
    return Model({(r["name"], r["value"], r["state"]): r["n"] for r in sums})


def extract_pages(pages: DataFrame, model: Model, keep: tuple[str, ...] = ("page_id", "url"),
                  html_col: str = "html") -> DataFrame:
    """The ``keep`` columns, the main text and its code points, for every row."""
    n = len(keep)

    def run(batches):
        for b in batches:
            texts = [model.extract(source) for source in b.column(n).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:n], pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                [*keep, "text", "n_chars"])

    own = pages.select(*keep, F.col(html_col).cast("string").alias("__html"))
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:n])
    return map_arrow(own, run, f"{fields}, text string, n_chars bigint")
