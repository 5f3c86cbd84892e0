"""Main text of web pages by a tree-structured graphical model over the page's elements.

Every element of the page is a node with two states, content or not. A node's own
evidence is the chance of its features (tag, words of class and id, amount of its text and
sentences, share of link text) in either state; an edge holds the chance of a child's state
given its parent's, by the part that the child's tag has in HTML. One upward and one downward pass of sum-product
messages give each node's marginal; text belongs to the page's main text where the
marginal of its element is over one half.

The tables are counted from labelled pages: the small labelled set below, and a bounded
sample (``sample`` pages, by a hash of page_id) of given pages whose own mark-up names the
article and the furniture. Features the tables do not know weigh nothing.

Text is cut into blocks by block elements; white space in a block becomes one space, the
block is trimmed, and blocks join in page order by a line feed. Character references are
decoded once. Comments, scripts, styles, templates and declarations have no text; an svg,
select, template or iframe that nothing ends is empty, so that the page goes on after it. Unclosed
and misnested tags are taken as browsers mostly do, in time that grows as the page. A null or empty page, or one without
content, has an empty text; repeated rows keep theirs; other columns are not read.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bound of the sample of given pages.
SAMPLE = 2000
#: One page of the labelled set counts as so many of the sample.
LABEL_WEIGHT = 500
_OPEN = re.compile(r"<(?:(!--)|[!?]|/(?![a-zA-Z])|(/?)([a-zA-Z][^\s/>]*+))")
_COMMENT_END = re.compile(r"-?>|.*?--!?>", re.S)
#: What is left of a tag: quotes hold a '>' only in an attribute's value; a quote that nothing closes is a character.
_REST = re.compile(r"([^>=]*+(?:=\s*+(?:\"[^\"]*+\"|'[^']*+')?+[^>=]*+)*+)>")
_ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
_WORD = re.compile(r"[a-z]+")
_STOP = re.compile(r"[.!?](?=\s|\Z)")
# Elements of HTML without end tags, with raw text, without visible text, that form blocks, and what an
# opening tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe".split())
HIDDEN = frozenset("noscript template svg select datalist".split())
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption"
    " figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table"
    " tbody td tfoot th thead tr ul".split())
ENDS_P = BLOCKS - frozenset("caption td th tr tbody thead tfoot html head body legend li dd dt".split()) | {"li", "dd", "dt"}
SAME = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select", "datalist"}}
ALIKE = {"dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th")}
TEXT_TAGS = frozenset(
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd pre blockquote figure figcaption caption table tr tbody thead tfoot address details"
    " summary legend fieldset".split())
FURNITURE_TAGS = frozenset("nav footer aside form header menu dialog button".split())
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement banner breadcrumb breadcrumbs comment comments cookie cookies footer header menu"
    " nav navbar navigation newsletter notice notices popup promo related share sharing sidebar social sponsor sponsored"
    " subscribe toolbar widget disqus replies consent modal".split())
CONTENT_TAGS = frozenset(("article", "main"))


@dataclass(slots=True)
class Node:
    tag: str
    parent: int
    words: tuple[str, ...] = ()
    label: str = ""
    chars: int = 0
    link_chars: int = 0
    children: int = 0
    paragraphs: int = 0
    own: int = 0
    stops: int = 0


@dataclass
class Page:
    nodes: list[Node] = field(default_factory=list)
    #: (node, text) in page order; a text of None is the end of a block.
    texts: list[tuple[int, str | None]] = field(default_factory=list)


class _Open:
    """The open elements: a stack of nodes, and for each tag (and for blocks) the depths where it is open.

    Every question is answered from the last depth of a tag, so a page costs time in
    proportion to its length, however its tags are nested.
    """

    def __init__(self, page: Page) -> None:
        self.page, self.stack = page, [0]
        self.depths: dict[str, list[int]] = {}
        self.hidden = 0  # the depth of the outermost element without visible text

    def last(self, *tags: str) -> int:
        return max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=0)

    def push(self, node: int, tag: str) -> None:
        depth = len(self.stack)
        self.depths.setdefault(tag, []).append(depth)
        if tag in BLOCKS:
            self.depths.setdefault("#block", []).append(depth)
        if tag in HIDDEN and not self.hidden:
            self.hidden = depth
        self.stack.append(node)

    def close(self, down_to: int) -> None:
        while len(self.stack) > down_to:
            tag = self.page.nodes[self.stack[-1]].tag
            self.depths[tag].pop()
            if tag in BLOCKS:
                self.depths["#block"].pop()
                self.page.texts.append((self.stack[-1], None))
            self.stack.pop()
        if self.hidden >= down_to:
            self.hidden = 0

    def end(self, tag: str) -> None:
        """An end tag. An inline one does not close blocks; one without its element does nothing."""
        depth = self.last(tag)
        if depth and (tag in BLOCKS or depth > self.last("#block")):
            self.close(depth)

    def make_way(self, tag: str) -> None:
        """Closes what the start of ``tag`` ends."""
        if tag in ENDS_P and (depth := self.last("p")) and depth == self.last("#block"):
            self.close(depth)
        if tag in SAME and (depth := self.last(*ALIKE.get(tag, (tag,)))) > self.last(*SAME[tag]):
            self.close(depth)


def parse(source: str) -> Page:
    """The elements and texts of a page, in one pass over it."""
    page = Page([Node("#page", -1)])
    nodes, texts = page.nodes, page.texts
    opened = _Open(page)
    stack = opened.stack
    at, size = 0, len(source)
    heed_quotes = True  # until a tag's quotes would leave it open to the end of the page
    last_end: dict[str, int] = {}

    def ends_after(tag: str) -> bool:
        if tag not in last_end:
            last_end[tag] = max((m.start() for m in re.finditer(rf"</{re.escape(tag)}(?=[\s/>])", source, re.I)), default=-1)
        return last_end[tag] >= at

    while at < size:
        m = _OPEN.search(source, at)
        start = m.start() if m else size
        if at < start and not opened.hidden:
            texts.append((stack[-1], source[at:start]))
        if not m:
            break
        at = m.end()
        if m[3] is None:
            if m[1]:
                end = _COMMENT_END.match(source, at)
                at = end.end() if end else size
            else:
                at = source.find(">", at) + 1 or size
            continue
        tag = m[3].lower()
        rest = _REST.match(source, at) if heed_quotes else None
        if rest:
            attributes, at = rest[1], rest.end()
        else:
            heed_quotes = False
            end = source.find(">", at)
            attributes, at = (source[at:end], end + 1) if end >= 0 else ("", size)
            if at == size and end < 0:
                break  # a tag that does not end is no text
        if m[2]:
            opened.end(tag)
            continue
        opened.make_way(tag)
        if tag in BLOCKS or tag in ("br", "hr"):
            texts.append((stack[-1], None if tag != "br" else " "))
        if tag in VOID:
            continue
        words, label = (), ""
        if attributes:
            found = _ATTRIBUTE.findall(attributes)
            words = tuple(sorted({w for f in found for w in _WORD.findall(" ".join(f[1:]).lower())}))
            if "data-y" in attributes:
                label = attributes[attributes.index("data-y") + 7 :].strip("\"'")[:1]
        node = len(nodes)
        nodes.append(Node(tag, stack[-1], words, label))
        nodes[stack[-1]].children += 1
        nodes[stack[-1]].paragraphs += tag == "p"
        if tag in RAW:
            if ends_after(tag):
                end = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>?", re.I).search(source, at)
                at = end.end()
            elif tag != "iframe":
                at = size
            continue
        if tag in HIDDEN and not ends_after(tag):
            continue
        if not attributes.endswith("/") or tag in BLOCKS:
            opened.push(node, tag)
    opened.close(1)
    for node, words in texts:
        if words:
            nodes[node].chars += len(words)
            nodes[node].own += len(words)
            nodes[node].stops += len(_STOP.findall(words))
    for n in range(len(nodes) - 1, 0, -1):  # children come after their parents
        own, up = nodes[n], nodes[nodes[n].parent]
        up.chars += own.chars
        if own.tag not in BLOCKS:
            up.own += own.own
        up.stops += own.stops
        up.link_chars += own.chars if own.tag == "a" else own.link_chars
    return page


def kind(node: Node) -> str:
    """What an edge's table depends on: the element's part in HTML, by its tag, and whether a div or the like has a name.

    A table's cell of mere text is text.
    """
    if node.tag in CONTENT_TAGS:
        return "article"
    if node.tag in FURNITURE_TAGS:  # a header is the article's or the site's
        return "header" if node.tag == "header" else "furniture"
    if node.tag in TEXT_TAGS or (node.tag in ("td", "th") and not node.children):
        return "text"
    return "inline" if node.tag not in BLOCKS else "named" if node.words else "unnamed"


def features(node: Node) -> list[str]:
    """What is observed of a node.

    Paragraphs and inline elements mostly share the state of what holds them, and many of
    them are no more evidence than their sum: what their text is like is observed of the holder.
    """
    share = node.link_chars / node.chars if node.chars else 0.0
    names = [f"word:{w}" for w in node.words]
    part = kind(node)
    if part in ("text", "inline"):
        return names + (["a list of links"] if node.tag in ("ul", "ol") and share > 0.75 else [])
    return names + [
        f"tag:{node.tag}", f"links:{int(share * 3.99)}", f"own:{min(int(math.log2(node.own + 1)), 9) // 3}",
        f"stops:{min(node.stops, 7) // 2}", f"paragraphs:{min(node.paragraphs, 3)}",
    ]


def named_states(page: Page) -> list[int] | None:
    """States by the page's own mark-up: inside an article and in no furniture. None if it names no article."""
    states, seen = [], False
    for node in page.nodes:
        above = states[node.parent] if node.parent >= 0 else 0
        named = node.tag in FURNITURE_TAGS or FURNITURE_WORDS.intersection(node.words)
        state = 0 if named else 1 if node.tag in CONTENT_TAGS else above
        seen |= node.tag in CONTENT_TAGS
        states.append(state)
    return states if seen else None


def labelled_states(page: Page) -> list[int]:
    states: list[int] = []
    for node in page.nodes:
        states.append(int(node.label) if node.label else states[node.parent] if node.parent >= 0 else 0)
    return states


#: Labelled pages: data-y is the state of an element and of all below it that has none of its own.
LABELLED = (
    "<html><head><title>T</title></head><body><header class=site-header><a href=/>Home page</a></header><nav><ul><li><a>One</a>"
    "<li><a>Two</a></ul></nav><main data-y=1><h1>A headline for the story</h1><p>Text of the story that is long enough.</p>"
    "<aside class=related data-y=0><a>More of the same</a></aside><p>And it goes on for another while, in words.</p></main>"
    "<aside class=sidebar><p>Read this too, it may be of use.</p></aside><section id=comments><div class=comment>First!</div></section>"
    "<footer><p>All rights reserved</p></footer></body></html>",
    "<body><div class=cookie-notice>We use cookies <button>Yes</button></div><div id=menu><a>A</a><a>B</a></div><div id=content"
    " data-y=1><h2>On the matter</h2><div><p>One paragraph with <b>bold</b> and <a>a link</a> in it. And one more sentence.</p><blockquote>Quoted text"
    " of someone</blockquote><ul><li>first point<li>second point</ul></div><div class='ad banner' data-y=0>Buy now</div>"
    "<form class=newsletter data-y=0>Subscribe <input></form><p>The last paragraph says the rest.</p></div><div class=footer>Imprint</div></body>",
    "<body><article class=post data-y=1><header><h1>Title of it</h1></header><section><p>Para one of the text, rather long. It goes on. And on.</p><p>Para two.</p>"
    "<figure><figcaption>What is seen here</figcaption></figure><table><tr><td>cell</td></tr></table><pre>code</pre></section>"
    "<div class='share social' data-y=0><a>Share</a></div><div class=comments data-y=0><p>I do not agree with this at all.</p></div>"
    "</article><div class=sponsored><p>A word of our sponsor, which is long.</p></div><form><p>Search the site</p></form></body>",
    "<body><div class=wrap><div class=top><a href=/>Start</a> <a>Shop</a> <a>Help</a></div><div class=text "
    "data-y=1><h1>Rain in the valley</h1><p>It rained for nine days. The river rose by a metre, and the road was "
    "closed.</p><p>On the tenth day the sun came out. People went back to their fields.</p><p>Nobody was hurt, said the "
    "mayor.</p></div><div class=right><ul><li><a>Older</a><li><a>Newer</a></ul></div></div><div class=bottom><a>Terms</a> "
    "<a>Privacy</a></div></body>",
    "<body><table><tr><td><a>Index</a><br><a>Maps</a><br><a>Links</a></td><td data-y=1><h2>The old mill</h2><p>The mill was"
    " built in 1702. It burnt down twice, and was rebuilt both times.</p><p>Today it is a museum. Visitors can see the "
    "great wheel turn.</p></td></tr></table></body>",
    "<body><div><div><a>News</a><a>Sport</a><a>Weather</a></div><div data-y=1><h1>Bread at home</h1><p>Mix the flour with "
    "water. Let it rest for an hour.</p><ol><li>Knead the dough.</li><li>Shape a loaf.</li><li>Bake it until "
    "brown.</li></ol><p>Let it cool before you cut it. It keeps for a week.</p></div><div><p>Log in or "
    "register</p><a>Forgot it?</a></div></div></body>",
    "<body><nav><a>Papers</a></nav><main data-y=1><h1>On sorting</h1><p>Sorting is old. We give a new bound for it.</p><div"
    " class=related-work><h2>Related work</h2><p>Many have studied this before. Their bounds are weaker than ours.</p><p>We"
    " follow the first of them.</p></div><section id=share-of-markets><p>The share of large inputs grows. Small ones "
    "stay.</p></section></main><footer>Press</footer></body>",
    "<body><div id=header><a>Law review</a></div><div id=article data-y=1><h1>The statute</h1><div class='comment "
    "on-the-law'><p>The law is short. It has been read in two ways for years.</p><p>Both readings have merits. A court will"
    " have to choose.</p></div><div class=notice-of-appeal><p>The notice was filed in May. The court heard it in "
    "June.</p></div></div><div id=sidebar><a>Archive</a><a>About</a></div></body>",
    "<body><article data-y=1><header><h1>A banner year</h1><p>By a writer of ours. Published on Monday.</p></header><div "
    "class='menu of-the-day'><h2>What they cooked</h2><p>The menu had six courses. All of them were good.</p><p>The last "
    "was the best one.</p></div><p>We shall go back. You should too.</p><aside data-y=0><a>Other "
    "places</a></aside></article><div class=promo><p>Win a dinner for two!</p></div></body>",
    "<body><div class=nav><a>A</a><a>B</a></div><div class=post data-y=1><h2>Two tables</h2><div><p>The first table has the"
    " rivers. They are long.</p><p>It is from a map.</p></div><table><tr><th>river</th><th>km</th></tr><tr><td>Elbe</td><td>1094</td></tr>"
    "</table><div class=part><p>The second has hills.</p><p>No hill is as high. None is as old.</p><table><tr><td>Brocken</td><td>1141</td></tr>"
    "</table></div><div><p>Both are from one book. It is old.</p></div><div><p>Its maps are new. <a>All of them</a> are here.</p></div></div>"
    "<div class=footer><div>Imprint</div></div></body>",
    "<body><div class=page><div class=story data-y=1><p>The bridge opened today. Ten thousand walked over it in the first "
    "hour.</p><p>It had taken six years. The cost was twice the plan.</p><div class='advert' data-y=0><p>Our cars are the "
    "best. Come and try one today.</p></div><p>The old bridge will go. Work on that starts in spring.</p></div><div "
    "class=comments><div class=comment><p>I was there too. It was very crowded.</p></div><div class=reply><p>So was I. It "
    "was fun.</p></div></div><div class='cookie notice'><p>We use cookies. Do you agree to "
    "that?</p><button>Yes</button></div></div></body>",
    "<body><div class=header><p>The daily paper. Since 1901.</p></div><div class=columns><div class=left><ul "
    "class=menu><li><a>Home</a><li><a>World</a></ul></div><div class=entry data-y=1><h3>Chess</h3><p>White won in forty "
    "moves. It was a quiet game at first.</p><p>Black then gave up a knight. That was a mistake.</p><div class=share "
    "data-y=0><a>Post</a> <a>Mail</a></div></div><div class=related><p>Read this next. You will like "
    "it.</p><a>Go</a></div></div><div class=newsletter><p>Get our letter. It is free of "
    "charge.</p><form><input></form></div><div class=footer><p>All rights reserved. Do not copy.</p></div></body>",
)


@dataclass
class Model:
    """Log odds of each feature, log tables of each kind of edge, by counting."""

    evidence: dict[str, tuple[float, float]]
    edges: dict[str, np.ndarray]

    @classmethod
    def fitted(cls, counts: Counter) -> Model:
        """``counts``: of (feature, state) and of (edge kind, parent's state, state)."""
        totals = {s: sum(n for k, n in counts.items() if k == ("tag:*", s)) + 2.0 for s in (0, 1)}
        names = {k[0] for k in counts if len(k) == 2}
        evidence = {f: tuple(math.log((counts[f, s] + 0.5) / totals[s]) for s in (0, 1)) for f in names if f != "tag:*"}
        edges = {}
        for k in ("article", "furniture", "header", "text", "named", "unnamed", "inline"):
            table = np.array([[counts[k, up, s] + 0.5 for s in (0, 1)] for up in (0, 1)])
            edges[k] = np.log(table / table.sum(1, keepdims=True))
        return cls(evidence, edges)

    def marginals(self, page: Page) -> list[float]:
        """The chance of content for each element: sum-product on the tree, in two passes."""
        nodes = page.nodes
        n = len(nodes)
        own0, own1 = [0.0] * n, [0.0] * n
        for i, node in enumerate(nodes):
            for f in features(node):
                if (e := self.evidence.get(f)) is not None:
                    own0[i] += e[0]
                    own1[i] += e[1]
        own0[0], own1[0] = 0.0, -1e6  # the page as a whole is no content
        tables = [self.edges[kind(node)].tolist() for node in nodes]
        up0, up1 = [0.0] * n, [0.0] * n
        for i in range(n - 1, 0, -1):
            t, a, b, parent = tables[i], own0[i], own1[i], nodes[i].parent
            up0[i], up1[i] = _add(a + t[0][0], b + t[0][1]), _add(a + t[1][0], b + t[1][1])
            own0[parent] += up0[i]
            own1[parent] += up1[i]
        chances = [0.0] * n
        down = [0.0] * n  # log odds that the rest of the page gives to the parent's state, then all
        all0, all1 = [own0[0]] * n, [own1[0]] * n
        for i in range(1, n):
            parent, t = nodes[i].parent, tables[i]
            from0, from1 = all0[parent] - up0[i], all1[parent] - up1[i]
            all0[i] = own0[i] + _add(from0 + t[0][0], from1 + t[1][0])
            all1[i] = own1[i] + _add(from0 + t[0][1], from1 + t[1][1])
            down[i] = all1[i] - all0[i]
            chances[i] = 1 / (1 + math.exp(-max(-500.0, min(500.0, down[i]))))
        return chances


def _add(a: float, b: float) -> float:
    """log(exp(a) + exp(b))."""
    return a + math.log1p(math.exp(b - a)) if a > b else b + math.log1p(math.exp(a - b))


def counted(page: Page, states: list[int], counts: Counter) -> None:
    for node, state in zip(page.nodes, states, strict=True):
        if node.parent >= 0:
            counts[kind(node), states[node.parent], state] += 1
            counts["tag:*", state] += 1
            for f in features(node):
                counts[f, state] += 1


def main_text(source: str, model: Model) -> str:
    page = parse(source)
    content = [c > 0.5 for c in model.marginals(page)]
    blocks: list[str] = []
    block: list[str] = []
    for node, words in page.texts:
        if words is None:
            if block:
                blocks.append(html.unescape("".join(block)))
                block = []
        elif content[node]:
            block.append(words)
    blocks.append(html.unescape("".join(block)))
    return "\n".join(b for b in (" ".join(x.split()) for x in blocks) if b)


def fit(pages: DataFrame, sample: int = SAMPLE, id: str = "page_id", source: str = "html") -> Model:
    """The labelled set and at most about ``sample`` of the given pages, as one table of counts."""
    total = Counter()
    for text in LABELLED:
        page = parse(text)
        one = Counter()
        counted(page, labelled_states(page), one)
        for k, n in one.items():
            total[k] += LABEL_WEIGHT * n
    rows = pages.count()
    part = F.pmod(F.xxhash64(id, F.lit("sample")), F.lit(1 << 30)) / float(1 << 30)
    chosen = pages.where(part < (sample / rows if rows else 1.0)).select(F.col(source).alias("html"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            for value in batch.column("html"):
                page = parse(value.as_py() or "")
                if states := named_states(page):
                    counted(page, states, counts)
        keys = list(counts)
        yield pa.RecordBatch.from_pydict({
            "name": pa.array([k[0] for k in keys], pa.string()), "up": pa.array([k[1] if len(k) == 3 else -1 for k in keys], pa.int32()),
            "state": pa.array([k[-1] for k in keys], pa.int32()), "n": pa.array([counts[k] for k in keys], pa.int64())})

    found = chosen.mapInArrow(count, "name string, up int, state int, n long").groupBy("name", "up", "state").agg(F.sum("n").alias("n"))
    # features of at most ``sample`` pages; rare ones say little and are left out
    for r in found.where("n > 2").collect():
        total[(r["name"], r["state"]) if r["up"] < 0 else (r["name"], r["up"], r["state"])] += r["n"]
    return Model.fitted(total)


def extract(pages: DataFrame, model: Model, id: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """(id, url, text, n_chars) for each row of ``pages``."""
    known = pages.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(value.as_py() or "", known.value) for value in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                names)

    rows = pages.select(id, url, source)
    names = [id, url, "text", "n_chars"]
    return rows.mapInArrow(run, rows.select(id, url).schema.add("text", "string").add("n_chars", "long"))
