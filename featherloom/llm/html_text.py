"""Main text of web pages by consensus paths of each host.

First pass: every page is parsed, its containers are scored, and the path of tags and classes that
leads to the best one, with digits generalised, is its vote. Spark sums the votes of each host and
keeps the winning path. A container is left for a child only while nothing but boilerplate stays
outside, and never below an article. Names that mark what is not the article cut an element only
where the page has its text elsewhere; a form counts as marked. Second pass: the elements on the host's path are extracted; a page without
such an element falls back to its own best container. Paths of hosts with over a thousandth of the
pages are broadcast, so a large host's pages are spread like any others.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from featherloom.llm.common import materialise
from featherloom.llm.url_filter import host_of
from featherloom.naming import quoted
from featherloom.operators.joins import lookup_join

#: Share of a container's text that a child must hold to be chosen in its place.
DOMINANT = 0.6
#: Characters outside links from which text beside that child is no boilerplate.
SENTENCE = 25
#: A marked element is the article if it holds most of the text, and so many times what is unmarked.
OUTWEIGHS = 10

# Element names of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
SKIPPED = frozenset((
    "script style noscript template iframe object svg math canvas head title nav header footer "
    "aside button select option input textarea label menu dialog xmp noembed noframes "
    "audio video map").split())
INLINE = frozenset((
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark nobr q rp rt ruby "
    "s samp small span strike strong sub sup time tt u var wbr img").split())
#: Blocks of an article, never the article itself.
ARTICLE_BLOCKS = frozenset((
    "p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table tbody thead tfoot tr pre blockquote figure "
    "figcaption hr address summary").split())
#: Elements whose start ends an open paragraph.
CLOSES_P = frozenset((
    "address article aside blockquote center details dialog dir div dl fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section summary "
    "table ul").split())
#: Elements that end one of the same kind, up to the given ancestors.
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}),
            "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr"}, {"table"}),
            "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
            "option": ({"option"}, {"select"})}
#: Names in class, id or role that mark what is not the article.
NOT_ARTICLE = re.compile(
    r"(?:^|[\s_\-])(?:ad|ads|advert\w*|adbox|banner\w*|sponsor\w*|promo\w*|side|side-?bar|sidenav|"
    r"aside|comment\w*|reply|replies|respond|disqus\w*|discussion|menu\w*|nav|navbar|navigation|"
    r"breadcrumb\w*|pager|pagination|footer\w*|header|masthead|site-?head\w*|topbar|toolbar|"
    r"cookie\w*|consent|gdpr|notice\w*|alert|popup|pop-up|modal|overlay|newsletter|subscri\w*|"
    r"signup|login|share|sharing|social\w*|related|recommend\w*|trending|widget\w*|search\w*|form|"
    r"skip|copyright|legal|complementary|contentinfo|hidden)(?:$|[\s_\-\d])", re.I)
#: Names that only speak of such parts, or are the article's own, and do not mark an element.
NO_MARK = re.compile(
    r"(?:^|(?<=\s))(?:\S*?[_\-])?(?:(?:has|have|no|not|with|without)[_\-]\S*|"
    r"(?:entry|post|article|story|page|content)[_\-]header)(?=\s|$)", re.I)
#: Names of parts that often hold articles of their own, such as comments and teasers.
FOREIGN = re.compile(r"comment|repl(?:y|ies)|respond|disq|discussion|related|recommend|trending|"
                     r"widget|promo|sponsor|(?:^|[\s_\-])ad(?:s|vert\w*|box)?(?:$|[\s_\-\d])", re.I)
#: Names of an article or of what holds it, as whole names.
ARTICLE_NAME = re.compile(
    r"(?:^|(?<=\s))(?:(?:page|site|main|post|entry|article|content|body|layout)[_\-]?"
    r"(?:container|wrapper|wrap|content|body|inner|main|area)?|container|wrapper|wrap|story|text)"
    r"(?=[\d\s]|$)", re.I)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

TOKEN = re.compile(
    r"<!--(?:.*?-->|>|->)|<!--.*|<[!?][^>]*>?|"
    r"<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'=]++|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|[=\"'])*+)>|"
    r"<(/?)([a-zA-Z][^\s/>]*)([^>]*)>?", re.S)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
BARE_HIDDEN = re.compile(r"(?:^|\s)hidden(?:$|[\s/=])", re.I)
DIGITS = re.compile(r"\d+")


#: What the names of an element say: nothing, not the article, that and the article, or that it
#: holds articles of others.
PLAIN, MARKED, MIXED, OTHERS = 0, 1, 2, 3


class Element:
    __slots__ = ("tag", "step", "parent", "skipped", "parts", "size", "links", "mark")

    def __init__(self, tag: str, step: str, parent: Element | None, skipped: bool,
                 mark: int = PLAIN) -> None:
        self.tag, self.step, self.parent, self.skipped = tag, step, parent, skipped
        self.parts: list[str | Element | None] = []   # None stands for a line break
        self.size = self.links = 0
        self.mark = mark

    def path(self) -> str:
        """The steps from the root; built where it is asked for, as deep pages have long ones."""
        steps, node = [], self
        while node is not None:
            steps.append(node.step)
            node = node.parent
        return "/".join(reversed(steps))


def _attributes(text: str) -> tuple[str, bool, int]:
    """(class names, whether the element is hidden, what class, id and role say of it)."""
    if not text or text.isspace():
        return "", False, PLAIN
    classes, marks, hidden = "", [], bool(BARE_HIDDEN.search(ATTRIBUTE.sub(" ", text)))
    for name, a, b, c in ATTRIBUTE.findall(text):
        name, value = name.lower(), a or b or c
        if name == "class":
            classes = " ".join(sorted(value.split()))
            marks.append(value)
        elif name in ("id", "role"):
            marks.append(value)
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "").lower()
        elif name == "aria-hidden":
            hidden |= value.lower() == "true"
        elif name == "hidden":
            hidden = True
    # names that speak of other parts are read as none
    if not any(NOT_ARTICLE.search(m) and NOT_ARTICLE.search(NO_MARK.sub(" ", m)) for m in marks):
        return classes, hidden, PLAIN
    if any(FOREIGN.search(m) for m in marks):
        return classes, hidden, OTHERS
    return classes, hidden, MIXED if any(ARTICLE_NAME.search(m) for m in marks) else MARKED


def parse(html: str) -> Element:
    """A tree of elements; never fails. Ends that match nothing are ignored."""
    root = Element("", "", None, False)
    node, at = root, 0
    length = len(html)
    marked = False
    steps: dict[str, str] = {}   # one string for equal steps
    opened: dict[str, int] = defaultdict(int)   # open elements by tag, so no end is sought in vain

    def leave(element: Element) -> Element:
        """Ends all up to an open element; what stays open is its parent."""
        inner = node
        while inner is not element.parent:
            opened[inner.tag] -= 1
            inner = inner.parent
        return inner

    while at < length:
        start = html.find("<", at)
        if start < 0:
            start = length
        if start > at:
            node.parts.append(html[at:start])
        if start == length:
            break
        found = TOKEN.match(html, start)
        if not found:
            node.parts.append("<")
            at = start + 1
            continue
        at = found.end()
        closing, tag, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if not tag:
            continue
        tag = tag.lower()
        if closing:
            if opened[tag]:
                other = node
                while other.tag != tag:
                    other = other.parent
                node = leave(other)
            elif tag == "br":
                node.parts.append(None)
            continue
        if tag in CLOSES_P and opened["p"]:
            other = node
            while other.parent is not None and (other.tag in INLINE):
                other = other.parent
            if other.tag == "p":
                node = leave(other)
        elif tag in SIBLINGS and any(opened[t] for t in SIBLINGS[tag][0]):
            same, stop = SIBLINGS[tag]
            other = node
            while other.parent is not None and other.tag not in same and other.tag not in stop:
                other = other.parent
            if other.tag in same:
                node = leave(other)
        if tag in VOID:
            if tag not in INLINE:
                node.parts.append(None)
            continue
        step, skipped, mark = "", True, PLAIN
        # an article's own header holds its title
        if not node.skipped and (tag not in SKIPPED or tag == "header" and opened["article"]):
            classes, skipped, mark = _attributes(attributes)
            if tag == "form" and mark == PLAIN:
                mark = MARKED
            skipped = skipped and tag not in ("html", "body", "main", "article")
            marked |= mark != PLAIN
        if not skipped:
            step = f"{tag}.{classes.replace(' ', '.')}" if classes else tag
            step = steps.setdefault(step, DIGITS.sub("0", step).replace("/", "|"))
        child = Element(tag, step, node, skipped, mark)
        node.parts.append(child)
        if tag in RAW:
            end = re.compile(rf"</{tag}(?=[\s/>])[^>]*>", re.I).search(html, at)
            at = end.end() if end else length
        elif not attributes.rstrip().endswith("/") or tag not in ("svg", "math"):
            node = child
            opened[tag] += 1
    if marked:
        _skip_marked(root)
    return root


def _cuttable(element: Element) -> bool:
    return element.mark != PLAIN and element.tag not in ("html", "body", "main", "article")


def _inside(element: Element) -> Iterator[Element]:
    return (p for p in element.parts if isinstance(p, Element) and not p.skipped)


def _skip_marked(root: Element) -> None:
    """Skips marked elements, but not those without which the page loses its article.

    Such are the one that holds most of the text of article and main while no unmarked one has any
    (if its names do not speak of others' articles), and the one that holds most of the page's text, if its names speak for an article too, or if it
    has headings or paragraphs and all unmarked text is next to nothing.
    """
    order, waiting = [], [(root, False)]
    while waiting:
        node, linked = waiting.pop()
        order.append((node, linked))
        waiting += [(p, linked or p.tag == "a") for p in _inside(node)]
    # of each element: text, text outside marks, text of articles, that outside marks, any block
    sums: dict[int, tuple[int, int, int, int, bool]] = {}
    for node, linked in reversed(order):
        text = 0 if linked else sum(len(p.strip()) for p in node.parts if isinstance(p, str))
        plain, core, plain_core = text, 0, 0
        block = bool(text) and (node.tag == "p" or node.tag in HEADINGS)
        for part in _inside(node):
            t, p, c, pc, b = sums[id(part)]
            text, core, block = text + t, core + c, block or b
            if not _cuttable(part):
                plain, plain_core = plain + p, plain_core + pc
        if node.tag in ("article", "main") and node.mark == PLAIN:
            core, plain_core = text, plain
        block = block or bool(text) and (node.tag == "p" or node.tag in HEADINGS)
        sums[id(node)] = text, plain, core, plain_core, block
    total, plain, all_core, plain_core, _ = sums[id(root)]
    waiting = [root]
    while waiting:
        node = waiting.pop()
        for part in _inside(node):
            if _cuttable(part):
                t, p, c, pc, block = sums[id(part)]
                holds_core = part.mark != OTHERS and not plain_core and 2 * c > all_core
                holds_text = 2 * t > total and (part.mark == MIXED
                                                or block and OUTWEIGHS * plain < t)
                if not holds_core and not holds_text:
                    part.skipped = True
                    continue
                plain, plain_core = plain + p, plain_core + pc
            waiting.append(part)


def _measure(element: Element, linked: bool) -> None:
    """Gives each element below the lengths of its text outside and inside links."""
    size = links = 0
    for part in element.parts:
        if part is None:
            continue
        if isinstance(part, str):
            if linked:
                links += len(part.strip())
            else:
                size += len(part.strip())
        elif not part.skipped:
            _measure(part, linked or part.tag == "a")
            size, links = size + part.size, links + part.links
    element.size, element.links = size, links


def _headed(element: Element) -> bool:
    return any(p.size and (p.tag in HEADINGS or _headed(p)) for p in _inside(element))


def _boilerplate_beside(node: Element, top: Element) -> bool:
    """True if a container holds no heading, paragraph or further text outside a child.

    Children on the same path are taken with it. Lists of links are boilerplate.
    """
    rest = 0
    for part in node.parts:
        if isinstance(part, str):
            rest += len(part.strip())
        elif part is not None and not part.skipped and part.size and part.step != top.step:
            if part.tag == "p" or part.tag in HEADINGS:
                return False
            if part.links <= part.size:
                if _headed(part):
                    return False
                rest += part.size
    return rest < SENTENCE


def best_container(root: Element) -> Element:
    """From the root down to the child that holds most of the text, while all else is boilerplate
    and no article or main is reached."""
    _measure(root, False)
    node = root
    while node.tag not in ("article", "main"):
        children = [p for p in _inside(node)
                    if p.tag not in INLINE and p.tag not in ARTICLE_BLOCKS]
        top = max(children, key=lambda e: e.size, default=None)
        if (top is None or not top.size or top.size < DOMINANT * node.size
                or not _boilerplate_beside(node, top)):
            return node
        node = top
    return node


def elements_on(root: Element, path: str) -> list[Element]:
    """Topmost elements on a path, in page order."""
    out, waiting, steps = [], [(root, 0)], path.split("/")
    while waiting:
        node, depth = waiting.pop()
        if node.step != steps[depth]:
            continue
        if depth + 1 == len(steps):
            out.append(node)
            continue
        waiting += [(p, depth + 1) for p in reversed(node.parts)
                    if isinstance(p, Element) and not p.skipped]
    return out


def block_text(elements: list[Element]) -> str:
    """Text of the blocks in page order, white space as one space."""
    pieces: list[str] = []

    def walk(element: Element) -> None:
        block = element.tag not in INLINE
        if block:
            pieces.append(" ")
        for part in element.parts:
            if part is None:
                pieces.append(" ")
            elif isinstance(part, str):
                pieces.append(unescape(part) if "&" in part else part)
            elif not part.skipped:
                walk(part)
            elif part.tag not in INLINE:
                pieces.append(" ")
        if block:
            pieces.append(" ")

    for element in elements:
        walk(element)
    return " ".join("".join(pieces).split())


#: Depth below which elements count as their parent's text; keeps recursion bounded.
DEEPEST = 200


def page_tree(html: str) -> Element:
    root = parse(html)
    waiting = [(root, 0)]
    while waiting:
        node, depth = waiting.pop()
        if depth >= DEEPEST:
            node.parts = _spliced(node)
            continue
        waiting += [(p, depth + 1) for p in node.parts if isinstance(p, Element)]
    return root


def _spliced(element: Element) -> list:
    """All text below an element, without the elements."""
    out: list = []
    waiting = list(reversed(element.parts))
    while waiting:
        part = waiting.pop()
        if not isinstance(part, Element):
            out.append(part)
        elif not part.skipped:
            if part.tag not in INLINE:
                out.append(None)
                waiting.append(None)
            waiting += reversed(part.parts)
    return out


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums and numbers of the pages' votes for each host and path of a task."""
    totals: dict[tuple[str, str], float] = defaultdict(float)
    counts: dict[tuple[str, str], int] = defaultdict(int)

    def rows() -> pa.RecordBatch:
        hosts, paths = zip(*totals, strict=True) if totals else ((), ())
        return pa.RecordBatch.from_arrays(
            [pa.array(hosts, pa.string()), pa.array(paths, pa.string()),
             pa.array(totals.values(), pa.float64()), pa.array(counts.values(), pa.int64())],
            names=["host", "path", "votes", "n"])

    for batch in batches:
        for host, html in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                              strict=True):
            root = page_tree(html)
            best = best_container(root)
            if best.size:
                vote = host, best.path()
                totals[vote] += best.size / root.size
                counts[vote] += 1
        if len(totals) > 100_000:
            yield rows()
            totals.clear()
            counts.clear()
    yield rows()


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for html, path in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(),
                              strict=True):
            if not html:
                texts.append("")
                continue
            root = page_tree(html)
            chosen = elements_on(root, path) if path is not None else []
            text = block_text(chosen) if chosen else ""
            texts.append(text or block_text(elements_on(root, best_container(root).path())))
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[2:], pa.array(texts, pa.string())],
            names=[*batch.schema.names[2:], "text"])


def extract_text(df: DataFrame, html_column: str = "html", url_column: str = "url",
                 keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """The columns of ``keep`` and the main text of each page.

    Host paths are voted over all pages of the table. Null, empty or textless pages give ''. Pages
    without a URL or host vote together. Broken markup is read leniently: an unclosed comment or
    script runs to the end of the page; elements below a depth of 200 are text of the one there.
    Repeated rows vote each and get equal texts. An empty
    table gives an empty table. A column of ``keep`` named ``text`` is replaced.
    """
    keep = tuple(c for c in keep if c.lower() != "text")
    names = {c: f"k{i}" for i, c in enumerate(keep)}
    pages = df.select(quoted(html_column).alias("html"), host_of(quoted(url_column)).alias("host"),
                      *[quoted(c).alias(n) for c, n in names.items()])
    votes = (pages.where(F.length("html") > 0).select("host", "html")
             .mapInArrow(_votes, "host string, path string, votes double, n long")
             .groupBy("host", "path").agg(F.round(F.sum("votes"), 6).alias("votes"),
                                          F.sum("n").alias("n")))
    # written once, as the paths of large hosts are broadcast and those of others are joined
    winners = materialise(votes.groupBy("host").agg(
        F.max_by("path", F.struct("votes", "path")).alias("path"), F.sum("n").alias("n")))
    found = lookup_join(pages, winners, "host", "n")
    types = {f.name: f.dataType for f in df.schema}
    schema = T.StructType([T.StructField(n, types[c]) for c, n in names.items()]
                          + [T.StructField("text", T.StringType())])
    return (found.select("html", "path", *names.values()).mapInArrow(_extract, schema)
            .select(*[F.col(n).alias(c) for c, n in names.items()], "text"))


def page_texts(df: DataFrame) -> DataFrame:
    return extract_text(df).withColumn("n_chars", F.char_length("text").cast("long"))
