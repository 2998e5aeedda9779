"""Main text of web pages: the best contiguous run of words, by a maximum-scoring subsequence.

A page is read as a sequence of words and tags. Elements that cannot be the article (navigation, forms, scripts, adverts, comments
and the like, by tag, role or class) leave it first. Of the rest each word scores positive and each tag negative, with
weights learned from labelled pages: pages whose own markup names the article are the labels. One linear scan finds the
contiguous region of the largest total. If that region lies mostly in an element that names itself the article, the region
is set to that element, so short first and last paragraphs are not lost. Its blocks are the text.

Character references are decoded, white space within a block becomes one space, blocks are trimmed and joined by an empty line.
``<br>`` is white space. Elsewhere the region grows to the element that holds it, if that adds little.

Learning reads at most ``LABELLED_PAGES`` pages, chosen by hash of their ids. Weights without labels: 1 for a word (0.5 in a link), and
for a tag a share of -3.25, small for the tags that articles are made of.

Defined results: a NULL or empty html, or one without a word, has the empty text; a tag that the page's end cuts off is no text;
unclosed elements end with their parents; repeated rows are extracted alike; an empty table gives an empty result. Only ``page_id``,
``url`` and ``html`` are read, so other columns cannot clash. A page is handled on its own; a very long or deeply nested one costs time in
proportion to its length and memory for itself.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.common import travels

LABELLED_PAGES = 500
WORD, TAG = 1.0, -3.25  # weights where nothing is known
PRIOR = 20.0  # words or tags that the weights without labels count for
MOST_TITLE_WORDS = 4  # of a heading that names a section of comments
MOST_ADDED = 0.25  # of the region's words that its own container may add

travels(__name__)

RAW = "script|style|textarea|title|noscript|template|iframe|noembed|noframes|xmp"
TOKEN = re.compile(
    rf"""<!--.*?(?:--!?>|\Z)
    |<(?P<raw>{RAW})(?=[\s/>])[^>]*+>.*?(?:</(?P=raw)\s*+>|\Z)
    |<(?P<close>/?)(?P<name>[a-zA-Z][^\s/>]*+)(?P<attrs>(?>[^>"']++|"[^"]*+"|'[^']*+')*+)>
    |<(?P<close2>/?)(?P<name2>[a-zA-Z][^\s/>]*+)(?P<attrs2>[^>]*+)(?:>|\Z)
    |<[!?/][^>]*+(?:>|\Z)""",
    re.S | re.I | re.X,
)
ATTRIBUTE = re.compile(r"""([a-zA-Z_:][\w:.-]*+)\s*+(?:=\s*+("[^"]*+"|'[^']*+'|[^\s"'>]++))?""")
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|\d+")

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label map mark q rp rt ruby s samp small span "
    "strike strong sub sup time tt u var wbr br "
    "math mfrac mi mn mo mover mpadded mroot mrow ms mspace msqrt mstyle msub msubsup msup mtable mtd mtext mtr munder munderover semantics".split()
)
#: Elements that are never part of an article.
NEVER = frozenset(
    "head nav footer aside form menu select button dialog object embed svg canvas audio video map applet datalist fieldset "
    "frameset".split()
)
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alertdialog alert status form menu menubar toolbar tablist note".split()
)
#: Parts of a class or id that say what an element is, if it is not the article.
NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising adsense adbox adslot sponsor sponsored sponsors promo promos promotion "
    "cookie cookies consent gdpr notice notices popup modal overlay lightbox newsletter subscribe subscription signup login "
    "sidebar sidebars nav navbar navigation menu menus breadcrumb breadcrumbs footer header masthead topbar toolbar social "
    "share sharing related recommended recommendations widget widgets pagination pager banner alert toast disclaimer copyright "
    "outbrain taboola hidden skip".split()
)
TALK = frozenset("comment comments commentlist disqus respond reply replies discussion".split())
#: Words of a heading that begins the readers' comments, besides one of the first ones and numbers.
TALK_HEADINGS = frozenset("comment comments reply replies respond response responses".split())
WITH_TALK = frozenset("a add all and as discuss discussion join latest leave load new newest no on our post reader readers recent s show the this to view write yet your".split())
#: Names that also describe what an article is about; within one they only count where links prevail or little is said.
SOFT = frozenset("share sharing social related recommended recommendations discussion".split())
#: What closes what when an end tag is left out.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
SCOPES = frozenset("div section article main nav header footer aside td th li blockquote form table ul ol dl body figure".split())


@dataclass
class Element:
    name: str
    never: bool = False  # by its tag, role or attributes
    named: bool = False  # by its class or id
    talk: bool = False
    soft: bool = False  # named by such words alone
    article: bool = False
    parent: int = -1
    holds_article: bool = False
    words: int = 0
    linked: int = 0  # words in links


@dataclass
class Page:
    """Elements; runs ``(element, block, context, words)`` and tags ``(name, element)`` in page order; the text of each block."""

    elements: list[Element] = field(default_factory=list)
    items: list[tuple] = field(default_factory=list)
    blocks: list[list[str]] = field(default_factory=list)


def describe(name: str, attrs: str) -> Element:
    found = Element(name, never=name in NEVER, article=name in ("article", "main"))
    if attrs and not attrs.isspace() and name not in ("html", "body"):
        values = {k.lower(): (v[1:-1] if v[:1] in ("'", '"') else v) for k, v in ATTRIBUTE.findall(attrs)}
        role = values.get("role", "").lower()
        style = values.get("style", "").replace(" ", "").lower()
        hidden = "hidden" in values or values.get("aria-hidden") == "true" or "display:none" in style or "visibility:hidden" in style
        found.never = found.never or hidden or role in ROLES
        found.article = found.article or role in ("main", "article") or values.get("itemprop", "").lower() == "articlebody"
        parts = {p.lower() for p in PARTS.findall(f"{values.get('class', '')} {values.get('id', '')}")}
        found.talk = not parts.isdisjoint(TALK)
        found.named = found.talk or (name != "main" and not parts.isdisjoint(NAMES))
        found.soft = found.named and parts.isdisjoint((NAMES | TALK) - SOFT)
    return found


def begins_talk(heading: str) -> bool:
    """Whether a heading says that readers' comments follow, as in "3 comments" or "Leave a reply"."""
    words = PARTS.findall(heading.lower())
    said = [w for w in words if not w.isdigit()]
    return len(words) <= MOST_TITLE_WORDS and not TALK_HEADINGS.isdisjoint(said) and all(w in TALK_HEADINGS or w in WITH_TALK for w in said)


def parse(source: str) -> Page:
    """The page in one pass; what a step needs to know of the open elements is kept with them, not searched for."""
    page = Page([Element("#page")])
    stack, kinds, near = [0], ["#page"], [0]  # open elements, their closest blocks, and the closest level that may end a paragraph
    opened: Counter = Counter(["#page"])
    block: list[str] | None = None
    at = 0

    def text(part: str) -> None:
        nonlocal block
        words = entities.unescape(part) if "&" in part else part
        count = len(words.split())
        if block is None:
            if not count:
                return
            block = []
            page.blocks.append(block)
        block.append(words)
        if count:
            linked = "a" in [page.elements[e].name for e in stack[-3:]]
            page.items.append((stack[-1], len(page.blocks) - 1, (kinds[-1], linked), count))
            if kinds[-1] in HEADINGS and count <= MOST_TITLE_WORDS and begins_talk(words):
                level = near[-1]
                if level and page.elements[stack[level]].name in HEADINGS:
                    # All that follows in the heading's container, which itself stays what it is.
                    above = page.elements[stack[level - 1]]
                    page.elements.append(Element(above.name, named=True, talk=True, parent=stack[level - 1]))
                    stack[level - 1] = len(page.elements) - 1
                    page.elements[stack[level]].parent = stack[level - 1]

    def push(element: int) -> None:
        name = page.elements[element].name
        stack.append(element)
        opened[name] += 1
        kinds.append(kinds[-1] if name in INLINE else name)
        near.append(len(stack) - 1 if name == "p" or name in HEADINGS or name in SCOPES else near[-1])

    def pop_to(place: int) -> None:
        for e in stack[place:]:
            opened[page.elements[e].name] -= 1
        del stack[place:], kinds[place:], near[place:]

    for found in TOKEN.finditer(source):
        if found.start() > at:
            text(source[at : found.start()])
        at = found.end()
        name = (found["name"] or found["name2"] or "").lower()
        if not name:
            if found["raw"]:
                page.items.append((found["raw"].lower(), stack[-1]))
            continue
        page.items.append((name, stack[-1]))
        if name == "br":
            if block is not None:
                block.append(" ")
            continue
        if name not in INLINE:
            block = None
        if found["close"] or found["close2"]:
            if opened[name]:
                pop_to(next(k for k in range(len(stack) - 1, 0, -1) if page.elements[stack[k]].name == name))
            continue
        if name in VOID:
            continue
        if name not in INLINE:  # a block ends an open paragraph
            k = near[-1]
            while k > 0:
                inside = page.elements[stack[k]].name
                if inside == "p" or (inside in HEADINGS and name in HEADINGS):
                    pop_to(k)
                    break
                if inside in SCOPES:
                    break
                k = near[k - 1]
        if name in CLOSES:
            same, scope = CLOSES[name]
            for k in range(len(stack) - 1, 0, -1):
                inside = page.elements[stack[k]].name
                if inside in same:
                    pop_to(k)
                elif inside in scope:
                    break
        element = describe(name, found["attrs"] or found["attrs2"] or "")
        element.parent = stack[-1]
        if (found["attrs"] or "").endswith("/") and name in ("svg", "path", "use"):
            continue
        page.elements.append(element)
        push(len(page.elements) - 1)
    if at < len(source):
        text(source[at:])
    return page


def upwards(page: Page) -> list[int]:
    """The elements, each after all that are in it. A comment section stands after the heading that it was made for."""
    order, children = [], [[] for _ in page.elements]
    for i, e in enumerate(page.elements):
        if e.parent >= 0:
            children[e.parent].append(i)
    todo = [0]
    while todo:
        order.append(todo.pop())
        todo += children[order[-1]]
    return order[::-1]


def excluded(page: Page) -> list[bool]:
    """Which elements are no part of the article, with all that is in them.

    A class or id does not count if its element holds the article, or most words of the page; a form does not if it is most of it.
    """
    for item in page.items:
        if len(item) == 4:
            page.elements[item[0]].words += item[3]
            page.elements[item[0]].linked += item[3] * item[2][1]
    order = upwards(page)
    for i in order[:-1]:
        e = page.elements[i]
        above = page.elements[e.parent]
        above.words, above.linked = above.words + e.words, above.linked + e.linked
        above.holds_article = above.holds_article or e.holds_article or e.article
    out, in_article = [False] * len(order), [False] * len(order)
    total = page.elements[0].words
    for i in reversed(order):
        e = page.elements[i]
        above = e.parent >= 0 and out[e.parent]
        within = e.parent >= 0 and in_article[e.parent]
        most = 5 * e.words > 3 * total
        named = e.named and not e.holds_article and (e.talk or not e.article) and (e.talk or not most)
        if within and e.soft and e.words >= 15 and 2 * e.linked < e.words:
            named = False
        title = within and e.name in HEADINGS and page.elements[e.parent].name == "header" and not out[page.elements[e.parent].parent]
        never = e.never and not (e.name == "form" and (most or e.holds_article))
        # A header goes, but for the article's own title in it.
        out[i] = (above and not title) or never or named or e.name == "header"
        in_article[i] = within or (e.article and not out[i])
    return out


def owner_article(page: Page, out: list[bool]) -> list[int]:
    """For each element the outermost named article that it belongs to, or -1."""
    owner = [-1] * len(page.elements)
    for i in reversed(upwards(page)):
        e = page.elements[i]
        above = owner[e.parent] if e.parent >= 0 else -1
        # An article within a main element is the closer name, if it is the only one there.
        owner[i] = above if above >= 0 and not (page.elements[above].name == "main" and e.article) else i if e.article and not out[i] else above
    return owner


def label_counts(source: str) -> Counter:
    """``(feature, inside)`` counts of a labelled page; features are words by context, and tags."""
    page = parse(source)
    out = excluded(page)
    owner = owner_article(page, out)
    words = Counter()
    for item in page.items:
        if len(item) == 4 and not out[item[0]] and owner[item[0]] >= 0:
            words[owner[item[0]]] += item[3]
    counts: Counter = Counter()
    if not words:
        return counts
    best = words.most_common(1)[0][0]
    for item in page.items:
        run = len(item) == 4
        element = item[0] if run else item[1]
        if not out[element]:
            feature = f"w {item[2][0]} {int(item[2][1])}" if run else f"t {item[0]}"
            counts[(feature, owner[element] == best)] += item[3] if run else 1
    return counts


#: Tags that articles are made of; without labels they cost little.
CONTENT = HEADINGS | frozenset("p li ul ol blockquote pre dl dt dd table tbody tr td th figure figcaption".split()) | (INLINE - {"a", "input", "img"})


def weight(feature: str, inside: int = 0, outside: int = 0) -> float:
    """A word's weight is the share of such words inside the article, a tag's the share outside times ``TAG``."""
    kind, name, *link = feature.split()
    usual = (0.5 if link[0] == "1" else 1.0) if kind == "w" else 0.9 if name in CONTENT else 0.4
    share = (inside + PRIOR * usual) / (inside + outside + PRIOR)
    return WORD * share if kind == "w" else TAG * (1 - share)


KNOWN = (INLINE | NEVER | SCOPES | HEADINGS | VOID | frozenset("p pre html title #page header script style tr dt dd figcaption".split())) | set(RAW.split("|"))


def weights_from(counts: dict[tuple[str, bool], int]) -> dict[str, float]:
    return {f: weight(f, counts.get((f, True), 0), counts.get((f, False), 0)) for f in {f for f, _ in counts}}


def with_container(page: Page, region: list[tuple], runs: list[tuple]) -> list[tuple]:
    """The region with the rest of the smallest element that holds nine tenths of it, if that rest is small.

    Short blocks that are mostly links are not added.
    """
    inside = [0] * len(page.elements)
    for item in region:
        inside[item[0]] += item[3]
    order = upwards(page)
    for i in order[:-1]:
        inside[page.elements[i].parent] += inside[i]
    total = sum(item[3] for item in region)
    box = next(i for i in order if 10 * inside[i] >= 9 * total)  # what is in it comes before it
    if page.elements[box].name in ("#page", "html", "body"):
        return region
    wanted, links, sizes = {item[1] for item in region}, Counter(), Counter()
    for item in runs:
        sizes[item[1]] += item[3]
        links[item[1]] += item[3] * item[2][1]
    boxed = [False] * len(page.elements)
    for i in reversed(order):
        boxed[i] = i == box or (page.elements[i].parent >= 0 and boxed[page.elements[i].parent])
    more = [
        item for item in runs
        if boxed[item[0]] and item[1] not in wanted and (2 * links[item[1]] <= sizes[item[1]] or sizes[item[1]] >= 15)
    ]
    return region + more if sum(item[3] for item in more) <= MOST_ADDED * total else region


def score(item: tuple, weights: dict[str, float]) -> float:
    """The weight of a run of words or a tag."""
    feature = f"w {item[2][0]} {int(item[2][1])}" if len(item) == 4 else f"t {item[0]}"
    each = weights[feature] if feature in weights else weight(feature)
    return each * item[3] if len(item) == 4 else each


def best_range(page: Page, out: list[bool], weights: dict[str, float]) -> tuple[float, tuple[int, int] | None]:
    """The linear scan: the best sum that ends at an item either goes on from the one before or begins anew."""
    best, found, total, begin = 0.0, None, 0.0, 0
    for i, item in enumerate(page.items):
        if out[item[0] if len(item) == 4 else item[1]]:
            continue
        if total <= 0:
            total, begin = 0.0, i
        total += score(item, weights)
        if total > best:
            best, found = total, (begin, i)
    return best, found


def main_text(source: str | None, weights: dict[str, float]) -> str:
    page = parse(source or "")
    out = excluded(page)
    owner = owner_article(page, out)
    _, best = best_range(page, out, weights)
    if best is None:
        return ""
    runs = [(i, item) for i, item in enumerate(page.items) if len(item) == 4 and not out[item[0]]]
    region = [item for i, item in runs if best[0] <= i <= best[1]]
    words = Counter()
    for item in region:
        words[owner[item[0]]] += item[3]
    article, most = words.most_common(1)[0]
    if article >= 0 and 2 * most >= sum(words.values()):
        region = [item for _, item in runs if owner[item[0]] == article]
    else:
        region = with_container(page, region, [item for _, item in runs])
    wanted = {item[1] for item in region}
    texts = (" ".join("".join(page.blocks[b]).split()) for b in sorted(wanted))
    return "\n\n".join(t for t in texts if t)


def learned_weights(pages: DataFrame, bound: int = LABELLED_PAGES) -> dict[str, float]:
    marked = pages.where(F.col("html").rlike(r"(?i)<(article|main)\b|\brole\s*=\s*.?main\b|articleBody"))
    chosen = marked.select("page_id").distinct().orderBy(F.xxhash64("page_id"), "page_id").limit(bound)
    some = marked.select("page_id", "html").join(F.broadcast(chosen), "page_id").groupBy("page_id").agg(F.min("html").alias("html"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for source in batch.column(0).to_pylist():
                found = label_counts(source)
                counts.update({k: n for k, n in found.items() if k[0].split()[1] in KNOWN})
        keys = list(counts)
        columns = [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.bool_()), pa.array([counts[k] for k in keys], pa.int64())]
        yield pa.record_batch(columns, ["feature", "inside", "n"])

    parts = some.select("html").mapInArrow(run, "feature string, inside boolean, n bigint")
    return weights_from({(r[0], r[1]): r[2] for r in parts.groupBy("feature", "inside").agg(F.sum("n")).collect()})


def extracted(pages: DataFrame, bound: int = LABELLED_PAGES) -> DataFrame:
    """Rows ``(page_id, url, text, n_chars)``, one per page."""
    weights = learned_weights(pages, bound)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(source.as_py(), weights) for source in batch.column(2)]
            yield pa.record_batch(
                [batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                ["page_id", "url", "text", "n_chars"],
            )

    rows = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"))
    return rows.mapInArrow(run, "page_id bigint, url string, text string, n_chars bigint")
