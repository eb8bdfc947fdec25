"""Main text of web pages from flat text blocks.

The markup is cut into blocks of text at every element that starts a new line.  Each block is described by its
words and link density, those of its neighbours, and the kind of container it stands in; a decision
tree trained on a small labelled table keeps or drops it.  Every page is handled alone: nothing is
shuffled or collected.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from panelcast.llm.common import ship

# fixed values: elements of HTML
INLINE = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt ruby "
             "s samp small span strike strong sub sup time tt u var wbr".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = set("script style noscript template title textarea select option button iframe object svg math canvas audio video "
             "head datalist".split())
BOILER = set("nav footer aside form menu dialog header".split())
CONTENT = set("article main".split())
BOILER_HINTS = set("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments "
                   "consent cookie cookies copyright disqus footer gdpr header login masthead menu nav navbar navigation newsletter notice "
                   "notices popup promo promoted related reply replies respond share sharing sidebar signup social sponsor "
                   "sponsored subscribe tags toolbar widget complementary contentinfo alert".split())
MENU_HEADINGS = set("follow menu navigation recommended related share tags topics".split())
CONTENT_HINTS = set("article body content entry main post story text".split())

_NAME = re.compile(r"[A-Za-z][^\s/>]*")
_SPECIAL = re.compile(r"""[>"']""")
_ATTR = re.compile(r"""(?<![A-Za-z-])([A-Za-z-]+)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""")
_RAW = {t: re.compile(rf"</{t}\s*>", re.I) for t in ("script", "style", "textarea", "title", "noscript", "iframe", "svg", "template", "select", "button")}
_HIDDEN = re.compile(r"(?:^|\s)hidden(?:\s|=|/|$)|display\s*:\s*none|visibility\s*:\s*hidden|aria-hidden\s*=\s*[\"']?true", re.I)


@dataclass
class Block:
    text: str
    words: int
    link_words: int
    zone: int  # 1 inside the article, -1 inside menus, footers and the like, 0 unknown

    @property
    def density(self) -> float:
        return self.link_words / self.words if self.words else 0.0


#: Kinds of container besides 1 and 0: content in a container named by a hint, a container of which a hint is only part of a
#: name (has-sidebar, no-comments), one named by a hint (sidebar), and one whose element or style is final.
CLAIMED, TOUCHED, NAMED, FINAL = 2, -1, -2, -3


def _zone(tag: str, attrs: str, above: int) -> int:
    """FINAL holds for all that is inside.  In a hinted container, <article>, <main> and content hints start content
    again, in one named by a hint only as a claim, which counts if the page has no other content.  1 holds until a menu or the like comes."""
    if above == FINAL or (attrs and _HIDDEN.search(attrs)):
        return FINAL
    heading = tag == "header" and above > 0
    if tag in BOILER and not heading:
        return FINAL
    bad, good, first, named = set(), set(), False, False
    if attrs and tag not in ("html", "body"):
        for m in _ATTR.finditer(attrs):
            if m[1].lower() in ("class", "id", "role"):
                for name in (m[2] or m[3] or m[4] or "").lower().split():
                    hints = [h for h in re.split(r"[^a-z]+", name) if h]
                    bad.update(BOILER_HINTS.intersection(hints))
                    good.update(CONTENT_HINTS.intersection(hints))
                    first |= bool(hints) and hints[0] in BOILER_HINTS
                    named |= bool(hints) and BOILER_HINTS.issuperset(hints)
    if bad and not good and not heading and tag != "main" and (first or tag != "article"):
        return NAMED if named or above in (NAMED, CLAIMED) else TOUCHED
    if not (tag in CONTENT or (good and not bad)) or (above < 0 and bad and first and tag != "main"):
        return above
    return CLAIMED if above in (NAMED, CLAIMED) and tag != "main" else 1


def tag_reader(page: str):
    """A function that gives (start, end, closing, name, attributes) of the first tag, comment or declaration from a place on, or None; name is
    empty for the latter two.  The places asked for must not go back.

    A tag ends at the first > outside quotes; a < that begins none is text.  No stretch is read more than a few times, however broken the
    markup: what a tag without an end has met is remembered, and a later one that meets it again ends there too."""
    last = {c: page.rfind(c) for c in ">\"'"}
    dead: set[int] = set()                # quotes opened by tags without an end
    seen_from, seen = 0, -1               # no special character from seen_from up to seen

    def end_of(pos: int) -> int:
        nonlocal seen_from, seen
        met = []
        while pos <= last[">"]:
            if not seen_from <= pos <= seen:
                seen_from, seen = pos, _SPECIAL.search(page, pos).start()
            if page[seen] == ">":
                return seen + 1
            if seen in dead or seen >= last[page[seen]]:
                break
            met.append(seen)
            pos = page.index(page[seen], seen + 1) + 1
        dead.update(met)
        return 0

    def next_tag(at: int):
        while (at := page.find("<", at)) >= 0:
            if page.startswith("<!--", at):
                end = page.find("-->", at + 4)
                return at, end + 3 if end >= 0 else len(page), False, "", ""
            if last[">"] < at:                # only an open comment needs no >
                at += 1
                continue
            closing = page.startswith("/", at + 1)
            name = _NAME.match(page, at + 1 + closing)
            if name and (end := end_of(name.end())):
                return at, end, closing, name[0].lower(), page[name.end():end - 1]
            if page[at + 1:at + 2] in ("!", "?"):
                return at, page.index(">", at) + 1, False, "", ""
            at += 1
        return None

    return next_tag


def blocks(page: str) -> list[Block]:
    """The blocks of text of a page in order, references decoded and white space made one space."""
    out: list[Block] = []
    parts: list[str] = []
    linked: list[str] = []
    stack: list[tuple[str, int]] = []
    depth: Counter = Counter()            # open elements by name
    in_link, at = False, 0

    def close():
        text = " ".join("".join(parts).split())
        if text:
            out.append(Block(text, len(text.split()), len("".join(linked).split()), stack[-1][1] if stack else 0))
        parts.clear()
        linked.clear()

    def say(raw: str):
        if raw:
            text = html.unescape(raw)
            parts.append(text)
            if in_link:
                linked.append(text + " ")

    next_tag = tag_reader(page)
    while found := next_tag(at):
        start, end, closing, tag, attrs = found
        say(page[at:start])
        at = end
        if not tag:
            continue
        if tag == "a":
            in_link = not closing
            continue
        if tag in _RAW and not closing:
            raw_end = _RAW[tag].search(page, at)
            at = raw_end.end() if raw_end else len(page)
            if tag in ("button", "select", "svg"):
                parts.append(" ")
            continue
        if tag in INLINE:
            if tag in ("br", "img"):
                parts.append(" ")
            continue
        close()
        in_link = False
        if tag in VOID or tag in ("p", "li", "dt", "dd", "tr", "td", "th", "html", "body"):
            if tag == "body" and not closing:
                stack.clear()
                depth.clear()
            continue
        above = stack[-1][1] if stack else 0
        if closing:
            while depth[tag]:
                depth[stack[-1][0]] -= 1
                if stack.pop()[0] == tag:
                    break
        elif not attrs.endswith("/"):
            stack.append((tag, FINAL if tag in UNSEEN else _zone(tag, attrs, above)))
            depth[tag] += 1
    if at < len(page):
        rest = page[at:]
        say(rest if not re.match(r"<[A-Za-z/!]", rest) else "")
    close()
    claimed = -1 if any(b.zone == 1 for b in out) else 1
    for b in out:
        b.zone = claimed if b.zone == CLAIMED else max(b.zone, -1)
    _menus(out)
    return out


def _menus(bs: list[Block]) -> None:
    """Rows of links in an article are of a menu if their neighbours say so: a heading of one, or, without any heading
    before them, three or more links of at most three words each."""
    edge, at = Block("", 0, 0, 0), 0
    while at < len(bs):
        end = at
        while end < len(bs) and bs[end].zone == 1 and bs[end].density >= 1:
            end += 1
        if end > at:
            before = bs[at - 1] if at else edge
            heading = 0 < before.words <= 6 and before.zone == 1
            if (MENU_HEADINGS.intersection(re.findall(r"[a-z]+", before.text.lower())) if heading else
                    end - at >= 3 and all(b.words <= 3 for b in bs[at:end])):
                for b in bs[at:end]:
                    b.zone = -1
        at = max(end, at + 1)


FEATURES = ("zone", "words", "density", "words_before", "density_before", "words_after", "density_after")


def features(bs: list[Block]) -> list[tuple]:
    edge = Block("", 0, 0, 0)
    if not bs:
        return []
    return [(b.zone, b.words, b.density, p.words, p.density, n.words, n.density)
            for p, b, n in zip([edge, *bs[:-1]], bs, [*bs[1:], edge], strict=True)]


#: The labelled table: the features in the order of FEATURES, then 1 for a block of the main text.
LABELLED = [
    # inside an article: long and short paragraphs, headings, captions, paragraphs with links
    (1, 60, 0.0, 8, 0.0, 45, 0.0, 1), (1, 8, 0.0, 0, 0.0, 60, 0.0, 1), (1, 1, 0.0, 30, 0.0, 25, 0.0, 1),
    (1, 3, 0.0, 2, 0.0, 80, 0.1, 1), (1, 25, 0.3, 40, 0.0, 12, 0.0, 1), (1, 5, 0.4, 30, 0.0, 30, 0.0, 1),
    (1, 12, 0.0, 5, 1.0, 0, 0.0, 1), (1, 2, 0.0, 3, 1.0, 9, 0.0, 1), (1, 40, 0.05, 6, 0.8, 7, 0.0, 1),
    (1, 1, 0.0, 1, 0.0, 1, 0.0, 1), (1, 4, 0.0, 9, 0.0, 6, 0.0, 1), (1, 18, 0.6, 30, 0.0, 22, 0.0, 1),
    (1, 3, 0.0, 3, 0.0, 4, 0.0, 1), (1, 2, 0.0, 3, 1.0, 2, 1.0, 1), (1, 1, 0.0, 0, 0.0, 0, 0.0, 1),
    (1, 3, 0.0, 40, 0.0, 3, 0.9, 1), (1, 9, 0.0, 4, 0.9, 3, 1.0, 1), (1, 3, 0.5, 3, 0.0, 2, 0.0, 1),
    (1, 2, 0.0, 1, 1.0, 3, 0.0, 1), (1, 6, 0.0, 12, 0.0, 2, 0.0, 1), (1, 15, 0.0, 2, 0.0, 2, 0.0, 1),
    (1, 3, 0.0, 0, 0.0, 9, 0.0, 1), (1, 11, 0.2, 1, 0.0, 1, 0.0, 1), (1, 4, 0.0, 14, 0.0, 1, 1.0, 1),
    # inside an article: linked headings, bylines and references
    (1, 6, 1.0, 0, 0.0, 40, 0.0, 1), (1, 2, 1.0, 6, 1.0, 45, 0.0, 1), (1, 3, 1.0, 40, 0.0, 3, 1.0, 1),
    (1, 2, 1.0, 3, 1.0, 2, 1.0, 1), (1, 9, 1.0, 8, 1.0, 7, 1.0, 1), (1, 4, 1.0, 3, 1.0, 0, 0.0, 1),
    # short rows of links that show a menu
    (-1, 3, 1.0, 40, 0.0, 3, 1.0, 0), (-1, 2, 1.0, 3, 1.0, 2, 1.0, 0), (-1, 4, 1.0, 3, 1.0, 0, 0.0, 0),
    # inside menus, footers, sidebars, adverts, forms, comments
    (-1, 1, 1.0, 0, 0.0, 1, 1.0, 0), (-1, 2, 1.0, 1, 1.0, 9, 0.0, 0), (-1, 9, 0.0, 1, 1.0, 12, 0.0, 0),
    (-1, 30, 0.0, 2, 0.0, 3, 0.0, 0), (-1, 14, 0.0, 45, 0.0, 0, 0.0, 0), (-1, 80, 0.0, 60, 0.0, 70, 0.0, 0),
    (-1, 5, 0.5, 40, 0.0, 0, 0.0, 0), (-1, 22, 0.1, 22, 0.1, 25, 0.0, 0), (-1, 12, 0.0, 50, 0.0, 1, 1.0, 0),
    (-1, 45, 0.0, 4, 0.0, 4, 0.0, 0), (-1, 3, 0.0, 30, 0.0, 50, 0.0, 0), (-1, 18, 0.9, 1, 1.0, 1, 1.0, 0),
    # no known container: hand-made rows; those below are of kinds
    (0, 50, 0.0, 40, 0.0, 60, 0.0, 1), (0, 70, 0.1, 3, 1.0, 30, 0.0, 1), (0, 25, 0.0, 50, 0.0, 4, 0.0, 1),
    (0, 30, 0.2, 6, 0.0, 20, 0.0, 1), (0, 7, 0.0, 30, 0.0, 45, 0.0, 1), (0, 6, 0.0, 2, 1.0, 40, 0.0, 1),
    (0, 2, 1.0, 1, 1.0, 2, 1.0, 0), (0, 3, 1.0, 2, 1.0, 30, 0.0, 0), (0, 12, 0.9, 4, 1.0, 5, 1.0, 0),
    (0, 30, 0.9, 10, 0.8, 8, 1.0, 0), (0, 8, 0.6, 30, 0.0, 4, 0.8, 0), (0, 40, 0.7, 3, 1.0, 3, 1.0, 0),
]

#: Neighbours (words and density before and after): of text, of links, of the edge of a page.
_TEXT, _LINE, _LINKS, _EDGE = (45, 0.0), (4, 0.0), (2, 1.0), (0, 0.0)
_NEAR = [(b, a) for b in (_TEXT, _LINE, _LINKS, _EDGE) for a in (_TEXT, _LINE, _LINKS, _EDGE)]
# inside of known containers the kind of container decides, whatever the neighbours are
LABELLED += [(zone, w, d, *b, *a, int(zone > 0)) for zone in (1, -1) for w in (1, 6, 12, 28, 120)
             for d in (0.0, 0.3, 0.7, 1.0) for b, a in _NEAR]
# outside of known containers: text of a line or more stays whatever stands beside it, also first, last, alone or with some links
LABELLED += [(0, w, d, *b, *a, 1) for w in (12, 28, 120) for d in (0.0, 0.3) for b, a in _NEAR]
# most words linked: menus and lists of links
LABELLED += [(0, w, d, *b, *a, 0) for w in (1, 12, 28) for d in (0.7, 1.0) for b, a in _NEAR]
# short text: headings, lines and captions stay; the label before a list of links, and the line behind one at the end, go
LABELLED += [(0, w, 0.0, *b, *a, int(a != _LINKS and (b, a) != (_LINKS, _EDGE))) for w in (1, 6) for b, a in _NEAR]


def train(rows=LABELLED, depth: int = 9):
    """A decision tree on the labelled rows: (feature, threshold, low branch, high branch) or a label."""
    labels = [r[-1] for r in rows]
    ones = sum(labels)
    if depth == 0 or ones in (0, len(rows)):
        return int(2 * ones >= len(rows))

    def gini(part):
        p = sum(r[-1] for r in part) / len(part)
        return len(part) * 2 * p * (1 - p)

    best = None
    for f in range(len(rows[0]) - 1):
        values = sorted({r[f] for r in rows})
        for lo, hi in zip(values, values[1:], strict=False):
            cut = (lo + hi) / 2
            low, high = [r for r in rows if r[f] <= cut], [r for r in rows if r[f] > cut]
            score = gini(low) + gini(high)
            if best is None or score < best[0] - 1e-12:
                best = (score, f, cut, low, high)
    if best is None:
        return int(2 * ones >= len(rows))
    return best[1], best[2], train(best[3], depth - 1), train(best[4], depth - 1)


def classify(tree, row) -> int:
    while isinstance(tree, tuple):
        tree = tree[2] if row[tree[0]] <= tree[1] else tree[3]
    return tree


def main_text(page: str | None, tree) -> str:
    bs = blocks(page or "")
    return "\n\n".join(b.text for b, row in zip(bs, features(bs), strict=True) if classify(tree, row))


def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html; others are ignored).

    Null and empty pages, and pages without any main text, give the empty text; an empty table gives an empty one.  Broken markup is read
    as far as it goes, and the time grows with the length of a page whatever stands in it.  Repeated rows come out alike."""
    ship(pages.sparkSession)
    tree = train()

    def run(batches):
        for b in batches:
            texts = [main_text(x.as_py(), tree) for x in b.column(2)]
            yield pa.record_batch([b.column(0), b.column(1), pa.array(texts, pa.string()),
                                   pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])

    p = pages.select("page_id", "url", "html")
    kind = p.schema["page_id"].dataType.simpleString()
    return p.mapInArrow(run, f"page_id {kind}, url string, text string, n_chars bigint")


def query(spark, sf_dir: str) -> DataFrame:
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
