"""Main text of web pages by the maximum-scoring subsequence of their tokens.

A page is a sequence of words and tags.  Words score positive, tags negative, and
one linear scan finds the contiguous region with the largest sum.  The weights are
learned from labelled pages: a tag costs more the more often it stands outside
the labelled content and outside boilerplate, tags inside boilerplate or named
content cost nothing on top, and an element that hardly ever does inside is boilerplate,
whose words count nothing and are left out of the text.

Pages are labelled where their own markup names the content (``article``, ``main``,
``role=main``, ``itemprop=articleBody``), or by a caller's labels; a bounded sample
is enough, and the weights then serve pages without such markup.

Defined results: a null or empty page, or one without words, has empty text; a tag
or reference that the end of the page cuts off is markup without text, or stays
as it is; an element without its end tag ends where HTML says, or with what is around it; repeated rows get equal results; of equal regions the first wins; other
columns pass through, those named like a result column give way.
"""

from __future__ import annotations

import html as _html
import re
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.llm.common import small_batches


#: labelled pages that the weights are learned from, at most about
LABELLED_PAGES = 4000
#: tags with fewer occurrences keep the weight of unknown tags
LEAST_SEEN = 3
#: scores: a word, a tag inside content, and what a tag outside costs on top
WORD, TAG, OUTSIDE = 1.0, 0.2, 3.0
#: what a list, table or link tag costs that is not learned
LISTED = 0.5
#: an element this often outside the labelled content is boilerplate, if seen so often
BOILERPLATE = 0.95
LEAST_BOILERPLATE = 20
#: an element with this share of a page's words is its content, whatever its names say
MOST = 2 / 3

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<![^>]*(?:>|\Z)|<\?[^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:_-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)(?:>|\Z)"
    r"|<(/?)([A-Za-z][A-Za-z0-9:_-]*)([^>]*)(?:>|\Z)",
    re.S,
)
_ATTRIBUTE = re.compile(r"([A-Za-z_:-]+)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+)")
_NAME = re.compile(r"[a-z]+")
_WHITE = re.compile(r"\s+")

# fixed values: HTML's element kinds
RAW = {"script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes", "noscript", "template"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
NEVER = RAW | {"head", "nav", "footer", "aside", "form", "button", "select", "option", "svg", "canvas", "object", "menu", "dialog", "label", "fieldset"}
#: never content, however many words they hold
SURE = NEVER - {"form", "fieldset", "label"}
BLOCK = set(
    "address article aside blockquote body caption center dd details div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "header hr html li main nav ol p pre section summary table tbody tfoot thead tr ul".split()
)
CONTENT = {"article", "main"}
LISTS = set("a ul ol li dl dt dd table caption thead tbody tfoot tr th td figure figcaption img".split())
PROSE = set("p br b i em strong span u q s cite small sub sup code pre blockquote h1 h2 h3 h4 h5 h6".split())
# fixed values: words of class, id and role that name what is not the article
NAMED = set(
    "ad ads advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments cookie cookies consent disclaimer disqus "
    "footer header masthead menu menubar modal nav navbar navigation newsletter notice notices notification pager pagination popup promo promoted "
    "related search share sharing sidebar sidenav social sponsor sponsored subscribe toolbar topbar widget widgets contentinfo complementary alert".split()
)
# fixed values: words that go with those in a name and tell nothing of their own
GENERIC = set(
    "area bar block bottom box btn button buttons col column container float inline inner item items left link links list mobile outer panel post posts "
    "right row section small text top unit wrap wrapper".split()
)
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
# fixed values: elements whose end tag may be left out, and the opening tags that end them
_ENDS_P = set(
    "address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section "
    "table ul".split()
)
_ENDS_CELL = {"td", "th", "tr", "tbody", "thead", "tfoot"}
ENDED_BY = {
    "p": _ENDS_P, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "td": _ENDS_CELL, "th": _ENDS_CELL, "tr": _ENDS_CELL - {"td", "th"},
    "option": {"option", "optgroup"}, "optgroup": {"optgroup"},
}


def _names(attributes: str) -> list[str]:
    """The words of an element's class, id and role."""
    out = []
    for k, v in _ATTRIBUTE.findall(attributes):
        if k.lower() in ("class", "id", "role"):
            out += _NAME.findall(v.lower())
    return out


def _says_boilerplate(attributes: str) -> bool:
    """Whether a class, role or whole id consists of listed words, with others at most
    that tell nothing.  Slugs of headings and compounds do not."""
    for k, v in _ATTRIBUTE.findall(attributes):
        if k.lower() in ("class", "id", "role"):
            for name in v.strip("\"'").lower().split():
                words = _NAME.findall(name)
                if any(w in NAMED for w in words) and all(w in NAMED or w in GENERIC for w in words):
                    return True
    return False


def _key(tag: str, names: list[str]) -> str:
    return tag if not names else f"{tag}.{names[0]}"


def tokens(page: str):
    """``(position, end, tag, closing, attributes)`` of every tag; contents of raw
    elements belong to their opening tag."""
    at = 0
    while True:
        m = _TOKEN.search(page, at)
        if m is None:
            return
        tag = (m[2] or m[5] or "").lower()
        closing, attributes, end = bool(m[1] or m[4]), m[3] or m[6] or "", m.end()
        if tag in RAW and not closing:
            stop = re.compile(rf"</{re.escape(tag)}\b[^>]*(?:>|\Z)", re.I).search(page, end)
            # an unclosed raw element ends the page
            end = stop.end() if stop else len(page)
        yield m.start(), end, tag, closing, attributes
        at = end


@dataclass
class Weights:
    """Per tag key the cost of the tag, and the keys of boilerplate elements."""

    cost: dict[str, float] = field(default_factory=dict)
    boilerplate: set[str] = field(default_factory=set)

    def of(self, key: str, tag: str) -> float:
        """Cost of a tag; one not learned costs little if it marks up prose or lists."""
        return self.cost.get(key, self.cost.get(tag, TAG if tag in PROSE else LISTED if tag in LISTS else TAG + OUTSIDE / 2))


def _is_boilerplate(tag: str, names: list[str], attributes: str, inside: bool, weights: Weights) -> bool:
    if tag in CONTENT or tag in ("html", "body"):
        return False
    if tag in NEVER:
        return True
    if inside and tag in HEADINGS:  # ids of headings repeat their text
        return False
    if _key(tag, names) in weights.boilerplate:
        return True
    if inside:
        return _says_boilerplate(attributes)
    return tag == "header" or any(n in NAMED for n in names)


class _Skipped:
    """The open elements of a skipped one, which says where it ends even if it or those
    in it have no end tags."""

    def __init__(self, tag: str):
        self.open = [tag]

    def ends(self, tag: str, closing: bool, leaf: bool, inside: bool) -> str:
        """What a tag does: "" (still inside), "with" it (its own end tag), or "before" it
        (a tag beside or around it)."""
        if closing:
            if tag in self.open:
                at = len(self.open) - 1 - self.open[::-1].index(tag)
                if tag in BLOCK or tag in NEVER or not at:
                    del self.open[at:]  # what is open in a block ends with it
                else:
                    del self.open[at]
                return "" if self.open else "with"
            # an end tag of something around it
            return "before" if self.open[0] in ENDED_BY and tag in BLOCK or tag in CONTENT and inside else ""
        if tag in CONTENT:
            return "before"  # it was never closed
        # the innermost element that may end without a tag, below inline ones only
        for at in range(len(self.open) - 1, -1, -1):
            if tag in ENDED_BY.get(self.open[at], ()):
                del self.open[at:]
                if not self.open:
                    return "before"
                break
            if self.open[at] in BLOCK or self.open[at] in NEVER:
                break
        if not leaf:
            self.open.append(tag)
        return ""


def _holds_most(found: list, page: str) -> set[int]:
    """Which opening tags of a page without named content hold most of its words."""
    if any(tag in CONTENT for _, _, tag, _, _ in found):
        return set()
    before, at, total, open_tags, ends = [], 0, 0, {}, {}
    for i, (start, end, tag, closing, _) in enumerate(found):
        total += len(page[at:start].split())
        before.append(total)
        at = end
        if closing and open_tags.get(tag):
            ends[open_tags[tag].pop()] = i
        elif not closing and tag not in VOID and tag not in RAW:
            open_tags.setdefault(tag, []).append(i)
    total += len(page[at:].split())
    unclosed = {i: None for left in open_tags.values() for i in left}
    return {i for i, j in (ends | unclosed).items() if (total if j is None else before[j]) - before[i] > MOST * total}


def _pieces(page: str, weights: Weights):
    """The page as ``(text, score, breaks)``: text between tags, None inside
    boilerplate, each followed by the score of the tag after it."""
    at, skip, inside = 0, None, 0
    found = list(tokens(page))
    most = _holds_most(found, page)
    for i, (start, end, tag, closing, attributes) in enumerate(found):
        text = page[at:start]
        yield (None if skip else text), 0.0, False
        at = end
        leaf = tag in VOID or tag in RAW or attributes.endswith("/")
        ends = skip.ends(tag, closing, leaf, inside > 0) if skip and tag else ""
        if ends == "before":
            skip, ends = None, ""
        names = _names(attributes) if attributes and not closing else []
        key = _key(tag, names)
        # tags of boilerplate inside are not the content's, and in named content no tag tells against it
        cost = 0.0 if skip and not ends else TAG if not tag or (inside and tag not in CONTENT) else weights.of(key, tag)
        yield None, -cost, tag in BLOCK
        if tag in ("br", "td", "th") and not skip:
            yield " ", 0.0, False
        if skip:
            skip = None if ends else skip
        elif tag in CONTENT:
            inside = max(0, inside + (-1 if closing else 1))
        elif tag and not closing and not leaf and not (i in most and tag not in SURE) and _is_boilerplate(tag, names, attributes, inside > 0, weights):
            skip = _Skipped(tag)
    if not skip:
        yield page[at:], 0.0, False


def best_region(scores: list[float]) -> tuple[int, int]:
    """Begin and end of the contiguous part with the largest sum above 0, the first of
    equal ones; empty if there is none."""
    best = total = 0.0
    first = begin = end = 0
    for i, score in enumerate(scores):
        if total + score <= 0:
            total, first = 0.0, i + 1
            continue
        total += score
        if total > best:
            best, begin, end = total, first, i + 1
    return begin, end


def extract(page: str | None, weights: Weights) -> str:
    """The text of the best contiguous region: its blocks joined by an empty line."""
    if not page:
        return ""
    pieces = list(_pieces(page, weights))
    begin, end = best_region([score if text is None else WORD * len(text.split()) for text, score, _ in pieces])
    blocks, current = [], []
    for text, _, breaks in pieces[begin:end]:
        if text is not None:
            current.append(text)
        if breaks:
            blocks.append("".join(current))
            current = []
    blocks.append("".join(current))
    clean = (_WHITE.sub(" ", _html.unescape(b)).strip() for b in blocks)
    return "\n\n".join(b for b in clean if b)


def labelled_counts(page: str) -> dict[str, list[int]]:
    """Of a page whose markup names one content element: per tag key how often it
    opens inside and outside of it.  Other pages give nothing."""
    spots = []
    for start, end, tag, closing, attributes in tokens(page):
        named = tag in CONTENT or (not closing and re.search(r"role\s*=\s*[\"']?main|itemprop\s*=\s*[\"']?articleBody", attributes))
        spots.append((start, tag, closing, _key(tag, _names(attributes)) if not closing else tag, bool(named)))
    opened = [i for i, s in enumerate(spots) if s[4] and not s[2]]
    if len(opened) != 1:
        return {}
    tag, depth, last = spots[opened[0]][1], 0, len(spots)
    for i in range(opened[0], len(spots)):
        if spots[i][1] == tag:
            depth += -1 if spots[i][2] else 1
            if not depth:
                last = i
                break
    out: dict[str, list[int]] = {}
    skip, depth = "", 0
    for i, (_, t, closing, key, named) in enumerate(spots):
        # tags below boilerplate tell nothing about those beside it
        if skip:
            if t == skip:
                depth += -1 if closing else 1
                skip = skip if depth else ""
            if skip and not (named and not closing):
                continue
            skip = ""
        elif t and not closing and not named and t not in VOID and t not in RAW and t in NEVER:
            skip, depth = t, 1
        if t and not closing and not named and t not in ("html", "body"):
            out.setdefault(key, [0, 0])[0 if opened[0] < i < last else 1] += 1
    return out


def learn(pages: DataFrame, html: str = "html", key: str = "page_id", limit: int = LABELLED_PAGES) -> Weights:
    """Weights from about ``limit`` pages, drawn by a hash of their key, that name
    their content.  Per tag key one row of counts reaches the driver; keys seen less
    than ``LEAST_SEEN`` times do not."""
    n = pages.count()
    drawn = pages.where(F.pmod(F.xxhash64(F.col(key), F.lit("labelled")), F.lit(max(1, n // limit))) == 0).select(F.col(html).alias("html"))

    def run(batches):
        for batch in batches:
            total: dict[str, list[int]] = {}
            for page in batch.column(0).to_pylist():
                for k, (a, b) in labelled_counts(page or "").items():
                    t = total.setdefault(k, [0, 0])
                    t[0] += a
                    t[1] += b
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array([v[0] for v in total.values()], pa.int64()), pa.array([v[1] for v in total.values()], pa.int64())],
                names=["tag", "inside", "outside"],
            )

    counts = drawn.mapInArrow(run, "tag string, inside bigint, outside bigint")
    rows = counts.groupBy("tag").agg(F.sum("inside").alias("i"), F.sum("outside").alias("o")).where(F.col("i") + F.col("o") >= LEAST_SEEN).collect()
    weights = Weights()
    for tag, i, o in rows:
        share = o / (i + o)
        weights.cost[tag] = TAG + OUTSIDE * share
        if share >= BOILERPLATE and i + o >= LEAST_BOILERPLATE and "." in tag:
            weights.boilerplate.add(tag)
    return weights


def main_text(pages: DataFrame, weights: Weights, html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` with the column ``out``."""
    small_batches(pages.sparkSession)
    names = [c for c in pages.columns if c != out or c == html]
    pages = pages.select(*(F.col(f"`{c}`") for c in names))
    from pyspark.sql.types import StringType, StructField, StructType

    schema = StructType(pages.schema.fields + [StructField(out if out != html else "text", StringType())])

    def run(batches):
        for batch in batches:
            at = batch.schema.get_field_index(html)
            text = pa.array([extract(p, weights) for p in batch.column(at).to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([*batch.columns, text], names=schema.names)

    return pages.mapInArrow(run, schema)
