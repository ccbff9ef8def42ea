"""Main text of web pages by a maximum-scoring subsequence.

A page is a sequence of tags and runs of words.  Words score positive in what
looks like an article and negative in what doesn't, tags score negative; one
linear scan finds the contiguous region with the highest sum, and its words
that scored positive are the text.

The weights come from labelled pages: pages with exactly one ``<article>``
element say which of their words are main text.  Each kind of element (its
tag, with a class or id) gets the log odds of its words being main text, and
each kind of tag a cost by how often it stands outside of the article.  The
fit reads at most ``sample`` such pages (smallest id hash); only counts by kind
reach the driver.  Hidden elements are not main text, wherever they stand; those in
``BOILERPLATE`` neither, unless the sample has them around articles and with most of their words
inside these.  An article or main element ends the menus, headers and sidebars that a page leaves open, and
is no form where a form is around it.  The class words in ``HINT`` are a prior:
an element with one isn't main text unless the sample has it with most of its words inside the article; a word
counts as a whole, all its parts being hints or neutral (``cookie-box``, not ``side-effects``), and words for a state
(``no-sidebar``, ``has-sidebar``) and the classes of ``WHOLE`` elements say nothing.

Defined cases: null html is empty and gives the empty text; null ids and urls
are carried; repeated rows are extracted one by one; unclosed and stray tags
and comments are tolerated; a page without positive words gives the empty text.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from functools import lru_cache
from html import unescape
from math import log

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Attributes as HTML reads them: quotes count behind an equals sign only.  A quoted
#: value ends at a quote that an attribute or the tag's end may follow; one that
#: doesn't end so (the quote was forgotten) ends with the tag.
TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)"
    r"|<[a-zA-Z/!?](?:[^<>=]|=\s*\"[^\"<]*\"(?=[\s/>])|=\s*'[^'<]*'(?=[\s/>])"
    r"|=\s*\"[^\"]{0,2000}\"(?=[\s/>])|=\s*'[^']{0,2000}'(?=[\s/>])|=)*+>|[^<]+|<", re.S | re.I)
TAG = re.compile(r"<(/?)([a-zA-Z][a-zA-Z0-9:-]*)")
NAMED = re.compile(r"\s(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.I)
HIDDEN = re.compile(r"\shidden(?=[\s=>/])|aria-hidden\s*=\s*[\"']?true|display\s*:\s*none", re.I)
INLINE = frozenset("a abbr b bdi bdo cite code data del dfn em font i ins kbd label mark q s samp small span strike strong "
                   "sub sup time tt u var wbr".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Elements that end where one of their family begins (or a block, for p), or with what they stand in.
FAMILY = {t: f for f in (("p",), ("li",), ("dt", "dd"), ("td", "th"), ("tr", "td", "th"), ("option",),
                         ("thead", "tbody", "tfoot", "tr", "td", "th"), ("caption",), ("h1", "h2", "h3", "h4", "h5", "h6"))
          for t in f} | {"td": ("td", "th"), "th": ("td", "th"), "tr": ("tr", "td", "th")}
LOOSE = frozenset(FAMILY)
BOILERPLATE = frozenset("head title nav header footer aside form menu dialog noscript template svg iframe textarea select "
                        "button object canvas".split())
#: Boilerplate that main and article end, where the page doesn't close it itself.
ENDED = frozenset("nav header footer aside menu".split())
HINT = re.compile(r"ad|ads|advert\w*|banners?|sponsor\w*|promo\w*|cookies?|consent|notices?|notifications?|alerts?|gdpr|"
                  r"sidebars?|side|menus?|nav|navbar|navigation|breadcrumbs?|footer|foot|header|masthead|topbar|toolbar|"
                  r"comments?|replies|reply|discussion|disqus|share|sharing|social|related|recommend\w*|newsletter|subscribe|"
                  r"signup|login|search|popup|modal|overlay|widgets?|pagination|pager|copyright|contentinfo|complementary|"
                  r"tags|meta|byline")
#: Parts of class words that say where or how, not what.
NEUTRAL = re.compile(r"[a-z]|area|bar|bars|block|bottom|box|boxes|btn|button|buttons|center|class|col|column|container|content|"
                     r"desktop|div|element|fixed|global|group|holder|icon|icons|id|image|img|inner|inline|item|items|label|large|"
                     r"left|line|link|links|list|mobile|module|outer|page|panel|post|posts|primary|right|row|secondary|section|"
                     r"site|slot|small|sticky|strip|text|title|top|unit|wrap|wrapper|js|is")
#: A class that says what the page has or lacks, not what the element is.
STATE = re.compile(r"(?:[a-z0-9-]+:)*(?:no|not|non|has|have|with|without|hide|hides|show|shows)[-_]", re.I)
#: Elements that hold the main text, whatever they are called.
WHOLE = frozenset("html body main article".split())
#: Scores of a word: in what isn't main text (little, so that an advert inside an
#: article doesn't split it; its words are left out anyway), unknown, and at most; of a tag.
BAD, UNKNOWN, MOST = -0.25, 0.75, 1.0
TAG_COST = 0.5


def kind_of(tag: str, source: str) -> str:
    """The tag with the sorted set of all words of its class, id and role; digits don't tell kinds apart."""
    named = " ".join(next(filter(None, m.groups()[1:]), "") for m in NAMED.finditer(source)).lower()
    return f"{tag}.{' '.join(sorted(set(re.sub('[0-9]+', '0', named).split())))}" if named.strip() else tag


class Place:
    """An open element, linked to the one around it: what holds for a word in
    it is worked out once, however deep the element lies."""

    __slots__ = ("tag", "kind", "around", "nests", "boiler", "hints", "article", "held", "score")

    def __init__(self, tag: str, kind: str, around: Place | None, nests: bool):
        self.tag, self.kind, self.around, self.nests = tag, kind, around, nests
        own = boilerplate(kind)
        # boilerplate around: hidden ones stay, a form does not make the article in it a form
        self.boiler: frozenset = around.boiler if around else NONE
        if tag in ("main", "article"):
            self.boiler = self.boiler - {k for k in self.boiler if k.split(".", 1)[0] == "form"}
        if own and kind not in self.boiler:
            self.boiler = self.boiler | {kind}
        self.hints: frozenset = around.hints if around else NONE
        if hinted(kind) and kind not in self.hints:
            self.hints = self.hints | {kind}
        self.article = tag == "article" or around is not None and around.article
        #: Boilerplate that the article stands in.
        self.held: frozenset = around.held if around and around.article else self.boiler if tag == "article" else NONE
        self.score: float | None = None


NONE: frozenset = frozenset()


def pieces(html: str) -> Iterator[tuple[str, str, str, Place | None]]:
    """(what, tag, kind or text, innermost open element); what: open, close or text.

    Inline elements, and those that end by themselves, count as open only where their class, id, role
    or hidden state says something; the others leave the place as it is."""
    here: Place | None = None
    open_tags: Counter = Counter()
    tokens = list(TOKEN.finditer(html))
    balance: Counter = Counter()  # elements that are opened and never closed
    for m in tokens:
        if (t := TAG.match(m.group())) and not m.group(1) and t.group(2).lower() in ENDED:
            balance[t.group(2).lower()] += -1 if t.group(1) else 1

    def leave(to: Place | None) -> None:
        nonlocal here
        while here is not to:
            open_tags[here.tag] -= 1
            here = here.around

    def loose_end(tags) -> None:
        """Ends the open loose or inline element of ``tags``, inside the block we are in."""
        at = here
        while at is not None and not at.nests:
            if at.tag in tags:
                leave(at.around)
                return
            at = at.around

    for m in tokens:
        source = m.group()
        if source[0] != "<" or source == "<":
            yield "text", "", unescape(source), here
            continue
        t = TAG.match(source)
        if m.group(1) or t is None:
            continue
        tag = t.group(2).lower()
        light = tag in INLINE or tag in LOOSE
        if t.group(1):
            yield "close", tag, tag, here
            if light:
                loose_end((tag,))
            elif open_tags[tag] > 0:
                at = here
                while not (at.tag == tag and at.nests):
                    at = at.around
                leave(at.around)
            continue
        kind = "hidden" if HIDDEN.search(source) else kind_of(tag, source)
        if tag in LOOSE:
            loose_end(FAMILY[tag])
        if tag not in INLINE:
            loose_end(("p",))
        if tag in ("main", "article") and any(open_tags[t] > 0 and balance[t] > 0 for t in ENDED):
            at, last = here, None
            while at is not None:
                if at.tag in ENDED and balance[at.tag] > 0:
                    balance[at.tag] -= 1
                    last = at
                at = at.around
            if last is not None:
                leave(last.around)
        if tag not in VOID and not source.endswith("/>") and (not light or kind == "hidden" or hinted(kind)):
            here = Place(tag, kind, here, not light)
            open_tags[tag] += not light
        yield "open", tag, kind, here


def boilerplate(kind: str) -> bool:
    return kind == "hidden" or kind.split(".", 1)[0] in BOILERPLATE


def hint_word(word: str) -> bool:
    """Whether all parts of a class word are hints or neutral, one a hint at least."""
    if STATE.match(word):
        return False
    parts = [p for p in re.split("[^a-z]+", word) if p]
    hints = [bool(HINT.fullmatch(p)) for p in parts]
    return any(hints) and all(h or NEUTRAL.fullmatch(p) for h, p in zip(hints, parts))


@lru_cache(100_000)
def hinted(kind: str) -> bool:
    """Whether a class word says that this isn't main text, as far as no label is known."""
    tag, _, named = kind.partition(".")
    return tag not in WHOLE and any(map(hint_word, named.split()))


class Weights:
    """Scores from counts {(what, kind): (inside, outside)} of labelled pages."""

    def __init__(self, counts: dict[tuple[str, str], tuple[int, int]], least: int = 20):
        self.words, self.tags, self.main = {}, {}, set()
        for (what, kind), (inside, outside) in counts.items():
            if what == "word" and inside + outside >= least:
                self.words[kind] = max(BAD, min(MOST, log((inside + 1) / (outside + 1))))
            elif what == "under" and inside + outside >= least and inside > outside:
                self.main.add(kind)
            elif what == "tag":
                self.tags[kind] = -TAG_COST * (outside + 0.1) / (inside + outside + 0.1)

    def word(self, place: Place | None) -> float:
        """The innermost element that is known decides, unless one around it isn't main text."""
        if place is not None and not self.main.issuperset(place.boiler | place.hints):
            return BAD
        passed = []
        while place is not None and place.score is None and place.kind not in self.words:
            passed.append(place)
            place = place.around
        score = UNKNOWN if place is None else self.words[place.kind] if place.score is None else place.score
        for p in passed:
            p.score = score
        return score

    def tag(self, kind: str) -> float:
        return self.tags.get(kind, -TAG_COST)

    def extract(self, html: str) -> str:
        return extract(html, self)


def best_region(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous region with the largest sum, the first of
    equal ones; empty where no sum is positive."""
    best, region, total, start = 0.0, (0, 0), 0.0, 0
    for k, score in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += score
        if total > best:
            best, region = total, (start, k + 1)
    return region


def extract(html: str, weights: Weights) -> str:
    """The main text: blocks in page order, one line each."""
    items = []
    for what, tag, value, place in pieces(html):
        if what == "text":
            score = weights.word(place)
            items.append((len(value.split()) * score, what, tag, value, score > 0))
        else:
            items.append((weights.tag(value), what, tag, "", False))
    blocks: list[list[str]] = [[]]
    for _, what, tag, value, good in items[slice(*best_region([item[0] for item in items]))]:
        if what == "text":
            if good:
                blocks[-1].append(value)
        elif tag not in INLINE:
            blocks.append([])
    lines = (" ".join("".join(b).split()) for b in blocks)
    return "\n".join(line for line in lines if line)


def count_page(html: str) -> list[tuple[str, str, int, int]]:
    """(what, kind, inside, outside) of a labelled page; no rows of another."""
    counts: dict[tuple[str, str], list[int]] = defaultdict(lambda: [0, 0])
    opened = Counter()
    for what, tag, value, place in pieces(html):
        inside = place is not None and place.article
        if what == "text":
            n = len(value.split())
            if n and place is not None:
                for kind in place.hints:
                    counts["under", kind][not inside] += n
                for kind in place.boiler - {"hidden"}:  # what stands inside of an article is no label for it
                    counts["under", kind][kind not in place.held] += n
                around = place.around.hints if place.around else NONE
                if not place.boiler and not around:  # else that rule decides for the others
                    counts["word", place.kind][not inside] += n
        else:
            opened[tag] += what == "open"
            counts["tag", value][not inside or tag == "article"] += 1
    return [(*k, *v) for k, v in counts.items()] if opened["article"] == 1 else []


COUNTS = T.ArrayType(T.StructType([T.StructField("what", T.StringType()), T.StructField("kind", T.StringType()),
                                   T.StructField("inside", T.LongType()), T.StructField("outside", T.LongType())]))


@F.pandas_udf(COUNTS)
def _counts(pages: pd.Series) -> pd.Series:
    return pages.map(lambda h: [dict(zip(COUNTS.elementType.names, x)) for x in count_page(h)])


@F.pandas_udf(T.BooleanType())
def _labelled(pages: pd.Series) -> pd.Series:
    """Whether a page has exactly one opening <article>."""
    def one(html: str) -> bool:
        opened = (TAG.match(m.group()) for m in TOKEN.finditer(html) if m.group()[0] == "<" and not m.group(1))
        return sum(t is not None and not t.group(1) and t.group(2).lower() == "article" for t in opened) == 1
    return pages.map(one)


def fit(pages: DataFrame, sample: int = 600) -> Weights:
    """Weights from at most ``sample`` labelled pages."""
    ids = pages.filter("page_id is not null and lower(html) like '%<article%'").filter(_labelled("html")).select(
        "page_id").distinct().orderBy(
        F.xxhash64("page_id"), "page_id").limit(sample)
    read = pages.select("page_id", F.coalesce("html", F.lit("")).alias("html")).join(
        F.broadcast(ids), "page_id", "left_semi")  # at most `sample` ids
    rows = read.select(F.inline(_counts("html"))).groupBy("what", "kind").agg(
        F.sum("inside"), F.sum("outside")).collect()  # kinds of at most `sample` pages
    return Weights({(r[0], r[1]): (r[2], r[3]) for r in rows})


def main_text(pages: DataFrame, sample: int = 600) -> DataFrame:
    """page_id, url, text, n_chars for every row of ``pages``."""
    weights = fit(pages, sample)

    @F.pandas_udf(T.StringType())
    def text(html: pd.Series) -> pd.Series:
        return html.map(weights.extract)

    return pages.select(F.col("page_id").cast("bigint").alias("page_id"), "url",
                        text(F.coalesce("html", F.lit(""))).alias("text")).withColumn(
        "n_chars", F.char_length("text").cast("bigint"))
