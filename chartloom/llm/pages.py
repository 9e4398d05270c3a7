"""Main text of web pages by a maximum-scoring subsequence of words and tags.

A page is read once, from left to right, into words and tags. Words score above zero, tags
below; a linear scan finds the contiguous stretch with the highest sum, and the blocks it
touches are the text. The weights are log-likelihood ratios of being inside or outside of
the content, counted over all labelled pages: those whose authors marked their content by
`article` or `main`. Tags that are as frequent inside as outside cost next to nothing, so
short paragraphs stay; menus and lists of links cost much.

Elements that are never content (`SKIPPED`, and those whose class, id or role says so) leave
the sequence, and count as outside when weights are learned. Tags in marked content cost the
least there is, whatever they cost elsewhere. An `article` or `main` inside a form, menu,
header or footer counts all the same; inside comments, adverts or sidebars it does not.

Defined results: null and empty pages have an empty text, as have pages without words; of
stretches with equal sums the first is taken; malformed markup never fails: an unclosed
comment or script runs to the end, end tags that match nothing are ignored, an incomplete
tag at the end is dropped; repeated rows give equal rows, and rows with null ids theirs;
other columns are ignored. Reading takes time in proportion to the page's length. Without
any labelled page all tags weigh the same.
"""

from __future__ import annotations

import html as references
import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from chartloom.llm.catalog import query

# Element names of HTML by their role, and words in a class, an id or a role that tell content from the rest.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("iframe noembed noframes script style textarea title xmp".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4"
    " h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split())
INLINE = frozenset(
    "a abbr audio b bdi bdo big br button canvas cite code data del dfn em font i iframe img input ins kbd label map mark math meter noscript object"
    " output picture q rp rt ruby s samp script select small source span strike strong style sub sup svg template textarea time tt u var video wbr".split())
CONTENT = frozenset(["article", "main"])
SKIPPED = frozenset(
    "aside audio button canvas datalist dialog footer head iframe menu nav noembed noframes noscript object script select style svg template"
    " textarea title video".split())
STAY_SHUT = frozenset("aside dialog noscript object script style svg template".split())
CUES = frozenset(
    "ad ads alert alerts banner breadcrumb breadcrumbs consent cookie cookies dialog disqus footer footnav gdpr login masthead menu menubar modal nav"
    " navbar navigation newsletter notice notices notification notifications pager pagination popup promo promos promoted recommended related"
    " replies reply respond search share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget widgets".split())
CUE_STARTS = ("advert", "comment", "cookie", "newsletter", "sidebar")
HARD_CUES = frozenset(["ad", "ads", "disqus", "promo", "promoted", "related", "replies", "reply", "respond", "sidebar", "sponsor", "sponsored"])
HEADER_OWNERS = frozenset("article content entry main post story".split())
NEGATIONS = frozenset("has is no not with without".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog menu menubar navigation search".split())

OPEN, FORM, SOFT, HARD = range(4)  # how an element shuts out its words: not at all, like a form, like a menu, for good
WORD = "#word"
WORD_RANGE, TAG_RANGE = (0.2, 3.0), (-4.0, -0.01)
SEEN_LEAST = 20  # a tag met less often says nothing

_TAG = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)((?:[^\"'>]++|\"[^\"]*+\"|'[^']*+')*+)>")
_SIMPLE = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)([^>]*+)>")
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_TELLING = re.compile(r"class|id|role|hidden|style", re.IGNORECASE)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("", text, "") for a stretch of text, ("<" or "</", name, attributes) for a tag; comments and raw text are left out."""
    at, end, tag = 0, len(page), _TAG
    while at < end:
        begin = page.find("<", at)
        if begin < 0:
            yield "", page[at:], ""
            return
        after = page[begin + 1 : begin + 2]
        if after in ("!", "?"):
            if begin > at:
                yield "", page[at:begin], ""
            closing = "-->" if page.startswith("<!--", begin) else ">"
            stop = page.find(closing, begin + 2)
            if stop < 0:
                return
            at = stop + len(closing)
            continue
        if not (after.isascii() and after.isalpha()) and not (after == "/" and page[begin + 2 : begin + 3].isalpha()):
            yield "", page[at : begin + 1], ""
            at = begin + 1
            continue
        if begin > at:
            yield "", page[at:begin], ""
        found = tag.match(page, begin)
        if found is None and tag is _TAG:  # a quote that is never closed: from here on quotes mean nothing
            tag = _SIMPLE
            found = tag.match(page, begin)
        if found is None:
            return
        closes, name, attributes = found.groups()
        name, at = name.lower(), found.end()
        yield "</" if closes else "<", name, attributes
        if name in RAW and not closes:
            stop = re.compile(f"</{name}(?=[\\s/>])", re.IGNORECASE).search(page, at)
            if stop is None:
                return
            at = stop.start()


def shuts(name: str, attributes: str, inside: bool) -> int:
    """How an element shuts out its words; `inside` an article a header is part of it."""
    level = OPEN
    if name in SKIPPED:
        level = HARD if name in STAY_SHUT else SOFT
    elif name == "form":
        level = FORM
    elif name == "header" and not inside:
        level = SOFT
    if name in ("html", "body", "main") or not attributes or not _TELLING.search(attributes):
        return level
    bare = _ATTRIBUTE.sub(" ", attributes).lower().split()
    if "hidden" in bare:
        return HARD
    for key, *values in _ATTRIBUTE.findall(attributes):
        key, value = key.lower(), "".join(values)
        if key == "role" and value.lower() in ROLES:
            level = max(level, SOFT)
        elif key == "style" and re.search(r"display\s*:\s*none", value, re.IGNORECASE):
            return HARD
        elif key in ("class", "id"):
            for one in value.split():
                parts = [p.lower() for p in _PARTS.findall(one)]
                if not parts or parts[0] in NEGATIONS:
                    continue
                if any(p in HARD_CUES or p.startswith(CUE_STARTS) for p in parts):
                    return HARD
                if not CUES.isdisjoint(parts) or "header" in parts and not inside and HEADER_OWNERS.isdisjoint(parts):
                    level = max(level, SOFT)
    return level


@dataclass
class Page:
    """What reading a page gives: its tags and texts in order.

    `names` has a tag's name or "" for a text; `words` counts those of a text; `levels` and
    `labels` say how it is shut out and whether it lies in the marked content; `blocks` has
    the number of a text's block, `texts` its characters.
    """

    names: list[str] = field(default_factory=list)
    words: list[int] = field(default_factory=list)
    levels: list[int] = field(default_factory=list)
    labels: list[bool] = field(default_factory=list)
    blocks: list[int] = field(default_factory=list)
    texts: list[str] = field(default_factory=list)
    labelled: bool = False

    def add(self, name: str, level: int, label: bool, block: int, text: str = "", words: int = 0) -> None:
        self.names.append(name)
        self.words.append(words)
        self.levels.append(level)
        self.labels.append(label and level == OPEN)
        self.blocks.append(block)
        self.texts.append(text)


def read(page: str) -> Page:
    out, block = Page(), 0
    stack: list[tuple[str, int, bool]] = [("", OPEN, False)]  # name, level, inside of marked content
    places: dict[str, list[int]] = {}

    def close_to(place: int) -> None:
        while len(stack) > place:
            places[stack.pop()[0]].pop()

    for kind, name, attributes in tokens(page):
        _, level, inside = stack[-1]
        if not kind:
            text = references.unescape(name) if "&" in name else name
            out.add("", level, inside, block, text, len(text.split()))
            continue
        block += name in BLOCKS
        if kind == "<":
            top = stack[-1][0]
            if len(stack) > 1 and (top == "p" and name in BLOCKS or top == name and name in ("li", "dd", "dt", "tr", "td", "th", "option")):
                close_to(len(stack) - 1)
                _, level, inside = stack[-1]
            if name == "body" and places.get("head"):
                close_to(places["head"][-1])
                _, level, inside = stack[-1]
            own = shuts(name, attributes, inside)
            if name in CONTENT and level < HARD:
                level, inside = own, inside or own == OPEN
                out.labelled |= own == OPEN
            else:
                level = max(level, own)
            out.add(name, level, inside, block)
            if name == "br":
                out.add("", level, inside, block, " ")
            if name not in VOID and not attributes.endswith("/") or name in BLOCKS - VOID:
                places.setdefault(name, []).append(len(stack))
                stack.append((name, level, inside))
        else:
            out.add(name, level, inside, block)
            if own_places := places.get(name):
                place = own_places[-1]
                # text-level end tags do not end an element that shuts out its words
                if name in BLOCKS - {"p"} or stack[place][1] == level:
                    close_to(place)
    return out


@dataclass(frozen=True)
class Weights:
    """Scores of a word and of tags by name."""

    word: float = 1.0
    tags: dict[str, float] = field(default_factory=dict)

    def tag(self, name: str) -> float:
        return self.tags.get(name, TAG_RANGE[1])


def best_stretch(scores: list[float]) -> tuple[int, int]:
    """Start and end of the contiguous stretch with the highest sum above zero, by one scan; (0, 0) if there is none."""
    best, begin, end, running, start = 0.0, 0, 0, 0.0, 0
    for i, score in enumerate(scores):
        if running <= 0:
            running, start = 0.0, i
        running += score
        if running > best:
            best, begin, end = running, start, i + 1
    return begin, end


def main_text(page: str | None, weights: Weights) -> str:
    """The blocks of the best stretch, one to a line."""
    if not page:
        return ""
    own = read(page)
    limit = OPEN if any(w and level == OPEN for w, level in zip(own.words, own.levels)) else FORM
    scores = [
        0.0 if level > limit else weights.word * words if not name else TAG_RANGE[1] if label else weights.tag(name)
        for name, words, level, label in zip(own.names, own.words, own.levels, own.labels)]
    begin, end = best_stretch(scores)
    if begin == end:
        return ""
    touched = [own.blocks[i] for i in range(begin, end) if own.words[i] and own.levels[i] <= limit]
    pieces: dict[int, list[str]] = {}
    for name, level, block, text in zip(own.names, own.levels, own.blocks, own.texts):
        if not name and level <= limit and touched[0] <= block <= touched[-1]:
            pieces.setdefault(block, []).append(text)
    lines = (" ".join("".join(parts).split()) for parts in pieces.values())
    return "\n".join(line for line in lines if line)


def token_counts(pages: DataFrame, html: str = "html") -> DataFrame:
    """token, inside, n: words and tags of labelled pages, in and out of the marked content."""
    known = BLOCKS | INLINE | VOID

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: Counter = Counter()
        for batch in batches:
            for value in batch.column(0):
                own = read(value.as_py() or "")
                if own.labelled:
                    for name, words, label in zip(own.names, own.words, own.labels):
                        if words or name in known:
                            sums[name or WORD, label] += words or 1
        yield pa.RecordBatch.from_arrays(
            [pa.array([t for t, _ in sums], pa.string()), pa.array([i for _, i in sums], pa.bool_()), pa.array(list(sums.values()), pa.int64())],
            names=["token", "inside", "n"])

    return pages.select(html).mapInArrow(run, "token string, inside boolean, n bigint").groupBy("token", "inside").agg(F.sum("n").alias("n"))


def fit(pages: DataFrame, html: str = "html") -> Weights:
    """Log-likelihood ratios; words are kept above zero and tags below. A row per element name of HTML reaches the driver."""
    inside, outside = Counter(), Counter()
    for r in token_counts(pages, html).collect():
        (inside if r["inside"] else outside)[r["token"]] = r["n"]
    if not inside or not outside:
        return Weights()
    names = set(inside) | set(outside)
    total_in, total_out = (sum(c.values()) + len(names) for c in (inside, outside))

    def ratio(token: str) -> float:
        return math.log((inside[token] + 1) / total_in) - math.log((outside[token] + 1) / total_out)

    def held(value: float, bounds: tuple[float, float]) -> float:
        return min(max(value, bounds[0]), bounds[1])

    seen = [t for t in names if t != WORD and inside[t] + outside[t] >= SEEN_LEAST]
    return Weights(held(ratio(WORD), WORD_RANGE), {t: held(ratio(t), TAG_RANGE) for t in seen})


def extract(pages: DataFrame, weights: Weights, keep: tuple[str, ...] = ("page_id", "url"), html: str = "html", name: str = "text") -> DataFrame:
    """`keep` and the main text of every page."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([main_text(v.as_py(), weights) for v in batch.column(len(keep))], pa.string())
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in range(len(keep))), found], names=[*keep, name])

    picked = pages.select(*[pages[k] for k in keep], pages[html])
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in picked.schema.fields[:-1]]
    return picked.mapInArrow(run, ", ".join([*fields, f"`{name}` string"]))


@query("op12_main_text", exact=True)
def op12_main_text(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return extract(pages, fit(pages)).withColumn("n_chars", F.length("text").cast("long"))
