"""The main text of web pages, as the maximum-scoring run of their tokens.

A page is read as words and tags. Words score positive and tags negative, words in menus,
adverts and the like negative too; the weights are log odds of being content, learned from pages
whose markup labels it (`article` or `main`). One linear scan finds the contiguous run with the
largest sum. Its text, less what stands in such boilerplate elements, is given out by blocks.

On pages whose markup labels nothing words weigh by the element they stand in and by whether they
are a link, and tags by their own name, whatever class or boilerplate the labelled pages had them
in. So a menu's links or an advert's bare `div` go there without being named.

Each page is read on its own; nothing is shuffled but the counts of some hundred features.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator, Mapping
from html import unescape
from math import log
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from logbraid.llm.arrow import in_parts, texts_of
from logbraid.llm.rows import row_of, unpacked

# About so many labelled pages, picked by a hash of the page, are learned from.
LABELLED_PAGES = 2000
RESULTS = ("text", "n_chars")

# Elements of HTML by kind.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog div dl dt fieldset"
    " figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav"
    " ol optgroup option p pre section summary table tbody td tfoot th thead title tr ul".split()
)
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp"
    " small span strike strong sub sup time tt u var".split()
)
_LABELS = frozenset({"article", "main"})
_BOILERPLATE = frozenset(
    "aside audio button canvas datalist dialog fieldset footer form head iframe input label menu"
    " nav object option select textarea title video".split()
)
# All other elements are one feature, so that features are bounded in number.
_KNOWN, _OTHER = _VOID | _BLOCK | _INLINE | _BOILERPLATE | {"body"}, "?"
# Words in a class, id or role that name boilerplate.
_NAMES = frozenset(
    "ad ads adbox adslot advert adverts advertisement advertising advertorial alert banner"
    " breadcrumb breadcrumbs comment comments commentlist complementary consent contentinfo cookie"
    " cookies copyright disclaimer disqus footer form gdpr header login masthead menu modal nav"
    " navbar navigation newsletter notice notices notification outbrain pager pagination popup"
    " promo promoted promotion recommended related replies reply respond search share sharing"
    " sidebar sidebars signup skip social sponsor sponsored subscribe subscription taboola toolbar"
    " widget widgets".split()
)
# What a class begins with that tells of the page, not of the element; and words
# beside which `header` is a heading's wrapper.
_ABOUT = frozenset("category format has is js layout no postid status tag type with".split())
_OF_CONTENT = frozenset("article content entry post story title".split())
# Names that may as well be what an article is about (`search-results`,
# `notice-board`), and what may follow them where they are not.
_SUBJECTS = frozenset("alert form login notice notices search".split())
_LAYOUT = frozenset(
    "area bar block bottom box button container field icon inner input left message right section"
    " text top wrapper".split()
)
_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(?:svg|math)(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*(?<=/)>"
    r"|<(script|style|noscript|template|svg|math|textarea|iframe|xmp)(?=[\s/>])[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>"
    r"|<(/?)([a-z][^\s/>]*)([^>]*)>"
    r"|<[!?/][^>]*>",
    re.DOTALL | re.IGNORECASE,
)
_ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.IGNORECASE)
_HIDDEN = re.compile(
    r"""(?:^|\s)hidden(?=[\s/=]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.IGNORECASE
)
_PARTS = re.compile(r"[a-z]+", re.IGNORECASE)

# Bounds of the weights, and those of features that no labelled page has. A run may pass over a
# short advert if there is enough content behind it, but over no menu.
_WORDS, _BOILERPLATE_WORDS, _TAGS = (0.1, 3.0), (-0.3, -0.01), (-1.0, -0.01)
_BOUNDS = {"word": _WORDS, "-word": _BOILERPLATE_WORDS, "~word": _BOILERPLATE_WORDS}
# On pages without a label a tag that is only beside content outweighs some words that are in it.
_WORDS_THERE, _TAGS_THERE = (-1.0, 1.0), (-8.0, -0.01)
# A block of so many words is another feature: few adverts and no menus have as many.
LONG = 20
_UNSEEN_TAG, _UNSEEN_WORD, _UNSEEN_BOILERPLATE = -0.2, 1.0, -0.3


class Token(NamedTuple):
    """A tag or a run of words. Features of tokens in boilerplate begin with `-`, those of words
    beside what the page's own markup labels as content with `~`."""

    feature: str
    words: int
    text: str
    breaks: bool  # a block begins or ends here
    labelled: bool
    where: str = ""  # the feature on pages without a label: a tag, or what words stand in


# Whether an element is boilerplate: not, by a name or as a form, which a page's wrapper may be
# too, or for sure.
_NOT, _PERHAPS, _SURELY = range(3)


def _boilerplate(tag: str, attributes: str, labelled: bool) -> int:
    if tag != "form" and (tag in _BOILERPLATE or (tag == "header" and not labelled)):
        return _SURELY
    if attributes and tag not in ("html", "body"):
        if _HIDDEN.search(attributes):
            return _SURELY
        if _has_name(attributes, labelled):
            return _PERHAPS
    return _PERHAPS if tag == "form" else _NOT


def _has_name(attributes: str, labelled: bool) -> bool:
    """Whether a class, id or role names boilerplate. In what the markup labels as content a name
    that may be a subject does only where its last word, but for those of layout, is one."""
    for _, value in _ATTRIBUTE.findall(attributes):
        for name in value.strip("\"'").lower().split():
            parts = _PARTS.findall(name)
            if parts and parts[0] not in _ABOUT:
                found = _NAMES.intersection(parts)
                if labelled and found <= _SUBJECTS:
                    last = [p for p in parts if p not in _LAYOUT][-1:]
                    found = found.intersection(last)
                if found - {"header"} or (found and not _OF_CONTENT.intersection(parts)):
                    return True
    return False


class _Open:
    """The elements that are open, as a browser would have them where tags are missing.

    Elements are known by their place among those pushed; `wrappers` are no boilerplate.
    """

    def __init__(self, wrappers: frozenset[int] = frozenset(), lifts: bool = True) -> None:
        # Tag, whether it is boilerplate, and how much boilerplate it puts out of force.
        self.stack: list[tuple[str, bool, int]] = []
        # Beside each the block that words in it stand in, and whether they are a link.
        self.blocks: list[tuple[str, bool]] = []
        self.boilerplate = self.labelled = 0
        self.seen_label = False
        self.wrappers, self.lifts = wrappers, lifts
        self.lifted = False
        # Words so far, and those labelled and in no boilerplate.
        self.words = self.words_labelled = 0
        # Of each element that is perhaps boilerplate its place and the words before it, by its
        # height in the stack while it is open, and then its place and the words in it.
        self.pushed = 0
        self.perhaps: dict[int, tuple[int, int, int]] = {}
        self.closed: list[tuple[int, int, int]] = []

    def count(self, words: int) -> None:
        self.words += words
        if self.labelled and not self.boilerplate:
            self.words_labelled += words

    def push(self, tag: str, attributes: str) -> None:
        if tag in _BLOCK:
            self._end_paragraph()
        if tag == "li":
            self._end_item()
        if tag in _VOID:
            return
        kind, lifted = _boilerplate(tag, attributes, bool(self.labelled)), 0
        marked = kind != _NOT and self.pushed not in self.wrappers
        if kind == _PERHAPS:
            self.perhaps[len(self.stack)] = (self.pushed, self.words, self.words_labelled)
        self.pushed += 1
        if tag in _LABELS:
            # The page's first article, in something that only by its name is boilerplate.
            by_tag = any(m and (t in _BOILERPLATE or t == "header") for t, m, _ in self.stack)
            if self.lifts and not self.seen_label and not marked and not by_tag:
                lifted = self.boilerplate
                self.lifted = self.lifted or lifted > 0
            self.seen_label = True
            self.labelled += 1
        self.stack.append((tag, marked, lifted))
        block, link = self.blocks[-1] if self.blocks else ("body", False)
        self.blocks.append((tag, False) if tag in _BLOCK else (block, link or tag == "a"))
        self.boilerplate += marked - lifted

    def close(self, tag: str) -> None:
        for place in range(len(self.stack) - 1, -1, -1):
            if self.stack[place][0] == tag:
                self._cut(place)
                return

    def _cut(self, place: int) -> None:
        for tag, marked, lifted in self.stack[place:]:
            self.boilerplate -= marked - lifted
            self.labelled -= tag in _LABELS
        for height in [h for h in self.perhaps if h >= place]:
            number, words, labelled = self.perhaps.pop(height)
            self.closed.append((number, self.words - words, self.words_labelled - labelled))
        del self.stack[place:], self.blocks[place:]

    def words_in(self) -> str:
        block, link = self.blocks[-1] if self.blocks else ("body", False)
        return f"words in {block} a" if link else f"words in {block}"

    def wrapping(self) -> frozenset[int]:
        """Elements perhaps boilerplate that hold most of the page's words: forms and names, if
        no labelled words are beside them."""
        self._cut(0)
        return frozenset(
            number
            for number, words, labelled in self.closed
            if 2 * words > self.words and labelled == self.words_labelled
        )

    def _end_paragraph(self) -> None:
        """A paragraph holds no blocks, so a block ends it."""
        for place in range(len(self.stack) - 1, -1, -1):
            if self.stack[place][0] == "p":
                self._cut(place)
                return
            if self.stack[place][0] in _BLOCK:
                return

    def _end_item(self) -> None:
        for place in range(len(self.stack) - 1, -1, -1):
            if self.stack[place][0] == "li":
                self._cut(place)
                return
            if self.stack[place][0] in ("ul", "ol", "menu"):
                return


def tokens(html: str) -> list[Token]:
    """The page's tags and runs of words, in order.

    What the markup labels as content is taken as labelled if it has at least as many words as
    what is beside it; otherwise no token is, and the weights decide.
    """
    elements = _Open()
    found = list(_tokens(html, elements))
    if wrappers := elements.wrapping():
        elements = _Open(wrappers)
        found = list(_tokens(html, elements))
    inside, beside = _label_words(found)
    if elements.lifted and inside < beside:
        found = list(_tokens(html, _Open(wrappers, lifts=False)))
        inside, beside = _label_words(found)
    found = _with_lengths(found)
    if inside < beside:
        return [t._replace(labelled=False) for t in found]
    if inside:
        beside = (t.feature == "word" and not t.labelled for t in found)
        found = [t._replace(feature="~word") if b else t for t, b in zip(found, beside)]
    return found


def _with_lengths(found: list[Token]) -> list[Token]:
    """Words of long blocks are told from those of short ones."""
    out, block = [], []
    for token in found:
        if token.breaks:
            out += _block(block)
            out.append(token)
            block = []
        else:
            block.append(token)
    return out + _block(block)


def _block(block: list[Token]) -> list[Token]:
    if sum(t.words for t in block) < LONG:
        return block
    return [t._replace(where=f"{t.where}, long") if t.text else t for t in block]


def _label_words(found: list[Token]) -> tuple[int, int]:
    """Words in labelled elements and beside them, but for boilerplate."""
    words = [(t.words, t.labelled) for t in found if t.feature == "word"]
    return sum(n for n, labelled in words if labelled), sum(n for n, labelled in words if not labelled)


def _tokens(html: str, elements: _Open) -> Iterator[Token]:
    at = 0

    def words(text: str) -> Iterator[Token]:
        found = unescape(text) if "&" in text else text
        n = len(found.split())
        elements.count(n)
        if n or found:
            feature = "-word" if elements.boilerplate else "word"
            yield Token(feature, n, found, False, bool(elements.labelled), elements.words_in())

    for match in _TOKEN.finditer(html):
        if match.start() > at:
            yield from words(html[at : match.start()])
        at = match.end()
        tag = (match[3] or match[6] or "").lower()
        if tag:
            closing = bool(match[2] or match[5])
            before = elements.labelled, elements.boilerplate
            if closing:
                elements.close(tag)
            else:
                elements.push(tag, match[4] or match[7] or "")
            labelled = bool(elements.labelled or before[0])
            marked = bool(elements.boilerplate or before[1])
            name = tag if tag in _KNOWN else _OTHER
            yield Token("-" * marked + name, 0, "", tag in _BLOCK, labelled, f"<{name}>")
    if at < len(html):
        yield from words(html[at:])


def weights_from(counts: Mapping[str, tuple[int, int]]) -> dict[str, float]:
    """A weight per feature from how often it is (inside, outside) labelled content: the log odds,
    words positive, tags and all in boilerplate negative."""
    out = {}
    for feature, (a, b) in counts.items():
        if feature.startswith("words in "):
            low, high = _WORDS_THERE
        else:
            low, high = _BOUNDS.get(feature, _TAGS_THERE if feature[0] == "<" else _TAGS)
        out[feature] = min(max(log((a + 1) / (b + 1)), low), high)
    return out


def _weight(weights: Mapping[str, float], token: Token, by_place: bool) -> float:
    if by_place and token.feature[0] != "-" and token.where in weights:
        each = weights[token.where]
    elif token.feature in weights:
        each = weights[token.feature]
    elif token.feature == "word":
        each = _UNSEEN_WORD
    else:
        each = _UNSEEN_BOILERPLATE if token.feature[0] in "-~" else _UNSEEN_TAG
    return each * (token.words if token.text else 1)


def best_run(scores: Iterable[float]) -> tuple[int, int]:
    """(first, one after the last) of the run with the largest positive sum; of equal ones the
    first. Empty if there is none."""
    best, bounds, total, first = 0.0, (0, 0), 0.0, 0
    for i, score in enumerate(scores):
        if total <= 0:
            total, first = 0.0, i
        total += score
        if total > best:
            best, bounds = total, (first, i + 1)
    return bounds


def main_text(html: str, weights: Mapping[str, float]) -> str:
    """The text of the best run: white space in a block is one space, blocks are lines.

    If a page without a label has no run that is positive by what its words stand in, words count
    as words wherever they stand.
    """
    found = tokens(html)
    by_place = not any(t.labelled for t in found)
    first, last = best_run(_weight(weights, t, by_place) for t in found)
    if by_place and first == last:
        first, last = best_run(_weight(weights, t, False) for t in found)
    blocks, block = [], []
    for token in found[first:last]:
        if token.breaks:
            blocks.append(block)
            block = []
        elif token.feature == "word":
            block.append(token.text)
        elif token.feature == "br":
            block.append(" ")
    lines = (" ".join("".join(b).split()) for b in (*blocks, block))
    return "\n".join(line for line in lines if line)


def _count_features(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[tuple[str, bool]] = Counter()
    pages = (h for b in batches for part in in_parts(b, "html") for h in texts_of(part, "html"))
    for html in pages:
        found = tokens(html)
        if not any(t.labelled for t in found):
            continue
        for token in found:
            n = token.words if token.text else 1
            counts[token.feature, token.labelled] += n
            counts[token.where, token.labelled and token.feature[0] != "-"] += n
    rows = [(feature, n * labelled, n * (not labelled)) for (feature, labelled), n in counts.items()]
    columns = list(zip(*rows)) or [()] * 3
    kinds = (pa.string(), pa.int64(), pa.int64())
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, kind) for c, kind in zip(columns, kinds)], ["feature", "inside", "outside"]
    )


def learn_weights(pages: DataFrame, html: str = "html") -> dict[str, float]:
    """Weights from a sample of about `LABELLED_PAGES` pages that have `article` or `main`.

    The result has one number per feature. Elements that HTML doesn't know are one, so there are
    some hundred at most.
    """
    labelled = pages.select(F.col(html).alias("html")).where(
        F.col("html").rlike(r"(?i)<(article|main)[\s>]")
    )
    one_in = max(1, labelled.count() // LABELLED_PAGES)
    sample = labelled.where(F.pmod(F.xxhash64("html"), F.lit(one_in)) == 0)
    rows = (
        sample.mapInArrow(_count_features, "feature string, inside long, outside long")
        .groupBy("feature")
        .agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
        .collect()
    )
    return weights_from({r.feature: (r.inside, r.outside) for r in rows})


def extract_main_text(
    pages: DataFrame, weights: Mapping[str, float] | None = None, html: str = "html"
) -> DataFrame:
    """`pages` without the html, with the main `text` and its length `n_chars` in code points.

    Without `weights` they are learned from `pages`. Character references are decoded; white
    space is what Unicode calls so. A NULL or empty page, or one without words, has an empty
    text. Tags may be missing or overlap. Pages are read whole. Repeated rows come out alike, an
    empty table gives an empty result, and columns named as the results are replaced.
    """
    learned = learn_weights(pages, html) if weights is None else dict(weights)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in in_parts(batch, "html"):
                found = [main_text(page, learned) for page in texts_of(part, "html")]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        pa.array(found, pa.string()),
                        pa.array(map(len, found), pa.int64()),
                    ],
                    ["row", *RESULTS],
                )

    without = [c for c in pages.columns if c.lower() != html.lower()]
    row = row_of(pages, without)
    rows = pages.select(row, F.col(html).cast("string").alias("html"))
    schema = (
        T.StructType([rows.schema["row"]])
        .add("text", T.StringType())
        .add("n_chars", T.LongType())
    )
    return unpacked(rows.mapInArrow(run, schema), without, RESULTS)
