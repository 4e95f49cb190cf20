"""Main text of web pages by the best-scoring run of words."""

from __future__ import annotations

import html
import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from strataset.session import hold

# Words of names, classes, ids and roles whose elements are not part of an article.
_ASIDE_TAGS = frozenset(
    "aside button canvas dialog embed footer head iframe input menu nav noscript object option script select "
    "style svg template textarea title".split()
)
_ASIDE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising alert banner breadcrumb breadcrumbs comment comments "
    "complementary consent contentinfo cookie cookies disqus footer form login masthead menu modal nav navbar "
    "navigation newsletter notice notices notification pager pagination popup promo promoted promotion recommended "
    "related replies reply search share sharebar sharing sidebar signup skip social sponsor sponsored subscribe "
    "subscription toolbar widget".split()
)
# Words that names of such elements have beside those; any other word makes a name something else.
_FRAME_WORDS = frozenset(
    "area article bar block body bottom box button col column container content entry fixed footer full global group "
    "head holder inner item items left link links list main mobile module outer overlay panel post primary right row "
    "secondary section site small sticky tertiary top unit wide wrap wrapper zone".split()
)
_HEADER_WORDS = frozenset({"header"})  # an article's own header holds its title and stays
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_PROSE = _HEADINGS | {"p"}
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark nobr q rp rt ruby s samp small "
    "span strike strong sub sup time tt u var wbr img".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_CONTENT = frozenset({"article", "main"})
_QUIET = frozenset({"noscript", "svg", "template"})  # tags inside cost nothing
_ENDS_PARAGRAPH = frozenset(
    "address article aside blockquote div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main nav ol p "
    "pre section table ul".split()
)
_SAME_ENDS = frozenset("li dt dd tr td th option".split())

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|textarea|iframe)(?=[\s/>])(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)"
    r"|<[!?][^>]*(?:>|\Z)",
    re.S | re.I,
)
# One attribute after the other with its whole value, so that no value is taken for a name.
_ATTRIBUTE = re.compile(r"""([^\s"'>/=][^\s>/=]*)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+)))?""")
_NAME = re.compile(r"[a-z]+|[A-Z]+(?![a-z])|[A-Z][a-z]+")


@dataclass
class Element:
    name: str
    marks: tuple[str, ...]  # its name and classes, as features
    aside: bool  # it or what it is in is not part of an article
    content: bool
    hard: bool = False  # it or what it is in is hidden or of a name that never holds an article
    soft: bool = False  # a word of its own, or its being a form, speaks against it; see `_unwrap`
    parent: Element | None = None
    quiet: bool = False
    named: bool = False  # its name or a class says so


@lru_cache(1 << 16)
def _names_aside(name: str, content: bool) -> bool:
    """Whether a class, id or role as a whole names an aside: `cookie-banner` and `sidebar_left` do, a
    name that has other words (`related-work`, `has-sidebar`) does not."""
    words = {w.lower() for w in _NAME.findall(name)}
    asides = _ASIDE_WORDS if content else _ASIDE_WORDS | _HEADER_WORDS
    return bool(words & asides) and words <= asides | _FRAME_WORDS


def _element(name: str, attributes: str, parent: Element | None) -> Element:
    marks, hard, soft, named = [name], name in _ASIDE_TAGS, name == "form", False
    content = name in _CONTENT or bool(parent and parent.content)
    for key, *values in _ATTRIBUTE.findall(attributes) if attributes else ():
        key, value = key.lower(), next(filter(None, values), "")
        if key == "hidden" or key == "aria-hidden" and value.lower() == "true":
            hard = True
        elif key == "style":
            hard |= "display:none" in value.replace(" ", "").lower()
        elif key in ("class", "id", "role"):
            names = value.split()
            marks += ["." + v.lower() for v in names]
            if name not in ("body", "html", "article", "main") and name not in _HEADINGS:
                named |= any(_names_aside(v, content) for v in names)
    named |= name == "header" and not content
    soft |= named
    hard |= bool(parent and parent.hard)
    return Element(name, tuple(marks), hard or soft or bool(parent and parent.aside), content, hard, soft, parent, name in _QUIET or bool(parent and parent.quiet), named)


def _path(element: Element | None) -> Iterator[Element]:
    """An element and what it is in, from the inside out."""
    while element:
        yield element
        element = element.parent


def _unwrap(elements: list[Element], texts: list[tuple[int, Element | None]]) -> None:
    """Takes the soft marks off wrappers that hold the main text.

    These are what the `article` or `main` of most words is in; words count that no mark inside of it
    excludes. On a page without such words they are the forms, such as some servers put around a whole
    page, that hold the most paragraphs and headings by their words, if these are ten times those under
    no mark. Elements are in page order, so parents come first.
    """
    articles: dict[int, list] = {}
    wrapped: dict[int, list] = {}
    free = 0
    for n, element in texts:
        if element and element.hard:
            continue
        prose = False
        for e in _path(element):
            prose |= e.name in _PROSE
            if e.soft:
                if prose and not e.named:
                    wrapped.setdefault(id(e), [0, e])[0] += n
                break
            if e.name in _CONTENT:
                articles.setdefault(id(e), [0, e])[0] += n
        else:
            free += n
    best = max((articles or wrapped).values(), key=lambda x: x[0], default=None)
    if not best or not articles and best[0] < 10 * free:
        return
    around = [e for e in _path(best[1]) if e.soft]
    for e in around:
        e.soft = False
    if around:
        for e in elements:
            e.aside = e.hard or e.soft or bool(e.parent and e.parent.aside)


def events(page: str) -> Iterator[tuple[str, object]]:
    """("tag", marks) and ("text", (words, stack)) in page order; a text ends at each block's edge.

    A wrapper of the main text is no aside, whatever it is called.
    """
    elements: list[Element] = []
    found = list(_parse(page, elements))
    if any(e.soft for e in elements):
        _unwrap(elements, [(len(value[0]), value[1]) for kind, value in found if kind == "text"])
    for kind, value in found:
        yield kind, (value[0], tuple(_path(value[1]))[::-1]) if kind == "text" else value


def _parse(page: str, elements: list[Element]) -> Iterator[tuple[str, object]]:
    """`events` with the innermost element of a text; all elements are added to `elements`.

    Elements nest as a browser would have them, as far as it matters here: an end tag closes what is
    open inside, and paragraphs, items and cells end where the next one starts.
    """
    stack: list[Element] = []
    held: list[str] = []
    last = 0
    final: dict[str, int] = {}  # where the last end tag of a name is

    def flush():
        words = html.unescape("".join(held)).split() if held else []
        held.clear()
        return ("text", (words, stack[-1] if stack else None)) if words else None

    def close(names, within=None) -> None:
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].name in names:
                del stack[i:]
                return
            if within and stack[i].name in within:
                return

    for m in _TOKEN.finditer(page):
        if m.start() > last:
            held.append(page[last : m.start()])
        last = m.end()
        name = m[3] or m[6]
        if not name:
            if m[1] and (found := flush()):
                yield found
            continue
        name, ending = name.lower(), bool(m[2] or m[5])
        if (name not in _INLINE or stack and stack[-1].name == "title") and (found := flush()):
            yield found
        if stack and stack[-1].name == "title":  # holds no elements, so it ends at any tag
            stack.pop()
            if ending and name == "title":
                continue
        if ending:
            quiet = bool(stack and stack[-1].quiet)
            close((name,))
            if not quiet:
                yield "tag", (name,)
            continue
        attributes = m[4] if m[3] else m[7]
        if name in _QUIET:
            if name not in final:
                final[name] = max((x.start() for x in re.finditer(f"</{name}(?=[\\s/>])", page, re.I)), default=-1)
            if attributes.endswith("/") or final[name] < m.end():  # closed already, or never
                continue
        if name in _ENDS_PARAGRAPH and stack and stack[-1].quiet:  # no elements of a drawing
            close(("svg",), ("foreignobject",))
        if name == "body":
            close(("head",))
        if name in _ENDS_PARAGRAPH:
            close(("p",), ("div", "td", "th", "li", "article", "main", "section", "button", "table", "blockquote"))
        if name in _SAME_ENDS:
            close((name,), ("ul", "ol", "dl", "table", "tbody", "select"))
        element = _element(name, attributes, stack[-1] if stack else None)
        elements.append(element)
        own = element.soft or element.hard and not (stack and stack[-1].hard)
        if own and name in _INLINE and (found := flush()):
            yield found
        if not element.quiet and name != "title":
            yield "tag", element.marks
        if name not in _VOID and not attributes.endswith("/"):
            stack.append(element)
    if last < len(page):
        held.append(page[last:])
    if found := flush():
        yield found


@dataclass
class Weights:
    """Log-odds of being in an article, per feature of a word's elements, and of a tag."""

    words: dict[str, float]
    tags: dict[str, float]
    base: float = 1.0
    most: float = 4.0
    least_tag: float = -4.0
    usual_tag: float = -0.05

    def word(self, stack: tuple[Element, ...]) -> float:
        get = self.words.get
        total = self.base + sum(get(mark, 0.0) for mark in {x for e in stack for x in e.marks})
        return max(-self.most, min(self.most, total))

    def tag(self, marks: tuple[str, ...]) -> float:
        return max(self.least_tag, min(self.usual_tag, min(self.tags.get(x, self.usual_tag) for x in marks)))


def best_region(scores: np.ndarray) -> tuple[int, int]:
    """The run of largest sum in one scan, as [start, end); the first of equals, (0, 0) if none is
    positive."""
    best, at, start, running = 0.0, (0, 0), 0, 0.0
    for i, s in enumerate(scores.tolist()):
        if running <= 0:
            running, start = 0.0, i
        running += s
        if running > best:
            best, at = running, (start, i + 1)
    return at


def main_text(page: str | None, weights: Weights) -> str:
    """The words of the best region outside menus, adverts and the like, joined by single spaces."""
    scores, texts = [], []
    for kind, value in events(page or ""):
        if kind == "tag":
            scores.append(weights.tag(value))
            texts.append(None)
        elif not (value[1] and value[1][-1].aside):
            words, stack = value
            scores.append(len(words) * weights.word(stack))
            texts.append(words)
    a, b = best_region(np.array(scores))
    return " ".join(" ".join(t) for t in texts[a:b] if t)


# ---- weights from labelled pages -----------------------------------------------------------------


def _labelled(page: str) -> list[tuple[str, str, bool, int]]:
    """(kind, feature, in the article, count) of a page that names its one article; else nothing."""
    found = list(events(page))
    for name in ("article", "main"):
        if sum(kind == "tag" and value[0] == name and len(value) >= 1 for kind, value in found) == 2:
            break
    else:
        return []
    out, inside = [], False
    for kind, value in found:
        if kind == "tag":
            if value[0] == name:
                inside = not inside
            else:
                out += [("tag", mark, inside, 1) for mark in value]
        else:
            words, stack = value
            aside = bool(stack and stack[-1].aside)
            out += [("word", mark, inside and not aside, len(words)) for mark in {x for e in stack for x in e.marks}]
            out.append(("word", "", inside and not aside, len(words)))
    return out


def fit(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", sample: int = 2000, smoothing: float = 5.0) -> Weights:
    """Weights from labelled pages: those that mark their article by one `article` or `main` element.

    At most `sample` pages are looked at, those of smallest hash of their id. Counts per feature are
    added up by Spark; features of one page alone are left out. Without labelled pages words score
    alike and every tag costs a little.
    """
    rows = pages.select(F.xxhash64(id_col).alias("pick"), F.col(html_col).alias("html"))
    last = rows.select("pick").orderBy("pick").limit(sample).agg(F.max("pick")).first()[0]
    if last is None:
        return Weights({}, {})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for page in batch.column(0).to_pylist():
                sums: dict[tuple[str, str], list[int]] = {}
                for kind, mark, inside, n in _labelled(page or ""):
                    sums.setdefault((kind, mark), [0, 0])[inside] += n
                if sums:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c) for c in zip(*[(k, m, out, in_) for (k, m), (out, in_) in sums.items()])],
                        names=["kind", "mark", "outside", "inside"],
                    )

    counts = (
        hold(rows.filter(F.col("pick") <= last).orderBy("pick").limit(sample).select("html"), "labelled-pages")
        .mapInArrow(count, "kind string, mark string, outside long, inside long")
        .groupBy("kind", "mark").agg(F.sum("outside").alias("o"), F.sum("inside").alias("i"), F.count(F.lit(1)).alias("pages"))
        .filter("pages > 1").collect()
    )
    sums = {kind: [max(1, sum(r[x] for r in counts if r.kind == kind and (kind == "tag" or r.mark == ""))) for x in ("o", "i")] for kind in ("word", "tag")}

    def odds(row) -> float:
        out, in_ = sums[row.kind]
        return math.log((row.i + smoothing) / (in_ + smoothing)) - math.log((row.o + smoothing) / (out + smoothing))

    return Weights(
        {r.mark: odds(r) for r in counts if r.kind == "word" and r.mark},
        {r.mark: odds(r) for r in counts if r.kind == "tag"},
    )


def extract(pages: DataFrame, weights: Weights, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """`pages` without the html column, with text and n_chars (code points). One scan, no shuffle.

    Null and empty pages, and pages without words outside menus and the like, have an empty text.
    Columns named text or n_chars are replaced.
    """
    kept = [c for c in pages.columns if c not in (html_col, "text", "n_chars")]
    schema = pages.select(*[F.col(f"`{c}`") for c in kept]).schema

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a in range(0, batch.num_rows, 200):
                part = batch.slice(a, 200)
                texts = [main_text(t.as_py(), weights) for t in part.column(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=[*kept, "text", "n_chars"],
                )

    return pages.select(*[F.col(f"`{c}`") for c in kept], F.col(html_col).alias("__page")).mapInArrow(
        make, schema.add("text", "string").add("n_chars", "long")
    )
