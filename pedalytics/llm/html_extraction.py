"""HTML extraction by a maximum-scoring subsequence of words and tags.

A page is read as a sequence of text pieces and tags. Words score positive and tags negative; both
weights come from labelled pages, those that mark their content with one ``article`` element: an
element (name and first class) is worth the log odds that words below it are content, a tag the share
in which it stands outside of content. Elements below one that is nearly never content are not blamed
for it: a list in a menu says nothing of lists. Standing beside the page's one article is a feature
like an element. What labels do not know gets a prior: ``PRIOR`` words outside for elements that HTML
itself defines as other than content, else none. One linear scan (the running sum, cut where it falls
below zero) finds the best contiguous region; of it, text below an element of log odds ``OUT`` or less
is not given out.

The training sample is bounded (``TRAIN`` pages); every page is extracted whole, in time linear in its
length however broken it is. Null and empty HTML give an empty text; a page without words too. Unclosed
elements, comments and scripts end with the page; a tag that no ``>`` ends is text, and quotes that
are never closed do not count. Of equally good regions the first is taken. Repeated rows give the same
text. An empty table gives no rows. Columns other than id, URL and HTML are ignored.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pedalytics.session import release, stage

TRAIN = 1000
PRIOR = 20  # words outside of content that an element of OTHER has before any label
OUT = -1.0
BESIDE = "beside the article"
_NAME = re.compile(r"/?([A-Za-z][A-Za-z0-9:-]*)")
_STOP = re.compile(r"[>\"']")
_CLASS = re.compile(r"""\bclass\s*=\s*["']?\s*([^\s"'>]+)""", re.I)
_ARTICLE = re.compile(r"<article\b", re.I)

# Elements that hold no text of the page, elements other than content, inline elements.
RAW = frozenset("script style noscript template textarea svg iframe".split())
OTHER = frozenset("nav footer header aside form button select option dialog menu head title".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img input ins kbd label mark q s samp small"
    " span strike strong sub sup time tt u var wbr".split()
)
_ENDS = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SELF_CLOSING = {"p": {"p"}, "li": {"li", "p"}, "tr": {"tr", "td", "th", "p"}, "td": {"td", "th", "p"}, "th": {"td", "th", "p"},
                "dt": {"dt", "dd", "p"}, "dd": {"dt", "dd", "p"}}
CLOSES_P = frozenset("article aside blockquote div dl fieldset footer form h1 h2 h3 h4 h5 h6 header hr main nav ol"
                     " pre section table ul".split())


def tokens(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", text, ""), ("open", name, attributes) and ("close", name, "") in page order.

    The scanner only moves forward: what is not found once to the end of the page is not looked for again.
    """
    at, size, more, quotes = 0, len(page), True, {'"', "'"}
    while at < size:
        start = page.find("<", at)
        if start < 0 or not more:
            yield "text", page[at:], ""
            return
        if start > at:
            yield "text", page[at:start], ""
        if page.startswith("<!--", start):
            end = page.find("-->", start + 4)
            at = size if end < 0 else end + 3
            continue
        named = _NAME.match(page, start + 1)
        if named is None and page[start + 1 : start + 2] not in ("!", "?"):
            yield "text", "<", ""
            at = start + 1
            continue
        first = page.find(">", start)
        if first < 0:  # no tag ends any more
            more, at = False, start
            continue
        end = first
        if named and quotes:
            end, mark = -1, named.end()
            while stop := _STOP.search(page, mark):
                mark = stop.end()
                if stop[0] == ">":
                    end = stop.start()
                    break
                if stop[0] in quotes:
                    close = page.find(stop[0], mark)
                    if close < 0:
                        quotes.discard(stop[0])
                    else:
                        mark = close + 1
            if end < 0:
                end, quotes = first, set()
        at = end + 1
        if named is None:
            continue
        name = named[1].lower()
        if page[start + 1] == "/":
            yield "close", name, ""
        elif name in RAW:
            found = _ENDS[name].search(page, at)
            at = found.end() if found else size
        else:
            yield "open", name, page[named.end() : end]


class Walk:
    """The open elements of a page; ``enter`` and ``leave`` are called for each, with what it has inherited."""

    def __init__(self, page: str, enter, leave=lambda element: None):
        self.page, self.enter, self.leave = page, enter, leave
        self.stack: list[tuple[str, object]] = []
        self.names: Counter = Counter()
        self.only = len(_ARTICLE.findall(page)) == 1

    def top(self, default):
        return self.stack[-1][1] if self.stack else default

    def pop(self) -> str:
        name, element = self.stack.pop()
        self.names[name] -= 1
        self.leave(element)
        return name

    def pieces(self) -> Iterator[tuple[str, str, bool]]:
        """("text", text, False) or ("tag", name, block?); the stack is as of that piece."""
        for kind, name, attributes in tokens(self.page):
            if kind == "text":
                yield "text", name, False
            elif kind == "close":
                yield "tag", name, name not in INLINE
                if self.names[name] > 0:
                    while self.pop() != name:
                        pass
            else:
                shut = SELF_CLOSING.get(name) or (("p",) if name in CLOSES_P else ())
                while self.stack and self.stack[-1][0] in shut:
                    self.pop()
                yield "tag", name, name not in INLINE
                if name not in VOID and name not in INLINE and not attributes.endswith("/"):
                    self.names[name] += 1
                    self.stack.append((name, self.enter(self.key(name, attributes))))
        while self.stack:
            self.pop()

    def key(self, name: str, attributes: str) -> str:
        """Name and first class; a header or footer of the article itself is another thing than the page's."""
        if name in ("header", "footer") and self.names["article"] > 0:
            name = "article " + name
        found = _CLASS.search(attributes) if "=" in attributes else None
        return f"{name}.{found[1].lower()}" if found else name


def count_labels(page: str, seen: dict[str, list[int]], weights: dict[str, float]) -> None:
    """Words below each element, and each tag, inside and outside of the page's one article.

    Elements and tags below one that ``weights`` holds for other than content are left out.
    """

    def shielded() -> bool:
        above = walk.top(None)
        return above is not None and (above[3] or weights.get(above[0], 0.0) <= OUT)

    def enter(key: str) -> list:
        return [key, 0, 0, shielded()]  # key, words inside, words outside, shielded

    def leave(element: list) -> None:
        above = walk.top(None)
        if above is not None:
            above[1] += element[1]
            above[2] += element[2]
        if not element[3] and element[0] not in ("html", "body"):  # these hold all there is
            seen[element[0]][0] += element[1]
            seen[element[0]][1] += element[2]

    walk = Walk(page, enter, leave)
    if not walk.only:
        return
    for kind, text, _ in walk.pieces():
        outside = not walk.names["article"]
        if kind == "tag":
            if text not in ("article", "html", "body", "main") and not shielded():
                seen["<" + text][outside] += 1
            continue
        words = len(text.split())
        if words and walk.stack:
            walk.stack[-1][1][1 + outside] += words
            if outside:
                seen[BESIDE][1] += words


def weigh(counts: dict[str, tuple[int, int]]) -> dict[str, float]:
    """Element: log odds of content, within -3 and 3; tag (key with <): minus its share outside."""
    out = {}
    for key in {*counts, *OTHER}:
        inside, outside = counts.get(key, (0, 0))
        if key[0] == "<":
            out[key] = -outside / (inside + outside)
        else:
            outside += PRIOR * (key.partition(".")[0] in OTHER)
            out[key] = max(-3.0, min(3.0, math.log((inside + 1) / (outside + 1))))
    return out


def extract(page: str | None, weights: dict[str, float], tag: float = -0.5) -> str:
    """Main text: blocks joined by a line feed."""
    if not page:
        return ""

    def enter(key: str) -> float:
        """The least log odds of an element and those it stands in; an unknown class counts as its plain element."""
        known = weights.get(key)
        if known is None:
            known = weights.get(key.partition(".")[0], 0.0) if key.partition(".")[0] in OTHER else 0.0
        return min(walk.top(0.0), known)

    walk = Walk(page, enter)
    beside = weights.get(BESIDE, 0.0) if walk.only else 0.0
    blocks: list[list[str]] = [[]]
    worth = [0.0]
    for kind, text, block in walk.pieces():
        if kind == "tag":
            worth[-1] += weights.get("<" + text, tag)
            if block:
                blocks.append([])
                worth.append(0.0)
            elif text == "br":
                blocks[-1].append(" ")
            continue
        text = entities.unescape(text)
        least = min(walk.top(0.0), 0.0 if walk.names["article"] else beside)
        worth[-1] += len(text.split()) * (least if least < 0 else 1.0)
        if least > OUT:
            blocks[-1].append(text)
    best = run = 0.0
    begin = first = last = 0
    for i, s in enumerate(worth):
        if run <= 0:
            run, begin = 0.0, i
        run += s
        if run > best:
            best, first, last = run, begin, i + 1
    found = (" ".join("".join(b).split()) for b in blocks[first:last])
    return "\n".join(b for b in found if b)


def learned_weights(pages: DataFrame, html_col: str = "html", train: int = TRAIN) -> dict[str, float]:
    """Weights from at most ``train`` labelled pages, those with the least hashes."""
    labelled = pages.where(F.col(html_col).rlike("(?i)<article\\b")).select(html_col)
    sample = labelled.select(F.xxhash64(html_col).alias("h"), F.col(html_col).alias("page"))
    n = sample.count()
    if n > 4 * train:  # fewer rows to order: hashes are uniform, so this part holds enough
        sample = sample.where(F.col("h").bitwiseAND((1 << 40) - 1) < int((1 << 40) * 2.0 * train / n))
    sample = sample.select("page").limit(train).repartition(8) if n <= train else sample.orderBy("h").limit(train).select("page")

    sample = stage(sample, "labelled-pages")
    weights: dict[str, float] = {}
    for _ in range(2):  # the second time, what stands below a menu is not blamed for it

        def count(batches: Iterator[pa.RecordBatch], weights=weights) -> Iterator[pa.RecordBatch]:
            seen: dict[str, list[int]] = defaultdict(lambda: [0, 0])
            for batch in batches:
                for page in batch.column(0):
                    count_labels(page.as_py() or "", seen, weights)
            rows = [(k, a, b) for k, (a, b) in seen.items() if a + b]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.int64())], names=["key", "inside", "outside"])

        counted = sample.mapInArrow(count, "key string, inside long, outside long")
        counted = counted.groupBy("key").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside"))
        weights = weigh({r["key"]: (r["inside"], r["outside"]) for r in counted.collect()})  # elements of the sample only
    release(sample)
    return weights


def main_text(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", train: int = TRAIN
) -> DataFrame:
    """(id, url, text, n_chars) for every row of ``pages``."""
    weights = learned_weights(pages, html_col, train)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [extract(page.as_py(), weights) for page in part.column(2)]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()),
                     pa.array([len(t) for t in texts], pa.int64())], names=[id_col, url_col, "text", "n_chars"])

    rows = pages.select(F.col(id_col).cast("long"), F.col(url_col).cast("string"), html_col)
    return rows.mapInArrow(run, f"`{id_col}` long, `{url_col}` string, text string, n_chars long")


def op8_html_extraction(spark, sf_dir):
    """Main text of every page."""
    return main_text(spark.read.parquet(f"{sf_dir}/pages.parquet"))
