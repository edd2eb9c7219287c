"""Main text of HTML pages from streamed parser events.

Events of the standard library's parser are folded into lines, one per block of text.
A line's text-to-tag ratio is its characters over its tags, links counted as tags of
their own; ratios are smoothed with a Gaussian along the page and split into two clusters.
Lines of the upper cluster, and headings of the first level, are content. Article and main
parts that together hold most of their text are the article; without such, the innermost
element that holds all of them is. Its lines stand, short ones between long ones included, but not
lines that are mostly links nor those in parts that are something else by their element
(navigation, header, footer, aside, form, script) or by a name in their class or id (advert,
notice, comments, sidebar). A name never costs the article: phrases (`no-sidebar`,
`search-for-life`) are no such names, and a named part stands if it holds over half of the
page's text and an article, main or first-level heading of its own (comments: such a heading),
or, on pages without any of these, at least three blocks.

Null, empty or text-free html: empty text, 0 characters. Tags left open are closed by
what follows them, a head by the first thing that can't stand in it; a link that is never closed ends with its block. Repeated rows are judged each for itself.
"""

from __future__ import annotations

import math
import re
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import table

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
HIDDEN = frozenset("script style noscript template head title svg math canvas object iframe audio video".split())
CONTROLS = frozenset("nav header footer aside form button select option textarea input label fieldset dialog menu".split())
HEAD_ONLY = frozenset("html head title meta link base script style noscript template".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br".split()
)
CONTAINERS = frozenset("article main section div td body html table tbody tr center blockquote".split())
OTHER_PART = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertisements?|advertising|sponsor(?:ed)?|promos?|promotions?|banners?|cookies?|consent|gdpr|notices?|alerts?"
    r"|nav|navbar|navigation|menus?|breadcrumbs?|sidebars?|aside|widgets?|related|recommended|share|sharing|social|newsletter|subscribe|signup"
    r"|login|popups?|modals?|overlay|footer|header|masthead|pagination|pager|toolbar|skip|search|comments?|discussion|replies|respond|disqus)(?:$|[\s_-])",
    re.IGNORECASE,
)
#: A name with such a word is a phrase about the part, not the part's kind.
PHRASE = re.compile(r"^(?:no|not|has|with|without)[_-]|[_-](?:for|of)[_-]", re.IGNORECASE)
COMMENTS = re.compile(r"comment|discussion|replies|respond|disqus", re.IGNORECASE)
ROLES = frozenset("navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split())
#: Line distance at which smoothing has fallen to 60 %.
SPREAD = 1.0


def part_names(named: str) -> str:
    """The names in class and id values that tell a part other than the article."""
    return " ".join(x for x in named.split() if OTHER_PART.search(x) and not PHRASE.search(x))


class Lines(HTMLParser):
    """Blocks of a page in order, as parser events come in."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.open: list[tuple] = []  # (tag, state around it)
        self.out: list[dict] = []
        self.text: list[str] = []
        self.tags = 0
        self.links = 0
        self.late = 0  # linked characters of the line if a link from an earlier block is closed yet
        self.unsure: list[tuple] = []  # (line, such characters)
        self.link = self.past = False  # within a link; past the block it began in
        self.number = 0
        self.kinds: dict[int, str] = {}
        self.heading = False
        self.anchored: dict[int, bool] = {}  # per part of such a name: an article or main begins in it
        self.comment_parts: set[int] = set()
        self.state = (False, False, False, (), ())  # excluded, in comments, hidden, container path, named parts

    def flush(self):
        text = " ".join("".join(self.text).split())
        if text:
            excluded, _, hidden, path, named = self.state
            self.out.append({"text": text, "tags": self.tags, "links": self.links, "out": excluded or hidden, "path": path, "named": named, "heading": self.heading})
            self.unsure.append((self.out[-1], self.late))
        self.text, self.tags, self.links, self.late, self.heading = [], 0, 0, 0, False
        self.past = self.link

    def end_link(self, closed: bool):
        """The link ends, by its end tag or by what follows it."""
        if self.link and closed:
            self.links += self.late
            for line, late in self.unsure:
                line["links"] += late
        self.link, self.past, self.late, self.unsure = False, False, 0, []

    def close_from(self, k: int):
        """Close the k-th open element and those in it."""
        if any(x[0] == "a" for x in self.open[k + 1 :]):
            self.end_link(False)
        self.state = self.open[k][1]
        del self.open[k:]

    def end_head(self, last: bool):
        """Close a head that is open, if nothing in it is or if `last` things no longer count."""
        for k, (tag, _) in enumerate(self.open):
            if tag == "head" and (last or k == len(self.open) - 1):
                self.close_from(k)
                return

    def handle_starttag(self, tag, attrs):
        if tag not in INLINE:
            self.flush()
        if tag not in HEAD_ONLY:
            self.end_head(tag == "body")
        self.tags += 1
        if tag == "br" or tag == "img":
            self.text.append(" ")
        if tag in VOID:
            return
        if tag == "p" or tag not in INLINE:
            self.close_open({"p"})
        if tag in ("li", "td", "th", "tr", "dt", "dd", "option"):
            self.close_open({tag} | ({"td", "th"} if tag in ("td", "th", "tr") else set()) | ({"dt", "dd"} if tag in ("dt", "dd") else set()), stop=("ul", "ol", "table", "dl", "select"))
        if tag == "a":
            self.end_link(False)
            self.link = True
        self.heading = self.heading or tag == "h1"
        excluded, comments, hidden, path, within = self.state
        values = dict(attrs)
        names = "" if tag in ("body", "html") else part_names(" ".join(values.get(k) or "" for k in ("class", "id")))
        other = tag in CONTROLS or (values.get("role") or "") in ROLES or "hidden" in values or (values.get("aria-hidden") == "true")
        if tag in ("body", "html"):
            other = False
        # an article or main part begins afresh where something before it was left open
        fresh = tag in ("article", "main") and not (comments or COMMENTS.search(names)) and not hidden
        excluded = other or (excluded and not fresh)
        if tag in ("article", "main"):
            for part in within:
                self.anchored[part] = True
        if fresh:
            within = ()
        if names:
            part = len(self.anchored)
            self.anchored[part] = False
            within = (*within, part)
            if COMMENTS.search(names):
                comments = True
                self.comment_parts.add(part)
        if tag in ("header", "h1") and any(x[0] in ("article", "main") for x in self.open) and not self.state[0] and not names:
            excluded = excluded and tag != "header"  # an article's own heading
        if tag in CONTAINERS:
            self.number += 1
            self.kinds[self.number] = tag
            path = (*path, self.number)
        self.open.append((tag, self.state))
        self.state = (excluded, comments, hidden or tag in HIDDEN, path, within)

    def close_open(self, tags, stop=()):
        """Close the innermost open one of these tags, unless a stopping element is nearer."""
        for k in range(len(self.open) - 1, -1, -1):
            tag = self.open[k][0]
            if tag in tags:
                self.close_from(k)
                return
            if tag in stop or (tags == {"p"} and tag in CONTAINERS):
                return

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.flush()
        self.tags += 1
        if tag == "a":
            self.end_link(True)
        for k in range(len(self.open) - 1, -1, -1):
            if self.open[k][0] == tag:
                self.close_from(k)
                return

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_data(self, data):
        if self.open and self.open[-1][0] == "head" and not data.isspace():
            self.end_head(False)
        if self.state[2]:
            return
        self.text.append(data)
        if self.past:
            self.late += len(data)
        elif self.link:
            self.links += len(data)


def smooth(x: np.ndarray, spread: float = SPREAD) -> np.ndarray:
    reach = math.ceil(3 * spread)
    kernel = np.exp(-(np.arange(-reach, reach + 1) ** 2) / (2 * spread * spread))
    return np.convolve(np.pad(x, reach, mode="edge"), kernel / kernel.sum(), "valid")


def two_clusters(x: np.ndarray) -> float:
    """The threshold between the lower and the upper of two means."""
    low, high = float(x.min()), float(x.max())
    while True:
        cut = (low + high) / 2
        if not (x > cut).any() or (x > cut).all():
            return cut
        new = float(x[x <= cut].mean()), float(x[x > cut].mean())
        if new == (low, high):
            return cut
        low, high = new


def other_parts(parser: Lines) -> set[int]:
    """The named parts that are not the article."""
    held, blocks = dict.fromkeys(parser.anchored, 0), dict.fromkeys(parser.anchored, 0)
    headed, total, anchors = set(), 0, False
    for x in parser.out:
        if x["out"]:
            continue
        total += len(x["text"])
        anchors = anchors or x["heading"] or any(parser.kinds[c] in ("article", "main") for c in x["path"])
        for part in x["named"]:
            held[part] += len(x["text"])
            blocks[part] += 1
            if x["heading"]:
                headed.add(part)

    def article(part):
        own = part in headed or (part not in parser.comment_parts and (parser.anchored[part] or (not anchors and blocks[part] >= 3)))
        return own and 2 * held[part] > total

    return {part for part in parser.anchored if not article(part)}


def main_text(html: str | None) -> str:
    """The article's blocks, joined by an empty line."""
    if not html:
        return ""
    parser = Lines()
    parser.feed(html)
    parser.close()
    parser.flush()
    lines = parser.out
    for x in lines:
        x["out"] = x["out"] or 2 * x["links"] > len(x["text"])
    others = other_parts(parser)
    for x in lines:
        x["out"] = x["out"] or not others.isdisjoint(x["named"])
    if all(x["out"] for x in lines):
        return ""
    ratio = np.array([0.0 if x["out"] else len(x["text"]) / max(1, x["tags"]) for x in lines])
    level = np.log1p(smooth(ratio))
    content = level > two_clusters(level)
    if level.max() - level.min() < 0.5:
        content[:] = True  # one cluster only
    good = [x for x, upper in zip(lines, content, strict=True) if (upper or x["heading"]) and not x["out"]]
    # the outermost article and main parts that hold content
    parts = {next((c for c in x["path"] if parser.kinds[c] in ("article", "main")), 0) for x in good} - {0}
    inside = sum(len(x["text"]) for x in good if parts & {*x["path"]})
    if 2 * inside > sum(len(x["text"]) for x in good):
        lines = [x for x in lines if parts & {*x["path"]}]
    elif good:
        # the innermost element that holds all of the content; a quotation is part of what is around it
        shared = [c for c in good[0]["path"] if all(c in x["path"] for x in good)]
        while shared and parser.kinds[shared[-1]] == "blockquote":
            shared.pop()
        lines = [x for x in lines if not shared or shared[-1] in x["path"]]
    return "\n\n".join(x["text"] for x in lines if not x["out"])


def extract(pages: DataFrame, id_col: str = "page_id", keep: tuple = ("url",), html_col: str = "html") -> DataFrame:
    """(id, kept columns, text, n_chars) for every row."""
    own = pages.select(F.col(id_col), *keep, F.col(html_col).cast("string").alias("_html"))

    def run(batches):
        for batch in batches:
            found = [main_text(h) for h in batch.column(batch.num_columns - 1).to_pylist()]
            columns = [batch.column(k) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.string()), pa.array([len(t) for t in found], pa.int64())], names=[*batch.schema.names[:-1], "text", "n_chars"])

    head = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in own.schema.fields[:-1])
    return own.mapInArrow(run, f"{head}, text string, n_chars long")


def op3_html_text(spark, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))
