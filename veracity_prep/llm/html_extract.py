"""Main text of web pages by tree scoring.

The tags of a page make a tree; elements that end implicitly are closed as browsers do. Boilerplate elements (menus,
footers, asides, forms, scripts and the like, by tag or role, or because they are hidden) are left out with all they
hold. Words in class and id are evidence, weighed against what an element holds: one that holds the article or main
element is no boilerplate, whatever its name, and vague words (widget, related and the like) count only for an element
with less than half of the page's points, and inside an article only for a list of links. Every block of text gives points for its length and its commas to its parent, half of them to the grandparent,
a third to the next, less the share of its text that is links. The best container is kept, widened to the article or
main element it lies in, with siblings that score a fifth of it and headings right before it.

A block is the text between two block-level tags; its character references are decoded, white space becomes one
space, and blocks are joined in page order by two newlines. Nothing else is dropped or cut.

Nulls and edge cases: null, empty and tag-only pages give the empty text; text without any tag is one block. Repeated
rows are worked on each; extra columns stay out of the result.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Elements whose content is no markup; comments; tags; declarations.
TOKEN = re.compile(
    # A slash before the bracket closes foreign elements only.
    r"<!--.*?(?:-->|\Z)|<(script|style|noscript|template|iframe|textarea|title|xmp|noembed|noframes|(?:svg|math)(?![^>]*/>))\b[^>]*+>.*?(?:</\1\b[^>]*+>|\Z)"
    r"|<(/?)([a-z][^\s/<>]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+')*+)>|<(/?)([a-z][^\s/<>]*+)([^<>]*+)>|<[!?/][^<>]*+>",
    re.S | re.I,
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th thead tr ul button".split()
)
HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
#: Left out with all they hold.
DROPPED = frozenset("head nav footer aside form select button dialog menu search object embed canvas audio video map fieldset".split())
ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
#: Words of a class or id that name boilerplate, unless they say what a layout has or lacks; and words that may.
_APART = r"(?:^|(?<=[\s_-]))(?<!\bno[_-])(?<!\bhas[_-])(?<!\bwith[_-])(?<!\bwithout[_-])"
WORDS = re.compile(
    _APART + r"(?:ads?|advert\w*|adsense|sponsor\w*|promo\w*|banner|cookies?|consent|gdpr|notices?|alert|popup|modal|overlay|newsletter|subscri\w*|sidebar|"
    r"menu|nav|navbar|navigation|breadcrumbs?|footer|header|masthead|topbar|comments?|commentlist|disqus|replies|respond|share|sharing|social|"
    r"toolbar|pagination|pager|login|signup|skip)(?=$|[\s_-])",
    re.I,
)
VAGUE = re.compile(_APART + r"(?:side|reviews|related|recommended|widget)(?=$|[\s_-])", re.I)
#: Verdicts on an element: kept, left out for a vague or a clear word if it holds no content, left out.
KEPT, VAGUELY, CLEARLY, LEFT_OUT = range(4)
ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: What an opening tag closes: open elements of these names above the nearest barrier.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
    "tbody": {"tr", "td", "th", "thead", "tbody"}, "tfoot": {"tr", "td", "th", "thead", "tbody"}, "body": {"head"},
}
BARRIERS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}, "tbody": {"table"}, "tfoot": {"table"}, "body": set()}
NOT_IN_P = BLOCK - {"body", "html", "button", "option", "optgroup", "select", "head", "td", "th", "tr", "tbody", "thead", "tfoot", "caption", "legend"}
#: Elements that mark the page's content by themselves.
CONTENT = ("article", "main")
LEAST, SHARE = 10.0, 0.2


def verdict(tag: str, attributes: str, inside_content: bool) -> int:
    if tag in DROPPED or tag == "header" and not inside_content:
        return LEFT_OUT
    if not attributes or attributes.isspace() or tag in ("html", "body", "article", "main"):
        return KEPT
    found = KEPT
    for name, *values in ATTRIBUTE.findall(attributes):
        name, value = name.lower(), "".join(values)
        if name in ("class", "id"):
            found = max(found, CLEARLY if WORDS.search(value) else VAGUELY if VAGUE.search(value) else KEPT)
        if name == "role" and value.lower() in ROLES or name == "hidden" or name == "aria-hidden" and value.lower() == "true":
            return LEFT_OUT
        if name == "style" and re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", value, re.I):
            return LEFT_OUT
    return found


class Page:
    """Elements (tag, parent, verdict, whether inside content) and the blocks of text in page order.

    Open elements are counted by name, inline ones apart inside each open block, so that a stray end tag costs one
    lookup and every search closes what it passes: the work is linear in the page.
    """

    def __init__(self, source: str):
        self.tags, self.parents, self.verdicts, self.out, self.inside = ["#"], [-1], [KEPT], [False], [False]
        self.holders, self.blocks_open, self.inline_open = [0], Counter(), [Counter()]
        self.blocks: list[tuple[int, str, int]] = []  # element, text, characters in links
        self.open, self.parts, self.linked, self.links = [0], [], 0, 0
        at = 0
        for m in TOKEN.finditer(source):
            if m.start() > at:
                self.text(source[at : m.start()])
            at = m.end()
            tag = m[3] or m[6]
            if tag:
                (self.close if (m[2] or m[5]) else self.start)(tag.lower(), m[4] or m[7] or "")
            elif m[1]:
                self.text(" ")
        if at < len(source):
            self.text(source[at:])
        self.flush()

    def text(self, raw: str) -> None:
        if not self.out[self.open[-1]]:
            self.parts.append(raw)
            if self.links:
                self.linked += len(raw)

    def flush(self) -> None:
        if self.parts:
            text = " ".join(entities.unescape("".join(self.parts)).split())
            if text:
                self.blocks.append((self.holders[-1], text, min(self.linked, len(text))))
            self.parts, self.linked = [], 0

    def pop(self, depth: int) -> None:
        """Closes open elements down to ``depth``."""
        if any(self.tags[x] in BLOCK for x in self.open[depth:]):
            self.flush()
        for x in reversed(self.open[depth:]):
            tag = self.tags[x]
            self.links -= tag == "a"
            if tag in BLOCK:
                self.blocks_open[tag] -= 1
                self.holders.pop()
                self.inline_open.pop()
            else:
                self.inline_open[-1][tag] -= 1
        del self.open[depth:]

    def start(self, tag: str, attributes: str) -> None:
        if tag == "br":
            self.text(" ")
            return
        if tag in BLOCK:
            self.flush()
        if tag in VOID:
            return
        if tag in NOT_IN_P and self.blocks_open["p"]:
            for k in range(len(self.open) - 1, 0, -1):
                if self.tags[self.open[k]] == "p":
                    self.pop(k)
                    break
                if self.tags[self.open[k]] in BLOCK:
                    break
        if tag in CLOSES and any(self.blocks_open[x] for x in CLOSES[tag]):
            depth = None
            for k in range(len(self.open) - 1, 0, -1):
                name = self.tags[self.open[k]]
                if name in BARRIERS[tag]:
                    break
                if name in CLOSES[tag]:
                    depth = k
                elif depth:
                    break
            if depth:
                self.pop(depth)
        above = self.open[-1]
        found = verdict(tag, attributes, self.inside[above])
        self.tags.append(tag)
        self.parents.append(above)
        self.verdicts.append(found)
        self.out.append(self.out[above] or found == LEFT_OUT)
        self.inside.append(self.inside[above] or tag in CONTENT)
        self.open.append(len(self.tags) - 1)
        self.links += tag == "a"
        if tag in BLOCK:
            self.blocks_open[tag] += 1
            self.holders.append(self.open[-1])
            self.inline_open.append(Counter())
        else:
            self.inline_open[-1][tag] += 1

    def close(self, tag: str, _: str) -> None:
        # The end of an inline element doesn't close blocks.
        if self.blocks_open[tag] if tag in BLOCK else self.inline_open[-1][tag]:
            for k in range(len(self.open) - 1, 0, -1):
                if self.tags[self.open[k]] == tag:
                    self.pop(k)
                    return

    def leave_out(self, gains: list[float]) -> list[bool]:
        """Which elements are left out for the words in their class or id, by what they hold of the page's ``gains``."""
        n = len(self.tags)

        def held() -> tuple[list[float], list[int], list[int]]:
            points, size, linked = [0.0] * n, [0] * n, [0] * n
            for (holder, text, in_links), gain in zip(self.blocks, gains, strict=True):
                if not out[holder]:
                    points[holder] += gain
                    size[holder] += len(text)
                    linked[holder] += in_links
            for x in range(n - 1, 0, -1):  # parents come before their children
                for sums in (points, size, linked):
                    sums[self.parents[x]] += sums[x]
            return points, size, linked

        content = [tag in CONTENT for tag in self.tags]
        for x in range(n - 1, 0, -1):
            content[self.parents[x]] |= content[x]
        out = [False] * n
        for x in range(1, n):
            out[x] = out[self.parents[x]] or self.verdicts[x] == CLEARLY and not content[x]
        points, size, linked = held()
        for x in range(1, n):
            few_links = self.inside[self.parents[x]] and linked[x] < size[x] / 5
            vague = self.verdicts[x] == VAGUELY and not content[x] and not few_links and points[x] <= points[0] / 2
            out[x] = out[x] or out[self.parents[x]] or vague
        return out

    def main_text(self) -> str:
        if not self.blocks:
            return ""
        n = len(self.tags)
        gains = [(min(len(text) / 100, 3) + text.count(",") + (len(text) >= 25)) * (1 - in_links / len(text)) for _, text, in_links in self.blocks]
        out = self.leave_out(gains)
        gains = [g for g, (holder, _, _) in zip(gains, self.blocks, strict=True) if not out[holder]]
        self.blocks = [b for b in self.blocks if not out[b[0]]]
        points, size, linked = [0.0] * n, [0] * n, [0] * n
        for (holder, text, in_links), gain in zip(self.blocks, gains, strict=True):
            container = self.parents[holder] if self.tags[holder] in ("p", "li", "pre", "blockquote", "td", "dd") or self.tags[holder] in HEADINGS else holder
            for share in (1.0, 0.5, 1 / 3, 0.25):
                if container < 0:
                    break
                points[container] += gain * share
                container = self.parents[container]
            size[holder] += len(text)
            linked[holder] += in_links
        for x in range(n - 1, 0, -1):  # parents come before their children
            size[self.parents[x]] += size[x]
            linked[self.parents[x]] += linked[x]
        score = [p * (1 - (k / s if s else 0)) for p, k, s in zip(points, linked, size, strict=True)]
        best = max(range(n), key=lambda x: (score[x], -x))
        for wanted in CONTENT:
            above = best
            while above > 0 and self.tags[above] != wanted:
                above = self.parents[above]
            if above > 0:
                best = above
                break
        keep = {best}
        if best > 0:
            before = -1
            for x in range(1, n):
                if self.parents[x] != self.parents[best] or x == best:
                    continue
                if self.tags[x] in HEADINGS and x < best:
                    before = x
                dense = linked[x] / size[x] if size[x] else 1
                if self.tags[best] not in CONTENT and (score[x] >= max(LEAST, SHARE * score[best]) or self.tags[x] == "p" and dense < 0.25):
                    keep.add(x)
            if before > 0:
                keep.add(before)
        kept = [False] * n
        for x in range(n):
            kept[x] = x in keep or self.parents[x] >= 0 and kept[self.parents[x]]
        return "\n\n".join(text for holder, text, _ in self.blocks if kept[holder])


def main_text(source: str | None) -> str:
    return Page(source).main_text() if source else ""


def extract(html: Column) -> Column:
    """Main text of a column of pages."""

    @F.arrow_udf("string")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array((main_text(x.as_py()) for x in batch), pa.string(), size=len(batch))

    return run(html)


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text (empty if none) and n_chars (its code points) of every page."""
    found = pages.select("page_id", "url", extract(F.col("html")).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))
