"""HTML main-text extraction by consensus host paths (operator 5).

1. On every page each container element is scored by the text directly in its
   blocks, less what stands in links; half of it counts for the parent.  A
   container's path is the chain of its tags and classes, with digits generalised, so
   that ``div.post-12`` and ``div.post-97`` vote together.
2. A page gives its best containers votes in proportion to their scores, and
   Spark adds up the votes by host and path.  The path with most votes wins the
   host (the smallest path on ties).
3. Every page is read again and the text of its containers on the winning path
   taken; a page without one falls back to its own best container, and without
   any container to all that isn't boilerplate.

Outside an article a page votes not for its best container itself, but for the lowest
ancestor that holds nearly all text of the page, or the main, so that a lead or a
summary beside the largest container stays.

Boilerplate never counts, wherever it stands: menus, headers, footers, sidebars,
notices, adverts, forms, comments, scripts, styles.  A class or id that only has such a
word as a part ('with-sidebar') doesn't drop a container that holds the page's article
or main or, on a page without one, most of its text.  A form or a container with such a
word as a whole class ('widget post-content') stays if the article or main with most of the
page's text is inside; a form also if it holds most of the text of a page without either.
Comments, adverts and consent notices go in any case.  A block's character references are decoded
and its white space collapsed; blocks are joined by one space.

A page is scanned once, and a container's path is the number of (parent's path, names), so time
and memory grow in proportion to the page.

Defined results: a null or empty page, or one without text, gives an empty
text; a null url belongs to the host "" ; repeated rows are extracted each;
a page may be of any length and broken: a tag that never ends ends the page, and an end tag
without a begin counts for nothing; other columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from html import unescape

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialize

MOST_HOSTS = 200_000        # winning paths that are broadcast; beyond, they are joined
MOST = 0.5                  # of an article or main inside a form or another such container
LANDMARK = 0.2              # share of a page's text that makes the first article or main its own
NEARLY = 0.9                # share of a page's text outside links that the article is to hold
PAGE_PATHS = 4              # containers that a page votes for
VOTES = 1000                # votes of a page

# A tag from its name on.  A quote counts after "=" only; one that is never closed is a character.
_TAG = re.compile(r"(/?)([a-zA-Z][a-zA-Z0-9:-]*)"
                  r"((?:[^>=]|=\s*+\"[^\"]*+\"|=\s*+'[^']*+'|=)*+)>")
_NAME = re.compile("/?[a-zA-Z]")
_RAW_END = {t: re.compile(rf"</{t}\b[^>]*>", re.I) for t in (
    "script", "style", "template", "noscript", "textarea", "title", "svg", "select", "iframe")}
_ATTR = re.compile(r"""([^\s"'>/=]+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*)))?""")
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd "
                    "label mark meter output q rp rt ruby s samp small span strike strong sub "
                    "sup time tt u var wbr picture source".split())
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_LEAF = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th pre blockquote figcaption caption "
                  "ul ol dl table thead tbody tfoot tr figure".split())
_CLOSED_BY = {"p": None, "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"},
              "tr": {"tr"}, "td": {"td", "th", "tr"}, "th": {"td", "th", "tr"},
              "option": {"option"}}
_DROP_TAGS = frozenset("nav header footer aside menu button dialog fieldset object "
                       "audio video canvas map head".split())
_DROP_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo "
                        "promotion banner nav navbar navigation menu breadcrumb breadcrumbs header "
                        "masthead footer sidebar aside cookie cookies consent notice notices popup "
                        "modal overlay comment comments reply replies disqus share sharing social "
                        "related recommended recommendations subscribe subscription newsletter "
                        "signup login search pagination pager widget toolbar skip".split())
# Of these, what holds no article in any case.
_NEVER_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsor sponsored promo "
                         "promotion cookie cookies consent popup modal overlay comment comments "
                         "reply replies disqus".split())
_DROP_ROLES = frozenset("navigation banner contentinfo complementary search form dialog "
                        "menu menubar alert".split())


class Page:
    """The containers and text blocks of one page."""

    def __init__(self, html: str):
        # containers: number of the path, parent, dropped, tag, dropped by a part of a class or
        # id, dropped as a form or by a whole class or id, where a block in it stands, its article
        self.paths, self.parents, self.dropped, self.tags = [0], [-1], [False], [""]
        self.doubtful, self.soft = [False], [False]
        self.holders, self.articles = [0], [0]
        self.numbers: dict[tuple[int, str], int] = {}
        self.blocks: list[tuple[int, str, int]] = []      # container, text, characters in links
        self._text: list[str] = []
        self._links = self._link = 0
        self._open: dict[str, int] = defaultdict(int)
        stack: list[tuple[str, int]] = [("", 0)]
        at, n = 0, len(html)
        while at < n:
            begin = html.find("<", at)
            if begin < 0:
                self._add(html[at:])
                break
            if begin > at:
                self._add(html[at:begin])
            if html.startswith("<!--", begin):
                end = html.find("-->", begin + 4)
                at = end + 3 if end >= 0 else n
                continue
            if html.startswith(("<!", "<?"), begin):
                end = html.find(">", begin)
                at = end + 1 if end >= 0 else n
                continue
            if not _NAME.match(html, begin + 1):
                self._add("<")
                at = begin + 1
                continue
            m = _TAG.match(html, begin + 1)
            if m is None:
                break
            at = m.end()
            tag = m[2].lower()
            if m[1]:
                self._end(tag, stack)
                continue
            if tag in _RAW_END:
                end = _RAW_END[tag].search(html, at)
                at = end.end() if end else n
                continue
            self._start(tag, m[3], stack)
        self._flush(stack[-1][1])
        self._settle()

    def _add(self, text: str) -> None:
        self._text.append(text)
        if self._link:
            self._links += len(text)

    def _flush(self, container: int) -> None:
        if self._text:
            text = " ".join(unescape("".join(self._text)).split())
            if text:
                self.blocks.append((container, text, min(self._links, len(text))))
            self._text = []
        self._links = 0

    def _start(self, tag: str, attributes: str, stack: list[tuple[str, int]]) -> None:
        if tag == "a":
            self._link = 1
        if tag in _INLINE:
            return
        self._flush(stack[-1][1])
        self._link = 0
        if tag in _VOID:
            return
        # end tags that may be left out
        while len(stack) > 1 and stack[-1][0] in _CLOSED_BY and (
                tag in (_CLOSED_BY[stack[-1][0]] or (tag,)) or stack[-1][0] == "p"):
            self._open[stack.pop()[0]] -= 1
        parent = stack[-1][1]
        names, drop, doubtful = tag, self.dropped[parent] or tag in _DROP_TAGS, False
        soft = tag == "form"
        for m in _ATTR.finditer(attributes) if attributes.strip() else ():
            kind, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
            if kind == "class":
                names += "".join(sorted("." + re.sub(r"\d+", "#", c) for c in value.split()))
            if kind == "role":
                drop |= value in _DROP_ROLES
            elif kind == "hidden":
                drop = True
            elif kind in ("class", "id") and tag not in ("html", "body", "article", "main"):
                whole = value.split()
                drop |= not _NEVER_WORDS.isdisjoint(whole)
                soft |= not _DROP_WORDS.isdisjoint(whole)
                doubtful |= not _DROP_WORDS.isdisjoint(re.split(r"[\s_-]+", value))
        number, key = len(self.paths), (self.paths[parent], names.replace(">", "_"))
        self.paths.append(self.numbers.setdefault(key, len(self.numbers) + 1))
        self.parents.append(parent)
        self.dropped.append(drop)
        self.doubtful.append(doubtful)
        self.soft.append(soft)
        self.tags.append(tag)
        self.holders.append(self.holders[parent] if tag in _LEAF else number)
        self.articles.append(number if tag == "article" else self.articles[parent])
        self._open[tag] += 1
        stack.append((tag, number))

    def _end(self, tag: str, stack: list[tuple[str, int]]) -> None:
        if tag == "a":
            self._link = 0
        if tag in _INLINE:
            return
        self._flush(stack[-1][1])
        while self._open[tag]:
            name = stack.pop()[0]
            self._open[name] -= 1
            if name == tag:
                return

    def _sizes(self, worth: list[int]) -> list[int]:
        """The sum of the blocks' ``worth`` in each container, with all inside it."""
        out = [0] * len(self.paths)
        for (container, _, _), n in zip(self.blocks, worth):
            out[container] += n
        for i in range(len(out) - 1, 0, -1):
            out[self.parents[i]] += out[i]
        return out

    def _landmark(self, size: list[int], share: float) -> int:
        """The first main, else the first article, with this share of the text; 0 without."""
        for tag in ("main", "article"):
            for i, t in enumerate(self.tags):
                if t == tag and size[i] and size[i] >= share * size[0]:
                    return i
        return 0

    def _up(self, at: int) -> set[int]:
        out = set()
        while at > 0:
            out.add(at)
            at = self.parents[at]
        return out

    def _inherit(self, drop: list[bool]) -> list[bool]:
        for i in range(1, len(drop)):
            drop[i] = drop[i] or drop[self.parents[i]]
        return drop

    def _outside(self, drop: list[bool]) -> list[int]:
        return self._sizes([0 if drop[c] else len(t) for c, t, _ in self.blocks])

    def _settle(self) -> None:
        """Drop forms and containers by a class or id ('header', 'site-header'), but for those
        that hold the page's article or main, or on a page without one most of its text."""
        if any(self.soft):
            without = self._inherit([a or b for a, b in zip(self.dropped, self.soft)])
            if not self._landmark(self._outside(without), LANDMARK):
                size = self._outside(self.dropped)
                mark = self._landmark(size, MOST)
                keep = self._up(mark) if mark else {
                    i for i, t in enumerate(self.tags) if t == "form" and 2 * size[i] > size[0]}
                without = self._inherit([d or s and i not in keep for i, (d, s) in enumerate(
                    zip(self.dropped, self.soft))])
            else:
                keep = set()
            self.dropped = without
            # what stays as a form or by a whole word is not doubted for a part of it
            self.doubtful = [d and i not in keep for i, d in enumerate(self.doubtful)]
        if not any(self.doubtful):
            return
        size = self._outside(self.dropped)
        mark = self._landmark(size, LANDMARK)
        keep = self._up(mark)
        self.dropped = self._inherit([
            d or q and not (i in keep if mark else 2 * size[i] > size[0])
            for i, (d, q) in enumerate(zip(self.dropped, self.doubtful))])

    def path(self, container: int) -> str:
        """A container's chain of tags and classes."""
        names = []
        number = self.paths[container]
        above = {n: key for key, n in self.numbers.items()}
        while number:
            number, name = above[number]
            names.append(name)
        return "".join(">" + n for n in reversed(names))

    def on_path(self, path: str | None) -> int:
        """The number of a path, or -1 if no container is on it."""
        if path is None:
            return -1
        number = 0
        for name in path.split(">")[1:]:
            number = self.numbers.get((number, name), -1)
            if number < 0:
                return -1
        return number

    def scores(self) -> dict[int, int]:
        out: dict[int, int] = defaultdict(int)
        for container, text, links in self.blocks:
            if self.dropped[container]:
                continue
            holder, worth = self.holders[container], 2 * max(0, len(text) - 2 * links)
            out[holder] += worth
            if holder:
                out[self.holders[self.parents[holder]]] += worth // 2
        best: dict[int, int] = defaultdict(int)
        for container, score in out.items():
            # an article's title and parts belong together
            best[self.articles[container] or container] += score
        return {c: s for c, s in best.items() if s > 0 and c}

    def best(self) -> list[tuple[int, int]]:
        """(container, score), best first."""
        return sorted(self.scores().items(), key=lambda x: (-x[1], x[0]))

    def best_parts(self) -> list[tuple[int, int]]:
        """(container, score) of the best containers, each gone up to the lowest ancestor with
        nearly all text of the page that is neither dropped nor in links, or to the main, so
        that an article's other parts stay beside its largest; an article is whole."""
        size = self._sizes([0 if self.dropped[c] else max(0, len(t) - 2 * links)
                            for c, t, links in self.blocks])
        out: dict[int, int] = defaultdict(int)
        for container, score in self.best()[:PAGE_PATHS]:
            at = container
            while at and self.tags[at] not in ("article", "main") and (
                    size[at] < NEARLY * size[0]):
                at = self.parents[at]
            out[at] += score
        return sorted(out.items(), key=lambda x: (-x[1], x[0]))

    def text(self, path: str | None) -> str:
        """The text on the winning path, or in the page's own best container."""
        number = self.on_path(path)
        chosen = {i for i, p in enumerate(self.paths) if p == number and not self.dropped[i]}
        if not chosen:
            best = self.best_parts()
            chosen = {best[0][0]} if best else {0}
        inside = [i in chosen for i in range(len(self.paths))]
        for i, parent in enumerate(self.parents):
            if parent >= 0 and inside[parent]:
                inside[i] = True
        return " ".join(t for c, t, _ in self.blocks if inside[c] and not self.dropped[c])


def _vote(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        votes: dict[tuple[str, str], int] = defaultdict(int)
        for host, html in zip(batch["host"], batch["html"]):
            if not html:
                continue
            page = Page(html)
            best = page.best_parts()
            total = sum(s for _, s in best)
            for container, score in best:
                votes[host, page.path(container)] += VOTES * score // total
        yield pd.DataFrame([(*k, v) for k, v in votes.items()],
                           columns=["host", "path", "votes"])


def _extract(html: pd.Series, path: pd.Series) -> pd.Series:
    return pd.Series([Page(h).text(p) if h else "" for h, p in zip(html, path)],
                     index=html.index, dtype=object)


def with_host(pages: DataFrame) -> DataFrame:
    host = F.lower(F.regexp_extract(F.coalesce("url", F.lit("")),
                                    r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1))
    return pages.withColumn("host", host)


def host_paths(pages: DataFrame) -> DataFrame:
    """host → the container path that most of its pages vote for, written."""
    votes = with_host(pages.select("url", "html")).select("host", "html").mapInPandas(
        _vote, "host string, path string, votes long")
    total = votes.groupBy("host", "path").agg(F.sum("votes").alias("votes"))
    won = total.groupBy("host").agg(F.min(F.struct(-F.col("votes"), "path")).alias("w"))
    return materialize(won.select(F.col("host").alias("won_host"),
                                  F.col("w.path").alias("path")), "host-paths")


def extract(pages: DataFrame) -> DataFrame:
    """``pages`` (page_id, url, html) → page_id, url, text."""
    pages = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    paths = host_paths(pages)
    if paths.count() <= MOST_HOSTS:
        paths = F.broadcast(paths)
    return (with_host(pages).join(paths, F.col("host") == F.col("won_host"), "left")
                            .select("page_id", "url", F.pandas_udf(_extract, "string")(
                                F.col("html"), F.col("path")).alias("text")))
