"""Main text of web pages by consensus paths of their hosts (operator 6).

Every page is read into containers and text blocks.  Text set apart as menu,
header, footer, sidebar, notice, advert, form, script, style or reader comment
does not count, nor does the text of container paths (tags and classes, numbers
generalised) that say the same on most of at least ``REPEATS`` different pages
of a host; pages whose largest container says the same are one page.  The page's
best container is the innermost one that holds all other text but links.  Its
path is the page's vote; Spark counts the votes of each host, and every page is
then extracted again from the containers on its host's winning path.  A page
that has no such container, or other text beside it that counts, keeps its own
best one, and so does one without a host.

Null and empty pages have an empty text.  Ties between paths go to the one with
more text, then to the greater path hash.  Repeated rows vote each and are
extracted alike.  Unclosed and misplaced tags are closed where an enclosing
one ends; a tag that never ends is text.  Pages are read once from front to back,
and containers know their path by a hash, so that very long and very deep pages
take linear time; a page is held whole.  Only the id, url and html columns are
read.  An empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.sink import materialize
from . import textvec as tv
from .ngram_join import BROADCAST_ROWS

# HTML element names by what they do here.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
DROPPED = frozenset("head script style noscript template iframe nav footer aside form button select option textarea title svg canvas object dialog menu".split())
BLOCKS = frozenset(
    "address article aside blockquote body br caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split()
)
CONTAINERS = frozenset("body article main section div td center details figure blockquote table tbody tr ul ol".split())
REPEATS = 3  # pages of a host that say the same before that is no page's own text
HEADINGS = frozenset(["h1", "h2"])
NEVER_DROPPED = frozenset(["html", "body", "article", "main"])
# Words of class and id names that set a container apart.
APART = frozenset(
    "nav navbar navigation menu menubar masthead header topbar footer sidebar aside rail notice notices alert cookie cookies consent gdpr banner ad ads advert adverts advertisement sponsor sponsored promo promotion share sharing social related recommended breadcrumb breadcrumbs pagination pager comment comments commentlist disqus respond replies reply newsletter subscribe subscription signup login popup modal overlay paywall widget".split()
)
# Words that name a subject as well: inside an article they set apart only what is mostly links.
SUBJECTS = frozenset("social related rail recommended promotion subscription respond reply replies alert banner widget".split())
# Words that make a name speak of what is missing or beside: no-sidebar, has-menu, comments-off.
MODIFIERS = frozenset("no not non without has with hide hidden open opened closed close off on free is toggle toggled active enabled disabled left right".split())
COMMENT_WORDS = frozenset("comment comments commentlist disqus respond replies reply".split())
ARTICLE_WORDS = frozenset("article entry post story content".split())

_NAME = re.compile(r"(/?)([a-zA-Z][^\s/>]*+)")
# The rest of a tag: names, and values after an equals sign; quotes elsewhere are characters.
_REST = re.compile(r"""(?:[^>"'=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s>"']*+)|["'])*+>""")
_ATTRIBUTE = re.compile(r"""([^\s/>=]++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]*+)))?""")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_SPACE = re.compile(r"\s+")


@lru_cache(maxsize=1 << 14)
def _hash(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def _below(key: int, step: str) -> int:
    """The hash of a path one step longer, as a signed 64-bit number."""
    mixed = ((key ^ 0x5851F42D4C957F2D) * 0x9E3779B97F4A7C15 + _hash(step)) & 0xFFFFFFFFFFFFFFFF
    mixed ^= mixed >> 29
    return mixed - (1 << 64) if mixed >> 63 else mixed


def path_key(path: str) -> int:
    """The hash of a path written as steps (tag and classes) with ``>`` between them."""
    key = 0
    for step in path.split(">"):
        key = _below(key, step)
    return key


def attributes_of(source: str) -> dict[str, str]:
    """Attribute values by lower-cased name; the first of a name counts."""
    out: dict[str, str] = {}
    for name, double, single, bare in _ATTRIBUTE.findall(source):
        out.setdefault(name.lower(), double or single or bare)
    return out


class Tags:
    """Reads tags from front to back; each character is looked at a bounded number of times."""

    def __init__(self, source: str):
        self.source, self.unbalanced, self.ended = source, False, False

    def at(self, start: int) -> tuple[int, str, str, str] | None:
        """(end, slash, name, attributes) of the markup at a ``<``; no name for comments; None if it is text."""
        source = self.source
        if source.startswith("<!--", start):
            end = source.find("-->", start + 4)
            return (end + 3 if end >= 0 else len(source)), "", "", ""
        if self.ended:
            return None
        m = _NAME.match(source, start + 1)
        if not m:
            return self._to(source.find(">", start), "", "", start) if source[start + 1 : start + 2] in ("!", "?") else None
        if not self.unbalanced:
            rest = _REST.match(source, m.end())
            if rest:
                return rest.end(), m[1], m[2].lower(), source[m.end() : rest.end() - 1]
            self.unbalanced = True  # a quote is open to the end of the page: no more quotes are heeded
        return self._to(source.find(">", m.end()), m[1], m[2].lower(), m.end())

    def _to(self, end: int, slash: str, name: str, begin: int) -> tuple[int, str, str, str] | None:
        if end < 0:
            self.ended = True
            return None
        return end + 1, slash, name, self.source[begin:end] if name else ""


class Page:
    """Containers (by number, the parent's number smaller) and text blocks of one page."""

    def __init__(self, source: str, repeated: list[int] | None = None):
        self.repeated = frozenset(repeated or ())
        self.tag, self.parent, self.keys, self.apart, self.heading = ["html"], [-1], [_below(0, "html")], [False], [False]
        self.by_name = [False]  # set apart by its class or id alone, not by one of a reader's comments
        self.by_subject = [False]  # set apart by a word that may be the article's subject
        self.in_article = [False]
        self.blocks: list[tuple[int, str, int]] = []  # container, text, characters in links
        self._counted: tuple[list[bool], list[int]] | None = None
        self._read(source)

    def _open(self, tag: str, attributes: str, parent: int) -> int:
        names = attributes_of(attributes) if attributes and "=" in attributes or "hidden" in attributes.lower() else {}
        tokens = [re.split(r"[^a-z0-9]+", t) for t in f"{names.get('class', '')} {names.get('id', '')}".lower().split()]
        words = {w for t in tokens if len(t) == 1 or MODIFIERS.isdisjoint(t) for w in t}
        apart, subject = tag in DROPPED, False
        if tag == "header" and (self.in_article[parent] or self._inside_main(parent)):
            words = set()
        elif tag == "header":
            apart = True
        elif tag not in NEVER_DROPPED and not APART.isdisjoint(words):
            apart = not (APART.intersection(words) <= {"header", "banner"} and not ARTICLE_WORDS.isdisjoint(words))
            subject = tag not in DROPPED and self.in_article[parent] and APART.intersection(words) <= SUBJECTS
        by_name = apart and tag not in DROPPED and tag != "header" and COMMENT_WORDS.isdisjoint(words)
        if tag == "article" and not {"comment", "comments", "reply", "respond"}.isdisjoint(words):
            apart, subject = True, False  # a reader's comment in an element of its own
        if ("hidden" in names or _NO_DISPLAY.search(names.get("style", ""))) and tag not in NEVER_DROPPED:
            apart, by_name, subject = True, False, False
        if names.get("role", "").lower() in ("navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog"):
            apart, by_name, subject = True, False, False
        classes = ".".join(sorted({re.sub(r"\d+", "#", c) for c in names.get("class", "").split()}))
        self.tag.append(tag)
        self.parent.append(parent)
        self.keys.append(_below(self.keys[parent], tag + ("." + classes if classes else "")))
        self.apart.append(apart)
        self.by_name.append(by_name)
        self.by_subject.append(subject)
        self.in_article.append(self.in_article[parent] or tag == "article" and not apart)
        self.heading.append(False)
        return len(self.tag) - 1

    def _inside_main(self, node: int) -> bool:
        while node >= 0:
            if self.tag[node] in ("article", "main"):
                return True
            node = self.parent[node]
        return False

    def _read(self, source: str) -> None:
        # open elements: (tag, container number); inline ones stay in their container
        stack: list[tuple[str, int]] = [("html", 0)]
        opened: Counter[str] = Counter()
        text: list[str] = []
        links = link_depth = 0
        tags = Tags(source)

        def flush() -> None:
            nonlocal links
            if text:
                joined = _SPACE.sub(" ", html.unescape("".join(text))).strip()
                if joined:
                    self.blocks.append((stack[-1][1], joined, min(links, len(joined))))
                text.clear()
            links = 0

        def push(tag: str, node: int) -> None:
            stack.append((tag, node))
            opened[tag] += 1

        def cut(k: int) -> None:
            opened.subtract(t for t, _ in stack[k:])
            del stack[k:]

        at, size = 0, len(source)
        while at < size:
            begin = source.find("<", at)
            found = tags.at(begin) if begin >= 0 else None
            run = source[at : size if begin < 0 else begin if found else begin + 1]
            if run:
                text.append(run)
                links += len(run) if link_depth else 0
            if begin < 0:
                break
            if not found:
                at = begin + 1
                continue
            at, slash, tag, attributes = found
            if not tag:
                continue
            if slash:
                if tag == "a":
                    link_depth = 0
                if tag in BLOCKS:
                    flush()
                if opened[tag] > 0:
                    for k in range(len(stack) - 1, 0, -1):
                        if stack[k][0] == tag:
                            cut(k)
                            break
                continue
            if tag in RAW:
                end = re.compile(rf"</{re.escape(tag)}[\s/>]", re.I).search(source, at)
                at = end.start() if end else size
                close = source.find(">", at)
                at = close + 1 if end and close >= 0 else size
                continue
            if tag == "a":
                link_depth = 1
            if tag not in BLOCKS and tag not in DROPPED:
                if tag not in VOID and tag != "a" and _needs_node(attributes):
                    node = self._open(tag, attributes, stack[-1][1])
                    if self.apart[node]:
                        flush()
                        push(tag, node)
                        continue
                if tag not in VOID and not attributes.endswith("/"):
                    push(tag, stack[-1][1])
                continue
            flush()
            if tag in ("p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "br", "hr"):
                # a paragraph ends an open one; these hold text but are no containers
                if tag not in ("br", "hr"):
                    for k in range(len(stack) - 1, 0, -1) if opened["p"] > 0 or opened[tag] > 0 else ():
                        if stack[k][0] in CONTAINERS and stack[k][0] != "li":
                            break
                        if stack[k][0] == "p" or stack[k][0] == tag:
                            cut(k)
                            break
                    node = stack[-1][1]
                    if tag in HEADINGS:
                        self.heading[node] = True
                    if _needs_node(attributes):
                        node = self._open(tag, attributes, node)
                    push(tag, node)
                continue
            if tag == "html" or tag == "body" and opened["body"] > 0:
                continue
            if tag not in VOID:
                push(tag, self._open(tag, attributes, stack[-1][1]))
        flush()

    def _kept(self) -> tuple[list[bool], list[int]]:
        """Per container, whether its text counts; and the good characters in it and below."""
        if self._counted is None:
            if self.repeated:
                self._counted = self._kept_without([i > 0 and k in self.repeated for i, k in enumerate(self.keys)])
            if self._counted is None or not self._counted[1][0]:
                self._counted = self._kept_without([False] * len(self.tag))
        return self._counted

    def _kept_without(self, repeated: list[bool]) -> tuple[list[bool], list[int]]:
        n = len(self.tag)
        holds = [t in ("article", "main") and not a for t, a in zip(self.tag, self.apart, strict=True)]
        linked, said = [0] * n, [0] * n
        for node, text, links in self.blocks:
            linked[node] += links
            said[node] += len(text)
        for i in range(n - 1, 0, -1):
            linked[self.parent[i]] += linked[i]
            said[self.parent[i]] += said[i]
            if holds[i] and not (self.apart[i] and self.tag[i] in DROPPED):
                holds[self.parent[i]] = True
        apart = [a and not (s and 2 * k < t) for a, s, k, t in zip(self.apart, self.by_subject, linked, said, strict=True)]
        # a name does not set apart what holds most of the text that nothing else sets apart
        shown, free = [True] * n, [0] * n
        for i in range(1, n):
            shown[i] = shown[self.parent[i]] and not (apart[i] and not self.by_name[i])
        for node, text, links in self.blocks:
            if shown[node]:
                free[node] += max(0, len(text) - 2 * links)
        for i in range(n - 1, 0, -1):
            free[self.parent[i]] += free[i]
        kept = [True] * n
        for i in range(1, n):
            set_apart = apart[i] and not (self.by_name[i] and 2 * free[i] > free[0]) and not (holds[i] and self.tag[i] not in DROPPED and self.tag[i] != "header")
            kept[i] = kept[self.parent[i]] and not set_apart and not repeated[i]
        good = [0] * n
        for node, text, links in self.blocks:
            if kept[node]:
                good[node] += max(0, len(text) - 2 * links)
        for i in range(n - 1, 0, -1):
            good[self.parent[i]] += good[i]
        return kept, good

    def best(self) -> int:
        """The innermost container that holds all of the good text; an article, or what has a headline of its own, is not entered."""
        _, good = self._kept()
        below: list[list[int]] = [[] for _ in self.tag]
        for i in range(1, len(self.tag)):
            below[self.parent[i]].append(i)
        at = 0
        while True:
            inner = [i for i in below[at] if self.tag[i] in CONTAINERS or self.tag[i] not in BLOCKS]
            most = max(inner, key=lambda i: good[i], default=-1)
            if most < 0 or good[most] < good[at] or not good[at] or self.tag[at] in ("article", "main") and self.tag[most] not in ("article", "main") or self.heading[at]:
                return at
            if self.tag[most] not in CONTAINERS or self.tag[most] in ("table", "tbody", "tr", "ul", "ol", "blockquote") and not below[most]:
                return at
            at = most

    def branches(self) -> dict[int, tuple[int, str]]:
        """For every path of containers beside which there is other good text: good characters, and the text."""
        kept, good = self._kept()
        # an inner branch's text is its own, not its outer one's
        owner = [0] * len(self.tag)
        for i in range(1, len(self.tag)):
            own = kept[i] and 0 < good[i] < good[self.parent[i]] and self.tag[i] not in NEVER_DROPPED
            owner[i] = i if own else owner[self.parent[i]]
        found: dict[int, list[str]] = {i: [] for i, o in enumerate(owner) if i and o == i}
        for node, text, _ in self.blocks:
            if kept[node] and owner[node]:
                found[owner[node]].append(text)
        out: dict[int, list[str]] = {}
        most: dict[int, int] = {}
        for i, texts in found.items():
            out.setdefault(self.keys[i], []).extend([str(good[i]), *texts])
            most[self.keys[i]] = max(most.get(self.keys[i], 0), good[i])
        return {k: (most[k], "\n".join(t)) for k, t in out.items()}

    def text(self, roots: list[int]) -> str:
        """The kept blocks in and below the given containers, in page order."""
        kept, _ = self._kept()
        inside = self.inside(set(roots))
        return " ".join(t for node, t, _ in self.blocks if inside[node] and kept[node])

    def inside(self, roots: set[int]) -> list[bool]:
        """Per container, whether it is one of the roots or lies in one."""
        out = [i in roots for i in range(len(self.tag))]
        for i in range(1, len(self.tag)):
            out[i] = out[i] or out[self.parent[i]]
        return out

    def on_path(self, key: int) -> list[int]:
        return [i for i, k in enumerate(self.keys) if k == key]


def _needs_node(attributes: str) -> bool:
    return bool(attributes) and ("class" in attributes or "id" in attributes or "hidden" in attributes or "none" in attributes or attributes.lower() != attributes)


def main_text(source: str, path: str | int | None = None, repeated: list[str | int] | None = None) -> str:
    """The main text of one page, from the containers on ``path`` if they hold all that counts; paths by steps or hash."""
    key = path_key(path) if isinstance(path, str) else path
    page = Page(source, [path_key(r) if isinstance(r, str) else r for r in repeated or ()])
    best = page.best()
    if key is not None and (roots := page.on_path(key)):
        _, good = page._kept()
        inside = page.inside(set(roots))
        outermost = [r for r in roots if page.parent[r] < 0 or not inside[page.parent[r]]]
        if sum(good[r] for r in outermost) >= good[best] and (found := page.text(roots)):
            return found
    return page.text([best])


HOST = r"^[a-z][a-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)"


def host_of(url):
    return F.coalesce(F.regexp_extract(F.lower(url), HOST, 1), F.lit(""))


def _hosted(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """The pages and their host's row, if any; the large side is not moved while the hosts and their paths are few."""
    size = hosts.agg(F.count(F.lit(1)) + F.sum(F.coalesce(F.size("__repeated"), F.lit(0)))).first()[0] or 0
    return pages.join(F.broadcast(hosts) if size <= BROADCAST_ROWS else hosts, "__host", "left")


def repeated_paths(pages: DataFrame, url: str = "url", html_column: str = "html") -> DataFrame:
    """(__host, __repeated): the paths whose text is the same on most of a host's different pages that have them.

    Pages whose largest branch says the same are one page, whatever stands around it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tv.release()
        for batch in batches:
            out = []
            for host, v in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                branches = Page(v.as_py()).branches()
                main = max(branches.values(), default=(0, ""))[1]
                out += [(host, _hash(main), path, _hash(text)) for path, (_, text) in branches.items()]
            columns = list(zip(*out, strict=True)) or [(), (), (), ()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.int64(), pa.int64(), pa.int64()), strict=True)], names=["__host", "page", "path", "said"])

    rows = pages.select(host_of(F.col(url)).alias("__host"), F.coalesce(F.col(html_column), F.lit("")).alias("__html")).where("__host <> ''")
    said = rows.mapInArrow(run, "__host string, page long, path long, said long").distinct()
    counts = said.groupBy("__host", "path", "said").agg(F.count(F.lit(1)).alias("n"))
    alike = counts.groupBy("__host", "path").agg(F.max("n").alias("most"), F.sum("n").alias("all"))
    return alike.where((F.col("most") >= REPEATS) & (2 * F.col("most") > F.col("all"))).groupBy("__host").agg(F.sort_array(F.collect_list("path")).alias("__repeated"))


def host_paths(pages: DataFrame, repeated: DataFrame, url: str = "url", html_column: str = "html") -> DataFrame:
    """(host, path): each host's winning path."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            paths, sizes = [], []
            for v, r in zip(batch.column(1), batch.column(2), strict=True):
                page = Page(v.as_py(), r.as_py())
                paths.append(page.keys[page.best()])
                sizes.append(sum(len(t) for _, t, _ in page.blocks))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(paths, pa.int64()), pa.array(sizes, pa.int64())], names=["host", "path", "size"])

    rows = pages.select(host_of(F.col(url)).alias("__host"), F.coalesce(F.col(html_column), F.lit("")).alias("__html")).where("__host <> ''")
    rows = _hosted(rows, repeated).select("__host", "__html", "__repeated")
    votes = rows.mapInArrow(run, "host string, path long, size long").groupBy("host", "path").agg(F.count(F.lit(1)).alias("votes"), F.sum("size").alias("size"))
    return votes.groupBy("host").agg(F.max(F.struct("votes", "size", "path")).alias("best")).select("host", F.col("best.path").alias("path"))


def extract(pages: DataFrame, page_id: str = "page_id", url: str = "url", html_column: str = "html") -> DataFrame:
    """page id, url, text and n_chars of every page."""
    repeated = materialize(repeated_paths(pages, url, html_column), "host-repeats")
    winners = host_paths(pages, repeated, url, html_column).withColumnRenamed("host", "__host").withColumnRenamed("path", "__path")
    hosts = materialize(winners.join(repeated, "__host", "left"), "host-paths")
    rows = pages.select(page_id, url, host_of(F.col(url)).alias("__host"), F.coalesce(F.col(html_column), F.lit("")).alias("__html"))
    joined = _hosted(rows, hosts).select(page_id, url, "__html", "__path", "__repeated")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(h.as_py(), p.as_py(), r.as_py()) for h, p, r in zip(*batch.columns[2:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[page_id, url, "text", "n_chars"])

    schema = pages.select(page_id, url).schema.add("text", "string").add("n_chars", "long")
    return joined.mapInArrow(run, schema)
