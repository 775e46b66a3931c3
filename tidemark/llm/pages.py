"""Main text of web pages by consensus of the pages of a host.

Each page's containers are scored by the text of their blocks; the path of the
best container, generalised to tags and classes without numbers, is the page's
vote. Votes are counted per host. Every page is then extracted from the container
whose path has most votes of its host among all paths the page holds, so that a page
whose own scores mislead follows the rest of its site, whatever its number of layouts.
Paths are kept as their depth and a digest, computed from the page's root down.

A container without an article around it grows over what stands beside it: to all that holds
it and, besides, only headings, or less text than it has, of which at most a third is links.

Menus, notices and the like are known by their elements, roles and whole classes or ids.
Noise words and forms do not drop an element that holds the page's only article, or
most of its text outside of links; comments never, and notices never for their text.

Defined results: null or empty html, and a page of which only notices, menus and
the like remain, gives empty text and 0 characters. A page without a usable url
belongs to the host ''. Unclosed and stray tags are taken as browsers take them,
near enough; an unclosed script, style or comment ends with the page. Of paths with
equal votes the one nearer to the root wins, then that of the smaller digest. Repeated rows get equal results and each has a vote.
Other columns pass through; a column with the name of a result is replaced.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sinks.scratch import materialize

# Elements and words that mark what is not the article.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
DROPPED = frozenset(
    "head script style template noscript textarea title xmp iframe noembed noframes svg object canvas audio video annotation annotation-xml "
    "nav footer aside button select option datalist dialog menu input label fieldset".split()
)
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike "
    "strong sub sup time tt u var wbr img math mi mn mo ms mtext mrow mfrac msup msub msubsup msqrt mroot mover munder "
    "munderover mstyle mpadded semantics".split()
)
CONTAINERS = frozenset("article main section div td body html blockquote center".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CLOSES_P = frozenset(
    "address article aside blockquote center details dialog div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 "
    "h6 header hr main menu nav ol p pre section table ul".split()
)
#: A start tag that ends an open element of the same list, within the nearest of the bounds.
SIBLINGS = {
    "li": (("li",), ("ul", "ol", "menu")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "tr": (("tr", "td", "th"), ("table",)),
    "td": (("td", "th"), ("tr", "table")),
    "th": (("td", "th"), ("tr", "table")),
    "option": (("option",), ("select",)),
}
NOISE_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar nav navbar "
    "navigation menu menus breadcrumb breadcrumbs footer comment comments disqus reply replies respond cookie cookies "
    "consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login "
    "share sharing social related recommended widget toolbar pagination pager masthead topbar search form".split()
)
#: Of these, what never is a wrapper of the page's text, and what holds others' text.
FIRM_WORDS = frozenset(
    "ad ads adv advert adverts advertisement advertising sponsor sponsored cookie cookies consent gdpr notice notices "
    "notification alert popup modal newsletter subscribe subscription".split()
)
COMMENT_WORDS = frozenset("comment comments disqus reply replies respond".split())
#: Words that leave a class of noise words one: comment-list, but not has-sidebar or social-science.
NEUTRAL_WORDS = frozenset(
    "area bar block body bottom box button buttons cell col column container content entry footer group header head holder "
    "inner item items left links list main outer panel post posts right row section site slot top unit wrap wrapper page article "
    "primary secondary global local mobile desktop".split()
)
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog menu menubar".split())
HEADER_WORDS = frozenset(("header", "head"))

_TOKEN = re.compile(r"<!--.*?(?:-->|$)|<!\[CDATA\[.*?(?:\]\]>|$)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+|\d+")
_NUMBER = re.compile(r"\d+")
_END = {tag: re.compile(rf"</{tag}(?=[\s/>])", re.I) for tag in RAW}


class Page:
    """Elements in page order, so that an element's inside is a range, and the text between their tags."""

    def __init__(self, text: str):
        # Element 0 is the page itself.
        self.parent, self.tag, self.classes, self.mark, self.end = [-1], ["html"], [""], [0], [0]
        self.texts: list[tuple[int, str]] = []
        self.open: dict[str, int] = {}  # open elements of each tag
        self._read(text)
        # States: 0 kept, 1 inside a header (only headings kept), 2 dropped.
        self.state = self._states(self._wrappers())
        self._look_up()

    # Marks: 1 a header, 2 dropped; by words or as a form: 3, 4 never a wrapper of most of the text, 5 comments.
    def _open(self, tag: str, attributes: str, stack: list[int]) -> int:
        above, mark, classes = stack[-1], 3 if tag == "form" else 0, ""
        if attributes and attributes.strip(" /"):
            given = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTRIBUTE.finditer(attributes)}
            classes = given.get("class", "")
            if tag not in ("html", "body"):
                found = self._words(f"{classes} {given.get('id', '')}")
                styled = given.get("style", "").replace(" ", "").lower()
                if given.get("role", "").lower() in NOISE_ROLES or "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in styled:
                    mark = 2
                elif found & NOISE_WORDS:
                    mark = 5 if found & COMMENT_WORDS else 4 if found & FIRM_WORDS else 3
                elif found & HEADER_WORDS and not mark:
                    mark = 1
        if tag in DROPPED:
            mark = 2
        elif tag == "header" and not mark:
            mark = 1
        self.parent.append(above)
        self.tag.append(tag)
        self.classes.append(classes)
        self.mark.append(mark)
        self.end.append(0)
        return len(self.tag) - 1

    @staticmethod
    def _words(names: str) -> set[str]:
        """Words of the classes and ids that say nothing else."""
        found: set[str] = set()
        for name in names.split():
            own = {w.lower() for w in _WORD.findall(name)}
            if all(w in NOISE_WORDS or w in HEADER_WORDS or w in NEUTRAL_WORDS or w.isdigit() for w in own):
                found |= own
        return found

    def _states(self, wrappers: set[int]) -> list[int]:
        """State of each element; marks by words and forms count unless they are wrappers."""
        states, inside = [0], [False]
        for node in range(1, len(self.tag)):
            above, mark, tag = self.parent[node], self.mark[node], self.tag[node]
            state = states[above]
            inside.append(inside[above] or self.tag[above] in ("article", "main"))
            if mark == 2 or mark > 2 and node not in wrappers:
                state = 2
            elif mark == 1:
                state = max(state, 1)
            if state == 1 and tag in HEADINGS and inside[node]:
                state = 0
            states.append(state)
        return states

    def _wrappers(self) -> set[int]:
        """Elements of noise words and forms that hold the page's article or most of its text outside of links."""
        soft = {i for i, m in enumerate(self.mark) if m > 2}
        if not soft:
            return soft
        states, size = self._states(soft), [0] * len(self.tag)
        linked, above = [False] * len(self.tag), [0] * len(self.tag)  # above: elements of ``soft`` on the way
        comments = [False] * len(self.tag)
        for node in range(1, len(self.tag)):
            up = self.parent[node]
            linked[node] = linked[up] or self.tag[node] == "a"
            above[node] = above[up] + (node in soft)
            comments[node] = comments[up] or self.mark[node] == 5
        for node, text in self.texts:
            if not states[node] and not linked[node] and not comments[node]:
                size[node] += len(text.strip())
        for node in range(len(self.tag) - 1, 0, -1):
            size[self.parent[node]] += size[node]
        kept = {i for i in soft if self.mark[i] == 3 and 2 * size[i] > size[0]}
        articles = [i for i, tag in enumerate(self.tag) if tag in ("article", "main") and i not in soft and not comments[i] and states[i] < 2 and size[i]]
        if articles and all(above[i] for i in articles):
            node = max(articles, key=lambda i: (size[i], -i))
            while (node := self.parent[node]) > 0:
                if node in soft:
                    kept.add(node)
        return kept

    def _close(self, stack: list[int], names: tuple[str, ...], bounds: tuple[str, ...] = ()) -> None:
        if not any(self.open.get(name) for name in names):
            return
        for k in range(len(stack) - 1, 0, -1):
            tag = self.tag[stack[k]]
            if tag in names:
                for i in stack[k:]:
                    self.end[i] = len(self.tag)
                    self.open[self.tag[i]] -= 1
                del stack[k:]
                return
            if tag in bounds:
                return

    def _read(self, text: str) -> None:
        at, stack, size = 0, [0], len(text)
        while at < size:
            found = _TOKEN.search(text, at)
            if found is None:
                self.texts.append((stack[-1], text[at:]))
                break
            if found.start() > at:
                self.texts.append((stack[-1], text[at : found.start()]))
            at = found.end()
            if found[0].startswith("<![CDATA["):
                self.texts.append((stack[-1], entities.escape(found[0][9:].removesuffix("]]>"))))
                continue
            if found[2] is None:
                continue
            tag = found[2].lower()
            if tag not in INLINE:
                self.texts.append((stack[-1], ""))
            if found[1]:
                self._close(stack, (tag,), () if tag in ("html", "body", "article", "main") else ("article", "main", "td", "table")[: 4 if tag in INLINE or tag == "p" else 0])
                continue
            if tag in CLOSES_P:
                self._close(stack, ("p",), ("article", "section", "div", "td", "table", "button", "li", "blockquote"))
            if tag in SIBLINGS:
                self._close(stack, *SIBLINGS[tag])
            node = self._open(tag, found[3], stack)
            if tag in VOID or found[3].endswith("/") and tag not in CONTAINERS and tag not in CLOSES_P and tag not in RAW:
                self.end[node] = node + 1
            elif tag in RAW:
                close = _END[tag].search(text, at)
                at = size if close is None else close.start()
                self._push(stack, node)
            else:
                self._push(stack, node)
        for i in stack:
            self.end[i] = len(self.tag)

    def _push(self, stack: list[int], node: int) -> None:
        stack.append(node)
        self.open[self.tag[node]] = self.open.get(self.tag[node], 0) + 1

    def _look_up(self) -> None:
        """What lies above each element, and the kept text inside it, each taken once from its parent or its range."""
        size = len(self.tag)
        prose, linked = [0] * (size + 1), [0] * (size + 1)  # of the elements before each, headings left out
        self.article, self.link, self.inner, self.outer = [-1] * size, [-1] * size, [-1] * size, [-1] * size
        headed = [False] * size
        for node in range(size):
            up, tag = self.parent[node], self.tag[node]
            if up >= 0:
                self.article[node], self.link[node], headed[node] = self.article[up], self.link[up], headed[up]
                self.inner[node], self.outer[node] = self.inner[up], self.outer[up]
            if tag in ("article", "main"):
                self.article[node] = node
            if tag == "a":
                self.link[node] = node
            if tag in HEADINGS:
                headed[node] = True
            if tag in CONTAINERS:
                self.inner[node], self.outer[node] = node, self.inner[node]
        for node, text in self.texts:
            if text and not self.state[node] and not headed[node]:
                (linked if self.link[node] >= 0 else prose)[node + 1] += len(text.strip())
        for node in range(size):
            prose[node + 1] += prose[node]
            linked[node + 1] += linked[node]
        self.grown = [0] * size
        for node in range(1, size):
            up, end = self.parent[node], self.end[node]
            self.grown[node] = node
            if up > 0 and self.tag[up] not in ("body", "html"):
                own = prose[end] - prose[node]
                beside = prose[self.end[up]] - prose[up] - own
                links = linked[self.end[up]] - linked[up] - (linked[end] - linked[node])
                if not beside + links or beside < own and 3 * links <= beside + links:
                    self.grown[node] = self.grown[up]

    def paths(self) -> list[bytes]:
        """Depth and digest of every element's path: its tag and classes without numbers, below its parent's."""
        out, depth = [b"\0" * 16], [0]
        for node in range(1, len(self.tag)):
            words = sorted(set(_NUMBER.sub("#", self.classes[node]).split()))
            depth.append(depth[self.parent[node]] + 1)
            part = ".".join([self.tag[node], *words]).encode("utf-8", "replace")
            digest = hashlib.blake2b(out[self.parent[node]] + part, digest_size=14).digest()
            out.append(min(depth[node], 65535).to_bytes(2) + digest)
        return out

    def scores(self) -> dict[int, float]:
        """Text of each container's own blocks, and half of that of the containers right below, without links."""
        out: dict[int, float] = {}
        for node, text in self.texts:
            inner, outer = self.inner[node], self.outer[node]
            if not text or self.state[node] or self.link[node] > outer:
                continue
            n = len(text.strip())
            for k, holder in enumerate((inner, outer)):
                if holder >= 0:
                    out[holder] = out.get(holder, 0.0) + n / (1 + k)
        return {k: v for k, v in out.items() if v > 0}

    def widen(self, node: int) -> int:
        """The article around a container; without one, what holds it and besides only headings or less prose."""
        return self.article[node] if self.article[node] > 0 else self.grown[node]

    def best(self) -> tuple[int, float]:
        """The best container and its score; (-1, 0) if the page has no text to keep."""
        scores = self.scores()
        if not scores:
            return -1, 0.0
        node = max(scores, key=lambda i: (scores[i], -i))
        return self.widen(node), scores[node]

    def held(self) -> list[int]:
        """Containers with text to keep, and what they grow to, in page order."""
        scores = self.scores()
        return sorted({self.widen(i) for i in scores} | set(scores))

    def text_of(self, *nodes: int) -> str:
        """Text in elements given in page order, none inside another."""
        parts: list[list[str]] = [[] for _ in nodes]
        for i, t in self.texts:
            k = bisect_right(nodes, i) - 1
            if k >= 0 and i < self.end[nodes[k]] and self.state[i] == 0:
                parts[k].append(t or " ")
        return " ".join(filter(None, (" ".join(entities.unescape("".join(p)).split()) for p in parts)))

    def extract(self, path: bytes | None = None) -> str:
        """Text of the containers with a path, else of the page's own best."""
        if path:
            paths, outer = self.paths(), []
            for node in self.held():
                if paths[node] == path and (not outer or node >= self.end[outer[-1]]):
                    outer.append(node)
            if text := self.text_of(*outer):
                return text
        node, _ = self.best()
        return self.text_of(node) if node >= 0 else ""


def host_of(url: str = "url"):
    """Lower-case host of a url; '' if there is none."""
    return F.coalesce(F.lower(F.regexp_extract(F.col(url), r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", 1)), F.lit(""))


def _keyed(pages: DataFrame, html: str, url: str):
    """Host, and a key that pages of the same host and text share."""
    host = host_of(url)
    return host, F.unhex(F.sha2(F.concat_ws("\n", host, F.col(html)), 256))


def page_paths(pages: DataFrame, html: str = "html", url: str = "url") -> DataFrame:
    """Of every page with text: host, key, path of the best container, its score, and all paths it holds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, keys, best, scores, held = [], [], [], [], []
            for host, key, text in zip(*(batch.column(n).to_pylist() for n in ("host", "key", "html"))):
                page = Page(text or "")
                node, score = page.best()
                if node >= 0:
                    paths = page.paths()
                    hosts.append(host)
                    keys.append(key)
                    best.append(paths[node])
                    scores.append(score)
                    held.append(sorted({paths[i] for i in page.held()}))
            columns = [pa.array(hosts, pa.string()), pa.array(keys, pa.binary()), pa.array(best, pa.binary()), pa.array(scores, pa.float64()), pa.array(held, pa.list_(pa.binary()))]
            yield pa.RecordBatch.from_arrays(columns, names=["host", "key", "path", "score", "held"])

    host, key = _keyed(pages, html, url)
    given = pages.select(host.alias("host"), key.alias("key"), F.col(html).alias("html"))
    return given.mapInArrow(run, "host string, key binary, path binary, score double, held array<binary>")


def votes(paths: DataFrame) -> DataFrame:
    """Pages and score behind every path a host's pages voted for: host, path, pages, score."""
    return paths.groupBy("host", "path").agg(F.count("*").alias("pages"), F.sum("score").alias("score"))


def winners(paths: DataFrame) -> DataFrame:
    """The path a page follows, by its key: of all it holds, the one with most votes of its host."""
    held = paths.select("host", "key", F.explode("held").alias("path")).join(votes(paths), ["host", "path"])
    first = F.min(F.struct((-F.col("pages")).alias("order"), "path"))["path"]
    return held.groupBy("key").agg(first.alias("path"))


def extract(pages: DataFrame, html: str = "html", url: str = "url", into: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """Adds the main text of every page and its number of code points."""
    spark = pages.sparkSession
    followed = materialize(spark, winners(materialize(spark, page_paths(pages, html, url), "page-paths")), "page-winners")
    kept = [f for f in pages.schema.fields if f.name not in (into, n_chars)]
    names = [f.name for f in kept]
    # The winners are as many as the pages, so their side is never broadcast; keys are digests, so no host is hot.
    given = pages.select(F.struct(*dict.fromkeys([*names, html])).alias("row"), _keyed(pages, html, url)[1].alias("key"))
    given = given.join(followed.hint("shuffle_hash"), "key", "left")
    schema = T.StructType([*kept, T.StructField(into, T.StringType()), T.StructField(n_chars, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, paths = batch.column("row").field(html).to_pylist(), batch.column("path").to_pylist()
            found = [Page(text).extract(path) if text else "" for text, path in zip(texts, paths)]
            columns = [*map(batch.column("row").field, names), pa.array(found, pa.string()), pa.array(list(map(len, found)), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, into, n_chars])

    return given.select("row", "path").mapInArrow(run, schema)
