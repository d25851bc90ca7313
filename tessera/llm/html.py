"""Main text of web pages by consensus host paths.

Pages of one host share a template. Each page's containers are scored by the
text that they hold directly in blocks, little of it in links; the page votes
for the generalised path (tags with their classes, digits masked) of the best
one. Spark adds up the votes per host, and every page of the host is extracted
anew from the winning path; a page that lacks it falls back to its own best
container.
"""

from __future__ import annotations

import html as entities
import re
from typing import NamedTuple
from urllib.parse import urlsplit

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import map_rows
from tessera.session import cut_lineage

#: Elements whose content is no markup.
RAW = frozenset("script style noscript template textarea iframe svg title".split())
_RAW_END = {tag: re.compile(f"</{tag}(?=[\\s/>])[^>]*>|</{tag}\\Z", re.IGNORECASE) for tag in RAW}
_NAME = re.compile(r"[a-zA-Z][^\s/>]*")
_SKIP = re.compile(r"[\s/]*")
_ATTR_NAME = re.compile(r"[^\s/>][^\s/>=]*")
_EQUALS = re.compile(r"\s*=\s*")
_UNQUOTED = re.compile(r"[^\s>]+")
_READ = frozenset(("class", "id", "role", "style", "hidden", "aria-hidden", "href"))

VOID = frozenset("area base basefont bgsound br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure "
    "footer form h1 h2 h3 h4 h5 h6 header hr html li main menu nav ol p pre section summary table tbody td tfoot th "
    "thead tr ul".split())
#: Elements that can be a page's container; others, such as lists, are parts of a text.
CONTAINERS = frozenset("html body article main div section center".split())
#: Elements that hold no main text; a header inside of an article or main does.
DROPPED = frozenset("nav header footer aside form button select option dialog menu head audio video canvas".split())
#: Elements that a head may hold; any other one, or text, ends it.
_IN_HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
#: Words of classes, ids and roles that hint at what is no main text.
_BOILER = re.compile(
    r"(?:^|[\s_-])(?:ads?|advert(?:s|isement|ising)?|sponsor(?:ed)?|promo(?:tion)?|banner|cookies?|consent|gdpr|"
    r"notices?|alert|popup|modal|overlay|newsletter|subscribe|signup|nav(?:bar|igation)?|menu|breadcrumbs?|"
    r"pagination|pager|header|masthead|footer|side-?bar|aside|widget|related|recommend(?:ed|ations)?|comments?|"
    r"commentlist|replies|respond|disqus|share|sharing|social|toolbar|complementary|contentinfo|search(?:box)?)"
    r"(?:$|[\s_-])", re.IGNORECASE)
_HEADER = re.compile(r"(?<![^\s_-])(?:header|masthead)(?![^\s_-])", re.IGNORECASE)
#: Names of layouts ("no-sidebar", "post-with-comments"), which say nothing of the element itself.
_MODIFIER = re.compile(r"(?:^|(?<=[\s_-]))(?:has|have|no|non|not|with|without)[_-]\S*", re.IGNORECASE)
#: Names of parts that hold articles or much text of their own, and names of wrappers that overrule them.
_PART = re.compile(
    r"(?:^|[_-])(?:comments?|commentlist|replies|respond|disqus|related|recommend(?:ed|ations)?|ads?|"
    r"advert(?:s|isement|ising)?|sponsor(?:ed)?|promo(?:tion)?|newsletter|cookies?|consent|gdpr|share|sharing|social)"
    r"(?:[_-](?:list|section|area|wrap(?:per)?|container|box|block|posts?|articles?|items?|thread|body|\d+))*$",
    re.IGNORECASE)
_WRAPPER = frozenset("article body container content entry layout main page post single site story text wrap "
                     "wrapper".split())
#: What an open <p> is closed by, and the siblings that close each other.
_CLOSES_P = BLOCKS - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot", "caption"}
_SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
             "th": {"td", "th"}, "option": {"option"}}
_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"},
          "th": {"tr", "table"}, "option": {"select"}}


class _Tags:
    """The texts and tags of a page in order, in time linear in its length: each is
    (text, None, False, None, False) or (None, tag, ends, attributes, closes itself).

    A ``<`` that no ``>`` follows is text. Once a tag's quotes have run to the end of the
    page, tags end at the first ``>``, whatever stands in quotes. Attributes that
    nothing reads are left out; an unquoted value may hold quotes.
    """

    def __init__(self, source: str):
        self.source, self.loose = source, False

    def __iter__(self):
        source, at, n = self.source, 0, len(self.source)
        last = source.rfind(">")
        while at < n:
            lt = source.find("<", at)
            if lt < 0 or lt > last:
                yield source[at:], None, False, None, False
                return
            if lt > at:
                yield source[at:lt], None, False, None, False
            if source.startswith("<!--", lt):
                # an empty comment may end at once
                if source.startswith((">", "->"), lt + 4):
                    end = source.find(">", lt + 4)
                else:
                    end = source.find("-->", lt + 4)
                    end = end + 2 if end >= 0 else n
                at = end + 1
                continue
            ends = source.startswith("/", lt + 1)
            name = _NAME.match(source, lt + 1 + ends)
            if name is None:
                if source.startswith(("!", "?", "/"), lt + 1):
                    at = source.find(">", lt) + 1
                else:
                    yield "<", None, False, None, False
                    at = lt + 1
                continue
            tag = name[0].lower()
            attributes, at, closed = self._attributes(name.end())
            if tag in RAW and not ends:
                end = _RAW_END[tag].search(source, at)
                at = end.end() if end else n
                continue
            yield None, tag, ends, attributes, closed

    def _attributes(self, at: int) -> tuple[dict, int, bool]:
        """The attributes from there on, the place behind the tag, and whether a slash ends it."""
        source, start, found = self.source, at, {}
        while not self.loose:
            skipped = _SKIP.match(source, at)
            at = skipped.end()
            if source.startswith(">", at):
                return found, at + 1, "/" in skipped[0]
            name = _ATTR_NAME.match(source, at)
            if name is None:
                break
            at, value = name.end(), ""
            equals = _EQUALS.match(source, at)
            if equals:
                at = equals.end()
                quote = source[at:at + 1]
                if quote in ("'", '"') and quote:
                    end = source.find(quote, at + 1)
                    if end < 0:
                        break
                    value, at = source[at + 1:end], end + 1
                elif unquoted := _UNQUOTED.match(source, at):
                    value, at = unquoted[0], unquoted.end()
                    if value.endswith("/") and source.startswith(">", at):
                        value = value[:-1]
                        if name[0].lower() in _READ:
                            found.setdefault(name[0].lower(), value)
                        return found, at + 1, True
            if name[0].lower() in _READ:
                found.setdefault(name[0].lower(), value)
        self.loose = True  # the quotes ran to the end of the page
        end = source.find(">", start)
        return {}, (end + 1 if end >= 0 else len(source)), False


def _generalised(tag: str, attributes: dict, in_article: bool) -> tuple[str, bool, str]:
    """The path step of an element, whether it is dropped with all in it, and the names
    in its class, id and role if they hint that it is no main text."""
    drop = tag in DROPPED and not (tag == "header" and in_article)
    step, names = tag, []
    for name, value in attributes.items():
        if name == "class":
            step += "".join("." + c for c in sorted(re.sub(r"\d+", "#", value.lower()).split()))
        if name in ("class", "id", "role"):
            if tag not in ("html", "body", "article", "main"):
                names.append(value)
        elif name == "hidden" or name == "aria-hidden" and value.lower() == "true" \
                or name == "style" and "display:none" in value.replace(" ", "").lower():
            drop = True
    hint = _MODIFIER.sub(" ", " ".join(names)) if names else ""
    if hint and _HEADER.search(hint) and in_article:
        hint = _HEADER.sub(" ", hint)
    return step, drop, hint if hint and _BOILER.search(hint) else ""


def _is_part(hint: str) -> bool:
    words = hint.lower().split()
    return any(_PART.search(w) for w in words) and _WRAPPER.isdisjoint(words)


class Block(NamedTuple):
    node: int  # the nearest container
    text: str
    linked: int  # characters in links
    hint: int  # the nearest hinted element around it, or -1

    @property
    def worth(self) -> int:
        return max(0, len(self.text) - 2 * self.linked)


class _Open(NamedTuple):
    """An open element."""

    tag: str
    dropped: bool
    node: int
    hint: int
    in_link: bool


class Page:
    """Blocks of a page, its containers and their paths.

    Containers are numbered as they open, each with its parent, and so are paths: two
    containers with the same steps from the top have one path. Number 0 is the page
    itself. Sums over what lies in an element are made in one pass from the last number
    to the first, so time grows with the page, however deep it is.

    A boilerplate name is a hint only. A hinted element stays if the host's path
    leads through it, if it has the only article, main or h1, or if it has most
    of the unlinked text around it; parts such as comments or related articles
    stay for an h1 only. All stay if nothing would be left.
    """

    def __init__(self, source: str):
        self.all: list[Block] = []
        # containers: parent, path, depth; depth of the nearest h1, article or main, and container proper
        self.parent, self.path, self.depth = [0], [0], [0]
        self.h1, self.main, self.proper = [-1], [-1], [-1]
        # paths: parent, last step, its tag
        self.above, self.step, self.tag = [0], [""], [""]
        self._paths: dict[tuple[int, str], int] = {}
        # hinted elements: hint around, containers above, whether it is a part
        self.hint_above, self.hint_depth, self.hint_part = [], [], []
        self._read(source)
        self.blocks = self._kept(None)

    def _container(self, parent: int, tag: str, step: str) -> int:
        key = (self.path[parent], step)
        path = self._paths.get(key)
        if path is None:
            path = self._paths[key] = len(self.step)
            self.above.append(key[0])
            self.step.append(step)
            self.tag.append(tag)
        depth = self.depth[parent]
        self.parent.append(parent)
        self.path.append(path)
        self.depth.append(depth + 1)
        self.h1.append(depth if tag == "h1" else self.h1[parent])
        self.main.append(depth if tag in ("article", "main") else self.main[parent])
        self.proper.append(depth if tag in CONTAINERS else self.proper[parent])
        return len(self.parent) - 1

    def _read(self, source: str) -> None:
        top = _Open("", False, 0, -1, False)
        stack: list[_Open] = []
        where: dict[str, list[int]] = {}  # places of the open elements of a tag
        walls: list[int] = []  # places of the open blocks other than p
        parts: list[str] = []
        linked = 0

        def flush():
            nonlocal linked
            if parts:
                text = " ".join(entities.unescape("".join(parts)).split())
                if text:
                    around = stack[-1] if stack else top
                    self.all.append(Block(around.node, text, linked, around.hint))
                parts.clear()
            linked = 0

        def close(to: int):
            if any(e.tag in BLOCKS for e in stack[to:]) or stack[-1].hint != (stack[to - 1].hint if to else -1):
                flush()
            for e in stack[to:]:
                where[e.tag].pop()
                if e.tag in BLOCKS and e.tag != "p":
                    walls.pop()
            del stack[to:]

        def last(tags) -> int:
            return max((where[t][-1] for t in tags if where.get(t)), default=-1)

        for text, tag, ends, attributes, closed in _Tags(source):
            if text is not None:
                if stack and stack[-1].tag == "head" and text.strip():
                    close(len(stack) - 1)
                if not (stack and stack[-1].dropped):
                    parts.append(text)
                    if stack and stack[-1].in_link:
                        linked += len(text.strip())
                continue
            wall = walls[-1] if walls else -1
            if ends:
                at = last((tag,))
                # an inline end tag does not close a container
                if at >= 0 and (tag in BLOCKS or at > wall):
                    close(at)
                continue
            if tag not in _IN_HEAD and stack and stack[-1].tag == "head":
                close(len(stack) - 1)
            if tag in VOID:
                if tag == "hr":
                    flush()
                elif tag == "br":
                    parts.append(" ")
                continue
            if tag in _CLOSES_P and last(("p",)) > (walls[-1] if walls else -1):
                close(last(("p",)))
            if tag in _SIBLINGS and (at := last(_SIBLINGS[tag])) > last(_SCOPE[tag]):
                close(at)
            if tag in BLOCKS:
                flush()
            around = stack[-1] if stack else top
            step, drop, hint = _generalised(tag, attributes, self.main[around.node] >= 0)
            if drop or hint:
                flush()
            if closed and tag not in BLOCKS:
                continue
            number = around.hint
            if hint and not (drop or around.dropped):
                number = len(self.hint_above)
                self.hint_above.append(around.hint)
                self.hint_depth.append(self.depth[around.node])
                self.hint_part.append(_is_part(hint))
            node = self._container(around.node, tag, step) if tag in BLOCKS and tag != "p" else around.node
            # a link begins where another one is open only because its end is missing
            link = "href" in attributes if tag == "a" else around.in_link
            where.setdefault(tag, []).append(len(stack))
            if tag in BLOCKS and tag != "p":
                walls.append(len(stack))
            stack.append(_Open(tag, drop or around.dropped, node, number, link))
        flush()

    def _under(self, path: int) -> list[bool]:
        """Of every path, whether it leads through that one."""
        under = [False] * len(self.step)
        for k in range(len(under)):  # a path's number is above that of its parent
            under[k] = k == path or k > 0 and under[self.above[k]]
        return under

    def _kept(self, path: int | None) -> list[Block]:
        """The blocks outside of the hinted elements that are dropped; those on the given path stay."""
        n = len(self.hint_above)
        if not n:
            return self.all
        stay = [False] * n
        if path:
            under, steps = self._under(path), self._path_depth(path)
            around = [False] * n  # hinted elements with a block of the path in them
            for b in self.all:
                if b.hint >= 0 and under[self.path[b.node]]:
                    around[b.hint] = True
            for h in range(n - 1, -1, -1):
                if around[h] and self.hint_above[h] >= 0:
                    around[self.hint_above[h]] = True
                stay[h] = around[h] and self.hint_depth[h] < steps
        # of each hinted element (place n: the page): the text in it, and the deepest h1 and
        # article anywhere in it and outside of further hinted elements
        worth, h1, main = [0] * (n + 1), [-1] * (n + 1), [-1] * (n + 1)
        own_h1, own_main = [-1] * (n + 1), [-1] * (n + 1)
        for b in self.all:
            if b.worth:
                h = b.hint if b.hint >= 0 else n
                worth[h] += b.worth
                own_h1[h], own_main[h] = max(own_h1[h], self.h1[b.node]), max(own_main[h], self.main[b.node])
        h1, main = own_h1[:], own_main[:]
        for h in range(n - 1, -1, -1):
            up = self.hint_above[h] if self.hint_above[h] >= 0 else n
            worth[up] += worth[h]
            h1[up], main[up] = max(h1[up], h1[h]), max(main[up], main[h])
        alive = [False] * n
        for h in range(n):
            up = self.hint_above[h] if self.hint_above[h] >= 0 else n
            if up < n and not alive[up]:
                continue
            since, depth = (self.hint_depth[up] if up < n else 0), self.hint_depth[h]
            alive[h] = stay[h] or own_h1[up] < since and h1[h] >= depth or not self.hint_part[h] and (
                2 * worth[h] > worth[up] or own_main[up] < since and main[h] >= depth)
        return [b for b in self.all if b.hint < 0 or alive[b.hint]] or self.all

    def _path_depth(self, path: int) -> int:
        depth = 0
        while path:
            path, depth = self.above[path], depth + 1
        return depth

    def _steps(self, path: int) -> tuple[str, ...]:
        steps = []
        while path:
            steps.append(self.step[path])
            path = self.above[path]
        return tuple(reversed(steps))

    def _find(self, steps: tuple[str, ...]) -> int | None:
        """The number of a path, or None if the page has none such."""
        path = 0
        for step in steps:
            path = self._paths.get((path, step))
            if path is None:
                return None
        return path

    def best(self) -> tuple[str, float]:
        """Path and score of the page's best container."""
        path, score = self._best()
        return ">".join(self._steps(path)), score

    def _best(self) -> tuple[int, float]:
        """Path and score of the page's best container.

        A container's score is the unlinked text below it. An article or main
        wins before others; else the innermost container with nearly all of the
        page's text, widened to what is connected with it."""
        if not self.blocks:
            return 0, 0.0
        n = len(self.step)
        scores, depth, there = [0] * n, [0] * n, [False] * n
        for k in range(1, n):
            depth[k] = depth[self.above[k]] + 1
        for b in self.blocks:
            scores[self.path[b.node]] += b.worth
            there[self.path[b.node]] = True
        for k in range(n - 1, 0, -1):
            scores[self.above[k]] += scores[k]
            there[self.above[k]] |= there[k]

        def first(paths, key):
            """The greatest by the key, ties by the greatest steps."""
            top = max(map(key, paths))
            ties = [k for k in paths if key(k) == top]
            return ties[0] if len(ties) == 1 else max(ties, key=self._steps)

        marked = [k for k in range(1, n) if self.tag[k] in ("article", "main") and scores[k] > 0]
        if marked:  # an article's parts are no container of their own
            path = first(marked, lambda k: (scores[k], -depth[k]))
        else:
            pool = [k for k in range(n) if there[k] and (k == 0 or self.tag[k] in CONTAINERS)
                    and scores[k] >= 0.75 * scores[0]]
            path = self._widened(first(pool, lambda k: (depth[k], scores[k])))
        return path, float(scores[path])

    def _widened(self, path: int) -> int:
        """The smallest container, one element, of what is connected with a path's
        text: the h1 before it, sections beside it, and text beside it or beside an
        element around it that is in no container of its own (beside the body's
        children only where the path is one of them)."""
        blocks = [b for b in self.blocks if b.worth]

        def up(path: int, to: int) -> int:
            for _ in range(self._path_depth(path) - to):
                path = self.above[path]
            return path

        def connected(path: int) -> int:
            under, size = self._under(path), self._path_depth(path)
            inside = [under[self.path[b.node]] for b in blocks]
            if size == 0 or not any(inside):
                return path
            first = inside.index(True)
            # the elements around the first block of the path, by depth, and how far each
            # container shares them
            chain, node = [], blocks[first].node
            while node:
                chain.append(node)
                node = self.parent[node]
            chain.reverse()
            shared = [0] * len(self.parent)
            for k in range(1, len(shared)):
                d = self.depth[k]
                shared[k] = d if d <= len(chain) and chain[d - 1] == k else shared[self.parent[k]]
            if self.tag[path] not in CONTAINERS or any(x and shared[b.node] < size for b, x in zip(blocks, inside)):
                return self.above[path]
            titles = [k for k, b in enumerate(blocks) if self.h1[b.node] >= 0]
            if not any(inside[k] for k in titles) and (before := [k for k in titles if k < first]):
                return up(path, min(size, shared[blocks[before[-1]].node]))
            steps = []  # tags of the path, by depth
            k = path
            while k:
                steps.append(self.tag[k])
                k = self.above[k]
            steps.reverse()
            loose_at = [k == size - 1 or not (k == 0 or steps[k - 1] in ("html", "body")) for k in range(size)]
            following, k = [size] * (size + 1), size - 1
            while k >= 0:
                following[k] = k if loose_at[k] else following[k + 1]
                k -= 1
            least = size
            for b, x in zip(blocks, inside):
                if x:
                    continue
                common = min(shared[b.node], size - 1)
                k = following[min(self.proper[b.node] + 1, size)]
                if k <= common:
                    least = min(least, k)
                if common == size - 1 and self.depth[b.node] > size - 1 and steps[-1] == "section" \
                        and self._tag_at(b.node, size - 1) == "section":
                    least = min(least, size - 1)
            return up(path, least) if least < size else path

        while (wider := connected(path)) != path:
            path = wider
        return path

    def _tag_at(self, node: int, depth: int) -> str:
        """The tag of the container around a block at that depth."""
        while self.depth[node] > depth + 1:
            node = self.parent[node]
        return self.tag[self.path[node]]

    def text(self, path: str | None) -> str:
        """The text under a path ("": of the whole page), or under the page's best one."""
        lines = []
        if path is not None:
            found = self._find(tuple(path.split(">")) if path else ())
            if found is not None:
                under = self._under(found)
                lines = [b.text for b in self._kept(found) if under[self.path[b.node]]]
        if not lines:
            under = self._under(self._best()[0])
            lines = [b.text for b in self.blocks if under[self.path[b.node]]]
        return "\n".join(lines)


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").lower()
    except ValueError:
        return ""


def hosted(pages: DataFrame) -> DataFrame:
    """page_id, url, html and the url's host, by which pages are joined with the votes."""
    return pages.select("page_id", "url", "html", F.udf(host_of, "string", useArrow=False)("url").alias("host"))


def page_votes(pages: DataFrame) -> DataFrame:
    """host, path, score: the vote of each of the ``pages`` (url, html)."""
    def make():
        return lambda url, source: (host_of(url), *Page(source or "").best())

    return map_rows(pages.select("url", "html"), make, "host string, path string, score double").where("score > 0")


def host_paths(votes: DataFrame) -> DataFrame:
    """The winning path of each host: most votes, then the higher score, then the path."""
    per_path = votes.groupBy("host", "path").agg(F.count(F.lit(1)).alias("n"), F.sum("score").alias("total"))
    return per_path.groupBy("host").agg(F.max(F.struct("n", "total", "path")).alias("w")).select(
        "host", F.col("w.path").alias("path"))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every row of ``pages``.

    The whole html is read; null counts as empty and gives an empty text. Pages
    without a host (null or broken urls) form one group. Repeated rows are kept.
    The host's path is joined by Spark: broadcast while the table of hosts is
    small, else by a shuffle whose hot hosts adaptive execution splits.
    """
    rows = hosted(pages)
    paths = cut_lineage(host_paths(page_votes(pages))).select(F.col("host").alias("h"), "path")
    rows = rows.join(paths, F.col("host") == F.col("h"), "left").select("page_id", "url", "html", "path")

    def make():
        def one(page_id, url, source, path):
            text = Page(source or "").text(path)
            return page_id, url, text, len(text)

        return one

    return map_rows(rows, make, "page_id long, url string, text string, n_chars long")
