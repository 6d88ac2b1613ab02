"""Main text of web pages by consensus host paths.

Every page's containers are scored by the text that stands in them outside links; each page votes, in
Spark, for the generalised tag-class path of its best container, and per host the path with most votes
wins. Pages are then read again and the text below the winning path is extracted; a page that lacks it
falls back on its own best container.

Votes are counted before the shuffle. The winning paths of the hosts with the most html, `BROADCAST`
rows at most, are broadcast, so that their pages stay where they are read and no host is a task of its
own; only pages of further hosts are dealt out by host.
"""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import lean, written
from .url_filter import url_host

#: Hosts whose paths are broadcast at most, and characters of the host and the path of each.
BROADCAST, LONGEST = 50_000, 500

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style noscript template iframe textarea title svg math object select".split())
NOISE_TAGS = frozenset("nav footer aside form button menu dialog head".split()) | RAW
NOISE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent notice notices alert sidebar menu nav navbar navigation breadcrumb breadcrumbs "
    "footer header masthead comment comments disqus reply replies related share sharing social newsletter subscribe signup login search widget popup modal toolbar pagination pager".split()
)
BLOCKS = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul".split())
#: Blocks that hold text rather than other blocks: the container is what is around them.
TEXT_BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li blockquote pre dt dd figcaption caption ul ol dl table tbody thead tfoot tr td th summary center address".split())
MAIN = frozenset("article main".split())
#: Open elements that a start tag of the key ends.
ENDS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}

_markup = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(?=/?[a-zA-Z])[^<]*+\Z""", re.S)
_attribute = re.compile(r"""\b(class|id|role)\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++))""", re.I)
_digits = re.compile(r"\d+")
_word = re.compile(r"[a-z]+")
_raw_end = {tag: re.compile(rf"</{tag}\s*+[^>]*+>", re.I) for tag in RAW}


class Page:
    """The text blocks of a page that aren't noise: the path of the container, and the text."""

    def __init__(self, source: str) -> None:
        self.blocks: list[tuple[str, str, int]] = []  # path of the container, text, characters in links
        self.own: dict[str, str] = {}  # path and its tag
        stack: list[tuple[str, str, bool]] = [("", "", False)]  # tag, container's path, noise
        parts: list[str] = []
        linked, links, at = 0, 0, 0

        def flush() -> None:
            nonlocal linked
            if parts:
                text = " ".join(html.unescape("".join(parts)).split())
                if text and not stack[-1][2]:
                    self.blocks.append((stack[-1][1], text, linked))
                parts.clear()
            linked = 0

        def text(piece: str) -> None:
            nonlocal linked
            if piece and not stack[-1][2]:
                parts.append(piece)
                if links:
                    linked += len(piece.strip())

        def close(depth: int) -> None:
            nonlocal links
            if any(tag in BLOCKS for tag, _, _ in stack[depth:]) or stack[-1][2] != stack[depth - 1][2]:
                flush()
            links -= sum(tag == "a" for tag, _, _ in stack[depth:])
            del stack[depth:]

        position, find = 0, _markup.search
        while m := find(source, position):
            text(source[at : m.start()])
            at = position = m.end()
            if not m[2]:
                continue
            tag = m[2].lower()
            if m[1]:
                for depth in range(len(stack) - 1, 0, -1):
                    if stack[depth][0] == tag:
                        close(depth)
                        break
                    if stack[depth][0] in MAIN and tag not in ("body", "html"):  # an end tag doesn't reach beyond the article
                        break
                else:
                    if tag in ("br", "p"):
                        flush()
                continue
            if tag in RAW:
                if not m[3].endswith("/"):
                    end = _raw_end[tag].search(source, at)
                    at = position = end.end() if end else len(source)
                continue
            if tag in BLOCKS or tag == "br":
                flush()
                if tag in BLOCKS:
                    ended = ENDS.get(tag, ()) if tag in ENDS else ()
                    for depth in range(len(stack) - 1, 0, -1):
                        if stack[depth][0] == "p" or stack[depth][0] in ended:
                            close(depth)
                            break
                        if stack[depth][0] in BLOCKS and stack[depth][0] not in ("td", "th"):
                            break
            if tag in VOID or m[3].endswith("/"):
                continue
            words, label, role = set(), tag, ""
            if m[3]:
                for name, a, b, c in _attribute.findall(m[3]):
                    value = (a or b or c).lower()
                    if name.lower() == "role":
                        role = value
                        continue
                    words.update(w for x in value.split() for w in _word.findall(x))
                    if name.lower() == "class":
                        label += "".join("." + _digits.sub("#", x) for x in sorted(set(value.split()))[:3])
            inner = any(t in MAIN for t, _, _ in stack)
            noise = stack[-1][2] or tag in NOISE_TAGS or (tag == "header" and not inner) or (bool(words & NOISE_WORDS) and tag not in ("body", "html") and tag not in MAIN and not (tag[0] == "h" and tag[1:].isdigit()))
            noise = noise or role in ("navigation", "banner", "contentinfo", "complementary", "search", "dialog")
            if noise and not stack[-1][2]:
                flush()
            path = stack[-1][1]
            if tag in BLOCKS and tag not in TEXT_BLOCKS and tag not in ("html", "body"):
                path = f"{path}/{label}"
                self.own[path] = "main" if role == "main" else tag
            if tag == "a":
                links += 1
            stack.append((tag, path, noise))
        text(source[at:])
        flush()

    def scores(self) -> dict[str, int]:
        """By path: characters outside links, whole for the container, halved for each step outwards;
        whole for articles and main elements around it."""
        found: dict[str, int] = defaultdict(int)
        for path, text, linked in self.blocks:
            weight, size = 1 << 10, max(0, len(text) - 2 * linked)
            while size:
                found[path] += size * ((1 << 10) + 1 if self.own.get(path) in MAIN else weight)
                if not path:
                    break
                path, weight = path.rpartition("/")[0], weight >> 1
        return found

    def best(self) -> str | None:
        """The path with the highest score. Without articles and main elements, the parent instead as long as
        what else stands below it is mostly text outside links: an article may span several containers.
        Containers that stand side by side in the body stay apart."""
        found = self.scores()
        path = min(found, key=lambda p: (-found[p], len(p), p)) if found else None
        if path is None or not MAIN.isdisjoint(self.own.values()):
            return path
        inner = path
        while parent := inner.rpartition("/")[0]:
            rest = [(len(t), n) for p, t, n in self.blocks if (p == parent or p.startswith(parent + "/")) and p != inner and not p.startswith(inner + "/")]
            if 2 * sum(n for _, n in rest) > sum(n for n, _ in rest):
                break
            inner = parent
            if rest:
                path = parent
        return path

    def below(self, path: str) -> str | None:
        """The text of the blocks at and below a path; None if the page doesn't have it."""
        inside = [t for p, t, _ in self.blocks if p == path or p.startswith(path + "/")]
        return " ".join(inside) if inside or path in self.own else None


def main_text(source: str | None, path: str | None = None) -> str:
    """Text below `path`, or else below the page's own best container; empty if there is none."""
    page = Page(source or "")
    text = page.below(path) if path is not None else None
    if text is None:
        own = page.best()
        text = page.below(own) if own is not None else None
    return text or ""


def host_paths(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """host, path, size: the generalised path that most of a host's pages vote for, and the characters of
    those pages. Ties go to the path with the higher score, then the shorter, then the first by name."""

    def votes(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hosts, paths, scores, sizes = [], [], [], []
            for host, source in zip(batch.column("host"), batch.column("html"), strict=True):
                raw = source.as_py() or ""
                page = Page(raw)
                if (best := page.best()) is not None:
                    sizes.append(len(raw))
                    hosts.append(host.as_py())
                    paths.append(best)
                    scores.append(page.scores()[best])
            yield pa.RecordBatch.from_arrays([pa.array(hosts, pa.string()), pa.array(paths, pa.string()), pa.array(scores, pa.int64()), pa.array(sizes, pa.int64())], ["host", "path", "score", "size"])

    rows = pages.select(url_host(F.coalesce(F.col(url_col), F.lit(""))).alias("host"), F.col(html_col).alias("html"))
    counted = rows.mapInArrow(lean(votes), "host string, path string, score long, size long").groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("score").alias("score"), F.sum("size").alias("size"))
    return counted.groupBy("host").agg(F.min_by("path", F.struct(-F.col("votes"), -F.col("score"), F.length("path"), "path")).alias("path"), F.sum("size").alias("size"))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of each row of `pages`, from the whole html.

    Null or empty html, and pages without text, give an empty text; a null URL or one without a host
    votes with others of that kind. Repeated rows come out each, and their votes count each. Pages of any
    length are read whole, one at a time. No rows give no rows; other columns are not read.
    """
    kind = pages.schema[id_col].dataType.simpleString()
    winners = written(host_paths(pages, url_col, html_col), "paths")
    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"), url_host(F.coalesce(F.col(url_col), F.lit(""))).alias("host"))
    short = F.length("host") + F.length("path") <= LONGEST
    hosts = winners.agg(F.count("*").alias("n"), F.count_if(short).alias("short")).head()

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(source.as_py(), path.as_py()) for source, path in zip(batch.column("html"), batch.column("path"), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([*map(len, texts)], pa.int64())], ["page_id", "url", "text", "n_chars"])

    if hosts["n"] == hosts["short"] <= BROADCAST:
        joined = own.join(F.broadcast(winners.select("host", "path")), "host", "left")
    else:
        great = written(winners.filter(short).orderBy(F.desc("size"), "host").limit(BROADCAST).select("host", "path"), "great")
        rest = own.join(F.broadcast(great.select("host")), "host", "left_anti")
        joined = own.join(F.broadcast(great), "host").unionByName(rest.join(winners.select("host", "path"), "host", "left"))
    return joined.select("page_id", "url", "html", "path").mapInArrow(lean(run), f"page_id {kind}, url string, text string, n_chars long")
