"""Main text of web pages by consensus host paths.

1. Every page's containers are scored: the share of the page's clean text below
   them, weighted by what tag and class say about them. Containers go by their
   generalised path: tags and classes from the root, digits taken out.
2. The scores are votes, added up per host and path in Spark (partial sums
   first, so a hot host is no hot task); the path with most votes wins.
3. Each page is extracted again from the containers with its host's winning
   path, if they hold most of what the page's own best container holds (or
   ``LEAST_SHARE`` of it, where that is around them). Otherwise its own best
   container is used: the host has several templates, and the path may hold a
   teaser only. One case is left to the host: no other page has that best path,
   and the winning path holds as much as it usually does, so the page has its
   article there, beside something loud.
4. What is clean beside the chosen container, in the containers around it, is
   added (``_extended``): a headline or a lead may stand outside of it.

Never part of the text: scripts, styles, comments in the markup, menus, page
headers, footers, sidebars, notices, adverts, forms and reader comments, by
tag, role, class or id. A form, or a container left out by its class or id only,
stays where it carries the page (see ``_carries``); where these names would
leave out all text, none of them counts. A block is the inline content between
two block-level tags; character references are decoded, white space becomes one space, blocks
are joined by an empty line. Nothing else is dropped or cut.

Null or empty html gives an empty text. Pages without a host share the empty
host. Repeated rows are extracted each; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import html
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import store

#: Fixed lists of tags and of the words in classes and ids.
SKIPPED_TAGS = set("nav footer aside button select menu dialog svg".split())
RAW_TAGS = "script style title textarea noscript template iframe xmp noembed noframes head".split()
VOID_TAGS = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE_TAGS = set("a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q s "
                  "samp small span strike strong sub sup time tt u var wbr "
                  # embedded in a line: a formula, or what stands in for a medium
                  "object audio video canvas map math mi mn mo ms mtext mspace mrow mfrac msqrt mroot mstyle merror mpadded "
                  "mphantom msub msup msubsup munder mover munderover mmultiscripts mtable mtr mtd semantics annotation "
                  "annotation-xml".split())
CONTAINERS = set("html body main article section div td center".split())
PLAIN_TAGS = {"html", "body", "main", "article"}
TITLES = {"h1", "h2"}
SKIPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "form", "menu"}
SKIPPED_WORDS = set(
    "nav navbar navigation menu header masthead topbar footer sidebar aside notice cookie cookies consent gdpr banner "
    "ad ads advert adverts advertisement advertising sponsor sponsored promo popup modal share sharing social comment "
    "comments disqus replies related recommended newsletter subscribe breadcrumb breadcrumbs pagination pager login "
    "signup search toolbar widget alert".split())
#: In a class like has-sidebar or no-ads the other words tell about the page, not about the container.
MODIFIERS = {"has", "no", "non", "with", "without"}
READERS = {"comment", "comments", "disqus", "replies"}
GOOD_WORDS = set("article content main post entry story text body".split())
WEIGHTS = {"article": 1.5, "main": 1.3, "section": 0.9, "td": 0.9, "body": 0.7, "html": 0.6}
#: Containers with less of a page's text get no vote; a vote is in thousandths.
LEAST_SHARE = 0.2
#: A winning path is used where it holds so much of the page's own best container.
MOST = 0.5

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"
    r"|<(?P<raw>" + "|".join(t for t in RAW_TAGS if t != "head") + r")(?=[\s/>])(?:[^>\"']|\"[^\"]*\"|'[^']*')*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>(?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>"
    r"|<(?P<end2>/?)(?P<tag2>[a-zA-Z][^\s/>]*+)[^>]*+>"
    r"|</?[a-zA-Z][^>]*+\Z"  # a tag that never ends
    r"|(?P<text>[^<]++|<)", re.S | re.I)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_WORD = re.compile(r"[^a-z]+")


class Doubt(NamedTuple):
    """A container that is left out by its name, or a form, unless it carries the page."""

    words: set[str]              # the skipped words of its class and id
    plain: bool                  # a class or id consists of skipped words only
    article: list[int]           # one entry per article opened in it


class Block(NamedTuple):
    text: str
    links: int                   # characters of it inside links
    inside: tuple[int, ...]      # containers around it, by number
    title: bool = False          # a heading of the first two levels


def _named(attrs: str) -> tuple[str, set[str], str, str]:
    """(class, words of class and id, role, id) of a tag's attributes."""
    if "=" not in attrs:
        return "", set(), "", ""
    got = {k.lower(): a or b or c for k, a, b, c in _ATTR.findall(attrs)}
    cls = got.get("class", "")
    words = set(_WORD.split(f"{cls} {got.get('id', '')}".lower())) - {""} if cls or "id" in got else set()
    return cls, words, got.get("role", "").lower(), got.get("id", "")


def _skipped_words(cls: str, ident: str) -> tuple[set[str], bool]:
    """The skipped words of a class and id, and whether one name has no other words."""
    found: set[str] = set()
    plain = False
    for name in f"{cls} {ident}".lower().split():
        words = set(_WORD.split(name)) - {""}
        if words & SKIPPED_WORDS and not words & MODIFIERS:
            found |= words & SKIPPED_WORDS
            plain = plain or words <= SKIPPED_WORDS
    return found, plain


def _carries(d: Doubt, mine: list[int], rest: list[int]) -> bool:
    """Whether a doubtful container holds the page's content, by (characters,
    characters in links, paragraphs, characters in articles) in it and outside.
    Beside an article it must have most of the text and of the paragraphs."""
    size, links, paragraphs, article = mine
    if d.words & READERS and rest[0] > rest[1]:
        return False
    if rest[3]:
        return not d.plain and 2 * links <= size and size > rest[0] and (paragraphs > rest[2] or not paragraphs + rest[2])
    if d.article and (article >= LEAST_SHARE * (size + rest[0]) or paragraphs >= rest[2]):
        return True
    return 2 * links <= size and (paragraphs > rest[2] or size >= rest[0])


def _general(tag: str, cls: str) -> str:
    return ".".join([tag, *sorted({re.sub(r"\d+", "", c) for c in cls.lower().split()} - {""})])


def parse(page: str) -> tuple[list[Block], list[tuple[str, str, set[str]]]]:
    """The page's clean blocks in order, and its containers: (path, tag, words)."""
    blocks: list[Block] = []
    containers: list[tuple[str, str, set[str]]] = []
    stack: list[tuple[str, int, bool, bool]] = []   # tag, container number or -1, skipped, doubtful
    inside: list[int] = []
    doubts: list[Doubt] = []
    doubtful: list[int] = []
    places: list[tuple[tuple[int, ...], bool, bool]] = []   # per block: doubtful containers, in a paragraph, in an article
    skipped = links = article = paragraph = title = 0
    held: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            if text:
                blocks.append(Block(text, linked, tuple(inside), title > 0))
                places.append((tuple(doubtful), paragraph > 0, article > 0))
            held.clear()
        linked = 0

    def pop() -> None:
        nonlocal skipped, links, article, paragraph, title
        tag, number, skip, doubt = stack.pop()
        skipped -= skip
        links -= tag == "a"
        paragraph -= tag == "p"
        title -= tag in TITLES
        if doubt:
            doubtful.pop()
        article -= tag in ("article", "main")
        if number >= 0:
            inside.pop()

    for m in _TOKEN.finditer(page):
        if m["text"] is not None:
            if not skipped:
                text = html.unescape(m["text"]) if "&" in m["text"] else m["text"]
                held.append(text)
                linked += len(text) if links else 0
            continue
        tag = m["tag"] or m["tag2"]
        if not tag:
            if m["raw"]:
                flush() if m["raw"].lower() not in INLINE_TAGS else None
            continue
        tag = tag.lower()
        if tag not in INLINE_TAGS:
            flush()
        elif tag == "br":
            held.append(" ")
        if m["end"] or m["end2"]:
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] == tag), -1)
            if depth >= 0 and (tag not in INLINE_TAGS or all(s[0] in INLINE_TAGS for s in stack[depth:])):
                while len(stack) > depth:
                    pop()
            continue
        attrs = m["attrs"] or ""
        if tag in VOID_TAGS:
            continue
        if tag not in INLINE_TAGS:
            # a block ends an open paragraph and the inline tags in it
            depth = next((i for i in range(len(stack) - 1, -1, -1) if stack[i][0] not in INLINE_TAGS), -1)
            if depth >= 0 and stack[depth][0] == "p" or tag == "li" and depth >= 0 and stack[depth][0] == "li":
                while len(stack) > depth:
                    pop()
        cls, words, role, ident = _named(attrs)
        skip = tag in SKIPPED_TAGS or tag == "head" or role in SKIPPED_ROLES or tag == "header" and not article
        doubt = False
        if not skip and not skipped and tag not in INLINE_TAGS and tag not in PLAIN_TAGS and (tag == "form" or words & SKIPPED_WORDS):
            named, plain = _skipped_words(cls, ident)
            doubt = tag == "form" or bool(named) and not (article and named == {"header"})
            if doubt:
                doubtful.append(len(doubts))
                doubts.append(Doubt(named, plain, []))
        if tag in ("article", "main") and not skip and not skipped:
            for i in doubtful:
                doubts[i].article.append(1)
        number = -1
        if tag in CONTAINERS and not skip and not skipped:
            path = (containers[inside[-1]][0] + ">" if inside else "") + _general(tag, cls)
            number = len(containers)
            containers.append((path, tag, words))
            inside.append(number)
        stack.append((tag, number, skip, doubt))
        skipped += skip
        paragraph += tag == "p"
        title += tag in TITLES
        links += tag == "a"
        article += tag in ("article", "main")
    flush()
    return _decided(blocks, places, doubts), containers


def _decided(blocks: list[Block], places: list[tuple[tuple[int, ...], bool, bool]], doubts: list[Doubt]) -> list[Block]:
    """The blocks outside the doubtful containers that do not carry the page; all, if none is."""
    if not any(d for d, _, _ in places):
        return blocks
    total = [0] * 4
    own = [[0] * 4 for _ in doubts]
    for b, (inside, paragraph, article) in zip(blocks, places, strict=True):
        n = len(b.text)
        for sums in (total, *[own[i] for i in inside]):
            sums[0] += n
            sums[1] += min(b.links, n)
            sums[2] += paragraph
            sums[3] += n * article
    kept = [_carries(d, mine, [t - m for t, m in zip(total, mine, strict=True)]) for d, mine in zip(doubts, own, strict=True)]
    left = [b for b, (inside, _, _) in zip(blocks, places, strict=True) if all(kept[i] for i in inside)]
    return left or blocks


def _scored(blocks: list[Block], containers: list[tuple[str, str, set[str]]]) -> tuple[dict[str, int], dict[str, float]]:
    """(votes, characters outside links) by container path."""
    size: dict[str, float] = defaultdict(float)
    kind: dict[str, tuple[str, set[str]]] = {}
    total = 0.0
    for b in blocks:
        plain = len(b.text) - min(b.links, len(b.text))
        total += plain
        for path in {containers[i][0] for i in b.inside}:
            size[path] += plain
    for path, tag, words in containers:
        kind.setdefault(path, (tag, words))
    out = {}
    for path, n in size.items():
        if total and n / total >= LEAST_SHARE:
            tag, words = kind[path]
            weight = WEIGHTS.get(tag, 1.0) * (1.25 if words & GOOD_WORDS else 1.0) * (1 + 0.02 * path.count(">"))
            out[path] = round(1000 * weight * n / total)
    return out, size


def scores(page: str) -> dict[str, int]:
    """Votes of a page, by container path: thousandths of the weighted share of its clean text."""
    return _scored(*parse(page))[0]


def best_path(votes: dict[str, int]) -> str | None:
    return min(votes, key=lambda p: (-votes[p], p)) if votes else None


def _number(path: str) -> int:
    return int.from_bytes(hashlib.blake2b(path.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True)


def extract(page: str | None, path: str | None, usual: float | None = None, shared: Iterable[int] = ()) -> str:
    """The text of the containers with the path, or of the page's own best; a page without containers: all blocks.
    ``usual``: the mean of the host's characters at the path; ``shared``: the best paths that several pages have."""
    blocks, containers = parse(page or "")
    votes, size = _scored(blocks, containers)
    own = best_path(votes)
    if path is not None and own is not None and path != own:
        around = path.startswith(own + ">")
        if size.get(path, 0) < (LEAST_SHARE if around else MOST) * size[own]:
            alone = usual is not None and size.get(path, 0) >= MOST * usual and _number(own) not in shared
            path = path if alone else own
    for attempt in (path, own):
        if attempt is None:
            continue
        took = _extended(blocks, containers, attempt)
        if took:
            return "\n\n".join(b.text for b in took)
    return "\n\n".join(b.text for b in blocks) if own is None else ""


def _clean(blocks: list[Block]) -> bool:
    return 3 * sum(min(b.links, len(b.text)) for b in blocks) <= sum(len(b.text) for b in blocks)


def _extended(blocks: list[Block], containers: list[tuple[str, str, set[str]]], path: str) -> list[Block]:
    """The blocks of the containers with the path, and of the containers around
    the first of them, nearest first, what is clean beside it: a headline or lead
    may stand outside the container that won.

    Beside it, blocks go by the container that they are in. Those of a box count
    when few of their characters are in links; in an article or main all such
    boxes do, in other containers they must be smaller than what is there
    already. The whole page (html, body), and what is around an article, only
    adds a title that stands before.
    """
    took = {k for k, b in enumerate(blocks) if any(containers[i][0] == path for i in b.inside)}
    if not took:
        return []
    first = min(took)
    around = blocks[first].inside
    at = next(n for n, i in enumerate(around) if containers[i][0] == path)
    beside: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))   # by container around, then by box
    for k, b in enumerate(blocks):
        if k not in took:
            n = next((n for n, (i, j) in enumerate(zip(b.inside, around)) if i != j), min(len(b.inside), at))
            if n:
                beside[n - 1][b.inside[n] if len(b.inside) > n else -1 - k].append(k)
    whole = containers[around[at]][1] in ("article", "main")
    for n in range(at - 1, -1, -1):
        tag = containers[around[n]][1]
        semantic = tag in ("article", "main")
        for box in beside[n].values():
            own = [blocks[k] for k in box]
            if not _clean(own):
                continue
            if whole or tag in ("html", "body"):
                fits = len(own) == 1 and own[0].title and box[0] < first
            else:
                fits = semantic or sum(len(b.text) for b in own) <= MOST * sum(len(blocks[k].text) for k in took)
            if fits:
                took.update(box)
        whole = whole or semantic
    return [blocks[k] for k in sorted(took)]


def host_of(url: Column) -> Column:
    return F.lower(F.coalesce(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1), F.lit("")))


def _votes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = []
        for host, page in zip(b.column(0).to_pylist(), b.column(1), strict=True):
            votes, size = _scored(*parse(page.as_py() or ""))
            own = best_path(votes)
            rows += [(host, path, v, int(size[path]), int(path == own), _number(path)) for path, v in votes.items()]
        kinds = [pa.string(), pa.string(), *[pa.int64()] * 4]
        yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(kinds)],
                                         ["host", "path", "vote", "size", "best", "number"])


def host_paths(pages: DataFrame) -> DataFrame:
    """(host, path, votes, usual, shared): the winning path of every host, ties go to the path first in order; the mean
    of the characters there; numbers of the paths that are the best of several pages."""
    votes = pages.select(host_of(F.col("url")).alias("host"), "html").mapInArrow(
        _votes, "host string, path string, vote long, size long, best long, number long")
    total = votes.groupBy("host", "path").agg(F.sum("vote").alias("votes"), F.avg("size").alias("usual"), F.sum("best").alias("best"),
                                              F.first("number").alias("number"))
    won = total.groupBy("host").agg(F.min(F.struct((-F.col("votes")).alias("n"), "path", "usual")).alias("w"),
                                    F.collect_list(F.when(F.col("best") > 1, F.col("number"))).alias("shared"))
    return won.select("host", F.col("w.path").alias("path"), (-F.col("w.n")).alias("votes"), F.col("w.usual").alias("usual"), "shared")


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [extract(h.as_py(), p, u, s or ()) for h, p, u, s in zip(b.column(2), *[b.column(i).to_pylist() for i in (3, 4, 5)], strict=True)]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()),
                                          pa.array([len(t) for t in texts], pa.int64())], ["page_id", "url", "text", "n_chars"])


def main_texts(pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text (empty if none), n_chars."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html", host_of(F.col("url")).alias("host"))
    # a stored table: its size is known when the join is planned, so that a few
    # hosts are broadcast and the pages of a hot one stay where they are
    won = store(host_paths(pages).drop("votes"), "host-paths")
    rows = rows.join(won, "host", "left")
    return rows.select("page_id", "url", "html", "path", "usual", "shared").mapInArrow(
        _texts, "page_id long, url string, text string, n_chars long")
