"""Main text of web pages: structure where a page has it, repeated runs of its host where it has not.

A page is read into blocks. Menus, headers, footers, sidebars, notices, adverts, forms, scripts, styles and reader
comments are told by tag, role, class or id, and by what the page's host repeats. The token streams of the parts outside
marked articles (``article`` or ``main``), and of whole pages that mark none, are put together per host and sorted into a
suffix array; runs of at least ``RUN`` tokens that stand on distinct pages there are the host's frame. Every page is
searched for the frame of its host: a page that marks no article loses the runs; in a marked article they are candidates,
and structure has the last word: blocks go that the runs cover whole, that stand in different articles too and that are
text put straight into a ``div`` or ``section``. So a notice inside articles goes without being named as one, while
paragraphs and headings stay even if adverts quote them, and so do the copy of an article on a second page, a passage that
articles share and the teaser of an article on other pages. Articles differ when their first blocks do.

No host meets in one task: the streams are cut into stretches under content-defined keys (equal runs have equal
keys), equal stretches collapse to one before they meet, and keys are dealt over buckets of a fixed expected size, so a host
of any size is spread. Of articles only stretches travel whose key the frame has (a bitmap of fixed size, 2 MB; a false hit
sends a stretch for nothing).

Defined cases: NULL and empty html give the empty text; pages cut off in the middle give what is there; repeated rows
are one page to each other (same url and html), so they do not count as boilerplate; NULL urls share one host;
only page_id, url and html are read.
"""

from __future__ import annotations

import hashlib
import html as entities
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.anchors import sliding_least
from tidemark.llm.repeats import _bitmap, _marked
from tidemark.llm.run_index import covered
from tidemark.llm.shingles import mix, word_hashes
from tidemark.session import staged, text_batches

RUN, GRAM = 8, 4
#: Stretches per bucket.
BUCKET = 40_000
#: Of the bitmaps of keys and of pages.
BITS = 24
#: Characters whose tokens are hashed together.
CHUNK = 1 << 20

_PART = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)>|<[/!?a-zA-Z][^>]*\Z|[^<]+|<", re.S)
_RAW = {"script", "style", "textarea", "title", "noscript", "template", "iframe", "svg", "math", "object", "canvas"}
_OUT = {"nav", "footer", "aside", "form", "button", "select", "head", "menu", "dialog"}
_VOID = {"br", "hr", "img", "input", "meta", "link", "wbr", "source", "area", "base", "col", "embed", "track", "param"}
_INLINE = set("a abbr b bdi bdo cite code data dfn del em font i ins kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split())
_NAMED = re.compile(r"""(?:class|id|role|aria-label)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_JUNK = frozenset(
    "ad ads adv advert advertisement advertising adsense sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notices alert sidebar menu nav navbar "
    "navigation breadcrumb breadcrumbs footer header masthead comment comments disqus share sharing social related newsletter subscribe subscription popup modal login search "
    "complementary contentinfo widget toolbar pagination".split())
_CONTENT = frozenset("content article post entry story main".split())
_HAS = frozenset("with has no without".split())
_HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
_SPACES = re.compile(r"\s+")


#: Where a block stands: in a part to leave out, in the open, in the marked article, there straight in one of ``_LOOSE``.
JUNK, OPEN, INSIDE, LOOSE = 0, 1, 2, 3
_LOOSE = ("div", "section")


def blocks(html: str) -> tuple[bool, list[tuple[int, str]]]:
    """Whether the page marks its article, and its text blocks in order as (:data:`JUNK`, :data:`OPEN`, :data:`INSIDE` or :data:`LOOSE`, text)."""
    out: list[tuple[int, str]] = []
    text: list[str] = []
    depth = 0  # of article or main
    marked = False
    inner = ""  # the block element opened last, unless another ended since
    skip, nested = "", 0  # the tag that opened a part to leave out, and how many of its name are open

    def flush() -> None:
        if text:
            block = _SPACES.sub(" ", entities.unescape("".join(text))).strip()
            if block:
                out.append((JUNK if skip else OPEN if not depth else LOOSE if inner in _LOOSE else INSIDE, block))
            text.clear()

    at = 0
    while m := _PART.match(html, at):
        at = m.end()
        name = m.group(2)
        if name is None:
            piece = m.group(0)
            if piece[:1] != "<" or piece == "<":
                text.append(piece)
            if at == len(html):
                break
            continue
        name, closing = name.lower(), m.group(1) == "/"
        if name in _RAW and not closing:  # no markup in there, only its own end
            if not m.group(3).endswith("/"):
                end = re.compile(f"</{name}[^>]*(?:>|\\Z)", re.I).search(html, at)
                at = end.end() if end else len(html)
            if name == "title":
                flush()
            continue
        if skip == "p" and name not in _INLINE and name not in _VOID and not (closing and name == "p"):
            flush()  # a paragraph's end tag may be left out: the next block, or its parent's end, ends it
            skip = ""
        if skip:
            if name == skip:
                if closing:
                    nested -= 1
                    if not nested:
                        flush()
                        skip = ""
                elif not m.group(3).endswith("/"):
                    nested += 1
                continue
            if name not in _INLINE:
                flush()
            continue
        if name in _INLINE and closing:
            continue
        if not closing and name not in _VOID and name != "html" and name != "body" and (name in _OUT or name == "header" and not depth or _is_junk(name, m.group(3))):
            if not m.group(3).endswith("/"):
                flush()
                skip, nested = name, 1
            continue
        if name in _INLINE:
            continue
        flush()
        inner = "" if closing else name
        if name in ("article", "main"):
            depth = max(0, depth - 1) if closing else depth + 1
            marked |= not closing
    flush()
    return marked, out


def _is_junk(element: str, attributes: str) -> bool:
    """Whether an element's names say that it is no content. Names of what it has, or lacks, say nothing about itself."""
    if not attributes or "=" not in attributes and "hidden" not in attributes:
        return False
    words = _JUNK - {"header"} if element in _HEADINGS else _JUNK
    names = [n for m in _NAMED.finditer(attributes) for n in (m.group(1) or m.group(2) or m.group(3) or "").lower().split()]
    if _CONTENT.isdisjoint(names):
        for n in names:
            parts = [x for x in re.split(r"[^a-z0-9]+", n) if x]
            if parts and parts[0] not in _HAS and not words.isdisjoint(parts):
                return True
    return bool(_HIDDEN.search(attributes))


def host(url: str | None) -> str:
    m = re.match(r"[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m.group(1).lower() if m else ""


def _number(*texts: str | None) -> int:
    """A 64-bit number for texts: of a page's url and html, or of a block."""
    return int.from_bytes(hashlib.sha256(" ".join(map(str, texts)).encode("utf-8", "surrogatepass")).digest()[:8], "little", signed=True)


def _cut(streams: list[tuple[str, str]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[bytes]]:
    """The stretches of token streams given as (host, blocks joined by a space): stream, key, first token, tokens (as bytes)."""
    none = np.empty(0, np.int64)
    words = word_hashes(" ".join(t for _, t in streams).encode("utf-8", "surrogatepass"))
    if len(words) < RUN:
        return none, none, none, []
    sizes = np.array([t.count(" ") + 1 for _, t in streams])
    seeds = {h: mix(word_hashes(h.encode("utf-8", "surrogatepass") or b"?"))[0] for h in {h for h, _ in streams}}
    owner = np.repeat(np.arange(len(streams)), sizes)
    tokens = mix(words ^ np.array([seeds[h] for h, _ in streams], np.uint64)[owner])  # told apart by host
    grams = tokens[:len(tokens) - GRAM + 1].copy()
    for k in range(1, GRAM):
        grams = grams * np.uint64(0xC2B2AE3D27D4EB4F) + tokens[k:len(tokens) - GRAM + 1 + k]
    keys = sliding_least(mix(grams), RUN - GRAM + 1)
    spot = np.flatnonzero(owner[:len(keys)] == owner[RUN - 1:])  # runs that end in the stream they begin in
    if not len(spot):
        return none, none, none, []
    key, stream = keys[spot], owner[spot]
    new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (stream[1:] != stream[:-1])]))
    first, last = spot[new], spot[np.concatenate([new[1:], [len(spot)]]) - 1]
    begin = np.cumsum(sizes) - sizes
    held = [tokens[a:b].tobytes() for a, b in zip(first.tolist(), (last + RUN).tolist(), strict=True)]
    return stream[new], key[new].astype(np.int64), first - begin[stream[new]], held


def _chunks(streams):
    """Lists of (page, host, text, further) of about :data:`CHUNK` characters of text."""
    part, size = [], 0
    for x in streams:
        part.append(x)
        size += len(x[2])
        if size > CHUNK:
            yield part
            part, size = [], 0
    if part:
        yield part


def frames(pages: DataFrame) -> DataFrame:
    """Stretches of the token streams outside articles: key, page, at, tokens, whether the page marks no article."""
    def outside(batch):
        for url, html in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            marked, found = blocks(html or "")
            if parts := [t for zone, t in found if not (marked and zone >= INSIDE)]:
                yield _number(url, html or ""), host(url), " ".join(parts), not marked

    def read(batches):
        for batch in batches:
            for part in _chunks(outside(batch)):
                stream, key, at, held = _cut([x[1:3] for x in part])
                page, plain = np.array([x[0] for x in part], np.int64), np.array([x[3] for x in part], bool)
                yield pa.record_batch([pa.array(key), pa.array(page[stream]), pa.array(at), pa.array(held, pa.binary()), pa.array(plain[stream])], names=["key", "page", "at", "tokens", "plain"])

    return pages.select("url", "html").mapInArrow(read, "key long, page long, at long, tokens binary, plain boolean")


def articles(pages: DataFrame, keys) -> DataFrame:
    """Stretches of marked articles with a marked key: key, page, at, tokens, article (by its first block)."""
    def inside(batch):
        for url, html in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            marked, found = blocks(html or "")
            if parts := [t for zone, t in found if marked and zone >= INSIDE]:
                yield _number(url, html or ""), host(url), " ".join(parts), _number(parts[0])

    def read(batches):
        for batch in batches:
            for part in _chunks(inside(batch)):
                stream, key, at, held = _cut([x[1:3] for x in part])
                hit = np.flatnonzero(_marked(keys.value, key, BITS))
                page, article = np.array([x[0] for x in part], np.int64), np.array([x[3] for x in part], np.int64)
                yield pa.record_batch([pa.array(key[hit]), pa.array(page[stream[hit]]), pa.array(at[hit]), pa.array([held[k] for k in hit.tolist()], pa.binary()), pa.array(article[stream[hit]])],
                                      names=["key", "page", "at", "tokens", "article"])

    return pages.select("url", "html").mapInArrow(read, "key long, page long, at long, tokens binary, article long")


def _array(rows: pd.DataFrame) -> pd.DataFrame:
    """Where each distinct stretch of a bucket holds a run of ``RUN`` tokens of the frame, and one that different articles hold too, by a suffix array."""
    parts = [np.frombuffer(x, np.uint64) for x in rows["tokens"]]
    size = np.array([len(p) for p in parts])
    text = np.concatenate(parts)
    begin = np.cumsum(size) - size
    _, rank = np.unique(text, return_inverse=True)
    rank, have = rank.astype(np.uint64), 1
    while have < RUN:  # RUN is a power of two
        after = np.concatenate([rank[have:], np.zeros(have, np.uint64)])
        _, rank = np.unique((rank << np.uint64(32)) | after, return_inverse=True)
        rank, have = rank.astype(np.uint64), 2 * have
    spots = size - RUN + 1
    owner = np.repeat(np.arange(len(parts)), spots)
    place = np.repeat(begin - (np.cumsum(spots) - spots), spots) + np.arange(spots.sum())
    order = np.argsort(rank[place], kind="stable")  # suffixes by their first RUN tokens
    ranked = rank[place][order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    start, group = np.flatnonzero(new), np.cumsum(new) - 1

    def several(least: str, most: str) -> np.ndarray:
        low, high = (rows[c].astype("Int64").fillna(x).to_numpy(np.int64)[owner[order]] for c, x in ((least, 2 ** 63 - 1), (most, -2 ** 63)))
        return (np.minimum.reduceat(low, start) < np.maximum.reduceat(high, start))[group]

    framed = several("page_low", "page_high")
    inside = (framed & several("article_low", "article_high"))[framed]
    owned, spot = owner[order[framed]], place[order[framed]] - begin[owner[order[framed]]]
    out = pd.DataFrame({"row": owned, "spot": spot, "inside": inside}).groupby("row").agg(list).reset_index()
    return pd.DataFrame({"key": rows["key"].to_numpy()[out["row"]], "tokens": rows["tokens"].to_numpy()[out["row"]], "spots": out["spot"], "inside": out["inside"]})


def _unique(starts: np.ndarray, sizes: np.ndarray, open_: np.ndarray, parts: bool = True) -> np.ndarray:
    """Which tokens of a page stay: those of open blocks, less blocks that repeated runs cover, and (``parts``) runs inside a block.

    A run may begin in one block and end in the next; of a block that is not covered as a whole it takes nothing then.
    """
    ends = np.cumsum(sizes)
    block = np.repeat(np.arange(len(sizes)), sizes)
    keep = np.repeat(open_, sizes)
    over = np.zeros(len(block), bool)
    for a, b in covered(starts, starts + RUN):
        over[a:b] = True
    whole = np.bincount(block, over, len(sizes)) == sizes
    inside = starts[starts + RUN <= ends[block[starts]]] if len(starts) else starts
    for a, b in covered(inside, inside + RUN) if parts else ():
        keep[a:b] = False
    return keep & ~whole[block]


def frame_starts(pages: DataFrame) -> DataFrame:
    """page, starts: where the runs of its host's frame begin that count on the page (tokens of the article, or of all blocks if none is marked)."""
    spark = pages.sparkSession
    outside = staged(frames(pages))
    keys = staged(outside.groupBy("key").agg(F.min("page").alias("low"), F.max("page").alias("high")).filter("low <> high").select("key"))
    marks = spark.sparkContext.broadcast(_bitmap(keys, "key", BITS))  # one bit a cell
    inside = staged(articles(pages, marks))
    outside = outside.join(keys, "key", "left_semi")
    every = outside.select("key", "tokens", "page", F.lit(None).cast("long").alias("article")).union(inside.select("key", "tokens", F.lit(None).cast("long"), "article"))
    distinct = every.groupBy("key", "tokens").agg(*[f(c).alias(f"{c}_{end}") for c in ("page", "article") for f, end in ((F.min, "low"), (F.max, "high"))])
    buckets = max(1, -(-(outside.count() + inside.count()) // BUCKET))
    found = distinct.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(buckets))).groupBy("bucket").applyInPandas(_array, "key long, tokens binary, spots array<long>, inside array<boolean>")
    found = staged(found)
    plain = outside.filter("plain").join(found, ["key", "tokens"]).select("page", F.explode("spots").alias("spot"), "at")
    framed = inside.join(found, ["key", "tokens"]).select("page", F.explode(F.expr("filter(spots, (x, i) -> inside[i])")).alias("spot"), "at")
    return plain.union(framed).groupBy("page").agg(F.collect_set(F.col("at") + F.col("spot")).alias("starts"))  # one page's places


def _text(html: str | None, starts: list[int] | None) -> str:
    """The main text of a page, given where runs of its host's frame begin."""
    marked, found = blocks(html or "")
    if marked:
        found = [(zone, t) for zone, t in found if zone >= INSIDE]
    if not starts:
        return " ".join(t for zone, t in found if zone != JUNK)
    words, zones = [t.split(" ") for _, t in found], np.array([zone for zone, _ in found])
    sizes = np.array([len(w) for w in words], np.int64)
    keep = _unique(np.array(sorted(starts), np.int64), sizes, zones != JUNK, not marked) | np.repeat(zones == INSIDE, sizes)
    return " ".join(w for w, k in zip((w for block in words for w in block), keep.tolist(), strict=True) if k)


def extract(pages: DataFrame) -> DataFrame:
    """page_id, url, text and n_chars of every page."""
    spark = pages.sparkSession
    text_batches(spark)
    starts = staged(frame_starts(pages))
    marks = spark.sparkContext.broadcast(_bitmap(starts, "page", BITS))  # pages on which the frame counts; only these meet their places

    def rows(batch):
        columns = [batch.column(k).to_pylist() for k in (1, 2)]
        page = np.array([_number(url, html or "") for url, html in zip(*columns, strict=True)], np.int64)
        return page, _marked(marks.value, page, BITS)

    def free(batches):
        for batch in batches:
            some = batch.filter(pa.array(~rows(batch)[1]))
            yield pa.record_batch([some.column(0), some.column(1), pa.array([_text(h, None) for h in some.column(2).to_pylist()], pa.string())], names=["page_id", "url", "text"])

    def held(batches):
        for batch in batches:
            page, hit = rows(batch)
            yield pa.record_batch([*batch.filter(pa.array(hit)).columns, pa.array(page[hit])], names=["page_id", "url", "html", "page"])

    def cut(batches):
        for batch in batches:
            texts = [_text(h, s) for h, s in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)]
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    kind = pages.schema["page_id"].dataType.simpleString()
    read = pages.select("page_id", "url", "html")
    framed = read.mapInArrow(held, f"page_id {kind}, url string, html string, page long").join(starts, "page", "left").select("page_id", "url", "html", "starts")
    out = f"page_id {kind}, url string, text string"
    texts = read.mapInArrow(free, out).union(framed.mapInArrow(cut, out))
    return texts.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))


def query(spark, sf_dir: str) -> DataFrame:
    """op6: the main text of every page."""
    return extract(spark.read.parquet(f"{sf_dir}/pages.parquet"))
