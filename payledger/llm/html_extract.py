"""Main text of web pages (operator 10).

1. *Blocks.* A page is read into blocks of text with the elements round them.
   Scripts, styles, menus, footers, sidebars, notices, adverts, forms and reader
   comments go by element, role, or class and id; page headers go outside an article.
2. *Pairing.* Within a host, pages of equal blocks are one class, which stands
   where the first of its urls does in the order of paths. A class meets the
   classes before and after it. Long hosts are cut into ranges of that order, of
   ``GROUP`` classes or more; the ends of a range meet the ends of the next.
3. *Differencing.* The blocks of a class and its neighbour are aligned by longest
   common subsequence (bit-parallel), and shared blocks are deleted from all pages
   of the class: those shared with the neighbour whose path has the longer start in
   common, the one before if equal.

Markup checks the result on pages with an ``article`` or ``main`` element: blocks
outside are not part of the text, and a block inside is deleted only if it stands
at the same end of the article in the classes before and after, neither is a copy
of it (more than half of its characters, or of the other's blocks, shared), and more
than half of the host's classes hold it: a passage that articles quote stays. Differencing alone
would lose lines of articles that quote each other and keep menus that vary from
page to page (see README).

Defined results: a null or empty html gives an empty text. A null url, or one
without a host, is paired within the host ``''``. A page whose class
has no neighbour loses nothing to differencing; pages without blocks are none. Time
and memory stay in proportion to a malformed page: a stray end tag costs one look-up. Repeated rows keep their own
result; extra columns are ignored.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator
from html.parser import HTMLParser

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from payledger.llm.common import stored
from payledger.llm.url_filters import url_host, url_path

GROUP = 2000
LCS_BITS = 1 << 27  # table of an alignment, in one task

# HTML element kinds.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 "
    "h4 h5 h6 head header hgroup hr html legend li main menu nav ol option p pre section summary table tbody td tfoot th thead title tr ul".split())
DROPPED = frozenset(
    "aside audio button canvas datalist dialog embed footer form head iframe input link menu meta nav noscript object option script select "
    "style svg template textarea title video".split())
ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search toolbar".split())
HINT = re.compile(
    r"(?:^|[\s_-])(?:ads?|adverts?|advertis\w*|adslot|banners?|sponsor\w*|promo\w*|cookies?|consent|gdpr|notices?|alerts?|popups?|modal|"
    r"newsletter|subscribe|sidebars?|sidenav|menus?|nav|navbar|navigation|breadcrumbs?|footer|masthead|comments?|commentlist|replies|"
    r"discussion|disqus|share|sharing|social|related|recommend\w*|widgets?|toolbar|pagination|pager|login|signup)(?=$|[\s_-])", re.I)
HEADER_HINT = re.compile(r"(?:^|[\s_-])(?:header|topbar)(?=$|[\s_-])", re.I)


class _Blocks(HTMLParser):
    """Collects ``(text, in_main)`` of the blocks that are not dropped."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, bool]] = []
        self.open: list[tuple[str, bool, bool]] = []  # tag, dropped, in main
        self.count: Counter[str] = Counter()  # open elements of a tag
        self.edges: list[int] = []  # places of the block elements among the open ones
        self.dropped = self.main = self.seen_main = False
        self.part: list[str] = []

    def flush(self):
        text = " ".join("".join(self.part).split())
        if text:
            self.blocks.append((text, self.main))
        self.part = []

    def handle_starttag(self, tag, attrs):
        if tag in BLOCK:
            self.flush()
        elif tag == "br":
            self.part.append(" ")
        if tag in VOID:
            return
        if tag == "p" or tag == "li":
            # an unclosed element of the kind ends where the next one starts
            if self.edges and self.open[self.edges[-1]][0] == tag:
                self.close_from(self.edges[-1])
        dropped = self.dropped or tag in DROPPED or (tag == "header" and not self.main)
        main = self.main or tag in ("article", "main")
        if not dropped and attrs:
            given = dict(attrs)
            names = f"{given.get('class') or ''} {given.get('id') or ''}"
            if tag not in ("html", "body", "main"):
                dropped = bool(HINT.search(names)) or (not self.main and bool(HEADER_HINT.search(names))) or given.get("role") in ROLES
            dropped = dropped or "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in (given.get("style") or "").replace(" ", "")
        if tag in BLOCK:
            self.edges.append(len(self.open))
        self.count[tag] += 1
        self.open.append((tag, dropped, main))
        self.dropped, self.main = dropped, main and not dropped
        self.seen_main = self.seen_main or self.main

    def handle_endtag(self, tag):
        if tag in BLOCK:
            self.flush()
        if not self.count[tag]:
            return  # a stray end tag
        i = len(self.open) - 1
        while self.open[i][0] != tag:
            i -= 1
        self.close_from(i)

    def close_from(self, i):
        """Closes the open elements from place ``i`` on; each is closed once."""
        self.count.subtract(tag for tag, _, _ in self.open[i:])
        del self.open[i:]
        while self.edges and self.edges[-1] >= i:
            self.edges.pop()
        _, self.dropped, main = self.open[-1] if self.open else ("", False, False)
        self.main = main and not self.dropped

    def handle_data(self, data):
        if not self.dropped:
            self.part.append(data)


def page_blocks(html: str | None) -> tuple[list[str], bool]:
    """The blocks of a page that may be its text, and whether markup names them."""
    if not html:
        return [], False
    p = _Blocks()
    p.feed(html)
    p.close()
    p.flush()
    return [t for t, main in p.blocks if main or not p.seen_main], p.seen_main


def _unmatched(a: list, b: list) -> int:
    """Bits of the places of ``a`` that lengthen no common subsequence with ``b``:
    that of ``a[:k]`` and ``b`` is as long as the zeros among the first ``k``."""
    full = (1 << len(a)) - 1
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    v = full
    for y in b:
        u = v & places.get(y, 0)
        v = ((v + u) | (v - u)) & full
    return v


def _lengths(a: list, b: list) -> np.ndarray:
    """Length of a longest common subsequence of ``a[:k]`` and ``b`` for every k."""
    bits = np.frombuffer(_unmatched(a, b).to_bytes(len(a) // 8 + 1, "little"), dtype=np.uint8)
    zeros = 1 - np.unpackbits(bits, bitorder="little")[: len(a)].astype(np.int64)
    return np.concatenate([[0], np.cumsum(zeros)])


def common_lines(a: list, b: list, room: int = LCS_BITS) -> set[int]:
    """Indices of ``a`` in a longest common subsequence of ``a`` and ``b``. Equal
    ends belong to one; what is left is halved until the table of a part, a bit
    for a pair of lines, has at most ``room`` bits."""
    out: set[int] = set()
    todo = [(0, len(a), 0, len(b))]
    while todo:
        i, j, k, m = todo.pop()
        while i < j and k < m and a[i] == b[k]:
            out.add(i)
            i, k = i + 1, k + 1
        while i < j and k < m and a[j - 1] == b[m - 1]:
            out.add(j - 1)
            j, m = j - 1, m - 1
        if i == j or k == m:
            continue
        if (j - i) * (m - k) > room and m - k > 1:
            half = (k + m) // 2
            ahead = _lengths(a[i:j], b[k:half])
            behind = _lengths(a[i:j][::-1], b[half:m][::-1])[::-1]
            cut = i + int(np.argmax(ahead + behind))
            todo += [(i, cut, k, half), (cut, j, half, m)]
        else:
            out.update(i + x for x in _table(a[i:j], b[k:m]))
    return out


def _table(a: list, b: list) -> set[int]:
    """``common_lines`` by a walk back through the rows of the whole table."""
    full = (1 << len(a)) - 1
    places: dict = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    v, rows = full, []
    for y in b:
        u = v & places.get(y, 0)
        v = ((v + u) | (v - u)) & full
        rows.append(v)
    out, col, row = set(), len(a), len(b)
    while row and col:
        if rows[row - 1] >> (col - 1) & 1:
            col -= 1
        else:
            row -= 1
            if not row or rows[row - 1] >> (col - 1) & 1:
                col -= 1
                out.add(col)
    return out


def _parse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for page_id, url, host, path, html in zip(pdf["page_id"], pdf["url"], pdf["host"], pdf["path"], pdf["html"]):
            blocks, marked = page_blocks(html if isinstance(html, str) else None)
            keys = np.array([xxhash.xxh64_intdigest(b) for b in blocks], dtype=np.uint64).view(np.int64)
            out.append((None if pd.isna(page_id) else int(page_id), url if isinstance(url, str) else None, host, path, blocks, marked, keys))
        yield pd.DataFrame(out, columns=["page_id", "url", "host", "path", "blocks", "marked", "keys"]).astype({"page_id": "Int64"})


def _near(path: str, other: str | None) -> int:
    """Characters that a path shares with the start of another."""
    return len(os.path.commonprefix([path, other])) if isinstance(other, str) else -1


def shared_blocks(keys: list, sizes: list, marked: bool, before: list | None, after: list | None, nearer: bool = False) -> list[int]:
    """Indices of the blocks to delete, from the blocks of the classes around;
    ``nearer`` says that the url of the class after is the nearer one."""
    if not marked:
        return sorted(common_lines(keys, (after if nearer or before is None else before) or []))
    if before is None or after is None:
        return []
    found = []
    for other in (before, after):
        gone = common_lines(keys, other) if not set(keys).isdisjoint(other) else set()
        if not gone or 2 * sum(sizes[i] for i in gone) > sum(sizes) or 2 * len(gone) > len(other):
            return []
        found.append(gone)
    both, gone = found[0] & found[1], set()
    for i, step in ((0, 1), (len(keys) - 1, -1)):  # only what stands at an end of all three
        k = 0 if step > 0 else -1
        while i in both and keys[i] == before[k] == after[k]:
            gone.add(i)
            i, k = i + step, k + step
            if abs(k) >= min(len(before), len(after)):
                break
    return sorted(gone)


def _difference(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        around = [[None if x is None else x.tolist() for x in pdf[k]] for k in ("before", "after")]
        nearer = [_near(p, a) > _near(p, b) for p, b, a in zip(pdf["path"], pdf["path_before"], pdf["path_after"])]
        gone = [shared_blocks(k.tolist(), z.tolist(), *rest) for k, z, *rest in zip(pdf["keys"], pdf["sizes"], pdf["marked"], *around, nearer)]
        out = pd.DataFrame({"host": pdf["host"], "marked": pdf["marked"], "sig": pdf["sig"], "gone": gone,
                            "gone_keys": [k[g] for k, g in zip(pdf["keys"], gone)]})
        yield out[[bool(g) for g in gone]]


def paired(rows: DataFrame, group: int) -> tuple[DataFrame, DataFrame]:
    """The classes, and ``host, marked, sig, path, keys, sizes, before, after, path_before,
    path_after`` of every class of pages with equal blocks; ``before`` and
    ``after`` are the keys of its neighbours."""
    classes = rows.where(F.size("keys") > 0).groupBy("host", "marked", "sig").agg(
        F.min(F.struct("path", F.coalesce("url", F.lit("")).alias("url"))).alias("at"),
        F.any_value(F.struct("keys", F.transform("blocks", F.length).alias("sizes"))).alias("of"))
    classes = stored(classes.select("host", "marked", "sig", "at.path", "at.url", "of.keys", "of.sizes"), "classes")
    n = max(1, min(-(-classes.count() // group), int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    dealt = classes.repartitionByRange(n, "host", "marked", "path", "url", "sig").withColumn("deal", F.spark_partition_id())
    dealt = stored(dealt, "dealt")
    place = F.struct("path", "url", "sig", "keys")
    ends = dealt.groupBy("host", "marked", "deal").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    along = Window.partitionBy("host", "marked").orderBy("deal")
    of = F.struct("keys", "path")
    ends = ends.select("host", "marked", "deal", F.lag(F.struct("last.keys", "last.path")).over(along).alias("left"),
                       F.lead(F.struct("first.keys", "first.path")).over(along).alias("right"))
    near = Window.partitionBy("host", "marked", "deal").orderBy("path", "url", "sig")
    met = dealt.withColumns({"lag": F.lag(of).over(near), "lead": F.lead(of).over(near)}).join(ends, ["host", "marked", "deal"])
    before, after = F.coalesce("lag", "left"), F.coalesce("lead", "right")
    return dealt, met.select("host", "marked", "sig", "path", "keys", "sizes", before["keys"].alias("before"), after["keys"].alias("after"),
                      before["path"].alias("path_before"), after["path"].alias("path_after"))


def confirmed(found: DataFrame, articles: DataFrame) -> DataFrame:
    """Of the blocks found inside articles, those that more than half of the
    classes of the host hold, as ``host, marked, sig, gone``."""
    each = found.select("host", "marked", "sig", F.explode(F.arrays_zip("gone", "gone_keys")).alias("at")).select(
        "host", "marked", "sig", F.col("at.gone").alias("place"), F.col("at.gone_keys").alias("key"))
    lines = articles.select("host", F.explode(F.array_distinct("keys")).alias("key"))
    held = lines.join(each.select("host", "key").distinct(), ["host", "key"]).groupBy("host", "key").agg(F.count("*").alias("n"))
    total = articles.groupBy("host").agg(F.count("*").alias("total"))
    common = held.join(total, "host").where("2 * n > total").select("host", "key")
    return each.join(common, ["host", "key"]).groupBy("host", "marked", "sig").agg(F.collect_list("place").alias("gone"))


def extract(pages: DataFrame, group: int = GROUP) -> DataFrame:
    """``page_id, url, text, n_chars`` for every row of ``pages``."""
    rows = pages.select("page_id", "url", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"), "html").mapInPandas(
        _parse, "page_id long, url string, host string, path string, blocks array<string>, marked boolean, keys array<bigint>")
    rows = stored(rows.withColumn("sig", F.xxhash64("keys")), "blocks")
    classes, met = paired(rows, group)
    gone = stored(met.mapInPandas(_difference, "host string, marked boolean, sig long, gone array<int>, gone_keys array<bigint>"), "gone")
    gone = gone.where("NOT marked").drop("gone_keys").union(confirmed(gone.where("marked"), classes.where("marked")))
    gone = stored(gone, "gone")  # its own bytes decide how the pages meet it
    out = rows.join(gone, ["host", "marked", "sig"], "left")  # a hot class: rows on the left, which a skew join splits
    text = F.array_join(F.when(F.col("gone").isNull(), F.col("blocks")).otherwise(
        F.filter("blocks", lambda b, i: ~F.array_contains("gone", i))), "\n")
    return out.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))
