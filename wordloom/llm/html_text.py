"""Main text of web pages: what differs from the nearest page of the same host.

Pages of a host are ordered by URL path and each is compared to the neighbour that shares
the longest path with it. The longest common subsequence of their text lines is what
the site repeats, and is deleted, inside articles too. Copies of an article under two URLs
repeat the article as well: they are passed over, to the next page that is no copy. Lines that the
markup gives to menus, footers, adverts and the like go without being shared.
"""

from __future__ import annotations

import bisect
import re
from collections.abc import Iterator
from html import unescape
from os.path import commonprefix
from urllib.parse import urlsplit

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.llm.common import as_texts, pick, text_slices
from wordloom.operators.ranking import number_rows
from wordloom.session import stage

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([a-zA-Z][^\s/>]*)((?:[^'\">]++|\"[^\"]*+\"|'[^']*+')*+)>", re.DOTALL
)
ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
RAW = {name: re.compile(rf"</{name}[\s/>]", re.IGNORECASE) for name in ("script", "style", "textarea", "title", "xmp", "iframe", "noembed", "noframes")}
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter nobr q rp rt ruby s samp small span strike"
    " strong sub sup time tt u var wbr img".split()
)
#: Elements that are never main text.
DROPPED = frozenset(
    "head script style noscript template iframe object svg canvas nav header footer aside form button select textarea dialog menu".split()
)
#: Words of a class, id or role that say the same.
DROPPED_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner cookie cookies consent gdpr notice popup modal overlay newsletter"
    " subscribe subscription side sidebar aside nav navbar navigation menu breadcrumb breadcrumbs header masthead footer comment comments discussion disqus"
    " reply replies respond share sharing social related recommended widget toolbar pagination pager search login signup form contentinfo complementary"
    " dialog alert".split()
)
SAME_CLOSES = frozenset("p li dt dd tr td th option".split())
WORDS = re.compile("[a-z]+")
MAIN = frozenset(("article", "main"))


def is_dropped(name: str, attributes: str, in_main: bool) -> bool:
    """Whether an element holds no main text; a header inside an article is the article's own."""
    if name in DROPPED and not (name == "header" and in_main):
        return True
    if not attributes.strip() or name in ("html", "body"):
        return False
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        key, value = key.lower(), (a or b or c).lower()
        if key == "aria-hidden" and value == "true" or key == "style" and re.search(r"display\s*:\s*none", value):
            return True
        if key in ("class", "id", "role") and not DROPPED_WORDS.isdisjoint(WORDS.findall(value)):
            return not (key == "class" and name == "main")
    return bool(re.search(r"(?:^|\s)hidden(?:\s|=|/|$)", ATTRIBUTE.sub(" ", attributes)))


def page_lines(html: str) -> tuple[list[str], list[int]]:
    """Text blocks in page order and what the markup says of each: 0 dropped, 1 plain, 2 inside an article."""
    lines, kinds, current = [], [], []
    open_tags: list[tuple[str, bool, bool]] = []  # name, in a dropped element, in an article

    def close_block() -> None:
        if current:
            text = " ".join(unescape("".join(current)).split())
            current.clear()
            if text:
                _, gone, inside = open_tags[-1] if open_tags else ("", False, False)
                lines.append(text)
                kinds.append(0 if gone else 2 if inside else 1)

    def pop_to(place: int) -> None:
        close_block()
        del open_tags[place:]

    at = 0
    while at < len(html):
        token = TOKEN.search(html, at)
        if token is None:
            current.append(html[at:])
            break
        if token.start() > at:
            current.append(html[at : token.start()])
        at = token.end()
        if token[2] is None:
            continue
        name = token[2].lower()
        if token[1]:
            if name == "br" or name == "p" and not any(t[0] == "p" for t in open_tags):
                close_block()
            place = next((k for k in range(len(open_tags) - 1, -1, -1) if open_tags[k][0] == name), None)
            if place is not None:
                if name in INLINE and not open_tags[place][1] and all(t[0] in INLINE for t in open_tags[place:]):
                    del open_tags[place:]
                elif name not in INLINE or all(t[0] in INLINE for t in open_tags[place:]):
                    pop_to(place)
            continue
        attributes = token[3]
        if name not in INLINE:
            close_block()
        if name in RAW:
            end = RAW[name].search(html, at)
            at = len(html) if end is None else end.start()
            closing = html.find(">", at)
            at = len(html) if closing < 0 else closing + 1
            continue
        if name in VOID or attributes.endswith("/") and name in ("svg", "path"):
            continue
        if name == "body":
            pop_to(0)
        if name in SAME_CLOSES or name not in INLINE:
            closes = name if name in SAME_CLOSES else "p"
            for k in range(len(open_tags) - 1, -1, -1):
                if open_tags[k][0] == closes:
                    pop_to(k)
                    break
                if open_tags[k][0] not in INLINE:
                    break
        _, gone, inside = open_tags[-1] if open_tags else ("", False, False)
        dropped = is_dropped(name, attributes, inside)
        if dropped and not gone:
            close_block()
        open_tags.append((name, gone or dropped, inside or name in MAIN and not gone and not dropped))
    close_block()
    return lines, kinds


def judged(lines: list[str], kinds: list[int]) -> list[int]:
    """The kinds, once it is known which part is the main one: beside articles with half of the text or more, plain lines
    go (0); articles with less are cards beside the text, and all that is not dropped is plain (1)."""
    size = [0, 0, 0]
    for x, kind in zip(lines, kinds, strict=True):
        size[kind] += len(x)
    if size[2] and size[2] >= size[1]:
        return [kind if kind == 2 else 0 for kind in kinds]
    return [min(kind, 1) for kind in kinds]


def line_keys(lines: list[str], kinds: list[int]) -> list[int]:
    """For each line, in one number: 52 bits of its hash, its length (1,023 at most) and its kind, which comes last."""
    return [
        ((xxhash.xxh3_64_intdigest(x.encode("utf-8", "surrogatepass")) >> 12 << 12) | min(len(x), 1023) << 2 | kind) - (1 << 63)
        for x, kind in zip(lines, kinds, strict=True)
    ]


def same_lines(keys: list[int]) -> list[int]:
    """The keys without the kinds: a line is the same wherever the markup puts it."""
    return [k >> 2 for k in keys]


def lcs_lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of all of a with each prefix of b, by bit-parallel rows."""
    masks: dict[int, int] = {}
    for j, x in enumerate(b):
        masks[x] = masks.get(x, 0) | (1 << j)
    full = (1 << len(b)) - 1
    row = full
    for x in a:
        both = row & masks.get(x, 0)
        row = ((row + both) | (row - both)) & full
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.r_[0, np.cumsum(1 - bits.astype(np.int64))]


def common(a: list[int], b: list[int], most_pairs: int = 1 << 20) -> list[int]:
    """Positions in a of a longest common subsequence with b; memory stays linear however often lines repeat."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    head, tail = list(range(start)), list(range(len(a) - end, len(a)))
    mid_a, mid_b = a[start : len(a) - end], b[start : len(b) - end]
    places: dict[int, list[int]] = {}
    for j in range(len(mid_b) - 1, -1, -1):
        places.setdefault(mid_b[j], []).append(j)
    mine = [i for i, x in enumerate(mid_a) if x in places]
    if not mine:
        return head + tail
    if sum(len(places[mid_a[i]]) for i in mine) <= most_pairs:
        ends: list[int] = []
        links: list[tuple[int, object]] = []
        for i in mine:
            for j in places[mid_a[i]]:
                k = bisect.bisect_left(ends, j)
                link = (i, links[k - 1] if k else None)
                if k == len(ends):
                    ends.append(j)
                    links.append(link)
                else:
                    ends[k], links[k] = j, link
        found, link = [], links[-1]
        while link is not None:
            found.append(link[0])
            link = link[1]
        return head + [start + i for i in reversed(found)] + tail
    half = len(mid_a) // 2
    if half == 0:
        return head + [start] + tail
    left = lcs_lengths(mid_a[:half], mid_b)
    right = lcs_lengths(mid_a[half:][::-1], mid_b[::-1])[::-1]
    cut = int((left + right).argmax())
    first, second = common(mid_a[:half], mid_b[:cut]), common(mid_a[half:], mid_b[cut:])
    return head + [start + i for i in first] + [start + half + i for i in second] + tail


def split_url(url: str | None) -> tuple[str, str]:
    """Host in lower case and path with query; what is no URL is all path."""
    try:
        parts = urlsplit(url or "")
        return (parts.hostname or "").lower(), parts.path + ("?" + parts.query if parts.query else "")
    except ValueError:
        return "", url or ""


def is_copy(a: list[int], b: list[int]) -> bool:
    """Whether two pages have the same article: of the smaller one half the letters or more; without articles, all lines."""
    mine, other = ([k >> 2 for k in keys if k & 3 == 2] for keys in (a, b))
    if not mine or not other:
        return same_lines(a) == same_lines(b)
    size = lambda keys: sum([k & 1023 for k in keys])
    return 2 * size([mine[i] for i in common(mine, other)]) >= min(size(mine), size(other))


def shared_lines(keys: list[int], path: str, before, after) -> tuple[list[int], bool, bool]:
    """Lines in common with the neighbour nearest by path that is no copy of the page, and which of the two is a copy."""
    copies = [before[0] is not None and is_copy(before[1], keys), after[0] is not None and is_copy(keys, after[1])]
    sides = [(len(commonprefix([path, p])), k) for (p, k), copy in zip((before, after), copies, strict=True) if p is not None and not copy]
    shared = common(same_lines(keys), same_lines(max(sides, key=lambda s: s[0])[1])) if sides else []
    return shared, *copies


def list_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in text_slices(batches, "html"):
        out = {n: [] for n in ("host", "path", "keys")}
        for url, html in zip(chunk.column("url").to_pylist(), as_texts(chunk.column("html")), strict=True):
            host, path = split_url(url)
            out["host"].append(host)
            out["path"].append(path)
            lines, kinds = page_lines(html)
            out["keys"].append(line_keys(lines, judged(lines, kinds)))
        yield pa.RecordBatch.from_arrays(
            [chunk.column("page"), pa.array(out["host"], pa.string()), pa.array(out["path"], pa.string()), pa.array(out["keys"], pa.list_(pa.int64()))],
            names=["page", "host", "path", "keys"],
        )


def compare_pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = batch.to_pylist()
        found = [shared_lines(r["keys"], r["path"], (r["path_before"], r["keys_before"]), (r["path_after"], r["keys_after"])) for r in rows]
        shared, before, after = zip(*found, strict=True) if found else ((), (), ())
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(c) for c in ("page", "host", "place")), pa.array(shared, pa.list_(pa.int32())), pa.array(before, pa.bool_()), pa.array(after, pa.bool_())],
            names=["page", "host", "place", "shared", "copy_before", "copy_after"],
        )


def main_lines(lines: list[str], kinds: list[int]) -> tuple[list[str], list[int]]:
    """What the markup leaves, with the places of the lines: the articles if they are the main part, else all not dropped."""
    places = [i for i, kind in enumerate(judged(lines, kinds)) if kind]
    return [lines[i] for i in places], places


def main_text(lines: list[str], places: list[int], shared: list[int]) -> str:
    """The lines that the nearest page does not have at the same turn."""
    gone = set(shared)
    return " ".join([x for x, place in zip(lines, places, strict=True) if place not in gone])


def split_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for chunk in text_slices(batches, "html"):
        found = [main_lines(*page_lines(html)) for html in as_texts(chunk.column("html"))]
        yield pa.RecordBatch.from_arrays(
            [
                chunk.column("page_id"), chunk.column("url"), chunk.column("page"),
                pa.array([x for x, _ in found], pa.list_(pa.string())), pa.array([x for _, x in found], pa.list_(pa.int32())),
            ],
            names=["page_id", "url", "page", "lines", "places"],
        )


def join_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("lines", "places", "shared")]
        texts = [main_text(lines, places, shared or []) for lines, places, shared in zip(*columns, strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
            names=["page_id", "url", "text", "n_chars"],
        )


def copy_runs(compared: DataFrame) -> DataFrame:
    """(host, place, first, last): pages next to a copy of theirs, with the ends of the run of copies that they stand in.

    The n-th page without a copy before it and the n-th without one after it are the ends of one run; no run goes through a window.
    """
    held = compared.filter("copy_before or copy_after")
    first = number_rows(held.filter("not copy_before").select("host", F.col("place").alias("first")), ["host"], [F.asc("first")], "run")
    last = number_rows(held.filter("not copy_after").select("host", F.col("place").alias("last")), ["host"], [F.asc("last")], "run")
    return first.join(last, ["host", "run"]).select("host", F.explode(F.sequence("first", "last")).alias("place"), "first", "last")


def extract_text(pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text, n_chars of every page.

    Null and empty html give empty text; a null or broken url belongs to the host ''; equal pages (url and html)
    get equal text; a page alone on its host, or with copies of it alone, has nothing shared; an empty
    table gives no rows.
    """
    rows = pick(pages, id, url, html).toDF("page_id", "url", "html").withColumn("page", F.xxhash64(F.coalesce("url", F.lit("")), F.coalesce("html", F.lit(""))))
    listed = rows.select("page", "url", "html").mapInArrow(list_lines, "page long, host string, path string, keys array<long>")
    placed = stage(number_rows(stage(listed.dropDuplicates(["page"]), "page_lines"), ["host"], [F.asc("path"), F.asc("page")], "place"), "page_places")

    def beside(before, after, own: DataFrame = placed) -> DataFrame:
        """``own`` pages compared with those at two places of their hosts."""
        for name, place in (("before", before), ("after", after)):
            other = placed.select("host", F.col("place").alias(f"at_{name}"), F.col("path").alias(f"path_{name}"), F.col("keys").alias(f"keys_{name}"))
            own = own.withColumn(f"at_{name}", place).join(other, ["host", f"at_{name}"], "left")
        met = own.select("page", "host", "place", "path", "keys", "path_before", "keys_before", "path_after", "keys_after")
        return met.mapInArrow(compare_pages, "page long, host string, place long, shared array<int>, copy_before boolean, copy_after boolean")

    compared = stage(beside(F.col("place") - 1, F.col("place") + 1), "page_compared")
    runs = stage(copy_runs(compared), "page_copies")
    further = beside(F.col("first") - 1, F.col("last") + 1, placed.join(runs, ["host", "place"])).select("page", "shared")
    shared = stage(compared.filter("not (copy_before or copy_after)").select("page", "shared").unionByName(further).filter(F.size("shared") > 0), "page_shared")
    kind = rows.schema["page_id"].dataType.simpleString()
    left = rows.mapInArrow(split_batches, f"page_id {kind}, url string, page long, lines array<string>, places array<int>")
    return left.join(shared, "page", "left").select("page_id", "url", "lines", "places", "shared").mapInArrow(
        join_batches, f"page_id {kind}, url string, text string, n_chars long"
    )
