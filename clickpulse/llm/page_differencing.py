"""Main text of pages by differencing with the page of the nearest URL.

Pages of a host are ordered by path; a page is compared with the neighbour that shares
the longer beginning of its path. Lines that a longest common subsequence of the two
aligns are the site's own and go, unless they stand in an article element.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections.abc import Iterator
from os.path import commonprefix

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.frames import Input
from clickpulse.llm.html_lines import ARTICLE, page_lines
from clickpulse.llm.urls import split_url

#: Bytes of HTML per range of pages, on average.
RANGE_BYTES = 32 << 20
#: A neighbour that shares more of a page's text is a copy of it and tells nothing.
COPY_SHARE = 0.8
#: Cells of a table of bit rows that is kept whole; larger ones are cut in halves.
_CELLS = 1 << 28


def _length_rows(a: list, b: list) -> Iterator[int]:
    """After each line of a, bits of b's prefixes; a zero where the common length grows."""
    at: dict = {}
    for j, line in enumerate(b):
        at[line] = at.get(line, 0) | 1 << j
    row = full = (1 << len(b)) - 1
    for line in a:
        both = row & at.get(line, 0)
        row = ((row + both) | (row - both)) & full
        yield row


def _lengths(a: list, b: list) -> list[int]:
    row = (1 << len(b)) - 1
    for row in _length_rows(a, b):  # noqa: B007
        pass
    out, n = [0], 0
    for bit in bin(row | 1 << len(b))[:2:-1]:
        n += bit == "0"
        out.append(n)
    return out


def shared_lines(a: list, b: list) -> list[int]:
    """Places in a that a longest common subsequence with b aligns."""
    start = 0
    while start < min(len(a), len(b)) and a[start] == b[start]:
        start += 1
    end = 0
    while end < min(len(a), len(b)) - start and a[-1 - end] == b[-1 - end]:
        end += 1
    edges = [*range(start), *range(len(a) - end, len(a))]
    common = set(a[start : len(a) - end]) & set(b[start : len(b) - end])
    where = [i for i in range(start, len(a) - end) if a[i] in common]
    if not where:
        return sorted(edges)
    x = [a[i] for i in where]
    y = [line for line in b[start : len(b) - end] if line in common]
    if len(x) * len(y) > _CELLS and len(x) > 1:
        half = len(x) // 2
        left = _lengths(x[:half], y)
        right = _lengths(x[:half - 1 : -1], y[::-1])[::-1]
        cut = max(range(len(y) + 1), key=lambda j: left[j] + right[j])
        found = shared_lines(x[:half], y[:cut])
        found += [half + i for i in shared_lines(x[half:], y[cut:])]
        return sorted(edges + [where[i] for i in found])
    rows = list(_length_rows(x, y))
    j = len(y) - 1
    for i in range(len(x) - 1, -1, -1):
        above = rows[i - 1] if i else (1 << len(y)) - 1
        # Skip back over lines of b that add nothing to the common length.
        while j >= 0 and rows[i] >> j & 1:
            j -= 1
        if j < 0:
            break
        if above >> j & 1:
            edges.append(where[i])
            j -= 1
    return sorted(edges)


def main_text(lines: list[tuple[str, int]], mates: list[list[str]]) -> str:
    """The lines that a mate does not share, and all lines of an article element.

    The first mate that is no copy decides. Within an article element, lines that two pages
    share are passages and stay. A mate that shares most of a page, and most of its article
    element if it has one, is a copy. If all mates are copies every line stays; without
    mates an article element's lines do, or every line where there is none.
    """
    text = [line for line, _ in lines]
    article = {i for i, (_, part) in enumerate(lines) if part == ARTICLE}

    def most(shared: set[int], of: set[int]) -> bool:
        size = sum(len(text[i]) for i in of)
        return sum(len(text[i]) for i in shared & of) > COPY_SHARE * size

    kept = article if article and not mates else set(range(len(text)))
    for mate in mates:
        shared = set(shared_lines(text, mate))
        if not (most(shared, kept) and (not article or most(shared, article))):
            kept = kept - shared | article
            break
    return "\n".join(text[i] for i in sorted(kept))


def _ranges(keys: DataFrame, parts: int) -> list:
    """The first and last key of each range of the ordered keys."""
    ordered = keys.repartitionByRange(parts, "host", "path", "tie")
    key = F.struct("host", "path", "tie")
    ends = ordered.groupBy(F.spark_partition_id().alias("part")).agg(
        F.min(key).alias("first"), F.max(key).alias("last")
    )
    return [(tuple(r["first"]), tuple(r["last"])) for r in ends.orderBy("first").collect()]


def _reader(ranges):
    """Parse pages and deal them to ranges; the page next to a range goes there as well."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = [first for first, _ in ranges.value]
        lasts = [last for _, last in ranges.value]
        for batch in batches:
            out: list[dict] = []
            for row in batch.to_pylist():
                key = (row["host"], row["path"], row["tie"])
                lines = page_lines(row.pop("html") or "")
                row["lines"] = [line for line, _ in lines]
                row["parts"] = bytes(part for _, part in lines)
                at = max(0, bisect_right(firsts, key) - 1)
                out.append(row | {"range": at, "guest": False})
                guest = row | {"guest": True}
                if at and firsts[at] == key:
                    out.append(guest | {"range": at - 1})
                if at + 1 < len(lasts) and lasts[at] == key:
                    out.append(guest | {"range": at + 1})
            yield from pa.Table.from_pylist(out, _schema(batch.schema)).to_batches()

    return read


def _schema(given: pa.Schema) -> pa.Schema:
    extra = [
        ("lines", pa.list_(pa.string())),
        ("parts", pa.binary()),
        ("range", pa.int32()),
        ("guest", pa.bool_()),
    ]
    return pa.schema([f for f in given if f.name != "html"] + [pa.field(*x) for x in extra])


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in the order of ranges, hosts and paths; equal neighbours are one page."""
    schema = None

    def runs() -> Iterator[list[dict]]:
        run: list[dict] = []
        for batch in batches:
            nonlocal schema
            schema = batch.schema
            for row in batch.to_pylist():
                same = ("range", "host", "lines", "parts")
                if run and any(run[0][c] != row[c] for c in same):
                    yield run
                    run = []
                run.append(row)
        if run:
            yield run

    def finish(before: list[dict], run: list[dict], after: list[dict]) -> list[dict]:
        page = run[0]
        near = []
        for other in (after[:1], before[-1:]):
            if other and all(other[0][c] == page[c] for c in ("range", "host")):
                near.append((len(commonprefix([other[0]["path"], page["path"]])), other[0]))
        near.sort(key=lambda x: -x[0])
        lines = list(zip(page["lines"], page["parts"], strict=True))
        text = main_text(lines, [m["lines"] for _, m in near if m["lines"]])
        return [row | {"text": text} for row in run if not row["guest"]]

    def results() -> Iterator[dict]:
        before: list[dict] = []
        run: list[dict] = []
        for after in runs():
            if run:
                yield from finish(before, run, after)
            before, run = run, after
        if run:
            yield from finish(before, run, [])

    held: list[dict] = []
    columns = ("id", "url", "text")

    def batch_of() -> pa.RecordBatch:
        kinds = [schema.field("id").type, schema.field("url").type, pa.string()]
        arrays = [pa.array([r[c] for r in held], k) for c, k in zip(columns, kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=list(columns))

    for row in results():
        held.append(row)
        if len(held) == 1000:
            yield batch_of()
            held = []
    if held:
        yield batch_of()


def extract_pages(
    pages: DataFrame, id: str = "page_id", url: str = "url", html: str = "html"
) -> DataFrame:
    """Returns one row per page: its id, url, text and n_chars (code points of the text).

    A null or empty page has an empty text. A null URL, or one without ://, belongs to the
    empty host. Pages with the same lines count as one when neighbours are compared, and
    repeated rows all stay. Pages of equal paths are ordered by a hash of URL and HTML, so
    neighbours do not hang on how the rows are dealt out. Other columns are not read. An
    empty table gives an empty table.
    """
    given = Input(pages)
    host, path = split_url(given[url])
    tie = F.xxhash64(given[url], given[html])
    keyed = given.frame.select(
        given[id].alias("id"),
        given[url].alias("url"),
        given[html].alias("html"),
        host.alias("host"),
        path.alias("path"),
        tie.alias("tie"),
    )
    size = keyed.agg(F.sum(F.octet_length("html"))).head()[0] or 0
    parts = max(1, math.ceil(size / RANGE_BYTES))
    ends = _ranges(keyed.select("host", "path", "tie"), parts)
    ranges = pages.sparkSession.sparkContext.broadcast(ends)
    kinds = {f.name: f.dataType.simpleString() for f in keyed.schema}
    shape = ", ".join(f"{c} {kinds[c]}" for c in ("id", "url", "host", "path", "tie"))
    read = keyed.mapInArrow(
        _reader(ranges), f"{shape}, lines array<string>, parts binary, range int, guest boolean"
    )
    dealt = read.repartition(max(1, len(ends)), "range").sortWithinPartitions(
        "range", "host", "path", "tie"
    )
    shape = f"id {kinds['id']}, url {kinds['url']}, text string"
    found = dealt.mapInArrow(_compare, shape)
    return found.select(
        F.col("id").alias(id),
        F.col("url").alias(url),
        "text",
        F.length("text").cast("long").alias("n_chars"),
    )
