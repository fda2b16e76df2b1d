"""Benchmark decontamination with an FM-index per shard of training texts.

A task cuts its texts into shards of a bounded number of words, indexes each, searches all
phrases of the benchmark backwards, locates their occurrences and merges them into spans
of words. Texts are never shuffled; benchmark texts go to the tasks in blocks of bounded
size, one pass over the texts for each block.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.fm_index import FMIndex
from clickpulse.llm.frames import Input, tidy

WINDOW = 10
#: Words that one index holds; a longer text is a shard by itself.
SHARD_WORDS = 1 << 18
#: Bytes of benchmark text in one block, on average.
BLOCK_BYTES = 8 << 20

_KEPT = set(b"0123456789abcdefghijklmnopqrstuvwxyz") | set(range(0x80, 0x100))
_PLAIN = bytes(c if c in _KEPT else 0x20 for c in bytes(range(256)).lower())

_WORD = re.compile(rb"[0-9A-Za-z\x80-\xff]+")

_SPANS = "array<struct<start:bigint,end:bigint>>"
_FOUND = f"struct<n_words:bigint,spans:{_SPANS},items:array<string>>"


def plain_words(text: bytes) -> list[bytes]:
    """Lower-cased (A-Z) runs of ASCII letters, digits and characters beyond ASCII."""
    return text.translate(_PLAIN).split()


#: The words of a block of items, and its windows by length: an array with one window per
#: line, as numbers of words, and the items of each.
Phrases = tuple[list[bytes], list[tuple[np.ndarray, list[list[str]]]]]


def phrases_of(items: list[tuple[str | None, str]], window: int) -> Phrases:
    number: dict[bytes, int] = defaultdict(count().__next__)
    owners: dict[tuple[int, ...], set[str]] = defaultdict(set)
    for item, text in items:
        ids = [number[w] for w in plain_words(text.encode())]
        for i in range(max(1, len(ids) - window + 1) if ids else 0):
            owners[tuple(ids[i : i + window])] |= {item} - {None}
    by_length: dict[int, list[tuple[int, ...]]] = defaultdict(list)
    for phrase in owners:
        by_length[len(phrase)].append(phrase)
    groups = [
        (np.array(phrases, np.int64), [sorted(owners[p]) for p in phrases])
        for phrases in by_length.values()
    ]
    return list(number), groups


def _occurrences(
    phrases: Phrases, texts: list[list[bytes]]
) -> tuple[np.ndarray, list[set[str]]]:
    """For a shard, which of its words are hit (an end after each text), and items per text."""
    vocabulary, groups = phrases
    number: dict[bytes, int] = defaultdict(count(1).__next__)
    number[b""] = 0  # no word; ends a text
    flat = [number[w] for words in texts for w in (*words, b"")]
    symbols = np.array(flat, np.int64)
    size = len(number)
    translate = np.array([number.get(w, -1) for w in vocabulary], np.int64)
    edge = np.zeros(len(symbols) + 1, np.int64)
    items: list[set[str]] = [set() for _ in texts]
    ends = np.flatnonzero(symbols == 0)
    index = None
    for group, owners in groups:
        wanted = translate[group]
        known = np.flatnonzero((wanted >= 0).all(axis=1))
        if not len(known):
            continue
        index = index or FMIndex(symbols, size)
        low, high = index.search(wanted[known])
        n = high - low
        rows = np.repeat(low - np.append(0, np.cumsum(n)[:-1]), n) + np.arange(n.sum())
        at = index.locate(rows)
        np.add.at(edge, at, 1)
        np.add.at(edge, at + group.shape[1], -1)
        phrase = np.repeat(known, n)
        text = np.searchsorted(ends, at)
        for pair in np.unique(text * len(owners) + phrase).tolist():
            items[pair // len(owners)].update(owners[pair % len(owners)])
    return np.cumsum(edge[:-1]) > 0, items


def _spans(hit: np.ndarray) -> list[tuple[int, int]]:
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
    return [(int(a), int(b)) for a, b in edges.reshape(-1, 2)]


def _merged(a: list[tuple[int, int]], b: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, end in sorted([*a, *b]):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _search_texts(phrases: Phrases, texts: list[bytes | None], shard_words: int) -> Iterator[dict]:
    """Words, spans and items of each text, shard by shard."""

    def searched(shard: list[list[bytes]]) -> Iterator[dict]:
        hit, items = _occurrences(phrases, shard)
        start = 0
        for words, found in zip(shard, items, strict=True):
            mine = hit[start : start + len(words)]
            spans = _spans(mine) if mine.any() else []
            yield {"n_words": len(words), "spans": spans, "items": sorted(found)}
            start += len(words) + 1

    shard: list[list[bytes]] = []
    held = 0
    for text in texts:
        words = plain_words(text or b"")
        if shard and held + len(words) > shard_words:
            yield from searched(shard)
            shard, held = [], 0
        shard.append(words)
        held += len(words) + 1
    if shard:
        yield from searched(shard)


def _finder(phrases, shard_words: int):
    kind = pa.struct(
        [
            ("n_words", pa.int64()),
            ("spans", pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
            ("items", pa.list_(pa.string())),
        ]
    )

    def find(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        block = phrases.value
        for text, earlier in batches:
            rows = []
            texts = text.cast(pa.binary()).to_pylist()
            found = _search_texts(block, texts, shard_words)
            for row, old in zip(found, earlier.to_pylist(), strict=True):
                if old and old["spans"]:
                    past = [(s["start"], s["end"]) for s in old["spans"]]
                    row["spans"] = _merged(past, row["spans"])
                    row["items"] = sorted({*old["items"], *row["items"]})
                row["spans"] = [{"start": a, "end": b} for a, b in row["spans"]]
                rows.append(row)
            yield pa.array(rows, kind)

    def tidied(batches: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        yield from tidy(find)(batches)

    return F.arrow_udf(tidied, _FOUND)


def find_passages(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = WINDOW,
    shard_words: int = SHARD_WORDS,
    block_bytes: int = BLOCK_BYTES,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Find every occurrence of every benchmark window in every text.

    A window is `window` words in a row of an item; an item of fewer words, but not none,
    is one window. Adds n_words, spans (merged word ranges, end excluded, that occurrences
    cover), n_hit (words in them) and items (ids with an occurring window, as sorted
    strings). Null and empty texts have no words; an item with a null id is searched for as
    well, but not listed; one with a null text is none; repeated items count once; an empty
    benchmark hits nothing; an empty table gives an empty table. Rows are judged one by one,
    so repeated rows get the same result. A result column replaces an input column of its name.
    """
    context = docs.sparkSession.sparkContext
    own = Input(benchmark)
    known = own.frame.select(own[item].cast("string").alias("item"), own[item_text].alias("text"))
    known = known.where("text IS NOT NULL")
    size = known.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    blocks = max(1, math.ceil(size / block_bytes))
    given = Input(docs)
    df = given.frame.withColumn("found", F.lit(None).cast(_FOUND))
    for n in range(blocks):
        rows = known.where(F.pmod(F.xxhash64("item", "text"), F.lit(blocks)) == n).collect()
        phrases = context.broadcast(phrases_of([(r.item, r.text) for r in rows], window))
        df = df.withColumn("found", _finder(phrases, shard_words)(given[text], F.col("found")))
    total = lambda a, s: a + s["end"] - s["start"]
    return given.results(
        df,
        {
            "n_words": F.col("found.n_words"),
            "spans": F.col("found.spans"),
            "n_hit": F.aggregate("found.spans", F.lit(0).cast("long"), total),
            "items": F.col("found.items"),
        },
    )


def cut_passages(text: Column, spans: Column) -> Column:
    """The text without the words in the spans and what stands between them.

    What is left on both sides of a cut is joined by a line feed. Null stays null.
    """
    def cut(texts: pa.Array, ranges: pa.Array) -> pa.Array:
        out = []
        for text, spans in zip(texts.to_pylist(), ranges.to_pylist(), strict=True):
            if text is not None and spans:
                data = text.encode()
                at = [m.span() for m in _WORD.finditer(data)]
                pieces, start = [], 0
                for s in spans:
                    pieces.append(data[start : at[s["start"]][0]])
                    start = at[s["end"] - 1][1]
                text = b"\n".join([*pieces, data[start:]]).decode()
            out.append(text)
        return pa.array(out, pa.string())

    udf = F.arrow_udf(cut, "string")
    return F.when(F.size(spans) > 0, udf(text, spans)).otherwise(text)
