"""Alignment of two tokenizers on the same texts.

Both tokenizers end tokens at byte offsets of a text. The shorter list of ends is sought
in the longer one by galloping: from a guess the step doubles until the place is between
two probes, and halves to it from there. Ends found in both lists cut the tokens into
groups; the ranks of two ends that follow each other bound the tokens of the other side
that a token overlaps.

Texts are tokenized once and their ids written to the shared folder. Over the corpus the
links of every pair of ids are counted. Documents look the counts of their pairs up: frequent pairs, of which there can be only so many, in every task, the
other ones by a join in which no pair is hot.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from clickpulse.llm.frames import Input, durable
from clickpulse.llm.pretokens import MARKS, load_model, piece_ids, uncut_ends
from clickpulse.storage import run_dir

#: At most so many pairs are sent to every task: those with this share of all links.
COMMON = 1 << 20

#: Bytes of texts or ids that are worked on at once, parts of texts whose ids are kept, and
#: words that are tokenized in a row.
_BYTES, _PARTS, _ROW = 1 << 20, 1 << 19, 1000
#: Bytes, as a power of two, in a step of offsets whose ends are counted to guess ranks.
_STEP = 1
#: More than a vocabulary has ids; a pair of ids is one number.
_IDS = 1 << 31
#: A word of Latin letters and its marks: both tokenizers end a token between them.
_WORD = re.compile(rf"([A-Za-zÀ-ÖØ-öø-ʯ]+)([{re.escape(MARKS)}]*)")
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")
#: What a text may have that is not cut at each of its spaces.
_LOOSE = re.compile(r"\s\s|^\s|\s\Z")

#: What a text's own row has: counts, sums over common pairs, and a hash in four numbers.
_COUNTS = ["n_a", "n_b", "n_groups", "n_links"]
_SHA = ["sha0", "sha1", "sha2", "sha3"]
_OWN = ", ".join(f"{name}: bigint" for name in [*_COUNTS, "best", "total", *_SHA])


def align_tokens(
    docs: DataFrame,
    a_path: str,
    b_path: str,
    common: int = COMMON,
    with_groups: bool = False,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of docs: its id and how the tokens of A and B lie to each other.

    A is a byte-level BPE of the tokenizers library, which gets a space and the text; B a
    sentencepiece model, which adds the space itself. n_a and n_b count tokens, n_groups
    the spans between ends of both, n_links the pairs of tokens that overlap. The count
    of a pair of ids is the number of its links in all rows; count_sum adds up the counts
    of a row's links, and n_best says how many of them have the highest count of their B
    id. groups_sha256 is the SHA-256, in hex, of the groups' ids as "a1,a2|b1;a3|b2"; this
    text itself is returned as `groups` if asked for.

    Texts that are null or empty, or that one tokenizer does not give back byte by byte,
    have no tokens: zeros and ''. Repeated rows, also of a null id, count
    each time and give a row each. Other columns are not returned. An empty table
    gives an empty table.
    """
    given = Input(docs)
    body = given.frame.select(given[id].alias("id"), given[text].alias("text"))
    if any(end.isalpha() for end in uncut_ends(load_model(b_path))):
        raise ValueError("words of B must end before marks")
    spark = body.sparkSession
    kind = body.schema["id"].dataType.simpleString()
    vocabularies = spark.sparkContext.broadcast(Vocabularies.read(a_path, b_path))
    folder = run_dir(spark, "alignment")
    tokenized = body.mapInArrow(
        lambda batches: _tokenized(batches, a_path, b_path, vocabularies),
        f"id {kind}, digest binary, a binary, b binary",
    )
    tokenized.write.option("compression", "zstd").parquet(folder)
    tokenized = spark.read.schema(tokenized.schema).parquet(folder)
    counts = _pair_counts(tokenized.select("a", "b"), vocabularies)
    known = spark.sparkContext.broadcast(_common(counts, common))
    rows = tokenized.mapInArrow(
        lambda batches: _rows(batches, vocabularies, known, with_groups),
        f"id {kind}, digest binary, own struct<{_OWN}, groups: string>, pair bigint, n bigint",
    )
    valued = rows.join(counts, "pair", "left").select(
        "id",
        "digest",
        "own.*",
        F.coalesce(F.col("n") * F.col("links"), F.lit(0)).alias("more"),
        F.when(F.col("is_best"), F.col("n")).otherwise(0).alias("more_best"),
    )
    single = [*_COUNTS, *_SHA, *(["groups"] if with_groups else [])]
    sums = valued.groupBy("id", "digest").agg(
        F.count("n_a").alias("copies"),
        *(F.max(name).alias(name) for name in single),
        (F.coalesce(F.sum("best"), F.lit(0)) + F.sum("more_best")).alias("best"),
        (F.coalesce(F.sum("total"), F.lit(0)) + F.sum("more")).alias("total"),
    )
    # Equal texts under one id were summed; the row of each comes back.
    sha = F.lower(F.concat(*(F.lpad(F.hex(name), 16, "0") for name in _SHA)))
    result = {
        **{name: F.col(name) for name in _COUNTS},
        "n_best": F.expr("best div copies"),
        "count_sum": F.expr("total div copies"),
        "groups_sha256": F.when(F.col("n_a") > 0, sha).otherwise(""),
    }
    if with_groups:
        result["groups"] = F.col("groups")
    each = sums.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies")))
    return each.select(F.col("id").alias(id), *(c.alias(name) for name, c in result.items()))


def gallop(keys: np.ndarray, table: np.ndarray, guess: np.ndarray) -> np.ndarray:
    """For each key the number of smaller entries of the sorted table.

    Starts at the guesses, which only cost time if they are wrong. All keys gallop at
    once: first in steps 1, 2, 4, ... until the rank lies in [low, high], then by halves.
    """
    size = len(table)
    low, high = np.zeros(len(keys), np.int64), np.full(len(keys), size)
    up = table[guess] < keys
    low[up], high[~up] = guess[up] + 1, guess[~up]
    for right in (True, False):
        left, step = np.flatnonzero(up == right), 1
        while len(left):
            if right:
                probe = np.minimum(low[left] + step - 1, size)
                inside = probe < size
            else:
                probe = np.maximum(high[left] - step, -1)
                inside = probe >= 0
            left, probe = left[inside], probe[inside]
            smaller = table[probe] < keys[left]
            low[left[smaller]] = probe[smaller] + 1
            high[left[~smaller]] = probe[~smaller]
            left = left[smaller == right]
            step *= 2
    open_ = np.flatnonzero(low < high)
    while len(open_):
        middle = (low[open_] + high[open_]) // 2
        smaller = table[middle] < keys[open_]
        low[open_[smaller]] = middle[smaller] + 1
        high[open_[~smaller]] = middle[~smaller]
        open_ = open_[low[open_] < high[open_]]
    return low


def _guess(keys: np.ndarray, table: np.ndarray) -> np.ndarray:
    """Where to start galloping: behind the entries of all steps of bytes before a key's own."""
    before = np.append(0, np.cumsum(np.bincount(table >> _STEP, minlength=(keys[-1] >> _STEP) + 1)))
    return np.minimum(before[keys >> _STEP], len(table) - 1)


@dataclass(frozen=True)
class Overlap:
    """How two lists of tokens over the same bytes lie to each other.

    Token i of the driving list overlaps tokens first[i] to last[i] of the other; `common`
    marks the driving tokens that end where a token of the other, last[i], ends.
    """

    first: np.ndarray
    last: np.ndarray
    common: np.ndarray


def overlaps(driving: np.ndarray, other: np.ndarray, guess: np.ndarray) -> Overlap:
    """Overlaps from the ends of both lists, which end together."""
    last = gallop(driving, other, guess)
    common = other[last] == driving
    first = np.zeros(len(last), np.int64)
    # A token starts where the one before it ends: on an end of both, behind its token.
    first[1:] = last[:-1] + common[:-1]
    return Overlap(first, last, common)


@dataclass(frozen=True)
class Vocabularies:
    """The bytes of the tokens of A and of B."""

    bytes: tuple[list[bytes], list[bytes]]

    @classmethod
    def read(cls, a_path: str, b_path: str) -> Vocabularies:
        return cls((_a_bytes(Tokenizer.from_file(a_path)), _b_bytes(load_model(b_path))))

    @property
    def kinds(self) -> tuple[np.dtype, ...]:
        """The types in which ids are written."""
        return tuple(np.dtype("<u2" if len(table) <= 1 << 16 else "<u4") for table in self.bytes)

    @property
    def sizes(self) -> tuple[np.ndarray, ...]:
        return tuple(np.array([len(t) for t in table], np.int64) for table in self.bytes)

    @property
    def names(self) -> list[str]:
        """Ids as text behind what separates them: a group, another id, or the other side."""
        marks = (";,", "|,")
        return [f"{m}{n}" for s in (0, 1) for m in marks[s] for n in range(len(self.bytes[s]))]


@dataclass(frozen=True)
class Sides:
    """The tokens of some texts: ids of A and of B, text by text, and how many each text has."""

    ids: tuple[np.ndarray, np.ndarray]
    counts: tuple[np.ndarray, np.ndarray]

    def written(self, kinds: tuple[np.dtype, ...]) -> list[pa.Array]:
        """The ids of each text as bytes."""
        columns = []
        for ids, counts, kind in zip(self.ids, self.counts, kinds):
            ends = np.append(0, np.cumsum(counts)).astype(np.int32) * kind.itemsize
            buffers = [None, pa.py_buffer(ends), pa.py_buffer(ids.astype(kind))]
            columns.append(pa.Array.from_buffers(pa.binary(), len(counts), buffers))
        return columns

    @classmethod
    def read(cls, columns: list[pa.Array], kinds: tuple[np.dtype, ...]) -> Sides:
        rows = [column.to_pylist() for column in columns]
        ids = (np.frombuffer(b"".join(r), kind).astype(np.int64) for r, kind in zip(rows, kinds))
        counts = (np.array([len(x) // kind.itemsize for x in r]) for r, kind in zip(rows, kinds))
        return cls(tuple(ids), tuple(counts))


@dataclass(frozen=True)
class _Known:
    """Names with their ids of A and B, name by name, and whether both give them back."""

    names: list[str]
    ids: list[np.ndarray]
    sizes: list[np.ndarray]
    whole: np.ndarray


class Tokens(dict):
    """Places of parts of texts in a list of their ids of A and B.

    Texts are cut at single spaces between other characters, words also before marks; no
    token of A or B crosses there. Parts that were seen before are not tokenized again.
    """

    def __init__(self, a_path: str, b_path: str, vocabularies: Vocabularies) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.a, self.b = Tokenizer.from_file(a_path), load_model(b_path)
        self.a.encode_special_tokens = True
        self.bytes = vocabularies.bytes
        self.spaced = tuple(np.array([t[:1] == b" " for t in table]) for table in self.bytes)
        self._forget()

    def _forget(self) -> None:
        self.clear()
        self.new: list[str] = []
        self.ids = [np.empty(0, np.int32) for _ in self.bytes]
        self.begin = [np.zeros(1, np.int64) for _ in self.bytes]
        #: Whether both sides give a part back byte by byte.
        self.whole = np.empty(0, bool)

    def __missing__(self, part: str) -> int:
        place = self[part] = len(self)
        self.new.append(part)
        return place

    def of(self, texts: list[str | None]) -> Sides:
        """The ids of the texts, each behind a space; none where bytes are not given back."""
        if len(self) > _PARTS:
            self._forget()
        flat: list[int] = []
        counts = []
        for text in texts:
            if not text:
                parts = []
            elif _LOOSE.search(text):
                parts = _BETWEEN.split(" " + text)
                parts[0] = parts[0][1:]
            else:
                parts = text.split(" ")
            flat += map(self.__getitem__, parts)
            counts.append(len(parts))
        if self.new:
            self._learn()
        at, text = np.array(flat, np.int64), np.repeat(np.arange(len(texts)), counts)
        broken = np.zeros(len(texts), bool)
        broken[text[~self.whole[at]]] = True
        at, text = at[~broken[text]], text[~broken[text]]
        ids, sizes = [], []
        for side, begin in zip(self.ids, self.begin):
            size = begin[at + 1] - begin[at]
            shift = begin[at] - np.cumsum(size) + size
            ids.append(side[np.repeat(shift, size) + np.arange(size.sum())].astype(np.int64))
            sizes.append(np.bincount(text, size, len(texts)).astype(np.int64))
        return Sides(tuple(ids), tuple(sizes))

    def _learn(self) -> None:
        """Tokenize new parts, each behind a space; of a word and its marks both alone."""
        words, marks = [], []
        for part in self.new:
            found = _WORD.fullmatch(part)
            cut = found and found[2]
            words.append(" " + (found[1] if cut else part))
            marks.append(found[2] if cut else "")
        known = self._encoded(list(dict.fromkeys([*words, *marks])))
        place = {name: n for n, name in enumerate(known.names)}
        both = np.array([*map(place.__getitem__, words), *map(place.__getitem__, marks)], np.int64)
        both = both.reshape(2, -1).T
        for s, (ids, sizes) in enumerate(zip(known.ids, known.sizes)):
            size = sizes[both.ravel()]
            begin = (np.cumsum(sizes) - sizes)[both.ravel()]
            shift = begin - np.cumsum(size) + size
            flat = ids[np.repeat(shift, size) + np.arange(size.sum())]
            ends = np.cumsum(size.reshape(-1, 2).sum(axis=1))
            self.ids[s] = np.append(self.ids[s], flat)
            self.begin[s] = np.append(self.begin[s], ends + self.begin[s][-1])
        self.whole = np.append(self.whole, known.whole[both].all(axis=1))
        self.new = []

    def _encoded(self, names: list[str]) -> _Known:
        """Plain words, each behind a space, are tokenized many in a row.

        Only the first id of a word begins with a space. Words of a row where these do not
        fit, or that is not given back, are tokenized one by one like everything else.
        """
        plain = [name for name in names if name[-1:].isalpha() and _WORD.fullmatch(name, 1)]
        rest = list(dict.fromkeys(names).keys() - set(plain))
        done, ids, sizes = [], ([], []), ([], [])
        rows = [plain[i : i + _ROW] for i in range(0, len(plain), _ROW)]
        texts = ["".join(row) for row in rows]
        encoded = self.a.encode_batch_fast(texts, add_special_tokens=False)
        for row, text, e, b in zip(rows, texts, encoded, piece_ids(self.b, texts)):
            sides = (e.ids, b)
            flat = [np.array(side, np.int32) for side in sides]
            starts = [np.flatnonzero(spaced[side]) for spaced, side in zip(self.spaced, flat)]
            fit = all(len(at) == len(row) and at[0] == 0 for at in starts)
            if not fit or not self._whole(text, *sides):
                rest += row
                continue
            done += row
            for s in (0, 1):
                ids[s].append(flat[s])
                sizes[s].append(np.diff(starts[s], append=len(flat[s])))
        encoded = self.a.encode_batch_fast(rest, add_special_tokens=False)
        single = [(e.ids, b) for e, b in zip(encoded, piece_ids(self.b, rest))]
        for s in (0, 1):
            ids[s].append(np.fromiter(chain.from_iterable(x[s] for x in single), np.int32))
            sizes[s].append(np.array([len(x[s]) for x in single], np.int64))
        whole = [self._whole(name, *sides) for name, sides in zip(rest, single)]
        flat, lengths = ([np.concatenate(x) for x in y] for y in (ids, sizes))
        return _Known(done + rest, flat, lengths, np.array([True] * len(done) + whole, bool))

    def _whole(self, text: str, a: list[int], b: list[int]) -> bool:
        ours, theirs = (b"".join(map(t.__getitem__, ids)) for t, ids in zip(self.bytes, (a, b)))
        return text.encode() == ours == theirs


def _a_bytes(tokenizer: Tokenizer) -> list[bytes]:
    """Bytes of the entries of a byte-level vocabulary.

    Its alphabet writes printable bytes as themselves and the rest, in order, from U+0100.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {chr(byte): byte for byte in printable}
    letters |= {chr(0x100 + n): byte for n, byte in enumerate(sorted(set(range(256)) - set(printable)))}
    size = tokenizer.get_vocab_size(with_added_tokens=True)
    return [_decoded(tokenizer.id_to_token(i) or "", letters) for i in range(size)]


def _decoded(token: str, letters: dict[str, int]) -> bytes:
    return bytes(letters[c] for c in token) if all(c in letters for c in token) else token.encode()


def _b_bytes(model) -> list[bytes]:
    """Bytes of pieces: a byte piece is its byte, the mark of a space is a space."""
    found = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        found.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode())
    return found


@dataclass(frozen=True)
class Links:
    """The links of some texts: the place of the text, and the ids of A and B."""

    text: np.ndarray
    a: np.ndarray
    b: np.ndarray

    @property
    def pair(self) -> np.ndarray:
        return self.a * _IDS + self.b


def _align(
    sides: Sides, sizes: tuple[np.ndarray, ...], names: list[str] | None = None
) -> Iterator[tuple[np.ndarray, Links, list]]:
    """Links, and with names of ids the groups as text, of those texts that have tokens.

    Texts with fewer tokens of A drive A's ends into B's, the other ones B's into A's.
    """
    a_fewer = sides.counts[0] <= sides.counts[1]
    for d, chosen in ((0, a_fewer), (1, ~a_fewer)):
        chosen = chosen & (sides.counts[0] > 0)
        texts, o = np.flatnonzero(chosen), 1 - d
        if not len(texts):
            continue
        ids = [i[np.repeat(chosen, c)] for i, c in zip(sides.ids, sides.counts)]
        counts = [c[texts] for c in sides.counts]
        ends = [np.cumsum(size[i]) for size, i in zip(sizes, ids)]
        text = np.repeat(np.arange(len(texts)), counts[d])
        met = overlaps(ends[d], ends[o], _guess(ends[d], ends[o]))
        width = met.last - met.first + 1
        place = np.arange(width.sum()) - np.repeat(np.cumsum(width) - width, width)
        linked = [None, None]
        linked[d] = np.repeat(ids[d], width)
        linked[o] = ids[o][np.repeat(met.first, width) + place]
        offset = [len(size) for size in sizes]
        groups = _group_texts(names, offset, ids, counts, d, met) if names else []
        yield texts, Links(np.repeat(text, width), *linked), groups


def _group_texts(
    names: list[str], kinds: list[int], ids: list, counts: list, d: int, met: Overlap
) -> list:
    """Number of groups and the groups as text, for each text."""
    o = 1 - d
    cuts = [None, None]
    cuts[d], cuts[o] = np.flatnonzero(met.common) + 1, met.last[met.common] + 1
    # The group of each token, and its place if every group holds A's tokens, then B's.
    group = [np.repeat(np.arange(len(c)), np.diff(c, prepend=0)) for c in cuts]
    before = np.concatenate([[0], cuts[1][:-1]])
    place_a = np.arange(len(ids[0])) + before[group[0]]
    place_b = np.arange(len(ids[1])) + cuts[0][group[1]]
    n_a, n_b = kinds
    opens = [np.diff(g, prepend=-1) > 0 for g in group]
    at = np.empty(len(ids[0]) + len(ids[1]), np.int64)
    at[place_a] = ids[0] + np.where(opens[0], 0, n_a)
    at[place_b] = ids[1] + np.where(opens[1], 2 * n_a, 2 * n_a + n_b)
    written = [names[i] for i in at.tolist()]
    ends_a = np.cumsum(counts[0])
    ends = (ends_a + np.cumsum(counts[1])).tolist()
    groups = np.diff(group[0][ends_a - 1], prepend=-1).tolist()
    return [
        (n, "".join(written[start:end])[1:]) for n, start, end in zip(groups, [0, *ends[:-1]], ends)
    ]


def _parts(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Rows that hold about `most` bytes; a longer one ends its part."""
    for batch in batches:
        size = np.asarray(pc.binary_length(batch.column(column)).fill_null(0)).astype(np.int64)
        part = np.cumsum(size) // most
        edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(batch)]
        for start, end in zip(edges, edges[1:]):
            if end > start:
                yield batch.slice(start, end - start)


def _tokenized(
    batches: Iterator[pa.RecordBatch], a_path: str, b_path: str, vocabularies: Broadcast
) -> Iterator[pa.RecordBatch]:
    """Each row's id, a digest of its text, and the ids of its tokens."""
    tokens = Tokens(a_path, b_path, vocabularies.value)
    kinds = vocabularies.value.kinds
    for part in _parts(batches, "text", _BYTES):
        texts = part.column("text").to_pylist()
        digests = [xxhash.xxh3_128_digest((text or "").encode()) for text in texts]
        columns = [part.column("id"), pa.array(digests, pa.binary()), *tokens.of(texts).written(kinds)]
        yield pa.RecordBatch.from_arrays(columns, names=["id", "digest", "a", "b"])


def _pair_counts(tokenized: DataFrame, vocabularies: Broadcast) -> DataFrame:
    """pair, links, and whether no pair of its B id has more links.

    The highest counts are one row per B id, so never more than the vocabulary has.
    """
    met = tokenized.mapInArrow(
        lambda batches: _counted(batches, vocabularies), "pair bigint, links bigint"
    )
    counts = durable(met.groupBy("pair").agg(F.sum("links").alias("links")))
    b = F.col("pair") % F.lit(_IDS)
    highest = counts.groupBy(b.alias("b")).agg(F.max("links").alias("highest"))
    joined = counts.withColumn("b", b).join(F.broadcast(highest), "b")
    return joined.select("pair", "links", (F.col("links") == F.col("highest")).alias("is_best"))


def _common(counts: DataFrame, common: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs that hold at least 1 / common of all links, so at most `common`; sorted."""
    total = counts.agg(F.sum("links")).first()[0] or 0
    rows = counts.where(F.col("links") * F.lit(common) >= total).orderBy("pair").collect()
    pairs, links = (np.array([row[n] for row in rows], np.int64) for n in (0, 1))
    return pairs, links, np.array([row[2] for row in rows], bool)


def _counted(batches: Iterator[pa.RecordBatch], vocabularies: Broadcast) -> Iterator[pa.RecordBatch]:
    kinds, sizes = vocabularies.value.kinds, vocabularies.value.sizes
    for part in _parts(batches, "a", _BYTES):
        sides = Sides.read([part.column("a"), part.column("b")], kinds)
        pairs = [links.pair for _, links, _ in _align(sides, sizes)]
        if pairs:
            pair, n = np.unique(np.concatenate(pairs), return_counts=True)
            yield pa.record_batch({"pair": pa.array(pair), "links": pa.array(n, pa.int64())})


def _rows(
    batches: Iterator[pa.RecordBatch], vocabularies: Broadcast, known: Broadcast, with_groups: bool
) -> Iterator[pa.RecordBatch]:
    """A row per text with all that it knows itself, and one per pair that is not common.

    The first has a negative number in place of a pair, which spreads these rows as well.
    """
    kinds, sizes = vocabularies.value.kinds, vocabularies.value.sizes
    names = vocabularies.value.names
    pairs, counts, is_best = known.value
    for part in _parts(batches, "a", _BYTES):
        sides = Sides.read([part.column("a"), part.column("b")], kinds)
        digests = part.column("digest").to_pylist()
        own = {name: np.zeros(len(part), np.int64) for name in [*_COUNTS, "best", "total"]}
        own["n_a"], own["n_b"] = sides.counts
        groups = [""] * len(part)
        at = [np.arange(len(part))]
        asked = [np.array([-1 - (int.from_bytes(d[:8]) >> 1) for d in digests], np.int64)]
        times = [np.zeros(len(part), np.int64)]
        for places, links, written in _align(sides, sizes, names):
            for place, (n, text) in zip(places.tolist(), written):
                own["n_groups"][place], groups[place] = n, text
            pair = links.pair
            where = np.minimum(np.searchsorted(pairs, pair), max(len(pairs) - 1, 0))
            met = pairs[where] == pair if len(pairs) else np.zeros(len(pair), bool)
            starts = np.flatnonzero(np.diff(links.text, prepend=-1))
            own["n_links"][places] = np.diff(np.append(starts, len(pair)))
            if len(pairs):
                own["best"][places] = np.add.reduceat(met & is_best[where], starts, dtype=np.int64)
                own["total"][places] = np.add.reduceat(np.where(met, counts[where], 0), starts)
            text, pair, n = _repeated(links.text[~met], pair[~met])
            at.append(places[text])
            asked.append(pair)
            times.append(n)
        yield _batch(part, own, groups, with_groups, *map(np.concatenate, (at, asked, times)))


def _repeated(text: np.ndarray, pair: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, pair), and how often each occurs."""
    order = np.lexsort((pair, text))
    text, pair = text[order], pair[order]
    new = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(pair, prepend=-1) != 0))
    return text[new], pair[new], np.diff(np.append(new, len(pair)))


def _batch(part, own, groups, with_groups, at, pair, n) -> pa.RecordBatch:
    """The rows of the texts, then those of their other pairs."""
    shas = b"".join(hashlib.sha256(text.encode()).digest() for text in groups)
    halves = np.frombuffer(shas, ">i8").astype(np.int64).reshape(-1, 4).T
    columns = [pa.array(c, pa.int64()) for c in (*own.values(), *halves)]
    columns.append(pa.array(groups if with_groups else [None] * len(groups), pa.string()))
    texts = pa.StructArray.from_arrays(columns, names=[*own, *_SHA, "groups"])
    rows = pa.array(at, pa.int64())
    others = pa.nulls(len(at) - len(texts), texts.type)
    return pa.record_batch(
        {
            "id": part.column("id").take(rows),
            "digest": part.column("digest").take(rows),
            "own": pa.concat_arrays([texts, others]),
            "pair": pa.array(pair, pa.int64()),
            "n": pa.array(n, pa.int64()),
        }
    )
