"""Token ids of a corpus in files of independently coded, checksummed blocks.

Documents are put in order, tokenized, and their ids coded block by block. A file is the
part of the order that one task writes; each of its rows is a block with an index of the
documents whose ids it holds. A block reads back without any other.
"""

from __future__ import annotations

import math
import os
import re
import string
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import WhitespaceSplit

from clickpulse.llm.frames import Input, tidy
from clickpulse.llm.range_coder import decode_block, encode_block

#: Ids in a full block.
BLOCK_IDS = 1 << 20
#: Bytes of text in one file, on average.
FILE_BYTES = 16 << 20
#: Words that a worker remembers with their ids before it forgets those that did not come again.
_REMEMBERED = 1 << 19
#: Bytes of text that are cut into words at once.
_CHUNK_BYTES = 4 << 20
#: Texts whose ids are laid out at once.
_LAID = 256
#: Marks behind a word of any script, and behind one of plain letters.
_MARKS = ".,;:!?"
_ALL_MARKS = string.punctuation
#: Letters that no normal form splits or joins, and how many words of them go in a row.
_LETTERS = string.ascii_letters + "".join(map(chr, {*range(0xC0, 0x100)} - {0xD7, 0xF7}))
_ROW = 1000


def _word_ends(tokenizer: Tokenizer) -> np.ndarray | None:
    """For each id whether it ends a word; None if the vocabulary does not say."""
    suffix = getattr(tokenizer.model, "end_of_word_suffix", None)
    if not suffix:
        return None
    ends = np.zeros(tokenizer.get_vocab_size(), bool)
    for token, number in tokenizer.get_vocab().items():
        ends[number] = token.endswith(suffix)
    return ends


def _gather(ids: np.ndarray, begin: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of the words at these places, in a row, and how many each word has."""
    first = begin[at]
    size = begin[at + 1] - first
    ends = np.cumsum(size)
    places = np.repeat(first - ends + size, size)
    places += np.arange(len(places))
    return ids[places], size


class _Ids:
    """Ids of texts, of which each different word is tokenized once.

    Texts are cut at spaces and line feeds, and a run of marks behind a letter or digit
    that the normalizer leaves one stands for itself: a tokenizer that splits words there
    sees the same words, so ids of the words in a row are the ids of the text. Words lie in
    Arrow arrays and ids in flat ones; no word of a text becomes an object.
    """

    def __init__(self, tokenizer: Tokenizer, end: int) -> None:
        self.tokenizer, self.end = tokenizer, end
        self.ends = _word_ends(tokenizer)
        #: Last characters of words that are not ASCII, by whether they end in a letter or digit.
        self.closed: dict[str, bool] = {}
        self._look_at_letters()
        self.known = pa.array([], pa.large_string())
        self.ids, self.begin = np.empty(0, np.int32), np.zeros(1, np.int64)
        #: Known words that later texts had again.
        self.again = np.zeros(0, bool)

    def _look_at_letters(self) -> None:
        """Ask the tokenizer what it makes of each plain letter, and which marks come apart from one.

        Words are plain if their form is that of their letters in a row, whatever two
        letters meet. Then only the model is needed for them. An added token is looked for
        in the text as it is: if one has letters alone, or marks behind letters, no word is
        plain; nor if the vocabulary does not say where a word ends.
        """
        self.letters = self.plain = None
        easy = re.compile(f"[{_LETTERS}]*[{re.escape(_ALL_MARKS)}]*")
        added = self.tokenizer.get_added_tokens_decoder().values()
        forms = {c: self._forms(c) for c in _LETTERS}
        pairs = "".join(a + b for a in _LETTERS for b in _LETTERS)
        self.table = str.maketrans({c: " ".join(form) for c, form in forms.items()})
        in_a_row = pairs.translate(self.table)
        if (
            self.ends is None
            or any(easy.fullmatch(token.content) for token in added)
            or any(len(form) != 1 for form in forms.values())
            or self._forms(pairs) != [in_a_row]
            or in_a_row.split() != [in_a_row]
        ):
            return
        apart = []
        for mark in _ALL_MARKS:
            both, letter, alone = self._encoded([f"a{mark}", "a", mark])
            if both == letter + alone:
                apart.append(mark)
        self.letters = f"[{_LETTERS}]+"
        self.plain = f"{self.letters}[{re.escape(''.join(apart))}]*" if apart else self.letters
        self.one_case = all(forms[c] == forms[c.lower()] for c in _LETTERS)
        self.words = Tokenizer(self.tokenizer.model)
        self.words.pre_tokenizer = WhitespaceSplit()

    def _forms(self, text: str) -> list[str]:
        """The words that the model would get."""
        normalizer, cut = self.tokenizer.normalizer, self.tokenizer.pre_tokenizer
        form = normalizer.normalize_str(text) if normalizer else text
        return [word for word, _ in cut.pre_tokenize_str(form)] if cut else [form]

    def _forget(self) -> None:
        """Keep only words that came again since the last time, and none if they are too many."""
        kept = np.flatnonzero(self.again)
        if 2 * len(kept) > _REMEMBERED:
            kept = kept[:0]
        self.ids, size = _gather(self.ids, self.begin, kept)
        self.begin = np.append(0, np.cumsum(size))
        self.known = self.known.take(pa.array(kept))
        self.again = np.zeros(len(kept), bool)

    def _encoded(self, words: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(words, add_special_tokens=False)]

    def _full(self, words: pa.Array, pattern: str | None) -> np.ndarray:
        """Which words the pattern, if there is one, describes from end to end."""
        if pattern is None:
            return np.zeros(len(words), bool)
        return pc.match_substring_regex(words, f"^(?:{pattern})$").to_numpy(False)

    def _in_rows(self, words: pa.Array) -> Iterator[tuple]:
        """Ids of plain words, tokenized many in a row, and the sizes of each.

        Each word ends with the only id of it that stands for the end of a word; a row
        where the ends do not fit the words is tokenized word by word.
        """
        starts = [*range(0, len(words), _ROW), len(words)]
        lists = pa.ListArray.from_arrays(pa.array(starts, pa.int32()), words)
        rows = pc.binary_join(lists, pa.scalar(" ", words.type))
        for start, row in zip(starts, rows, strict=False):
            text = row.as_py().translate(self.table)
            ids = self.words.encode_batch_fast([text], add_special_tokens=False)[0].ids
            at = np.flatnonzero(self.ends[ids]) + 1
            if len(at) == min(_ROW, len(words) - start) and at[-1] == len(ids):
                yield ids, np.diff(at, prepend=0)
            else:
                yield from self._one_by_one(words.slice(start, _ROW).to_pylist())

    def _one_by_one(self, words: list[str]) -> Iterator[tuple]:
        for start in range(0, len(words), _ROW):
            lists = self._encoded(words[start : start + _ROW])
            yield list(chain.from_iterable(lists)), [len(x) for x in lists]

    def _places(self, words: pa.Array) -> np.ndarray:
        """Where different words are among the known ones; new ones are tokenized."""
        found = pc.index_in(words, value_set=self.known)
        new = found.is_null().to_numpy(False)
        at = found.fill_null(0).to_numpy(False).astype(np.int64)
        self.again[at[~new]] = True
        fresh = words.filter(pa.array(new))
        row = self._full(fresh, self.letters)
        order = np.concatenate([np.flatnonzero(row), np.flatnonzero(~row)])
        fresh = fresh.take(pa.array(order))
        at[np.flatnonzero(new)[order]] = len(self.known) + np.arange(len(order))
        n = int(row.sum())
        parts = chain(
            self._in_rows(fresh.slice(0, n)), self._one_by_one(fresh.slice(n).to_pylist())
        )
        ids, sizes = [self.ids], [np.empty(0, np.int64)]
        for part, size in parts:
            ids.append(np.array(part, np.int32))
            sizes.append(np.array(size, np.int64))
        self.ids = np.concatenate(ids)
        ends = np.cumsum(np.concatenate(sizes)) + self.begin[-1]
        self.begin = np.concatenate([self.begin, ends])
        self.known = pa.concat_arrays([self.known, fresh])
        self.again = np.append(self.again, np.zeros(len(fresh), bool))
        return at

    def _halves(self, words: pa.Array) -> tuple[np.ndarray, pa.Array, pa.Array]:
        """An order of the words, and in this order what is before the last marks and these."""
        plain = self._full(words, self.plain)
        order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
        easy = words.filter(pa.array(plain))
        bodies = pc.utf8_rtrim(easy, characters=_ALL_MARKS)
        marks = pc.utf8_ltrim(easy, characters=_LETTERS)
        if self.plain and self.one_case:
            bodies = pc.utf8_lower(bodies)
        halves = []
        for word in words.filter(pa.array(~plain)).to_pylist():
            body = word.rstrip(_MARKS)
            cut = len(body) if len(body) < len(word) and self._ends_a_word(body) else len(word)
            halves.append((word[:cut], word[cut:]))
        kind = words.type
        return (
            order,
            pa.concat_arrays([bodies, pa.array([a for a, _ in halves], kind)]),
            pa.concat_arrays([marks, pa.array([b for _, b in halves], kind)]),
        )

    def _ends_a_word(self, body: str) -> bool:
        """Whether the normal form ends in a letter or digit, so that a mark behind is split off.

        The last character alone can become a letter and a combining mark, which the
        tokenizer keeps with a mark behind it.
        """
        last = body[-1:]
        if last.isascii():
            return last.isalnum()
        if last not in self.closed:
            normalizer = self.tokenizer.normalizer
            form = normalizer.normalize_str(last) if normalizer else last
            self.closed[last] = last.isalnum() and form[-1:].isalnum()
        return self.closed[last]

    def of(self, texts: pa.Array | list[str | None]) -> list[np.ndarray]:
        """The ids of each text, with the end id."""
        if len(self.known) > _REMEMBERED:
            self._forget()
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.large_string())
        column = column.cast(pa.large_string())
        words = pc.split_pattern(pc.replace_substring(column, "\n", " "), " ")
        until = np.cumsum(pc.fill_null(pc.list_value_length(words), 0).to_numpy(False).astype(np.int64))
        coded = pc.dictionary_encode(words.flatten())
        del words
        order, bodies, marks = self._halves(coded.dictionary)
        parts = pc.dictionary_encode(pa.concat_arrays([bodies, marks]))
        at = self._places(parts.dictionary)[parts.indices.to_numpy(False)]
        # The ids of each different word, and behind them the end id.
        pairs = np.empty((len(order), 2), np.int64)
        pairs[order] = at.reshape(2, -1).T
        ids, size = _gather(self.ids, self.begin, pairs.ravel())
        ids = np.append(ids, np.int32(self.end))
        ends = np.cumsum(size.reshape(-1, 2).sum(axis=1))
        begin = np.concatenate([[0], ends, [len(ids)]])
        places = coded.indices.to_numpy(False)
        out: list[np.ndarray] = []
        for first in range(0, len(until), _LAID):
            stops = until[first : first + _LAID]
            start = int(until[first - 1]) if first else 0
            row = np.insert(places[start : stops[-1]].astype(np.int64), stops - start, len(order))
            flat, size = _gather(ids, begin, row)
            text_ends = np.cumsum(size)[stops - start + np.arange(len(stops))]
            out += np.split(flat, text_ends[:-1])
        return out


@lru_cache(maxsize=1)
def _ids(tokenizer: str, end: int) -> _Ids:
    """What all tasks of a worker know, one after the other."""
    return _Ids(Tokenizer.from_str(tokenizer), end)


def _chunks(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Slices of the batch with a bounded size of texts, or with one text."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(False)
    ends = np.cumsum(sizes.astype(np.int64))
    start = 0
    while start < batch.num_rows:
        most = (int(ends[start - 1]) if start else 0) + _CHUNK_BYTES
        stop = max(start + 1, int(np.searchsorted(ends, most, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def _encoder(tokenizer, end: int, block_ids: int, schema: pa.Schema):
    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        known = _ids(tokenizer.value, end)
        size = known.tokenizer.get_vocab_size()
        seq = blocks = held = 0
        file, docs, parts = None, [], []

        def block() -> pa.RecordBatch:
            row = {
                "file": file,
                "block": blocks,
                "doc_ids": [d for d, _ in docs],
                "seqs": [s for _, s in docs],
                "sizes": [len(p) for p in parts],
                "data": encode_block(np.concatenate(parts), size),
            }
            return pa.RecordBatch.from_pylist([row], schema)

        for batch in batches:
            for rows in _chunks(batch):
                names = rows.column("id").to_pylist()
                file = rows.column("file")[0].as_py()
                for name, ids in zip(names, known.of(rows.column("text")), strict=True):
                    while len(ids):
                        part, ids = ids[: block_ids - held], ids[block_ids - held :]
                        docs.append((name, seq))
                        parts.append(part)
                        held += len(part)
                        if held == block_ids:
                            yield block()
                            blocks, held, docs, parts = blocks + 1, 0, [], []
                    seq += 1
        if parts:
            yield block()

    return encode


def write_tokens(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end: int,
    block_ids: int = BLOCK_IDS,
    file_bytes: int = FILE_BYTES,
    id: str = "doc_id",
    text: str = "text",
) -> None:
    """Tokenize every whole text, end each with the id `end`, and write the ids to `path`.

    `tokenizer` is a file of the tokenizers library that cuts words at spaces, with at
    most 65,536 ids. Documents are in ascending order of their ids, null first; rows of
    one id are ordered by their texts and all written. A null text is empty and has the
    end id alone. An empty table writes files without blocks. Other columns are not read.
    """
    with open(tokenizer, encoding="utf-8") as f:
        content = docs.sparkSession.sparkContext.broadcast(f.read())
    given = Input(docs)
    rows = given.frame.select(given[id].alias("id"), given[text].alias("text"))
    size = rows.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    files = max(1, math.ceil(size / file_bytes))
    ordered = rows.repartitionByRange(files, "id").sortWithinPartitions("id", "text")
    numbered = ordered.withColumn("file", F.spark_partition_id())
    kind = rows.schema["id"].dataType
    shape = (
        f"file int, block int, doc_ids array<{kind.simpleString()}>, seqs array<long>, "
        "sizes array<int>, data binary"
    )
    empty = docs.sparkSession.createDataFrame([], shape)
    encode = _encoder(content, end, block_ids, empty.toArrow().schema)
    numbered.mapInArrow(tidy(encode), shape).write.parquet(path)


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo that of CRC-32, lowest power in the highest bit."""
    product = 0
    for bit in range(31, -1, -1):
        if a >> bit & 1:
            product ^= b
        b = (b >> 1) ^ (0xEDB88320 if b & 1 else 0)
    return product


def join_crc(first: int, second: int, size: int) -> int:
    """The CRC-32 of two strings in a row, from theirs and the bytes of the second."""
    power, base = 1 << 31, 1 << 23
    while size:
        if size & 1:
            power = _times(power, base)
        base, size = _times(base, base), size >> 1
    return _times(power, first) ^ second


def _blocks(row: dict) -> Iterator[tuple]:
    ids = decode_block(row["data"]).astype("<u4")
    start = 0
    for name, seq, size in zip(row["doc_ids"], row["seqs"], row["sizes"], strict=True):
        yield name, seq, ids[start : start + size]
        start += size
    if start != len(ids):
        raise ValueError("the index of the block does not fit its ids")


def read_tokens(spark: SparkSession, path: str) -> DataFrame:
    """The pieces of documents in the files: file, block, seq, doc_id, ids.

    A document that lies in several blocks has a piece in each, in the order of blocks.
    """
    rows = spark.read.parquet(path)
    kind = rows.schema["doc_ids"].dataType.elementType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name = batch.schema.field("doc_ids").type.value_type
            for row in batch.to_pylist():
                found = list(_blocks(row))
                n = len(found)
                arrays = [
                    pa.array([row["file"]] * n, pa.int32()),
                    pa.array([row["block"]] * n, pa.int32()),
                    pa.array([s for _, s, _ in found], pa.int64()),
                    pa.array([d for d, _, _ in found], name),
                    pa.array([i.astype(np.int32) for _, _, i in found], pa.list_(pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(
                    arrays, names=["file", "block", "seq", "doc_id", "ids"]
                )

    return rows.mapInArrow(
        read, f"file int, block int, seq long, doc_id {kind}, ids array<int>"
    )


def token_index(spark: SparkSession, path: str) -> DataFrame:
    """From the files, one row per document in their order: doc_id, start, n_tokens, ids_crc32.

    start counts the ids of all documents before it; ids_crc32 is the unsigned CRC-32 of
    its ids as little-endian unsigned 32-bit numbers. A damaged block fails the query.
    """
    rows = spark.read.parquet(path)
    kind = rows.schema["doc_ids"].dataType.elementType.simpleString()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            name = batch.schema.field("doc_ids").type.value_type
            for row in batch.to_pylist():
                found = [(d, s, len(i), zlib.crc32(i.tobytes())) for d, s, i in _blocks(row)]
                n = len(found)
                doc, seq, size, crc = zip(*found, strict=True) if n else ((), (), (), ())
                arrays = [
                    pa.array([row["file"]] * n, pa.int32()),
                    pa.array([row["block"]] * n, pa.int32()),
                    pa.array(seq, pa.int64()),
                    pa.array(doc, name),
                    pa.array(size, pa.int64()),
                    pa.array(crc, pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays(
                    arrays, names=["file", "block", "seq", "doc_id", "n", "crc"]
                )

    def joined(pieces: pa.Array) -> pa.Array:
        out = []
        for parts in pieces.to_pylist():
            crc = parts[0]["crc"]
            for part in parts[1:]:
                crc = join_crc(crc, part["crc"], 4 * part["n"])
            out.append(crc)
        return pa.array(out, pa.int64())

    pieces = rows.mapInArrow(
        tidy(read), f"file int, block int, seq long, doc_id {kind}, n long, crc long"
    )
    whole = pieces.groupBy("file", "seq").agg(
        F.first("doc_id").alias("doc_id"),
        F.sum("n").alias("n_tokens"),
        F.sort_array(F.collect_list(F.struct("block", "n", "crc"))).alias("pieces"),
    )
    crc = F.arrow_udf(joined, "long")
    whole = whole.withColumn("ids_crc32", crc("pieces")).drop("pieces")
    # Files are counted from their blocks' index alone.
    sizes = rows.select("file", F.aggregate("sizes", F.lit(0).cast("long"), lambda a, n: a + n).alias("n"))
    sizes = sizes.groupBy("file").agg(F.sum("n").alias("n"))
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("offset"))
    before = Window.partitionBy("file").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("n_tokens").over(before), F.lit(0)).cast("long")
    placed = whole.withColumn("before", start).join(offsets, "file")
    return placed.select(
        "doc_id", (F.col("before") + F.col("offset")).alias("start"), "n_tokens", "ids_crc32"
    )

