"""Token counts of texts, without their ids.

Texts are cut into pre-tokens. Pieces are counted once per distinct pre-token, joined to
the pre-token frequencies of the documents, and summed. The counts of frequent pre-tokens,
of which there can be only so many, are found over the whole corpus first and sent to
every task. Each other pre-token is counted once in each task that meets it: to bring its
frequencies from all documents to one place moved more than the texts hold.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.frames import Input, durable
from clickpulse.llm.pretokens import load_model, piece_counts, pretoken_pattern, spaced

#: Tokens that a text may have.
LIMIT = 4096
#: At most so many pre-tokens are sent to every task: those with this share of all.
COMMON = 1 << 20
#: Characters of a pre-token that may be sent to every task.
COMMON_CHARS = 64

#: Texts, and different pre-tokens, that are held at once.
_TEXTS, _HELD = 256, 1 << 18


def count_tokens(
    docs: DataFrame,
    model_path: str,
    limit: int = LIMIT,
    common: int = COMMON,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """One row per row of docs: its id, n_bytes, n_tokens and over_limit.

    n_bytes counts UTF-8 bytes, n_tokens what the sentencepiece model makes of the whole
    text, without begin or end; over_limit says whether they are more than `limit`. A null
    text counts as empty: no bytes, no tokens. Repeated rows, also of a null id, give
    a row each. Other columns are not returned. An empty table gives an empty table.
    """
    given = Input(docs)
    body = given.frame.select(given[id].alias("id"), given[text].alias("text"))
    pattern = pretoken_pattern(load_model(model_path))
    known = body.sparkSession.sparkContext.broadcast(_common(body, model_path, pattern, common))
    kind = body.schema["id"].dataType.simpleString()
    counted = body.mapInArrow(
        lambda batches: _counted(batches, pattern, known, model_path),
        f"id {kind}, n_bytes bigint, n_tokens bigint",
    )
    over = F.col("n_tokens") > limit
    return counted.select(F.col("id").alias(id), "n_bytes", "n_tokens", over.alias("over_limit"))


def _common(body: DataFrame, model_path: str, pattern: str, common: int) -> dict[str, int]:
    """Pieces of the pre-tokens that hold at least 1 / common of all; so at most `common`.

    A pre-token that a task meets only once is left out here. That decides where it is
    counted, not the count.
    """
    seen = body.select("text").mapInArrow(
        lambda batches: _repeated(batches, pattern), "pretoken string, n bigint"
    )
    counts = durable(seen.groupBy("pretoken").agg(F.sum("n").alias("n")))
    total = counts.where("pretoken IS NULL").agg(F.sum("n")).first()[0] or 0
    frequent = counts.where(F.col("pretoken").isNotNull() & (F.col("n") * F.lit(common) >= total))
    valued = frequent.select("pretoken").mapInArrow(
        lambda batches: _pieces(batches, model_path), "pretoken string, pieces bigint"
    )
    return {row.pretoken: row.pieces for row in valued.collect()}


def _pieces(batches: Iterator[pa.RecordBatch], model_path: str) -> Iterator[pa.RecordBatch]:
    """Distinct pre-tokens with their pieces."""
    model = load_model(model_path)
    for batch in batches:
        names = batch.column("pretoken")
        counts = piece_counts(model, names.to_pylist())
        yield pa.record_batch({"pretoken": names, "pieces": pa.array(counts, pa.int64())})


def _texts(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, list]]:
    for batch in batches:
        for start in range(0, len(batch), _TEXTS):
            part = batch.slice(start, _TEXTS)
            yield part, part.column(column).to_pylist()


def _repeated(batches: Iterator[pa.RecordBatch], pattern: str) -> Iterator[pa.RecordBatch]:
    """Pre-tokens that occur in two or more texts, and in a row without one how many occur."""
    find = re.compile(pattern).findall
    held: Counter = Counter()

    def flush() -> pa.RecordBatch:
        often = [(p, n) for p, n in held.items() if n > 1 and len(p) <= COMMON_CHARS]
        names, counts = [None, *(p for p, _ in often)], [sum(held.values()), *(n for _, n in often)]
        held.clear()
        return pa.record_batch({"pretoken": pa.array(names, pa.string()), "n": pa.array(counts, pa.int64())})

    for _, texts in _texts(batches, "text"):
        for text in texts:
            if text:
                held.update(set(find(spaced(text))))
        if len(held) > _HELD:
            yield flush()
    if held:
        yield flush()


def _counted(
    batches: Iterator[pa.RecordBatch], pattern: str, known: Broadcast, model_path: str
) -> Iterator[pa.RecordBatch]:
    """Frequencies of each text times pieces, summed."""
    find, model, common = re.compile(pattern).findall, load_model(model_path), known.value
    rare: dict[str, int] = {}
    for part, texts in _texts(batches, "text"):
        counters = [Counter(find(spaced(text)) if text else ()) for text in texts]
        if len(rare) > _HELD:
            rare.clear()
        new = list(set().union(*counters) - common.keys() - rare.keys())
        rare.update(zip(new, piece_counts(model, new)))
        tokens = [
            sum(n * (common[p] if p in common else rare[p]) for p, n in counter.items())
            for counter in counters
        ]
        sizes = [len((text or "").encode()) for text in texts]
        yield pa.record_batch(
            {
                "id": part.column("id"),
                "n_bytes": pa.array(sizes, pa.int64()),
                "n_tokens": pa.array(tokens, pa.int64()),
            }
        )
