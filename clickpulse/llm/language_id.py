"""Language identification by a linear-chain conditional random field over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.llm.crf import WORD, Model, Packed, posteriors, train
from clickpulse.llm.frames import Input

#: The sample a model is fitted on: documents per language, and characters of each.
SAMPLE_DOCS = 300
SAMPLE_CHARS = 20_000
#: Words that one forward-backward pass holds; a longer text is a pass by itself.
PASS_WORDS = 1 << 19
#: Known words a task remembers before it starts anew.
_REMEMBERED = 1 << 20


def training_sample(
    docs: DataFrame, usable: Column, text: str, lang: str, id: str, size: int, chars: int
) -> list[tuple[str, str]]:
    """At most `size` labelled texts per language, spread evenly by a hash of id and text.

    Each gives at most `chars` characters from a place that the same hash picks. The smallest
    hash of a language is always in, so none goes missing however alike its rows are.
    """
    given = Input(docs)
    hashed = F.xxhash64(given[id], given[text], F.lit(2))
    share = F.pmod(hashed, F.lit(1 << 30)) / float(1 << 30)
    rows = given.frame.where(usable & given[lang].isNotNull() & given[text].isNotNull())
    rows = rows.select(
        given[lang].cast("string").alias("lang"),
        given[text].alias("text"),
        hashed.alias("h"),
        share.alias("share"),
    )
    counts = rows.groupBy("lang").agg(F.count("*").alias("n"), F.min("share").alias("least"))
    # A hash below the language's bound leaves about twice the sample to choose from.
    near = rows.join(F.broadcast(counts), "lang").where(
        (F.col("share") * F.col("n") < 2 * size) | (F.col("share") == F.col("least"))
    )
    first = Window.partitionBy("lang").orderBy("h", F.length("text"), F.crc32(F.encode("text", "utf-8")))
    start = F.pmod(F.col("h"), F.greatest(F.lit(1), F.length("text") - chars)) + 1
    part = F.substr("text", start.cast("int"), F.lit(chars))
    near = near.select("lang", "h", part.alias("text"))
    chosen = near.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= size)
    return sorted((r["lang"], r["text"]) for r in chosen.select("lang", "text").collect())


class _Scores(dict):
    """Places of words in a growing table of their scores."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self.table = np.empty((0, len(model.languages)), np.float32)
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        place = self[word] = len(self)
        self.new.append(word)
        return place

    def of(self, words: list[str]) -> np.ndarray:
        if len(self) > _REMEMBERED:
            self.clear()
            self.table = self.table[:0]
        places = np.array([self[w] for w in words], np.int64)
        if self.new:
            self.table = np.concatenate([self.table, self.model.scores(self.new)])
            self.new = []
        return self.table[places]


def _passes(texts: list[str | None]) -> Iterator[tuple[list[int], list[list[str]]]]:
    """Texts with words, in groups of similar length and bounded size."""
    words = {i: found for i, t in enumerate(texts) if t and (found := WORD.findall(t.lower()))}
    group: list[int] = []
    held = 0
    for i in sorted(words, key=lambda i: len(words[i])):
        if group and held + len(words[i]) > PASS_WORDS:
            yield group, [words[j] for j in group]
            group, held = [], 0
        group.append(i)
        held += len(words[i])
    if group:
        yield group, [words[j] for j in group]


def _solved(model: Model, scores: _Scores, lists: list[list[str]]) -> tuple[np.ndarray, Packed]:
    packed = Packed(np.array([len(w) for w in lists]))
    table = scores.of([w for words in lists for w in words])
    return posteriors(model, table[packed.source], packed), packed


def fit_languages(
    docs: DataFrame,
    usable: Column | None = None,
    id: str = "doc_id",
    text: str = "text",
    lang: str = "lang",
    sample_docs: int = SAMPLE_DOCS,
    sample_chars: int = SAMPLE_CHARS,
) -> Model:
    """Learn from a bounded sample of the labelled documents among the usable rows.

    `usable` is a condition on the columns as the caller names them. Rows with a null text
    or label teach nothing; without any label the model knows no language.
    """
    rows = docs if usable is None else docs.where(usable)
    return train(training_sample(rows, F.lit(True), text, lang, id, sample_docs, sample_chars))


def identify_languages(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add lang_pred and score: the language with the largest mean word probability.

    Every word of the whole text counts. A null text, one without a letter, or a model
    that knows no language gives und with score 0. Ties go to the smaller language name.
    Rows are judged by their text alone; repeated rows get the same result. An empty table
    gives an empty table; a result column replaces an input column of its name.
    """
    given = Input(docs)
    parts = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.weights, model.start, model.change)
    )
    kind = pa.struct([("lang", pa.string()), ("score", pa.float64())])

    def identify(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = Model(*parts.value)
        scores = _Scores(model)
        for batch in batches:
            texts = batch.to_pylist()
            rows: list = [{"lang": "und", "score": 0.0}] * len(texts)
            for group, lists in _passes(texts) if model.languages else ():
                p, packed = _solved(model, scores, lists)
                for_text = np.stack(
                    [np.bincount(packed.which, p[:, k]) for k in range(p.shape[1])], axis=1
                )
                best = for_text.argmax(axis=1)
                for at, k in enumerate(best.tolist()):
                    i = int(packed.order[at])
                    score = min(1.0, float(for_text[at, k]) / len(lists[i]))
                    rows[group[i]] = {"lang": model.languages[k], "score": score}
            yield pa.array(rows, kind)

    found = F.arrow_udf(identify, "lang string, score double")
    df = given.frame.withColumn("found", found(given[text]))
    return given.results(
        df, {"lang_pred": F.col("found.lang"), "score": F.col("found.score")}
    )


def label_words(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """Add words (lower-cased runs of letters) and word_langs (the likeliest language of each).

    Both are empty for a null text, one without a letter, or a model without languages.
    """
    given = Input(docs)
    parts = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.weights, model.start, model.change)
    )
    kind = pa.struct([("words", pa.list_(pa.string())), ("langs", pa.list_(pa.string()))])

    def label(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        model = Model(*parts.value)
        scores = _Scores(model)
        for batch in batches:
            texts = batch.to_pylist()
            rows: list = [{"words": [], "langs": []}] * len(texts)
            for group, lists in _passes(texts) if model.languages else ():
                p, packed = _solved(model, scores, lists)
                best = np.empty(len(p), np.int64)
                best[packed.source] = p.argmax(axis=1)
                start = 0
                for i, words in zip(group, lists, strict=True):
                    langs = [model.languages[k] for k in best[start : start + len(words)]]
                    rows[i] = {"words": words, "langs": langs}
                    start += len(words)
            yield pa.array(rows, kind)

    found = F.arrow_udf(label, "words array<string>, langs array<string>")
    df = given.frame.withColumn("found", found(given[text]))
    return given.results(
        df, {"words": F.col("found.words"), "word_langs": F.col("found.langs")}
    )
