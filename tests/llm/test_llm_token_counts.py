"""Token counts against the sentencepiece library on whole texts."""

import random

import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor

from clickpulse.llm.pretokens import load_model, piece_counts, pretoken_pattern, spaced
from clickpulse.llm.queries import QUERIES
from clickpulse.llm.token_counts import count_tokens

MODEL = public_tokenizers.path("piece_bpe_32k.model")
LONG = " ".join(f"word{n}," for n in range(60_000))
# Marks, digits of all kinds, combining marks, spaces, controls, and the model's own space.
ALPHABET = "ab é.,;:!?'\"()<>/_-1²٣\n\t\r ▁　日本हिन्दी़\x00\x1c>s​́İﬁ𝒳"
PARTS = [" ", "the", "</s>", "<s>", "<unk>", "<0x0A>", ".com", "\n", "s>", "².", "▁▁", "  "]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=MODEL)


def want(library, text):
    text = text or ""
    n = len(library.encode(text))
    return len(text.encode()), n, n > 4096


def test_pretokens_have_the_pieces_of_the_text(library):
    import re

    find = re.compile(pretoken_pattern(load_model(MODEL))).findall
    pick = random.Random(3)
    texts = ["".join(pick.choices(ALPHABET, k=pick.randrange(1, 30))) for _ in range(8000)]
    texts += ["".join(pick.choices(PARTS, k=pick.randrange(1, 9))) for _ in range(8000)]
    for text in texts:
        parts = find(spaced(text))
        assert "".join(parts) == spaced(text)
        assert sum(piece_counts(library, parts)) == len(library.encode(text)), repr(text)


def test_query(spark, library):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, QUERIES["op13_token_counts"](spark, folder).collect()))
    assert got == sorted((d.doc_id, *want(library, d.text)) for d in docs)


@pytest.mark.parametrize("common", [1 << 20, 4, 1])
def test_odd_rows(spark, library, common):
    """Whatever is sent to every task: all pre-tokens, the most frequent, or next to none."""
    texts = [(1, "a b, a b."), (1, "a b, a b."), (1, "other"), (2, None), (3, ""), (4, " \t\n"), (5, LONG)]
    texts += [(None, "a"), (None, "a"), (None, None), (6, "x" * 20_000), (7, "<s>a</s>"), (8, "▁a ")]
    schema = "doc_id bigint, text string, n_tokens string, copies string, pretoken string"
    docs = spark.createDataFrame([(*row, "x", "y", "z") for row in texts], schema).repartition(3)
    result = count_tokens(docs, MODEL, common=common)
    assert result.columns == ["doc_id", "n_bytes", "n_tokens", "over_limit"]
    expected = [(i, *want(library, text)) for i, text in texts]
    assert sorted(map(tuple, result.collect()), key=repr) == sorted(expected, key=repr)


def test_empty_table(spark):
    result = count_tokens(spark.createDataFrame([], "doc_id int, text string"), MODEL)
    assert result.collect() == [] and dict(result.dtypes)["doc_id"] == "int"


def test_a_third_of_all_rows_alike(spark, library):
    texts = [(1, "hot text of many copies")] * 400 + [(n, f"text{n} of its own") for n in range(2, 802)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(8)
    got = sorted(map(tuple, count_tokens(docs, MODEL).collect()))
    assert got == sorted((i, *want(library, text)) for i, text in texts)
