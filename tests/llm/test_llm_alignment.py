"""Alignment of tokenizers against whole texts and all pairs of tokens."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from clickpulse.llm.alignment import (
    Sides,
    Tokens,
    Vocabularies,
    _guess,
    align_tokens,
    gallop,
    overlaps,
)
from clickpulse.llm.queries import QUERIES

A = public_tokenizers.path("byte_bpe_50k.json")
B = public_tokenizers.path("piece_bpe_32k.model")
LONG = " ".join(f"word{n}," for n in range(8_000))
ALPHABET = "ab é.,;:!?'\"()<>/_-1²٣\n\t\r  日本हिन्दी़\x00\x1c>s​́İﬁ𝒳\u0085᠎×ʯ"
PARTS = [" ", "the", "</s>", "<|endoftext|>", "don't", ".com", "\n", "s>", "².", "  ", "Ünter", ", "]


@pytest.fixture(scope="module")
def libraries():
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    return a, SentencePieceProcessor(model_file=B)


def byte_letters():
    """The alphabet of byte-level vocabularies, from the tokenizer's own alphabet."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, extra = {chr(b): b for b in shown}, 0
    for byte in range(256):
        if byte not in shown:
            letters[chr(256 + extra)] = byte
            extra += 1
    return letters


LETTERS = byte_letters()


def pieces(libraries, text):
    """Ids and bytes of the tokens of both, or nothing."""
    a, b = libraries
    if not text:
        return [], []
    raw = (" " + text).encode()
    ids = a.encode(" " + text, add_special_tokens=False).ids
    ours = [(i, bytes(LETTERS[c] for c in a.id_to_token(i))) for i in ids]
    theirs = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        theirs.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    if any(b"".join(p for _, p in side) != raw for side in (ours, theirs)):
        return [], []
    return ours, theirs


def spans(side):
    at = 0
    for i, raw in side:
        yield i, at, at + len(raw)
        at += len(raw)


def brute(libraries, rows):
    """The result by comparing all tokens of a text with each other."""
    linked, groups, counts = [], [], Counter()
    for _, text in rows:
        ours, theirs = (list(spans(side)) for side in pieces(libraries, text))
        pairs, start = [], 0
        for a, s, e in ours:
            while start < len(theirs) and theirs[start][2] <= s:
                start += 1
            for b, s2, e2 in theirs[start:]:
                if s2 >= e:
                    break
                pairs.append((a, b))
        cuts = sorted({e for _, _, e in ours} & {e for _, _, e in theirs})
        written, low = [], 0
        by_end = [defaultdict(list), defaultdict(list)]
        for cut_of, side in zip(by_end, (ours, theirs)):
            k = 0
            for i, _, e in side:
                while cuts[k] < e:
                    k += 1
                cut_of[k].append(str(i))
        written = [",".join(by_end[0][k]) + "|" + ",".join(by_end[1][k]) for k in range(len(cuts))]
        linked.append((len(ours), len(theirs), pairs))
        groups.append(written)
        counts.update(pairs)
    highest = defaultdict(int)
    for (_, b), n in counts.items():
        highest[b] = max(highest[b], n)
    for (i, _), (n_a, n_b, pairs), written in zip(rows, linked, groups):
        best = sum(counts[p] == highest[p[1]] for p in pairs)
        text = ";".join(written)
        sha = hashlib.sha256(text.encode()).hexdigest() if text else ""
        yield (i, n_a, n_b, len(written), len(pairs), best, sum(counts[p] for p in pairs), sha, text)


def ordered(rows):
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("seed", range(20))
def test_gallop_finds_ranks_from_any_guess(seed):
    pick = np.random.default_rng(seed)
    table = np.unique(pick.integers(0, 400, pick.integers(1, 200)))
    keys = np.sort(pick.integers(-5, 405, 60))
    guess = pick.integers(0, len(table), len(keys))
    assert (gallop(keys, table, guess) == np.searchsorted(table, keys)).all()


def test_guesses_are_close_to_the_ranks():
    """Also where a text's tokens are very unlike in length at its two ends."""
    table = np.concatenate([np.arange(1, 5001), np.arange(5010, 55001, 10)])
    keys = np.concatenate([np.arange(50, 5001, 50), np.arange(5001, 55001)])
    keys[-1] = table[-1]
    off = _guess(keys, table) - np.searchsorted(table, keys)
    assert abs(off).max() <= 2
    assert list(_guess(np.array([7]), np.array([7]))) == [0]


def test_overlaps_by_hand():
    # Ends 3 5 9 in 2 3 6 7 9: tokens 0-3, 3-5, 5-9 meet 0-2 2-3, 3-6, 3-6 6-7 7-9.
    met = overlaps(np.array([3, 5, 9]), np.array([2, 3, 6, 7, 9]), np.array([4, 0, 2]))
    assert met.first.tolist() == [0, 2, 2] and met.last.tolist() == [1, 2, 4]
    assert met.common.tolist() == [True, False, True]


def test_parts_have_the_ids_of_the_text(libraries):
    pick = random.Random(4)
    texts = ["".join(pick.choices(ALPHABET, k=pick.randrange(1, 30))) for _ in range(5000)]
    texts += ["".join(pick.choices(PARTS, k=pick.randrange(1, 9))) for _ in range(5000)]
    vocabularies = Vocabularies.read(A, B)
    sides = Tokens(A, B, vocabularies).of([*texts, *texts, None, ""])
    sides = Sides.read(sides.written(vocabularies.kinds), vocabularies.kinds)
    ours, theirs = (np.split(i, np.cumsum(c)[:-1]) for i, c in zip(sides.ids, sides.counts))
    for n, text in enumerate([*texts, *texts, None, ""]):
        want = pieces(libraries, text)
        assert ours[n].tolist() == [i for i, _ in want[0]], repr(text)
        assert theirs[n].tolist() == [i for i, _ in want[1]], repr(text)


def test_query(spark, libraries):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op11_token_alignment"](spark, folder)
    assert got.columns == [
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
    ]
    assert ordered(got.collect()) == ordered(row[:-1] for row in brute(libraries, docs))


@pytest.mark.parametrize("common", [1 << 20, 30, 1])
def test_odd_rows(spark, libraries, common):
    """Whatever is sent to every task: all pairs, the most frequent, or next to none."""
    texts = [(1, "a b, a b."), (1, "a b, a b."), (1, "other"), (2, None), (3, ""), (4, " \t\n")]
    texts += [(5, LONG), (None, "a"), (None, "a"), (None, None), (6, "x" * 5000), (7, "a▁b"), (8, "▁")]
    texts += [(9, "<|endoftext|> </s>"), (10, "日本 हिन्दी")]
    schema = "doc_id bigint, text string, n_a string, pair string, own string"
    docs = spark.createDataFrame([(*row, "x", "y", "z") for row in texts], schema).repartition(3)
    result = align_tokens(docs, A, B, common=common, with_groups=True)
    assert ordered(result.collect()) == ordered(brute(libraries, texts))


def test_empty_table(spark):
    result = align_tokens(spark.createDataFrame([], "doc_id int, text string"), A, B)
    assert result.collect() == [] and dict(result.dtypes)["doc_id"] == "int"


def test_a_third_of_all_rows_alike(spark, libraries):
    texts = [(1, "hot text, of many copies")] * 200 + [(n, f"text{n} of its own") for n in range(2, 402)]
    docs = spark.createDataFrame(texts, "doc_id bigint, text string").repartition(8)
    got = ordered(align_tokens(docs, A, B).collect())
    assert got == ordered(row[:-1] for row in brute(libraries, texts))
