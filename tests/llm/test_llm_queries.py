"""Every query over whole tables, against its SQL or plain Python."""

import zlib
from collections import defaultdict

import brute
import duckdb
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from clickpulse.llm.oracles import ORACLES
from clickpulse.llm.queries import QUERIES


@pytest.fixture(scope="module")
def small():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def database(small):
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark", "embeddings"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    return con


@pytest.fixture(scope="module")
def result(spark, small):
    return lambda name: QUERIES[name](spark, small)


@pytest.fixture(scope="module")
def texts(database):
    return dict(database.execute("SELECT doc_id, text FROM documents").fetchall())


@pytest.mark.parametrize("name", ORACLES)
def test_against_sql(result, database, name):
    got = result(name)
    want = database.execute(ORACLES[name])
    assert got.columns == [c[0] for c in want.description]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)


def test_token_blocks(result, texts):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    got = sorted(map(tuple, result("op1_token_blocks").collect()))
    assert got == list(brute.index(sorted(texts.items()), tokenizer))


def test_held_out_languages(result, database):
    lang = dict(database.execute("SELECT doc_id, lang FROM documents").fetchall())
    rows = result("op2_language_crf").collect()
    assert len(rows) == len(lang)
    for row in rows:
        assert row.held_out == (zlib.crc32(str(row.doc_id).encode()) % 3 == 1)
        assert 0 <= row.score <= 1
    held_out = [row for row in rows if row.held_out and lang[row.doc_id]]
    right = sum(row.lang_pred == lang[row.doc_id] for row in held_out)
    assert len(held_out) > 30 and right >= 0.97 * len(held_out)


def test_line_quality_by_hand(result, texts):
    for row in result("op4_line_quality").collect():
        assert tuple(row)[1:6] == brute.line_counts(texts[row.doc_id])
        failed = row.n_words < 20 or 100 * row.n_repeat_words > 30 * row.n_words
        assert row.base_failed == failed and not (failed and row.kept)


def test_page_texts(result, database):
    pages = database.execute("SELECT page_id, url, html FROM pages").fetchall()
    want = [(i, url, brute.article(html)) for i, url, html in pages]
    got = result("op5_page_differencing").collect()
    assert sorted(tuple(r)[:3] for r in got) == sorted(want)
    assert all(row.n_chars == len(row.text) for row in got)


def test_mixture(result, database, texts):
    source = dict(database.execute("SELECT doc_id, source FROM documents").fetchall())
    size = {i: len(brute.words(t)) for i, t in texts.items()}
    by_source = defaultdict(int)
    for i, n in size.items():
        by_source[source[i]] += n
    target = brute.targets(by_source)
    taken = defaultdict(int)
    rows = result("op6_pareto_mixture").collect()
    assert len(rows) == len(texts)
    for row in rows:
        name = source[row.doc_id]
        assert (row.size, row.source_size) == (size[row.doc_id], by_source[name])
        assert row.target == pytest.approx(target[name])
        assert row.taken in (0, row.size, 2 * row.size)
        taken[name] += row.taken
    largest = max(size.values())
    assert all(abs(taken[name] - target[name]) <= largest / 2 + 1 for name in target)
    assert sorted(rows) == sorted(result("op6_pareto_mixture").collect())


def test_shards(result, texts):
    rows = result("op7_two_pass_shuffle").collect()
    assert sorted(row.doc_id for row in rows) == sorted(texts)
    slots = defaultdict(list)
    for row in rows:
        data = texts[row.doc_id].encode()
        assert (row.size, row.text_crc32, row.law) == (len(data) + 8, zlib.crc32(data), "key")
        assert row.grown_shard in (row.shard, 24)
        slots[row.shard].append(row.slot)
    assert all(sorted(found) == list(range(len(found))) for found in slots.values())
    assert set(slots) <= set(range(24)) and len(slots) == 24
    in_order = sorted((row.shard, row.slot, row.doc_id) for row in rows)
    assert in_order != sorted(in_order, key=lambda r: (r[0], r[2]))


def test_groups(result, texts):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in result("op8_jaccard_join").collect()}
    want = brute.groups(texts)
    assert got == want and any(i != root for i, (_, root) in want.items())
