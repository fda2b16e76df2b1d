"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import random

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import AddedToken, Tokenizer

from clickpulse.llm import range_coder, token_files
from clickpulse.llm.components import components
from clickpulse.llm.crf import WORD, Model, Packed, posteriors, train
from clickpulse.llm.decontamination import cut_passages, find_passages
from clickpulse.llm.fm_index import FMIndex, suffix_order
from clickpulse.llm.html_lines import page_lines
from clickpulse.llm.jaccard_join import keep_one, similar_groups
from clickpulse.llm.language_id import fit_languages, identify_languages, label_words
from clickpulse.llm.licenses import LICENSES, scan_licenses
from clickpulse.llm.lines import judge_lines
from clickpulse.llm.mixing import mix_sources
from clickpulse.llm.page_differencing import extract_pages, main_text, shared_lines
from clickpulse.llm.range_coder import decode_block, encode_block
from clickpulse.llm.sharding import shuffle_into_shards, write_shards
from clickpulse.llm.token_files import _Ids, join_crc, read_tokens, token_index, write_tokens
from clickpulse.llm.urls import judge_urls

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
PROSE = "The quick brown fox jumps over the lazy dog near the old river bank. "
LONG = " ".join(f"word{n}" for n in range(60_000))

# Columns that clash with names of results and of steps in between.
CLASHES = "kept string, size string, text2 string, in0 string, tokens string, label string"
DOCS = f"doc_id bigint, text string, lang string, source string, {CLASHES}"


def doc(i, text, lang=None, source=None):
    return (i, text, lang, source, *("x" * 6))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [
        doc(1, PROSE * 3, "en", "a"),
        doc(1, PROSE * 3, "en", "a"),  # a repeated row
        doc(2, None, None, None),
        doc(3, "", "en", "a"),
        doc(4, " \t\n", None, ""),
        doc(5, LONG, "en", None),
        doc(None, "Short one.", "en", "b"),
        doc(None, None, None, "b"),
        doc(6, "\n".join([PROSE] * 4), "en", "a"),
        doc(7, "123 456 !!", None, "a"),
    ]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


# Line cleaning


def test_lines(frame):
    clean = "\n".join(
        " ".join(f"word{n}x{k}" for k in range(10)).capitalize() + "." for n in range(9)
    )
    cases = {
        1: clean,
        2: clean + "\nHome | About | Contact\nAll rights reserved.\n$$$ ### %%% &&& ***",
        3: clean.upper().replace(" ", "!! "),
        4: "\n".join([PROSE] * 3),
        5: None,
        6: "too short",
        7: clean + "\n" + clean.split("\n")[0],
    }
    got = {r.doc_id: r for r in judge_lines(frame("doc_id int, text string", *cases.items())).collect()}
    assert got[1].kept and got[1].clean_text == clean
    assert got[2].kept and got[2].clean_text == clean
    assert not got[3].base_failed and not got[3].kept
    assert got[4].base_failed and got[4].n_repeat_words > 30
    assert (got[5].n_words, got[5].base_failed, got[5].clean_text) == (0, True, "")
    assert got[6].base_failed and not got[6].kept
    assert got[7].kept and got[7].n_dup_lines == 1 and got[7].clean_text == clean


def test_lines_on_odd_rows(docs, empty):
    judged = judge_lines(docs)
    assert judged.count() == docs.count() and judge_lines(empty).count() == 0
    assert "clean_text" in judged.columns and dict(judged.dtypes)["kept"] == "boolean"
    for row in judged.collect():
        figures = (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words)
        assert figures == brute.line_counts(row.text)
        assert row.size == row.in0 == "x"


# Mixing


def test_mixture_of_odd_rows(docs, empty):
    mixed = mix_sources(docs).collect()
    assert len(mixed) == docs.count() and mix_sources(empty).count() == 0
    same = [row.taken for row in mixed if row.doc_id == 1]
    assert same[0] == same[1] and all(row.taken <= 2 * row.size for row in mixed)
    assert all(row.taken == 0 for row in mixed if not row.size)
    sizes = {}
    for row in mixed:
        sizes[row.source] = sizes.get(row.source, 0) + row.size
    want = brute.targets(sizes)
    assert all(row.target == pytest.approx(want[row.source]) for row in mixed)


def test_mixture_hits_its_targets(spark):
    pick = random.Random(1)
    rows = [
        (i, "w " * int(pick.paretovariate(1.2) * 20), "hot" if i % 3 == 0 else f"s{i % 7}")
        for i in range(3000)
    ]
    df = spark.createDataFrame(rows, "doc_id int, text string, source string").repartition(7)
    mixed = mix_sources(df)
    sums = mixed.groupBy("source").agg(
        F.sum("taken").alias("taken"), F.first("target").alias("target"), F.max("size").alias("most")
    )
    for row in sums.collect():
        assert abs(row.taken - row.target) <= row.most / 2 + 1
    assert sorted(mixed.collect()) == sorted(mix_sources(df.repartition(3)).collect())


# Sharding


def test_shards_of_odd_rows(docs, empty, spark, tmp_path):
    sharded = shuffle_into_shards(docs, shards=5, bucket_bytes=4096)
    rows = sharded.collect()
    assert len(rows) == docs.count() and shuffle_into_shards(empty).count() == 0
    for shard in range(5):
        slots = sorted(r.slot for r in rows if r.shard == shard)
        assert slots == list(range(len(slots)))
    assert len({r.shard for r in rows if r.doc_id == 1}) == 1
    assert all(r.grown_shard in (r.shard, 5) for r in rows)
    write_shards(sharded, str(tmp_path / "shards"))
    assert spark.read.parquet(str(tmp_path / "shards")).count() == len(rows)


# Licences


def test_licenses(frame, docs, empty):
    mit = LICENSES["MIT"]
    cases = {
        1: mit,
        2: mit.upper().replace("<year>", "2020").replace("\n", "\r\n"),
        3: mit.replace("(c) <year> <copyright holders>", "2001 Someone Else, Inc."),
        4: mit.replace("sublicense", "sub license").replace("COPYRIGHT HOLDERS", "copyright owners"),
        5: mit + " and more",
        6: None,
        7: "...",
        8: "  licensed under the APACHE licence, version 2.0 ",
    }
    got = {r.doc_id: r for r in scan_licenses(frame("doc_id int, text string", *cases.items())).collect()}
    assert [got[i].license for i in range(1, 5)] == ["MIT"] * 4
    assert got[5].license is None and got[5].digest
    assert got[6].digest is got[7].digest is None
    assert got[8].license == "Apache-2.0 (notice)"
    assert scan_licenses(docs).count() == docs.count() and scan_licenses(empty).count() == 0
    assert scan_licenses(docs, {}).where("license IS NOT NULL").count() == 0


def test_full_licenses(frame, spark):
    import duckdb

    from clickpulse.llm.oracles import license_digests

    body = LICENSES["MIT"].split("\n", 4)[4]
    wrapped = body.replace("AUTHORS OR COPYRIGHT", "AUTHORS OR\nCOPYRIGHT")
    assert "\nCOPYRIGHT HOLDERS BE LIABLE" in wrapped
    known = ("Apache-2.0 BSD-2-Clause BSD-3-Clause CC0-1.0 GPL-2.0 GPL-3.0 LGPL-2.1 LGPL-3.0 MPL-2.0 Unlicense")
    cases = [(name, " " + LICENSES[name].replace("\n", "\r\n").replace("  ", "\t")) for name in known.split()]
    cases += [
        ("MIT", body),
        ("MIT", "The MIT License (MIT)\n\nCopyright (c) 2015 A. Person\n\n" + body),
        ("MIT", "The MIT License (MIT)\nCopyright IBM Corp. 2004\n(c) 2001 B. Person\n" + body),
        ("MIT", "Copyright The Authors of This\n\n" + wrapped),
        ("MIT", "# MIT License\n\n© B. Person\n" + wrapped),
        ("BSD-3-Clause", LICENSES["BSD-3-Clause"].replace("<owner>", "Me\nAll rights reserved.")),
        (None, wrapped.replace("COPYRIGHT HOLDERS BE LIABLE", "")),
        (None, LICENSES["Apache-2.0"].replace("(c) You must retain", "")),
        (None, "All rights reserved."),
        (None, "Released under the MIT License."),
    ]
    docs = [(n, text) for n, (_, text) in enumerate(cases)]
    got = {r.doc_id: (r.digest, r.license) for r in scan_licenses(frame("doc_id int, text string", *docs)).collect()}
    assert [got[n][1] for n in range(len(cases))] == [name for name, _ in cases]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id INT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    assert {i: (d, name) for i, d, name in con.execute(license_digests()).fetchall()} == got


# URLs


def test_urls(frame):
    cases = {
        1: ("http://site.org/casino", "block"),
        2: ("http://site.org/casinos", "allow"),
        3: ("http://site.org/free?x=win", "block"),
        4: ("http://site.org/free/free", "allow"),
        5: ("http://middlesex.org/", "allow"),
        6: (None, "allow"),
        7: ("no url", "allow"),
        8: ("HTTP://A.Good.ORG/Porn", "allow"),
        9: ("http://good.org.bad/porn", "block"),
        10: ("http://x.good.org/worse/", "block"),
        11: ("", "allow"),
    }
    rules = {"good.org/": "allow", "good.org/worse": "block"}
    pages = frame("page_id int, url string, host string", *((i, u, "x") for i, (u, _) in cases.items()))
    got = {r.page_id: r for r in judge_urls(pages, rules).collect()}
    assert {i: got[i].verdict for i in cases} == {i: verdict for i, (_, verdict) in cases.items()}
    assert (got[8].host, got[8].path, got[8].rule) == ("a.good.org", "/Porn", "good.org/")
    assert got[10].rule == "good.org/worse" and got[6].host == got[7].path == ""
    assert judge_urls(pages.limit(0), {}).count() == 0
    assert judge_urls(pages, {}, strict=(), soft=()).where("verdict = 'block'").count() == 0


# Decontamination


@settings(max_examples=60, deadline=None)
@given(st.lists(st.lists(st.integers(1, 3), max_size=30), min_size=1, max_size=5))
def test_fm_index(texts):
    symbols = np.array([s for text in texts for s in (*text, 0)], np.int64)
    distinct = symbols + len(texts)
    distinct[symbols == 0] = np.arange(len(texts))
    rest = [tuple(distinct[i:]) for i in range(len(distinct))]
    assert suffix_order(distinct).tolist() == sorted(range(len(rest)), key=rest.__getitem__)
    index = FMIndex(symbols, 4)
    for length in (1, 2, 3):
        phrases = np.array(list(np.ndindex(*[3] * length))) + 1
        low, high = index.search(phrases)
        for phrase, lo, hi in zip(phrases.tolist(), low, high, strict=True):
            want = [i for i in range(len(symbols)) if symbols[i : i + length].tolist() == phrase]
            assert sorted(index.locate(np.arange(lo, hi)).tolist()) == want


@pytest.mark.parametrize("options", [{}, {"shard_words": 7, "block_bytes": 40}])
def test_passages(spark, frame, options):
    pick = random.Random(3)
    draw = lambda n: " ".join(pick.choice("aa Bb cc dd, ee-ff é".split()) for _ in range(n))
    items = {n: draw(pick.randrange(1, 25)) for n in range(12)} | {50: None, 51: "", 52: "..."}
    texts = {n: draw(pick.randrange(40)) for n in range(40)} | {90: None, 91: ""}
    docs = frame("doc_id int, text string, spans string, found int", *((i, t, "x", 1) for i, t in texts.items()))
    nameless = [(None, "bb cc dd"), (None, "bb cc dd"), (None, None)]
    benchmark = frame("item_id int, text string", *items.items(), (0, items[0]), *nameless)
    found = find_passages(docs, benchmark, **options)
    items = items | {"nameless": "bb cc dd"}
    found = found.withColumn("cut", cut_passages(F.col("text"), F.col("spans")))
    for row in found.collect():
        n, hit, names = brute.contamination(row.text, items)
        covered = {i for s in row.spans for i in range(s.start, s.end)}
        names = [name for name in names if name != "nameless"]
        assert (row.n_words, covered, row["items"]) == (n, hit, names)
        assert row.n_hit == len(hit)
        left = brute.contamination(row.cut, {})[0]
        assert left == n - len(hit)
        if not hit:
            assert row.cut == row.text


def test_passages_of_items_without_an_id(frame):
    docs = frame("doc_id int, text string", (1, "x bb cc dd y"), (2, "bb cc"))
    benchmark = frame("item_id int, text string", (None, "bb cc dd"), (None, "bb cc dd"), (3, "zz"))
    for options in ({}, {"block_bytes": 8}):
        found = {r.doc_id: r for r in find_passages(docs, benchmark, **options).collect()}
        assert [tuple(s) for s in found[1].spans] == [(1, 4)]
        assert (found[1].n_hit, found[1]["items"], found[2].n_hit) == (3, [], 0)


def test_passages_on_odd_tables(docs, empty, frame):
    benchmark = frame("item_id int, text string", (1, LONG[3000:3200]), (2, PROSE))
    found = {r.doc_id: r for r in find_passages(docs, benchmark).where("doc_id IS NOT NULL").collect()}
    assert found[5]["items"] == ["1"] and found[1]["items"] == found[6]["items"] == ["2"]
    assert find_passages(docs, benchmark.limit(0)).where("n_hit > 0").count() == 0
    assert find_passages(empty, benchmark).count() == 0


# Jaccard join


def near_copies(seed):
    pick = random.Random(seed)
    vocabulary = [f"w{n}" for n in range(400)]
    rows, shared = {}, [pick.choice(vocabulary) for _ in range(60)]
    for family in range(12):
        base = [pick.choice(vocabulary) for _ in range(pick.randrange(20, 120))]
        if family % 3 == 0:
            base += shared
        for _ in range(pick.choice([1, 2, 5, 40])):
            copy = list(base)
            for _ in range(pick.randrange(6)):
                copy[pick.randrange(len(copy))] = pick.choice(vocabulary)
            rows[len(rows) * 7 % 1009] = " ".join(copy)
    return rows


@pytest.mark.parametrize("seed, options", [(1, {}), (3, {"region_rows": 3}), (4, {"region_rows": 1})])
def test_groups(spark, monkeypatch, seed, options):
    from clickpulse.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "TASK_ROWS", 500)
    texts = near_copies(seed)
    df = spark.createDataFrame(list(texts.items()), "doc_id int, text string").repartition(4)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_groups(df, **options).collect()}
    assert got == brute.groups(texts)


def test_groups_from_many_batches(spark, monkeypatch):
    """A task gets its texts in many small batches."""
    texts = near_copies(5)
    df = spark.createDataFrame(list(texts.items()), "doc_id int, text string").repartition(2)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "20")
    try:
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_groups(df).collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert got == brute.groups(texts)


def test_groups_at_the_threshold(frame):
    tail = " ".join(f"t{n}" for n in range(100))
    texts = {
        1: "a b c d",
        2: "A B C D",
        3: "a b c",
        4: tail,
        # 96 shingles; one changed word at the end of k replaces k of them.
        5: tail.rsplit(" ", 13)[0],  # 83 of 96 shared: linked
        6: "x " * 40 + tail,
    }
    df = frame("doc_id int, text string, node string, key string", *((i, t, "x", "y") for i, t in texts.items()))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_groups(df).collect()}
    assert got == brute.groups(texts) and got[5][1] == 4 and got[2][1] == 1


def test_regions_end_where_no_set_reaches_the_next(spark):
    """Sizes far apart, and sets that share only a late shingle, are no candidates."""
    from clickpulse.llm.jaccard_join import _ROW, _stars

    rows = np.array(
        [(1, 10, 13, 5), (1, 13, 17, 4), (1, 18, 24, 9), (1, 20, 15, 7), (2, 10, 9, 1), (2, 10, 9, 2),
         (2, 11, 9, 3), (3, 4, 5, 6), (1, 13, 17, 4)], _ROW,
    )
    table = pa.table({"rows": [rows[:4].tobytes(), rows[4:].tobytes()], "cut": [b"", b""]})
    found = sorted(zip(*(_stars(table).column(c).to_pylist() for c in ("node", "pivot"))))
    # 10 reaches 13, 13 does not reach 18; 18 reaches 20. In region 2 nothing is reached.
    assert found == [(5, 4), (9, 7)]
    empty = _stars(table.slice(0, 0))
    assert empty.num_rows == 0 and empty.schema == _stars(table).schema


def members(sets):
    from clickpulse.llm.shingles import parities_of

    n = len(sets)
    keys = [np.array(sorted(s), np.uint64) * np.uint64(0x9E3779B97F4A7C15) for s in sets]
    return pa.table(
        {
            "p": [0] * n,
            "x": list(range(n)),
            "low": [0.0] * n,
            "high": [1.0] * n,
            "own": list(range(n)),
            "main": [n - 1] * n,
            "n": [len(s) for s in sets],
            "parities": pa.array([parities_of(k) for k in keys], pa.binary()),
        }
    )


@pytest.mark.parametrize("most", [0, 16])
def test_members_of_a_group_meet_in_few_pairs(monkeypatch, most):
    """Texts put together from shared passages: pairs grow with the texts, not their square."""
    from clickpulse.llm import jaccard_join
    from clickpulse.llm.jaccard_join import _meeting

    monkeypatch.setattr(jaccard_join, "OPEN_PAIRS", most)
    pick = random.Random(1)
    passages = [set(range(1000 * n, 1000 * n + 30)) for n in range(12)]
    nothing = pa.table({c: pa.array([], pa.int64()) for c in ("g", "x", "p")})
    for n in (100, 400):
        sets = [set.union(*pick.sample(passages, 6)) for _ in range(n)]
        found = _meeting(0.25)(members(sets), nothing)
        assert found.num_rows < max(1, most) * n
        assert set(found.column("all").to_pylist()) <= {most > 0}
        side = list(range(n))
        for x, p in zip(found.column("x").to_pylist(), found.column("p").to_pylist()):
            old, new = side[x], side[p]
            side = [new if s == old else s for s in side]
        for i in range(0, n, 7):
            for j in range(i):
                if 4 * len(sets[i] & sets[j]) >= 3 * len(sets[i] | sets[j]):
                    assert side[i] == side[j]


def test_pairs_that_were_tried_do_not_meet_again(monkeypatch):
    from clickpulse.llm import jaccard_join
    from clickpulse.llm.jaccard_join import _meeting

    monkeypatch.setattr(jaccard_join, "OPEN_PAIRS", 0)

    sets = [set(range(40)), set(range(1, 41)), set(range(2, 42))]
    first = _meeting(0.25)(members(sets), pa.table({c: pa.array([], pa.int64()) for c in "gxp"}))
    again = _meeting(0.25)(members(sets), first)
    pairs = lambda t: set(zip(t.column("x").to_pylist(), t.column("p").to_pylist()))
    assert len(pairs(first)) == 2 and not pairs(first) & pairs(again) and len(pairs(again)) == 1


@pytest.mark.parametrize("most", [0, 1])
def test_groups_when_bounds_tell_nothing(spark, monkeypatch, most):
    """All pairs seem near, so many are refuted and regions meet again and again."""
    from clickpulse.llm import jaccard_join

    monkeypatch.setattr(jaccard_join, "OPEN_PAIRS", most)
    monkeypatch.setattr(jaccard_join, "parities_of", lambda keys: bytes(64))
    pick = random.Random(8)
    shared = [f"s{n}" for n in range(30)]
    texts = {}
    for family in range(4):
        base = shared + [f"f{family}x{n}" for n in range(25)]
        for _ in range(3):
            copy = list(base)
            copy[pick.randrange(35, 55)] = f"y{len(texts)}"
            texts[len(texts)] = " ".join(copy)
    df = spark.createDataFrame(list(texts.items()), "doc_id int, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in similar_groups(df).collect()}
    assert got == brute.groups(texts) and len({c for _, c in got.values()}) > 1


def test_groups_of_odd_rows(docs, empty):
    groups = similar_groups(docs)
    rows = groups.collect()
    assert len(rows) == docs.count() and similar_groups(empty).count() == 0
    by_id = {r.doc_id: r for r in rows}
    assert by_id[2].n_shingles == by_id[3].n_shingles == by_id[4].n_shingles == 0
    assert [by_id[i].component_id for i in (2, 3, 4, 5)] == [2, 3, 4, 5]
    assert by_id[6].component_id == 1 and by_id[5].n_shingles == 59_996
    kept = keep_one(docs, groups)
    assert kept.columns == docs.columns
    ids = sorted((r.doc_id for r in kept.collect()), key=repr)
    assert ids == sorted([1, 2, 3, 4, 5, 7, None, None], key=repr)


def test_components(frame):
    edges = [(1, 2), (3, 2), (3, 4), (10, 11), (11, 12), (5, 5), (9, 4)]
    chain = [(100 + n, 101 + n) for n in range(60)]
    found = dict(map(tuple, components(frame("a int, b int", *edges, *chain)).collect()))
    assert {found[n] for n in (1, 2, 3, 4, 9)} == {1} and {found[n] for n in (10, 11, 12)} == {10}
    assert {found[n] for n in range(100, 161)} == {100}


# Pages


def test_page_parts():
    html = """<html><head><title>t</title><style>x</style></head><body class="has-sidebar">
    <nav>Menu<li>one</nav><div class="cookie-notice">We use cookies</div><div class=ad>Buy</div>
    <article><header><h1>Head &amp; line</h1></header><p>First <b>bold<i> text</p> tail<br>more
    <script>var t="</p>";</script><form>Name</form><aside>Side</aside>
    <div id="comments"><article>Comment</article></div><ul><li>Point</ul>
    </article><div>Other &lt;tag&gt;</div><footer>Foot<p>er</footer></body>"""
    lines = page_lines(html)
    assert main_text(lines, []) == "Head & line\nFirst bold text\ntail more\nPoint"
    assert [line for line, part in lines if part == 1] == ["Other <tag>"]
    assert main_text(page_lines("<nav>Menu<article><p>Text"), []) == "Text"


def test_class_words_only_choose_between_parts():
    text = lambda html: main_text(page_lines(html), [])
    menu = "<nav>Menu</nav>"
    assert text(f"{menu}<article class='post category-social'><p>All of it</article>") == "All of it"
    assert text(f"{menu}<main id=legal><p>Terms</main><div class=ad>Buy</div>") == "Terms"
    assert text(f"{menu}<div class='post tags'><p>All of it</div>") == "All of it"
    # Where another part is left, they still count; what is hidden never does.
    both = "<article><p>Story</article><section><article class=comment><p>Nice</article></section>"
    assert text(menu + both) == "Story"
    assert text(f"{menu}<div>Text</div><div class=tags>a b</div>") == "Text"
    assert text("<article hidden>Old</article><article class=ad style='display: none'>x</article>") == ""


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(0, 4), max_size=25), st.lists(st.integers(0, 4), max_size=25))
def test_shared_lines_are_a_longest_common_subsequence(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best = max(table[i][j + 1], table[i + 1][j])
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else best
    found = shared_lines(a, b)
    assert found == sorted(set(found)) and len(found) == table[-1][-1]
    rest = iter(b)
    assert all(a[i] in rest for i in found)


def test_shared_lines():
    assert shared_lines(list("abcde"), list("xbxdex")) == [1, 3, 4]
    assert shared_lines([], ["a"]) == shared_lines(["a"], []) == []


def test_pages_without_article(frame):
    page = lambda body: f"<body><div>Site name</div><div>{body}</div><div>Write to us</div></body>"
    rows = [
        (1, "http://h.org/a/1", page("About apples, a long and unique line of text.")),
        (2, "http://h.org/a/2", page("About pears, another long and unique line of text.")),
        (3, "http://h.org/a/2", page("About pears, another long and unique line of text.")),
        (4, "http://other.org/", page("Alone on its host.")),
        (5, None, None),
        (6, "http://h.org/a/1", ""),
        (None, "x", "<p>y"),
    ]
    df = frame("page_id int, url string, html string, text string", *((*r, "old") for r in rows)).repartition(3)
    got = {r.page_id: r for r in extract_pages(df).collect()}
    assert got[1].text == "About apples, a long and unique line of text."
    assert got[2].text == got[3].text == "About pears, another long and unique line of text."
    assert got[4].text == "Site name\nAlone on its host.\nWrite to us"
    assert (got[5].text, got[5].n_chars, got[6].text, got[None].text) == ("", 0, "", "y")
    assert extract_pages(df.limit(0)).count() == 0


def test_differencing_of_pages_with_article(frame):
    page = lambda n: (
        f"<div>Site name</div><h1>Headline {n}</h1><article><p>A passage of two pages.</p>"
        f"<p>Own text of page {n}.</p></article><div>Text outside of {n}.</div><div>Write to us</div>"
    )
    teaser = (
        "<div>Site name</div><div>A long text of its own in an element that marks nothing.</div>"
        "<article>Teaser</article><div>Write to us</div>"
    )
    menu = "<div>" + "</div><div>".join(f"A long menu entry {n}" for n in range(50)) + "</div>"
    rows = [
        (1, "http://h.org/a/1", page(1)),
        (2, "http://h.org/a/2", page(2)),
        (3, "http://h.org/b", teaser),
        (4, "http://menu.org/1", menu + "<article>Short one.</article>"),
        (5, "http://menu.org/2", menu + "<article>Short two.</article>"),
    ]
    df = frame("page_id int, url string, html string", *rows)
    got = {r.page_id: r.text for r in extract_pages(df).collect()}
    for n in (1, 2):
        assert got[n] == f"Headline {n}\nA passage of two pages.\nOwn text of page {n}.\nText outside of {n}."
    assert got[3] == "A long text of its own in an element that marks nothing.\nTeaser"
    assert (got[4], got[5]) == ("Short one.", "Short two.")


def test_ranges_of_pages_do_not_matter(spark, frame, monkeypatch):
    from clickpulse.llm import page_differencing

    page = lambda n: f"<div>Site</div><div>Text of page {n} is its own</div><div>Imprint {n % 2}</div>"
    df = frame("page_id int, url string, html string", *((n, f"http://h.org/{n // 3}/{n}", page(n)) for n in range(60)))
    want = sorted(map(tuple, extract_pages(df).collect()))
    monkeypatch.setattr(page_differencing, "RANGE_BYTES", 300)
    assert sorted(map(tuple, extract_pages(df.repartition(5)).collect())) == want


# Languages


def test_code_switched_words(spark, frame):
    english = "the cat sat on the mat with another white thing while they were thinking of this"
    german = "der hund und die katze gehen nicht über die straße weil sie keine zeit haben"
    model = train([("en", english + " " + english)] * 5 + [("de", german + " " + german)] * 5)
    mixed = "the white cat and that thing die katze und der hund"
    df = frame("id int, text string, words string", (1, mixed, "x"), (2, None, "x"), (3, "12 !", "x"))
    got = {r.id: r for r in label_words(df, model).collect()}
    assert got[1].words == mixed.split()
    assert got[1].word_langs == ["en"] * 6 + ["de"] * 5
    assert got[2].words == got[3].word_langs == []


def test_words_are_letters_with_their_marks():
    assert WORD.findall("½ ② Ⅷ ٣ 42 _ !") == []
    assert WORD.findall("हिन्दी, re\u0301sume\u0301 don't x2y") == [
        "हिन्दी", "re\u0301sume\u0301", "don", "t", "x", "y",
    ]


def test_languages_of_rows_with_one_id(spark):
    rows = [(7, f"the cat number {n} sat on the mat", "en") for n in range(900)]
    rows += [(7, "der hund und die katze", "de")] * 900
    df = spark.createDataFrame(rows, "doc_id int, text string, lang string")
    model = fit_languages(df, sample_docs=20)
    assert model.languages == ["de", "en"]
    got = {r.text: r.lang_pred for r in identify_languages(df, model).distinct().collect()}
    assert got["der hund und die katze"] == "de" and got[rows[0][1]] == "en"


@pytest.mark.parametrize("seed", range(5))
def test_forward_backward_against_all_paths(seed):
    """Probabilities of labels are sums over all ways to label a short text."""
    rng = np.random.default_rng(seed)
    kinds, lengths = 3, np.array([4, 1, 6, 2])
    model = Model(
        ["a", "b", "c"],
        np.zeros((1, kinds), np.float32),
        rng.normal(size=kinds).astype(np.float32),
        rng.normal(size=(kinds, kinds)).astype(np.float32),
    )
    scores = rng.normal(size=(lengths.sum(), kinds)).astype(np.float32)
    packed = Packed(lengths)
    found = np.empty_like(scores)
    found[packed.source] = posteriors(model, scores[packed.source], packed)
    begin = 0
    for n in lengths:
        own = scores[begin : begin + n].astype(float)
        want = np.zeros((n, kinds))
        for path in np.ndindex(*[kinds] * n):
            value = model.start[path[0]] + sum(own[t, k] for t, k in enumerate(path))
            value += sum(model.change[a, b] for a, b in zip(path, path[1:]))
            for t, k in enumerate(path):
                want[t, k] += np.exp(value)
        want /= want.sum(axis=1, keepdims=True)
        assert np.allclose(found[begin : begin + n], want, atol=1e-4)
        begin += n


def test_languages_of_odd_rows(docs, empty, spark):
    model = fit_languages(docs)
    assert model.languages == ["en"]
    found = identify_languages(docs, model)
    by_text = {r.text: (r.lang_pred, r.score) for r in found.collect()}
    assert by_text[None] == by_text[""] == by_text["123 456 !!"] == ("und", 0.0)
    assert by_text[LONG] == ("en", 1.0)
    assert identify_languages(empty, model).count() == 0
    nothing = fit_languages(empty)
    assert {r.lang_pred for r in identify_languages(docs, nothing).collect()} == {"und"}


# Tokens


@settings(max_examples=40, deadline=None)
@given(st.integers(0, 3000), st.integers(1, 400), st.integers(0, 10**6))
def test_coder_round_trip(n, kinds, seed):
    rng = np.random.default_rng(seed)
    ids = rng.integers(0, kinds, n) ** 2 % 49408
    block = encode_block(ids, 49408)
    assert decode_block(block).tolist() == ids.tolist()
    damaged = bytearray(block)
    damaged[int(rng.integers(len(block)))] ^= 1 << int(rng.integers(8))
    for wrong in (bytes(damaged), block[:-1], b""):
        with pytest.raises(ValueError):
            decode_block(wrong)


@pytest.mark.parametrize("vocabulary", [49408, 65536])
def test_coder_uses_narrow_numbers_with_the_highest_ids(vocabulary, monkeypatch):
    rng = np.random.default_rng(4)
    ids = np.concatenate([vocabulary - 1 - rng.integers(0, 9, 40_000) ** 2, rng.integers(0, vocabulary, 9000)])
    seen = []

    class Model(range_coder._Model):
        def learn(self, *given):
            seen.append({values.itemsize for values in (*self.seen, self.one_seen, self.two_seen)})
            super().learn(*given)

    monkeypatch.setattr(range_coder, "_Model", Model)
    assert decode_block(encode_block(ids, vocabulary)).tolist() == ids.tolist()
    assert {size for sizes in seen for size in sizes} == {4}


def test_contexts_learn_from_each_id():
    """Every confidence, with the same id and another one, against the rule in plain Python."""
    old = np.array([16 * i + c for i in (0, 3, 65535) for c in range(16)] * 3, np.int32)
    fresh = np.repeat(np.array([0, 3, 65535], np.int32), 48) << 4

    def rule(state, new):
        seen, trust = divmod(state, 16)
        if seen * 16 == new and trust:
            return state + (trust < 15)
        return seen * 16 + trust // 2 if trust > 1 else new + 1

    want = [rule(int(o), int(f)) for o, f in zip(old, fresh, strict=True)]
    assert range_coder._followed(old, fresh).tolist() == want


def test_coder_learns():
    pattern = np.tile(np.arange(500) * 97 % 49408, 200)
    assert len(encode_block(pattern, 49408)) < len(pattern) / 2
    constant = np.full(50_000, 7)
    block = encode_block(constant, 49408)
    assert decode_block(block).tolist() == constant.tolist() and len(block) < 8000


@settings(max_examples=60, deadline=None)
@given(st.text(st.sampled_from("aA bB'stré.,!?\n\t́İΣς\x1c½1٣- <|endoftext>ß"), max_size=60))
def test_pieces_have_the_ids_of_the_text(text):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    want = tokenizer.encode(text, add_special_tokens=False).ids
    assert _Ids(tokenizer, 2).of([text, None])[0].tolist() == [*want, 2]


@pytest.mark.parametrize(
    "text",
    [
        "ALİ,", "İ.", "ALİ ALİ, İ!?", "\u0958,", "\u0915\u095b.", "\u095f;", "\ufb2a,",
        "\u05d0\ufb4b.", "E\u0301,", "é, É.", "½. ²,", "Ⅷ: Ⓐ;", "ﬁ.", "ẞ!", "가.", "我们,",
    ],
)
def test_marks_behind_letters_that_come_apart(text):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    want = tokenizer.encode(text, add_special_tokens=False).ids
    assert _Ids(tokenizer, 2).of([text])[0].tolist() == [*want, 2]


def test_a_word_is_tokenized_once_in_any_case_and_with_any_marks():
    tokenizer = Tokenizer.from_file(VOCABULARY)
    ids = _Ids(tokenizer, 2)
    texts = ["Straße, STRAßE $$$ straße$$$ (no", "straße! Straße&&&", None, "", "  "]
    want = [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]
    assert [x.tolist() for x in ids.of(texts)] == want
    known = ids.known.to_pylist()
    assert [w for w in known if w.lower().startswith("stra")] == ["straße"] and len(known) == len(set(known))
    before = len(known)
    assert [x.tolist() for x in ids.of(texts)] == want and len(ids.known) == before


def test_a_full_memory_keeps_words_that_come_again(monkeypatch):
    monkeypatch.setattr(token_files, "_REMEMBERED", 20)
    tokenizer = Tokenizer.from_file(VOCABULARY)
    ids = _Ids(tokenizer, 2)
    fresh = []
    one_by_one, in_rows = ids._one_by_one, ids._in_rows
    monkeypatch.setattr(ids, "_one_by_one", lambda words: fresh.extend(words) or one_by_one(words))
    monkeypatch.setattr(ids, "_in_rows", lambda words: fresh.extend(words.to_pylist()) or in_rows(words))
    letters = "abcdefghijklmnopqrstuvwxyz"
    rare = [" ".join(f"{a}{b}x{a}" for b in letters[:9]) for a in letters]
    for words in rare:
        text = f"often {words}, again 我们 {words}!"
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert ids.of([text])[0].tolist() == [*want, 2]
        assert len(ids.known) <= 20 + 13 and len(ids.again) == len(ids.known) == len(ids.begin) - 1
    assert all(fresh.count(word) == 1 for word in ("often", "again", "我们"))
    # Where all words come again they are too many to keep.
    everything = " ".join(rare)
    for _ in range(3):
        want = tokenizer.encode(everything, add_special_tokens=False).ids
        assert ids.of([everything])[0].tolist() == [*want, 2]
    assert len(ids.known) == 9 * 26 + 1


@pytest.mark.parametrize("added", ["ae", "a!", "!!"])
def test_added_tokens_inside_words(added):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    tokenizer.add_tokens([AddedToken(added, normalized=False)])
    text = "The aerie and a maestro Ae ae"
    want = tokenizer.encode(text, add_special_tokens=False).ids
    assert _Ids(tokenizer, 2).of([text])[0].tolist() == [*want, 2]


def test_texts_in_chunks(monkeypatch):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    monkeypatch.setattr(token_files, "_CHUNK_BYTES", 50)
    monkeypatch.setattr(token_files, "_LAID", 2)
    monkeypatch.setattr(token_files, "_REMEMBERED", 30)
    texts = [None, "", PROSE, None, PROSE * 2, "", "x y", "x y", *(f"w{n} v{n}!" for n in range(60))]
    batch = pa.RecordBatch.from_pydict({"text": pa.array(texts, pa.string())})
    chunks = list(token_files._chunks(batch))
    assert len(chunks) > 5 and sum(c.num_rows for c in chunks) == len(texts)
    ids = _Ids(tokenizer, 2)
    found = [x.tolist() for c in chunks for x in ids.of(c.column("text"))]
    assert found == [tokenizer.encode(t or "", add_special_tokens=False).ids + [2] for t in texts]


@given(st.binary(max_size=40), st.binary(max_size=40))
def test_joined_checksums(a, b):
    import zlib

    assert join_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def test_token_files_of_odd_rows(spark, docs, empty, tmp_path):
    path = str(tmp_path / "tokens")
    write_tokens(docs, path, VOCABULARY, 2, block_ids=15_000, file_bytes=100_000)
    rows = sorted(((r.doc_id, r.text) for r in docs.collect()), key=lambda r: (r[0] is not None, r[0], r[1] is not None, r[1]))
    want = list(brute.index(rows, Tokenizer.from_file(VOCABULARY)))
    got = sorted((tuple(r) for r in token_index(spark, path).collect()), key=lambda r: r[1])
    assert got == want
    pieces = read_tokens(spark, path).where("doc_id = 5").orderBy("block").collect()
    assert len(pieces) > 5 and sum(len(p.ids) for p in pieces) == dict((r[0], r[2]) for r in want)[5]
    write_tokens(empty, str(tmp_path / "none"), VOCABULARY, 2)
    assert token_index(spark, str(tmp_path / "none")).count() == 0
