"""Exact similarity join of texts by the Jaccard distance of their shingle sets.

Distance 1 - |x & y| / |x | y| is a metric. The join works on distinct sets (nodes):

1. Pivots are the shingles themselves, as sets of one element; a set is nearest to the
   pivots it contains. In a fixed order of all shingles, rare before frequent, the region
   of a pivot takes every set that has it among its first floor(d * n) + 1 shingles: a set
   within distance d misses at most floor(d * n) of the n shingles, so it shares a region.
2. A region is cut where sizes leave a gap: with this shingle as the first that two sets
   share, too few are left in both for a link. Each part gets a document pivot p, its
   smallest node. Small sketches bound the distance of every member to p from below; where
   the bound leaves a link open, the whole sets give the exact distance. Members within d
   are linked to p.
3. By the triangle inequality a pair with |d(x, p) - d(y, p)| > d has no link, and pairs in
   one component add nothing. Members outside p's component meet each other and the members
   inside their window. All pairs that bounds leave open are measured where they are few; of
   a region with many only those that would join components, the closest first: fewer
   than members. Where one of these turns out to be no link, its region meets again
   without it, until none is left.

A region of more than `region_rows` sets is cut by node into several, with a pivot each.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.components import components
from clickpulse.llm.frames import Input, Steps, durable, tidy
from clickpulse.llm.shingles import least_distance, node_of, parities_of, shingle_sets, sketch_of

#: Counts below this within one batch of texts are dropped while frequent shingles are
#: counted, so a count is short by less than this for each batch.
COUNT_FLOOR = 4
#: The most frequent shingles that the order of shingles knows; others come before them by
#: hash. The order decides the cost of the join, never its result.
FREQUENT = 1 << 18
#: Rows of regions that one task joins, on average.
TASK_ROWS = 1 << 19
#: Bits of the bitmap of wanted nodes; a bit that is shared only costs time.
_MAP_BITS = 1 << 26
_MAP_WIDTH = 1 << 15
#: A set in a region: half of the pivot's hash, the set's size, the largest size it can be
#: linked to there, and its node. Pivots with equal halves share a region; that costs time.
_ROW = np.dtype([("key", "<u4"), ("n", "<u4"), ("most", "<u4"), ("node", "<i8")])
#: Open pairs per member of a region up to which all of them are measured at once.
OPEN_PAIRS = 16
#: Distances are ratios of small whole numbers; this only absorbs their rounding.
_SLACK = 1e-9


def _scan(width: int):
    """Per text its set's size, node and sketch; per batch the shingles of many of its sets."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1), width)
            nodes = [node_of(s) if len(s) else None for s in sets]
            n = len(sets)
            nulls = lambda kind, size: pa.nulls(size, kind)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(2),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array(nodes, pa.int64()),
                    pa.array([sketch_of(s) if len(s) else None for s in sets], pa.binary()),
                    nulls(pa.int64(), n),
                    nulls(pa.int64(), n),
                ],
                names=["id", "hash", "n", "node", "sketch", "key", "count"],
            )
            different = list(dict(zip(nodes, sets, strict=True)).values())
            keys = np.sort(np.concatenate([*different, np.empty(0, np.uint64)]))
            if len(keys) < COUNT_FLOOR:
                continue
            begin = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
            counts = np.diff(np.append(begin, len(keys)))
            often = counts >= COUNT_FLOOR
            m = int(often.sum())
            yield pa.RecordBatch.from_arrays(
                [
                    nulls(batch.schema.field(0).type, m),
                    nulls(pa.int64(), m),
                    nulls(pa.int64(), m),
                    nulls(pa.int64(), m),
                    nulls(pa.binary(), m),
                    pa.array(keys[begin[often]].view(np.int64)),
                    pa.array(counts[often].astype(np.int64)),
                ],
                names=["id", "hash", "n", "node", "sketch", "key", "count"],
            )

    return scan


def _first_keys(keys: np.ndarray, size: int, frequent: np.ndarray, rank: np.ndarray) -> np.ndarray:
    """The first `size` keys of a set in the order of all shingles."""
    if len(frequent):
        at = np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)
        known = frequent[at] == keys
        if known.any():
            return keys[np.argsort(np.where(known, rank[at], 0), kind="stable")[:size]]
    return keys[:size]


def _regions(order, width: int, share: float, buckets: int, region_rows: int):
    """Rows of all regions, packed, one row per bucket and batch: `rows`, and `cut`.

    `cut` has (key, node, part) for regions cut by node.
    """
    # A link needs this many shared shingles per shingle of both sets.
    needed = (1 - share) / (2 - share)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, rank = order.value
        for batch in batches:
            sets = shingle_sets(batch.column(0), width)
            different = {node_of(s): s for s in sets if len(s)}
            firsts = [
                _first_keys(s, math.floor(len(s) * share + 1e-9) + 1, frequent, rank)
                for s in different.values()
            ]
            if not firsts:
                continue
            keys = np.concatenate(firsts)
            length = np.array([len(f) for f in firsts])
            n = np.repeat(np.array([len(s) for s in different.values()]), length)
            nodes = np.repeat(np.array(list(different), np.int64), length)
            # What comes before a key in the order is not shared if the key is the first.
            before = np.arange(len(keys)) - np.repeat(np.cumsum(length) - length, length)
            part, parts = np.zeros(len(keys), np.uint64), np.ones(len(keys), np.uint64)
            if len(frequent):
                at = np.minimum(np.searchsorted(frequent, keys), len(frequent) - 1)
                many = np.where(frequent[at] == keys, rank[at] // region_rows + 1, 1)
                parts = many.astype(np.uint64)
                part = nodes.view(np.uint64) % parts
            bucket = ((keys + part * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(buckets)).astype(
                np.int64
            )
            rows = np.empty(len(keys), _ROW)
            rows["key"], rows["n"], rows["node"] = keys >> np.uint64(32), n, nodes
            rows["most"] = np.maximum(np.floor((n - before) / needed + 1e-6) - n, 0)
            cut = np.stack([keys.view(np.int64), nodes, part.view(np.int64)], axis=1)
            which = np.unique(bucket)
            packed = [
                pa.array(_packed(kind[chosen], bucket[chosen], which), pa.binary())
                for kind, chosen in ((rows, parts == 1), (cut, parts > 1))
            ]
            yield pa.RecordBatch.from_arrays(
                [pa.array(which, pa.int64()), *packed], names=["bucket", "rows", "cut"]
            )

    return spread


def _packed(rows: np.ndarray, bucket: np.ndarray, which: np.ndarray) -> list[bytes]:
    """The rows of each bucket in turn."""
    by = np.argsort(bucket, kind="stable")
    edges = np.searchsorted(bucket[by], which)
    return [part.tobytes() for part in np.split(rows[by], edges[1:])]


def _stars(table: pa.Table) -> pa.Table:
    """Members and pivots of one bucket's regions with two sets or more, each pair once.

    Rows of regions cut in several keep their key, and are kept even alone in a part.
    """
    rows = np.frombuffer(b"".join(table.column("rows").to_pylist()), _ROW)
    rows = rows[np.lexsort((rows["node"], rows["n"], rows["key"]))]
    key, node = rows["key"].astype(np.int64), rows["node"]
    rows = rows[_new(key, node)]
    key, node, n = rows["key"].astype(np.int64), rows["node"], rows["n"].astype(np.int64)
    # Sizes rise within a key: a part ends where no set before it reaches up to the next size.
    first = _new(key)
    reach = np.maximum.accumulate((np.cumsum(first) << 32) | rows["most"].astype(np.int64)) & 0xFFFFFFFF
    first[1:] |= reach[:-1] < n[1:]
    begin = np.flatnonzero(first)
    pivot = np.minimum.reduceat(node, begin) if len(node) else node
    pivot = np.repeat(pivot, np.diff(np.append(begin, len(node))))
    whole = np.stack([node, pivot], axis=1)[node != pivot]
    whole = np.unique(whole, axis=0)

    cut = np.frombuffer(b"".join(table.column("cut").to_pylist()), np.int64).reshape(-1, 3)
    cut = np.unique(cut[:, [0, 2, 1]], axis=0)
    begin = np.flatnonzero(_new(cut[:, 0], cut[:, 1]))
    heads = np.repeat(cut[begin, 2], np.diff(np.append(begin, len(cut))))
    return pa.table(
        {
            "key": pa.concat_arrays([pa.nulls(len(whole), pa.int64()), pa.array(cut[:, 0])]),
            "node": np.append(whole[:, 0], cut[:, 2]),
            "pivot": np.append(whole[:, 1], heads),
        }
    )


def _new(*columns: np.ndarray) -> np.ndarray:
    """Whether a row differs from the one before it."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return new


def _wanted(texts: DataFrame, rows: DataFrame, nodes: DataFrame, width: int, whole: bool) -> DataFrame:
    """(node, n, keys, parities) of the wanted nodes, and of few others.

    With `whole` the keys of the sets, else their parities. Only texts (text, hash) are
    looked at whose hash belongs to a wanted node, by a bitmap of fixed size. Repeated
    texts may repeat.
    """
    wanted = rows.join(nodes, "node", "left_semi")
    place = F.pmod(F.col("hash"), F.lit(_MAP_BITS)) + 1
    maps = (
        wanted.select(place.alias("place"))
        .groupBy(F.bitmap_bucket_number("place").alias("at"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits"))
        .collect()
    )
    bits = np.zeros(_MAP_BITS // 8, np.uint8)
    for row in maps:
        start = (row["at"] - 1) * (_MAP_WIDTH // 8)
        bits[start : start + len(row["bits"])] = np.frombuffer(row["bits"], np.uint8)
    bitmap = texts.sparkSession.sparkContext.broadcast(bits)

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = bitmap.value
        for batch in batches:
            at = batch.column(1).to_numpy() % _MAP_BITS
            some = np.flatnonzero(wanted[at >> 3] >> (at & 7).astype(np.uint8) & 1)
            chosen = batch.column(0).take(pa.array(some))
            sets = [keys for keys in shingle_sets(chosen, width) if len(keys)]
            found = {node_of(keys): keys for keys in sets}
            keys = [s.view(np.int64) if whole else None for s in found.values()]
            bits = [None if whole else parities_of(s) for s in found.values()]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(list(found), pa.int64()),
                        pa.array([len(s) for s in found.values()], pa.int64()),
                        pa.array(keys, pa.list_(pa.int64())),
                        pa.array(bits, pa.binary()),
                    ],
                    names=["node", "n", "keys", "parities"],
                )

    shape = "node long, n long, keys array<long>, parities binary"
    return texts.select("text", "hash").mapInArrow(tidy(pick), shape)


def _exact(texts: DataFrame, pairs: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """The exact distance d of pairs (x, p)."""
    nodes = pairs.select(F.explode(F.array("x", "p")).alias("node")).distinct()
    # Copies of a text may give its set many times.
    sets = _wanted(texts, rows, nodes, width, whole=True).dropDuplicates(["node"])
    left = sets.select(F.col("node").alias("x"), F.col("keys").alias("kx"))
    right = sets.select(F.col("node").alias("p"), F.col("keys").alias("kp"))
    both = pairs.join(left, "x").join(right, "p")
    shared = F.size(F.array_intersect("kx", "kp"))
    distance = 1 - shared / (F.size("kx") + F.size("kp") - shared)
    return both.select("x", "p", distance.alias("d")).groupBy("x", "p").agg(F.min("d").alias("d"))


def _measured(
    written: Steps,
    texts: DataFrame,
    pairs: DataFrame,
    rows: DataFrame,
    sketches: DataFrame,
    width: int,
    near: float,
) -> DataFrame:
    """Pairs (x, p) with bounds low and high of their distance.

    Both are the exact distance where it may be `near` or less.
    """

    def bound(a: pa.Array, n_a: pa.Array, b: pa.Array, n_b: pa.Array) -> pa.Array:
        rows = zip(*(c.to_pylist() for c in (a, n_a, b, n_b)), strict=True)
        return pa.array([least_distance(*row) for row in rows], pa.float64())

    of = lambda side: sketches.select(
        F.col("node").alias(side), F.col("sketch").alias(f"s_{side}"), F.col("n").alias(f"n_{side}")
    )
    low = F.arrow_udf(bound, "double")("s_x", "n_x", "s_p", "n_p")
    bounded = pairs.join(of("x"), "x").join(of("p"), "p").select("x", "p", low.alias("low"))
    bounded = written(bounded)
    exact = _exact(texts, bounded.where(F.col("low") <= near).select("x", "p"), rows, width)
    return bounded.join(exact, ["x", "p"], "left").select(
        "x", "p", F.coalesce("d", "low").alias("low"), F.coalesce("d", F.lit(1.0)).alias("high")
    )


def similar_groups(
    docs: DataFrame,
    similarity: float = 0.75,
    width: int = 5,
    region_rows: int = 100_000,
    id: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Link texts of Jaccard similarity `similarity` or more, and group what links reach.

    Returns one row per document with its id, n_shingles (distinct shingles of `width`
    words, A-Z lower-cased; a shorter text has one) and component_id (the smallest id that
    links reach). A null text or one without words has no shingles, links to nothing and is
    a component by itself. Repeated rows and equal texts are in one component; null ids are
    never the smallest, and a component of null ids alone has a null component_id. Other
    columns of the input are not read. An empty table gives an empty table.

    Sets are told apart by 64-bit hashes of 64-bit shingle hashes.
    """
    distance = 1 - similarity
    near = distance + _SLACK
    written = Steps(docs.sparkSession)
    given = Input(docs)
    body = given.frame.select(given[text].cast("string").alias("text"))
    named = given.frame.select(
        given[id].alias("id"),
        given[text].cast("string").alias("text"),
        F.xxhash64(given[text].cast("string")).alias("hash"),
    )
    kind = named.schema["id"].dataType.simpleString()
    schema = f"id {kind}, hash long, n long, node long, sketch binary, key long, count long"
    scanned = written(named.mapInArrow(tidy(_scan(width)), schema))
    rows = scanned.where("key IS NULL").select("id", "hash", "n", "node")
    filled = scanned.where("node IS NOT NULL")
    sketches = filled.groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))

    often = scanned.where("key IS NOT NULL").groupBy("key").agg(F.sum("count").alias("count"))
    top = often.orderBy(F.desc("count"), "key").limit(FREQUENT).toArrow()
    keys = top.column("key").to_numpy().astype(np.int64).view(np.uint64)
    by = np.argsort(keys)
    counts = top.column("count").to_numpy().astype(np.int64)
    order = docs.sparkSession.sparkContext.broadcast((keys[by], counts[by]))

    total = rows.agg(F.sum("n")).head()[0] or 0
    buckets = max(1, math.ceil(total * distance / TASK_ROWS))
    spread = _regions(order, width, distance, buckets, region_rows)
    packed = body.mapInArrow(tidy(spread), "bucket long, rows binary, cut binary")
    shape = "key long, node long, pivot long"
    regions = written(packed.groupBy("bucket").applyInArrow(_stars, shape))

    # Regions cut in several have a pivot in each part; the smallest stands for all.
    cut = regions.where("key IS NOT NULL")
    heads = cut.groupBy("key").agg(F.min("pivot").alias("head"))
    whole = cut.join(heads, "key")
    between = whole.select(F.col("pivot").alias("x"), F.col("head").alias("p"))
    stars = regions.select(F.col("node").alias("x"), F.col("pivot").alias("p"))
    stars = stars.unionByName(between).where("x <> p").distinct()
    measured = written(_measured(written, named, stars, rows, sketches, width, near))
    links = measured.where(F.col("high") <= near).select(F.col("x").alias("a"), F.col("p").alias("b"))
    labels = components(links)

    # In a region cut in several, distances are to different pivots and prove nothing.
    loose = whole.select(
        F.col("node").alias("x"), F.col("head").alias("p"), F.lit(0.0).alias("low"), F.lit(1.0).alias("high")
    )
    members = _unresolved(written, measured.unionByName(loose.distinct()), labels, near)
    nodes = members.select(F.col("x").alias("node")).distinct()
    fine = _wanted(named, rows, nodes, width, whole=False).dropDuplicates(["node"])
    fine = written(fine.select(F.col("node").alias("x"), "n", "parities"))
    tried = docs.sparkSession.createDataFrame([], "g long, x long, p long")
    while True:
        met = members.join(fine, "x").groupBy("p").cogroup(tried.groupBy("g"))
        more = written(met.applyInArrow(_meeting(near), "g long, x long, p long, all boolean"))
        if not more.head(1):
            break
        found = written(_exact(named, more.select("x", "p").distinct(), rows, width))
        labels = _merged(written, labels, found.where(F.col("d") <= near))
        refuted = more.where("NOT all").join(found.where(F.col("d") > near), ["x", "p"])
        refuted = refuted.select("g", "x", "p")
        if not refuted.head(1):
            break
        tried = written(tried.unionByName(refuted))
        again = members.join(refuted.select(F.col("g").alias("p")).distinct(), "p", "left_semi")
        members = written(_apart(again.select("x", "p", "low", "high"), labels))

    marked = rows.join(labels, "node", "left")
    marked = durable(marked.select("id", "n", F.coalesce("label", "node").alias("label")))
    written.remove()
    least = marked.groupBy("label").agg(F.min("id").alias("least"))
    joined = marked.join(least.where("label IS NOT NULL"), "label", "left")
    alone = F.when(F.col("label").isNull(), F.col("id")).otherwise(F.col("least"))
    return joined.select(
        F.col("id").alias(id), F.col("n").alias("n_shingles"), alone.alias("component_id")
    )


def _merged(written: Steps, labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels after more links (x, p): the components themselves are linked, each pair once."""
    of = lambda name: labels.select(F.col("node").alias(name), F.col("label").alias(f"l_{name}"))
    ends = links.join(of("x"), "x", "left").join(of("p"), "p", "left")
    linked = ends.select(
        F.coalesce("l_x", "x").alias("a"), F.coalesce("l_p", "p").alias("b")
    ).distinct()
    merged = components(linked)
    renamed = merged.select(F.col("node").alias("label"), F.col("label").alias("new"))
    known = labels.join(renamed, "label", "left").select("node", F.coalesce("new", "label").alias("label"))
    return written(known.unionByName(merged.join(labels, "node", "left_anti")))


def _apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of pivots' groups that are not all in one component, with theirs (own).

    The largest component of a group is its main one.
    """
    of = labels.select(F.col("node").alias("x"), F.col("label").alias("own"))
    members = members.join(of, "x", "left").withColumn("own", F.coalesce("own", "x"))
    sizes = members.groupBy("p", "own").agg(F.count("*").alias("n"))
    main = sizes.groupBy("p").agg(
        F.max_by("own", F.struct("n", "own")).alias("main"), F.count("*").alias("parts")
    )
    # Most groups lie in one component.
    return members.join(main.where("parts > 1").drop("parts"), "p")


def _unresolved(
    written: Steps, measured: DataFrame, labels: DataFrame, near: float
) -> DataFrame:
    """Members of pivots' groups that may be linked to others, as far as pivots can tell.

    A pivot's group is the members of all its regions, with their distances to it. Its
    largest component (main) stays together; members outside of it have to meet each other
    and those inside that the triangle inequality leaves within reach.
    """
    pivots = measured.select(F.col("p").alias("x"), "p", F.lit(0.0).alias("low"), F.lit(0.0).alias("high"))
    members = written(_apart(measured.unionByName(pivots.distinct()), labels))
    outside = members.where("own <> main")
    reach = outside.groupBy("p").agg(F.min("low").alias("from"), F.max("high").alias("to"))
    inside = members.where("own = main").join(reach, "p")
    inside = inside.where((F.col("high") >= F.col("from") - near) & (F.col("low") <= F.col("to") + near))
    return written(outside.unionByName(inside.drop("from", "to")))


def _meeting(near: float):
    """Of one pivot's members, pairs of different components that bounds leave open.

    All of them (`all`) if they are few; else only those that join what is apart so far,
    so fewer than members. If all of these are links, no other pair is needed. Pairs that
    were tried before are left out.
    """

    def meet(table: pa.Table, tried: pa.Table) -> pa.Table:
        node, own, n = (table.column(c).to_numpy() for c in ("x", "own", "n"))
        low, high = (table.column(c).to_numpy() for c in ("low", "high"))
        outside = own != table.column("main").to_numpy()
        _, side = np.unique(own, return_inverse=True)
        refuted: dict[int, list[int]] = {}
        for x, p in zip(tried.column("x").to_pylist(), tried.column("p").to_pylist()):
            refuted.setdefault(x, []).append(p)
            refuted.setdefault(p, []).append(x)
        bits = [np.frombuffer(s, np.uint64) for s in table.column("parities").to_pylist()]
        lengths = np.array([len(s) for s in bits])
        every: list[np.ndarray] = []
        joining: list[np.ndarray] = []
        left = OPEN_PAIRS * len(node)
        for size in np.unique(lengths):
            # Sets that can be linked have bits of one length or of neighbouring ones.
            rows = np.flatnonzero((lengths == size) | (lengths == 2 * size))
            folded = np.stack([np.bitwise_xor.reduce(bits[i].reshape(-1, size)) for i in rows])
            at_size = lengths[rows] == size
            for k in np.flatnonzero(outside[rows]):
                i = rows[k]
                # Two members outside meet once; lengths that differ meet at the smaller one.
                other = (own[rows] != own[i]) & (at_size | at_size[k])
                if left < 0:
                    other &= side[rows] != side[i]
                other &= ~outside[rows] | (node[rows] < node[i])
                other &= (low[rows] <= high[i] + near) & (low[i] <= high[rows] + near)
                if int(node[i]) in refuted:
                    other &= ~np.isin(node[rows], refuted[int(node[i])])
                js = rows[other]
                if not len(js):
                    continue
                apart = np.bitwise_count(folded[other] ^ folded[k]).sum(axis=1, dtype=np.int64)
                least = 2 * apart / (n[js] + n[i] + apart)
                order = np.argsort(least, kind="stable")
                js = js[order[: np.searchsorted(least[order], near, side="right")]]
                left -= len(js)
                if left >= 0:
                    every.append(np.stack([np.full(len(js), node[i]), node[js]], axis=1))
                # The closest of each other side; from here on all of them are on one side.
                js = js[side[js] != side[i]]
                _, closest = np.unique(side[js], return_index=True)
                js = js[closest]
                joining.append(np.stack([np.full(len(js), node[i]), node[js]], axis=1))
                side[np.isin(side, side[js])] = side[i]
        pairs = np.concatenate([*(every if left >= 0 else joining), np.empty((0, 2), np.int64)])
        return pa.table(
            {
                "g": np.repeat(table.column("p").to_numpy()[:1], len(pairs)),
                "x": pairs.max(axis=1, initial=-(1 << 63)),
                "p": pairs.min(axis=1, initial=(1 << 63) - 1),
                "all": np.full(len(pairs), left >= 0),
            }
        )

    return meet


def keep_one(docs: DataFrame, groups: DataFrame, id: str = "doc_id") -> DataFrame:
    """Of each group the row with its smallest id; rows of one id are one document.

    A row whose component_id is null (null ids alone) goes with no other and stays.
    """
    given = Input(docs)
    kept = groups.where(F.col(id) == F.col("component_id")).select(F.col(id).alias("kept"))
    named = given.frame.where(given[id].isNotNull())
    one = named.join(kept.distinct(), given[id] == F.col("kept"), "left_semi")
    one = one.dropDuplicates([given.name(id)])
    return given.results(one.unionByName(given.frame.where(given[id].isNull())), {})
