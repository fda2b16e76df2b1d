"""Mixing sources to target weights by Pareto order sampling.

Every group of documents has a target in words. A document first gets the whole copies
that its group's rate makes certain; the rest of the rate is its inclusion probability p
in one sample per source. The sample orders documents by u / (1 - u) divided by
p / (1 - p), with u a seeded hash of the document's id, and takes them from the front
until the source's remaining words are used up, so its size is fixed and not random.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickpulse.llm.frames import Input, durable
from clickpulse.llm.words import word_count

#: Words are shared among size classes of one source by these weights: a document's rate
#: grows with the power of its class, so long documents are included more often.
CLASS_WEIGHT = 1.05
#: Ranks are cut into this many ranges, whose sums find the range where a sample ends.
#: It bounds no result: only the rows of that one range are ordered one by one.
RANGES = 1 << 16
#: Bits of the seeded hash that make the uniform number.
_BITS = 52


def fill_to_caps(
    groups: DataFrame, by: list[str], total: Column, weight: Column, cap: Column, out: str
) -> DataFrame:
    """Share a total by weight among the rows of each group, no share above its cap.

    The excess over a cap goes to the others by weight until no share is above. Rows that
    end at their cap are those with the smallest caps per weight, so one pass in that
    order finds the level of all others. Works on one row per group of documents; a total
    above the sum of all caps leaves every row at its cap.
    """
    order = Window.partitionBy(*by).orderBy("_ratio", *(x for x in groups.columns if x not in by))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*by)
    df = groups.withColumns(
        {n: c.cast("double") for n, c in (("_w", weight), ("_cap", cap), ("_total", total))}
    ).withColumn("_ratio", F.col("_cap") / F.col("_w"))
    left = F.col("_total") - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))
    weights = F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    df = df.withColumn("_level", left / weights)
    # Levels rise while rows end at their caps and fall from the first row that does not.
    above = F.col("_cap") > F.col("_w") * F.col("_level")
    level = F.coalesce(F.max(F.when(above, F.col("_level"))).over(whole), F.lit(float("inf")))
    share = F.least(F.col("_cap"), F.col("_w") * level)
    return df.withColumn(out, share).drop("_ratio", "_w", "_cap", "_level", "_total")


def _uniform(key: Column, seed: int) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(seed)), 64 - _BITS)
    return (bits.cast("double") + 0.5) / float(1 << _BITS)


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = (5.0, 2.0, 1.0),
    epochs: float = 1.5,
    max_copies: float = 2.0,
    seed: int = 6,
    id: str = "doc_id",
    text: str = "text",
    source: str = "source",
) -> DataFrame:
    """Choose how often each document is taken so that sources come near their targets.

    Sources in code point order, null last, take the weights in turn and share `epochs`
    times all words; no target exceeds max_copies (a whole number) times its source's
    words. Adds size (words of the text, 0 for null), source_size, target (the source's),
    copies (how often the document is taken) and taken (copies times size).

    Ties in rank go to the smaller id and size, and equal rows are decided alike; reruns
    give the same rows. A null id is a value like any other. Documents without words take
    nothing. An empty table gives an empty table. A result column replaces an input column
    of its name.
    """
    given = Input(docs)
    sized = _sized(given.frame, given[source], given[text])
    slim = durable(sized.select(given[id].alias("id"), "src", "cls", "size"))
    stats = slim.groupBy("src", "cls").agg(F.sum("size").alias("words"))
    plan = durable(_rates(stats, weights, epochs, max_copies))
    cuts = durable(_cuts(_ranked(slim, plan, F.col("id"), seed)))
    # One row per source and size class, and one per source.
    df = _ranked(sized, plan, given[id], seed).join(
        F.broadcast(cuts), F.col("src").eqNullSafe(F.col("c_src")), "left"
    )
    place = F.struct(F.col("value"), given[id].alias("id"), F.col("size"))
    # A source without an end wants its whole sample, but for rounding.
    whole_sample = F.col("c_end").isNull() & (F.col("p_wanted") > 0)
    inside = whole_sample | F.coalesce(place <= F.col("c_cut"), F.lit(False))
    picked = F.col("value").isNotNull() & inside
    copies = F.coalesce(F.col("p_whole"), F.lit(0)).cast("long") + picked.cast("long")
    return given.results(
        df,
        {
            "size": F.col("size"),
            "source_size": F.col("p_source_size"),
            "target": F.col("p_target"),
            "copies": copies,
            "taken": copies * F.col("size"),
        },
    )


def _sized(docs: DataFrame, source: Column, text: Column) -> DataFrame:
    size = F.col("size")
    return docs.withColumns({"src": source, "size": word_count(text)}).withColumn(
        "cls", F.when(size > 0, F.floor(F.log2(size))).cast("int")
    )


def _ranked(sized: DataFrame, plan: DataFrame, id: Column, seed: int) -> DataFrame:
    """Join the rates and add the rank, squeezed into (0, 1), of what can be sampled."""
    plan = plan.select(*(F.col(c).alias(f"p_{c}") for c in plan.columns))
    same = F.col("src").eqNullSafe(F.col("p_src")) & F.col("cls").eqNullSafe(F.col("p_cls"))
    df = sized.join(F.broadcast(plan), same, "left")
    u, rate = _uniform(id, seed), F.col("p_rate")
    rank = (u / (1 - u)) / (rate / (1 - rate))
    return df.withColumn("value", F.when(rate > 0, rank / (1 + rank)))


def _rates(
    stats: DataFrame, weights: tuple[float, ...], epochs: float, max_copies: float
) -> DataFrame:
    """Per source and size class the whole copies, the sampled rate and the source's targets."""
    sources = stats.groupBy("src").agg(F.sum("words").alias("source_size"))
    turn = Window.orderBy(F.col("src").asc_nulls_last())
    nth = (F.row_number().over(turn) - 1) % len(weights)
    sources = sources.withColumns(
        {
            "weight": F.get(F.array(*map(F.lit, weights)), nth),
            "all": F.sum("source_size").over(Window.partitionBy(F.lit(1))),
            "one": F.lit(1),
        }
    )
    sources = fill_to_caps(
        sources,
        ["one"],
        F.col("all") * epochs,
        F.col("weight"),
        F.col("source_size") * max_copies,
        "target",
    ).select(F.col("src").alias("s"), "source_size", "target")
    classes = stats.join(sources, F.col("src").eqNullSafe(F.col("s"))).drop("s")
    classes = classes.withColumn("key", F.struct("src"))
    words = F.col("words")
    heavy = words * F.pow(F.lit(CLASS_WEIGHT), F.coalesce(F.col("cls"), F.lit(0)))
    classes = fill_to_caps(
        classes.where("words > 0"),
        ["key"],
        F.col("target"),
        heavy,
        words * max_copies,
        "share",
    ).unionByName(classes.where("words = 0").withColumn("share", F.lit(0.0)))
    per_copy = F.when(words > 0, F.col("share") / words).otherwise(F.lit(0.0))
    # Shares within a billionth of whole copies are whole copies.
    over = per_copy - F.col("whole")
    classes = classes.withColumn("whole", F.floor(per_copy + 1e-9)).withColumn(
        "rate", F.when(over > 1e-9, over).otherwise(F.lit(0.0))
    )
    wanted = F.col("target") - F.sum(F.col("whole") * words).over(Window.partitionBy("key"))
    return classes.withColumn("wanted", wanted).select(
        "src", "cls", "source_size", "target", "whole", "rate", "wanted"
    )


def _cuts(ranked: DataFrame) -> DataFrame:
    """Where each source's sample ends: the range of ranks, and the last row inside.

    Sums per range of ranks say which range a sample ends in; only the rows of that range
    are ordered one by one. The row on the edge is in if half of it is still wanted.
    """
    rows = ranked.where(F.col("value").isNotNull()).withColumn(
        "cell", F.floor(F.col("value") * RANGES).cast("int")
    )
    cells = rows.groupBy("src", "cell").agg(
        F.sum("size").alias("words"), F.first("p_wanted").alias("wanted")
    )
    # First among ranges of 256 ranges, then among the ranges of the one that is found.
    cells = cells.withColumns({"wide": F.shiftright("cell", 8), "before": F.lit(0).cast("long")})
    wide = cells.groupBy("src", "wide").agg(
        F.sum("words").alias("words"), F.first("wanted").alias("wanted"), F.first("before").alias("before")
    )
    found = _ending(wide, "wide").select(
        F.col("src").alias("w_src"), F.col("wide").alias("w_wide"), F.col("spent").alias("w_spent")
    )
    same = F.col("src").eqNullSafe(F.col("w_src")) & (F.col("wide") == F.col("w_wide"))
    narrow = cells.join(F.broadcast(found), same).withColumn("before", F.col("w_spent"))
    ends = _ending(narrow, "cell").select(
        F.col("src").alias("c_src"), F.col("cell").alias("c_end"), "spent", "wanted"
    )
    at_end = F.col("src").eqNullSafe(F.col("c_src")) & (F.col("cell") == F.col("c_end"))
    place = Window.partitionBy("c_src").orderBy("value", "id", "size")
    earlier = F.sum("size").over(place.rowsBetween(Window.unboundedPreceding, -1))
    start = F.col("spent") + F.coalesce(earlier, F.lit(0))
    tail = rows.join(F.broadcast(ends), at_end).withColumn("start", start)
    inside = F.col("start") + F.col("size") / 2 <= F.col("wanted")
    last = F.max(F.when(inside, F.struct("value", "id", "size")))
    cut = tail.groupBy("c_src", "c_end").agg(last.alias("inner"), F.min("value").alias("v"))
    # Where no row of the range is inside, the sample ends just before it.
    none = F.struct(
        F.lit(0.0).alias("value"),
        F.lit(None).cast(ranked.schema["id"].dataType).alias("id"),
        F.lit(0).cast("long").alias("size"),
    )
    first = F.col("c_end") / F.lit(float(RANGES))
    below = none.withField("value", first)
    return cut.select("c_src", "c_end", F.coalesce("inner", below).alias("c_cut"))


def _ending(sums: DataFrame, by: str) -> DataFrame:
    """Of each source the range in which its wanted words are reached, with the words before."""
    order = Window.partitionBy("src").orderBy(by).rowsBetween(Window.unboundedPreceding, -1)
    spent = F.col("before") + F.coalesce(F.sum("words").over(order), F.lit(0))
    return sums.withColumn("spent", spent).where("spent < wanted AND spent + words >= wanted")
