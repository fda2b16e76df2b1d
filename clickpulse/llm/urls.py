"""URL filter with a weighted vocabulary.

One Aho-Corasick automaton holds all terms and scans host, path, query and fragment of a
URL once. A hit counts only between characters that are no ASCII letters or digits. One
strict term blocks; soft terms block from a number of different ones.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import ahocorasick
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.frames import Input

# The vocabulary, lower case.
STRICT = (
    "ads-track",
    "adserver",
    "casino",
    "doubleclick",
    "escort",
    "hentai",
    "malware",
    "phishing",
    "porn",
    "porno",
    "sex",
    "torrent",
    "warez",
    "xxx",
)
SOFT = (
    "adult",
    "affiliate",
    "bet",
    "betting",
    "bonus",
    "cam",
    "cheap",
    "coupon",
    "crack",
    "dating",
    "deal",
    "deals",
    "download",
    "free",
    "gambling",
    "hack",
    "hot",
    "keygen",
    "loan",
    "lottery",
    "nude",
    "pills",
    "poker",
    "promo",
    "replica",
    "serial",
    "slots",
    "sponsored",
    "track",
    "viagra",
    "win",
)
SOFT_HITS = 2


def automaton(strict: tuple[str, ...], soft: tuple[str, ...]) -> ahocorasick.Automaton | None:
    """All terms in one automaton, or None without terms; a term of both kinds is strict."""
    kinds = dict.fromkeys(soft, False) | dict.fromkeys(strict, True)
    if not kinds:
        return None
    found = ahocorasick.Automaton()
    for term, hard in kinds.items():
        found.add_word(term, (term, hard))
    found.make_automaton()
    return found


def _inside(char: str) -> bool:
    return char.isascii() and char.isalnum()


def count_terms(url: str, terms: ahocorasick.Automaton | None) -> tuple[int, int]:
    """How many different strict and soft terms a lower-cased URL holds."""
    hits: tuple[set, set] = (set(), set())
    for end, (term, hard) in terms.iter(url) if terms else ():
        start = end - len(term) + 1
        if not (start and _inside(url[start - 1])) and not _inside(url[end + 1 : end + 2]):
            hits[not hard].add(term)
    return len(hits[0]), len(hits[1])


def split_url(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null or a URL without ://."""
    start = F.instr(url, "://")
    rest = F.when(start > 0, F.substr(url, start + 3))
    host = lower_ascii(F.regexp_extract(rest, r"(?s)^[^/?#]*", 0))
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def lower_ascii(text: Column) -> Column:
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(text, letters, letters.lower())


def longest_rule(host: Column, path: Column, rules: Mapping[str, str]) -> Column:
    """The longest rule that fits as (rule, verdict), or null; equal lengths by code point.

    A rule is host/path. It fits its host and all subdomains if the path starts with the
    rule's path.
    """
    fits = []
    for rule in sorted(rules, key=lambda r: (-len(r), r)):
        domain, _, rest = rule.partition("/")
        same = (host == domain) | host.endswith("." + domain)
        fit = same & path.startswith("/" + rest)
        value = F.struct(F.lit(rule).alias("rule"), F.lit(rules[rule]).alias("verdict"))
        fits.append(F.when(fit, value))
    return F.coalesce(*fits) if fits else F.lit(None).cast("struct<rule:string,verdict:string>")


def judge_urls(
    pages: DataFrame,
    rules: Mapping[str, str],
    strict: tuple[str, ...] = STRICT,
    soft: tuple[str, ...] = SOFT,
    soft_hits: int = SOFT_HITS,
    url: str = "url",
) -> DataFrame:
    """Block or allow every URL; rules go before the vocabulary.

    Adds host, path, rule (null if none fits), verdict (block or allow), and the numbers of
    different terms strict_terms and soft_terms. A null or empty URL has no terms and is
    allowed. Rows are judged one by one, repeated rows alike; an empty table gives an empty
    table; a result column replaces an input column of its name.
    """
    given = Input(pages)

    def scan(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        terms = automaton(strict, soft)
        for batch in batches:
            found = [count_terms(url, terms) for url in batch]
            yield pd.DataFrame(found, columns=["strict", "soft"], dtype="int64")

    count = F.pandas_udf(scan, "strict long, soft long")
    host, path = split_url(given[url])
    df = given.frame.withColumns({"host": host, "path": path})
    df = df.withColumn("terms", count(F.coalesce(lower_ascii(given[url]), F.lit(""))))
    df = df.withColumn("fit", longest_rule(F.col("host"), F.col("path"), rules))
    bad = (F.col("terms.strict") > 0) | (F.col("terms.soft") >= soft_hits)
    own = F.when(bad, F.lit("block")).otherwise(F.lit("allow"))
    return given.results(
        df,
        {
            "host": F.col("host"),
            "path": F.col("path"),
            "rule": F.col("fit.rule"),
            "verdict": F.coalesce(F.col("fit.verdict"), own),
            "strict_terms": F.col("terms.strict"),
            "soft_terms": F.col("terms.soft"),
        },
    )
