"""Line-first cleaning: rules judge each line, failed lines go, and a document that
loses too much of its text is rejected.

Everything happens inside a row with built-in functions, so nothing is shuffled and a
very long text costs as much per character as a short one.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.frames import Input
from clickpulse.llm.words import WORD_CHAR, words

# The symbols and patterns of the rules.
SYMBOLS = "#*$%&|<>"
NAVIGATION = (
    r"(?i)^[^a-z]*(home|menu|log ?in|sign (in|up|out)|register|search|next|previous|read more|"
    r"click here|skip to|back to|share this|site ?map|about us|contact us)([^a-z]|$)|»|›| \| "
)
BOILERPLATE = (
    r"(?i)all rights reserved|copyright|©|(licensed|released) under|cookie|privacy policy|"
    r"terms of (use|service)|javascript|lorem ipsum|powered by|subscribe"
)
ENDED = r"[.!?][\x20\x09-\x0D]*\z"


@dataclass(frozen=True)
class LineRules:
    """Bounds of the rules; shares are whole percentages.

    min_words, max_repeated: a document with fewer words, or with more of its words in
    repeated windows of `window` words, fails before any line is judged.
    max_symbols: symbols among a line's characters other than white space.
    max_marks: runs of marks (!!, ??, ...) against the line's words.
    menu_words, notice_words: longest line that can be navigation or boilerplate.
    max_lost: characters in failed or repeated lines, of all characters in words.
    """

    min_words: int = 20
    max_repeated: int = 30
    window: int = 8
    max_symbols: int = 10
    max_marks: int = 20
    menu_words: int = 8
    notice_words: int = 16
    max_lost: int = 50


def _repeated_words(tokens: Column, window: int) -> Column:
    """Words inside windows that occur twice or more.

    Hashes find the texts without any repeat; others compare the windows themselves.
    A window that starts at s and is followed by one at t adds min(window, t - s) words.
    """
    last = F.size(tokens) - window + 1
    starts = F.sequence(F.lit(1), last)
    hashes = F.transform(starts, lambda i: F.xxhash64(F.slice(tokens, i, window)))
    ordered = F.sort_array(
        F.transform(starts, lambda i: F.struct(F.slice(tokens, i, window).alias("w"), i.alias("i")))
    )

    def found(pairs: Column) -> Column:
        same = lambda i, step: F.coalesce(
            F.get(pairs, i)["w"] == F.get(pairs, i + step)["w"], F.lit(False)
        )
        chosen = F.filter(pairs, lambda x, i: same(i, 1) | same(i, -1))
        return F.sort_array(F.transform(chosen, lambda x: x["i"]))

    def covered(at: Column) -> Column:
        start = F.struct(F.lit(0).cast("long").alias("n"), F.lit(-window).alias("at"))
        step = lambda a, i: F.struct(
            (a["n"] + F.least(F.lit(window), i - a["at"])).alias("n"), i.alias("at")
        )
        # Each start adds what its predecessor leaves of the window before it.
        return F.aggregate(at, start, step, lambda a: a["n"])

    one = lambda value, use: F.get(F.transform(F.array(value), use), 0)
    exact = one(ordered, lambda pairs: one(found(pairs), covered))
    repeats = F.size(F.array_distinct(hashes)) < last
    return F.when(last < 2, F.lit(0)).when(repeats, exact).otherwise(F.lit(0)).cast("long")


def _good(line: Column, rules: LineRules) -> Column:
    n_words = F.size(words(line))
    n_chars = F.length(F.regexp_replace(line, r"[\x20\x09-\x0D]+", ""))
    marks = F.regexp_count(line, F.lit(r"[!?]{2,}|\.{3,}"))
    n_symbols = F.length(line) - F.length(F.regexp_replace(line, f"[{SYMBOLS}]", ""))
    menu = (n_words <= rules.menu_words) & line.rlike(NAVIGATION) & ~line.rlike(ENDED)
    notice = (n_words <= rules.notice_words) & line.rlike(BOILERPLATE)
    shouted = (n_words >= 3) & line.rlike(r"\p{Lu}") & ~line.rlike(r"\p{Ll}")
    return (
        line.rlike(r"[\p{L}\p{N}]")
        & (100 * n_symbols <= rules.max_symbols * n_chars)
        & (100 * marks <= rules.max_marks * n_words)
        & ~shouted
        & ~menu
        & ~notice
    )


def judge_lines(docs: DataFrame, rules: LineRules = LineRules(), text: str = "text") -> DataFrame:
    """Clean every text line by line and judge the document.

    Adds n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed,
    kept (boolean) and clean_text (string: the lines that stay, in order, joined by a line
    feed). A null or empty text has no words, fails and has an empty clean_text. Rows are
    judged one by one: repeated rows all stay. A result column replaces an input column of
    its name; an empty table gives an empty table.
    """
    given = Input(docs)
    body = given[text]
    plain = F.coalesce(body, F.lit(""))
    bare = plain
    for symbol in SYMBOLS:
        bare = F.replace(bare, F.lit(symbol), F.lit(""))
    filled = F.filter(F.split(plain, "\n"), lambda line: line.rlike(WORD_CHAR))
    df = given.frame.withColumns({"tokens": words(body), "lines": filled})
    df = df.withColumns(
        {
            "n_words": F.size("tokens").cast("long"),
            "chars": F.length(F.array_join("tokens", "")).cast("long"),
            "repeated": _repeated_words(F.col("tokens"), rules.window),
            "different": F.array_distinct("lines"),
        }
    )
    df = df.withColumn("good", F.filter("different", lambda line: _good(line, rules)))
    n_words, chars, repeated = F.col("n_words"), F.col("chars"), F.col("repeated")
    failed = (n_words < rules.min_words) | (100 * repeated > rules.max_repeated * n_words)
    left = F.length(F.regexp_replace(F.array_join("good", ""), r"[\x20\x09-\x0D]+", ""))
    enough = 100 * left >= (100 - rules.max_lost) * chars
    judged = F.struct(
        n_words.alias("n_words"),
        chars.alias("word_chars"),
        (F.length(plain) - F.length(bare)).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size("different")).cast("long").alias("n_dup_lines"),
        repeated.alias("n_repeat_words"),
        failed.alias("base_failed"),
        (~failed & enough).alias("kept"),
        F.array_join("good", "\n").alias("clean_text"),
    )
    # As a generated row, so that a filter on a result is not merged with all of the above
    # and every step of it evaluated over and over.
    df = df.select(*given.frame.columns, F.explode(F.array(judged)).alias("judged"))
    return given.results(df, {f.name: F.col(f"judged.{f.name}") for f in df.schema["judged"].dataType})
