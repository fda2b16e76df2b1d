"""Licence scan by canonical digests of entire texts.

Text and known licences pass through the same normal form: lower case, copyright lines
and usual titles dropped, equivalent spellings and marks made one, white space and punctuation reduced.
Documents whose whole normal form equals a licence's are found by a hash join on SHA-256.
"""

from __future__ import annotations

from importlib.resources import files

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickpulse.llm.frames import Input

# Spellings that mean the same, the second form is kept.
SPELLINGS = (
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("capitalisation", "capitalization"),
    ("catalogue", "catalog"),
    ("categorise", "categorize"),
    ("centre", "center"),
    ("copyright holder", "copyright owner"),
    ("copyright holders", "copyright owners"),
    ("emphasised", "emphasized"),
    ("favour", "favor"),
    ("favourite", "favorite"),
    ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("labour", "labor"),
    ("licence", "license"),
    ("licences", "licenses"),
    ("maximise", "maximize"),
    ("modelled", "modeled"),
    ("modelling", "modeling"),
    ("noncommercial", "non commercial"),
    ("offence", "offense"),
    ("optimise", "optimize"),
    ("organisation", "organization"),
    ("organise", "organize"),
    ("per cent", "percent"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("signalling", "signaling"),
    ("sub license", "sublicense"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
)

def _bundled() -> dict[str, str]:
    """The full licence texts of the folder beside this file, by the names of their files."""
    folder = files(__package__) / "license_texts"
    texts = {f.name: f.read_text("utf-8") for f in folder.iterdir() if f.name.endswith(".txt")}
    return {name.removesuffix(".txt"): texts[name] for name in sorted(texts)}


#: Known texts by name; a notice stands for a text that says no more.
LICENSES = _bundled() | {
    "Apache-2.0 (notice)": "Licensed under the Apache License, Version 2.0.",
}

_LEAD = r"[ \t#*/;-]*"
_YEAR = r"(?:19|20)[0-9]{2}"
#: A sign, a year or a form to fill in behind the word; or a sign with a year; or a year
#: further on behind a name.
_NOTICE = (
    rf"{_LEAD}(?:copyright[ \t:,]*(?:\(c\)|©|{_YEAR}|[<\[{{])|©"
    rf"|\(c\)[ \t]*(?:copyright[ \t:,]+)?(?:{_YEAR}|[<\[{{])"
    rf"|(?:\(c\)[ \t]*)?(?-i:Copyright[ \t]+(?:by[ \t]+|[Tt]he[ \t]+)*\p{{Lu}})[^\n]*{_YEAR})[^\n]*"
    rf"(?:\n{_LEAD}all rights reserved\.?[ \t]*)?"
)
#: A name alone behind the word, at the beginning of a paragraph.
_HOLDER = rf"{_LEAD}(?-i:Copyright[ \t]+(?:by[ \t]+|[Tt]he[ \t]+)*\p{{Lu}})[^\n]*"
_TITLE = (
    r"(?:the )?(?:mit(?:/x11|/expat)? licen[cs]e(?: \(mit\))?|isc licen[cs]e(?: \(isc\))?"
    r"|(?:bsd zero[ -]clause licen[cs]e|zero[ -]clause bsd(?: licen[cs]e)?)(?: \(0bsd\))?"
    r"|zlib(?:/libpng)? licen[cs]e|unlicen[cs]e"
    r"|(?:bsd [23][ -]clause|[23][ -]clause bsd)"
    r"(?: \"(?:new|simplified)\"(?: or \"(?:revised|freebsd)\")?)? licen[cs]e"
    r"|(?:new|modified|revised|simplified) bsd licen[cs]e)|creative commons legal code"
)
#: Lines that only state who holds the copyright, with the line feed before them, and the
#: usual title on a line of its own at the beginning. Prose that begins with the word is neither.
COPYRIGHT_LINE = (
    rf"(?i)^[ \t\n#*/;=-]*\(?(?:{_TITLE})\)?[.:]?[ \t]*"
    rf"(?:[ \t\n=-]*\n(?:{_NOTICE}|{_HOLDER}))*(?:\n|\z)"
    rf"|(?:^|\n){_NOTICE}|(?:^|\n{_LEAD}\n){_HOLDER}"
)


def canonical(text: Column, spellings: tuple[tuple[str, str], ...] = SPELLINGS) -> Column:
    """The normal form; empty for a text without letters or digits, null for null.

    Lower case by code point; copyright lines and a usual title go; http and https are one; every run of
    characters other than letters and digits becomes one space; then spellings are
    replaced between spaces in their order.
    """
    form = F.regexp_replace(text, r"\r\n?", "\n")
    form = F.lower(F.regexp_replace(form, COPYRIGHT_LINE, ""))
    form = F.regexp_replace(form, r"https://", "http://")
    form = F.concat(F.lit(" "), F.regexp_replace(form, r"[^\p{L}\p{N}]+", " "), F.lit(" "))
    form = F.regexp_replace(form, r" +", " ")
    for old, new in spellings:
        form = F.replace(form, F.lit(f" {old} "), F.lit(f" {new} "))
    return F.trim(form)


def scan_licenses(
    docs: DataFrame, licenses: dict[str, str] | None = None, text: str = "text"
) -> DataFrame:
    """Add digest (hex SHA-256 of the normal form) and license (the known text it equals).

    digest and license are null for a null text and for one without letters or digits.
    The known texts are a parameter held by the caller, so their digests are small and
    are broadcast; of two names with one normal form the smaller is taken. Repeated rows
    are kept. An empty table gives an empty table; a result column replaces an input
    column of its name.
    """
    licenses = LICENSES if licenses is None else licenses
    given = Input(docs)
    spark = docs.sparkSession
    known = spark.createDataFrame(list(licenses.items()), "license string, known string")
    form = canonical(F.col("known"))
    known = (
        known.where(form != "")
        .groupBy(F.sha2(form, 256).alias("known_digest"))
        .agg(F.min("license").alias("license"))
    )
    form = F.col("form")
    df = given.frame.withColumn("form", canonical(given[text]))
    df = df.withColumn("digest", F.when(form != "", F.sha2(form, 256)))
    df = df.join(F.broadcast(known), F.col("digest") == F.col("known_digest"), "left")
    return given.results(df, {"digest": F.col("digest"), "license": F.col("license")})
