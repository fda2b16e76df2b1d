"""Cuts of texts that no piece of a sentencepiece vocabulary crosses.

A merge never makes a piece that the vocabulary lacks, so between two characters that
stand side by side in no piece a text can be cut, and its parts have the pieces of the
whole. Such places are before a space behind another character, around line feeds, and
between most letters or digits and a punctuation mark; the vocabulary is asked for each.
"""

from __future__ import annotations

import re
from collections.abc import Iterable

from sentencepiece import SentencePieceProcessor

#: Marks before which a word is cut if the vocabulary allows it.
MARKS = ".,;:!?"
_SPACE = "▁"


def load_model(path: str) -> SentencePieceProcessor:
    return SentencePieceProcessor(model_file=path)


def uncut_ends(model: SentencePieceProcessor) -> set[str]:
    """Letters and digits behind which some piece goes on with a mark.

    Refuses vocabularies whose pieces go on behind a word's end or hold line feeds, and
    models that do more to a text than to put a space before it.
    """
    found = set()
    for i in range(model.get_piece_size()):
        if model.is_byte(i) or model.is_control(i) or model.is_unknown(i):
            continue
        piece = model.id_to_piece(i)
        if "\n" in piece or _SPACE in piece.lstrip(_SPACE):
            raise ValueError(f"the piece {piece!r} crosses words or lines")
        found |= {a for a, b in zip(piece, piece[1:]) if a.isalnum() and b in MARKS}
    for probe in ("a  b ", "\nＡ éé", " \tx"):
        if model.decode(model.encode(probe)) != probe:
            raise ValueError("the model changes texts before it cuts them")
    return found


def pretoken_pattern(model: SentencePieceProcessor) -> str:
    """A pattern whose matches are the pre-tokens of `spaced` text."""
    uncut = re.escape("".join(sorted(uncut_ends(model))))
    end = f"(?<![{uncut}])" if uncut else ""
    return rf"\n+| *[^\W_]++{end}(?![^ \n{MARKS}])| *[^ \n]+| +"


def spaced(text: str) -> str:
    """The text with a space before it, as the model sees it: its mark of a space is one."""
    return " " + text.replace(_SPACE, " ")


def piece_ids(model: SentencePieceProcessor, pretokens: Iterable[str]) -> list[list[int]]:
    """The ids of each pre-token's pieces.

    Behind a line feed, which is cut off on its own, a pre-token stands as inside a text.
    """
    lead = len(model.encode("\n"))
    found = model.encode(["\n" + p for p in pretokens], num_threads=1)
    return [ids[lead:] for ids in found]


def piece_counts(model: SentencePieceProcessor, pretokens: Iterable[str]) -> list[int]:
    """The number of pieces of each pre-token."""
    return [len(ids) for ids in piece_ids(model, pretokens)]
