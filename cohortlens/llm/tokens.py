"""Cutting text where a byte-level tokenizer can be applied piece by piece.

The pattern of the tokenizer takes a word with one space before it, and of longer
white space all but the last character. A cut before a space is therefore safe if
the character before or the one after it is no white space: no token crosses it,
and both sides give the same tokens alone as together. Texts in which some space
has white space on both sides are taken whole.
"""

from __future__ import annotations

import re

#: White space of Unicode and of Python but for the plain space and the line feed.
RARE_SPACE = "\t\r\v\f\x1c-\x1f\x85\xa0  -     　"
CROSSING = re.compile(f"[{RARE_SPACE}] ")


def safe_to_cut(text: str) -> bool:
    """Whether every space may start a piece."""
    return "  " not in text and "\n " not in text and not CROSSING.search(text)
