"""How byte-level vocabularies cut texts into words and write bytes as characters."""

from __future__ import annotations

import re

import regex

from portloom.llm.chunks import WHITE

#: Fixed value: the word pattern of byte-level vocabularies, for any text and for ASCII alone.
WORD = regex.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^§\p{L}\p{N}]+|[§]+(?![^§])|[§]+".replace("§", WHITE)
)
ASCII_WORD = re.compile(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"
)


def byte_letters() -> dict[int, str]:
    """The visible character that stands for each byte in a byte-level vocabulary file: bytes with
    a visible Latin-1 character stand for themselves, the others for the code points from 256 on."""
    visible = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(visible)]
    return {b: chr(b) for b in visible} | {b: chr(256 + n) for n, b in enumerate(rest)}
