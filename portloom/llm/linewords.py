"""Words of many lines at once: blanks, word borders and 64-bit word hashes in numpy."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np

BLOCK_BYTES, BLOCK_LINES = 1 << 20, 1 << 13
#: Space and U+0009 to U+000D part words; a line ends at U+000A.
_BYTES = np.arange(256)
_VISIBLE = (~np.isin(_BYTES, [32, *range(9, 14)])).astype(np.uint8)
_LETTERS = (_BYTES >= 128) | np.isin(_BYTES | 32, range(97, 123))
_KIND = np.where(_LETTERS, 1, np.where(np.isin(_BYTES, range(48, 58)), 2, 3)).astype(np.uint8) * _VISIBLE
_LETTER = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * 2 + 1
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """The first ``n`` powers; those for a block are kept, more are made for a long line alone."""
    found = _powers.get(base)
    if found is None or len(found) < n:
        more = np.full(max(n, BLOCK_BYTES + 1), base, dtype=np.uint64)
        more[0] = 1
        found = np.multiply.accumulate(more)
        if n <= BLOCK_BYTES + 1:
            _powers[base] = found
    return found[:n]


def mixed(h: np.ndarray, by: int) -> np.ndarray:
    """Spreads the bits of 64-bit numbers; another ``by`` gives an independent number."""
    h = (h ^ (h >> np.uint64(32))) * np.uint64(by | 1)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def line_words(block: bytes, by_kind: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Line number and hash of every word of a block of lines; ``by_kind`` also parts letters,
    digits and other signs."""
    chars = np.frombuffer(block, np.uint8)
    kind = (_KIND if by_kind else _VISIBLE).take(chars)
    edges = np.concatenate(([0], np.flatnonzero(kind[1:] != kind[:-1]) + 1, [len(kind)]))
    runs = np.flatnonzero(kind[edges[:-1]]) if len(kind) else np.empty(0, np.int64)
    if not len(runs):
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    starts, ends = edges[runs], edges[runs + 1]
    # sums of letters by powers of their places in the block; a word's own begin at the power of its start
    sums = np.zeros(len(chars) + 1, np.uint64)
    np.multiply(_LETTER.take(chars), _power(_BASE, len(chars)), out=sums[1:])
    np.cumsum(sums, out=sums)
    h = (sums[ends] - sums[starts]) * _power(_INVERSE, len(chars))[starts]
    before = np.searchsorted(starts, np.flatnonzero(chars == 10))
    line = np.repeat(np.arange(len(before) + 1), np.diff(before, prepend=0, append=len(starts)))
    return line, mixed(h + (ends - starts).astype(np.uint64), 0x94D049BB133111EB)


def blocks(texts: Iterable[str | None]) -> Iterator[tuple[bytes, np.ndarray, np.ndarray]]:
    """Lines of all texts in blocks of at most ``BLOCK_LINES`` and about ``BLOCK_BYTES`` (a longer line is a block of its own),
    with the text's number and the line's number in its text for each line of the block."""
    lines: list[bytes] = []
    owner: list[int] = []
    place: list[int] = []
    size = 0
    for number, text in enumerate(texts):
        for n, line in enumerate((text or "").encode().split(b"\n")):
            if lines and (size + len(line) > BLOCK_BYTES or len(lines) == BLOCK_LINES):
                yield b"\n".join(lines), np.array(owner), np.array(place)
                lines, owner, place, size = [], [], [], 0
            lines.append(line)
            owner.append(number)
            place.append(n)
            size += len(line) + 1
    if lines:
        yield b"\n".join(lines), np.array(owner), np.array(place)
