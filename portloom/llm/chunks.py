"""Cuts texts at places where no token can cross and remembers the ids of each cut.

Both supplied vocabularies tokenise a text in parts that never reach from a visible character over
following white space. A chunk (white space, then visible characters) therefore has the same ids in
every text, so a task encodes each distinct chunk once and looks the others up.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Iterator

#: The characters with Unicode's White_Space property.
WHITE = "\t-\r \x85\xa0  -     　"

_CHUNK = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
_WORD = re.compile(f"[^{WHITE}]+")
_CUT = re.compile(f"(?<=[^{WHITE}])(?=[{WHITE}])")
_ONLY_PYTHON_WHITE = "\x1c\x1d\x1e\x1f"  # white space for str.split, visible for the tokenizers

SEGMENT_CHARS = 1 << 20
GROUP_CHUNKS = 600_000


def spaced_chunks(text: str) -> list[str]:
    """Chunks with the white space before them; joined they are the text."""
    return _CHUNK.findall(text)


def words(text: str) -> list[str]:
    """Chunks without white space, for vocabularies that drop it."""
    if any(c in text for c in _ONLY_PYTHON_WHITE):
        return _WORD.findall(text)
    return text.split()


def segments(text: str, size: int = SEGMENT_CHARS) -> Iterator[str]:
    """Pieces of about ``size`` characters that end where a chunk ends, so that a very long text
    never stands in memory as one list of chunks."""
    start = 0
    while len(text) - start > size:
        cut = _CUT.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    yield text[start:]


class TextParts:
    """Chunk lists of texts, and the ids of texts that are one id wherever they stand."""

    def __init__(self, split: Callable[[str], list[str]], special: dict[str, bytes]):
        self._split, self._special = split, special
        self._special_cut = re.compile("(" + "|".join(map(re.escape, special)) + ")") if special else None

    def __call__(self, text: str | None) -> Iterator[list[str] | bytes]:
        """The text's chunks in lists of bounded size, and special ids as bytes; a null is empty."""
        text = text or ""
        if self._special_cut is None or not any(s in text for s in self._special):
            yield from map(self._split, segments(text))
            return
        for part in self._special_cut.split(text):
            if part in self._special:
                yield self._special[part]
            elif part:
                yield from map(self._split, segments(part))


class ChunkMemory(dict):
    """Ids by chunk; unknown chunks are encoded when they are asked for. Chunks are kept in two
    generations of ``most`` each; those still in use move on."""

    def __init__(self, encode_one: Callable[[str], bytes], most: int):
        super().__init__()
        self._encode_one, self._most, self._older = encode_one, most, {}

    def __missing__(self, chunk: str) -> bytes:
        ids = self._older.get(chunk)
        if ids is None:
            ids = self._encode_one(chunk)
        if len(self) >= self._most:
            self._older = dict(self)
            self.clear()
        self[chunk] = ids
        return ids


class ChunkEncoder:
    """Texts to little-endian unsigned 32-bit ids, chunk by chunk."""

    def __init__(self, encode_one: Callable[[str], bytes], parts: TextParts, remembered: int):
        self._parts, self.memory = parts, ChunkMemory(encode_one, remembered)

    def _ids(self, part: list[str] | bytes) -> bytes:
        return part if isinstance(part, bytes) else b"".join(map(self.memory.__getitem__, part))

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts, four bytes each."""
        return [b"".join(map(self._ids, self._parts(t))) for t in texts]


class BlockEncoder:
    """The same for an encoder that is fast on many chunks at once.

    ``encode_many`` turns a list of chunks into one bytes object of ids each. Texts are taken in
    groups, whose unknown chunks are encoded together; a group may exceed ``remembered``."""

    def __init__(self, encode_many: Callable[[list[str]], Iterable[bytes]], parts: TextParts, remembered: int):
        self._encode_many, self._parts, self._limit = encode_many, parts, remembered
        self._ids: dict[str, bytes] = {}
        self._older: dict[str, bytes] = {}

    def _learn(self, group: list[tuple[int, list[str] | bytes]]) -> None:
        seen: set[str] = set()
        for _, chunks in group:
            if not isinstance(chunks, bytes):
                seen.update(chunks)
        unknown = seen - self._ids.keys()
        if len(self._ids) + len(unknown) > self._limit:
            self._older, self._ids, unknown = self._ids, {}, seen
        recalled = {c: self._older[c] for c in unknown if c in self._older}
        self._ids.update(recalled)
        fresh = list(unknown - recalled.keys())
        self._ids.update(zip(fresh, self._encode_many(fresh), strict=True))

    def _groups(self, texts: list[str | None]) -> Iterator[list[tuple[int, list[str] | bytes]]]:
        group, size = [], 0
        for number, text in enumerate(texts):
            for part in self._parts(text):
                group.append((number, part))
                size += len(part)
                if size >= GROUP_CHUNKS:
                    yield group
                    group, size = [], 0
        if group:
            yield group

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts, four bytes each."""
        out: list[list[bytes]] = [[] for _ in texts]
        for group in self._groups(texts):
            self._learn(group)
            for number, part in group:
                out[number].append(part if isinstance(part, bytes) else b"".join(map(self._ids.__getitem__, part)))
        return [b"".join(parts) for parts in out]
