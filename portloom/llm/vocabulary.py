"""Encoders over a public tokenizer file, one per worker process and file.

The file's text travels to the tasks inside the function, so an executor needs no path of its own;
its size is that of the vocabulary and does not depend on the data.
"""

from __future__ import annotations

import ctypes
import gc
import hashlib
import json
import os
import re
from array import array
from functools import lru_cache
from pathlib import Path

import pyarrow as pa

from portloom.llm.bytelevel import WORD, byte_letters
from portloom.llm.chunks import WHITE, ChunkEncoder, TextParts, spaced_chunks, words

#: Chunks kept per generation, about 100 MB in each worker process.
REMEMBERED = 600_000
WORDS_KEPT = 50_000

_ENCODERS: dict[str, ChunkEncoder] = {}


def forget() -> None:
    """Frees the remembered chunks; worker processes go on to tasks that need the memory."""
    _ENCODERS.clear()


def release() -> None:
    """At the end of a task: frees the remembered chunks, and gives memory that this worker process no
    longer uses back to the system, as the process lives on and later stages need room."""
    forget()
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the usual C library on Linux
    if trim is not None:
        trim(0)


def read_vocabulary(path: str) -> str:
    return Path(path).read_text(encoding="utf-8")


def vocabulary_size(vocabulary: str) -> int:
    spec = json.loads(vocabulary)
    return 1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])])


def special_ids(spec: dict) -> dict[str, bytes]:
    for token in spec["added_tokens"]:
        if token["single_word"] or token["lstrip"] or token["rstrip"]:
            raise ValueError("added tokens that take part of their surroundings are not supported")
    return {t["content"]: int(t["id"]).to_bytes(4, "little") for t in spec["added_tokens"]}


#: Letters and numbers below U+0180. There a normal form changes nothing, and every
#: character but U+0130 has one lower-case character.
_LATIN = re.compile("[\x00-\u012f\u0131-\u017f]*")
_LATIN_LETTERS = "A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-\u017f"
_LATIN_NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
#: Signs that are a word of their own at the end of a chunk, after letters.
_SIGNS = frozenset(".,;:!?")


def _latin_pattern(pattern: str) -> str:
    """A word pattern with the letters and numbers of Latin texts written out."""
    for kind, chars in ((r"[\p{L}]", f"[{_LATIN_LETTERS}]"), (r"[\p{N}]", f"[{_LATIN_NUMBERS}]")):
        pattern = pattern.replace(kind, chars)
    # outside of brackets of their own the classes stand alone or in a negated class
    pattern = re.sub(r"(\[\^[^\]]*)\\p\{L\}\\p\{N\}", rf"\g<1>{_LATIN_LETTERS}{_LATIN_NUMBERS}", pattern)
    return pattern.replace(r"\p{L}", f"[{_LATIN_LETTERS}]").replace(r"\p{N}", f"[{_LATIN_NUMBERS}]")


def _latin_cut(spec: dict) -> tuple[re.Pattern, bool] | None:
    """The vocabulary's word pattern for Latin texts and whether it lowers them, if that is known."""
    before, words_of = spec["normalizer"], spec["pre_tokenizer"]
    if before is None and words_of["type"] == "ByteLevel" and words_of["use_regex"] and not words_of["add_prefix_space"]:
        pattern, lower = WORD.pattern, False
    elif before and words_of["type"] == "Sequence":
        steps, parts = {n["type"] for n in before.get("normalizers", [])}, words_of["pretokenizers"]
        if steps != {"NFC", "Replace", "Lowercase"} or [p["type"] for p in parts] != ["Split", "ByteLevel"]:
            return None
        pattern, lower = parts[0]["pattern"]["Regex"].replace(r"\s", WHITE), True
    else:
        return None
    return re.compile(_latin_pattern(pattern)), lower


def library_encoder(vocabulary: str, remembered: int = REMEMBERED) -> ChunkEncoder:
    """Ids of the tokenizers library; ``remembered`` chunks a generation are kept. White space stays in the chunks if the vocabulary is
    byte-level without a normalizer; otherwise the vocabulary must drop white space.

    Latin chunks are cut here and only their words go to the library's model; others pass through
    the library as a whole."""
    key = f"{hashlib.sha256(vocabulary.encode()).hexdigest()} {remembered}"
    if key not in _ENCODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer

        spec = json.loads(vocabulary)
        tokenizer = Tokenizer.from_str(vocabulary)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        model, cut_of = tokenizer.model, _latin_cut(spec)
        letters = byte_letters()

        def ids_of(word: str) -> bytes:
            """Ids of a word, already in the letters of the file."""
            return array("I", [t.id for t in model.tokenize(word)]).tobytes()

        @lru_cache(maxsize=WORDS_KEPT)
        def word_ids(word: str) -> bytes:
            return ids_of("".join(map(letters.__getitem__, word.encode())))

        # letters and one space before them are one word where the pattern is that of byte-level files
        plain = cut_of is not None and cut_of[0].pattern == _latin_pattern(WORD.pattern) and not cut_of[1]
        space = letters[32]

        def encode_one(chunk: str) -> bytes:
            if cut_of is None or not (chunk.isascii() or _LATIN.fullmatch(chunk)):
                return array("I", tokenizer.encode(chunk, add_special_tokens=False).ids).tobytes()
            cut, lower = cut_of
            if plain:
                body = chunk[1:] if chunk[0] == " " else chunk
                if body.isalpha():
                    if chunk.isascii():
                        return ids_of(chunk.replace(" ", space))
                    return ids_of("".join(map(letters.__getitem__, chunk.encode())))
                if body[-1:] in _SIGNS and body[:-1].isalpha():
                    return memory[chunk[:-1]] + word_ids(chunk[-1])
            return b"".join(map(word_ids, cut.findall(chunk.lower() if lower else chunk)))

        parts = TextParts(words if spec["normalizer"] else spaced_chunks, special_ids(spec))
        _ENCODERS[key] = ChunkEncoder(encode_one, parts, remembered)
        memory = _ENCODERS[key].memory
    return _ENCODERS[key]
