"""Token ids of whole texts through a bounded memory of encoded chunks.

Both kinds of vocabulary cut text at white space before merging, so the ids of
a text are the ids of its chunks one after the other. Most chunks repeat; each
is encoded once per worker and kept as packed little-endian unsigned 32-bit
integers, and a text's ids are one ``bytes.join``.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Callable

import regex

from locusframe.llm.common import tokenizer_path, worker_cache

#: Chunks kept by a worker (in two generations of half as many), some 175
#: bytes each; the more, the fewer of them are encoded again. A generation is
#: what a dict of 2**19 places holds before it doubles its table.
MEMO_CHUNKS = 2 * (2**20 // 3)

#: Split pattern of the byte-level vocabularies (fixed value of these files).
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
#: Split pattern of the lower-cased word vocabulary (fixed value of its file).
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""

_CHUNK = re.compile(rb"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
#: Other white space than blank and line feed, or a lead byte of such.
_UNUSUAL = re.compile(rb"[\t\x0b-\r\x1c-\x1f\xc2\xe1\xe2\xe3\xef]")
#: White space outside the six ASCII bytes, beside which a border is unsure.
_ODD_SPACE = re.compile(
    rb"[\x1c-\x1f]|\xc2[\x85\xa0]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8f\xa8\xa9\xaf]|\xe2\x81[\x9f\xa0]|\xe3\x80\x80|\xef\xbb\xbf"
)
_SIGNS = b".,!?;:#$%&*|"
_ENDS_IN_LETTER = re.compile(rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])\Z")
_SAFE_BORDER = re.compile(rb"(?<=[\x21-\x7e])(?=[ \t-\r])")
#: Characters up to here are cut, lower-cased and composed alike by every
#: Unicode version; chunks with later ones go through the whole library call.
_LATIN = re.compile("[^\x00-ɏ]")


def words(text: bytes) -> list[bytes]:
    """Keys for lower-casing vocabularies that drop white space: the words."""
    return text.lower().split()


def spaced(text: bytes) -> list[bytes]:
    """Keys for vocabularies that keep white space.

    A white-space byte after any other byte always starts a new piece of the
    byte-level split pattern, so no piece crosses such a border. A key stands
    for a chunk: with a trailing blank for what is before it, with a leading
    line feed for itself, else for a blank and itself (see ``chunk_of``).
    """
    if b"  " not in text and b"\n\n" not in text and b" \n" not in text and not _UNUSUAL.search(text):
        keys = text.replace(b"\n", b" \n").split(b" ")
        keys[0] += b" "
        return keys
    cut = _SAFE_BORDER.split if _ODD_SPACE.search(text) else _CHUNK.findall
    return [x + b" " for x in cut(text) if x]


def chunk_of(key: bytes) -> bytes:
    """The bytes of the text that a key of ``spaced`` stands for."""
    return key[:-1] if key.endswith(b" ") else key if key.startswith(b"\n") else b" " + key


class ChunkMemory(dict):
    """Packed ids by key, in two generations; a miss is encoded once."""

    def __init__(
        self, encode: Callable[[bytes], bytes], tail_mark: bytes = b"", limit: int = MEMO_CHUNKS
    ):
        super().__init__()
        self._encode, self._mark, self._half, self._old = encode, tail_mark, limit // 2, {}

    def __missing__(self, key: bytes) -> bytes:
        packed = self._old.get(key)
        if packed is None:
            # Signs after a letter always start a piece of their own.
            core = key if key.isalpha() else key.rstrip(_SIGNS)
            if len(core) < len(key) and _ENDS_IN_LETTER.search(core):
                known = core in self or core in self._old
                packed = self[core] + self[key[len(core) :] + self._mark]
                # Most new words are never seen again: one place is enough.
                if not known:
                    return packed
            else:
                packed = self._encode(key)
        if len(self) >= self._half:
            # The older generation goes first: three at a time take too much.
            self._old = {}
            self._old = dict(self)
            self.clear()
        self[key] = packed
        return packed

    def pack(self, keys: list[bytes]) -> bytes:
        return b"".join(map(self.__getitem__, keys))


def packed(ids) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def byte_alphabet() -> dict[int, int]:
    """Character that stands for each byte in byte-level vocabularies: itself
    where printable, else the next free one from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + i for i, b in enumerate(hidden)}


def library_encoder(name: str, lower: bool) -> Callable[[bytes], bytes]:
    """Encoder of chunks by the tokenizers library; strings of special tokens
    in a text are ordinary text. Plain Latin chunks are cut here and only
    merged by the library's model; others take the library's whole way."""
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(tokenizer_path(name))
    tokenizer.encode_special_tokens = True
    merge, alphabet = tokenizer.model.tokenize, byte_alphabet()
    blank = chr(alphabet[32])
    pieces = regex.compile(WORD_PATTERN if lower else BYTE_PATTERN).findall

    def encode(chunk: bytes) -> bytes:
        # ASCII letters are one piece that its bytes' characters spell.
        if chunk.isalpha():
            return packed([token.id for token in merge((chunk.lower() if lower else chunk).decode())])
        if not lower and chunk[:1] == b" " and chunk[1:].isalpha():
            return packed([token.id for token in merge(blank + chunk[1:].decode())])
        text = chunk.decode("utf-8", "replace")
        if _LATIN.search(text):
            return packed(tokenizer.encode(text, add_special_tokens=False).ids)
        if lower:
            text = text.lower()
        # Letters alone, after one blank where blanks count, are one piece.
        one = text.isalpha() if lower else text[:1] == " " and text[1:].isalpha()
        return packed(
            [
                token.id
                for piece in ((text,) if one else pieces(text))
                for token in merge(piece.encode().decode("latin-1").translate(alphabet))
            ]
        )

    return encode


def word_memory(name: str) -> ChunkMemory:
    """The worker's memory of a lower-casing word vocabulary; keys: ``words``."""
    key = f"words {name}"
    cache = worker_cache(key)
    if key not in cache:
        cache[key] = ChunkMemory(library_encoder(name, lower=True))
    return cache[key]


def byte_memory(name: str) -> ChunkMemory:
    """The worker's memory of a byte-level vocabulary; keys: ``spaced``."""
    key = f"bytes {name}"
    cache = worker_cache(key)
    if key not in cache:
        encode = library_encoder(name, lower=False)
        cache[key] = ChunkMemory(lambda key: encode(chunk_of(key)), tail_mark=b" ")
    return cache[key]
