"""Token ids of whole texts by the tokenizers library, each distinct word encoded once per worker.

A BPE tokenizer cuts a text into words by a pattern and encodes each word on its own. So the ids of
a text are those of its words, one after the other, and words repeat. Here texts are cut at single
spaces into chunks, chunks into words, and both are remembered; only a word that is new goes to the
tokenizer's model. What the patterns below do not cover (letters beyond Latin, the spelling of a
special token) is given to the whole tokenizer, a chunk at a time or, with odd white space, a text.
"""

from __future__ import annotations

import json
import os
import re
import struct
import unicodedata
from collections.abc import Callable
from functools import lru_cache

# Bytes that the chunks and words of one worker may take.
MEMO_BYTES = 96 << 20
# What an entry takes beside its characters and ids: two objects and its place in the table.
_ENTRY_BYTES = 200

# Latin letters and marks, for which the classes below hold in every version of Unicode.
_LATIN_END = 0x250
_BEYOND_LATIN = chr(_LATIN_END)


def _of_category(initial: str) -> str:
    """The Latin characters of a category, as the inside of a character class."""
    return "".join(f"\\u{c:04x}" for c in range(_LATIN_END) if unicodedata.category(chr(c))[0] == initial)


_LETTERS, _NUMBERS, _WHITE = _of_category("L"), _of_category("N"), "\\t\\n\\x0b\\f\\r \\x85\\xa0"
_BEYOND = re.compile(f"[^\\x00-\\u{_LATIN_END - 1:04x}]")
_BEYOND_SPACE = re.compile("[  -     　]")
_SPECIAL = "<|"
# Marks behind a word and in front of a space or the end: an apostrophe is none, as it may begin a word.
# Both patterns begin with the characters to find, which are searched for faster than what is in front of them.
_BEHIND_WORD = re.compile(r"[.,;:!?%#$&*|](?<=[A-Za-zÀ-ÖØ-öø-ÿ].)[.,;:!?%#$&*|]*(?=[ \n]|\Z)")
_LINE_FEED = re.compile(r"\n(?<=\S\n)(?=\S)")

# The word patterns of the two vocabularies.
_SPACED_WORDS = re.compile(
    f"'(?:[stmd]|re|ve|ll)| ?[{_LETTERS}]+| ?[{_NUMBERS}]+| ?[^{_WHITE}{_LETTERS}{_NUMBERS}]+|[{_WHITE}]+(?![^{_WHITE}])|[{_WHITE}]+"
)
_BARE_WORDS = re.compile(f"'(?:[stmd]|re|ve|ll)|[{_LETTERS}]+|[{_NUMBERS}]|[^{_WHITE}{_LETTERS}{_NUMBERS}]+")


def _byte_letters() -> dict[int, int]:
    """The letter that stands for each byte: printable ones for themselves, the others from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in printable)
    return {**{b: b for b in printable}, **{b: 256 + n for n, b in enumerate(others)}}


_BYTE_LETTERS = _byte_letters()


_PACKERS = [struct.Struct(f"<{n}I").pack for n in range(40)]


def _packed(ids: list[int]) -> bytes:
    return _PACKERS[len(ids)](*ids) if len(ids) < len(_PACKERS) else struct.pack(f"<{len(ids)}I", *ids)


class Memo(dict):
    """What was encoded before, by key; past its budget the older half is forgotten.

    ``learn`` makes a missing value. Entries live in two generations: a full one becomes the older,
    and what is used again moves back to the newer, so common words stay.
    """

    def __init__(self, learn: Callable[[str], bytes], budget: int):
        super().__init__()
        self.learn, self.budget, self.used, self.older = learn, budget // 2, 0, {}

    def __missing__(self, key: str) -> bytes:
        value = self.older.get(key)
        if value is None:
            value = self.learn(key)
        size = len(key) + len(value) + _ENTRY_BYTES
        if self.used + size > self.budget:
            self.older, self.used = dict(self), 0
            self.clear()
        self.used += size
        self[key] = value
        return value


class BpeEncoder:
    """Ids of texts as little-endian unsigned 32-bit numbers, equal to the tokenizer's own."""

    def __init__(self, vocabulary: str, memo_bytes: int = MEMO_BYTES):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(vocabulary)
        self.tokenize = self.tokenizer.model.tokenize
        self.style = self._style()
        self.memo = Memo(self._learn, memo_bytes)

    def _style(self) -> str | None:
        """``spaced`` or ``bare`` for a vocabulary with one of the known word patterns."""
        config = json.loads(self.tokenizer.to_str())
        cut, normal, suffix = config["pre_tokenizer"], config["normalizer"], config["model"].get("end_of_word_suffix")
        if config["model"]["type"] != "BPE" or cut is None:
            return None
        if cut["type"] == "ByteLevel" and cut["use_regex"] and not cut["add_prefix_space"] and normal is None:
            return "spaced"
        kinds = [n["type"] for n in (normal or {}).get("normalizers", [])]
        if cut["type"] == "Sequence" and kinds == ["NFC", "Replace", "Lowercase"] and suffix == "</w>":
            split, pattern = cut["pretokenizers"][0], "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
            if split.get("pattern") == {"Regex": pattern} and split.get("behavior") == "Removed" and split.get("invert"):
                return "bare"
        return None

    def _whole(self, text: str) -> bytes:
        return _packed(self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _word(self, word: str) -> bytes:
        if word.isascii() and word.isprintable():
            letters = word.replace(" ", "Ġ")
        else:
            letters = word.encode().decode("latin-1").translate(_BYTE_LETTERS)
        return _packed([token.id for token in self.tokenize(letters)])

    def _learn(self, key: str) -> bytes:
        """The ids of a chunk: its words', or the tokenizer's where the pattern does not hold.

        With a spaced vocabulary a key stands for itself after a space, or, where it starts with a
        line feed, for what follows that without a space; so words are keys of their own.
        """
        if self.style == "spaced" and key.isalpha():
            # most of what is new: a single word
            if key.isascii():
                return _packed([token.id for token in self.tokenize(f"Ġ{key}")])
            if max(key) < _BEYOND_LATIN:
                return self._word(f" {key}")
        chunk = key if self.style == "bare" else key[1:] if key[0] == "\n" else f" {key}"
        if chunk.isascii():
            if chunk.isalpha() and (self.style == "spaced" or chunk.islower()):
                return self._word(chunk)
            safe = _SPECIAL not in chunk
        else:
            safe = not (_BEYOND.search(chunk) or "İ" in chunk or _SPECIAL in chunk)
        if not safe:
            return self._whole(chunk)
        memo = self.memo
        if self.style == "bare":
            words = _BARE_WORDS.findall(chunk.lower())
            return self._word(key) if words == [key] else b"".join([memo[w] for w in words])
        words = _SPACED_WORDS.findall(chunk)
        if len(words) == 1:
            return self._word(chunk)
        return b"".join([memo[w[1:] if w[0] == " " and w[1:2] not in ("", "\n") else "\n" + w] for w in words])

    def _spaced_chunks(self, text: str) -> list[str]:
        """Keys of the chunks between single spaces; a piece next to other white space joins its neighbours.

        In a text without such pieces marks behind a word and single line feeds are cut off first:
        they are words of their own, and fewer different chunks are left.
        """
        if not _oddly_spaced(text):
            return ("\n" + _LINE_FEED.sub(" \n\n \n", _BEHIND_WORD.sub(r" \n\g<0>", text))).split(" ")
        parts = text.split(" ")
        whole = [parts[0]]
        for part in parts[1:]:
            last = whole[-1]
            if part and last and not part[0].isspace() and not last[-1].isspace():
                whole.append(part)
            else:
                whole[-1] = f"{last} {part}"
        whole[0] = "\n" + whole[0]
        return whole

    def _bare_chunks(self, text: str) -> list[str]:
        """Pieces between white space, those of Latin text in lower case and without the marks behind a word."""
        if _SPECIAL not in text and (text.isascii() or not (_BEYOND.search(text) or "İ" in text)):
            text = _BEHIND_WORD.sub(r" \g<0>", text.lower())
        chunks = text.replace("\n", " ").split(" ")
        return [c for c in chunks if c] if "" in chunks else chunks

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if self.style is None or (not text.isascii() and _widely_spaced(text)):
            return self._whole(text)
        chunks = self._bare_chunks(text) if self.style == "bare" else self._spaced_chunks(text)
        return b"".join(map(self.memo.__getitem__, chunks))


# White space other than the space itself, up to the end of Latin-1.
_WHITE_SPACES = "\t\n\v\f\r\x1c\x1d\x1e\x1f\x85\xa0"


def _widely_spaced(text: str) -> bool:
    """Whether a text holds white space beyond Latin-1, which a text in Latin-1 need not be searched for."""
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return _BEYOND_SPACE.search(text) is not None
    return False


def _oddly_spaced(text: str) -> bool:
    """Whether a piece between single spaces is empty or has white space, none of it beyond Latin-1, at an end."""
    if text[0].isspace() or text[-1].isspace():
        return True
    # finding one character is much cheaper than finding two
    for c in _WHITE_SPACES:
        if c in text and (f" {c}" in text or f"{c} " in text):
            return True
    return "  " in text


@lru_cache(maxsize=2)
def encoder(vocabulary: str, memo_bytes: int = MEMO_BYTES) -> BpeEncoder:
    """The worker's encoder of a vocabulary; what it has learned serves the worker's later tasks."""
    return BpeEncoder(vocabulary, memo_bytes)


def encoded(texts: list[str | None], vocabulary: str, end_id: int, memo_bytes: int = MEMO_BYTES) -> list[bytes]:
    """Ids of each text followed by the end id; an absent text counts as empty."""
    end, encode = struct.pack("<I", end_id), encoder(vocabulary, memo_bytes).encode
    return [encode(t or "") + end for t in texts]
