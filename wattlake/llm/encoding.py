"""Ids of the tokenizers library with a memory for repeated chunks of text.

A text is cut where no pre-token of the vocabularies can reach over the cut, so the ids of a text
are the ids of its chunks in order. The library encodes each chunk that the worker has not met
yet; other chunks come from a dictionary of bounded size. Three ways to cut, each exact:

* fine: before each space, around each newline, and before a point or comma that ends a word;
* coarse, where such a point or comma does not follow a letter or digit, or white space meets a
  newline: before each space;
* whole, where two spaces meet or a space begins or ends the text: the library gets the text.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Callable
from typing import TYPE_CHECKING

import numpy as np

from wattlake.llm.arrow import KEPT
from wattlake.llm.vocabularies import resolve

if TYPE_CHECKING:
    from tokenizers import Tokenizer

MEMORY_ENTRIES = 900_000
#: Longer chunks are encoded each time and never kept.
LONGEST_KEPT = 64

#: Letters up to ɏ keep their kind when they are normalised, İ excepted.
_PLAIN = "0-9A-Za-zÀ-ÖØ-öø-įı-ɏ"
_UNSAFE = re.compile(rf"(?:^|[^{_PLAIN}])[.,](?:[ \n]|\Z)|\s\n|\n\s")
#: Fine chunks of a pre-token of letters, then perhaps one of signs, in all that _spelling knows.
_SIMPLE = re.compile(r"(\n?\x01)?([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:-@\[-`{-~]*)")
_PLAIN_END = re.compile(rf"[{_PLAIN}]\Z")


#: A point or comma that a fine cut has parted from its word, and the text that it stands for.
_POINTS = {".\1": ".", ",\1": ","}


def _fine(text: str) -> list[str]:
    """Chunks without the space before each; \\1 begins one that has none, after its newline if any."""
    marked = f"\1{text} ".replace("\n", " \n\1").replace(". ", "\2.\1 ").replace(", ", "\2,\1 ")
    return marked.replace("\2", " ").split(" ")[:-1]


def _coarse(text: str) -> list[str]:
    return text.replace(" ", "\0 ").split("\0")


def _parts(chunk: str) -> list[str]:
    """The texts that a fine chunk stands for, one or two."""
    if chunk in _POINTS:
        return [_POINTS[chunk]]
    if chunk[:1] == "\n":
        return ["\n", chunk[2:]]
    return [chunk[1:] if chunk[:1] == "\1" else " " + chunk]


def _plain(text: str) -> bool:
    """Whether every fine cut after this text is safe."""
    return text == "\n" or (
        bool(_PLAIN_END.search(text)) and (text[0] == " " or not text[0].isspace())
    )


def _byte_alphabet() -> dict[int, str]:
    """The character that stands for each byte in byte-level vocabularies, by the byte's number."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}


_ALPHABET = _byte_alphabet()


_SPACE = _ALPHABET[32]


def _letters_as_bytes(word: str, spaced: bool) -> str:
    """Characters of a vocabulary for the bytes of a word, with a space before or not."""
    if not word.isascii():
        word = word.encode().decode("latin-1").translate(_ALPHABET)
    return _SPACE + word if spaced else word


def _in_lower_case(word: str, spaced: bool) -> str:
    return _letters_as_bytes(word.lower(), False)


_BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
_WORDS = "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
_LOWER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = {"type": "Split", "pattern": {"Regex": _WORDS}, "behavior": "Removed", "invert": True}


def _spelling(tokenizer: Tokenizer) -> Callable[[str, bool], str] | None:
    """How the library spells a pre-token of _SIMPLE before its model gets it; None: not known."""
    rules = json.loads(tokenizer.to_str())
    normalizer, cut = rules["normalizer"], rules["pre_tokenizer"]
    if rules["truncation"] or rules["padding"] or rules["model"].get("dropout"):
        return None
    if normalizer is None and cut == _BYTE_LEVEL:
        return _letters_as_bytes
    split = {"type": "Sequence", "pretokenizers": [_SPLIT, _BYTE_LEVEL | {"use_regex": False}]}
    if normalizer == {"type": "Sequence", "normalizers": _LOWER} and cut == split:
        return _in_lower_case
    return None


class Memory(dict):
    """What is known of each chunk; an absent one is found out when it is asked for.

    Two halves of bounded size: a full one becomes the old one, from which chunks that are met
    again come back, so that frequent chunks stay.
    """

    def __init__(self, find: Callable[[str], bytes | None], given: dict[str, bytes]) -> None:
        super().__init__(given)
        self.find, self.given, self.old = find, given, {}

    def __missing__(self, chunk: str) -> bytes | None:
        ids = self.old.get(chunk, "")
        if ids == "":
            ids = self.find(chunk)
        if len(chunk) <= LONGEST_KEPT:
            if len(self) >= MEMORY_ENTRIES // 2:
                self.old = dict(self)
                self.clear()
                self.update(self.given)
            self[chunk] = ids
        return ids


class ChunkEncoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(resolve(path))
        self.spell = _spelling(self.tokenizer)
        self.model = self.tokenizer.model.tokenize
        self.newline = self.library(["\n"])[0]
        self.fine = Memory(self._plain_ids, {p: self.library([t])[0] for p, t in _POINTS.items()})
        self.aside = Memory(self._fine_ids, {})
        self.coarse = Memory(lambda chunk: self.library([chunk])[0], {})

    def library(self, texts: list[str]) -> list[bytes]:
        """What the library gives for each text by itself."""
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.asarray(f.ids, "<u4").tobytes() for f in found]

    def _simple_ids(self, lead: str | None, word: str, signs: str) -> bytes:
        """Ids of simple pre-tokens, straight from the library's model."""
        found = [t.id for t in self.model(self.spell(word, not lead))]
        if signs:
            found += [t.id for t in self.model(self.spell(signs, False))]
        ids = struct.pack(f"<{len(found)}I", *found)
        return self.newline + ids if lead == "\n\1" else ids

    def _fine_ids(self, chunk: str) -> bytes:
        simple = _SIMPLE.fullmatch(chunk) if self.spell else None
        return self._simple_ids(*simple.groups()) if simple else b"".join(self.library(_parts(chunk)))

    def _plain_ids(self, chunk: str) -> bytes | None:
        """Ids of a chunk after which every fine cut is safe, else None."""
        simple = _SIMPLE.fullmatch(chunk) if self.spell else None
        if simple:
            return None if simple[3] else self._simple_ids(*simple.groups())
        return self._fine_ids(chunk) if all(map(_plain, _parts(chunk))) else None

    def encode(self, texts: list[str]) -> list[bytes]:
        """Little-endian unsigned 32-bit ids of each text."""
        out: list[bytes] = [b""] * len(texts)
        whole = []
        for i, t in enumerate(texts):
            if "  " in t or t[-1:] == " " or t[:1] == " " or "\0" in t or "\1" in t or "\2" in t:
                whole.append(i)
                continue
            own = _fine(t)
            try:
                out[i] = b"".join(map(self.fine.__getitem__, own))
            except TypeError:  # a chunk that is not plain
                if _UNSAFE.search(t):
                    out[i] = b"".join(map(self.coarse.__getitem__, _coarse(t)))
                else:
                    known = zip(own, map(self.fine.__getitem__, own), strict=True)
                    out[i] = b"".join([self.aside[p] if ids is None else ids for p, ids in known])
        for i, ids in zip(whole, self.library([texts[i] for i in whole]), strict=True):
            out[i] = ids
        return out


_encoders: dict[str, ChunkEncoder] = {}
KEPT["encoders"] = _encoders.clear


def encoder(path: str) -> ChunkEncoder:
    """One encoder for each Python worker and vocabulary."""
    if path not in _encoders:
        _encoders[path] = ChunkEncoder(path)
    return _encoders[path]
