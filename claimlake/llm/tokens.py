"""Whole-text encoding with a file of the ``tokenizers`` library, remembering words.

A BPE model works on each pre-token alone, so a text's ids are its pre-tokens' ids side by side.
``TextEncoder`` splits texts as the file's pre-tokenizer does, asks the library for each pre-token
once and keeps its ids (a bounded memory that frequent ones stay in). Texts or words whose normalising it
can't be sure of go to the library whole, and so do texts that hold an added token's content (the
library gives it that token's id), and all texts if it doesn't know the pre-tokenizer.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable
from struct import pack

import regex
from tokenizers import Tokenizer

from claimlake.llm.common import Remembered

#: Fixed value: the pattern that the library documents for its ByteLevel pre-tokenizer.
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Fixed value: a split by words that drops white space; digits stand alone.
WORD_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
# Letters, numbers and white space among the first 256 code points, whose composition and case
# don't depend on their neighbours; the same patterns over these alone are several times faster.
_L, _N, _S = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", r"\t-\r \x85\xa0"
_SPACED = re.compile(f"'(?:s|t|re|ve|m|ll|d)| ?(?:[{_L}]+|[{_N}]+|[^{_S}{_L}{_N}]+)|[{_S}]+(?![^{_S}])|[{_S}]+")
_WORDS = re.compile(f"'(?:s|t|re|ve|m|ll|d)|[{_L}]+|[{_N}]|[^{_S}{_L}{_N}]+")


def _first_256(text: str) -> bool:
    """Whether all characters are among the first 256."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class TextEncoder:
    """Encodes texts to ids, each result as little-endian unsigned 32-bit integers."""

    def __init__(self, definition: str, remember: int = 500_000):
        self.library = Tokenizer.from_str(definition)
        self.memory = Remembered(self.ask, remember, longest=100)
        spec = json.loads(definition)
        self.added = [x["content"] for x in spec.get("added_tokens") or []]
        self.split = _splitter(spec)

    def ask(self, text: str) -> bytes:
        ids = self.library.encode(text, add_special_tokens=False).ids
        return pack(f"<{len(ids)}I", *ids)

    def encode(self, texts: list[str]) -> list[bytes]:
        ids, split, added = self.memory.__getitem__, self.split, self.added
        return [self.ask(t) if any(x in t for x in added) else b"".join(map(ids, split(t))) for t in texts]


def _splitter(spec: dict) -> Callable[[str], list[str]]:
    before, normal = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if normal and any(x.get("normalized") for x in spec.get("added_tokens") or []):
        return lambda text: [text]  # found in the normalised text, which only the library has
    if before.get("type") == "ByteLevel" and before.get("use_regex") and not before.get("add_prefix_space") and normal is None:
        whole = regex.compile(BYTE_LEVEL)
        return lambda text: _SPACED.findall(text) if _first_256(text) else whole.findall(text)
    if _drops_space(before, normal):
        return _words
    return lambda text: [text]


def _words(text: str) -> list[str]:
    if _first_256(text):
        return _WORDS.findall(text.lower())
    out = []
    for part in text.replace("\n", " ").split(" "):
        out += _WORDS.findall(part.lower()) if _first_256(part) else [part]
    return out


def _drops_space(before: dict, normal: dict | None) -> bool:
    """Lower-casing, white space removed by a pattern, then bytes: words stand alone."""
    steps = before.get("pretokenizers") or [{}]
    kinds = [x.get("type") for x in (normal or {}).get("normalizers", [])]
    return (
        [x.get("type") for x in steps] == ["Split", "ByteLevel"]
        and steps[0].get("behavior") == "Removed"
        and steps[0]["pattern"].get("Regex") == WORD_LEVEL
        and bool(steps[0].get("invert"))
        and not steps[1].get("use_regex")
        and kinds == ["NFC", "Replace", "Lowercase"]
    )


_BUILT: dict[tuple[int, int], TextEncoder] = {}


def encoder(definition: str, remember: int = 500_000) -> TextEncoder:
    """The encoder of this Python worker; tasks that it runs later find the words it knows."""
    key = hash(definition), remember
    if key not in _BUILT:
        _BUILT.clear()
        _BUILT[key] = TextEncoder(definition, remember)
    return _BUILT[key]


def definition(path: str) -> str:
    """A tokenizer file's content, read on the driver and sent to the tasks with their code."""
    with open(path, encoding="utf-8") as f:
        return f.read()
