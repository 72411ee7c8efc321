"""Token ids of texts by public tokenizers; stretches of text met again are not tokenized again."""

from __future__ import annotations

import hashlib
import json
import os
import re
import string
import sys
import types
import unicodedata
from array import array
from collections.abc import Callable, Iterable

#: entries after which the memory of tokenized stretches starts anew; longer stretches are not kept
KEPT, LONGEST = 700_000, 64
#: a blank between two characters that no tokenizer takes for white space
CUT = re.compile("(?<=[^\\s᠎]) (?=[^\\s᠎])")
ODD = re.compile(" (?:(?=[\\s᠎])|(?<=[\\s᠎] )|(?<!. )|\\Z)", re.DOTALL)  # a blank that isn't such, looked for at blanks only


def stretches(text: str) -> list[str]:
    """The text cut at single blanks, where neither tokens of byte-level BPE nor of sentence pieces reach across."""
    return CUT.split(text) if ODD.search(text) else text.split(" ")


class Numbers(dict):
    """A number for each stretch of text met, in the order they come; `new` has those not asked for yet by who works on them."""

    def __init__(self) -> None:
        super().__init__()
        self.new: list[str] = []

    def __missing__(self, part: str) -> int:
        self[part] = number = len(self)
        self.new.append(part)
        return number


def lasting(make: Callable, *models: bytes):
    """What `make` returns, kept by the worker process: Spark reuses it, and later tasks find what earlier ones have learned."""
    place = sys.modules.setdefault("_token_memory", types.ModuleType("_token_memory")).__dict__
    key = hashlib.sha256(b"".join(models)).hexdigest()
    if key not in place:
        place[key] = make()
    return place[key]


def json_tokenizer(model: bytes, plain_specials: bool = False):
    """A tokenizer from the content of its JSON file, one thread."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    t = Tokenizer.from_buffer(model)
    if plain_specials:
        t.encode_special_tokens = True
    return t


def json_encode(tokenizer) -> Callable[[list[str]], Iterable]:
    return lambda parts: (e.ids for e in tokenizer.encode_batch_fast(parts, add_special_tokens=False))


def file_bytes(path: str) -> bytes:
    """A tokenizer's file (a few MB at most), read on the driver and sent with the tasks."""
    with open(path, "rb") as f:
        return f.read()


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 characters stand for themselves, the other bytes, in order, are U+0100 and on.
    """
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(256 + k): b for k, b in enumerate(rest)}


class WordIds(dict):
    """Token ids of texts, as little-endian 32-bit numbers, by a tokenizer that lowers case and splits by one fixed pattern.

    The tokenizer's own normalizer is applied, then texts are split here and each part is handed to the tokenizer's merges once. Only
    what the pattern finds among letters, digits and signs of settled kind is split so; windows with anything else, and files with
    another pattern, go through the tokenizer as a whole. Both give the same ids. Long texts are taken in windows that end at white space.
    """

    # fixed values: the pattern in the tokenizer's file, and the endings it names
    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    ENDINGS = {"'s", "'t", "'re", "'ve", "'m", "'ll", "'d"}
    LETTERS = "a-zß-öø-ÿ"
    CUT = re.compile(rf"[{LETTERS}]+|'(?:s|t|re|ve|m|ll|d)|[0-9]|[^\s{LETTERS}0-9]+", re.ASCII)
    WORD = re.compile(f"[{LETTERS}]+")
    BEYOND = re.compile("[^\\0-\u052f\u2010-\u2027]|\u03a3")  # sigma's lower case depends on its place for Python only
    WINDOW, SPACE = 1_000_000, re.compile(rb"[ \t\n\r\f\v]")

    def __init__(self, model: bytes) -> None:
        super().__init__()
        self.tokenizer = json_tokenizer(model)
        self.normalizer, self.merges = self.tokenizer.normalizer, self.tokenizer.model
        spec = json.loads(model)
        steps = (spec.get("pre_tokenizer") or {}).get("pretokenizers") or [{}]
        kinds = [n["type"] for n in (spec.get("normalizer") or {}).get("normalizers", [])]
        self.known = (steps[0].get("pattern") or {}).get("Regex") == self.PATTERN and kinds == ["NFC", "Replace", "Lowercase"]
        self.letter = {b: c for c, b in byte_letters().items()}

    def settled(self, part: str) -> bool:
        """Whether a part of `CUT` is surely one of the pattern: Latin-1 letters, a digit, signs up to Cyrillic, dashes, quotation marks."""
        if part.isalpha():
            return self.WORD.fullmatch(part) is not None
        return part in self.ENDINGS or part in string.digits or all(
            not c.isalnum() and not c.isspace() and (c < "\u0530" or "\u2010" <= c <= "\u2027") for c in part)

    def __missing__(self, part: str) -> bytes:
        if not self.settled(part):
            raise KeyError(part)
        letters = part if part.isascii() and part.isprintable() else "".join(map(self.letter.__getitem__, part.encode()))
        out = array("I", [t.id for t in self.merges.tokenize(letters)]).tobytes()
        if len(part) <= LONGEST:
            self[part] = out
        return out

    def normal(self, given: bytes) -> str:
        """What the normalizer makes of a text, but for the length of white space."""
        if given.isascii():
            return given.lower().decode()
        text = given.decode("utf-8", "replace")
        if self.BEYOND.search(text) or not unicodedata.is_normalized("NFC", text):
            return self.normalizer.normalize_str(text)
        return text.lower()

    def of_window(self, text: bytes) -> bytes:
        if self.known and b"<|" not in text:  # nor a special token
            try:
                return b"".join(map(self.__getitem__, self.CUT.findall(self.normal(text))))
            except KeyError:
                pass
        return array("I", self.tokenizer.encode_batch_fast([text.decode("utf-8", "replace")], add_special_tokens=False)[0].ids).tobytes()

    def of(self, text: bytes) -> bytes:
        if len(self) > KEPT:
            self.clear()
        if len(text) <= self.WINDOW:
            return self.of_window(text)
        out, at = [], 0
        while at < len(text):
            space = self.SPACE.search(text, at + self.WINDOW)
            end = space.start() if space else len(text)
            out.append(self.of_window(text[at:end]))
            at = end
        return b"".join(out)


def byte_level_tokens(tokenizer) -> list[bytes]:
    """The bytes of each id of a byte-level vocabulary."""
    byte, out = byte_letters(), [b""] * tokenizer.get_vocab_size()
    for token, i in tokenizer.get_vocab().items():
        out[i] = bytes(byte[c] for c in token) if all(c in byte for c in token) else token.encode()
    return out


def sentence_piece_tokens(model) -> list[bytes]:
    """The bytes of each id of a sentence-piece vocabulary: U+2581 is a blank, <0xHH> the byte HH."""
    return [bytes([int(model.id_to_piece(i)[3:5], 16)]) if model.is_byte(i) else model.id_to_piece(i).replace("▁", " ").encode()
            for i in range(model.get_piece_size())]
