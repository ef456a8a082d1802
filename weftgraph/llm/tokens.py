"""Public tokenizer files, run through the fastest library that gives the same ids.

``byte_level`` and ``word_end`` return an encoder ``str -> uint32 array`` that equals
``tokenizers.Tokenizer.encode(text, add_special_tokens=False).ids`` on every text.
Both run plain text through tiktoken's merge loop with ranks taken from the same
file, and hand every text outside the plain case to the tokenizers library itself.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Callable
from functools import lru_cache

import numpy as np

# Fixed value: the split pattern of byte-level BPE.
BYTE_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: A text with a run of so many characters without white space, or of white space, goes to the library that owns the file.
RUN = 20000
LONG_RUN = re.compile(rf"\S{{{RUN}}}|\s{{{RUN}}}")
#: Longer texts are encoded in parts of about so many characters, cut before a blank between
#: two letters: no piece of either tokenizer reaches over such a place.
PART = 1 << 20
_CUT = re.compile("(?<=[A-Za-z]) (?=[A-Za-z])")


def parts(text: str) -> list[str]:
    out, at = [], 0
    while len(text) - at > PART and (m := _CUT.search(text, at + PART)):
        out.append(text[at : m.start()])
        at = m.start()
    return [*out, text[at:]]


def _in_parts(encode: Callable[[str], np.ndarray]) -> Callable[[str], np.ndarray]:
    def run(text: str) -> np.ndarray:
        return encode(text) if len(text) <= PART else np.concatenate([encode(p) for p in parts(text)])

    return run


def vocabulary(name: str) -> str:
    """The place of a public tokenizer file."""
    import public_tokenizers

    return str(public_tokenizers.path(name))


def as_array(ids: list[int]) -> np.ndarray:
    return np.frombuffer(array("I", ids), np.uint32)


def _byte_chars() -> dict[str, int]:
    """The printable stand-in of each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in plain}
    for i, b in enumerate(b for b in range(256) if b not in set(plain)):
        out[chr(256 + i)] = b
    return out


def _library(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


@lru_cache(4)
def size(path: str) -> int:
    """One more than the greatest id of a tokenizer file."""
    return max(_library(path).get_vocab(with_added_tokens=True).values(), default=-1) + 1


@lru_cache(2)
def byte_level(path: str) -> Callable[[str], np.ndarray]:
    import tiktoken

    spec = json.load(open(path, encoding="utf-8"))
    at = _byte_chars()
    special = {t["content"] for t in spec["added_tokens"]}
    ranks = {bytes(at[c] for c in piece): i for piece, i in spec["model"]["vocab"].items() if piece not in special}
    fast = tiktoken.Encoding("byte_level", pat_str=BYTE_SPLIT, mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_ordinary
    library = _library(path)
    odd = re.compile("|".join(map(re.escape, special)))

    def encode(text: str) -> np.ndarray:
        if odd.search(text) or len(text) >= RUN and LONG_RUN.search(text):
            return as_array(library.encode(text, add_special_tokens=False).ids)
        return as_array(fast(text))

    return _in_parts(encode)


@lru_cache(2)
def word_end(path: str) -> Callable[[str], np.ndarray]:
    """Lower-cased words with an end mark. The end mark becomes a blank after each
    piece, and a byte with its blank one symbol that forms before all others."""
    import tiktoken

    spec = json.load(open(path, encoding="utf-8"))
    at = _byte_chars()
    special = {t["content"] for t in spec["added_tokens"]}
    vocab = spec["model"]["vocab"]

    def raw(piece: str) -> bytes:
        end = piece.endswith("</w>")
        return bytes(at[c] for c in (piece[:-4] if end else piece)) + b" " * end

    ids = {raw(p): i for p, i in vocab.items() if p not in special}
    order = [bytes([b]) for b in range(256)] + [bytes([b]) + b" " for b in range(256) if b != 32]
    known = set(order)
    merged = []
    for pair in spec["model"]["merges"]:
        left, right = pair.split(" ") if isinstance(pair, str) else pair
        merged.append(raw(left + right))
    order += [m for m in merged if m not in known]
    back = [ids.get(p, -1) for p in order]
    core = tiktoken.Encoding("word_end", pat_str="[^ ]+ ", mergeable_ranks={p: i for i, p in enumerate(order)}, special_tokens={})._core_bpe.encode_ordinary
    library = _library(path)
    # Plain: white space, printable ASCII and Latin letters that no normal form changes, without the special strings.
    plain = bytes([9, 10, 11, 12, 13, *range(0x20, 0x7F), *range(0x80, 0xC0), *range(0xC2, 0xC6)])
    control = re.compile(b"\xc2[\x80-\xa0]")
    # What is not letters, as the split pattern takes it; letters between stay together.
    other = re.compile("('s|'t|'re|'ve|'m|'ll|'d|[0-9\xb2\xb3\xb9\xbc-\xbe]|(?:[^\\w\\s]|_)+)")
    # The same in two quick steps for a text without apostrophes.
    digit = re.compile("([0-9\xb2\xb3\xb9\xbc-\xbe])")
    mark = re.compile("([^\\sa-z\xaa\xb5\xba\xdf-\xf6\xf8-ſ]+)")
    translate = np.array(back, np.int64).astype(np.uint32)

    def odd(text: str) -> bool:
        data = text.encode("utf-8", "surrogatepass")
        return bool(data.translate(None, plain)) or b"<|" in data or control.search(data) is not None

    def encode(text: str) -> np.ndarray:
        if odd(text) or len(text) >= RUN and LONG_RUN.search(text):
            return as_array(library.encode(text, add_special_tokens=False).ids)
        text = text.lower()
        text = other.sub(r" \1 ", text) if "'" in text else " ".join(mark.split(" ".join(digit.split(text))))
        text = " ".join(text.split())
        return translate[as_array(core(text + " "))] if text else as_array([])

    return _in_parts(encode)
