"""Byte-level BPE by the faster of two public encoders, where both are known to give the same ids."""

from __future__ import annotations

import json
import re

import numpy as np
import tiktoken
from tokenizers import Tokenizer

from tablewright.llm.bpe import BYTE_CHARACTERS, MergeTable
from tablewright.llm.token_files import BYTE_LEVEL_WORDS

#: Texts of these characters only are cut into words alike by every regular expression engine.
COMMON = re.compile("[\t-\r -~\xa0-ɏ]*")


def token_bytes(spec: str) -> list[bytes]:
    """By id, the bytes of a byte-level vocabulary's entries."""
    parsed = json.loads(spec)
    back = {c: b for b, c in enumerate(BYTE_CHARACTERS)}
    found = {n: bytes(back[c] for c in token) for token, n in parsed["model"]["vocab"].items() if all(c in back for c in token)}
    found |= {t["id"]: t["content"].encode() for t in parsed["added_tokens"]}
    return [found.get(n, b"") for n in range(max(found) + 1)]


def by_rank(spec: str) -> bool:
    """Merging the pair whose result has the lowest id gives this model's ids: ids follow the merges, and every token's own
    text is encoded as that token, so any two tokens that make up a third one also merge to it."""
    model = json.loads(spec)["model"]
    merges = MergeTable(model["vocab"], model["merges"])
    first = len(BYTE_CHARACTERS)
    return all(n == first + rank and merges.is_sound(n) for n, rank in merges.rank.items())


class ByteLevel:
    """The ids of a byte-level tokenizer. ``ranked`` says that ``by_rank`` holds: texts of common characters then go
    to an encoder by ranks. With ``plain``, strings of special tokens are ordinary text."""

    def __init__(self, spec: str, ranked: bool, *, plain: bool):
        parsed = json.loads(spec)
        cutter = parsed["pre_tokenizer"]
        if cutter["type"] != "ByteLevel" or cutter["add_prefix_space"] or not cutter["use_regex"] or parsed["normalizer"]:
            raise ValueError("only plain byte-level tokenizers are handled")
        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        self.library.encode_special_tokens = plain
        self.bytes = token_bytes(spec)
        special = {t["id"] for t in parsed["added_tokens"]}
        self.special = () if plain else tuple(t["content"] for t in parsed["added_tokens"])
        ranks = {b: n for n, b in enumerate(self.bytes) if n not in special}
        self.fast = tiktoken.Encoding("own", pat_str=BYTE_LEVEL_WORDS, mergeable_ranks=ranks, special_tokens={}) if ranked else None

    def is_simple(self, text: str) -> bool:
        return self.fast is not None and COMMON.fullmatch(text) is not None and not any(s in text for s in self.special)

    def ids(self, text: str) -> np.ndarray:
        if self.is_simple(text):
            return self.fast.encode_to_numpy(text)
        return np.array(self.library.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def count(self, text: str) -> int:
        if self.is_simple(text):
            return len(self.fast.encode_ordinary(text))
        return len(self.library.encode(text, add_special_tokens=False).ids)
