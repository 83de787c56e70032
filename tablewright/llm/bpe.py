"""BPE encoding by dynamic programming over prefixes, and decoding.

For every prefix of a word there is one token that its encoding ends with. A token that ends the
prefix is that one if it is compatible with the last token of the prefix before it: the two stay
apart when their text is encoded alone. So one left-to-right pass over the vocabulary tokens that
end at each place, found by a trie with suffix links (Aho-Corasick), fills in the last tokens; following
them back from the end gives the ids, the same as merging pairs by rank.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct

import numpy as np
import regex
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from tablewright.llm.rows import Recent, any_ids, documents, map_batches, shown

#: Stands for the end-of-word suffix as one character; byte-level symbols don't use it.
MARK = "\ue000"
#: Fixed value: a pre-tokenizer that keeps runs of letters, digits and signs and drops white space.
DROPS_BLANKS = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
#: No white space, nothing that normalising changes, and classes of characters that are the same everywhere.
SIMPLE_CHUNK = re.compile("[\x21-\x7e\xa1-\u012f\u0131-\u017e]+")
#: The byte-level alphabet: printable bytes stand for themselves, the others for characters from U+0100 on.
PRINTABLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_OTHERS = iter(range(0x100, 0x200))
BYTE_CHARACTERS = [chr(b) if b in PRINTABLE else chr(next(_OTHERS)) for b in range(256)]


#: Signs that often end a word and are always cut off it.
ENDS = frozenset(",.;:!?")


def is_letters(word: str) -> bool:
    """Nothing but Latin letters whose class and lower case are the same everywhere."""
    return word.isalpha() and max(word) < "\u0130"


def byte_level(word: str) -> str:
    """The word's UTF-8 bytes in the byte-level alphabet."""
    if word.isalpha() and word.isascii():
        return word
    return "".join([BYTE_CHARACTERS[b] for b in word.encode()])


def pack_ids(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)



class MergeTable:
    """Which tokens may stand next to each other, from the ranks of the merges."""

    def __init__(self, vocab: dict[str, int], merges):
        self.rank: dict[int, int] = {}
        self.parts: dict[int, tuple[int, int]] = {}
        self.joins: dict[tuple[int, int], int] = {}
        for rank, merge in enumerate(merges):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            pair, made = (vocab[left], vocab[right]), vocab[left + right]
            if made in self.rank:
                raise ValueError(f"two merges make {left + right!r}; prefixes then have no unique last token")
            self.rank[made], self.parts[made], self.joins[pair] = rank, pair, rank
        self.known: dict[tuple[int, int], bool] = {}
        self.sound: dict[int, bool] = {}

    def stay_apart(self, left: int, right: int, before: float = float("inf")) -> bool:
        """No merge of rank under ``before`` crosses the border between the two.

        Takes the merges back, the latest first. Equal merges run from left to right, so the one
        at the border also comes before an equal one on its right.
        """
        while True:
            if self.joins.get((left, right), before) < before:
                return False
            a, b = self.rank.get(left, -1), self.rank.get(right, -1)
            if a < 0 and b < 0:
                return True
            if a > b:
                before, left = a, self.parts[left][1]
            else:
                before, right = b + 1, self.parts[right][0]

    def compatible(self, left: int, right: int) -> bool:
        pair = (left, right)
        answer = self.known.get(pair)
        if answer is None:
            if len(self.known) > 500_000:
                self.known.clear()
            answer = self.known[pair] = self.stay_apart(left, right)
        return answer

    def is_sound(self, token: int) -> bool:
        """The token's own text is encoded as this token."""
        if token not in self.parts:
            return True
        if token not in self.sound:
            left, right = self.parts[token]
            self.sound[token] = (
                self.is_sound(left) and self.is_sound(right) and self.stay_apart(left, right, self.rank[token])
            )
        return self.sound[token]


class SuffixLinkTrie:
    """Aho-Corasick: for each place in a text, the vocabulary strings that end there, by links from each state to its suffixes."""

    def __init__(self, strings: dict[str, int]):
        self.step: list[dict[str, int]] = [{}]
        self.link, self.found = [0], [()]
        for string, number in strings.items():
            state = 0
            for c in string:
                after = self.step[state].get(c)
                if after is None:
                    after = self.step[state][c] = len(self.step)
                    self.step.append({})
                    self.link.append(0)
                    self.found.append(())
                state = after
            self.found[state] = ((len(string), number),)
        level = list(self.step[0].values())
        while level:  # by length, so that a state's suffixes are ready before it
            below = []
            for state in level:
                for c, after in self.step[state].items():
                    self.link[after] = self.after(self.link[state], c)
                    below.append(after)
            for state in level:
                self.found[state] += self.found[self.link[state]]
            level = below

    def after(self, state: int, c: str) -> int:
        while True:
            found = self.step[state].get(c)
            if found is not None:
                return found
            if not state:
                return 0
            state = self.link[state]

    def ends(self, text: str) -> list[tuple]:
        """By end place, from 0 on: (length, number) of each string that ends there, the longest first."""
        state, made, steps, links, found = 0, [()], self.step, self.link, self.found
        for c in text:
            after = steps[state].get(c)
            while after is None and state:
                state = links[state]
                after = steps[state].get(c)
            state = after or 0
            made.append(found[state])
        return made


class PrefixBpe:
    """Encoder and decoder for a BPE model in the JSON form of the tokenizers library.

    The library normalises and cuts the text into words; the model's work is done here. Strings of
    special tokens in a text become those tokens, as the library does by default.
    """

    def __init__(self, spec: str):
        parsed = json.loads(spec)
        model = parsed["model"]
        odd = [k for k in ("dropout", "unk_token", "continuing_subword_prefix") if model.get(k)]
        odd += [k for k in ("fuse_unk", "byte_fallback", "ignore_merges") if model.get(k)]
        if model.get("type") != "BPE" or odd:
            raise ValueError(f"only plain BPE models are handled, this one sets {odd or model.get('type')}")
        if parsed.get("decoder") or parsed.get("post_processor"):
            raise ValueError("models with a decoder or a post-processor are not handled")
        added = parsed["added_tokens"]
        if any(a["normalized"] or a["single_word"] or a["lstrip"] or a["rstrip"] for a in added):
            raise ValueError("only added tokens that are matched as they stand are handled")
        vocab, suffix = model["vocab"], model.get("end_of_word_suffix") or ""
        self.end = MARK if suffix else ""
        self.merges = MergeTable(vocab, model["merges"])
        marked = {(t[: -len(suffix)] + MARK if suffix and t.endswith(suffix) else t): n for t, n in vocab.items()}
        self.automaton = SuffixLinkTrie({t: n for t, n in marked.items() if self.merges.is_sound(n)})
        self.strings = {number: token for token, number in vocab.items()} | {a["id"]: a["content"] for a in added}
        self.special = {a["content"]: a["id"] for a in added}
        self.at_special = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) or r"(?!)")
        library = Tokenizer.from_str(spec)
        self.normalizer, self.cutter = library.normalizer, library.pre_tokenizer
        patterns = [p.get("pattern", {}).get("Regex") for p in (parsed["pre_tokenizer"] or {}).get("pretokenizers", [])]
        kinds = [n["type"] for n in (parsed["normalizer"] or {}).get("normalizers", [])]
        self.by_chunk = patterns[:1] == [DROPS_BLANKS] and kinds == ["NFC", "Replace", "Lowercase"]
        self.simple_cut = regex.compile(DROPS_BLANKS).findall
        self.words = Recent(self.word_ids)
        self.chunks = Recent(self.chunk_ids)

    def word_ids(self, word: str) -> bytes:
        """The ids of one word as little-endian unsigned 32-bit integers.

        ``last`` holds the start and the token that end a prefix; prefixes are worked out as others
        need them, beginning with the whole word.
        """
        text = word + self.end
        ends = self.automaton.ends(text)
        compatible, last, waiting = self.merges.compatible, {}, [len(text)]
        while waiting:
            to = waiting[-1]
            for size, token in ends[to]:
                start = to - size
                if start and start not in last:
                    waiting.append(start)
                    break
                if not start or last[start] and compatible(last[start][1], token):
                    last[to] = (start, token)
                    waiting.pop()
                    break
            else:
                last[to] = None
                waiting.pop()
        found, at = [], len(text)
        while at:
            if not last[at]:
                raise ValueError(f"the vocabulary lacks symbols of {word!r}")
            at, token = last[at]
            found.append(token)
        return pack_ids(found[::-1])

    def plain_ids(self, text: str) -> bytes:
        if self.normalizer:
            text = self.normalizer.normalize_str(text)
        words = [w for w, _ in self.cutter.pre_tokenize_str(text)] if self.cutter else [text] if text else []
        return b"".join([self.words[w] for w in words])

    def with_special(self, text: str) -> bytes:
        made, at = [], 0
        for m in self.at_special.finditer(text):
            made += [self.plain_ids(text[at : m.start()]), pack_ids([self.special[m[0]]])]
            at = m.end()
        return b"".join([*made, self.plain_ids(text[at:])])

    def chunk_ids(self, chunk: bytes) -> bytes:
        """A text without ASCII white space. Simple ones are cut here, which takes less time than a library call."""
        text = chunk.decode()
        if is_letters(text):
            return self.words[byte_level(text.lower())]
        if text[-1] in ENDS and is_letters(text[:-1]):
            return self.words[byte_level(text[:-1].lower())] + self.words[text[-1]]
        if SIMPLE_CHUNK.fullmatch(text) and not self.at_special.search(text):
            return b"".join([self.words[byte_level(w)] for w in self.simple_cut(text.lower())])
        return self.with_special(text)

    def encode(self, text: str | None) -> bytes:
        """The ids of a text; None is empty. White space between chunks only ends words."""
        if not text:
            return b""
        if not self.by_chunk:
            return self.with_special(text)
        return b"".join(map(self.chunks.__getitem__, text.encode().split()))

    def decode(self, ids: bytes) -> str:
        """The tokens' strings with a space between them, as the library does for a model without decoder."""
        return " ".join(map(self.strings.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


def model(spec: str) -> PrefixBpe:
    """One for the task, given back with it."""
    return PrefixBpe(spec)


def read_spec(path: str, most_bytes: int = 64 << 20) -> str:
    """The tokenizer's JSON, which goes to the executors with the plan; refused beyond ``most_bytes``."""
    with open(path, encoding="utf-8") as f:
        spec = f.read(most_bytes + 1)
    if len(spec) > most_bytes:
        raise ValueError(f"{path} has more than {most_bytes} bytes")
    return spec


@any_ids("doc_id")
def encode(docs: DataFrame, tokenizer: str, **columns) -> DataFrame:
    """(doc_id, ids): the ids of each whole text as little-endian unsigned 32-bit integers.

    A NULL or empty text has no ids. Every row of the input gives one row, repeated ones too.
    """
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer))

    def start():
        m = model(spec.value)
        return lambda ids, texts: (ids, [m.encode(t) for t in texts])

    return shown(map_batches(documents(docs, **columns), start, "doc_id long, ids binary"))


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, text) from (doc_id, ids); NULL ids give an empty text."""
    spec = encoded.sparkSession.sparkContext.broadcast(read_spec(tokenizer))

    def start():
        m = model(spec.value)
        return lambda ids, codes: (ids, [m.decode(c or b"") for c in codes])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return map_batches(encoded.select("doc_id", "ids"), start, f"doc_id {kind}, text string")


@any_ids("doc_id")
def round_trip(docs: DataFrame, tokenizer: str, **columns) -> DataFrame:
    """Digests of the ids and of the decoded text of each document, without moving either."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer))

    def start():
        m = model(spec.value)

        def step(ids, texts):
            sizes, of_ids, of_text = [], [], []
            for text in texts:
                codes = m.encode(text)
                sizes.append(len(codes) // 4)
                of_ids.append(hashlib.sha256(codes).hexdigest())
                of_text.append(hashlib.sha256(m.decode(codes).encode()).hexdigest())
            return ids, sizes, of_ids, of_text

        return step

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return shown(map_batches(documents(docs, **columns), start, schema))
