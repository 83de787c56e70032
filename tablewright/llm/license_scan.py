"""License scans: how much a template helps to compress a block names the license, its wording confirms it.

A candidate block of words is compressed by itself and with each template as zstandard raw dictionary; the templates
are ranked by the bytes they save. In that order they are compared with the block word by word, and the first whose wording
stands there with few enough differing words is confirmed. Where it stands more than once, the words around each of these
places are ranked again by themselves, as another template may fit one of them better. What lies between the
confirmed places is searched again in the same way, until no template is confirmed.
"""

from __future__ import annotations

from collections import defaultdict
from functools import cached_property

import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tablewright.llm.decontaminate import words_of
from tablewright.llm.rows import any_ids, documents, map_batches, shown

#: The wording of common notices, by license name.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "MIT": "Released under the MIT License.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "MPL-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
    "MIT-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software",
    "BSD-text": "Redistribution and use in source and binary forms, with or without modification, are permitted",
}


class Template:
    """One wording, and the words of which any sufficiently alike block holds at least one."""

    def __init__(self, name: str, text: str, tolerance: float):
        self.name, self.words = name, words_of(text)
        if not self.words:
            raise ValueError(f"template {name!r} has no words")
        self.most = int(len(self.words) * tolerance)
        # a block that differs in ``most`` words lacks at most so many of these, which are one more
        distinct = sorted(set(self.words), key=lambda w: (-len(w), w))
        self.cues = distinct[: self.most + 1]
        if len(self.cues) <= self.most:
            raise ValueError(f"template {name!r} has too few different words for this tolerance")
        self.cue_places = {c: [i for i, w in enumerate(self.words) if w == c] for c in self.cues}

    @cached_property
    def compressor(self) -> zstandard.ZstdCompressor:
        data = zstandard.ZstdCompressionDict(b" ".join(self.words), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        return zstandard.ZstdCompressor(level=3, dict_data=data, write_content_size=False)

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k != "compressor"}

    def near_cues(self, words: list[bytes], lo: int, hi: int) -> list[tuple[int, int]]:
        """Start and end of the parts of ``words[lo:hi]`` in which the wording may lie, as a cue of it stands there."""
        spans = []
        for p in range(lo, hi):
            for q in self.cue_places.get(words[p], ()):
                spans.append((max(lo, p - q - self.most), min(hi, p - q + len(self.words) + self.most)))
        return merged(spans)

    def matches(self, words: list[bytes], lo: int, hi: int) -> list[tuple[int, int, int]]:
        """(differing words, start, end) of places in ``words[lo:hi]`` that don't overlap, the fewest differing words first.

        Differing words are the fewest to change, add or leave out to turn the wording into the words of the
        place. Of equally good places that overlap the shortest counts, then the first.
        """
        close = []
        for a, b in self.near_cues(words, lo, hi):
            # for every end the fewest differing words, and the last start that has so few
            row, starts = [0] * (b - a + 1), list(range(a, b + 1))
            for i, word in enumerate(self.words, 1):
                before, start, row[0] = row[0], starts[0], i
                for j in range(1, b - a + 1):
                    best = min(
                        (before + (word != words[a + j - 1]), -start),
                        (row[j] + 1, -starts[j]),
                        (row[j - 1] + 1, -starts[j - 1]),
                    )
                    before, start = row[j], starts[j]
                    row[j], starts[j] = best[0], -best[1]
            close += [(n, a + j - at, at, a + j) for j, (n, at) in enumerate(zip(row, starts, strict=True)) if n <= self.most]
        taken, found = bytearray(hi - lo), []
        for n, length, at, end in sorted(close):
            if not any(taken[at - lo : end - lo]):
                taken[at - lo : end - lo] = b"\1" * length
                found.append((n, at, end))
        return found


def merged(spans) -> list[tuple[int, int]]:
    """The spans in order, overlapping ones as one."""
    out: list[list[int]] = []
    for lo, hi in sorted(spans):
        if out and lo < out[-1][1]:
            out[-1][1] = max(hi, out[-1][1])
        else:
            out.append([lo, hi])
    return [(lo, hi) for lo, hi in out]


def make_templates(texts: dict[str, str], tolerance: float) -> list[Template]:
    return [Template(name, text, tolerance) for name, text in sorted(texts.items())]


def blocks_of(words: list[bytes], templates: list[Template]) -> list[tuple[int, int]]:
    """Start and end of the candidate blocks: where a cue stands, as wide as its template may lie around it."""
    places = defaultdict(list)
    wanted = {c for t in templates for c in t.cues}
    for i, w in enumerate(words):
        if w in wanted:
            places[w].append(i)
    spans = set()
    for t in templates:
        for cue in t.cues:
            for q in t.cue_places[cue]:
                for p in places.get(cue, ()):
                    lo = max(0, p - q - t.most)
                    spans.add((lo, min(len(words), p - q + len(t.words) + t.most)))
    return merged(spans)


def ranked(words: list[bytes], lo: int, hi: int, templates: list[Template]) -> list[tuple[int, Template]]:
    """(bytes saved, template) of all templates, the one that helps most to compress ``words[lo:hi]`` first."""
    data = b" ".join(words[lo:hi])
    alone = len(zstandard.ZstdCompressor(level=3, write_content_size=False).compress(data))
    saved = [(alone - len(t.compressor.compress(data)), t) for t in templates]
    return sorted(saved, key=lambda x: (-x[0], x[1].name))


def winner(words: list[bytes], lo: int, hi: int, templates: list[Template]) -> tuple[int, Template | None, list[tuple[int, int, int]]]:
    """(bytes saved, template, its places) of the first in rank that is confirmed; those behind it are not compared."""
    for saved, t in ranked(words, lo, hi, templates):
        if places := t.matches(words, lo, hi):
            return saved, t, sorted(places, key=lambda p: p[1])
    return 0, None, []


def winners(words: list[bytes], lo: int, hi: int, templates: list[Template]) -> list[tuple[int, int, str, int, int]]:
    """The winner's place in ``words[lo:hi]``; of several the winners around each, in order, none overlapping."""
    taken, parts = [], [(lo, hi)]
    while parts:
        a, b = parts.pop()
        a = max(a, taken[-1][1]) if taken else a
        saved, t, places = winner(words, a, b, templates)
        if len(places) == 1:
            (n, at, end), = places
            taken.append((at, end, t.name, n, saved))
        elif places:
            ends = [a, *(end for _, _, end in places[:-1])], [*(at for _, at, _ in places[1:]), b]
            parts += reversed(list(zip(*ends, strict=True)))
    return taken


def licenses_of(words: list[bytes], lo: int, hi: int, templates: list[Template]) -> list[tuple[int, int, str, int, int]]:
    """(start, end, license, differing words, bytes saved) of all places in a block, in order; none overlap.

    Bytes are compared over the words that the winner was ranked for: at most from the place before to the place after.
    """
    found, open_parts = [], [(lo, hi)]
    while open_parts:
        lo, hi = open_parts.pop()
        taken = winners(words, lo, hi, templates)
        found += taken
        if taken:
            for a, b in zip([lo, *(x[1] for x in taken)], [*(x[0] for x in taken), hi], strict=True):
                open_parts += [(a + x, a + y) for x, y in blocks_of(words[a:b], templates)]
    return sorted(found)


def scan(text: str | None, templates: list[Template]) -> tuple[int, list[tuple[str, int, int]]]:
    """Number of candidate blocks, and (license, differing words, bytes saved) of the confirmed places, in order."""
    words = words_of(text)
    spans = blocks_of(words, templates)
    return len(spans), [found[2:] for lo, hi in spans for found in licenses_of(words, lo, hi, templates)]


@any_ids("doc_id")
def license_scan(
    docs: DataFrame, templates: dict[str, str] | None = None, *, tolerance: float = 0.1, **columns
) -> DataFrame:
    """(doc_id, n_blocks, licenses array of (license, n_differing, bytes_saved)) of every document.

    ``tolerance`` is the share of a template's words that may differ, rounded down to whole words; letter
    case and signs don't count. Overlapping candidates are one block. A block has as many licenses as there are
    places with a wording in it, in order of place; only of overlapping places one counts.
    Texts without any cue are told apart by one native expression and never reach Python. A NULL or empty
    text has no blocks. No shuffle; the templates, a bounded parameter, go with the plan.
    """
    made = make_templates(TEMPLATES if templates is None else templates, tolerance)
    rows = documents(docs, **columns)
    cues = sorted({c.decode() for t in made for c in t.cues})
    pattern = "(?i)" + "|".join(cues) if cues else "(?!)"
    asked = rows.withColumn("text", F.when(F.col("text").rlike(pattern), F.col("text")))

    def start():
        def step(ids, texts):
            results = [scan(t, made) if t else (0, []) for t in texts]
            found = [
                [{"license": n, "n_differing": d, "bytes_saved": s} for n, d, s in r[1]] for r in results
            ]
            return ids, [r[0] for r in results], found

        return step

    schema = "doc_id long, n_blocks long, licenses array<struct<license: string, n_differing: long, bytes_saved: long>>"
    return shown(map_batches(asked, start, schema))
