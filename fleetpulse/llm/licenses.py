"""License scans: exact phrases of words, and short notices with a bounded number of edits.

A notice with at most k edits still has one of its k + 1 pieces unharmed. An automaton of all pieces finds
them in one pass over the normalised text; around each piece the ``regex`` library's bounded-error matching
verifies the notice and gives its span and edits.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Sequence

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from fleetpulse.llm.common import binaries, carry, plain_words

# Phrases of the base rule and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}

# Wording of common notices, as plain words.
NOTICES = [
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("mit", "released under the mit license"),
    ("mit", "licensed under the mit license"),
    ("mit", "spdx license identifier mit"),
    ("apache", "licensed under the apache license version 2 0"),
    ("apache", "spdx license identifier apache 2 0"),
    ("gpl", "licensed under the gnu general public license"),
    ("gpl", "under the terms of the gnu general public license"),
    ("lgpl", "gnu lesser general public license"),
    ("agpl", "gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification"),
    ("mpl", "subject to the terms of the mozilla public license"),
    ("isc", "permission to use copy modify and or distribute this software"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc", "licensed under a creative commons attribution"),
    ("unlicense", "free and unencumbered software released into the public domain"),
    ("proprietary", "all rights reserved"),
]
#: One edit for this many letters of a notice, one at least.
LETTERS_PER_EDIT = 12

_worker: dict = {}


class Scanner:
    def __init__(self, notices: Sequence[tuple[str, str]]):
        self.notices = []
        self.seeds = ahocorasick.Automaton()
        at: dict[str, list[tuple[int, int]]] = {}
        for i, (label, words) in enumerate(notices):
            k = max(1, len(words) // LETTERS_PER_EDIT)
            self.notices.append((label, words, k, regex.compile(f"(?b)(?:{regex.escape(words)}){{e<={k}}}")))
            cuts = [len(words) * j // (k + 1) for j in range(k + 2)]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                at.setdefault(words[lo:hi], []).append((i, lo))
        for seed, places in at.items():
            self.seeds.add_word(seed, (len(seed), places))
        self.seeds.make_automaton()
        self.longest = max((len(words) + k for _, words, k, _ in self.notices), default=0)

    def candidates(self, text: str) -> list[tuple[int, int, int, int]]:
        """(start, end, notice, edits) of the places of each notice. Every seed has its own window, at most 2 k longer
        than the notice, so the work grows with the seeds. Of overlapping places of one notice the one with the fewest
        edits stands, then the first."""
        begins: dict[int, set[int]] = {}
        for end, (size, places) in self.seeds.iter(text):
            for i, lo in places:
                begins.setdefault(i, set()).add(end + 1 - size - lo)
        found = []
        for i, around in begins.items():
            _, words, k, pattern = self.notices[i]
            places = set()
            for b in around:
                if b >= 0 and text.startswith(words, b):
                    places.add((0, b, b + len(words)))
                elif m := pattern.search(text, max(0, b - k), b + len(words) + k):
                    places.add((sum(m.fuzzy_counts), m.start(), m.end()))
            kept: list[tuple[int, int]] = []
            for edits, start, end in sorted(places):
                at = bisect_left(kept, (start, end))
                if (at == 0 or kept[at - 1][1] <= start) and (at == len(kept) or end <= kept[at][0]):
                    insort(kept, (start, end))
                    found.append((start, end, i, edits))
        return sorted(found)

    def spans(self, text: str) -> list[tuple[str, int, int, int, int]]:
        """(label, notice, start, end, edits) in the normalised text. Where notices overlap, those with the fewest
        edits stand: a place falls if any place of another notice that overlaps it has fewer."""
        found = self.candidates(text)
        starts = [f[0] for f in found]
        out = []
        for start, end, i, edits in found:
            near = found[bisect_left(starts, start - self.longest):bisect_left(starts, end)]
            if not any(g[3] < edits and start < g[1] for g in near):
                out.append((self.notices[i][0], i, start, end, edits))
        return sorted(out, key=lambda s: (s[2], s[3], s[1]))


def phrase_places(text: bytes) -> list[tuple[int, str]]:
    """(word, label) of each place where a phrase stands; text: words between single blanks, blanks around."""
    out = []
    if b"license" in text:
        for phrase, label in PHRASES.items():
            at, word, counted = -1, 0, 0
            while (at := text.find(b" " + phrase.encode() + b" ", at + 1)) >= 0:
                word, counted = word + text.count(b" ", counted, at), at
                out.append((word, label))
    return out


def scan(df: DataFrame, text: str = "text", spans: bool = False, notices: Sequence[tuple[str, str]] = NOTICES) -> DataFrame:
    """``__row`` with the base columns, ``labels`` and ``score``; with ``spans`` also the notices found.

    ``notices`` are labels and wordings, these as plain lower-case words.

    ``score`` is 1 for an exact phrase, else the best share of letters of a notice without edit, 0 for none.
    Spans are offsets in the text's words joined by blanks. Null and empty texts have no words and no labels;
    repeated rows stay; a text of any length is searched whole.
    """
    new = "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"
    if spans:
        new += ", spans array<struct<label:string,start:int,end:int,edits:int>>"
    width, known = 8 if spans else 7, tuple(notices)

    def work(rows):
        if _worker.get("notices") != known:
            _worker.update(notices=known, scanner=Scanner(known))
        scanner = _worker["scanner"]
        for batch in rows:
            out: list[list] = [[] for _ in range(width)]
            for t in binaries(batch, text):
                words = plain_words(t)
                joined = b" ".join(words)
                base = phrase_places(b" " + joined + b" ")
                found = scanner.spans(joined.decode("utf-8", "replace"))
                labels = {label for _, label in base}
                close = [1 - edits / len(scanner.notices[i][1]) for _, i, _, _, edits in found]
                row = [len(words), len(base), min(base, default=(None,))[0], max(base, default=(None,))[0], ",".join(sorted(labels)),
                       ",".join(sorted(labels | {f[0] for f in found})), 1.0 if base else float(np.max(close, initial=0.0))]
                if spans:
                    row.append([{"label": f[0], "start": f[2], "end": f[3], "edits": f[4]} for f in found])
                for column, value in zip(out, row, strict=True):
                    column.append(value)
            types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64()]
            if spans:
                types.append(pa.list_(pa.struct([("label", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("edits", pa.int32())])))
            yield [pa.array(c, t) for c, t in zip(out, types, strict=True)]

    return carry(df, new, work)
