"""License scans: fuzzy search for short notices, with pigeonhole-split exact seeds and verified edits.

A text becomes its lower-case words joined by single spaces. A notice that may differ in k edits is split into
2k + 1 seeds; wherever the notice occurs with at most k edits, k + 1 of them occur as they are, each at most k
characters off its place. An automaton finds all seeds in one pass; where enough of a notice's seeds lie
together, the regex library's bounded-error matching verifies the notice and reports span and edits. What was verified
is then held to the words: the span's first and last word count whole, a letter of theirs outside the match being one
more edit; the words that name a licence (``NAMES``) must stand in it as they are, edits are for the others; and of
spans that overlap, the one of the longest notice keeps the place, so that a shorter notice inside another licence's is
not a label. Base phrases are counted exactly, at every place where their words stand one after another.

Defined results: null and empty texts have no words, no places and no labels (empty strings, score 0, null
first_word and last_word); places may overlap and are all counted; of overlapping spans of equally long notices the one
with fewer edits wins, then the earlier, then the smaller label; a very long text is scanned whole, in time linear in
it; rows are judged one by one, so repeated rows repeat their result; an empty table gives an empty result; only doc_id
and text are read, other columns cannot clash.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections import Counter
from itertools import accumulate

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Base phrases and their labels.
PHRASES = {
    "mit license": "mit",
    "apache license": "apache",
    "general public license": "gpl",
}
#: Opening words of public licence notices, by label.
NOTICES = {
    "agpl": ("gnu affero general public license",),
    "apache": ("licensed under the apache license version 2 0", "apache software license"),
    "bsd": ("redistribution and use in source and binary forms with or without modification are permitted", "bsd 3 clause license", "released under the bsd license"),
    "cc by": ("licensed under a creative commons attribution", "licensed under cc by 4 0"),
    "cc by nc": ("licensed under a creative commons attribution noncommercial", "licensed under cc by nc 4 0"),
    "cc by nc nd": ("licensed under a creative commons attribution noncommercial noderivatives", "licensed under cc by nc nd 4 0"),
    "cc by nc sa": ("licensed under a creative commons attribution noncommercial sharealike", "licensed under cc by nc sa 4 0"),
    "cc by nd": ("licensed under a creative commons attribution noderivatives", "licensed under cc by nd 4 0"),
    "cc by sa": ("licensed under a creative commons attribution sharealike", "licensed under cc by sa 4 0"),
    "cc0": ("cc0 1 0 universal", "dedicated to the public domain under cc0"),
    "epl": ("eclipse public license",),
    "gpl": ("licensed under the gnu general public license", "under the terms of the gnu general public license as published by", "released under the gpl license"),
    "isc": ("permission to use copy modify and or distribute this software for any purpose", "released under the isc license"),
    "lgpl": ("gnu lesser general public license",),
    "mit": ("released under the mit license", "permission is hereby granted free of charge to any person obtaining a copy"),
    "mpl": ("this source code form is subject to the terms of the mozilla public license", "mozilla public license 2 0"),
    "proprietary": ("all rights reserved",),
    "unlicense": ("this is free and unencumbered software released into the public domain",),
    "zlib": ("released under the zlib license",),
}
#: Words that tell one licence from another.
NAMES = frozenset("affero apache attribution bsd by cc cc0 commons creative eclipse gnu gpl isc lesser mit mozilla nc nd noncommercial noderivatives sa sharealike zlib".split())
#: One edit for so many characters of a notice.
CHARS_PER_EDIT = 10
#: Characters of a block by which overlapping spans are looked up.
BLOCK = 64

SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "spans array<struct<label: string, start_word: long, end_word: long, edits: int, matched: string>>"
)
#: A-Z to a-z, and what is no word character ([^\x00-\x2F\x3A-\x60\x7B-\x7F] after lower-casing) to a space.
TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def seeds(notice: str, edits: int) -> list[tuple[int, str]]:
    """The notice cut into 2 * edits + 1 seeds of nearly equal length: (place in the notice, seed)."""
    n = 2 * edits + 1
    at = [len(notice) * k // n for k in range(n + 1)]
    return [(a, notice[a:b]) for a, b in zip(at, at[1:], strict=False)]


class Scanner:
    def __init__(self, notices: dict, phrases: dict, chars_per_edit: int):
        self.chars_per_edit = chars_per_edit
        self.phrases = [(f" {p} ".encode(), label) for p, label in phrases.items()]
        self.notices, found = [], {}
        for label, texts in notices.items():
            for notice in texts:
                k = len(notice) // chars_per_edit
                for piece, (at, seed) in enumerate(seeds(notice, k)):
                    found.setdefault(seed, []).append((len(self.notices), piece, at))
                self.notices.append((label, notice, k, regex.compile(rf"(?e)(?:{regex.escape(notice, literal_spaces=True)}){{e<={k}}}")))
        self.automaton = ahocorasick.Automaton()
        for seed, uses in found.items():
            self.automaton.add_word(seed, (len(seed), uses))
        self.automaton.make_automaton()

    def regions(self, joined: str) -> dict[int, list[list[int]]]:
        """By notice, where k + 1 of its seeds stand in an order and at distances that k edits can explain; overlapping ones as one."""
        hits: dict[int, list[tuple[int, int]]] = {}
        for end, (size, uses) in self.automaton.iter(joined):
            for which, piece, at in uses:
                hits.setdefault(which, []).append((end + 1 - size - at, piece))
        out = {}
        for which, starts in hits.items():
            _, notice, k, _ = self.notices[which]
            if len(starts) <= k:
                continue
            starts.sort()
            of, low, held = [], 0, Counter()
            for start, piece in starts:
                held[piece] += 1
                while starts[low][0] < start - 2 * k:
                    held[starts[low][1]] -= 1
                    if not held[starts[low][1]]:
                        del held[starts[low][1]]
                    low += 1
                if len(held) > k:
                    lo, hi = max(0, starts[low][0] - k), min(len(joined), start + len(notice) + 2 * k)
                    if of and lo <= of[-1][1]:
                        of[-1][1] = max(of[-1][1], hi)
                    else:
                        of.append([lo, hi])
            if of:
                out[which] = of
        return out

    def fuzzy(self, joined: str) -> list[tuple]:
        """(label, start, end, edits, length of the notice) in ``joined``."""
        spans = []
        for which, of in self.regions(joined).items():
            label, notice, k, pattern = self.notices[which]
            for lo, hi in of:
                while lo + len(notice) - k <= hi:  # places that are exact first, then what stands between them
                    exact = joined.find(notice, lo, hi)
                    end = hi if exact < 0 else exact
                    if lo + len(notice) - k <= end:
                        spans += [(label, m.start(), m.end(), sum(m.fuzzy_counts), len(notice)) for m in pattern.finditer(joined, lo, end)]
                    if exact < 0:
                        break
                    lo = exact + len(notice)
                    spans.append((label, exact, lo, 0, len(notice)))
        return spans

    def accepted(self, joined: str, spans: list[tuple]) -> list[tuple]:
        """Spans that hold as words: whole first and last words within the edits, naming words as they are, and no longer notice over them."""
        fine = []
        for label, a, b, edits, size in spans:
            first, last = joined.rfind(" ", 0, a + 1) + 1, joined.find(" ", max(a, b - 1))
            last = len(joined) if last < 0 else last
            beside = max(0, a - first) + max(0, last - b)
            if edits + beside <= size // self.chars_per_edit and self._named(label, size, joined[first:last].split()):
                fine.append((label, a, b, edits, size))
        fine.sort(key=lambda s: (-s[4], s[3], s[1], s[0]))
        kept, taken = [], {}  # spans by the blocks of characters that they reach into
        for span in fine:
            blocks = range(span[1] // BLOCK, span[2] // BLOCK + 1)
            if all(k[0] == span[0] or k[2] <= span[1] or span[2] <= k[1] for x in blocks for k in taken.get(x, ())):
                kept.append(span)
                for x in blocks:
                    taken.setdefault(x, []).append(span)
        return kept

    def _named(self, label: str, size: int, words: list[str]) -> bool:
        """Whether the naming words of a notice of this label and length stand in the words, in their order."""
        for other, notice, _, _ in self.notices:
            if other == label and len(notice) == size:
                at = iter(words)
                if all(w in at for w in notice.split() if w in NAMES):
                    return True
        return False

    def __call__(self, text: str) -> tuple:
        words = text.encode().translate(TABLE).split()
        flat = b" ".join(words)
        padded = b" " + flat + b" "
        at_byte = list(accumulate((len(w) + 1 for w in words), initial=0))  # where each word begins
        places, base = [], set()
        for phrase, label in self.phrases:
            at = padded.find(phrase)
            while at >= 0:
                places.append(bisect_left(at_byte, at))
                base.add(label)
                at = padded.find(phrase, at + 1)
        joined = flat.decode()
        spans, score = [], 1.0 if places else 0.0
        found = self.accepted(joined, self.fuzzy(joined))
        at_char = at_byte if len(joined) == len(flat) or not found else list(accumulate((len(w) + 1 for w in joined.split(" ")), initial=0))
        for label, a, b, edits, size in found:
            # the word that holds a character: spaces belong to the word before them
            spans.append({"label": label, "start_word": bisect_right(at_char, a) - 1, "end_word": bisect_right(at_char, max(a, b - 1)), "edits": edits, "matched": joined[a:b]})
            score = max(score, 1.0 - edits / size)
        labels = base | {s["label"] for s in spans}
        return (
            len(words), len(places), min(places, default=None), max(places, default=None),
            ",".join(sorted(base)), ",".join(sorted(labels)), score, sorted(spans, key=lambda s: (s["start_word"], s["label"], s["end_word"])),
        )


def scan_licenses(docs: DataFrame, notices: dict = NOTICES, phrases: dict = PHRASES, chars_per_edit: int = CHARS_PER_EDIT) -> DataFrame:
    """A row per document: the words, the base places and labels, all labels, the score and the spans found."""

    def kernel(batches):
        scan = Scanner(notices, phrases, chars_per_edit)
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64()]
        span = pa.list_(pa.struct([("label", pa.string()), ("start_word", pa.int64()), ("end_word", pa.int64()), ("edits", pa.int32()), ("matched", pa.string())]))
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"]
        for batch in batches:
            found = [scan(t.as_py() or "") for t in batch.column(1)]
            cols = [pa.array([f[i] for f in found], t) for i, t in enumerate([*types, span])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(kernel, SCHEMA)


def query(spark, sf_dir: str) -> DataFrame:
    """op1: the licence scan of every document."""
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
