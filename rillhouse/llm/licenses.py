"""License scans: phrases, and an exact set-similarity join of text blocks with templates.

A block is a run of words about as long as a template (its words / threshold), inside a line
or, where no line matches the template, inside a paragraph, so that notices survive wrapping.
It matches a template if it contains at least ``threshold`` of the template's words and the
words that name the licence (``NAMES``), side by side.  Words are ordered by how many blocks of the
whole corpus have them, rarest first, and the join runs through three filters that lose
nothing:

* prefix: of a template's n words o = ceil(threshold * n) must be shared, so at least one
  of its n - o + 1 rarest words is;
* length: the block has at least o different words;
* position: after the first shared word, enough words of the template and of the block
  must be left in the common order to reach o.

What remains is counted exactly.  The templates are given by hand and small; only their
words are counted over the corpus.

Defined results
* null text counts as empty: no words, no labels, score 0.
* the labels of the phrases stay; the join adds those of its templates.
* ``score`` is 1 where a phrase stands, else the highest containment that reached the
  threshold, else 0.
* repeated rows each appear; an empty table gives an empty result; other columns are not
  read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import doubles, id_and_text, longs, map_slices, strings

#: Fixed values of the contract: phrase and label.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
#: Templates of the join: label and notice text.
TEMPLATES = [
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this "
            "software and associated documentation files"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
]
THRESHOLD = 0.8
#: Words that must stand side by side, and words that must stand, by template.
NAMES = {
    TEMPLATES[0][1]: ("mit license", ""),
    TEMPLATES[1][1]: ("associated documentation files", ""),
    TEMPLATES[2][1]: ("apache", "2"),
    TEMPLATES[3][1]: ("gnu general public", "3"),
    TEMPLATES[4][1]: ("cc by nc", ""),
}

_WORD_BYTES = bytes(
    b + 32 if 0x41 <= b <= 0x5A else b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
    for b in range(256))


def words_of(data: bytes) -> list[bytes]:
    """Lower-cased words: runs of digits, letters and bytes beyond ASCII."""
    return data.translate(_WORD_BYTES).split()


def word_counts(documents: DataFrame, words: set[bytes]) -> dict[bytes, int]:
    """In how many blocks of the whole corpus each of the given words stands."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter = Counter()
        for batch in batches:
            for text in batch.column(1).to_pylist():
                for line in text.encode().translate(_LINES).split(b"\n"):
                    found.update(words.intersection(line.split()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(found), pa.binary()), longs(list(found.values()))], names=["word", "n"])

    rows = id_and_text(documents).mapInArrow(count, "word binary, n bigint")
    return {bytes(r[0]): r[1] for r in rows.groupBy("word").agg(F.sum("n")).collect()}


_LINES = _WORD_BYTES[:10] + b"\n" + _WORD_BYTES[11:]


class Templates:
    """Index of template prefixes under one global word order."""

    def __init__(self, templates: list[tuple[str, str]], threshold: float, counts: dict[bytes, int]):
        self.order = {w: (counts.get(w, 0), w) for _, t in templates for w in words_of(t.encode())}
        self.sets, self.index = [], {}
        for number, (label, text) in enumerate(templates):
            ordered = sorted(set(words_of(text.encode())), key=self.order.get)
            need = math.ceil(threshold * len(ordered) - 1e-9)
            name, must = (x.encode().split() for x in NAMES.get(text, ("", "")))
            reach = math.ceil(len(words_of(text.encode())) / threshold - 1e-9)
            self.sets.append((label, ordered, need, b" ".join([b"", *name, b""]), name + must, reach))
            for place, word in enumerate(ordered[:len(ordered) - need + 1]):
                self.index.setdefault(word, []).append((number, place))
        self.prefixes = set(self.index)

    def matches(self, block: list[bytes], skip: frozenset | set = frozenset()) -> dict[int, float]:
        """Template and highest containment in a run of words of this block."""
        met = self.prefixes.intersection(block)
        if not met:
            return {}
        have = set(block)
        shared = sorted((w for w in have if w in self.order), key=self.order.get)
        rank = {w: i for i, w in enumerate(shared)}
        out: dict[int, float] = {}
        judged = set(skip)
        for word in sorted(met, key=self.order.get):
            for number, place in self.index[word]:
                _, ordered, need, name, must, reach = self.sets[number]
                if number in judged or len(have) < need:
                    continue
                judged.add(number)
                # the first shared word of this template: all that may follow, in either
                if 1 + min(len(ordered) - place - 1, len(shared) - rank[word] - 1) < need:
                    continue
                if not have.issuperset(must) or sum(w in have for w in ordered) < need:
                    continue
                best = self._best_run(block, set(ordered), name, must, reach)
                if best >= need:
                    out[number] = best / len(ordered)
        return out

    @staticmethod
    def _best_run(block: list[bytes], wanted: set[bytes], name: bytes, must: list[bytes], reach: int) -> int:
        """Most words of the template in a run of ``reach`` words that has its name."""
        best, held = 0, Counter()
        for end, word in enumerate(block):
            if word in wanted:
                held[word] += 1
            if end >= reach and block[end - reach] in wanted:
                gone = block[end - reach]
                held[gone] -= 1
                if not held[gone]:
                    del held[gone]
            if len(held) > best:
                run = block[max(0, end - reach + 1):end + 1]
                if name in b" ".join([b"", *run, b""]) and all(w in run for w in must):
                    best = len(held)
        return best


def _paragraphs(lines: list[list[bytes]]) -> Iterator[list[bytes]]:
    """Words of each run of two or more lines with words."""
    held: list[list[bytes]] = []
    for line in [*lines, []]:
        if line:
            held.append(line)
            continue
        if len(held) > 1:
            yield [w for x in held for w in x]
        held = []


def _phrase_places(words: list[bytes], phrases: list[tuple[bytes, str]]) -> list[tuple[int, str]]:
    joined = b" " + b" ".join(words) + b" "
    found = []
    for phrase, label in phrases:
        at = joined.find(phrase)
        while at >= 0:
            found.append((joined.count(b" ", 0, at), label))
            at = joined.find(phrase, at + 1)
    return found


def scan(documents: DataFrame, phrases: dict[str, str] = PHRASES,
         templates: list[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    words = {w for _, t in templates for w in words_of(t.encode())}
    known = Templates(templates, threshold, word_counts(documents, words))
    spaced = [(b" " + p.encode() + b" ", label) for p, label in phrases.items()]

    def make():
        def work(ids, texts):
            out = [[] for _ in range(7)]
            for text in texts:
                lines = [line.split() for line in text.encode().translate(_LINES).split(b"\n")]
                words = [w for line in lines for w in line]
                places = _phrase_places(words, spaced)
                base = {label for _, label in places}
                met: dict[int, float] = {}
                for line in lines:
                    for number, score in known.matches(line).items():
                        met[number] = max(met.get(number, 0.0), score)
                whole = set(met)
                for block in _paragraphs(lines):
                    for number, score in known.matches(block, whole).items():
                        met[number] = max(met.get(number, 0.0), score)
                scores: dict[str, float] = {}
                for number, score in met.items():
                    label = known.sets[number][0]
                    scores[label] = max(scores.get(label, 0.0), score)
                starts = [at for at, _ in places]
                row = (len(words), len(places), min(starts, default=None), max(starts, default=None),
                       ",".join(sorted(base)), ",".join(sorted(base | set(scores))),
                       1.0 if base else max(scores.values(), default=0.0))
                for column, value in zip(out, row):
                    column.append(value)
            return [longs(ids), *map(longs, out[:4]), strings(out[4]), strings(out[5]), doubles(out[6])]
        return work

    return map_slices(id_and_text(documents), make,
                      "doc_id bigint, n_words bigint, n_base bigint, first_word bigint, last_word bigint, "
                      "base_labels string, labels string, score double")
