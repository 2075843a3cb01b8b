import hashlib
import random

import pytest
from pyspark.sql import functions as F

from rillhouse.llm import piecewise_hash as P

SCHEMA = "doc_id bigint, text string"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        above, row[0] = row[:], i
        for j, y in enumerate(b, 1):
            row[j] = min(above[j] + 1, row[j - 1] + 1, above[j - 1] + (x != y))
    return row[-1]


def prose(rng, n):
    words = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 9))) for _ in range(400)]
    return " ".join(rng.choices(words, k=n))


def brute(rows):
    """(doc_id, text) in order; every document, its edited text and its next document."""
    rows = [(d, t or "") for d, t in rows]
    out = []
    for (doc, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        k = len(text) // 4
        new = (text[:-k] if k else text) + after[:k]
        own, new_print, after_print = map(P.fingerprint, (text, new, after))
        out.append((doc, len(text), hashlib.sha256(new.encode()).hexdigest(), own, new_print,
                    P.likeness(own, new_print), P.likeness(own, after_print)))
    return sorted(out, key=repr)


def found(frame):
    return sorted(map(tuple, P.fingerprints(frame).collect()), key=repr)


def test_edit_distance_like_dynamic_programming():
    rng = random.Random(1)
    for _ in range(600):
        a, b = ([rng.choice(["AA", "AB", "BA"]) for _ in range(rng.randint(0, 70))] for _ in range(2))
        assert P.edit_distance("".join(a), "".join(b)) == distance(a, b)


def test_cuts_depend_on_context_and_are_bounded():
    import numpy as np

    rng = random.Random(2)
    text = prose(rng, 3000)
    for size in (1, 2, 64, 512):
        ends = {}
        for name, x in (("whole", text), ("moved", "Some other start. " + text)):
            values = np.frombuffer(x.encode(), np.uint8).astype(np.uint64) + np.uint64(1)
            cuts = P.chunk_ends(P.context_hashes(values), size)
            assert cuts[-1] == len(x) - 1 and cuts == sorted(set(cuts))
            gaps = np.diff([-1, *cuts])
            assert gaps.max() <= 4 * size and (gaps[:-1] >= size // 4).all()
            ends[name] = {c - (len(x) - len(text)) for c in cuts}
        late = {c for c in ends["whole"] if c > 10 * size}
        assert len(late & ends["moved"]) > .9 * len(late)


@pytest.mark.parametrize("unit", ["a", "ab", "The quick. ", "ä", "x" * 50 + "\n"])
def test_periodic_texts_have_short_fingerprints(unit):
    text = unit * (200_000 // len(unit))
    own = P.fingerprint(text)
    assert len(own) < 1300
    assert P.likeness(own, P.fingerprint(text[:-20_000] + "zq y" * 5000)) > .5


def test_likeness_of_copies_and_strangers():
    rng = random.Random(5)
    for n in (60, 400, 4000):
        text, other = prose(rng, n), prose(rng, n)
        words = text.split()
        for at in range(0, n, max(n // 10, 40)):
            words[at] = "changed"
        own = P.fingerprint(text)
        assert P.likeness(own, own) == 1.0
        assert P.likeness(own, P.fingerprint(" ".join(words))) > .5
        assert P.likeness(own, P.fingerprint(other)) < .2
        assert P.likeness(own, P.fingerprint(text + text)) <= 1
    assert P.likeness(P.fingerprint(text), P.fingerprint(text[:50])) == 0  # no common block size
    assert P.fingerprint("") == "0::" and P.likeness("0::", "0::") == 1 and P.likeness("0::", P.fingerprint("abc")) == 0


def test_next_documents_over_many_ranges(spark):
    rng = random.Random(6)
    rows = [(i * 3 - 50, prose(rng, rng.randint(0, 80))) for i in range(300)]
    mixed = rows[:]
    rng.shuffle(mixed)
    assert found(spark.createDataFrame(mixed, SCHEMA).repartition(7)) == brute(rows)


def test_fewer_documents_than_ranges(spark):
    rows = [(5, "eight ch"), (9, "0123456789")]
    assert found(spark.createDataFrame(rows[::-1], SCHEMA)) == brute(rows)
    assert [r[2] for r in brute(rows)] == [hashlib.sha256(x).hexdigest() for x in (b"eight 01", b"01234567ei")]
    assert found(spark.createDataFrame(rows[:1], SCHEMA)) == brute(rows[:1])


def test_nulls_repeats_long_texts_and_other_columns(spark):
    rng = random.Random(9)
    long = prose(rng, 60_000)
    rows = [(None, "no id"), (1, None), (2, ""), (3, long), (4, long), (5, "ünï \U0001f600" * 9)]
    frame = spark.createDataFrame(rows[::-1], SCHEMA)
    for name in ("tie", "rid", "part", "edge", "after", "fingerprint"):
        frame = frame.withColumn(name, F.lit("x"))
    assert found(frame) == brute(rows)
    # many equal rows: all but the last are followed by themselves
    same = [(1, "one text that stands here")] * 50 + [(2, "another text, after it")]
    assert found(spark.createDataFrame(same, SCHEMA).repartition(5)) == brute(same)


def test_empty_table(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
