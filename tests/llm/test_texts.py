"""Operators on documents against brute-force versions, and their odd inputs."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rillhouse.llm import (
    chunk_bpe, exact_dedup, language_id, licenses, packing, simhash, suffix_dedup,
)
from rillhouse.llm.components import components

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, fp string, k1 string, gram string"


def frame(spark, rows):
    """Documents with extra columns whose names clash with inner ones."""
    full = [(d, t, "en", "s", len(t or ""), "x", "y", "z") for d, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def prose(rng, n):
    return " ".join("".join(rng.choices(["the", "er", "on", "an", "re", "st"], k=rng.randint(1, 4)))
                    for _ in range(n))


@pytest.fixture(scope="module")
def odd():
    """Null, empty, blank, very long, repeated and tied rows."""
    rng = random.Random(5)
    body = prose(rng, 400)
    return [(1, None), (2, ""), (3, " \n\t"), (4, body), (5, body), (5, body), (6, body + "  "),
            (7, prose(rng, 30_000)), (8, "a"), (9, "É à ü"), (None, body), (None, None),
            (10, prose(rng, 90) + "\n" + body[:900] + "\n" + prose(rng, 60)), (11, "aaaa" * 900),
            (12, "x" + body[1:])]


# ------------------------------------------------------------------ suffix-array dedup

def brute_repeats(rows, length):
    seen = {}
    for i, (_, text) in enumerate(rows):
        data = (text or "").encode()
        for p in range(len(data) - length + 1):
            seen.setdefault(data[p:p + length], []).append((i, p))
    out = []
    flags = [np.zeros(len((t or "").encode()), bool) for _, t in rows]
    for places in seen.values():
        if len(places) > 1:
            for i, p in places:
                flags[i][p:p + length] = True
    for (doc, text), flag in zip(rows, flags):
        data = np.frombuffer((text or "").encode(), np.uint8)
        runs = int((np.diff(np.concatenate([[0], flag.astype(int)])) == 1).sum())
        out.append((doc, len(data), int(flag.sum()), runs, hashlib.sha256(data[~flag].tobytes()).hexdigest()))
    return sorted(out, key=repr)


def as_rows(found, *names):
    return sorted((tuple(r[n] for n in names) for r in found.collect()), key=repr)


REPEAT = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_repeats_of_odd_rows(spark, odd):
    found = suffix_dedup.repeated_spans(frame(spark, odd))
    assert as_rows(found, *REPEAT) == brute_repeats(odd, 400)


@pytest.mark.parametrize("group", [0, 5000])
def test_repeats_at_borders(spark, group, monkeypatch):
    """Passages in different surroundings, sorted (large group) or counted (group 0)."""
    monkeypatch.setattr(suffix_dedup.spans, "__defaults__", (400, group))
    rng = random.Random(11)
    passages = [prose(rng, n) for n in (70, 75, 80, 100, 160)]
    rows = []
    for d in range(40):
        parts = []
        for _ in range(rng.randint(1, 4)):
            p = rng.choice(passages)
            a, b = rng.randint(0, 60), rng.randint(0, 60)
            parts += [prose(rng, rng.randint(0, 40)), p[a:len(p) - b]]
        rows.append((d, " ".join(parts)))
    found = suffix_dedup.repeated_spans(frame(spark, rows))
    want = brute_repeats(rows, 400)
    assert as_rows(found, *REPEAT) == want
    assert any(r[2] for r in want) and any(not r[2] for r in want)


def test_repeats_of_given_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    pairs = [(r.doc_id, r.text) for r in rows.collect()]
    assert as_rows(suffix_dedup.repeated_spans(rows), *REPEAT) == brute_repeats(pairs, 400)


def test_long_text_in_blocks(monkeypatch):
    rng = random.Random(3)
    data = prose(rng, 3000).encode()
    whole = suffix_dedup.anchors(data)
    monkeypatch.setattr(suffix_dedup, "BLOCK", 1000)
    monkeypatch.setattr(suffix_dedup, "_rolling", {})
    for a, b in zip(whole, suffix_dedup.anchors(data)):
        assert np.array_equal(a, b)


def test_deep_shallow_sorts():
    rng = random.Random(2)
    base = [prose(rng, 30).encode() for _ in range(3)]
    texts = [rng.choice(base)[: rng.randint(0, 200)] + bytes(rng.choices(b"ab\0", k=rng.randint(0, 3)))
             for _ in range(300)]
    groups = np.array([rng.randint(0, 4) for _ in texts])
    order, shared = suffix_dedup.deep_shallow(texts, groups)
    # a string that ends inside the shallow depth may stand next to its own extension
    assert [groups[i] for i in order] == sorted(groups)
    for k, i in enumerate(order):
        if shared[k] < 0:
            assert k == 0 or groups[order[k - 1]] != groups[i]
        else:
            a, b = texts[order[k - 1]], texts[i]
            assert a <= b
            assert a[:shared[k]] == b[:shared[k]]
            assert shared[k] == min(len(a), len(b)) or a[shared[k]] != b[shared[k]]


def test_cut_keeps_columns(spark, odd):
    rows = frame(spark, odd)
    cut = suffix_dedup.cut_documents(rows)
    assert cut.columns == rows.columns and cut.count() == len(odd)
    assert cut.filter("doc_id = 4").first()["text"] == ""


# ------------------------------------------------------------------ exact dedup

def test_exact_against_brute_force(spark, odd):
    found = exact_dedup.exact_dedup(frame(spark, odd)).collect()
    norm = [re.sub("[\x20\x09-\x0d]", "", t or "") for _, t in odd]
    assert len(found) == len(odd)
    for sha in {r.text_sha256 for r in found}:
        mine = [(d, t) for (d, t), n in zip(odd, norm) if hashlib.sha256(n.encode()).hexdigest() == sha]
        keep = min(mine, key=lambda x: (-len(x[1] or ""), x[0] is None, x[0] or 0))[0]
        rows = [r for r in found if r.text_sha256 == sha]
        assert {r.keep_id for r in rows} == {keep} and {r.group_size for r in rows} == {len(mine)}
        assert sum(r.kept for r in rows) == 1


@pytest.mark.parametrize("share", [1, 2, 50])
def test_batches_do_not_matter(spark, odd, share):
    rows = frame(spark, odd)
    want = as_rows(exact_dedup.exact_dedup(rows), "doc_id", "keep_id", "group_size", "text_sha256")
    assert as_rows(exact_dedup.exact_dedup(rows, share), "doc_id", "keep_id", "group_size", "text_sha256") == want


def test_filter_never_misses():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 3, 50, 5000):
        keys = rng.integers(-2 ** 63, 2 ** 63 - 1, n)
        made = exact_dedup.build_filter(keys)
        assert exact_dedup.probe_filter(keys, *made).all()
        others = rng.integers(-2 ** 63, 2 ** 63 - 1, 20_000)
        assert exact_dedup.probe_filter(others, *made).mean() < 0.002


def test_dedup_keeps_one_of_each(spark, odd):
    kept = exact_dedup.deduplicated(frame(spark, odd))
    texts = [re.sub("[\x20\x09-\x0d]", "", r.text or "") for r in kept.collect()]
    assert len(texts) == len(set(texts)) == len({re.sub("[\x20\x09-\x0d]", "", t or "") for _, t in odd})


# ------------------------------------------------------------------ simhash

def brute_print(text, width=3):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    n = max(1, len(words) - width + 1)
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + width]).encode(), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > n)


def brute_components(prints, bits=3):
    root = list(range(len(prints)))
    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= bits:
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return root


def test_fingerprints(spark, odd, monkeypatch):
    monkeypatch.setattr(simhash, "BLOCK_BYTES", 700)
    for _, text in odd:
        assert simhash.fingerprint(text or "") == brute_print(text)


def test_near_duplicates_against_brute_force(spark):
    rng = random.Random(4)
    rows = []
    for d in range(60):
        words = prose(rng, 300).split() if d % 3 == 0 else words  # noqa: F821
        if d % 3:
            words = list(words)
            words[rng.randrange(300)] = prose(rng, 1)
        rows.append((d, " ".join(words)))
    rows += [(100, None), (101, " "), (5, rows[5][1]), (None, rows[8][1])]
    prints = [brute_print(t) for _, t in rows]
    root = brute_components(prints)
    least = {r: min((d for (d, _), q in zip(rows, root) if q == r and d is not None), default=None) for r in root}
    want = sorted(((d, least[r]) for (d, _), r in zip(rows, root)), key=repr)
    found = simhash.near_duplicates(frame(spark, rows))
    assert as_rows(found, "doc_id", "component_id") == want
    assert len({c for _, c in want}) < len(want) - 10


def test_links_of_crowded_lists(spark):
    """Fingerprints that share five bytes, hundreds in a list."""
    rng = np.random.default_rng(8)
    base = int(rng.integers(0, 2 ** 63))
    prints = sorted({base ^ int(x) for x in rng.integers(0, 1 << 12, 700)})
    df = spark.createDataFrame([(p,) for p in prints], "fp bigint")
    roots = {r.node: r.root for r in components(simhash.links(df)).collect()}
    want = brute_components(prints)
    assert [roots.get(p, p) for p in prints] == [prints[r] for r in want]


def test_components_of_chain_and_star(spark):
    edges = [(i + 1, i) for i in range(200)] + [(1000 + i, 500) for i in range(200)]
    found = components(spark.createDataFrame(edges, "hi bigint, lo bigint")).collect()
    assert {r.node: r.root for r in found} == {**{i: 0 for i in range(1, 201)},
                                               **{1000 + i: 500 for i in range(200)}}


# ------------------------------------------------------------------ licenses

def brute_scan(text, templates, threshold):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    pattern = "[^\x00-\x2f\x3a-\x60\x7b-\x7f]+"
    words = re.findall(pattern, low)
    places = [(i, label) for phrase, label in licenses.PHRASES.items()
              for i in range(len(words)) if words[i:i + len(phrase.split())] == phrase.split()]
    base, best = {x for _, x in places}, {}
    for block in low.split("\n"):
        have = set(re.findall(pattern, block))
        for label, t in templates:
            share = len(have & set(t.split())) / len(set(t.split()))
            if share >= threshold - 1e-12:
                best[label] = max(best.get(label, 0), share)
    starts = [i for i, _ in places]
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)),
            ",".join(sorted(base | set(best))), 1.0 if base else max(best.values(), default=0.0))


NOTICES = ["Released under the MIT License.", "Licensed under the Apache License, Version 2.0.",
           "Under the MIT license under the mit license", "licence cc-by-nc, 4 0 licensed",
           "This work is licensed under GNU General Public License v 3", "the work is under general version"]


def test_licenses_against_brute_force(spark, odd):
    rng = random.Random(9)
    rows = list(odd) + [(100 + i, prose(rng, 20) + "\n" + rng.choice(NOTICES) + " " + prose(rng, rng.randint(0, 3)))
                        for i in range(60)]
    found = licenses.scan(frame(spark, rows))
    want = sorted(((d, *brute_scan(t, licenses.TEMPLATES, 0.8)) for d, t in rows), key=repr)
    assert as_rows(found, "doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
                   "score") == want


def test_licenses_of_given_documents(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    want = sorted((r.doc_id, *brute_scan(r.text, licenses.TEMPLATES, 0.8)) for r in rows.collect())
    found = licenses.scan(rows)
    assert as_rows(found, *found.columns) == sorted(want, key=repr)


# ------------------------------------------------------------------ tokens

WEIRD = ["", " ", "  a  b ", "it's  we'll\tgo\n\nnow", "a<|endoftext|> b<|startoftext|>c", "ÀÉ ß Σας ΟΔΟΣ", "x" * 5000,
         "汉字 かな 한국어", "é a ́b c d", "1234 5,6.7 --- !!", "\x1c\x1d a\x85b", "tab\t  end  "]


def test_chunked_ids_equal_the_library(spark, odd):
    import public_tokenizers as public
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public.path("word_bpe_49k.json"))
    rng = random.Random(6)
    texts = [t or "" for _, t in odd] + WEIRD + [prose(rng, 900) for _ in range(5)]
    rows = list(enumerate(texts)) + [(None, None)]
    want = []
    for d, t in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        want.append((d, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(),
                     hashlib.sha256(back.encode()).hexdigest()))
    found = chunk_bpe.encoded(frame(spark, rows))
    assert as_rows(found, *found.columns) == sorted(want, key=repr)


def test_chunks_are_cut_by_content():
    rng = random.Random(1)
    passage = prose(rng, 800).encode()
    a, b = (chunk_bpe.cuts(prefix + passage) for prefix in (b"some words before ", b"x"))
    assert len({x - 18 for x in a} & {x - 1 for x in b}) >= len(b) - 2 > 3


def test_packing_against_the_library(spark, odd):
    import public_tokenizers as public
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    rows = list(odd) + [(200 + i, t) for i, t in enumerate(WEIRD)]
    ids = {}
    for d, t in rows:
        ids.setdefault(d, []).append(library.encode(t or "", add_special_tokens=False).ids + [2])
    found = packing.pack(frame(spark, rows), with_ids=True).collect()
    used = {}
    for r in found:
        assert len(r.ids) == r.length and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        assert any(x[r.start:r.start + r.length] == r.ids for x in ids[r.doc_id])
        used.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert sum(r.length for r in found) == sum(len(x) for v in ids.values() for x in v)
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 1024
    assert all(r.length == 1024 for r in found if r.piece > 0)
    total = sum(r.length for r in found)
    assert len(used) <= -(-total // 1024) + 1


def test_bin_completion_meets_the_optimum():
    def optimum(items, capacity):
        best = [len(items)]

        def go(i, bins):
            if len(bins) >= best[0]:
                return
            if i == len(items):
                best[0] = len(bins)
                return
            for k in range(len(bins)):
                if bins[k] + items[i] <= capacity:
                    go(i + 1, bins[:k] + [bins[k] + items[i]] + bins[k + 1:])
            go(i + 1, bins + [items[i]])

        go(0, [])
        return best[0]

    rng = random.Random(12)
    better = 0
    for _ in range(60):
        items = sorted((rng.randint(3, 30) for _ in range(rng.randint(1, 9))), reverse=True)
        counts = {s: items.count(s) for s in items}
        made = packing.plan(counts, 40)
        given = {}
        for filling, times in made:
            assert sum(s * n for s, n in filling) <= 40
            for s, n in filling:
                given[s] = given.get(s, 0) + n * times
        assert given == counts
        assert sum(t for _, t in made) <= optimum(items, 40) + 1
        better += sum(t for _, t in made) == optimum(items, 40)
    assert better >= 57


def test_places_are_gapless():
    rng = random.Random(3)
    counts = {s: rng.randint(1, 50) for s in rng.sample(range(1, 1024), 300)}
    places = packing.Places.of(packing.plan(counts))
    used = {}
    for size, n in counts.items():
        for rank in range(n):
            sequence, offset = places.place(size, rank)
            used.setdefault(sequence, []).append((offset, size))
    for spots in used.values():
        at = 0
        for offset, size in sorted(spots):
            assert offset == at
            at += size
        assert at <= 1024
    assert len(used) == places.sequences
    assert places.sequences <= packing.lower_bound(counts, 1024) + 1


# ------------------------------------------------------------------ language

def test_language_accuracy_on_held_out_rows(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    net = language_id.fit(rows.filter(~held))
    found = language_id.predicted(rows, net, held).join(rows.select("doc_id", "lang"), "doc_id")
    tested = found.filter("held_out")
    assert tested.count() > 150
    assert tested.filter("lang = lang_pred").count() >= 0.97 * tested.count()
    assert found.filter("score < 0 OR score > 1").count() == 0


def test_language_of_odd_rows(spark, odd):
    rows = frame(spark, odd + [(300, "123 !?"), (301, "...")])
    net = language_id.fit(rows)
    found = {r.doc_id: r for r in language_id.predicted(rows, net, F.lit(False)).collect()}
    assert found[1].lang_pred == found[2].lang_pred == found[300].lang_pred == "und"
    assert found[4].lang_pred == "en" and found[4].score == pytest.approx(1)
    empty = language_id.fit(rows.filter("false"))
    assert empty is None
    assert {r.lang_pred for r in language_id.predicted(rows, None, F.lit(None)).collect()} == {"und"}


def test_gradients_match_differences():
    rng = np.random.default_rng(0)
    windows, labels = rng.integers(1, 255, (4, language_id.WINDOW)).astype(np.uint8), np.array([0, 1, 1, 0])
    net = language_id.ByteConvNet.fresh(["a", "b"])
    for name in ("embed", "kernel", "bias", "dense", "dense_bias"):
        setattr(net, name, getattr(net, name).astype(np.float64))
    parts = [net.embed, net.kernel, net.bias, net.dense, net.dense_bias]

    def loss():
        return -np.log(net.probabilities(windows)[np.arange(4), labels]).mean()

    for p, g in zip(parts, net.gradients(windows, labels)):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        kept, step = p[at], 1e-6
        p[at] = kept + step
        up = loss()
        p[at] = kept - step
        down = loss()
        p[at] = kept
        assert (up - down) / (2 * step) == pytest.approx(g[at], rel=1e-3)


# ------------------------------------------------------------------ empty tables

def test_empty_tables(spark):
    none = frame(spark, [])
    made = [suffix_dedup.repeated_spans(none), exact_dedup.exact_dedup(none), simhash.near_duplicates(none),
            licenses.scan(none), packing.pack(none), chunk_bpe.encoded(none),
            language_id.predicted(none, language_id.fit(none), F.lit(False)),
            exact_dedup.deduplicated(none), simhash.one_of_each(none), suffix_dedup.cut_documents(none)]
    assert [x.count() for x in made] == [0] * len(made)
