"""Near-dedup of the pipeline against brute force of the five-word similarity."""

import random
import re

import pytest

import corpus_pipeline
from rillhouse.llm import near_dedup, simhash

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def word_set(text):
    words = re.findall(r"[^\x20\x09-\x0d]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


def similar(a, b):
    return len(a & b) >= 0.8 * len(a | b) - 1e-9


def brute_kept(rows):
    """Ids that stay: the smallest of each component of the similarity."""
    sets = [word_set(t) for _, t in rows]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if root[i] != root[j] and similar(sets[i], sets[j]):
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = [new if r == old else r for r in root]
    return sorted({min(d for (d, _), q in zip(rows, root) if q == r) for r in root})


def prose(rng, n):
    return ["".join(rng.choices(["ka", "lo", "mi", "nu", "pe", "ri"], k=rng.randint(1, 4))) for _ in range(n)]


def changed(rng, words, n):
    words = list(words)
    for at in rng.sample(range(len(words)), n):
        words[at] = "x" + str(rng.random())
    return words


def kept(spark, rows):
    full = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], SCHEMA)
    found = corpus_pipeline.drop_near_copies(spark, full, "")
    assert found.columns == full.columns
    return sorted(r.doc_id for r in found.collect())


def test_stage_links_all_of_the_similarity(spark):
    """Copies from far above to just below 0.8, long and short, chains included."""
    rng = random.Random(8)
    rows = []
    for d in range(60):
        base = prose(rng, rng.choice([6, 12, 40, 300, 500]))
        rows.append((len(rows), " ".join(base)))
        for _ in range(rng.randint(0, 5)):
            copy = changed(rng, base, rng.randint(0, max(1, len(base) // 30)))
            rows.append((len(rows), " ".join(copy).replace("k", rng.choice("kK"))))
            base = rng.choice([base, copy])
    rows += [(len(rows), " ".join(prose(rng, 3))), (len(rows) + 1, None), (len(rows) + 2, " "),
             (len(rows) + 3, rows[7][1])]
    want = brute_kept(rows)
    assert kept(spark, rows) == want
    assert 60 <= len(want) < len(rows) - 30


@pytest.mark.parametrize("name", ["sf0.001"])
def test_stage_on_given_documents(spark, name):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"/root/testdata/{name}/documents.parquet").collect()]
    assert kept(spark, rows) == brute_kept(rows)


def test_members_of_one_list_meet_across_components(spark):
    """The smallest node of a list may be like neither of two that are like each other."""
    rng = random.Random(3)
    base = prose(rng, 400)
    rows = [(d, " ".join(changed(rng, base, 9))) for d in range(70)]
    rows += [(100 + d, " ".join(prose(rng, 4))) for d in range(5)]
    assert kept(spark, rows) == brute_kept(rows)
    assert near_dedup.one_of_each(spark.createDataFrame([], SCHEMA)).count() == 0


def test_near_copies_below_the_similarity_make_no_pair_rows(spark):
    """Members of a large group that are not alike make rows by their number, not its square."""
    rng = random.Random(7)
    base = [f"w{i}" for i in range(300)]
    rows = []
    for i in range(120):
        words = list(base)
        for at in rng.sample(range(300), 7):
            words[at] = f"x{i}_{at}"
        rows.append((i, " ".join(words)))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    counted, by_tile = [], near_dedup._by_tile

    def counting(rows, work, schema):
        found = by_tile(rows, work, schema)
        counted.append(found.count())
        return found

    near_dedup._by_tile = counting
    try:
        found = {r.doc_id: r.component_id for r in near_dedup.near_copies(documents).collect()}
    finally:
        near_dedup._by_tile = by_tile
    sets = [set(near_dedup.shingles(t).tolist()) for _, t in rows]
    root = list(range(len(rows)))
    for _ in rows:
        for i, a in enumerate(sets):
            for j in range(i):
                if len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                    root[i] = root[j] = min(root[i], root[j])
    assert found == dict(enumerate(root))
    assert counted and counted[-1] < len(rows) * near_dedup.BANDS


def test_simhash_index_gives_candidates(spark, monkeypatch):
    """Without the other fingerprints, the byte-position index alone links what is within three
    bits, and the similarity still decides."""
    rng = random.Random(11)
    rows, want = [], {}
    for d in range(0, 40, 2):
        words = prose(rng, 400)
        rows += [(d, " ".join(words)), (d + 1, " ".join(words[:-1]))]
        want |= {d: d, d + 1: d}
    prints = [simhash.majority(simhash.votes_of(s), len(s)) for s in (near_dedup.shingles(t) for _, t in rows)]
    assert all((a ^ b).bit_count() <= 3 for a, b in zip(prints[::2], prints[1::2]))
    rows += [(50, rows[3][1].upper()), (51, None)]
    want |= {50: 2, 51: 51}
    entries = near_dedup._entries
    monkeypatch.setattr(near_dedup, "_entries", lambda sketches: entries(sketches).limit(0))
    documents = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near_dedup.near_copies(documents).collect()} == want
    monkeypatch.setattr(near_dedup, "_alike", lambda a, b: False)
    apart = {r.doc_id: r.component_id for r in near_dedup.near_copies(documents).collect()}
    assert apart == {d: d for d in want} | {50: 3}
