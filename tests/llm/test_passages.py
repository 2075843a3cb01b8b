"""The pipeline's cut of repeated passages against brute force over words."""

import random

import corpus_pipeline

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"


def stage(spark, rows):
    full = spark.createDataFrame([(d, t, "en", "s", len(t or "")) for d, t in rows], SCHEMA)
    found = corpus_pipeline.cut_repeats(spark, full, "")
    assert found.columns == full.columns
    return {r.doc_id: (r.text or "").split() for r in found.collect()}


def brute(rows, n=51):
    seen = {}
    for d, text in rows:
        words = (text or "").split()
        for i in range(len(words) - n + 1):
            seen.setdefault(tuple(words[i:i + n]), []).append((d, i))
    gone = {(d, j) for places in seen.values() if len(places) > 1 for d, i in places for j in range(i, i + n)}
    return {d: [w for j, w in enumerate((t or "").split()) if (d, j) not in gone] for d, t in rows}


def prose(rng, n, letters=4):
    return ["".join(rng.choices("abcdefghij", k=rng.randint(1, letters))) for _ in range(n)]


def test_passages_of_51_words_are_cut_in_all_places(spark):
    """Short words: 51 of them are far below 400 bytes; 50 stay."""
    rng = random.Random(4)
    passages = [prose(rng, n, letters) for n, letters in ((51, 1), (51, 4), (62, 5), (50, 9), (49, 5), (51, 12))]
    rows = []
    for d in range(60):
        words = prose(rng, rng.randint(0, 80))
        words += passages[d % 6] + prose(rng, rng.randint(1, 90), 6)
        if d % 7 == 0:
            words += passages[rng.randrange(6)] + prose(rng, 5)
        rows.append((d, "".join(w + rng.choice([" ", "\n", "  "]) for w in words)))
    rows += [(100, None), (101, ""), (102, " ".join(["x"] * 300)), (103, " ".join(prose(rng, 5000)))]
    want = brute(rows)
    assert stage(spark, rows) == want
    assert sum(len(t.split()) for _, t in rows if t) - sum(map(len, want.values())) > 51 * 30


def test_text_without_spaces_counts_characters(spark):
    rng = random.Random(6)
    shared = "".join(chr(rng.randint(0x4e00, 0x9000)) for _ in range(60))
    rows = [(d, "".join(chr(rng.randint(0x4e00, 0x9000)) for _ in range(40)) + shared) for d in range(2)]
    assert stage(spark, rows) == {d: [t[:40]] for d, t in rows}


def brute_counts(rows, n=51):
    """(runs of repeated passages, their words) per document."""
    out = {}
    for d, kept in brute(rows, n).items():
        words = next((t or "") for x, t in rows if x == d).split()
        out[d] = len(words) - len(kept)
    return out


def test_query_counts_passages_beside_bytes(spark):
    """Passages of 51 words that 400 bytes do not reach show in the added columns."""
    from rillhouse.llm.suffix_dedup import repeated_spans

    rng = random.Random(12)
    passage = prose(rng, 51, 3)
    rows = [(d, " ".join(prose(rng, 20 + d) + (passage if d % 3 == 0 else []) + prose(rng, 9))) for d in range(12)]
    rows += [(20, None), (21, ""), (22, " ".join(["y"] * 200))]
    found = {r.doc_id: r for r in repeated_spans(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    want = brute_counts(rows)
    assert {d: r.n_passage_words for d, r in found.items()} == want
    assert all(found[d].n_passages == (want[d] > 0) for d in want)
    assert all(found[d].n_removed == 0 and want[d] == 51 for d in range(0, 12, 3))


def test_very_many_equal_rows(spark):
    """10,000 equal rows, with and without an id, and one more text that holds theirs."""
    from rillhouse.llm.suffix_dedup import cut_passages, repeated_spans

    rng = random.Random(13)
    text, other = " ".join(prose(rng, 200, 6)), " ".join(prose(rng, 90, 6))
    rows = [(None, text)] * 6000 + [(7, text)] * 4000 + [(8, other + " " + text), (9, other[:100])]
    frame = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = repeated_spans(frame).groupBy("doc_id", "n_removed", "n_spans", "n_passage_words").count().collect()
    assert sorted(map(tuple, found), key=repr) == sorted(
        [(None, len(text), 1, 200, 6000), (7, len(text), 1, 200, 4000), (8, len(text), 1, 200, 1), (9, 0, 0, 0, 1)], key=repr)
    kept = cut_passages(frame).groupBy("text").count().collect()
    assert sorted(map(tuple, kept)) == sorted([("", 10000), (other + " ", 1), (other[:100], 1)])


def test_extra_columns_keep_their_names(spark):
    from pyspark.sql import functions as F

    from rillhouse.llm.suffix_dedup import cut_documents, cut_passages

    rng = random.Random(14)
    shared = " ".join(prose(rng, 150, 6))
    frame = spark.createDataFrame([(1, "a " + shared), (2, shared + " b"), (3, None)], "doc_id bigint, text string")
    names = ["_k1", "k1", "k2", "found", "row", "whole", "begin", "_begins", "a.b"]
    for name in names:
        frame = frame.withColumn(name, F.lit(f"value of {name}"))
    for cut in (cut_documents, cut_passages):
        got = cut(frame)
        assert got.columns == frame.columns
        rows = got.collect()
        assert {r.doc_id: (r.text or "").strip() for r in rows} == {1: "a", 2: "b", 3: ""}
        assert all(r[n] == f"value of {n}" for r in rows for n in names)


def test_search_keeps_only_what_it_still_reads(spark, monkeypatch):
    """When the texts are shuffled, what the steps before them stored is deleted."""
    from pathlib import Path

    from rillhouse.llm import common, suffix_dedup

    rng = random.Random(9)
    passage = prose(rng, 70)
    rows = [(d, " ".join(prose(rng, 60) + passage + prose(rng, 60))) for d in range(12)]
    documents = spark.createDataFrame(rows, "doc_id bigint, text string")
    since, left, with_bytes = len(common._folders), [], suffix_dedup._with_bytes

    def looked(*given):
        left.extend(f.rsplit("/", 1)[1].rsplit("-", 1)[0] for f in common._folders[since:]
                    if Path(f.removeprefix("file:")).exists())
        return with_bytes(*given)

    monkeypatch.setattr(suffix_dedup, "_with_bytes", looked)
    found = suffix_dedup._word_spans(suffix_dedup.keyed(documents), 51).collect()
    assert set(left) == {"covered", "wanted"}
    assert len({r.k1 for r in found}) == 12 and min(r.finish - r.begin for r in found) >= 51


def test_search_has_one_python_step_a_task(spark):
    """Steps on each other's rows run side by side, with a worker each: memory of four for two cores."""
    from rillhouse.llm import suffix_dedup

    rng = random.Random(10)
    passage = prose(rng, 70)
    rows = [(d, " ".join(prose(rng, 60) + passage + prose(rng, 60))) for d in range(12)]
    documents = suffix_dedup.keyed(spark.createDataFrame(rows, "doc_id bigint, text string"))

    def steps(node):
        """(Python steps in a row above, at most) of a plan."""
        below = [steps(node.children().apply(i)) for i in range(node.children().size())]
        chain = max([0, *(x[0] for x in below)])
        here = chain + 1 if "InArrow" in node.nodeName() else 0 if len(below) != 1 or "epartition" in node.nodeName() else chain
        return here, max([here, *(x[1] for x in below)])

    found = suffix_dedup.spans(documents, 100, 2)
    assert steps(found._jdf.queryExecution().optimizedPlan())[1] == 1
    assert found.count() >= 12


def test_word_codes_follow_the_words():
    """One code a word, equal for equal words only, whatever characters they have."""
    from rillhouse.llm.suffix_dedup import WORD, anchors, word_codes

    rng, names = random.Random(11), {}
    some = ["a", "b", "c", " ", "\n", "\u3000", "\u4e00", "\u0e01", "\u00e9", "\U00020001", "\x1c", "\u200b", "x" * 70, "\U0001F600"]
    for _ in range(500):
        text = "".join(rng.choices(some, k=rng.randint(0, 60)))
        words, codes = WORD.findall(text), word_codes(text).tolist()
        assert len(words) == len(codes)
        assert all(names.setdefault(w, c) == c for w, c in zip(words, codes))
    assert len(set(names.values())) == len(names)
    # the search goes by words: 51 of them are the window, not 204 bytes
    place, _, _, left, right = anchors(word_codes(" ".join(prose(rng, 400))), 51)
    assert len(place) and place.max() < 400 and right.max() == 51 and left.max() == 31


def test_runs_of_many_rows_at_once():
    import pyarrow as pa

    from rillhouse.llm.suffix_dedup import merged, merged_rows

    rng = random.Random(15)
    rows = [None if rng.random() < .2 else [
        {"begin": (a := rng.randrange(90)), "finish": a + rng.randint(1, 9)} for _ in range(rng.choice([0, 1, 8]))]
        for _ in range(200)]
    column = pa.array(rows, pa.list_(pa.struct([("begin", pa.int64()), ("finish", pa.int64())])))
    for part, given in ((column, rows), (column.slice(50, 100), rows[50:150]), (column.slice(0, 0), [])):
        ends, begin, finish = (x.tolist() for x in merged_rows(part))
        found = [list(zip(begin[a:b], finish[a:b])) for a, b in zip([0, *ends], ends)]
        assert found == [merged([x["begin"] for x in r or []], [x["finish"] for x in r or []]) for r in given]
