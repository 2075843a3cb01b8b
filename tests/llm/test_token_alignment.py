import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from rillhouse.llm import token_alignment as T

SCHEMA = "doc_id bigint, text string"
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
ODD = ["Hello world", " two  spaces\t\ttab\n\nline", "ünïcödé \U0001f600\U0001f468‍\U0001f469", "<|endoftext|> is text",
       "</s><s><unk> <0x41>", "日本語のテキスト", "▁ own mark", "a\x00b", "", None, "½ ① Ⅷ ﬁ", "é ﻿", "x" * 3000,
       "tokenization misalignments everywhere", "\r\n", " ", "नमस्ते"]


def libraries():
    import public_tokenizers as public
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public.path("piece_bpe_32k.model"))


def byte_alphabet():
    """Characters that stand for bytes in the byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


def brute(rows):
    """By sets of byte positions, token by token."""
    a_tok, b_tok = libraries()
    alphabet = byte_alphabet()
    docs, counts = [], Counter()
    for doc, text in rows:
        a = a_tok.encode(" " + text, add_special_tokens=False).ids if text else []
        b = b_tok.encode(text) if text else []
        a_bytes = [bytes(alphabet[c] for c in a_tok.id_to_token(i)) for i in a]
        b_bytes = [bytes([int(p[3:5], 16)]) if len(p) == 6 and p.startswith("<0x") else p.replace("▁", " ").encode()
                   for p in map(b_tok.id_to_piece, b)]
        if not text or not b"".join(a_bytes) == b"".join(b_bytes) == (" " + text).encode():
            docs.append((doc, 0, 0, 0, [], ""))
            continue
        a_ends, b_ends = ([sum(map(len, x[:i + 1])) for i in range(len(x))] if len(x) < 400 else np.cumsum([len(y) for y in x]).tolist()
                          for x in (a_bytes, b_bytes))
        spans_a = list(zip([0, *a_ends], a_ends))
        spans_b = list(zip([0, *b_ends], b_ends))
        links = [(x, y) for x, (s, e) in zip(a, spans_a) for y, (p, q) in zip(b, spans_b) if s < q and p < e]
        groups, low = [], 0
        for cut in sorted(set(a_ends) & set(b_ends)):
            groups.append("|".join(",".join(str(i) for i, e in zip(ids, ends) if low < e <= cut)
                                   for ids, ends in ((a, a_ends), (b, b_ends))))
            low = cut
        docs.append((doc, len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest()))
        counts.update(set(links))
    best = defaultdict(int)
    for (x, _), n in counts.items():
        best[x] = max(best[x], n)
    return sorted(((d, n, m, g, len(links), sum(counts[p] == best[p[0]] for p in links), sum(counts[p] for p in links), sha)
                   for d, n, m, g, links, sha in docs), key=repr)


def found(frame, **options):
    return sorted(map(tuple, T.alignment(frame, **options).select(*COLUMNS).collect()), key=repr)


def prose(rng, n):
    words = ["".join(rng.choices("abcdefghijklmnop éñ\n1.", k=rng.randint(1, 9))) for _ in range(60)]
    return " ".join(rng.choices(words, k=n))


def test_coalesced_groups_like_a_sweep():
    rng = random.Random(1)
    for _ in range(200):
        starts = [rng.randint(0, 60) for _ in range(rng.randint(1, 30))]
        spans = [(s, s + rng.randint(1, 9)) for s in starts]
        group = T.coalesced(*(np.array(x) for x in zip(*spans)))
        covered = {x for s, e in spans for x in range(s, e - 1)}  # joints inside an interval
        for (s, e), g in zip(spans, group):
            for (p, q), h in zip(spans, group):
                joined = all(x in covered for x in range(min(s, p), max(e, q) - 1))
                assert (g == h) == joined


def test_like_brute_force_on_odd_texts(spark):
    rows = list(enumerate(ODD)) + [(100 + i, x) for i, x in enumerate(ODD[:6])]
    got = found(spark.createDataFrame(rows, SCHEMA))
    assert got == brute(rows)
    assert sum(r[1] == 0 and r[7] == "" for r in got) >= 3
    assert any(r[3] < min(r[1], r[2]) for r in got)  # groups of several tokens on both sides


def test_like_brute_force_over_blocks(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randint(0, 30))) for i in range(120)]
    want = brute(rows)
    assert found(spark.createDataFrame(rows, SCHEMA).repartition(3)) == want
    import pyarrow as pa
    monkeypatch.setattr(T, "BLOCK_ROWS", 7)
    monkeypatch.setattr(T, "BLOCK_BYTES", 200)
    batch = pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["a", "b"])
    bounds = list(T._blocks(batch.slice(5)))
    assert [b for b, _ in bounds[1:]] == [e for _, e in bounds[:-1]] and bounds[0][0] == 0 and bounds[-1][1] == 115
    for b, e in bounds:
        size = sum(len((rows[5 + i][1] or "").encode()) for i in range(b, e))
        assert e - b <= 7 and (size <= 200 or e - b == 1)


def test_groups_hold_whole_links():
    pair = T.tokenizer_pair()
    rng = random.Random(3)
    found = T.Aligned(pair, [prose(rng, 50), "", "x" * 500, None, *ODD[:9]])
    group_a, group_b = found.group[:len(found.a)], found.group[len(found.a):]
    assert (group_a[found.link_a] == group_b[found.link_b]).all()
    assert len(found.link_a) == len(set(zip(found.link_a.tolist(), found.link_b.tolist())))


@pytest.mark.parametrize("name, sep", [("byte_bpe_50k", " ")])
def test_same_ids_as_the_tokenizers_library(name, sep):
    a_tok, _ = libraries()
    pair = T.tokenizer_pair()
    rng = random.Random(4)
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for _ in range(150):
        text = sep.join("".join(chr(rng.choice(codes[:3000] + [rng.choice(codes)])) for _ in range(6)) for _ in range(20))
        assert pair.encode_a(text) == a_tok.encode(text, add_special_tokens=False).ids


def test_repeats_null_ids_long_text_and_other_columns(spark):
    rows = [(1, "same text here")] * 40 + [(None, "same text here"), (2, prose(random.Random(5), 400)), (3, None)]
    frame = spark.createDataFrame(rows, SCHEMA)
    for name in ("rid", "block", "pairs", "times", "count", "a", "in_block"):
        frame = frame.withColumn(name, F.lit("x"))
    assert found(frame) == brute(rows)
    long = [(1, prose(random.Random(6), 60_000)), (2, "short")]
    got = found(spark.createDataFrame(long, SCHEMA))
    assert len(got) == 2 and got[0][4] >= max(got[0][1], got[0][2])


def test_empty_tables(spark):
    assert found(spark.createDataFrame([], SCHEMA)) == []
    assert found(spark.createDataFrame([(1, None), (2, "")], SCHEMA)) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]
