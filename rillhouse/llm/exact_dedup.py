"""Exact dedup: binary-fuse filters of immutable snapshots screen incoming digests.

Documents arrive in batches.  Those of a finished snapshot never change, so a static
filter can be built over its digests, one filter per hash bucket.  The digests of a new
batch are first grouped among themselves (copies inside the batch never meet the
snapshot), then screened by the filter of their bucket.  What the filter rejects is new
for certain; what it lets through joins the exact bucket, where key, byte length and the
256-bit digest of the normalised bytes are compared.

Defined results
* null text counts as empty; all texts that are empty after normalisation are equal.
* of equal texts the row with most code points stays, then the smallest ``doc_id``;
  a null ``doc_id`` comes after all others; of completely equal rows any one stays.
* repeated rows each appear in the result, at most one of them is kept.
* an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillhouse.llm.common import partitions, stored

#: Digests per filter at most on average; with it a filter takes about 120 kB.
KEYS_PER_FILTER = 50_000

_MASK = np.uint64(0xFFFFFFFFFFFFFFFF)


def normalised(text: Column) -> Column:
    """The text without white space of ASCII."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]", "")


# ------------------------------------------------------------------ binary fuse filter

def _mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser over key plus seed."""
    x = keys + np.uint64(seed)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def _shape(n: int) -> tuple[int, int]:
    """Length of a segment and number of starting segments for n keys."""
    if n < 2:
        return 4, 1
    length = min(1 << int(math.log(n) / math.log(3.33) + 2.25), 1 << 18)
    factor = max(1.125, 0.875 + 0.25 * math.log(1_000_000) / math.log(n))
    return length, max(1, -(-int(n * factor) // length) - 2)


def _slots(hashes: np.ndarray, length: int, segments: int) -> list[np.ndarray]:
    """Three places of each key, in three neighbouring segments."""
    first = ((hashes >> np.uint64(32)) * np.uint64(segments * length)) >> np.uint64(32)
    low = np.uint64(length - 1)
    second = (first + np.uint64(length)) ^ ((hashes >> np.uint64(18)) & low)
    third = (first + np.uint64(2 * length)) ^ (hashes & low)
    return [s.astype(np.int64) for s in (first, second, third)]


def _prints(hashes: np.ndarray) -> np.ndarray:
    return (hashes ^ (hashes >> np.uint64(32))).astype(np.uint16)


def build_filter(keys: np.ndarray) -> tuple[int, int, int, bytes]:
    """(seed, segment length, starting segments, fingerprints) over distinct 64-bit keys.

    Keys are peeled round by round: all that are alone in some slot at once.
    """
    keys = np.unique(keys.astype(np.uint64))
    length, segments = _shape(len(keys))
    size, seed = (segments + 2) * length, 0
    while True:
        seed += 0x9E3779B9
        hashes = _mixed(keys, seed)
        slots = np.stack(_slots(hashes, length, segments)) if len(keys) else np.zeros((3, 0), np.int64)
        count = np.bincount(slots.ravel(), minlength=size)
        owner = np.zeros(size, np.int64)
        for s in slots:
            np.bitwise_xor.at(owner, s, np.arange(len(keys)))
        rounds, left = [], len(keys)
        while left:
            alone = np.flatnonzero(count == 1)
            if not len(alone):
                break
            who, at = np.unique(owner[alone], return_index=True)
            rounds.append((who, alone[at]))
            for s in slots:
                np.subtract.at(count, s[who], 1)
                np.bitwise_xor.at(owner, s[who], who)
            left -= len(who)
        if not left:
            break
    prints, cells = _prints(hashes), np.zeros(size, np.uint16)
    for who, own in reversed(rounds):
        others = cells[slots[0][who]] ^ cells[slots[1][who]] ^ cells[slots[2][who]]
        cells[own] ^= prints[who] ^ others
    return seed, length, segments, cells.tobytes()


def probe_filter(keys: np.ndarray, seed: int, length: int, segments: int, cells: bytes) -> np.ndarray:
    """True where a key may be in; never False for one that is."""
    hashes = _mixed(keys.astype(np.uint64), seed)
    array = np.frombuffer(cells, np.uint16)
    a, b, c = _slots(hashes, length, segments)
    return array[a] ^ array[b] ^ array[c] == _prints(hashes)


# ------------------------------------------------------------------ the operator

_GROUP = "key bigint, sha string, size bigint, n bigint, less bigint, noid boolean, doc bigint, rid bigint"
_NAMES = [x.split()[0] for x in _GROUP.split(", ")]


def _groups(rows: DataFrame) -> DataFrame:
    """One row per distinct text: how many rows, and the one that stays."""
    best = F.min(F.struct("less", "noid", "doc", "rid")).alias("best")
    return (rows.groupBy("key", "sha", "size").agg(F.count(F.lit(1)).alias("n"), best)
            .select("key", "sha", "size", "n", "best.*"))


def snapshot_filters(groups: DataFrame, buckets: int) -> DataFrame:
    """(bucket, seed, length, segments, cells): the static filters of a snapshot."""
    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        seed, length, segments, cells = build_filter(pdf["key"].to_numpy())
        return pd.DataFrame({"bucket": [pdf["bucket"].iloc[0]], "seed": [seed], "length": [length],
                             "segments": [segments], "cells": [cells]})

    keyed = groups.select("key", F.pmod(F.hash("key"), F.lit(buckets)).alias("bucket"))
    return keyed.groupBy("bucket").applyInPandas(
        build, "bucket int, seed bigint, length bigint, segments bigint, cells binary")


def screen(groups: DataFrame, filters: DataFrame, buckets: int) -> DataFrame:
    """Incoming groups with ``maybe``: False where the snapshot cannot hold them."""
    def probe(new: pd.DataFrame, old: pd.DataFrame) -> pd.DataFrame:
        maybe = np.zeros(len(new), bool)
        for row in old.itertuples():
            maybe |= probe_filter(new["key"].to_numpy(), row.seed, row.length, row.segments, row.cells)
        return new[_NAMES].assign(maybe=maybe)

    keyed = groups.withColumn("bucket", F.pmod(F.hash("key"), F.lit(buckets)))
    return (keyed.groupBy("bucket").cogroup(filters.groupBy("bucket"))
            .applyInPandas(probe, _GROUP + ", maybe boolean"))


def digest_rows(documents: DataFrame) -> DataFrame:
    """One small row per document, evaluated once and stored; texts go no further."""
    text = normalised(F.col("text"))
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc"), text.alias("norm"),
                            F.length(F.coalesce("text", F.lit(""))).cast("bigint").alias("chars"))
    rows = rows.select(
        "doc", (-F.col("chars")).alias("less"), F.col("doc").isNull().alias("noid"),
        F.xxhash64("norm").alias("key"), F.sha2(F.col("norm").cast("binary"), 256).alias("sha"),
        F.octet_length("norm").cast("bigint").alias("size"),
        F.monotonically_increasing_id().alias("rid"))
    return stored(rows, "digests")


def duplicate_groups(snapshot: DataFrame, incoming: DataFrame) -> DataFrame:
    """Groups of equal texts over a snapshot and a new batch, both from ``digest_rows``."""
    spark = snapshot.sparkSession
    old, new = _groups(snapshot), _groups(incoming)
    buckets = max(partitions(spark), -(-snapshot.count() // KEYS_PER_FILTER))
    judged = stored(screen(new, snapshot_filters(old, buckets), buckets), "screened")
    hits, fresh = judged.filter("maybe").drop("maybe"), judged.filter("NOT maybe").drop("maybe")

    a, b = old.alias("a"), hits.alias("b")
    same = [F.col(f"a.{c}") == F.col(f"b.{c}") for c in ("key", "sha", "size")]
    order = ["less", "noid", "doc", "rid"]
    best = F.least(*(F.when(F.col(f"{s}.key").isNotNull(), F.struct(*[F.col(f"{s}.{c}") for c in order]))
                     for s in "ab"))
    joined = a.join(b, same, "full_outer").select(
        *[F.coalesce(F.col(f"a.{c}"), F.col(f"b.{c}")).alias(c) for c in ("key", "sha", "size")],
        (F.coalesce("a.n", F.lit(0)) + F.coalesce("b.n", F.lit(0))).alias("n"), best.alias("best"))
    return joined.select("key", "sha", "size", "n", "best.*").unionByName(fresh)


def _judged(documents: DataFrame, incoming_share: int) -> DataFrame:
    """The digest rows with the size of their group and the row that stays."""
    rows = digest_rows(documents)
    batch = F.pmod(F.xxhash64("doc", F.lit("batch")), F.lit(incoming_share)) == 0
    groups = duplicate_groups(rows.filter(~batch), rows.filter(batch)).select(
        "key", "sha", "size", F.col("n").alias("group_size"), F.col("doc").alias("keep_id"),
        F.col("rid").alias("keep_rid"))
    return rows.join(groups, ["key", "sha", "size"]).withColumn("kept", F.col("rid") == F.col("keep_rid"))


def exact_dedup(documents: DataFrame, incoming_share: int = 4) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256 for every row.

    One row in ``incoming_share`` (by a hash of its id) plays the new batch, all others
    the snapshot; the groups do not depend on that share.
    """
    return _judged(documents, incoming_share).select(
        F.col("doc").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256"))


def deduplicated(documents: DataFrame, incoming_share: int = 4) -> DataFrame:
    """The documents that stay, with all their columns; equal rows stay once.

    The columns travel in one struct, so no name of theirs can clash.  Texts are shuffled
    once: equal rows are reduced before that, and what stays is chosen on the same keys.
    """
    same = ["doc", "noid", "sha", "less"]
    kept = _judged(documents, incoming_share).filter("kept").select(*same)
    doc = F.col("doc_id").cast("bigint")
    rows = documents.select(
        F.coalesce(doc, F.lit(0)).alias("doc"), doc.isNull().alias("noid"),
        F.sha2(normalised(F.col("text")).cast("binary"), 256).alias("sha"),
        (-F.length(F.coalesce("text", F.lit(""))).cast("bigint")).alias("less"),
        F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row"))
    one = rows.groupBy(*same).agg(F.first("row").alias("row"))
    return (one.join(kept.withColumn("doc", F.coalesce("doc", F.lit(0))), same, "left_semi")
            .select(*[F.col("row").getField(c).alias(c) for c in documents.columns]))
