"""Language identification by a byte convolutional network.

Texts are lower-cased UTF-8 and cut into windows of fixed length.  Byte embeddings go
through filters of several widths, a max over the window, and a softmax over the learned
languages; a text's distribution is the mean over all its windows, weighted by bytes.
The network is trained in numpy on a bounded sample of labelled windows; predictions run
over whole texts inside Spark tasks, many windows at a time.

Sample: ``PER_LANGUAGE`` documents of each language, those with the smallest hash of id
and text, ``WINDOWS`` windows of each, spread over the whole text.

Defined results
* a null text, or one without a letter, is ``und`` with score 0; so is every text if
  nothing can be learned (no labelled rows, or an empty table).
* rows without language are not learned from; equal rows get equal predictions.
* other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from rillhouse.llm.common import booleans, doubles, longs, map_slices, strings

#: Bounds of the training sample.
PER_LANGUAGE, WINDOWS = 400, 4
#: Bytes of a window; filter widths; filters of each width; size of a byte's embedding.
WINDOW, WIDTHS, FILTERS, EMBEDDING = 256, (2, 3, 4), 12, 8
#: Windows scored in one go.
BATCH = 64
UNKNOWN = "und"

_LETTER = regex.compile(r"\p{L}")


def windows_of(data: bytes) -> np.ndarray:
    """All windows of a text, the last one padded with zero bytes."""
    count = max(1, -(-len(data) // WINDOW))
    out = np.zeros(count * WINDOW, np.uint8)
    out[:len(data)] = np.frombuffer(data, np.uint8)
    return out.reshape(count, WINDOW)


@dataclass
class ByteConvNet:
    """Parameters, and the passes over a batch of windows."""

    languages: list[str]
    embed: np.ndarray  # 256 x EMBEDDING
    kernel: np.ndarray  # widest * EMBEDDING x filters; rows past a filter's width stay zero
    bias: np.ndarray
    dense: np.ndarray  # filters x languages
    dense_bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], seed: int = 7) -> ByteConvNet:
        rng = np.random.default_rng(seed)
        total = FILTERS * len(WIDTHS)
        draw = lambda *shape, scale: rng.normal(0, scale, shape).astype(np.float32)
        return cls(languages, draw(256, EMBEDDING, scale=0.5),
                   draw(max(WIDTHS) * EMBEDDING, total, scale=0.2) * cls.shape_mask(),
                   np.zeros(total, np.float32), draw(total, len(languages), scale=0.2),
                   np.zeros(len(languages), np.float32))

    @staticmethod
    def shape_mask() -> np.ndarray:
        mask = np.zeros((max(WIDTHS) * EMBEDDING, FILTERS * len(WIDTHS)), np.float32)
        for i, width in enumerate(WIDTHS):
            mask[:width * EMBEDDING, i * FILTERS:(i + 1) * FILTERS] = 1
        return mask

    def patches(self, windows: np.ndarray) -> np.ndarray:
        """Each position's embedded bytes side by side: windows x places x widest * size."""
        widest = max(WIDTHS)
        padded = np.pad(windows, ((0, 0), (0, widest - 1)))
        cells = self.embed[padded].reshape(len(windows), -1)
        step = cells.strides[1]
        view = np.lib.stride_tricks.as_strided(
            cells, (len(windows), WINDOW, widest * EMBEDDING),
            (cells.strides[0], EMBEDDING * step, step))
        return np.ascontiguousarray(view)

    def convolve(self, windows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        patches = self.patches(windows)
        return patches, patches @ self.kernel + self.bias

    def probabilities(self, windows: np.ndarray) -> np.ndarray:
        """Softmax of every window, batch by batch."""
        out = []
        for at in range(0, len(windows), BATCH):
            pooled = np.maximum(self.convolve(windows[at:at + BATCH])[1].max(axis=1), 0)
            out.append(_softmax(pooled @ self.dense + self.dense_bias))
        return np.concatenate(out) if out else np.zeros((0, len(self.languages)), np.float32)

    def gradients(self, windows: np.ndarray, labels: np.ndarray) -> list[np.ndarray]:
        patches, raw = self.convolve(windows)
        n, rows = len(windows), np.arange(len(windows))
        place = raw.argmax(axis=1)
        top = np.take_along_axis(raw, place[:, None, :], 1)[:, 0]
        pooled = np.maximum(top, 0)
        error = _softmax(pooled @ self.dense + self.dense_bias)
        error[rows, labels] -= 1
        error /= n
        back = (error @ self.dense.T) * (top > 0)
        at_max = patches[rows[:, None], place]  # windows x filters x patch
        kernel = np.einsum("nf,nfp->pf", back, at_max) * self.shape_mask()
        cells = (back[:, :, None] * self.kernel.T[None]).reshape(n, -1, max(WIDTHS), EMBEDDING)
        padded = np.pad(windows, ((0, 0), (0, max(WIDTHS) - 1)))
        used = padded[rows[:, None, None], place[:, :, None] + np.arange(max(WIDTHS))]
        embed = np.zeros_like(self.embed)
        np.add.at(embed, used.ravel(), cells.reshape(-1, EMBEDDING))
        return [embed, kernel, back.sum(0), pooled.T @ error, error.sum(0)]


def _softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def train(windows: np.ndarray, labels: np.ndarray, languages: list[str], steps: int = 600,
          batch: int = 64, rate: float = 0.01, seed: int = 7) -> ByteConvNet:
    """Adam on batches that take every language equally often."""
    net, rng = ByteConvNet.fresh(languages, seed), np.random.default_rng(seed)
    params = [net.embed, net.kernel, net.bias, net.dense, net.dense_bias]
    mean, var = ([np.zeros_like(p) for p in params] for _ in range(2))
    of = [np.flatnonzero(labels == k) for k in range(len(languages))]
    for step in range(1, steps + 1):
        classes = rng.integers(0, len(languages), batch)
        chosen = np.array([rng.choice(of[k]) for k in classes])
        for p, g, m, v in zip(params, net.gradients(windows[chosen], labels[chosen]), mean, var):
            m += 0.1 * (g - m)
            v += 0.001 * (g * g - v)
            p -= rate * (1 - step / (steps + 1)) * (m / (1 - 0.9 ** step)) / (
                np.sqrt(v / (1 - 0.999 ** step)) + 1e-8)
    return net


# ------------------------------------------------------------------ Spark side

def sample(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """lang and windows of the documents learned from.

    Windows are cut before the ranking, so only a few hundred bytes of each document
    are sorted; the ranking runs in two steps, so no task gets all of one language.
    """
    text, n = F.col("text"), F.length("text")
    cuts = F.transform(F.sequence(F.lit(0), F.lit(WINDOWS - 1)), lambda i: F.substring(
        text, F.greatest(F.lit(0), F.floor((n - WINDOW) * i / (WINDOWS - 1))).cast("int") + 1,
        F.lit(WINDOW)))
    rows = labelled.filter("lang IS NOT NULL AND text IS NOT NULL").select(
        F.col("lang").cast("string").alias("lang"), F.array_distinct(cuts).alias("cuts"),
        F.xxhash64("doc_id", "text").alias("h"))
    rows = rows.withColumn("part", F.pmod("h", F.lit(64)))
    for keys in (["lang", "part"], ["lang"]):
        order = W.partitionBy(*keys).orderBy("h")
        rows = rows.withColumn("r", F.row_number().over(order)).filter(F.col("r") <= per_language)
    return rows.select("lang", "cuts", "h")


def fit(labelled: DataFrame, per_language: int = PER_LANGUAGE) -> ByteConvNet | None:
    """A network trained on the bounded sample of ``labelled`` (doc_id, text, lang)."""
    rows = sorted((r["h"], r["lang"], r["cuts"]) for r in sample(labelled, per_language).collect())
    rows = [(lang, cut) for _, lang, cuts in rows for cut in cuts if _LETTER.search(cut)]
    languages = sorted({lang for lang, _ in rows})
    if not languages:
        return None
    windows = [windows_of(cut.lower().encode())[:2] for _, cut in rows]
    labels = np.repeat([languages.index(lang) for lang, _ in rows], [len(w) for w in windows])
    return train(np.concatenate(windows), labels, languages)


def predict_texts(net: ByteConvNet | None, texts: list[str | None]) -> tuple[list[str], list[float]]:
    known = [bool(net and t and _LETTER.search(t)) for t in texts]
    names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    held: list[tuple[int, bytes]] = []
    size = 0
    for i, text in enumerate(texts):
        if known[i]:
            held.append((i, text.lower().encode()))
            size += len(held[-1][1])
        if held and (size >= 1 << 18 or i == len(texts) - 1):
            _score(net, held, names, scores)
            held, size = [], 0
    if held:
        _score(net, held, names, scores)
    return names, scores


def _score(net: ByteConvNet, held: list[tuple[int, bytes]], names: list, scores: list) -> None:
    windows = [windows_of(data) for _, data in held]
    weights = np.concatenate([
        np.minimum(WINDOW, len(data) - WINDOW * np.arange(len(w))) for (_, data), w in zip(held, windows)])
    weighted = net.probabilities(np.concatenate(windows)) * weights[:, None]
    starts = np.cumsum([0, *map(len, windows)])[:-1]
    sums = np.add.reduceat(weighted, starts, axis=0)
    shares = sums / sums.sum(axis=1, keepdims=True)
    for (i, _), share in zip(held, shares):
        best = int(share.argmax())
        names[i], scores[i] = net.languages[best], float(share[best])


def predicted(documents: DataFrame, net: ByteConvNet | None, held_out: Column) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every row; reads doc_id and text only."""
    rows = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"),
                            F.coalesce(held_out, F.lit(False)).alias("held_out"), "text")

    def make():
        def work(ids, held, texts):
            names, scores = predict_texts(net, texts)
            return longs(ids), booleans(held), strings(names), doubles(scores)
        return work

    return map_slices(rows, make, "doc_id bigint, held_out boolean, lang_pred string, score double")


def with_language(documents: DataFrame, net: ByteConvNet | None, name: str = "_lang") -> DataFrame:
    """All columns of the documents, then a struct column of prediction and score."""
    @F.pandas_udf("lang string, score double")
    def judge(texts: pd.Series) -> pd.DataFrame:
        names, scores = predict_texts(net, texts.where(texts.notna(), None).tolist())
        return pd.DataFrame({"lang": names, "score": scores})

    return documents.withColumn(name, judge(F.col("text")))


def recognised(documents: DataFrame, net: ByteConvNet | None) -> DataFrame:
    """The documents that are not ``UNKNOWN``, with all their columns, whatever their names."""
    row = F.struct(*[F.col(f"`{c}`") for c in documents.columns]).alias("row")
    judged = with_language(documents.select(row, F.col("text")), net, "judged")
    return judged.filter(F.col("judged.lang") != UNKNOWN).select(
        *[F.col("row").getField(c).alias(c) for c in documents.columns])
