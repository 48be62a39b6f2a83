"""Quality classifier: nearest-neighbour voting over latent-semantic vectors.

Terms are hashed trigrams of byte classes plus word-level repetition marks, so they follow the form of a
text (junk marks, tables, shouting, repeated words and lines) in any language. The labelled sample is
weighted by tf-idf and reduced by an SVD in numpy; its vectors are broadcast (fit_rows x dims floats,
a fixed size), and every document's exact cosine to every labelled vector is computed in blocks. The k nearest
labels vote, weighted by similarity. Null or empty texts get the labelled share of 1, as no term speaks.
Without labelled rows every score is 0.5.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satellion.functions.shipping import ship
from satellion.llm.common import batches, held_out, joined_bytes, labelled_sample, word_hashes

#: Byte classes: other 0, lower 1, upper 2, digit 3, blank 4, line end 5, sentence marks 6, other marks one each (mod 8), non-ASCII 15.
_CLASS = np.zeros(256, dtype=np.int32)
_CLASS[97:123], _CLASS[65:91], _CLASS[48:58], _CLASS[32], _CLASS[9:14] = 1, 2, 3, 4, 5
_CLASS[[ord(c) for c in ".,;:?'-"]] = 6
for _c in "!\"#$%&()*+/<=>@[\\]^_`{|}~":
    _CLASS[ord(_c)] = 7 + ord(_c) % 8
_CLASS[128:] = 15
#: Terms: 16**3 trigrams, then marks of repetition.
N_SHAPES, N_MARKS = 16**3, 4
N_TERMS = N_SHAPES + N_MARKS


def term_counts(texts: list[str | None]) -> np.ndarray:
    """Term frequencies (rows of texts, N_TERMS columns): shape trigrams per trigram, repetition marks per word or line."""
    out = np.zeros((len(texts), N_TERMS), dtype=np.float32)
    for i, j in batches(texts):
        part = texts[i:j]
        data, starts = joined_bytes(part)
        c = _CLASS[data]
        # a run of lower-case letters counts once: what stands between words speaks, not their length
        keep = np.concatenate(([True], (c[1:] != 1) | (c[:-1] != 1)))
        place = np.concatenate(([0], np.cumsum(keep)))[starts]
        c = c[keep]
        tri = c[:-2] * 256 + c[1:-1] * 16 + c[2:] if len(c) > 2 else np.zeros(0, np.int32)
        words, at = word_hashes(part)
        lines = np.array([hash(x) for t in part for x in (t or "").split("\n")], dtype=np.int64)
        line_at = np.concatenate(([0], np.cumsum([(t or "").count("\n") + 1 for t in part])))
        for k, t in enumerate(part):
            if not t:
                continue
            a, b = place[k], max(place[k], place[k + 1] - 2)
            row = out[i + k]
            if b > a:
                row[:N_SHAPES] = np.bincount(tri[a:b], minlength=N_SHAPES) / (b - a)
            w = words[at[k] : at[k + 1]]
            if len(w):
                same = 1 - len(np.unique(w)) / len(w)
                row[N_SHAPES] = np.mean(w[1:] == w[:-1]) if len(w) > 1 else 0
                row[N_SHAPES + 1] = max(0.0, same - 0.5)
                row[N_SHAPES + 2] = max(0.0, same - 0.8)
            x = lines[line_at[k] : line_at[k + 1]]
            row[N_SHAPES + 3] = max(0.0, 1 - len(np.unique(x)) / len(x) - 0.2)
    return out


def weigh(tf: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Rows of unit length: root of frequency times idf. Rows without terms stay zero."""
    x = np.sqrt(tf) * idf
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def fit(tf: np.ndarray, y: np.ndarray, dims: int) -> dict:
    """idf, projection and labelled vectors."""
    df = (tf > 0).sum(0)
    idf = np.where(df > 0, np.log((1 + len(tf)) / (1 + df)) + 1, 0).astype(np.float32)
    idf[N_SHAPES:] *= 2
    x = weigh(tf, idf)
    seen = np.flatnonzero(df > 0)
    _, _, v = np.linalg.svd(x[:, seen], full_matrices=False) if x.shape[0] < len(seen) else (0, 0, np.linalg.eigh(x[:, seen].T @ x[:, seen])[1].T[::-1])
    p = np.zeros((N_TERMS, min(dims, len(v))), dtype=np.float32)
    p[seen] = v[:dims].T
    z = x @ p
    z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-12)
    return {"idf": idf, "p": p, "z": z.astype(np.float32), "y": y.astype(np.float32), "prior": float(y.mean())}


def vote(model: dict, texts: list[str | None], k: int, block: int = 256) -> np.ndarray:
    """Scores: labels of the k nearest labelled vectors, each weighted by its cosine to the fourth power."""
    score = np.full(len(texts), model["prior"])
    k = min(k, len(model["y"]))
    for i in range(0, len(texts), block):
        x = weigh(term_counts(texts[i : i + block]), model["idf"])
        z = x @ model["p"]
        norm = np.linalg.norm(z, axis=1)
        cos = (z / np.maximum(norm, 1e-12)[:, None]) @ model["z"].T
        near = np.argpartition(-cos, k - 1, axis=1)[:, :k]
        w = np.maximum(np.take_along_axis(cos, near, 1), 1e-6).astype(np.float64) ** 4
        s = (w * model["y"][near]).sum(1) / w.sum(1)
        score[i : i + block] = np.where(norm > 1e-6, s, model["prior"])
    return np.clip(score, 0, 1)


def train(documents: DataFrame, labels: DataFrame, label: str = "quality", fit_rows: int = 3000, dims: int = 32) -> dict | None:
    """Fits on at most fit_rows labelled ids and rows, chosen by hash; terms are counted on the executors."""

    def count(parts):
        for pdf in parts:
            tf = term_counts(pdf.text.tolist())
            rows = [np.flatnonzero(r) for r in tf]
            yield pd.DataFrame({"y": pdf.y, "doc_id": pdf.doc_id, "h": pdf.h, "at": [r.astype(np.int32) for r in rows], "tf": [t[r] for t, r in zip(tf, rows)]})

    sample = labelled_sample(documents, labels, label, fit_rows)
    rows = sample.mapInPandas(count, "y int, doc_id long, h long, at array<int>, tf array<float>").orderBy("h", "doc_id", "at").limit(fit_rows).toPandas()
    if not len(rows):
        return None
    tf = np.zeros((len(rows), N_TERMS), dtype=np.float32)
    for r, at, v in zip(tf, rows["at"], rows["tf"]):
        r[np.asarray(at, dtype=np.int64)] = v
    return fit(tf, rows.y.to_numpy(), dims)


def score_quality(documents: DataFrame, labels: DataFrame, label: str = "quality", threshold: float = 0.3, fit_rows: int = 3000, dims: int = 32, k: int = 15) -> DataFrame:
    """documents with held_out, score and predicted added, extra columns kept (columns of these names are replaced).

    fit_rows bounds the labelled sample (ids and rows, chosen by hash), dims its vectors; nothing else is limited. Every whole text is
    scored by itself, so repeated rows score alike; rows with a null id count as held out; an empty table stays empty.
    """
    ship(documents.sparkSession)
    model = train(documents, labels, label, fit_rows, dims)
    if model is None:
        scored = documents.withColumn("score", F.lit(0.5))
    else:
        shared = documents.sparkSession.sparkContext.broadcast(model)

        @F.pandas_udf("double")
        def scores(texts: pd.Series) -> pd.Series:
            return pd.Series(vote(shared.value, [t if isinstance(t, str) else None for t in texts], k))

        scored = documents.withColumn("score", scores("text"))
    return scored.withColumns({"held_out": held_out("doc_id"), "predicted": (F.col("score") >= threshold).cast("int")})
