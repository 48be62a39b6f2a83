"""Toxicity: averaged subword-bag embeddings under a linear softmax, trained jointly in numpy.

A word is the mean of its character n-gram vectors (n = 3..5 over UTF-8 bytes with word ends, hashed into a
fixed table), so unseen misspellings share vectors with known words. A passage of `window` words is the
mean of its words under a two-class softmax; a document is scored by its most toxic passage, so a few
insults in a long text are not averaged away. Training chooses each document's passage anew in every epoch
(multiple-instance learning) and moves the embeddings and the softmax together. As averaging and softmax
weights are linear, scoring uses one number an n-gram. Null or empty texts have no passage and get the
softmax of its bias. Without labelled rows every score is 0.5.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satellion.functions.shipping import ship
from satellion.llm.common import _LOWER, _SPACE, batches, held_out, joined_bytes, labelled_sample

BITS, SIZES = 17, (3, 4, 5)
_MUL = np.uint32(0x9E3779B1)
_SOFT = np.zeros(256, dtype=bool)
_SOFT[[ord(c) for c in ".,;:!?\"()|&#%"]] = True


def grams(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Buckets of the n-grams in word order, each word's first n-gram (one more than words), each text's first word (one more than texts).

    Marks at word ends count as blanks, A-Z as lower case. Words under three bytes with their ends have no n-gram and are left out.
    """
    data, starts = joined_bytes(texts)
    data = _LOWER[data]
    space = _SPACE[data] | _SOFT[data]
    d = np.where(space, np.uint8(32), data).astype(np.uint32)
    n = len(d)
    before = np.concatenate(([0], np.cumsum(space)))
    at, code = [], []
    for size in SIZES:
        # an n-gram may have a blank at either end only, not within; a lone blank pair isn't one
        m = n - size + 2
        if m <= 0:
            continue
        padded = np.concatenate((np.array([32], np.uint32), d))[: m + size - 1]
        h = np.full(m, size, dtype=np.uint32)
        for k in range(size):
            h = (h ^ padded[k : k + m]) * _MUL
            h ^= h >> np.uint32(15)
        i = np.arange(m)  # begins at byte i - 1
        inner = before[np.minimum(i + size - 2, n)] - before[np.minimum(i, n)] == 0
        ok = np.flatnonzero(inner)
        at.append(ok)  # byte of the second symbol: inside the word
        code.append(h[ok] & np.uint32((1 << BITS) - 1))
    if not at:
        return np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(len(texts) + 1, np.int64)
    where, codes = np.concatenate(at), np.concatenate(code).astype(np.int64)
    order = np.argsort(where, kind="stable")
    where, codes = where[order], codes[order]
    word = before[where]  # blanks before: the same within a word only
    if not len(word):
        return codes, np.zeros(1, np.int64), np.zeros(len(texts) + 1, np.int64)
    new = np.flatnonzero(np.concatenate(([True], word[1:] != word[:-1])))
    # a word said again and again counts once, else a stammer would outvote its passage; a text's first word is always new
    each = np.diff(np.concatenate((new, [len(codes)])))
    sign = np.add.reduceat(codes * 7919 % 1000003, new)
    text = np.searchsorted(starts, where[new], side="right")
    fresh = np.concatenate(([True], (sign[1:] != sign[:-1]) | (each[1:] != each[:-1]) | (text[1:] != text[:-1])))
    codes, place, each = codes[np.repeat(fresh, each)], where[new][fresh], each[fresh]
    return codes, np.concatenate(([0], np.cumsum(each))), np.searchsorted(place, starts)


def passages(n_words: int, window: int) -> np.ndarray:
    """Starts of overlapping passages of a text: half a window apart."""
    return np.arange(0, max(1, n_words - window // 2), window // 2)


def top_passage(word_scores: np.ndarray, window: int) -> tuple[int, float]:
    """First word and mean score of the passage that scores highest."""
    total = np.concatenate(([0.0], np.cumsum(word_scores)))
    a = passages(len(word_scores), window)
    b = np.minimum(a + window, len(word_scores))
    mean = (total[b] - total[a]) / np.maximum(b - a, window // 2)
    k = int(np.argmax(mean))
    return int(a[k]), float(mean[k])


def word_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Each word's mean of values."""
    return np.add.reduceat(values, first[:-1]) / np.diff(first) if len(first) > 1 else np.zeros(0)


def train_model(texts: list[str], y: np.ndarray, window: int, dims: int = 8, steps: int = 1000, rate: float = 0.05, seed: int = 7) -> dict:
    """Adagrad on embeddings and softmax, a batch of documents' passages at a time, in whole epochs of steps batches at least."""
    rng = np.random.default_rng(seed)
    table = rng.normal(0, 0.1, (1 << BITS, dims)).astype(np.float32)
    soft = rng.normal(0, 0.5, (dims, 2)).astype(np.float32)
    bias = np.log(np.array([1 - y.mean(), y.mean()]).clip(1e-3, 1)).astype(np.float32)
    g_table, g_soft, g_bias = np.full(1 << BITS, 1e-6, np.float32), np.full_like(soft, 1e-6), np.full(2, 1e-6, np.float32)
    docs = []
    for i, j in batches(texts):
        codes, first, at = grams(texts[i:j])
        for k in range(j - i):
            a, b = at[k], at[k + 1]
            if b > a:
                f = first[a : b + 1]
                docs.append((codes[f[0] : f[-1]].astype(np.int32), (f - f[0]).astype(np.int32), int(y[i + k])))
    if not docs:
        return {"gram": np.zeros(1 << BITS, np.float32), "bias": float(bias[1] - bias[0]), "window": window}
    for epoch in range(1 + steps * 64 // len(docs)):
        gram = table @ (soft[:, 1] - soft[:, 0])
        order = rng.permutation(len(docs))
        for i in range(0, len(order), 64):
            part = [docs[k] for k in order[i : i + 64]]
            idx, weight, owner = [], [], []
            for k, (codes, first, _) in enumerate(part):
                n = len(first) - 1
                a = int(rng.integers(0, max(1, n - window + 1))) if epoch == 0 else top_passage(word_sums(gram[codes], first), window)[0]
                b = min(a + window, n)
                each = np.diff(first[a : b + 1])
                idx.append(codes[first[a] : first[b]])
                weight.append(np.repeat(1.0 / (each * max(b - a, window // 2)), each).astype(np.float32))
                owner.append(np.full(len(idx[-1]), k))
            idx, weight, owner = np.concatenate(idx), np.concatenate(weight), np.concatenate(owner)
            x = np.zeros((len(part), dims), np.float32)
            np.add.at(x, owner, table[idx] * weight[:, None])
            logits = x @ soft + bias
            p = np.exp(logits - logits.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            want = np.array([d[2] for d in part])
            e = p.copy()
            e[np.arange(len(part)), want] -= 1
            g = x.T @ e
            back = (e @ soft.T)[owner] * weight[:, None]
            rows, inv = np.unique(idx, return_inverse=True)
            grad = np.zeros((len(rows), dims), np.float32)
            np.add.at(grad, inv, back)
            g_table[rows] += (grad**2).mean(1)
            table[rows] -= rate * 4 * grad / np.sqrt(g_table[rows])[:, None]
            g_soft += g**2
            soft -= rate * g / np.sqrt(g_soft)
            gb = e.sum(0)
            g_bias += gb**2
            bias -= rate * gb / np.sqrt(g_bias)
    return {"gram": table @ (soft[:, 1] - soft[:, 0]), "bias": float(bias[1] - bias[0]), "window": window}


def score_texts(model: dict, texts: list[str | None]) -> np.ndarray:
    """Softmax of class 1 for the most toxic passage of each text."""
    out = np.full(len(texts), model["bias"])
    for i, j in batches(texts):
        codes, first, at = grams(texts[i:j])
        words = word_sums(model["gram"][codes], first)
        for k in range(j - i):
            if at[k + 1] > at[k]:
                out[i + k] += top_passage(words[at[k] : at[k + 1]], model["window"])[1]
    return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def score_toxicity(documents: DataFrame, labels: DataFrame, label: str = "toxic", threshold: float = 0.5, fit_rows: int = 4000, longest: int = 20000, window: int = 2) -> DataFrame:
    """documents with held_out, score and predicted added, extra columns kept (columns of these names are replaced).

    The labelled sample has fit_rows ids and rows at most, chosen by hash, of texts of `longest` characters at most, so what goes to
    the driver is bounded by both. Every whole text is scored, each by itself: repeated rows score alike, whatever stands beside
    them. Rows with a null id count as held out. An empty table stays empty.
    """
    ship(documents.sparkSession)
    rows = labelled_sample(documents, labels, label, fit_rows, longest).orderBy("h", "doc_id", "text").limit(fit_rows).toPandas()
    if not len(rows):
        scored = documents.withColumn("score", F.lit(0.5))
    else:
        shared = documents.sparkSession.sparkContext.broadcast(train_model(rows.text.tolist(), rows.y.to_numpy(), window))

        @F.pandas_udf("double")
        def scores(texts: pd.Series) -> pd.Series:
            return pd.Series(score_texts(shared.value, [t if isinstance(t, str) else None for t in texts]))

        scored = documents.withColumn("score", scores("text"))
    return scored.withColumns({"held_out": held_out("doc_id"), "predicted": (F.col("score") >= threshold).cast("int")})
