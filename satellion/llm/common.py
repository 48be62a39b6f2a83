"""Helpers shared by the text operators: shared-folder tables, splits and word hashing."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from satellion.functions.storing import discard, shared_dir, store  # noqa: F401

#: White space of the word contracts: blank, tab, line feed, vertical tab, form feed, return.
BLANKS = r"[\x20\x09-\x0D]+"

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_P = np.uint64(0x9E3779B97F4A7C15)
#: The lowest 0 to 8 bytes of a word of eight.
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def count_words(text: Column, gaps: str) -> Column:
    """Words between gaps. Splitting by the gaps is many times faster in the JVM than counting by a negated class."""
    parts = F.split(text, gaps, -1)
    return (F.size(parts) - (parts[0] == "").cast("int") - ((F.size(parts) > 1) & (F.element_at(parts, -1) == "")).cast("int")).cast("long")


def held_out(doc_id: Column | str) -> Column:
    """crc32 of the id as text, modulo 5, is 0: never used to learn labels. A null id counts as held out."""
    doc_id = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(True))


def set_aside(df: DataFrame, used: tuple[str, ...], made: tuple[str, ...] = ()) -> tuple[DataFrame, Callable[..., DataFrame]]:
    """df with all columns but `used` under names that no operator uses, and a function that gives the names back.

    Columns named in `made` are dropped first, as the operator adds its own; the function puts those last.
    """
    df = df.drop(*made)
    quoted = lambda c: F.col("`" + c.replace("`", "``") + "`")
    names = {c: c if c in used else f"_aside_{i}" for i, c in enumerate(df.columns)}
    back = lambda out: out.select(*[quoted(n).alias(c) for c, n in names.items()], *made)
    return df.select(*[quoted(c).alias(n) for c, n in names.items()]), back


def labelled_sample(documents: DataFrame, labels: DataFrame, label: str, fit_rows: int, longest: int | None = None) -> DataFrame:
    """(doc_id, text, y, h) of the training rows of at most fit_rows ids, chosen by id hash; the ids are chosen from the small table first.

    Texts longer than `longest` characters are left out. Rows without a label or a document are left out; contradicting
    labels of one id count by their maximum. Ids may repeat: the first fit_rows rows by h, a hash of id and text, are a fair sample.
    """
    ids = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
        .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out("doc_id"))
        .groupBy("doc_id").agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    )
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    docs = docs if longest is None else docs.where(F.length("text") <= longest)
    return docs.join(F.broadcast(ids), "doc_id").withColumn("h", F.xxhash64("doc_id", "text"))


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalizer of a 64-bit hash."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def batches(texts: list[str | None], limit: int = 1 << 21):
    """Slices (i, j) of texts of at most about limit characters, one text at least."""
    i, size = 0, 0
    for j, t in enumerate(texts):
        n = len(t) if t else 0
        if j > i and size + n > limit:
            yield i, j
            i, size = j, 0
        size += n
    if i < len(texts):
        yield i, len(texts)


def joined_bytes(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, each followed by a line feed, and each text's start (one more than texts)."""
    raw = [t.encode("utf-8", "surrogatepass") if t else b"" for t in texts]
    starts = np.zeros(len(raw) + 1, dtype=np.int64)
    np.cumsum([len(r) + 1 for r in raw], out=starts[1:])
    return np.frombuffer(b"\n".join(raw) + b"\n", dtype=np.uint8), starts


def word_hashes(texts: list[str | None], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words of all texts, in order, and the position of each text's first word (one more than texts).

    Bytes go in by eights, and each eight is mixed into the word's hash by a finalizer, so no two words are equal by construction
    but for chance collisions of 64-bit hashes.
    """
    data, starts = joined_bytes(texts)
    if lower:
        data = _LOWER[data]
    space = _SPACE[data]
    inner = ~space
    first = np.flatnonzero(inner & np.concatenate(([True], space[:-1])))
    size = np.flatnonzero(inner & np.concatenate((space[1:], [True]))) + 1 - first
    padded = np.concatenate((data, np.zeros(8, dtype=np.uint8)))
    eights = np.lib.stride_tricks.as_strided(padded.view(np.uint8), (len(data), 8), (1, 1))
    h = mix64(size.astype(np.uint64) * _P)
    open_ = np.arange(len(first))
    step = 0
    while len(open_):
        at = first[open_] + 8 * step
        left = np.minimum(size[open_] - 8 * step, 8)
        part = np.ascontiguousarray(eights[at]).view("<u8").ravel() & _MASKS[left]
        h[open_] = mix64((h[open_] ^ part) + _P)
        step += 1
        open_ = open_[size[open_] > 8 * step]
    return h, np.searchsorted(first, starts)
