"""Media columns: texts as lossless WebP files, and features of the pixels read back.

A text's UTF-8 bytes, padded with blanks to a positive multiple of 192, are the samples of a grey picture of 192 columns. A picture has 16384
rows at most, so rows of longer texts are as many times 192 samples wide as need be, up to 85 times, some 260 MB; what then stays free in the
last row is transparent and not read. Null texts are empty. Rows are taken one by one: repeated rows have equal values, rows with a null id keep it,
and an empty table stays empty. Only doc_id and text are read, so other columns don't matter.
"""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satellion.functions.shipping import ship
from satellion.llm import webp

WIDTH = 192


def to_media(text: str | None) -> tuple[bytes, int]:
    """The stored form and the number of bytes before padding."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    size = max(1, -(-len(raw) // WIDTH))
    samples = np.frombuffer(raw.ljust(size * WIDTH, b" "), dtype=np.uint8)
    wide = -(-size // webp.MAX_SIDE)
    if wide == 1:
        return webp.encode_grey(samples.reshape(size, WIDTH)), len(raw)
    if wide * WIDTH > webp.MAX_SIDE:
        raise ValueError("a text of more bytes than a picture holds")
    pixels = np.zeros((-(-size // wide) * wide * WIDTH, 4), dtype=np.uint8)
    pixels[: len(samples), :3] = samples[:, None]
    pixels[: len(samples), 3] = 255
    return webp.encode(pixels.reshape(-1, wide * WIDTH, 4), [("green",)], 0, True), len(raw)


def read_media(stored: bytes) -> np.ndarray:
    """Samples (rows, 192) of the stored form."""
    pixels = webp.decode(stored).reshape(-1, 4)
    return np.ascontiguousarray(pixels[pixels[:, 3] == 255, 0]).reshape(-1, WIDTH)


def feature(samples: np.ndarray) -> str:
    """Rows, the mean sample, and the mean step between neighbours in a row."""
    step = np.abs(np.diff(samples.astype(np.int16), axis=1)).sum(dtype=np.int64)
    return f"{len(samples)}x{WIDTH};{samples.sum(dtype=np.int64) / samples.size:.3f};{step / (samples.size - len(samples)):.3f}"


def media_features(documents: DataFrame) -> DataFrame:
    """(doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature, media) of each row; media is the stored form."""
    ship(documents.sparkSession)

    def run(parts):
        for pdf in parts:
            rows = []
            for text in pdf.text:
                stored, n = to_media(text)
                samples = read_media(stored)
                payload = samples.tobytes()
                rows.append((n, len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-16:]), len(stored), hashlib.sha256(stored).hexdigest(), feature(samples), stored))
            out = pd.DataFrame(rows, columns=["n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "media"])
            yield out.assign(doc_id=pdf.doc_id.astype("Int64").array)

    schema = "doc_id long, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, media binary"
    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInPandas(run, schema)
