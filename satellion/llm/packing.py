"""Best-fit packing with large-item matching.

Token ids are byte-pair ids of a public vocabulary file, an end id after each document. Only documents longer than a
sequence are cut, from their end, so that the first piece alone may be shorter. Lengths are whole numbers up
to the capacity, so all placing is done on the histogram of lengths, whose size is fixed: pieces above a third of the capacity are
matched greedily, two a sequence at most (longest first, each with the longest partner that fits); shorter pieces best-fit the remaining gaps,
longest first, and open new sequences when nothing fits. Runs of equal sequences are kept as ranges, and each piece finds
its place by its rank among pieces of its length. Ranks are counted in cells of about CELL pieces of one length, so a common length is dealt over as
many tasks as it needs.
"""

from __future__ import annotations

import bisect
import json
import zlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from satellion.functions.shipping import ship
from satellion.llm.common import store

#: Pieces a cell, about.
CELL = 1 << 16


def byte_symbols() -> dict[str, int]:
    """Byte-level vocabularies write a byte as a printable character: its own where it has one, else the next from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {chr(b): b for b in own}
    for i, b in enumerate(b for b in range(256) if b not in set(own)):
        out[chr(256 + i)] = b
    return out


def encoder(path: str, cache: dict = {}):  # noqa: B006  one a worker
    """text -> numpy ids, as the vocabulary file's own tokenizer gives them without added specials (special strings in a text are found)."""
    if path not in cache:
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        to_byte = byte_symbols()
        ranks = {bytes(to_byte[c] for c in t): i for t, i in spec["model"]["vocab"].items() if t not in special}
        enc = tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)
        cache[path] = lambda text: np.asarray(enc.encode(text, allowed_special="all", disallowed_special=()), dtype=np.uint32)
    return cache[path]


def pieces_of(ids: np.ndarray, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of each piece: the first takes the remainder."""
    n = len(ids)
    head = n % capacity or capacity
    return [(0, head), *((s, capacity) for s in range(head, n, capacity))] if n > capacity else [(0, n)]


def cut(documents: DataFrame, tokenizer: str | None, capacity: int, end_id: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, row) of each piece; row tells pieces apart, also those of repeated rows. Null texts are empty: one piece that holds the end id."""

    def run(parts):
        from pyspark import TaskContext

        if tokenizer is None:
            import public_tokenizers

            encode = encoder(public_tokenizers.path("byte_bpe_50k.json"))
        else:
            encode = encoder(tokenizer)
        row = TaskContext.get().partitionId() << 40
        for pdf in parts:
            rows = []
            for doc, text in zip(pdf.doc_id, pdf.text):
                ids = np.append(encode(text) if text else np.zeros(0, np.uint32), np.uint32(end_id)).astype("<u4")
                rows += [(doc, k, s, n, zlib.crc32(ids[s : s + n].tobytes())) for k, (s, n) in enumerate(pieces_of(ids, capacity))]
            out = pd.DataFrame(rows, columns=["doc_id", "piece", "start", "length", "ids_crc32"])
            yield out.astype({"doc_id": "Int64"}).assign(row=np.arange(row, row + len(out)))
            row += len(out)

    return documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).mapInPandas(run, "doc_id long, piece int, start long, length long, ids_crc32 long, row long")


def place(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Ranges (length, first rank, pieces a sequence, first sequence, offset), by length and first rank, for counts of lengths."""
    left = {n: c for n, c in counts.items() if c}
    ranks = dict.fromkeys(left, 0)
    out: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}  # gap -> ranges (first sequence, sequences)
    keys: list[int] = []
    used = 0

    def put(n: int, first: int, sequences: int, each: int, offset: int) -> None:
        out.append((n, ranks[n], each, first, offset))
        ranks[n] += sequences * each
        left[n] -= sequences * each

    def give(gap: int, first: int, sequences: int) -> None:
        if gap and sequences:
            if gap not in gaps:
                bisect.insort(keys, gap)
                gaps[gap] = []
            gaps[gap].append((first, sequences))

    def take(gap: int) -> tuple[int, int]:
        x = gaps[gap].pop()
        if not gaps[gap]:
            del gaps[gap], keys[bisect.bisect_left(keys, gap)]
        return x

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        n = large[-1]
        if not left[n]:
            large.pop()
            continue
        k = bisect.bisect_right(large, capacity - n) - 1
        while k >= 0 and not left[large[k]]:
            large.pop(k)
            k -= 1
        if k < 0:
            c = left[n]
            put(n, used, c, 1, 0)
            give(capacity - n, used, c)
        else:
            m = large[k]
            c = left[n] // 2 if m == n else min(left[n], left[m])
            if not c:
                # one piece of this length is left: the next shorter one that fits joins it
                m = next((x for x in reversed(large[:k]) if left[x]), None)
                c = 1
                put(n, used, 1, 1, 0)
                if m is not None:
                    put(m, used, 1, 1, n)
                    give(capacity - n - m, used, 1)
                else:
                    give(capacity - n, used, 1)
            elif m == n:
                put(n, used, c, 2, 0)
                give(capacity - 2 * n, used, c)
            else:
                put(n, used, c, 1, 0)
                put(m, used, c, 1, n)
                give(capacity - n - m, used, c)
        used += c
    for n in sorted((n for n in left if 3 * n <= capacity), reverse=True):
        while left[n]:
            k = bisect.bisect_left(keys, n)
            if k < len(keys):
                gap = keys[k]
                first, sequences = take(gap)
            else:
                gap, first, sequences = capacity, used, -(-left[n] // (capacity // n))
                used += sequences
            each = gap // n
            c = min(sequences, left[n] // each)
            if c:
                put(n, first, c, each, capacity - gap)
                give(gap - each * n, first, c)
            if c < sequences:
                if left[n]:
                    each = min(each, left[n])
                    put(n, first + c, 1, each, capacity - gap)
                    give(gap - each * n, first + c, 1)
                    c += 1
                if c < sequences:
                    give(gap, first + c, sequences - c)
    return sorted(out)


def pack(documents: DataFrame, capacity: int = 1024, end_id: int = 2, tokenizer: str | None = None) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset) of every piece of documents.

    tokenizer is the path of a byte-level vocabulary file (None: the installed public one); workers read it where they run. Rows are packed one
    by one: repeated rows each have their pieces, under the same doc_id and piece; rows with a null id keep it; an empty table has no pieces. Other
    columns are not read.
    """
    ship(documents.sparkSession)
    return assign(store(cut(documents, tokenizer, capacity, end_id)), capacity)


def assign(pieces: DataFrame, capacity: int, cell: int = CELL) -> DataFrame:
    """Places pieces(..., length, row). What goes to the driver and back is a number a length, and one more for every `cell` pieces."""
    spark = pieces.sparkSession
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}
    # a number a length, as a constant array: no join
    salts = F.array(*[F.lit(-(-counts.get(n, 1) // cell)) for n in range(1, capacity + 1)])
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("row"), F.element_at(salts, F.col("length").cast("int"))).cast("int"))
    cells = salted.groupBy("length", "salt").count().orderBy("length", "salt").toPandas()
    start = cells["count"].to_numpy()
    start = np.cumsum(start) - start
    n, salt = cells["length"].to_numpy(), cells["salt"].to_numpy()
    start -= start[np.searchsorted(n, n)] if len(n) else 0
    table = np.array(place(counts, capacity), dtype=np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast((n << 32 | salt, start, table))
    nth = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start", "ids_crc32", "row")) - 1

    def find(parts):
        cells, start, table = shared.value
        span = np.int64(1 << 48)
        index = table[:, 0] * span + table[:, 1]
        for pdf in parts:
            n = pdf.length.to_numpy()
            rank = start[np.searchsorted(cells, n << 32 | pdf.salt.to_numpy())] + pdf.nth.to_numpy()
            row = table[np.searchsorted(index, n * span + rank, side="right") - 1]
            k = rank - row[:, 1]
            yield pdf.drop(columns=["salt", "nth", "row"]).assign(sequence_id=row[:, 3] + k // row[:, 2], offset=row[:, 4] + k % row[:, 2] * n)

    columns = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"
    return salted.withColumn("nth", nth).mapInPandas(find, columns)
