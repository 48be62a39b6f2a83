"""Alignment kernels in numpy, and their Arrow-batched columns."""

from __future__ import annotations

import itertools
from functools import cache

import numpy as np
import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

GAP = 0  # composition of dashes only
SYMBOLS = "ACGT-"


@cache
def compositions() -> np.ndarray:
    """All ways to split 10 among A, C, G, T and dash, 1001 rows; the id is the row. Ordered by falling dashes in the way that gives id 0 to dashes only."""
    rows = [(a, c, g, t, 10 - a - c - g - t) for a, c, g, t in itertools.product(range(11), repeat=4) if a + c + g + t <= 10]
    return np.array(sorted(rows), dtype=np.int16)


@cache
def distances() -> np.ndarray:
    """Distance of compositions, 0..255: Euclidean, scaled by the largest one."""
    c = compositions().astype(float)
    return np.rint(255 * np.sqrt(((c[:, None] - c[None]) ** 2).sum(-1) / 200)).astype(np.uint8)


@cache
def _nearest(counts: tuple[int, ...]) -> int:
    return int(np.argmin(((compositions() - 10 * np.array(counts) / sum(counts)) ** 2).sum(1)))


def nearest_composition(counts: np.ndarray) -> int:
    """Id of the composition nearest to counts scaled to 10; the first of equals. Without counts: the gap."""
    return _nearest(tuple(map(int, counts))) if counts.sum() else GAP


def lcs_length(a: str, b: str) -> int:
    """Length of a longest common subsequence, bit-parallel over whole numbers."""
    at: dict[str, int] = {}
    for i, c in enumerate(a):
        at[c] = at.get(c, 0) | 1 << i
    row, full = 0, (1 << len(a)) - 1
    for c in b:
        x = row | at.get(c, 0)
        row = x & ~(x - (row << 1 | 1)) & full
    return row.bit_count()


def _symbols(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points as a matrix, 0 beyond a text's end, and lengths."""
    size = np.array([len(t) for t in texts], dtype=np.int64)
    out = np.zeros((len(texts), int(size.max(initial=0))), dtype=np.uint32)
    out[np.arange(out.shape[1]) < size[:, None]] = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
    return out, size


def anchored_distances(n: list[str], m: list[str], most: int | None = None) -> np.ndarray:
    """Smallest edit distance of each m (64 symbols at most) and a prefix of its n: one bit-parallel pass over n gives all prefixes, for all pairs at once."""
    (text, n_size), (word, size) = _symbols(n), _symbols(m)
    if word.shape[1] > 64:
        raise ValueError("more than 64 symbols")
    top = n_size if most is None else np.minimum(n_size, size + most)
    known = np.unique(word)
    row = np.arange(len(n))
    at = np.zeros((len(known) + 1, len(n)), dtype=np.uint64)
    for k in range(word.shape[1]):
        here = row[k < size]
        at[np.searchsorted(known, word[here, k]), here] |= np.uint64(1 << k)
    place = np.minimum(np.searchsorted(known, text), max(0, len(known) - 1))
    code = np.where(known[place] == text, place, len(known)) if len(known) else np.zeros(text.shape, dtype=np.int64)
    high = np.where(size > 0, np.uint64(1) << np.maximum(size - 1, 0).astype(np.uint64), np.uint64(0))
    one = np.uint64(1)
    plus, minus = np.full(len(n), ~np.uint64(0)), np.zeros(len(n), dtype=np.uint64)
    score, best = size.copy(), size.copy()
    for k in range(int(top.max(initial=0))):
        equal = at[code[:, k], row]
        x = equal | minus
        y = (((equal & plus) + plus) ^ plus) | equal
        up, down = minus | ~(y | plus), plus & y
        score += ((up & high) != 0).astype(np.int64) - ((down & high) != 0)
        best = np.where(k < top, np.minimum(best, score), best)
        up, down = up << one | one, down << one
        plus, minus = down | ~(x | up), up & x
    return best


def anchored(n: str, m: str, most: int | None = None):
    """anchored_distances of two columns; null where one is null. Rows whose m is longer than 64 symbols are an error: flanks are cut before."""

    @F.pandas_udf("int")
    def run(a: pd.Series, b: pd.Series) -> pd.Series:
        ok = (a.notna() & b.notna()).to_numpy()
        out = pd.Series(pd.NA, index=a.index, dtype="Int32")
        if ok.any():
            out[ok] = anchored_distances(a[ok].tolist(), b[ok].tolist(), most).astype(np.int32)
        return out

    return run(n, m)


def consensus(profile: np.ndarray) -> str:
    """Most frequent symbol of each column (first of equals), without dash columns."""
    return "".join(SYMBOLS[k] for k in compositions()[profile].argmax(1) if k != 4)


def profile_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """1 - weighted distance along the cheapest unweighted global alignment of two profiles; ties: diagonal, vertical, horizontal. Two profiles of dashes alone: 0."""
    d, solid = distances().astype(np.int64), 10 - compositions()[:, 4]
    n, m = len(a), len(b)
    down, across = d[a, GAP], d[GAP, b]
    cost = np.empty((n + 1, m + 1), dtype=np.int64)
    move = np.zeros((n + 1, m + 1), dtype=np.int8)
    cost[0], move[0] = np.concatenate(([0], np.cumsum(across))), 2
    cost[:, 0], move[1:, 0] = np.concatenate(([0], np.cumsum(down))), 1
    step = d[np.ix_(a, b)]
    run = np.concatenate(([0], np.cumsum(across)))
    for i in range(1, n + 1):
        diagonal, vertical = cost[i - 1, :-1] + step[i - 1], cost[i - 1, 1:] + down[i - 1]
        best = np.minimum(diagonal, vertical)
        # horizontal moves: a running minimum of cost less what has been paid along the row
        whole = np.minimum.accumulate(np.concatenate(([cost[i, 0]], best)) - run) + run
        cost[i, 1:] = whole[1:]
        move[i, 1:] = np.where(cost[i, 1:] == diagonal, 0, np.where(cost[i, 1:] == vertical, 1, 2))
    i, j, lost, weight = n, m, 0, 0
    while i or j:
        k = move[i, j]
        if k == 0:
            w, x = min(10, int(solid[a[i - 1]] + solid[b[j - 1]])), int(step[i - 1, j - 1])
            i, j = i - 1, j - 1
        elif k == 1:
            w, x = int(solid[a[i - 1]]), int(down[i - 1])
            i -= 1
        else:
            w, x = int(solid[b[j - 1]]), int(across[j - 1])
            j -= 1
        lost, weight = lost + w * x, weight + w
    return 1 - lost / (255 * weight) if weight else 0.0


def profile_similarities(a: list[np.ndarray], b: list[np.ndarray], cells: int = 1 << 18) -> np.ndarray:
    """profile_similarity of many pairs, a row of all their alignments at a time. Pairs of like size go together, as many as keep a row within `cells`."""
    n, m = (np.array([len(x) for x in side], dtype=np.int64) for side in (a, b))
    out = np.zeros(len(a))
    order = np.lexsort((m, n))
    k = 0
    while k < len(order):
        some = order[k : k + max(1, cells // (1 + int(m.max(initial=0))))]
        out[some] = _similarity_rows([a[x] for x in some], [b[x] for x in some], n[some], m[some])
        k += len(some)
    return out


def _padded(rows: list[np.ndarray], size: np.ndarray) -> np.ndarray:
    out = np.full((len(rows), int(size.max(initial=0))), GAP, dtype=np.int64)
    if out.size:
        out[np.arange(out.shape[1]) < size[:, None]] = np.concatenate(rows)
    return out


def _similarity_rows(a: list[np.ndarray], b: list[np.ndarray], n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Each cell carries the weighted distance and the weight of its own best path, so nothing is traced back."""
    d, solid = distances(), (10 - compositions()[:, 4]).astype(np.int64)
    x, y = _padded(a, n), _padded(b, m)
    zero = np.zeros((len(a), 1), dtype=np.int64)
    sums = lambda v: np.concatenate((zero, np.cumsum(v, axis=1)), axis=1)
    across = d[GAP, y].astype(np.int64)
    paid, paid_lost, paid_weight = sums(across), sums(solid[y] * across), sums(solid[y])
    cost, lost, weight = paid, paid_lost, paid_weight
    place = np.arange(y.shape[1] + 1)
    own = np.arange(len(a))
    out_lost, out_weight = lost[own, m], weight[own, m]
    for i in range(x.shape[1]):
        of_a = x[:, i : i + 1]
        step, down = d[of_a, y].astype(np.int64), d[of_a, GAP].astype(np.int64)
        both = np.minimum(10, solid[of_a] + solid[y])
        diagonal, vertical = cost[:, :-1] + step, cost + down
        # horizontal moves: a running minimum of cost less what has been paid along the row
        best = np.concatenate((vertical[:, :1], np.minimum(diagonal, vertical[:, 1:])), axis=1)
        cost = np.minimum.accumulate(best - paid, axis=1) + paid
        slant = np.concatenate((zero > 0, cost[:, 1:] == diagonal), axis=1)
        pad = lambda v: np.concatenate((zero, v), axis=1)
        lost = np.where(slant, pad(lost[:, :-1] + both * step), lost + solid[of_a] * down)
        weight = np.where(slant, pad(weight[:, :-1] + both), weight + solid[of_a])
        # a horizontal run goes on from the last cell that another move reached
        last = np.maximum.accumulate(np.where(slant | (cost == vertical), place, 0), axis=1)
        lost = np.take_along_axis(lost - paid_lost, last, axis=1) + paid_lost
        weight = np.take_along_axis(weight - paid_weight, last, axis=1) + paid_weight
        here = np.flatnonzero(n == i + 1)
        out_lost[here], out_weight[here] = lost[here, m[here]], weight[here, m[here]]
    return np.where(out_weight > 0, 1 - out_lost / np.maximum(255 * out_weight, 1), 0.0)


def wraparound(array: str, pattern: str, match: int = 2, mismatch: int = -5, gap: int = -7) -> tuple[int, list[tuple[int, int]]]:
    """Score of array against endless copies of pattern, and the pairs (array place or -1, pattern place or -1) of the alignment. N matches nothing."""
    n, m = len(array), len(pattern)
    s = np.zeros((n + 1, m + 1), dtype=np.int64)
    back = np.zeros((n + 1, m + 1), dtype=np.int8)  # 0 diagonal, 1 left, 2 top
    s[:, 0] = np.arange(n + 1) * gap
    codes, cost = np.array([ord(c) for c in pattern]), np.arange(m + 1) * gap
    for i in range(1, n + 1):
        c = array[i - 1]
        hit = np.where((codes == ord(c)) & (c in "ACGT"), match, mismatch)
        before = s[i - 1, :-1].copy()
        before[0] = max(before[0], s[i - 1, m])
        diagonal = before + hit
        # moves to the left: a running maximum of the score less what gaps along the row cost
        row = s[i]
        row[1:] = np.maximum(diagonal, s[i - 1, 1:] + gap)
        row[:] = np.maximum.accumulate(row - cost) + cost
        back[i, 1:] = np.where(row[1:] == diagonal, 0, np.where(row[1:] == row[:-1] + gap, 1, 2))
        # around the pattern's end to its start, as far as that gains
        around = row[m] + cost[1:]
        gains = int(np.argmin(np.append(around > row[1:], False)))
        row[1 : gains + 1], back[i, 1 : gains + 1] = around[:gains], 1
    j = int(max(range(1, m + 1), key=lambda x: (s[n, x], x))) if m else 0
    i, score, path = n, int(s[n, j]), []
    while i:
        k = back[i, j]
        if k == 0:
            path.append((i - 1, j - 1))
            i, j = i - 1, j - 1 or m
        elif k == 1:
            path.append((-1, j - 1))
            j = j - 1 or m
        else:
            path.append((i - 1, -1))
            i -= 1
    return score, path[::-1]


def build_profile(array: str, pattern: str) -> tuple[str, list[int], float, float]:
    """Best pattern, its profile (composition ids), copies and conservation of an array: copies are stacked in columns, the majority of each column is tried as a pattern as long as the score gains."""
    score, path = wraparound(array, pattern)
    while True:
        columns = _columns(array, pattern, path)
        counts = np.array([[col.get(c, 0) for c in SYMBOLS] for col, _ in columns])
        better = "".join(SYMBOLS[k] for k in counts.argmax(1) if k != 4) if len(counts) else ""
        if not better or better == pattern:
            break
        new_score, new_path = wraparound(array, better)
        if new_score <= score:
            break
        pattern, score, path = better, new_score, new_path
    columns = _columns(array, pattern, path)
    profile = [nearest_composition(np.array([col.get(c, 0) for c in SYMBOLS])) for col, _ in columns]
    same = sum(1 for a, p in path if a >= 0 and p >= 0 and array[a] == pattern[p] and array[a] in "ACGT")
    length = sum(n for _, n in columns)
    return pattern, profile, length / max(1, len(columns)), same / max(1, len(path))


def _columns(array: str, pattern: str, path: list[tuple[int, int]]) -> list[tuple[dict, int]]:
    """Symbol counts and cells of each column: a pattern place, and before it as many columns as any copy inserts there."""
    inserts, now = [0] * len(pattern), 0
    place = path[0][1] if path and path[0][1] >= 0 else 0
    for _, p in path:
        if p < 0:
            now += 1
        else:
            inserts[p] = max(inserts[p], now)
            now = 0
    first = next((p for _, p in path if p >= 0), place)
    order = [(first + k) % len(pattern) for k in range(len(pattern))] if pattern else []
    at, columns = {}, []
    for p in order:
        at[p] = len(columns) + inserts[p]
        columns += [({}, 0)] * (inserts[p] + 1)
    columns = [({}, 0) for _ in columns]
    waiting: list[str] = []

    def add(k: int, c: str) -> None:
        col, n = columns[k]
        col[c] = col.get(c, 0) + 1
        columns[k] = (col, n + 1)

    for a, p in path:
        if p < 0:
            waiting.append(array[a])
            continue
        start = at[p] - inserts[p]
        for k in range(inserts[p]):
            add(start + k, waiting[k] if k < len(waiting) else "-")
        add(at[p], array[a] if a >= 0 else "-")
        waiting = []
    for k, c in enumerate(waiting):
        if columns:
            add(k % len(columns), c)
    return columns


#: What building a profile gives. Types are objects, as workers that import this have no session to parse text.
PROFILE = T.StructType([T.StructField("pattern", T.StringType()), T.StructField("profile", T.ArrayType(T.ShortType())), T.StructField("copynum", T.DoubleType()), T.StructField("conserved", T.DoubleType())])


@F.pandas_udf(T.IntegerType())
def lcs(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([None if x is None or y is None else lcs_length(x, y) for x, y in zip(a, b)], dtype="Int32")


@F.pandas_udf(T.DoubleType())
def similarity(a: pd.Series, b: pd.Series) -> pd.Series:
    ok = (a.notna() & b.notna()).to_numpy()
    out = pd.Series(pd.NA, index=a.index, dtype="Float64")
    if ok.any():
        out[ok] = profile_similarities(*[[np.asarray(x, dtype=np.int64) for x in side[ok]] for side in (a, b)])
    return out


@F.pandas_udf(T.StringType())
def consensus_of(a: pd.Series) -> pd.Series:
    return pd.Series([None if x is None else consensus(np.asarray(x, dtype=np.int64)) for x in a])


@F.pandas_udf(PROFILE)
def profile_of(array: pd.Series, pattern: pd.Series) -> pd.DataFrame:
    rows = [build_profile(x, y) if x and y else (y, [], 0.0, 0.0) for x, y in zip(array, pattern)]
    return pd.DataFrame(rows, columns=["pattern", "profile", "copynum", "conserved"])
