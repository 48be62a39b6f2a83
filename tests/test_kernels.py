import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from satellion.functions import kernels

dna = st.text("ACGT", max_size=24)


def naive_lcs(a, b):
    t = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            t[i + 1][j + 1] = t[i][j] + 1 if x == y else max(t[i][j + 1], t[i + 1][j])
    return t[-1][-1]


@given(dna, dna)
def test_lcs(a, b):
    assert kernels.lcs_length(a, b) == naive_lcs(a, b)


def test_composition_ids():
    c = kernels.compositions()
    assert len(c) == 1001
    assert c[0].tolist() == [0, 0, 0, 0, 10] and c[285].tolist() == [0, 10, 0, 0, 0] and c[65].tolist() == [0, 0, 10, 0, 0]
    assert c[670].tolist() == [2, 8, 0, 0, 0] and c[602].tolist() == [2, 2, 2, 2, 2]
    assert all(kernels.nearest_composition(c[k]) == k for k in range(0, 1001, 37))


@settings(deadline=None, max_examples=30)
@given(st.lists(st.integers(1, 1000), min_size=1, max_size=12), st.lists(st.integers(1, 1000), min_size=1, max_size=12))
def test_similarity(a, b):
    a, b = np.array(a), np.array(b)
    assert kernels.profile_similarity(a, a) == 1
    assert 0 <= kernels.profile_similarity(a, b) <= 1


@settings(deadline=None, max_examples=30)
@given(st.text("ACGT", min_size=3, max_size=9), st.integers(2, 5))
def test_profile_of_exact_copies(pattern, n):
    score, path = kernels.wraparound(pattern * n, pattern)
    assert score == 2 * n * len(pattern)
    best, profile, copies, conserved = kernels.build_profile(pattern * n, pattern)
    assert conserved == 1 and abs(copies - n) < 1e-9 and len(profile) == len(pattern)


def plain_wraparound(array, pattern, match=2, mismatch=-5, gap=-7):
    """Score table cell by cell: around the end once more for every row."""
    m = len(pattern)
    row = [0] * (m + 1)
    for i, c in enumerate(array):
        new = [(i + 1) * gap]
        for j in range(1, m + 1):
            before = max(row[0], row[m]) if j == 1 else row[j - 1]
            new.append(max(before + (match if c == pattern[j - 1] and c in "ACGT" else mismatch), new[j - 1] + gap, row[j] + gap))
        for j in range(1, m + 1):
            new[j] = max(new[j], new[m] + j * gap)
        row = new
    return max(row[1:])


@settings(deadline=None, max_examples=200)
@given(st.text("ACGTN", min_size=1, max_size=30), st.text("ACGT", min_size=1, max_size=8))
def test_wraparound(array, pattern):
    score, path = kernels.wraparound(array, pattern)
    assert score == plain_wraparound(array, pattern)
    assert [a for a, _ in path if a >= 0] == list(range(len(array)))
    paid = sum(-7 if a < 0 or p < 0 else 2 if array[a] == pattern[p] and array[a] in "ACGT" else -5 for a, p in path)
    assert paid == score


def test_anchored_distances(spark):
    """The bit-parallel pass equals the smallest distance over all prefixes, cell by cell, also for words of 64 symbols, empty ones and nulls."""
    import random

    from satellion.functions import scalars

    rng = random.Random(3)
    word = lambda n: "".join(rng.choice("ACGTN") for _ in range(n))
    pairs = [(word(rng.randint(0, 75)), word(rng.choice([0, 1, 5, 30, 60, 63, 64]))) for _ in range(150)]
    pairs += [(m + "ACG", m[:10] + m[12:]) for _, m in pairs[:40]] + [("", ""), ("é😀x", "é😀"), ("ACG", "")]
    for most in (None, 8):
        want = []
        for n, m in pairs:
            row = list(range(len(m) + 1))
            best = row[-1]
            for k, c in enumerate(n[: len(m) + most if most is not None else len(n)], 1):
                new = [k]
                for i, x in enumerate(m, 1):
                    new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (x != c)))
                row, best = new, min(best, new[-1])
            want.append(best)
        assert kernels.anchored_distances([n for n, _ in pairs], [m for _, m in pairs], most).tolist() == want
    df = spark.createDataFrame([*pairs, (None, "A"), ("A", None)], "n string, m string")
    both = df.select(kernels.anchored("n", "m", 8).alias("a"), scalars.anchored_distance("n", "m", 8).alias("b")).collect()
    assert all(r.a == r.b for r in both) and both[-1].a is None


def test_similarities_of_many_pairs(spark):
    """All pairs at once equal one pair at a time, ties included; in small portions too; null where a side is null."""
    rng = np.random.default_rng(5)
    pick = np.append(rng.integers(0, 1001, 12), [0, 0, 285])  # few compositions make many ties
    one = lambda: rng.choice(pick, rng.integers(0, 14))
    a, b = [one() for _ in range(300)], [one() for _ in range(300)]
    a[:40] = [x.copy() for x in b[:40]]
    want = [kernels.profile_similarity(x, y) for x, y in zip(a, b)]
    for cells in (1 << 18, 60):
        assert np.allclose(kernels.profile_similarities(a, b, cells), want, atol=1e-12)
    df = spark.createDataFrame([([285, 65], [285, 65]), (None, [1]), ([1], None), ([0], [0])], "a array<short>, b array<short>")
    assert [r.s for r in df.select(kernels.similarity("a", "b").alias("s")).collect()] == [1.0, None, None, 0.0]
