"""Scalar functions as Catalyst expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def reverse_complement(s) -> Column:
    return F.reverse(F.translate(s, "ACGTacgt", "TGCAtgca"))


def complement(s) -> Column:
    return F.translate(s, "ACGTacgt", "TGCAtgca")


def clean_dna(s) -> Column:
    """Upper case, everything but ACGT as N."""
    return F.regexp_replace(F.upper(s), "[^ACGT]", "N")


def strip_blanks(s) -> Column:
    return F.regexp_replace(s, r"\s+", "")


def substring_index(s, sep: str, k: int) -> Column:
    """One piece of a split; -1 is the last piece only."""
    return F.element_at(F.split(s, f"\\Q{sep}\\E"), k if k < 0 else k + 1)


def left(s: str, n: int) -> Column:
    return F.substring(s, 1, n)


def right(s: str, n: int) -> Column:
    return F.when(F.length(s) <= n, F.col(s)).otherwise(F.expr(f"right({s}, {n})"))


def thousands(x) -> Column:
    return F.format_number(x, 0)


def percent(a: Column, b: Column) -> Column:
    """Truncated percentage; 0 where b isn't positive."""
    return F.when(b > 0, (100 * a / b).cast("int")).otherwise(0)


def round_half_up(x: Column) -> Column:
    return F.floor(x + 0.5)


def entropy(s) -> Column:
    """Bits over ACGT of a text; 0 for an empty one."""
    u = F.upper(s)
    counts = [F.length(u) - F.length(F.replace(u, F.lit(b), F.lit(""))) for b in "ACGT"]
    total = sum(counts[1:], counts[0])
    part = lambda c: F.when(c > 0, -(c / total) * F.log2(c / total)).otherwise(0.0)
    return F.when(total > 0, sum((part(c) for c in counts[1:]), part(counts[0]))).otherwise(0.0)


def min_rotation(s: str, with_complement: bool = False) -> Column:
    """Smallest rotation of a pattern, or of it and its reverse complement."""
    rotate = lambda c: F.transform(F.sequence(F.lit(0), F.greatest(F.length(c) - 1, F.lit(0))), lambda i: F.concat(F.substring(c, i + 1, F.length(c)), F.substring(c, F.lit(1), i)))
    all_ = rotate(F.col(s))
    return F.array_min(F.concat(all_, rotate(reverse_complement(s))) if with_complement else all_)


def leb36_encode(ids: str) -> Column:
    """Two base-36 digits an id, low digit first."""
    digit = lambda d: F.chr(F.when(d < 10, d + 48).otherwise(d + 55))
    return F.array_join(F.transform(ids, lambda x: F.concat(digit(x % 36), digit((x / 36).cast("int")))), "")


def leb36_decode(s: str | Column) -> Column:
    s = F.col(s) if isinstance(s, str) else s
    value = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    return F.transform(F.sequence(F.lit(0), F.greatest((F.length(s) / 2).cast("int") - 1, F.lit(0))), lambda i: (value(F.substring(s, 2 * i + 1, F.lit(1))) + 36 * value(F.substring(s, 2 * i + 2, F.lit(1)))).cast("short"))


def anchored_distance(n: str, m: str, most: int | None = None) -> Column:
    """Smallest edit distance of m and a prefix of n; prefixes beyond len(m) + most need not be looked at."""
    top = F.length(n) if most is None else F.least(F.length(n), F.length(m) + most)
    return F.array_min(F.transform(F.sequence(F.lit(0), top), lambda k: F.levenshtein(F.substring(F.col(n), F.lit(1), k), F.col(m))))


def error_limit(length: Column) -> Column:
    """Errors a flank of this length may have."""
    return F.least(F.lit(8), (0.4 * length + 0.01).cast("int"))


def duration(seconds: Column) -> Column:
    """Days, hours, minutes, seconds as text."""
    s = seconds.cast("long")
    return F.concat((s / 86400).cast("int"), F.lit("d "), (s % 86400 / 3600).cast("int"), F.lit("h "), (s % 3600 / 60).cast("int"), F.lit("m "), s % 60, F.lit("s"))
