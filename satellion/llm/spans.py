"""Positions of regular-expression matches with DataFrame functions alone.

Splitting a text by a pattern gives the gaps between its matches, and extracting gives the matches; running sums
of both lengths are the positions, in code points. A text that a cheap test rules out is not searched, and only texts with matches are split.
Patterns avoid nested backtracking: repeated groups are possessive, and long runs are entered at their start or where the
last match ended, so long texts cost time in proportion. Running sums and maxima go by blocks and pairs of spans are found by sorted
sweeps, so many matches cost time nearly in proportion too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Elements a block of a running total, and code points a block of a text: no step copies or walks more than a block.
BLOCK = 128
SPAN = "array<struct<kind:string,ord:int,start:int,end:int,value:string,score:double>>"


def matches(text: str, pattern: str, gate: Column) -> Column:
    """Leftmost non-overlapping matches, or null where there are none or gate is false."""
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    return F.when(gate, found)


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is evaluated once; in a lambda function an expression is evaluated wherever it is named."""
    return F.element_at(F.transform(F.array(value), body), 1)


def running(x: Column, zero: Column, join: Callable[[Column, Column], Column]) -> Column:
    """Inclusive running totals of an array of integers by an associative join, block by block."""

    def scan(part: Column) -> Column:
        start = F.struct(zero.cast("int").alias("at"), F.array().cast("array<int>").alias("out"))

        def step(acc: Column, v: Column) -> Column:
            new = join(acc["at"], v).cast("int")
            return F.struct(new.alias("at"), F.concat(acc["out"], F.array(new)).alias("out"))

        return F.aggregate(part, start, step)

    def spread(whole: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor((F.size(whole) - 1) / BLOCK).cast("int")), lambda b: scan(F.slice(whole, b * BLOCK + 1, F.lit(BLOCK))))

        def moved(own: Column, ends: Column) -> Column:
            later = lambda o, i: let(F.get(ends, i - 1), lambda before: F.transform(o["out"], lambda v: join(before, v).cast("int")))
            return F.flatten(F.transform(own, lambda o, i: F.when(i == 0, o["out"]).otherwise(later(o, i))))

        return let(blocks, lambda own: let(scan(F.transform(own, lambda o: o["at"]))["out"], lambda ends: moved(own, ends)))

    return F.when(F.size(x) > 0, let(x, spread)).otherwise(F.array().cast("array<int>"))


def running_sum(x: Column) -> Column:
    return running(x, F.lit(0), lambda a, v: a + v)


def running_max(x: Column) -> Column:
    """Nulls are left out; null before the first value."""
    return running(x, F.lit(None), F.greatest)


def placed(gaps: Column, hits: Column) -> Column:
    """Array of (start, end, value) of hits from the texts before each."""
    pairs = F.arrays_zip(F.transform(F.slice(gaps, F.lit(1), F.size(hits)), F.length).alias("gap"), hits.alias("hit"))

    def place(pairs: Column) -> Column:
        ends = running_sum(F.transform(pairs, lambda x: x["gap"] + F.length(x["hit"])))
        return F.zip_with(pairs, ends, lambda x, end: F.struct((end - F.length(x["hit"])).alias("start"), end.alias("end"), x["hit"].alias("value")))

    return let(pairs, place)


def positions(text: str, found: str, pattern: str) -> Column:
    """Array of (start, end, value) for the column of matches."""
    return F.when(F.size(found) > 0, placed(F.split(text, pattern, -1), F.col(found)))


def last_before(places: Column, others: Column) -> Column:
    """For each of places the largest value of those others (structs of at and value) whose at isn't beyond it, else null: one sweep over both, sorted."""
    other = lambda o: F.struct(o["at"].cast("int").alias("at"), F.lit(-1).alias("k"), o["value"].cast("int").alias("value"))
    place = lambda p, k: F.struct(p.cast("int").alias("at"), k.cast("int").alias("k"), F.lit(0).alias("value"))
    events = F.sort_array(F.concat(F.transform(others, other), F.transform(places, place)))

    def sweep(events: Column) -> Column:
        last = running_max(F.transform(events, lambda e: F.when(e["k"] < 0, e["value"])))
        both = F.zip_with(events, last, lambda e, m: F.struct(e["k"].alias("k"), m.alias("m")))
        return F.transform(F.sort_array(F.filter(both, lambda x: x["k"] >= 0)), lambda x: x["m"])

    return let(events, sweep)


def at_value(x: Column, at: Callable[[Column], Column], value: Callable[[Column], Column]) -> Column:
    return F.transform(x, lambda o: F.struct(at(o).alias("at"), value(o).alias("value")))


def near(spans: Column, others: Column, distance: int) -> Column:
    """For each span whether one of others stands beside it, not overlapping, with a gap of distance at most: an interval join by two sweeps."""
    left = last_before(F.transform(spans, lambda s: s["start"]), at_value(others, lambda o: o["end"], lambda o: o["end"]))
    right = last_before(F.transform(spans, lambda s: -s["end"]), at_value(others, lambda o: -o["start"], lambda o: -o["start"]))
    close = lambda s, m: F.coalesce(s - m <= distance, F.lit(False))
    beside = F.zip_with(spans, left, lambda s, m: F.struct(close(s["start"], m).alias("hit"), s["end"].alias("end")))
    return F.zip_with(beside, right, lambda b, m: b["hit"] | close(-b["end"], m))


def covered(spans: Column, others: Column) -> Column:
    """For each span whether one of others contains it."""
    reach = last_before(F.transform(spans, lambda s: s["start"]), at_value(others, lambda o: o["start"], lambda o: o["end"]))
    return F.zip_with(spans, reach, lambda s, m: F.coalesce(m >= s["end"], F.lit(False)))


def around(spans: Column, others: Column, distance: int) -> Column:
    """For each span whether one of others, which don't overlap each other, stands within the span widened by distance."""
    start = last_before(F.transform(spans, lambda s: s["end"] + distance), at_value(others, lambda o: o["end"], lambda o: o["start"]))
    return F.zip_with(spans, start, lambda s, m: F.coalesce(m >= s["start"] - distance, F.lit(False)))


def chosen(spans: Column, marks: Column) -> Column:
    """The spans whose mark is true."""
    both = F.zip_with(spans, marks, lambda s, m: F.struct(s.alias("s"), m.alias("m")))
    return F.transform(F.filter(both, lambda x: x["m"]), lambda x: x["s"])


def blocks_of(text: Column) -> Column:
    """The text in blocks of BLOCK code points."""
    return F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))


def part_of(blocks: Column, start: Column, end: Column) -> Column:
    """Code points start to end of a text in blocks: only the blocks there are walked."""
    first = F.floor(start / BLOCK).cast("int")
    count = F.floor((end - 1) / BLOCK).cast("int") - first + 1
    return F.when(end > start, F.substring(F.array_join(F.slice(blocks, first + 1, count), ""), start % BLOCK + 1, end - start)).otherwise("")


def digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn(value: Column) -> Column:
    """Whether the digits of value pass the Luhn sum."""
    d = digits(value)
    n = F.length(d)
    each = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.struct(i.alias("i"), F.substring(d, n - i + 1, F.lit(1)).cast("int").alias("d")))
    total = F.aggregate(each, F.lit(0), lambda a, x: a + F.when(x["i"] % 2 == 1, x["d"]).when(x["d"] > 4, x["d"] * 2 - 9).otherwise(x["d"] * 2))
    return (n > 0) & (total % 10 == 0)


def mod97(value: Column) -> Column:
    """Whether an account number with a leading country code and check digits leaves 1 modulo 97."""
    v = F.upper(F.replace(value, F.lit(" "), F.lit("")))
    moved = F.concat(F.substring(v, F.lit(5), F.length(v)), F.substring(v, F.lit(1), F.lit(4)))
    chars = F.filter(F.split(moved, ""), lambda c: c != "")
    number = lambda c: F.when(c.between("0", "9"), F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
    rest = F.aggregate(chars, F.lit(0), lambda a, c: F.when(c.between("0", "9"), (a * 10 + number(c)) % 97).otherwise((a * 100 + number(c)) % 97))
    return rest == 1


def spans_of(text: str, found: str, pattern: str, kind: str, ord_: int, keep=None, score: Column | float = 1.0) -> Column:
    """Spans of one kind, those that keep(value) accepts."""
    p = positions(text, found, pattern)
    p = F.filter(p, lambda x: F.coalesce(keep(x["value"]), F.lit(False))) if keep else p
    made = F.transform(p, lambda x: F.struct(F.lit(kind).alias("kind"), F.lit(ord_).alias("ord"), x["start"].alias("start"), x["end"].alias("end"), x["value"].alias("value"), F.lit(score).cast("double").alias("score")))
    return F.coalesce(made, F.array().cast(SPAN))


def listed(spans: Column) -> Column:
    """kind:start:end, comma-joined, in the array's order."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def by_kind(spans: Column) -> Column:
    """Sorted by kind as numbered, then start, then end."""
    order = F.transform(spans, lambda s: F.struct(s["ord"].alias("ord"), s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value"), s["score"].alias("score")))
    return F.transform(F.sort_array(order), lambda s: F.struct(*[s[c].alias(c) for c in ("kind", "ord", "start", "end", "value", "score")]))


def by_start(spans: Column) -> Column:
    """Sorted by start, then kind as numbered, then end."""
    order = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["ord"].alias("ord"), s["end"].alias("end"), s["kind"].alias("kind"), s["value"].alias("value"), s["score"].alias("score")))
    return F.transform(F.sort_array(order), lambda s: F.struct(*[s[c].alias(c) for c in ("kind", "ord", "start", "end", "value", "score")]))
