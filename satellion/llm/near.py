"""N-gram Jaccard join by a count-vector R-tree.

1. Sketch: each text's distinct word 5-shingles as 64-bit hashes. Equal sets become one class, represented by its smallest id.
2. Exact blocking: sets at least `percent` similar share an element of their prefixes (the rarest
   n - ceil(percent * n) + 1 elements in any order that all texts share). The order puts shingles that a bounded
   sample shows to be frequent last; this only steers cost, as the prefix rule holds in every order.
3. Min-hash bands first propose star edges, verified exactly. What these connect needs no further test to be one component.
4. In each block the rest are points in an R-tree: shingles hashed into groups, counted by group. The summed
   coordinate minima of a query and a node's upper corner bound the overlap of all points below the node. Blocks are
   cut into tiles of bounded size; every pair of tiles is a task of its own, so hot blocks are split and nothing is capped.
5. Surviving pairs are verified on whole texts, and links become components.
6. To count links, classes of one star component meet in tiles too, by their differences from one of them.

Ids stand for rows: rows that share an id are one document. Rows with a null id are returned unlinked, with a
null component. Null texts, and texts without words, have an empty set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from satellion.functions.shipping import ship
from satellion.llm.common import batches, mix64, set_aside, store, word_hashes
from satellion.llm.components import components

N, BANDS, ROWS, TILE = 5, 8, 3, 1024
#: Of links inside components: classes and elements of a tile, the most pairs of sets of an element that is counted by pairs, and pairs counted at once.
INNER, INNER_SHINGLES, FEW, PAIRS = 1024, 1 << 20, 4096, 1 << 21
_MIX = [np.uint64(pow(0x9E3779B97F4A7C15, 2 * k + 3, 1 << 64)) for k in range(N)]
_MINH = [np.uint64(pow(0xD1342543DE82EF95, k + 1, 1 << 64)) for k in range(BANDS * ROWS)]
_KEY = np.uint64((1 << 48) - 1)


def shingle_sets(texts: list[str | None], n: int = N) -> Iterator[np.ndarray]:
    """Each text's sorted distinct shingle hashes."""
    for i, j in batches(texts):
        words, at = word_hashes(texts[i:j])
        whole = np.zeros(max(0, len(words) - n + 1), dtype=np.uint64)
        for k in range(n):
            whole += words[k : k + len(whole)] * _MIX[k % N] ** np.uint64(1 + k // N)
        whole = mix64(whole)
        for a, b in zip(at[:-1], at[1:]):
            if b - a >= n:
                yield np.unique(whole[a : b - n + 1])
            elif b > a:
                short = mix64(np.sum(words[a:b] * np.array([_MIX[k % N] for k in range(b - a)], dtype=np.uint64), keepdims=True) + np.uint64(b - a))
                yield short
            else:
                yield np.zeros(0, dtype=np.uint64)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether percent of the union, at least, is shared."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def shared_counts(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """How many elements each set of left shares with each of right. Elements of few sets are counted pair by pair, others by matrix products."""
    out = np.zeros((len(left), len(right)), dtype=np.int64)
    both = np.intersect1d(np.concatenate(left), np.concatenate(right))
    if not len(both):
        return out

    def owners(sets: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sets by element of both, the first of each element's, and how many it has."""
        flat, who = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.minimum(np.searchsorted(both, flat), len(both) - 1)
        keep = both[at] == flat
        at, who = at[keep], who[keep]
        often = np.bincount(at, minlength=len(both))
        return who[np.argsort(at, kind="stable")], np.cumsum(often) - often, often

    (who_l, first_l, n_l), (who_r, first_r, n_r) = owners(left), owners(right)
    work = n_l * n_r
    few = np.flatnonzero(work <= FEW)
    cut = np.searchsorted(np.cumsum(work[few]), np.arange(PAIRS, work[few].sum() + PAIRS, PAIRS), side="right")
    for a, b in zip(np.append(0, cut[:-1]), cut):
        e = few[a:b]
        each = work[e]
        t = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        wide = np.repeat(n_r[e], each)
        x, y = who_l[np.repeat(first_l[e], each) + t // wide], who_r[np.repeat(first_r[e], each) + t % wide]
        out += np.bincount(x * len(right) + y, minlength=out.size).reshape(out.shape)
    many = np.flatnonzero(work > FEW)
    for k in range(0, len(many), 1024):
        e = many[k : k + 1024]
        has = []
        for who, first, n, m in ((who_l, first_l, n_l, len(left)), (who_r, first_r, n_r, len(right))):
            h = np.zeros((m, len(e)), dtype=np.float32)
            column = np.repeat(np.arange(len(e)), n[e])
            h[who[np.repeat(first[e] - np.cumsum(n[e]) + n[e], n[e]) + np.arange(n[e].sum())], column] = 1
            has.append(h)
        out += (has[0] @ has[1].T).astype(np.int64)
    return out


def prefix_size(n: int, percent: int) -> int:
    return n - -(-percent * n // 100) + 1


def count_vector(s: np.ndarray) -> np.ndarray:
    """Counts by group: a power of two of groups, half as many as elements at least; groups are leading bits, so vectors fold."""
    bits = min(15, max(4, int(np.ceil(np.log2(max(1, len(s)) / 2)))))
    return np.bincount((s >> np.uint64(64 - bits)).astype(np.int64), minlength=1 << bits).astype(np.uint16)


def pack(v: np.ndarray) -> bytes:
    return v.astype(np.uint8).tobytes() if v.max(initial=0) < 256 else b"\x01" + v.tobytes()


def unpack(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, dtype=np.uint8) if len(raw) % 2 == 0 else np.frombuffer(raw[1:], dtype=np.uint16)


def fold(v: np.ndarray, size: int) -> np.ndarray:
    return v if len(v) == size else v.reshape(size, -1).sum(1)


class CountRTree:
    """Packed R-tree over count vectors, in order of size: leaves of points, above them upper corners and smallest sizes."""

    def __init__(self, points: np.ndarray, fan: int = 16):
        self.n = points.sum(1)
        self.order = np.argsort(self.n, kind="stable")
        self.n, self.fan = self.n[self.order], fan
        self.levels = [(points[self.order], self.n, self.n)]
        while len(self.levels[-1][0]) > fan:
            p, low, high = self.levels[-1]
            cut = np.arange(0, len(p), fan)
            self.levels.append((np.maximum.reduceat(p, cut), np.minimum.reduceat(low, cut), np.maximum.reduceat(high, cut)))

    def search(self, q: np.ndarray, percent: int) -> np.ndarray:
        """Places of all points whose bound allows percent of the union to be shared with q."""
        n, at = int(q.sum()), np.arange(len(self.levels[-1][0]))
        for depth in range(len(self.levels) - 1, -1, -1):
            corner, low, high = self.levels[depth]
            at = at[(100 * low[at] <= 100 * n * 100 // percent) & (100 * high[at] >= percent * n)]
            bound = np.minimum(corner[at], q).sum(1)
            least = np.maximum(low[at], -(-percent * n // 100))
            at = at[(100 + percent) * np.minimum(bound, n) >= percent * (n + least)]
            if depth:
                below = len(self.levels[depth - 1][0])
                at = (at[:, None] * self.fan + np.arange(self.fan)).ravel()
                at = at[at < below]
        return self.order[at]


def tile_pairs(ids: np.ndarray, comp: np.ndarray, part: np.ndarray, vectors: list[np.ndarray], percent: int) -> np.ndarray:
    """Pairs that the bound allows between tile 0 and tile 1, or within tile 0 if there is no other; not within a component."""
    sizes = np.array([int(v.sum()) for v in vectors])
    out = []
    left, right = np.flatnonzero(part == 0), np.flatnonzero(part == 1)
    within = not len(right)
    right = left if within else right
    # by size classes: as fine vectors as both sides have
    cls = np.array([len(v) for v in vectors])
    for c in np.unique(cls[right]):
        r = right[cls[right] == c]
        trees = {}
        for k in left:
            g = min(int(cls[k]), int(c))
            if 100 * sizes[k] < percent * sizes[r].min() or 100 * sizes[r].max() < percent * sizes[k]:
                continue
            if g not in trees:
                trees[g] = CountRTree(np.stack([fold(vectors[x], g) for x in r]).astype(np.int32))
            hit = r[trees[g].search(fold(vectors[k], g).astype(np.int32), percent)]
            hit = hit[comp[hit] != comp[k]]
            if within:
                hit = hit[hit > k]
            if len(hit):
                out.append(np.stack((np.minimum(ids[k], ids[hit]), np.maximum(ids[k], ids[hit])), 1))
    return np.concatenate(out) if out else np.zeros((0, 2), np.int64)


def runs(parts: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """Rows sorted by keys, in frames that hold whole groups."""
    rest = None
    for pdf in parts:
        if rest is not None:
            pdf = pd.concat((rest, pdf), ignore_index=True)
        if not len(pdf):
            continue
        same = np.ones(len(pdf), dtype=bool)
        for k in keys:
            same &= (pdf[k] == pdf[k].iloc[-1]).to_numpy()
        cut = int(np.argmax(same))
        if cut:
            yield pdf.iloc[:cut]
        rest = pdf.iloc[cut:]
    if rest is not None and len(rest):
        yield rest


def starts_of(pdf: pd.DataFrame, keys: list[str]) -> np.ndarray:
    new = np.zeros(len(pdf), dtype=bool)
    new[:1] = True
    for k in keys:
        v = pdf[k].to_numpy()
        new[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(new), len(pdf))


def frequent_shingles(docs: DataFrame, sample_docs: int, least: int) -> np.ndarray:
    """Sorted hashes that occur in `least` documents of a sample of sample_docs chosen by id hash. Bounded by the sample's size."""
    ids = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)

    def explode(parts):
        for pdf in parts:
            for s in shingle_sets(pdf.text.tolist()):
                yield pd.DataFrame({"h": s.view(np.int64)})

    rows = docs.join(F.broadcast(ids), "doc_id").mapInPandas(explode, "h long").groupBy("h").count().where(F.col("count") >= least)
    return np.sort(rows.select("h").toPandas().h.to_numpy(dtype=np.int64).view(np.uint64))


def sketch(docs: DataFrame, percent: int, hot: np.ndarray) -> DataFrame:
    """(doc_id, n, s1, s2, keys, bands, vec) of (doc_id, text): set size, its 128-bit signature, prefix keys, bands, packed counts."""
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def run(parts):
        hot = shared.value
        for pdf in parts:
            out = {k: [] for k in ("n", "s1", "s2", "keys", "bands", "vec")}
            for s in shingle_sets(pdf.text.tolist()):
                out["n"].append(len(s))
                out["s1"].append(int(np.bitwise_xor.reduce(s)) - (1 << 63) if len(s) else 0)
                out["s2"].append(int(np.sum(mix64(s + np.uint64(1)), dtype=np.uint64)) - (1 << 63) if len(s) else 0)
                if not len(s):
                    for k in ("keys", "bands", "vec"):
                        out[k].append(None)
                    continue
                keep = prefix_size(len(s), percent)
                if len(hot):
                    at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
                    often = hot[at] == s
                    first = s[~often][:keep]
                    first = np.concatenate((first, s[often][: keep - len(first)]))
                else:
                    first = s[:keep]
                out["keys"].append((first & _KEY).astype(np.int64))
                low = np.array([((s * m) >> np.uint64(17)).min() for m in _MINH], dtype=np.uint64).reshape(BANDS, ROWS)
                b = low[:, 0] * _MIX[0] + low[:, 1] * _MIX[1] + low[:, 2] * _MIX[2] + np.arange(BANDS, dtype=np.uint64)
                out["bands"].append(mix64(b).view(np.int64))
                out["vec"].append(pack(count_vector(s)))
            yield pd.DataFrame({"doc_id": pdf.doc_id, **out})

    return docs.mapInPandas(run, "doc_id long, n long, s1 long, s2 long, keys array<long>, bands array<long>, vec binary")


def with_ids(docs: DataFrame, ids: DataFrame, bits: int = 24) -> DataFrame:
    """docs whose doc_id is among ids, and few others: by a bitmap of id hashes with 2**(bits - 6) rows at most, a fixed size."""
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(1 << bits))
    marks = ids.select(place(F.col("id")).alias("p")).groupBy(F.shiftright("p", 6).alias("w")).agg(F.expr("bit_or(shiftleft(1L, cast(p & 63 as int)))").alias("mask"))
    p = docs.withColumn("p", place(F.col("doc_id"))).withColumn("w", F.shiftright("p", 6))
    return p.join(F.broadcast(marks), "w").where(F.expr("getbit(mask, cast(p & 63 as int)) = 1")).select("doc_id", "text")


def verify(docs: DataFrame, pairs: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) whose whole texts link. Each a's text meets the texts of its bs, a thousand or so a task."""
    salts = pairs.groupBy(F.col("a").alias("c")).agg(F.ceil(F.count("*") / TILE).cast("int").alias("salts"))
    member = pairs.select(F.col("b").alias("id"), F.col("a").alias("c"), F.lit(1).alias("role")).join(salts, "c").withColumn("salt", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int"))
    centre = salts.select(F.col("c").alias("id"), "c", F.lit(0).alias("role"), "salts", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"))
    roles = store(member.select("c", "salt", "role", "id").union(centre.select("c", "salt", "role", "id")))
    texts = with_ids(docs, roles.select("id")).join(roles, F.col("doc_id") == F.col("id"))
    dealt = texts.select("c", "salt", "role", "id", "text").repartition(F.col("c"), F.col("salt")).sortWithinPartitions("c", "salt", "role", "id")

    def run(parts):
        now, sets = None, []
        for pdf in parts:
            hits = []
            for c, salt, role, i, s in zip(pdf.c, pdf.salt, pdf.role, pdf.id, shingle_sets(pdf.text.tolist())):
                if (c, salt) != now:
                    now, sets = (c, salt), []
                if role == 0:
                    sets.append(s)
                elif any(linked(x, s, percent) for x in sets):
                    hits.append((c, i))
            yield pd.DataFrame(hits, columns=["a", "b"], dtype="int64")

    return dealt.mapInPandas(run, "a long, b long").distinct()


def candidates(reps: DataFrame, percent: int) -> DataFrame:
    """Pairs of classes in different components whose prefixes meet and whose count vectors allow a link. reps(id, comp, keys, vec).

    Keys with the same first member (by component, then id) make one block, so classes that share many keys meet once.
    """
    keyed = reps.select(F.explode("keys").alias("key"), "id", "comp").repartition("key").sortWithinPartitions("key", "comp", "id")

    def mixed(parts):
        """(anchor, id, comp) of keys that hold several components. A key's first component waits for a second one; a long wait ends in its being passed on, which costs work only."""
        key = anchor = comp = None
        held: list[np.ndarray] | None = []
        n = 0
        for pdf in parts:
            if not len(pdf):
                continue
            k, c, i = (pdf[x].to_numpy() for x in ("key", "comp", "id"))
            at = starts_of(pdf, ["key"])
            out = []
            first = 0
            if k[0] == key:  # goes on from the frame before
                first = 1
                rows = np.stack((np.full(at[1], anchor), i[: at[1]], c[: at[1]]), 1)
                n += len(rows)
                if held is not None and rows[-1, 2] == comp and n < 1 << 20:
                    held.append(rows)
                else:
                    out += [*(held or ()), rows]
                    held = None
            if len(at) - 1 > first:
                begin, end = at[first:-1], at[first + 1 :]
                heads = np.repeat(i[begin], end - begin)
                rows = np.stack((heads, i[at[first] :], c[at[first] :]), 1)
                both = c[begin] != c[end - 1]
                out.append(rows[np.repeat(both, end - begin)])
                a = begin[-1]
                key, anchor, comp, n = k[a], i[a], c[a], end[-1] - a
                held = None if both[-1] else [rows[a - at[first] :]]
            rows = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 3), np.int64)
            yield pd.DataFrame({"anchor": rows[:, 0], "id": rows[:, 1], "comp": rows[:, 2]})

    rows = store(keyed.mapInPandas(mixed, "anchor long, id long, comp long").distinct())
    tiles = rows.groupBy("anchor").agg(F.ceil(F.count("*") / TILE).cast("int").alias("tiles")).where("tiles > 1")
    tile = F.pmod(F.xxhash64("id"), F.coalesce("tiles", F.lit(1))).cast("int")
    spread = (
        rows.join(tiles, "anchor", "left").join(reps.select("id", "vec"), "id").withColumn("tile", tile)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.coalesce("tiles", F.lit(1)) - 1)))
        .select("anchor", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), (F.col("tile") > F.col("other")).cast("int").alias("part"), "id", "comp", "vec")
    )
    keys = ["anchor", "i", "j"]

    def search(parts):
        for pdf in runs(parts, keys):
            at = starts_of(pdf, keys)
            ids, comp, part, raw = (pdf[x].to_numpy() for x in ("id", "comp", "part", "vec"))
            i, j = pdf.i.to_numpy(), pdf.j.to_numpy()
            out = []
            for a, b in zip(at[:-1], at[1:]):
                if b - a > 1 and not (i[a] != j[a] and part[a:b].min() == part[a:b].max()):
                    out.append(tile_pairs(ids[a:b], comp[a:b], part[a:b], [unpack(x) for x in raw[a:b]], percent))
            rows = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), np.int64)
            yield pd.DataFrame({"a": rows[:, 0], "b": rows[:, 1]})

    return spread.repartition(*keys).sortWithinPartitions(*keys, "part", "id").mapInPandas(search, "a long, b long").distinct()


def differences(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """(comp, id, copies, c, n, lost, diff) of nodes(id, comp, copies): the size of the set of the component's smallest id, the size of the node's own set, how many of
    the former's elements it lacks, and all elements that only one of both has.

    The smallest id's text meets the texts of its component, a thousand or so a task.
    """
    salts = nodes.groupBy("comp").agg(F.count("*").alias("m"), F.ceil(F.count("*") / TILE).cast("int").alias("salts")).where("m > 2")  # two are a component by the one link between them
    member = nodes.join(salts, "comp").select("comp", F.pmod(F.xxhash64("id"), F.col("salts")).cast("int").alias("salt"), F.lit(1).alias("role"), "id", "copies")
    centre = salts.select("comp", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(0).alias("role"), F.col("comp").alias("id"), F.lit(0).cast("long").alias("copies"))
    roles = store(member.union(centre))
    texts = with_ids(docs, roles.select("id")).join(roles, F.col("doc_id") == F.col("id"))
    dealt = texts.select("comp", "salt", "role", "id", "copies", "text").repartition(F.col("comp"), F.col("salt")).sortWithinPartitions("comp", "salt", "role", "id")

    def run(parts):
        now, base = None, None
        for pdf in parts:
            out = []
            for comp, salt, role, i, copies, s in zip(pdf.comp, pdf.salt, pdf.role, pdf.id, pdf.copies, shingle_sets(pdf.text.tolist())):
                if (comp, salt) != now:
                    now, base = (comp, salt), None
                if role == 0:
                    # where rows share the id, one set of them, the same in every task
                    base = s if base is None or (len(s), s.tobytes()) < (len(base), base.tobytes()) else base
                else:
                    lost = np.setdiff1d(base, s, assume_unique=True)
                    more = np.setdiff1d(s, base, assume_unique=True)
                    out.append((comp, i, copies, len(base), len(s), len(lost), np.concatenate((lost, more)).view(np.int64)))
            yield pd.DataFrame(out, columns=["comp", "id", "copies", "c", "n", "lost", "diff"])

    return dealt.mapInPandas(run, "comp long, id long, copies long, c long, n long, lost long, diff array<long>")


def inner_links(docs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """(id, n): how many documents of other classes of its component link with a class, in parts that add up. nodes(id, comp, copies).

    Sets of a component are mostly alike, so each is told by its difference from one of them: two sets share c - lost - lost + (what
    their differences share). Components are cut into tiles, and every pair of tiles is a task in which all differences meet; only counts leave it.
    """
    diffs = store(differences(docs, nodes))
    tiles = diffs.groupBy("comp").agg(F.greatest(F.ceil(F.count("*") / INNER), F.ceil(F.sum(F.size("diff")) / INNER_SHINGLES)).cast("int").alias("tiles"))
    keys = ["comp", "i", "j"]
    dealt = (
        diffs.join(tiles, "comp").withColumn("tile", F.pmod(F.xxhash64("id"), F.col("tiles")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        .select("comp", F.least("tile", "other").alias("i"), F.greatest("tile", "other").alias("j"), (F.col("tile") > F.col("other")).cast("int").alias("part"), "id", "copies", "c", "n", "lost", "diff")
        .repartition(*keys).sortWithinPartitions(*keys, "part", "id")
    )

    def meet(ids, copies, c, n, lost, sets, x: slice, y: slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Heads of the ids of x and y, and which of them link."""
        both = c - lost[x, None] - lost[None, y] + shared_counts(sets[x], sets[y])
        link = 100 * both >= percent * (n[x, None] + n[None, y] - both)
        heads = [np.flatnonzero(np.append(True, i[1:] != i[:-1])) for i in (ids[x], ids[y])]
        return *heads, np.logical_or.reduceat(np.logical_or.reduceat(link, heads[0], axis=0), heads[1], axis=1)

    def run(parts):
        for pdf in runs(parts, keys):
            at = starts_of(pdf, keys)
            ids, part, copies, c, n, lost = (pdf[x].to_numpy() for x in ("id", "part", "copies", "c", "n", "lost"))
            sets = [np.asarray(d, dtype=np.int64).view(np.uint64) for d in pdf["diff"]]
            across = (pdf.i != pdf.j).to_numpy()
            out = []
            for a, b in zip(at[:-1], at[1:]):
                mid = a + int((part[a:b] == 0).sum()) if across[a] else b
                if across[a] and mid in (a, b):
                    continue
                x, y = (slice(a, mid), slice(mid, b)) if across[a] else (slice(a, b), slice(a, b))
                hx, hy, link = meet(ids, copies, c[a], n, lost, sets, x, y)
                if not across[a]:
                    np.fill_diagonal(link, False)
                else:
                    out.append(np.stack((ids[y][hy], link.T @ copies[x][hx]), 1))
                out.append(np.stack((ids[x][hx], link @ copies[y][hy]), 1))
            rows = np.concatenate(out) if out else np.zeros((0, 2), np.int64)
            yield pd.DataFrame({"id": rows[:, 0], "n": rows[:, 1]})

    return dealt.mapInPandas(run, "id long, n long")


def jaccard_join(documents: DataFrame, percent: int = 75, sample_docs: int = 4000, frequent: int = 8, count_links: bool = True) -> DataFrame:
    """(doc_id, n_shingles, component_id, n_links) for each row of documents; without n_links where links aren't counted.

    n_links is the number of other documents whose sets link with the row's, copies of either included. Rows with a null id have none.
    Where different texts share an id, a class that this id represents has the links of all these texts. Whole texts count, however long; other
    columns are not read; an empty table stays empty.
    """
    ship(documents.sparkSession)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    named = docs.where("doc_id is not null")
    all_rows = store(sketch(docs, percent, frequent_shingles(named, sample_docs, frequent)))
    classes = all_rows.where("n > 0 and doc_id is not null").groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"))
    rep_rows = all_rows.join(classes, [all_rows.s1 == classes.s1, all_rows.s2 == classes.s2, all_rows.doc_id == classes.rep], "left_semi")
    reps = store(rep_rows.select(F.col("doc_id").alias("id"), "n", "keys", "bands", "vec"))
    # star edges of equal bands
    bands = reps.select("id", F.explode("bands").alias("band"))
    centres = bands.groupBy("band").agg(F.min("id").alias("a"), F.max("id").alias("z")).where("a < z").drop("z")
    stars = bands.join(centres, "band").where("a < id").select("a", F.col("id").alias("b")).distinct()
    first = store(verify(named, store(stars), percent))
    # rows of one id are one node, and so are all ids of a class
    comp = components(first)
    whole = store(reps.join(comp, "id", "left").select("id", F.coalesce("comp", "id").alias("comp"), "keys", "vec"))
    across = store(verify(named, store(candidates(whole, percent)), percent))
    final = components(first.union(across).union(_same_id(all_rows, classes)))
    named_classes = classes.join(final.withColumnRenamed("id", "rep"), "rep", "left").select("rep", "s1", "s2", F.coalesce("comp", "rep").alias("c"))
    if count_links:
        sizes = all_rows.where("n > 0 and doc_id is not null").select("s1", "s2", "doc_id").distinct().groupBy("s1", "s2").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"))
        # classes of one representative share it
        sizes = store(sizes.groupBy("rep").agg((F.sum("copies") - F.count("*") + 1).alias("copies")))
        nodes = store(comp.join(sizes.withColumnRenamed("rep", "id"), "id"))
        two = nodes.groupBy("comp").agg(F.min("id").alias("a"), F.max("id").alias("b"), F.count("*").alias("m")).where("m = 2").select("a", "b")
        pairs = across.union(two)
        outer = pairs.union(pairs.select("b", "a")).join(sizes, F.col("b") == F.col("rep")).select(F.col("a").alias("id"), F.col("copies").alias("n"))
        own = sizes.select(F.col("rep").alias("id"), (F.col("copies") - 1).alias("n"))
        degree = own.union(outer).union(inner_links(named, nodes, percent)).groupBy(F.col("id").alias("rep")).agg(F.sum("n").alias("n_links"))
        named_classes = named_classes.join(degree, "rep", "left")
    named_classes = named_classes.drop("rep")
    has = F.col("doc_id").isNotNull() & (F.col("n") > 0)
    counted = [F.coalesce(F.when(has, F.col("n_links")), F.lit(0)).cast("long").alias("n_links")] if count_links else []
    return all_rows.select("doc_id", "n", "s1", "s2").join(named_classes, ["s1", "s2"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when(F.col("doc_id").isNotNull(), F.when(F.col("n") > 0, F.col("c")).otherwise(F.col("doc_id"))).alias("component_id"),
        *counted,
    )


def _same_id(rows: DataFrame, classes: DataFrame) -> DataFrame:
    """Links between the classes of rows that share an id."""
    own = rows.where("n > 0 and doc_id is not null")
    twice = own.groupBy("doc_id").agg(F.min(F.struct("s1", "s2")).alias("x"), F.max(F.struct("s1", "s2")).alias("y")).where("x <> y").select("doc_id")
    of = own.join(twice, "doc_id", "left_semi").select("doc_id", "s1", "s2").join(classes, ["s1", "s2"]).select("doc_id", "rep")
    low = of.groupBy("doc_id").agg(F.min("rep").alias("a"))
    return of.join(low, "doc_id").where("a < rep").select("a", F.col("rep").alias("b")).distinct()


def drop_near_duplicates(documents: DataFrame, percent: int = 75) -> DataFrame:
    """One document of each component stays: the one with the smallest id, and of rows that share it the one with the smallest text, then the smallest hash of its other columns. Rows with a null id stay."""
    kept = jaccard_join(documents, percent, count_links=False).where("doc_id = component_id").select(F.col("doc_id").alias("keep_id")).distinct()
    plain, back = set_aside(documents, ("doc_id", "text"))
    named = plain.where("doc_id is not null").join(kept, F.col("doc_id") == F.col("keep_id"), "left_semi")
    others = [F.col(c) for c, t in plain.dtypes if c not in ("doc_id", "text") and "map<" not in t and t != "variant"]
    order = F.struct(F.col("text"), F.xxhash64(F.lit(0), *others))
    rest = named.groupBy("doc_id").agg(F.min_by(F.struct(*plain.columns), order).alias("row")).select("row.*")
    return back(rest.union(plain.where("doc_id is null")))
