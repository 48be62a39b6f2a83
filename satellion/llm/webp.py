"""Lossless WebP: a reader for prefix codes, back-references, colour cache and all four transforms, and a writer for them.

Pixels are uint8 arrays (height, width, 4) in the order red, green, blue, alpha. `encode` writes a file with given transforms;
`encode_small` chooses them by the entropy they leave.
"""

from __future__ import annotations

import functools

import numpy as np

#: Fixed values of the format.
CODE_LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = 0, 1, 2, 3
CACHE_HASH = 0x1E35A7BD
MAX_SIDE = 1 << 14

#: Near places by distance, then columns off, right before left: 120 distance codes.
NEAR = sorted(((x, y) for y in range(8) for x in range(-7, 9) if y or x > 0), key=lambda p: (p[0] ** 2 + p[1] ** 2, abs(p[0]), p[0] < 0))


#: Fifteen bits the other way round; a shorter code is taken as the leading ones.
_TURNED = np.zeros(1 << 15, dtype=np.int64)
for _k in range(15):
    _TURNED |= (np.arange(1 << 15) >> _k & 1) << (14 - _k)
_TURNED_LIST = _TURNED.tolist()


class Bits:
    """Reads bits, lowest first."""

    def __init__(self, data: bytes):
        self.data, self.at, self.end = data, 0, 8 * len(data)

    def read(self, n: int) -> int:
        a, self.at = self.at, self.at + n
        if self.at > self.end:
            raise ValueError("the stream ends early")
        return int.from_bytes(self.data[a >> 3 : (self.at + 7) >> 3], "little") >> (a & 7) & ((1 << n) - 1)


def canonical(lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Codes, first bit lowest, and their lengths by symbol; the only symbol of a code has no bits."""
    n = np.array(lengths, dtype=np.int64)
    if len(lengths) <= 40:  # symbol by symbol, which is faster for few
        order = sorted([s for s, k in enumerate(lengths) if k], key=lengths.__getitem__)
        if len(order) < 2:
            return np.zeros(len(n), dtype=np.int64), np.zeros(len(n), dtype=np.int64)
        out, code = [0] * len(lengths), 0
        for s in order:
            if code >> 15:
                break
            out[s] = _TURNED_LIST[code]
            code += 1 << (15 - lengths[s])
        else:
            if code == 1 << 15:
                return np.array(out), n
        raise ValueError("the prefix code isn't complete")
    used = np.flatnonzero(n)
    codes = np.zeros(len(n), dtype=np.int64)
    if len(used) < 2:
        return codes, np.zeros(len(n), dtype=np.int64)
    order = used[np.argsort(n[used], kind="stable")]
    longest = int(n[order[-1]])
    step = np.int64(1) << (longest - n[order])
    first = np.cumsum(step) - step
    if first[-1] + step[-1] != 1 << longest:
        raise ValueError("the prefix code isn't complete")
    codes[order] = _TURNED[first << (15 - longest)]
    return codes, n


class Code:
    """Reads a canonical prefix code through a table: symbol << 4 | length by the next bits."""

    def __init__(self, lengths: list[int]):
        used = [s for s, n in enumerate(lengths) if n]
        if len(used) < 2:
            self.mask, self.array = 0, np.array([(used[0] if used else 0) << 4])
            return
        if len(lengths) <= 40:
            self.table = self._table(lengths, used)
            self.mask = len(self.table) - 1
            return
        codes, n = canonical(lengths)
        longest = int(n.max())
        self.mask = (1 << longest) - 1
        each = 1 << (longest - n[used])
        nth = np.arange(1 << longest) - np.repeat(np.cumsum(each) - each, each)
        table = np.empty(1 << longest, dtype=np.int64)
        table[np.repeat(codes[used], each) | nth << np.repeat(n[used], each)] = np.repeat(np.array(used) << 4 | n[used], each)
        self.array = table

    @classmethod
    def of(cls, first: int, second: int) -> Code:
        """A code of one symbol, of no bits, or of two."""
        code = cls([1])
        low, high = sorted((first, second))
        if low == high:
            code.array = np.array([low << 4])
        else:
            code.mask, code.array = 1, np.array([low << 4 | 1, high << 4 | 1])
        return code

    @staticmethod
    def _table(lengths: list[int], used: list[int]) -> list[int]:
        """The table symbol by symbol, which is faster for few."""
        longest = max(lengths)
        if sum(1 << (longest - lengths[s]) for s in used) != 1 << longest:
            raise ValueError("the prefix code isn't complete")
        table, code = [0] * (1 << longest), 0
        for s in sorted(used, key=lengths.__getitem__):
            n = lengths[s]
            table[_TURNED_LIST[code << (15 - longest)] :: 1 << n] = [s << 4 | n] * (1 << (longest - n))
            code += 1 << (longest - n)
        return table

    @functools.cached_property
    def table(self) -> list[int]:
        return self.array.tolist()

    @functools.cached_property
    def array(self) -> np.ndarray:
        return np.array(self.table)

    @property
    def only(self) -> int | None:
        """The only symbol, if there is one."""
        return None if self.mask else self.table[0] >> 4

    def read(self, bits: Bits) -> int:
        at = bits.at
        t = self.table[int.from_bytes(bits.data[at >> 3 : (at >> 3) + 3], "little") >> (at & 7) & self.mask]
        bits.at = at + (t & 15)
        if bits.at > bits.end:
            raise ValueError("the stream ends early")
        return t >> 4


def read_code(bits: Bits, symbols: int) -> Code:
    if bits.read(1):
        two, wide = bits.read(1), bits.read(1)
        first = bits.read(8 if wide else 1)
        second = bits.read(8) if two else first
        return Code.of(first, second)
    first = [0] * 19
    some = 4 + bits.read(4)
    x = bits.read(3 * some)
    for k in CODE_LENGTH_ORDER[:some]:
        first[k] = x & 7
        x >>= 3
    outer = Code(first)
    left = 2 + bits.read(2 + 2 * bits.read(3)) if bits.read(1) else symbols
    lengths, before, pos = [], 8, bits.at
    table, mask, data = outer.table, outer.mask, bits.data
    while len(lengths) < symbols and left:
        left -= 1
        x = int.from_bytes(data[pos >> 3 : (pos >> 3) + 3], "little") >> (pos & 7)
        t = table[x & mask]
        pos += t & 15
        x >>= t & 15
        n = t >> 4
        if n < 16:
            lengths.append(n)
            before = n or before
        elif n == 16:
            lengths += [before] * (3 + (x & 3))
            pos += 2
        elif n == 17:
            lengths += [0] * (3 + (x & 7))
            pos += 3
        else:
            lengths += [0] * (11 + (x & 127))
            pos += 7
    if len(lengths) > symbols or pos > bits.end:
        raise ValueError("too many code lengths, or the stream ends early")
    bits.at = pos
    return Code(lengths + [0] * (symbols - len(lengths)))


def prefixed(bits: Bits, code: int) -> int:
    """Length or distance of a prefix symbol."""
    if code < 4:
        return code + 1
    extra = (code - 2) >> 1
    return ((2 + (code & 1)) << extra) + bits.read(extra) + 1


def place_of(code: int, width: int) -> int:
    """Distance in pixels of a distance code."""
    if code > 120:
        return code - 120
    x, y = NEAR[code - 1]
    return max(1, x + y * width)


#: Extra bits of a prefix symbol, and the least value that it stands for.
_EXTRA = np.array([0 if c < 4 else (c - 2) >> 1 for c in range(40)])
_LEAST = np.array([c + 1 if c < 4 else ((2 + (c & 1)) << ((c - 2) >> 1)) + 1 for c in range(40)])
_EIGHT = np.arange(8)


def read_greens(bits: Bits, green: Code, far: Code, width: int, total: int, span: int = 4096) -> bytes:
    """Greens of a picture whose other channels have one value each: symbols of green alone, and back-references.

    What would stand at each bit of a span of bytes is looked up at once; then the symbols that do stand there follow one from the other.
    """
    if green.only is not None:
        if green.only < 256:
            return bytes([green.only]) * total
        raise ValueError("a back-reference leaves the picture")
    words = np.ndarray((len(bits.data) + 8,), "<i8", bits.data + bytes(16), strides=(1,))
    out, pos, short = bytearray(), bits.at, green.array.astype(np.int16)
    while (done := len(out)) < total:
        first = pos >> 3
        x = (words[first : min(first + span, len(bits.data)), None] >> _EIGHT).ravel()
        t = short[x & green.mask]
        size = t & 15
        then = np.arange(len(t)) + size
        refs = np.flatnonzero(t > 4095)
        n, at = (t[refs] >> 4).astype(np.int64) - 256, then[refs]
        length = _LEAST[n] + (x[refs] >> size[refs] & ((1 << _EXTRA[n]) - 1))
        at += _EXTRA[n]
        y = words[np.minimum(first + (at >> 3), len(words) - 1)] >> (at & 7)
        u = far.array[y & far.mask]
        d = u >> 4
        distance = _LEAST[d] + (y >> (u & 15) & ((1 << _EXTRA[d]) - 1))
        then[refs] = at + (u & 15) + _EXTRA[d]
        go, here, end = then.data, pos & 7, len(then)
        met: list[int] = []
        put = met.append
        while here < end:
            put(here)
            here = go[here]
        if not met:
            raise ValueError("the stream ends early")
        stand = np.array(met)
        symbols = t[stand] >> 4
        kth = np.flatnonzero(symbols > 255)
        which = np.searchsorted(refs, stand[kth])
        length, distance = length[which], distance[which]
        share = np.ones(len(stand), dtype=np.int64)
        share[kth] = length
        sums = np.cumsum(share)
        last = int(np.searchsorted(sums, total - done))
        if last < len(sums):
            if sums[last] != total - done:
                raise ValueError("a back-reference leaves the picture")
            here = int(then[stand[last]])
            symbols, kth = symbols[: last + 1], kth[kth <= last]
        plain, begin = symbols.astype(np.uint8).tobytes(), 0
        for k, n, d in zip(kth.tolist(), length.tolist(), distance.tolist()):
            out += plain[begin:k]
            begin, at = k + 1, len(out)
            d = place_of(d, width) if d < 121 else d - 120
            if d > at:
                raise ValueError("a back-reference leaves the picture")
            out += out[at - d : at - d + n] if d >= n else (out[at - d :] * (n // d + 1))[:n]
        out += plain[begin:]
        pos = 8 * first + here
    if pos > bits.end:
        raise ValueError("the stream ends early")
    bits.at = pos
    return bytes(out)


def read_picture(bits: Bits, width: int, height: int, outer: bool) -> np.ndarray:
    """Decodes one entropy-coded picture to (height, width, 4)."""
    cache_bits = bits.read(4) if bits.read(1) else 0
    groups, shift, choice = 1, 0, None
    if outer and bits.read(1):
        shift = bits.read(3) + 2
        entropy = read_picture(bits, -(-width >> shift), -(-height >> shift), False).astype(np.int64)
        choice = (entropy[:, :, 0] << 8 | entropy[:, :, 1]).tolist()
        groups = max(map(max, choice)) + 1
    codes = [[read_code(bits, n) for n in (280 + (1 << cache_bits if cache_bits else 0), 256, 256, 256, 40)] for _ in range(groups)]
    total = width * height
    if groups == 1 and not cache_bits and None not in (rest := [c.only for c in codes[0][1:4]]):
        picture = np.empty((height, width, 4), dtype=np.uint8)
        picture[:] = rest[0], 0, rest[1], rest[2]
        picture[:, :, 1] = np.frombuffer(read_greens(bits, codes[0][0], codes[0][4], width, total), dtype=np.uint8).reshape(height, width)
        return picture
    out: list[int] = []
    cache = [0] * (1 << cache_bits) if cache_bits else None
    (green, red, blue, alpha, far), data, pos, end, down = codes[0], bits.data, bits.at, bits.end, 32 - cache_bits
    (g, gm), (r, rm), (b, bm), (a, am) = ((c.table, c.mask) for c in (green, red, blue, alpha))
    put, at = out.append, 0
    while at < total:
        if choice is not None:
            green, red, blue, alpha, far = codes[choice[(at // width) >> shift][(at % width) >> shift]]
            (g, gm), (r, rm), (b, bm), (a, am) = ((c.table, c.mask) for c in (green, red, blue, alpha))
        x = int.from_bytes(data[pos >> 3 : (pos >> 3) + 9], "little") >> (pos & 7)
        t = g[x & gm]
        n, s = t & 15, t >> 4
        if s < 256:
            x >>= n
            u = r[x & rm]
            x >>= u & 15
            v = b[x & bm]
            w = a[x >> (v & 15) & am]
            pos += n + (u & 15) + (v & 15) + (w & 15)
            p = w >> 4 << 24 | u >> 4 << 16 | s << 8 | v >> 4
            put(p)
            at += 1
            if cache is not None:
                cache[(CACHE_HASH * p & 0xFFFFFFFF) >> down] = p
        elif s < 280:
            bits.at = pos + n
            n = prefixed(bits, s - 256)
            d = place_of(prefixed(bits, far.read(bits)), width)
            pos = bits.at
            if d > at or at + n > total:
                raise ValueError("a back-reference leaves the picture")
            new = (out[at - d :] * (n // d + 1))[:n]
            out += new
            at += n
            if cache is not None:
                for p in new:
                    cache[(CACHE_HASH * p & 0xFFFFFFFF) >> down] = p
        else:
            pos += n
            put(cache[s - 280])
            at += 1
        if pos > end:
            raise ValueError("the stream ends early")
    bits.at = pos
    return np.array(out, dtype="<u4").view(np.uint8).reshape(height, width, 4)[:, :, [2, 1, 0, 3]]


def _half(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a.astype(np.int16) + b) >> 1


def predict(mode: int, left, top, top_left, top_right):
    """Predicted channels (int16) for one mode."""
    left, top, top_left, top_right = (np.asarray(x, dtype=np.int16) for x in (left, top, top_left, top_right))
    if mode == 0 or mode > 13:
        return np.broadcast_to(np.array([0, 0, 0, 255], dtype=np.int16), top.shape)
    if mode < 5:
        return (left, top, top_right, top_left)[mode - 1]
    if mode == 5:
        return _half(_half(left, top_right), top)
    if mode < 11:
        a, b = {6: (left, top_left), 7: (left, top), 8: (top_left, top), 9: (top, top_right), 10: (_half(left, top_left), _half(top, top_right))}[mode]
        return _half(a, b)
    if mode == 11:
        guess = left + top - top_left
        nearer = np.abs(guess - left).sum(-1) < np.abs(guess - top).sum(-1)
        return np.where(nearer[..., None], left, top)
    if mode == 12:
        return np.clip(left + top - top_left, 0, 255)
    mean = _half(left, top)
    change = mean - top_left
    return np.clip(mean + np.where(change < 0, -(-change >> 1), change >> 1), 0, 255)


def residuals(pixels: np.ndarray, mode: int) -> np.ndarray:
    """What one mode leaves of a whole picture. Neighbours are places before in reading order; what the rightmost pixel sees to its upper right is the first pixel of its own row."""
    height, width = pixels.shape[:2]
    flat = pixels.reshape(-1, 4)
    out = np.empty_like(flat)
    out[0] = flat[0] - np.array([0, 0, 0, 255], dtype=np.uint8)
    out[1:width] = flat[1:width] - flat[: width - 1]
    if height > 1:
        n = len(flat) - width
        p = predict(mode, flat[width - 1 : -1], flat[:n], np.concatenate((flat[:1], flat[: n - 1])), flat[1 : n + 1])
        out[width:] = flat[width:] - p.astype(np.uint8)
        out[width::width] = flat[width::width] - flat[:n:width]
    return out.reshape(pixels.shape)


def tiled(tiles: np.ndarray, size_bits: int, height: int, width: int) -> np.ndarray:
    """Each pixel's tile."""
    return np.repeat(np.repeat(tiles, 1 << size_bits, 0), 1 << size_bits, 1)[:height, :width]


def foretold(pixels: np.ndarray, modes: np.ndarray, size_bits: int) -> np.ndarray:
    """Residuals of pixels; modes by tile."""
    each = tiled(modes, size_bits, *pixels.shape[:2])
    out = np.empty_like(pixels)
    for mode in np.unique(modes):
        here = each == mode
        out[here] = residuals(pixels, int(mode))[here]
    return out


#: Modes that don't look at the pixel to the left, so a row is one step.
ROWWISE = (0, 2, 3, 4, 8, 9)


def predicted(rest: np.ndarray, modes: np.ndarray, size_bits: int) -> np.ndarray:
    """Adds predictions to residuals, row by row, in runs of one mode."""
    height, width = rest.shape[:2]
    out = rest.copy()
    out[:1, :1, 3] += np.uint8(255)
    np.cumsum(out[0], axis=0, dtype=np.uint8, out=out[0])
    for y in range(1, height):
        out[y, 0] += out[y - 1, 0]
        above, row = out[y - 1], out[y]
        right = np.concatenate((above[1:], row[:1]))
        tile = modes[y >> size_bits]
        x = 1
        while x < width:
            k = x >> size_bits
            mode, stop = int(tile[k]), k + 1
            while stop < len(tile) and tile[stop] == mode:
                stop += 1
            stop = min(stop << size_bits, width)
            if mode in ROWWISE or mode > 13:
                row[x:stop] += predict(mode, above[x:stop], above[x:stop], above[x - 1 : stop - 1], right[x:stop]).astype(np.uint8)
            elif mode == 1:
                row[x - 1 : stop] = np.cumsum(row[x - 1 : stop], axis=0, dtype=np.uint8)
            else:
                _follow(mode, row, above, right, x, stop)
            x = stop
    return out


def _follow(mode: int, row: np.ndarray, above: np.ndarray, right: np.ndarray, start: int, stop: int) -> None:
    """Pixels start to stop of a row whose predictions need the pixel to the left."""
    left = row[start - 1].tolist()
    top, corner, ahead = above[start:stop].tolist(), above[start - 1 : stop - 1].tolist(), right[start:stop].tolist()
    out = []
    for rest, t, c, a in zip(row[start:stop].tolist(), top, corner, ahead):
        if mode == 5:
            p = [((x + z >> 1) + y) >> 1 for x, y, z in zip(left, t, a)]
        elif mode == 6:
            p = [(x + z) >> 1 for x, z in zip(left, c)]
        elif mode == 7:
            p = [(x + y) >> 1 for x, y in zip(left, t)]
        elif mode == 10:
            p = [((x + z >> 1) + (y + q >> 1)) >> 1 for x, y, z, q in zip(left, t, c, a)]
        elif mode == 11:
            # the guess is left + top - corner: its way to left is top's to corner, and the other way round
            p = left if sum(abs(y - z) for y, z in zip(t, c)) < sum(abs(x - z) for x, z in zip(left, c)) else t
        elif mode == 12:
            p = [min(255, max(0, x + y - z)) for x, y, z in zip(left, t, c)]
        else:
            p = []
            for x, y, z in zip(left, t, c):
                mean = x + y >> 1
                change = mean - z
                p.append(min(255, max(0, mean + (-(-change >> 1) if change < 0 else change >> 1))))
        left = [(x + y) & 255 for x, y in zip(rest, p)]
        out.append(left)
    row[start:stop] = out


def crossed(pixels: np.ndarray, elements: np.ndarray, size_bits: int, forward: bool) -> np.ndarray:
    """Adds what green and red foretell of red and blue, or takes it away if forward. elements by tile: red to blue, green to blue, green to red."""
    height, width = pixels.shape[:2]
    e = tiled(elements, size_bits, height, width).view(np.int8).astype(np.int16)
    part = lambda t, c: (t * c.view(np.int8).astype(np.int16)) >> 5
    out = pixels.copy()
    green = np.ascontiguousarray(pixels[:, :, 1])
    sign = -1 if forward else 1
    red = (pixels[:, :, 0] + sign * part(e[:, :, 2], green)).astype(np.uint8)
    source = np.ascontiguousarray(pixels[:, :, 0]) if forward else red
    out[:, :, 0] = red
    out[:, :, 2] = (pixels[:, :, 2] + sign * (part(e[:, :, 1], green) + part(e[:, :, 0], source))).astype(np.uint8)
    return out


def packed_bits(colours: int) -> int:
    return 3 if colours <= 2 else 2 if colours <= 4 else 1 if colours <= 16 else 0


def decode(data: bytes) -> np.ndarray:
    """Pixels of one lossless file."""
    if data[:4] != b"RIFF" or data[8:12] != b"WEBP" or data[12:16] != b"VP8L":
        raise ValueError("no lossless WebP file")
    bits = Bits(data[20 : 20 + int.from_bytes(data[16:20], "little")])
    if bits.read(8) != 0x2F:
        raise ValueError("no signature")
    width, height = bits.read(14) + 1, bits.read(14) + 1
    if bits.read(4) >> 1:
        raise ValueError("unknown version")
    undo, wide = [], width
    while bits.read(1):
        kind = bits.read(2)
        if kind in (PREDICTOR, CROSS_COLOUR):
            size = bits.read(3) + 2
            undo.append((kind, wide, size, read_picture(bits, -(-wide >> size), -(-height >> size), False)))
        elif kind == PALETTE:
            n = bits.read(8) + 1
            colours = np.cumsum(read_picture(bits, n, 1, False)[0], axis=0, dtype=np.uint8)
            undo.append((kind, wide, packed_bits(n), colours))
            wide = -(-wide >> packed_bits(n))
        else:
            undo.append((kind, wide, 0, None))
    pixels = read_picture(bits, wide, height, True)
    for kind, wide, size, more in reversed(undo):
        if kind == PREDICTOR:
            pixels = predicted(pixels, more[:, :, 1], size)
        elif kind == CROSS_COLOUR:
            pixels = crossed(pixels, more[:, :, :3], size, False)
        elif kind == SUBTRACT_GREEN:
            pixels = np.ascontiguousarray(pixels)
            pixels[:, :, 0] += pixels[:, :, 1]
            pixels[:, :, 2] += pixels[:, :, 1]
        else:
            each = 8 >> size
            index = pixels[:, :, 1][:, :, None] >> (np.arange(1 << size, dtype=np.uint8) * each) & ((1 << each) - 1)
            index = index.reshape(height, -1)[:, :wide]
            table = np.zeros((256, 4), dtype=np.uint8)  # beyond the table: transparent black
            table[: len(more)] = more
            pixels = table[index]
    return pixels


class Writer:
    """Collects bits, lowest first."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.values: list[int] = []
        self.sizes: list[int] = []

    def put(self, value: int, n: int) -> None:
        self.values.append(value)
        self.sizes.append(n)

    def put_all(self, values: np.ndarray, sizes: np.ndarray) -> None:
        """Values of at most 32 bits."""
        self._flush()
        self.parts.append((values, sizes))

    def _flush(self) -> None:
        if self.values:
            self.parts.append((np.array(self.values, dtype=np.int64), np.array(self.sizes, dtype=np.int64)))
            self.values, self.sizes = [], []

    def bytes(self) -> bytes:
        self._flush()
        values, sizes = (np.concatenate([p[k] for p in self.parts]) for k in (0, 1))
        end = np.cumsum(sizes)
        at = end - sizes
        word, low = at >> 6, (at & 63).astype(np.uint64)
        values = values.astype(np.uint64)
        # no bit is set twice, so sums of words are what they hold; as values have 32 bits at most, some value begins in each word, and one at most goes on in the next
        out = np.zeros((int(end[-1]) >> 6) + 2, dtype="<u8")
        begin = np.flatnonzero(np.diff(word, prepend=-1))
        out[word[begin]] = np.add.reduceat(values << low, begin)
        over = np.flatnonzero((at & 63) + sizes > 64)
        out[word[over] + 1] += values[over] >> (np.uint64(64) - low[over])
        return out.tobytes()[: -(-int(end[-1]) // 8)]


def code_lengths(counts: np.ndarray, most: int = 15) -> list[int]:
    """Lengths of a prefix code for counts, at most `most`: counts are flattened until it fits. An only symbol has length 1."""
    used = np.flatnonzero(counts)
    out = np.zeros(len(counts), dtype=np.int64)
    if len(used) < 2:
        out[used] = 1
        return out.tolist()
    floor = 1
    while True:
        weight = np.maximum(counts[used], floor)
        order = np.argsort(weight, kind="stable")
        n = len(used)
        beyond = int(weight.sum()) + 1
        # two queues: single symbols by weight, and pairs in the order they are made, both followed by more than any weight
        single, pairs = [*weight[order].tolist(), beyond], [beyond] * n
        parent = [0] * (2 * n - 1)
        i = j = 0
        for k in range(n, 2 * n - 1):
            x, y = single[i], pairs[j]
            if x <= y:
                parent[i] = k
                i += 1
                total, x = x, single[i]
            else:
                parent[n + j] = k
                j += 1
                total, y = y, pairs[j]
            if x <= y:
                parent[i] = k
                i += 1
                total += x
            else:
                parent[n + j] = k
                j += 1
                total += y
            pairs[k - n] = total
        depth = [0] * (2 * n - 1)
        for k in range(2 * n - 3, -1, -1):
            depth[k] = depth[parent[k]] + 1
        if max(depth[:n]) <= most:
            out[used[order]] = depth[:n]
            return out.tolist()
        floor *= 2


def write_code(w: Writer, lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """Writes a code's lengths; codes and lengths by symbol."""
    used = [s for s, n in enumerate(lengths) if n]
    if len(used) <= 2 and all(s < 256 for s in used):
        used = used or [0]
        w.put(1, 1)
        w.put(len(used) - 1, 1)
        w.put(1, 1)
        for s in used:
            w.put(s, 8)
        return canonical([1 if s in used else 0 for s in range(len(lengths))])
    tokens: list[int] = []  # symbol, bits of its run's length above 8, their number above 16
    n = np.array(lengths)
    edges = [0, *(np.flatnonzero(n[1:] != n[:-1]) + 1).tolist()]
    before = 8
    for start, stop in zip(edges, [*edges[1:], len(lengths)]):
        value, run = lengths[start], stop - start
        if value and value != before:
            tokens.append(value)
            run, before = run - 1, value
        while run > 2:
            some = min(run, 6 if value else 138)
            tokens.append(16 | some - 3 << 8 | 2 << 16 if value else 18 | some - 11 << 8 | 7 << 16 if some >= 11 else 17 | some - 3 << 8 | 3 << 16)
            run -= some
        tokens += [value] * run
    token = np.array(tokens, dtype=np.int64)
    t, extra, wide = token & 255, token >> 8 & 255, token >> 16
    counts = np.bincount(t, minlength=19)
    if (counts > 0).sum() == 1:
        counts[0 if not counts[0] else 1] = 1
    outer_lengths = code_lengths(counts, 7)
    w.put(0, 1)
    last = max(k for k in range(19) if outer_lengths[CODE_LENGTH_ORDER[k]] or k < 4)
    w.put(last + 1 - 4, 4)
    for k in range(last + 1):
        w.put(outer_lengths[CODE_LENGTH_ORDER[k]], 3)
    codes, sizes = canonical(outer_lengths)
    w.put(0, 1)
    w.put_all(codes[t] | extra << sizes[t], sizes[t] + wide)
    return canonical(lengths)


def prefix_of(value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, extra bits' values, their numbers) of lengths or distance codes."""
    v = np.asarray(value, dtype=np.int64) - 1
    top = np.frexp(np.maximum(v, 1).astype(np.float64))[1].astype(np.int64) - 1
    extra = np.where(v < 4, 0, top - 1)
    return np.where(v < 4, v, 2 * top + (v >> np.maximum(top - 1, 0) & 1)), v & ((np.int64(1) << extra) - 1), extra


def earlier(key: np.ndarray) -> np.ndarray:
    """For each place the last place before it with an equal key (48 bits at most), or -1."""
    if len(key) <= 1 << 16:
        both = np.sort(key.astype(np.uint64) << np.uint64(16) | np.arange(len(key), dtype=np.uint64))
        order, key = (both & np.uint64(65535)).astype(np.int64), both >> np.uint64(16)
    else:
        order = np.argsort(key, kind="stable")
        key = key[order]
    same = key[1:] == key[:-1]
    out = np.full(len(key), -1, dtype=np.int64)
    out[order[1:][same]] = order[:-1][same]
    return out


def packed(pixels: np.ndarray) -> np.ndarray:
    """One number a pixel, in reading order: alpha, red, green, blue."""
    return (pixels.astype(np.uint32) @ np.array([1 << 16, 1 << 8, 1, 1 << 24], dtype=np.uint32)).ravel()


def references_of(p: np.ndarray, least: int = 3) -> list[tuple[int, int, int]]:
    """(place, length, distance) of runs of `least` values or more that stand before, greedily, by the nearest earlier place of each run's start."""
    return list(zip(*[x.tolist() for x in reference_columns(p, least)]))


def reference_columns(p: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """references_of, a column each."""
    m = len(p) - least + 1
    none = np.zeros(0, dtype=np.int64)
    if m < 2:
        return none, none, none
    if p.dtype == np.uint8 and least <= 6:
        key = np.ndarray((m,), "<u8", p.tobytes() + bytes(8), strides=(1,)) & np.uint64((1 << 8 * least) - 1)
    else:
        q = p.astype(np.uint64)
        key = q[:m]
        for k in range(1, least):
            key = key * np.uint64(0x9E3779B97F4A7C15) ^ q[k : k + m]
        key = key * np.uint64(0xC2B2AE3D27D4EB4F) >> np.uint64(16)
    before = earlier(key)
    at = np.flatnonzero(before >= 0)
    for k in range(0 if p.dtype == np.uint8 and least <= 6 else least):  # keys that are hashes may agree by chance
        at = at[p[at + k] == p[before[at] + k]]
    if not len(at):
        return none, none, none
    d = at - before[at]
    ends = np.ones(len(at), dtype=bool)
    ends[:-1] = (at[1:] - at[:-1] != 1) | (d[1:] != d[:-1])
    last = np.flatnonzero(ends)
    runs = last + 1
    runs[1:] -= runs[:-1].copy()
    n = np.minimum(np.repeat(at[last], runs) - at + least, 4096)
    go, k, taken = np.searchsorted(at, at + n).data, 0, []
    while k < len(at):
        taken.append(k)
        k = go[k]
    return at[taken], n[taken], d[taken]


def cached(p: np.ndarray, cache_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Each pixel's place in the colour cache, and whether it stands there."""
    h = ((p.astype(np.uint64) * np.uint64(CACHE_HASH) & np.uint64(0xFFFFFFFF)) >> np.uint64(32 - cache_bits)).astype(np.int64)
    before = earlier(h)
    return h, (before >= 0) & (p[np.maximum(before, 0)] == p)


def cost(counts: np.ndarray) -> float:
    """Bits of symbols under their entropy, and about five a symbol for its length."""
    n = counts[counts > 0]
    return float(n.sum() * np.log2(n.sum()) - (n * np.log2(n)).sum() + 5 * len(n)) if len(n) > 1 else 8.0


@functools.lru_cache(64)
def _near(width: int) -> tuple[np.ndarray, np.ndarray]:
    """Near distances in order, and the lowest code of each."""
    places, first = np.unique([place_of(c, width) for c in range(1, 121)], return_index=True)
    return places, first + 1


def near_codes(d: np.ndarray, width: int) -> np.ndarray:
    """Distance codes of distances."""
    places, codes = _near(width)
    k = np.minimum(np.searchsorted(places, d), len(places) - 1)
    return np.where(places[k] == d, codes[k], d + 120)


def write_greens(w: Writer, green: np.ndarray, width: int) -> None:
    """The outer picture of opaque pixels whose red and blue are 0: symbols of green and back-references."""
    w.put(0, 2)  # no cache, one group of codes
    place, n, d = reference_columns(green, 6)
    open_ = np.bincount(place, minlength=len(green) + 1) - np.bincount(place + n, minlength=len(green) + 1)
    at = np.flatnonzero(np.cumsum(open_)[:-1] == 0)
    (ns, ds), (nv, dv), (nb, db) = (x.reshape(2, -1) for x in prefix_of(np.concatenate((n, near_codes(d, width)))))
    symbols = green[at].astype(np.int64)
    # short codes make small tables for the reader
    code, size = write_code(w, code_lengths(np.bincount(np.concatenate((symbols, 256 + ns)), minlength=280), 10))
    for value in (0, 0, 255):  # codes of one symbol, of eight bits
        w.put(0b101 | value << 3, 11)
    far, far_size = write_code(w, code_lengths(np.bincount(ds, minlength=40), 8))
    order = np.argsort(np.concatenate((at, place, place)), kind="stable")
    w.put_all(
        np.concatenate((code[symbols], code[256 + ns] | nv << size[256 + ns], far[ds] | dv << far_size[ds]))[order],
        np.concatenate((size[symbols], size[256 + ns] + nb, far_size[ds] + db))[order],
    )


def symbols_of(pixels: np.ndarray, cache_bits: int, references: bool | list) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Symbols and their kinds, four a token, and counts by kind. Kinds are green, red, blue, alpha, distance; -100 - n stands for n extra bits."""
    width = pixels.shape[1]
    p = packed(pixels)
    found = references_of(p) if references is True else references or []
    single = np.ones(len(p), dtype=bool)
    for at, n, _ in found:
        single[at : at + n] = False
    at = np.flatnonzero(single)
    flat = pixels.reshape(-1, 4)[at]
    symbols, kinds = flat[:, [1, 0, 2, 3]].astype(np.int64), np.tile(np.array([0, 1, 2, 3]), (len(at), 1))
    if cache_bits:
        h, hit = cached(p, cache_bits)
        hit = hit[at]
        symbols[hit] = 0
        symbols[hit, 0] = 280 + h[at][hit]
        kinds[hit, 1:] = -100
    if found:
        place, n, d = np.array(found, dtype=np.int64).T
        ns, nv, nb = prefix_of(n)
        ds, dv, db = prefix_of(near_codes(d, width))
        order = np.argsort(np.concatenate((at, place)), kind="stable")
        symbols = np.concatenate((symbols, np.stack((256 + ns, nv, ds, dv), 1)))[order]
        kinds = np.concatenate((kinds, np.stack((np.zeros_like(n), -100 - nb, np.full_like(n, 4), -100 - db), 1)))[order]
    sizes = (280 + (1 << cache_bits if cache_bits else 0), 256, 256, 256, 40)
    flat_kinds, flat_symbols = kinds.ravel(), symbols.ravel()
    counts = [np.bincount(flat_symbols[flat_kinds == k], minlength=m) for k, m in enumerate(sizes)]
    return flat_symbols, flat_kinds, counts


def write_picture(w: Writer, pixels: np.ndarray, outer: bool, cache_bits: int = 0, references: bool | list = False) -> None:
    """Symbols with optional back-references to equal runs and a colour cache."""
    w.put(1 if cache_bits else 0, 1)
    if cache_bits:
        w.put(cache_bits, 4)
    if outer:
        w.put(0, 1)
    symbols, kinds, counts = symbols_of(pixels, cache_bits, references)
    values, sizes = symbols.copy(), np.maximum(-100 - kinds, 0)
    for k, c in enumerate(counts):
        code, n = write_code(w, code_lengths(c))
        here = kinds == k
        values[here], sizes[here] = code[symbols[here]], n[symbols[here]]
    w.put_all(values, sizes)


def _file(body: bytes) -> bytes:
    pad = b"\0" * (len(body) & 1)
    return b"RIFF" + (12 + len(body) + len(pad)).to_bytes(4, "little") + b"WEBPVP8L" + len(body).to_bytes(4, "little") + body + pad


def encode(pixels: np.ndarray, transforms: list[tuple] = (), cache_bits: int = 0, references: bool | list = False) -> bytes:
    """One file. transforms, in order: ("green",), ("predict", size_bits, modes), ("cross", size_bits, elements) or ("palette",)."""
    height, width = pixels.shape[:2]
    w = Writer()
    w.put(0x2F, 8)
    w.put(width - 1, 14)
    w.put(height - 1, 14)
    w.put(int((pixels[:, :, 3] != 255).any()), 1)
    w.put(0, 3)
    pixels = np.ascontiguousarray(pixels)
    for kind, *more in transforms:
        w.put(1, 1)
        if kind == "green":
            w.put(SUBTRACT_GREEN, 2)
            pixels = pixels.copy()
            pixels[:, :, 0] -= pixels[:, :, 1]
            pixels[:, :, 2] -= pixels[:, :, 1]
        elif kind == "palette":
            colours, index = np.unique(packed(pixels), return_inverse=True)
            table = colours.astype("<u4").view(np.uint8).reshape(-1, 4)[:, [2, 1, 0, 3]]
            w.put(PALETTE, 2)
            w.put(len(colours) - 1, 8)
            write_picture(w, np.diff(table, axis=0, prepend=np.zeros((1, 4), np.uint8))[None], False)
            n = packed_bits(len(colours))
            index = np.pad(index.reshape(height, -1), ((0, 0), (0, -pixels.shape[1] % (1 << n)))).reshape(height, -1, 1 << n)
            pixels = np.zeros((*index.shape[:2], 4), dtype=np.uint8)
            pixels[:, :, 1] = (index << (np.arange(1 << n) * (8 >> n))).sum(-1)
            pixels[:, :, 3] = 255
        else:
            size, table = more
            w.put(PREDICTOR if kind == "predict" else CROSS_COLOUR, 2)
            w.put(size - 2, 3)
            tiles = np.zeros((*table.shape[:2], 4), dtype=np.uint8)
            tiles[:, :, 3] = 255
            if kind == "predict":
                tiles[:, :, 1] = table
                pixels = foretold(pixels, table, size)
            else:
                tiles[:, :, :3] = table
                pixels = crossed(pixels, table, size, True)
            write_picture(w, tiles, False)
    w.put(0, 1)
    write_picture(w, pixels, True, cache_bits, references)
    return _file(w.bytes())


#: Modes that the writer tries, and the side of its tiles as a power of two.
TRIED, TILE = (1, 2, 4, 7, 11, 12), 4


def channel_bits(pixels: np.ndarray) -> np.ndarray:
    """Bits of each pixel's channels under the picture's own entropy."""
    out = np.zeros(pixels.shape[:2])
    for k in range(4):
        c = np.bincount(pixels[:, :, k].ravel(), minlength=256)
        out += (np.log2(c.sum()) - np.log2(np.maximum(c, 1)))[pixels[:, :, k]]
    return out


def per_tile(x: np.ndarray) -> np.ndarray:
    """Sums by tile."""
    rows = np.add.reduceat(x, np.arange(0, x.shape[0], 1 << TILE), axis=0)
    return np.add.reduceat(rows, np.arange(0, x.shape[1], 1 << TILE), axis=1)


def choose_modes(pixels: np.ndarray) -> np.ndarray | None:
    """Modes by tile, 0 unless another leaves clearly fewer bits there; None if it does nowhere."""
    plain = per_tile(channel_bits(pixels))
    best, modes = plain * 0.97 - 16, np.zeros(plain.shape, dtype=np.uint8)
    for mode in TRIED:
        bits = per_tile(channel_bits(residuals(pixels, mode)))
        modes[bits < best] = mode
        best = np.minimum(best, bits)
    return modes if modes.any() else None


def choose_elements(pixels: np.ndarray) -> np.ndarray | None:
    """Elements by tile: slopes of blue and red on green where they leave clearly fewer bits; None if they do nowhere."""
    signed = np.ascontiguousarray(pixels).view(np.int8).astype(np.float32)
    red, green, blue = signed[:, :, 0], signed[:, :, 1], signed[:, :, 2]
    square = np.maximum(per_tile(green * green), 1)
    slope = lambda x: np.clip(np.rint(32 * per_tile(x * green) / square), -128, 127).astype(np.int8).view(np.uint8)
    elements = np.stack((np.zeros(square.shape, np.uint8), slope(blue), slope(red)), -1)
    gain = per_tile(channel_bits(pixels)) * 0.97 - 32 - per_tile(channel_bits(crossed(pixels, elements, TILE, True)))
    elements[gain <= 0] = 0
    return elements if elements.any() else None


def choose_cache(pixels: np.ndarray, found: list) -> int:
    """Bits of the colour cache: none unless one pixel in sixteen finds its colour there, else what costs less."""
    p = packed(pixels)
    bits = min(10, max(1, int(np.log2(len(p))) - 1))
    if 16 * int(cached(p, bits)[1].sum()) < len(p):
        return 0
    return min((0, bits), key=lambda b: sum(map(cost, symbols_of(pixels, b, found)[-1])))


def encode_small(pixels: np.ndarray) -> bytes:
    """One file: a palette where colours are few and it is smaller, else predictors and cross-colour where they leave fewer bits; always back-references, and a cache that pays."""
    p = packed(pixels)
    transforms, rest = [], pixels
    if (modes := choose_modes(rest)) is not None:
        transforms.append(("predict", TILE, modes))
        rest = foretold(rest, modes, TILE)
    if (elements := choose_elements(rest)) is not None:
        transforms.append(("cross", TILE, elements))
        rest = crossed(rest, elements, TILE, True)
    found = references_of(packed(rest))
    out = encode(pixels, transforms, choose_cache(rest, found), found)
    if 4 * (colours := len(np.unique(p))) <= len(p) and colours <= 256:
        out = min(out, encode(pixels, [("palette",)], 0, True), key=len)
    return out


def entropy(counts: np.ndarray) -> float:
    """Bits a value."""
    c = counts[counts > 0]
    return float(np.log2(c.sum()) - c @ np.log2(c) / c.sum())


def encode_grey(grey: np.ndarray) -> bytes:
    """One opaque file of (height, width) samples, green taken from the other channels; other transforms where they promise to pay and do."""
    height, width = grey.shape
    w = Writer()
    for value, n in ((0x2F, 8), (width - 1, 14), (height - 1, 14), (0, 4), (1, 1), (SUBTRACT_GREEN, 2), (0, 1)):
        w.put(value, n)
    flat = grey.ravel()
    write_greens(w, flat, width)
    out = _file(w.bytes())
    counts = np.bincount(flat)
    least, top = 0.9 * entropy(counts), flat[width:] - flat[:-width]
    if np.count_nonzero(counts) <= 16 or entropy(np.bincount(flat[1:] - flat[:-1])) < least or (len(top) and entropy(np.bincount(top)) < least):
        pixels = np.full((height, width, 4), 255, dtype=np.uint8)
        pixels[:, :, :3] = grey[:, :, None]
        out = min(out, encode_small(pixels), key=len)
    return out
