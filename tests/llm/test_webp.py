import numpy as np
import pytest

from satellion.llm import media, webp


def picture(rng, height, width, colours=None):
    if colours:
        table = rng.integers(0, 256, (colours, 4), dtype=np.uint8)
        return table[rng.integers(0, colours, (height, width))]
    base = np.add.outer(np.arange(height), np.arange(width))[:, :, None] * np.array([1, 2, 3, 0]) + rng.integers(0, 5, (height, width, 4))
    return base.astype(np.uint8)


@pytest.mark.parametrize("mode", range(14))
def test_every_predictor_round_trips(mode):
    rng = np.random.default_rng(mode)
    p = picture(rng, 11, 13)
    modes = np.full((3, 4), mode, dtype=np.uint8)
    assert (webp.decode(webp.encode(p, [("predict", 2, modes)])) == p).all()


@pytest.mark.parametrize("seed", range(12))
def test_transforms_cache_and_references_round_trip(seed):
    rng = np.random.default_rng(seed)
    height, width = int(rng.integers(1, 30)), int(rng.integers(1, 40))
    p = picture(rng, height, width)
    if seed % 2:
        p[height // 2 :] = p[: height - height // 2]
    size = int(rng.integers(2, 5))
    tiles = (-(-height >> size), -(-width >> size))
    transforms = [("predict", size, rng.integers(0, 14, tiles, dtype=np.uint8)), ("cross", size, rng.integers(0, 256, (*tiles, 3), dtype=np.uint8)), ("green",)]
    order = rng.permutation(3)[: seed % 4]
    stored = webp.encode(p, [transforms[k] for k in order], cache_bits=seed % 5, references=bool(seed % 3))
    assert (webp.decode(stored) == p).all()


@pytest.mark.parametrize("colours", [1, 2, 3, 4, 5, 16, 17, 200])
def test_palettes_round_trip(colours):
    rng = np.random.default_rng(colours)
    p = picture(rng, 9, 21, colours)
    assert (webp.decode(webp.encode(p, [("palette",)], references=True)) == p).all()


def test_fixed_places_of_the_format():
    assert webp.NEAR[:8] == [(0, 1), (1, 0), (1, 1), (-1, 1), (0, 2), (2, 0), (1, 2), (-1, 2)]
    assert len(webp.NEAR) == 120 and webp.NEAR[-1] == (8, 7)


def met(stored):
    """Kinds of transforms and of symbols that reading meets."""
    out, kept = set(), (webp.predicted, webp.crossed, webp.place_of, webp.packed_bits)

    def named(name, f):
        def g(*a, **k):
            out.add(name)
            return f(*a, **k)

        return g

    webp.predicted, webp.crossed, webp.place_of, webp.packed_bits = (named(n, f) for n, f in zip(("predictor", "cross", "reference", "palette"), kept))
    try:
        webp.decode(stored)
    finally:
        webp.predicted, webp.crossed, webp.place_of, webp.packed_bits = kept
    return out


def test_what_the_query_reads_back():
    """The writer's own choice takes each part of the format where it pays, and files of prose are smaller than their payload."""
    rng = np.random.default_rng(6)
    words = ["".join(rng.choice(list("abcdefghijklmnoprstuvw"), rng.integers(2, 9))) for _ in range(300)]
    prose = " ".join(rng.choice(words, 900))
    twice = prose + " " * (-len(prose) % 3) + prose
    few = "".join(rng.choice(list("ab"), 9000, p=[0.9, 0.1]))
    slope = "".join(chr(33 + (k // 192 + k % 192 // 3 + int(rng.integers(0, 2))) % 90) for k in range(12288))
    for text, part in ((prose, None), (twice, "reference"), (few, "palette"), (slope, "predictor")):
        stored, n = media.to_media(text)
        assert media.read_media(stored).tobytes()[:n] == text.encode()
        assert part is None or part in met(stored), part
    stored, n = media.to_media(prose)
    assert len(stored) < 0.7 * n


def test_cross_colour_is_chosen():
    rng = np.random.default_rng(7)
    green = rng.integers(0, 100, (64, 64))
    p = np.stack((green // 2 + rng.integers(0, 2, (64, 64)), green, green + rng.integers(0, 2, (64, 64)), np.full((64, 64), 255)), -1).astype(np.uint8)
    stored = webp.encode_small(p)
    assert (webp.decode(stored) == p).all() and "cross" in met(stored)


@pytest.mark.parametrize("seed", range(8))
def test_grey_pictures_round_trip(seed):
    """Samples with runs and repeats of all kinds; the file's pixels are grey and opaque."""
    rng = np.random.default_rng(seed)
    grey = rng.integers(0, [2, 256, 30, 5][seed % 4], (int(rng.integers(1, 40)), 192), dtype=np.uint8)
    if seed > 3:
        grey[len(grey) // 2 :] = grey[: len(grey) - len(grey) // 2]
        grey[:, 50:90] = 7
    out = webp.decode(webp.encode_grey(grey))
    assert (out[:, :, :3] == grey[:, :, None]).all() and (out[:, :, 3] == 255).all()


@pytest.mark.parametrize("seed", range(6))
def test_lengths_of_codes(seed):
    """Prefix codes are complete, no longer than allowed, and as short as a plain Huffman code where that fits."""
    import heapq

    rng = np.random.default_rng(seed)
    counts = (rng.random(60) ** (1 + 3 * seed) * 1000).astype(np.int64)
    n = [x for x in webp.code_lengths(counts, 15) if x]
    assert sum(2.0**-x for x in n) == 1 and max(n) <= 15
    heap = [int(c) for c in counts if c]
    heapq.heapify(heap)
    least = 0
    while len(heap) > 1:
        x = heapq.heappop(heap) + heapq.heappop(heap)
        least += x
        heapq.heappush(heap, x)
    assert sum(int(c) * x for c, x in zip(counts[counts > 0], n)) == least or max(n) == 15


def test_texts_round_trip():
    for text in (None, "", "a", "x" * 192, "é" * 500, "y" * (3 * 64 * 16384 + 5), "ab" * (3 * 64 * 16384)):
        stored, n = media.to_media(text)
        payload = media.read_media(stored).tobytes()
        raw = (text or "").encode()
        assert n == len(raw) and payload == raw.ljust(max(192, -(-n // 192) * 192))


def test_damaged_files_are_told():
    with pytest.raises(ValueError):
        webp.decode(b"RIFFxxxxWEBPVP8 ")
    with pytest.raises(ValueError):
        webp.decode(webp.encode(picture(np.random.default_rng(0), 8, 8))[:40])


@pytest.mark.parametrize("span", [1, 3, 50, 4096])
def test_greens_are_read_in_spans(span):
    """Spans of any size give the same greens and end, also where other bits follow; too few bits and places before the picture are errors."""
    rng = np.random.default_rng(span)
    words = ["".join(rng.choice(list("abcdefgh"), rng.integers(2, 9))) for _ in range(60)]
    grey = np.frombuffer(" ".join(rng.choice(words, 700)).encode().ljust(20 * 192)[: 20 * 192], dtype=np.uint8)
    for flat in (grey, np.full(192, 7, dtype=np.uint8), np.tile(np.array([1, 2, 3], dtype=np.uint8), 64), rng.integers(0, 256, 1920, dtype=np.uint8)):
        w = webp.Writer()
        webp.write_greens(w, flat, 192)
        w.put(0b1011, 4)
        stored = w.bytes()
        for data in (stored, stored + b"\xff" * 40):
            bits = webp.Bits(data)
            assert bits.read(2) == 0
            green, *_, far = [webp.read_code(bits, n) for n in (280, 256, 256, 256, 40)]
            at = bits.at
            assert webp.read_greens(bits, green, far, 192, len(flat), span) == flat.tobytes() and bits.read(4) == 0b1011
            bits.at = at
            with pytest.raises(ValueError):
                webp.read_greens(webp.Bits(data[: at // 8]), green, far, 192, len(flat), span) if green.only is None else bits.read(8 * len(data))


def test_a_text_costs_few_calls():
    """Python calls a text, which cost nearly all of its time: fewer than a reader and writer that go symbol by symbol make."""
    import cProfile
    import pstats

    rng = np.random.default_rng(4)
    words = ["".join(rng.choice(list("abcdefghijklmnoprstuvw"), rng.integers(2, 9))) for _ in range(300)]
    text = " ".join(rng.choice(words, 450))
    media.read_media(media.to_media(text)[0])
    p = cProfile.Profile()
    p.runcall(lambda: media.read_media(media.to_media(text)[0]))
    assert pstats.Stats(p).total_calls < 3700
