"""Lossless WebP: payload round trips, and streams with every feature for the general decoder."""

import cProfile
import hashlib
import pstats
import random
import tracemalloc
import zlib

import numpy as np
import pytest

from isallobar.llm import webp
from tests.llm.fixtures import documents, empty


def _split(p: int) -> tuple[int, int, int, int]:
    return p >> 24, p >> 16 & 255, p >> 8 & 255, p & 255


def _join(parts: list[int]) -> int:
    a, r, g, b = parts
    return (a & 255) << 24 | (r & 255) << 16 | (g & 255) << 8 | b & 255


def predict(mode: int, left: int, top: int, right: int, corner: int) -> int:
    """Prediction of a pixel from its left, upper, upper right and upper left neighbours."""

    def mean(p: int, q: int) -> int:
        return _join([(x + y) >> 1 for x, y in zip(_split(p), _split(q), strict=True)])

    if mode in (0, 14, 15):
        return 0xFF000000
    if mode < 5:
        return (left, top, right, corner)[mode - 1]
    if mode < 11:
        pairs = {5: (mean(left, right), top), 6: (left, corner), 7: (left, top), 8: (corner, top), 9: (top, right), 10: (mean(left, corner), mean(top, right))}
        return mean(*pairs[mode])
    l, t, c = _split(left), _split(top), _split(corner)
    if mode == 11:
        to_left = sum(abs(y - z) for y, z in zip(t, c, strict=True))
        to_top = sum(abs(x - z) for x, z in zip(l, c, strict=True))
        return left if to_left < to_top else top

    def clamp(x: int) -> int:
        return min(255, max(0, x))

    if mode == 12:
        return _join([clamp(x + y - z) for x, y, z in zip(l, t, c, strict=True)])
    half = [(x + y) >> 1 for x, y in zip(l, t, strict=True)]
    return _join([clamp(x + int((x - z) / 2)) for x, z in zip(half, c, strict=True)])


def predicted(pixels: list[int], at: int, width: int, modes: list[int], bits: int) -> int:
    """Prediction of the pixel at ``at`` from those before it."""
    x, y = at % width, at // width
    if not at:
        return 0xFF000000
    if not y:
        return pixels[at - 1]
    if not x:
        return pixels[at - width]
    mode = modes[(y >> bits) * -(-width >> bits) + (x >> bits)] >> 8 & 15
    # Right of the last column stands the first pixel of the row itself.
    return predict(mode, pixels[at - 1], pixels[at - width], pixels[at - width + 1], pixels[at - width - 1])


def _signed(x: int) -> int:
    return x - 256 if x > 127 else x


def cross(pixel: int, element: int, sign: int) -> int:
    """Undo (1) or apply (-1) the cross-colour transform with one of its elements."""
    a, r, g, b = _split(pixel)
    _, red_to_blue, green_to_blue, green_to_red = _split(element)
    before = r
    r = (r + sign * (_signed(green_to_red) * _signed(g) >> 5)) & 255
    red = r if sign > 0 else before
    b = b + sign * ((_signed(green_to_blue) * _signed(g) >> 5) + (_signed(red_to_blue) * _signed(red) >> 5))
    return _join([a, r, g, b])


class Writer:
    """Bits, least first."""

    def __init__(self):
        self.value = self.size = 0

    def put(self, value, bits):
        self.value |= value << self.size
        self.size += bits

    def bytes(self):
        return self.value.to_bytes((self.size + 7) // 8, "little")


def put_code(out, lengths):
    """A prefix code in its normal form, with a flat code for the lengths."""
    used = [k for k, n in enumerate(lengths) if n]
    if len(used) <= 1:
        s = used[0] if used else 0
        out.put(1, 1), out.put(0, 1), out.put(1, 1), out.put(s, 8)
        return
    out.put(0, 1)
    wanted = {*range(13), 16, 17, 18}
    out.put(15, 4)
    for s in webp.CODE_LENGTH_ORDER:
        out.put(4 if s in wanted else 0, 3)
    out.put(0, 1)
    for v, b, _ in zip(*webp.length_tokens(np.array([lengths])), strict=True):
        out.put(int(v), int(b))


def put_symbol(out, code, lengths, s):
    out.put(int(code[s]), int(lengths[s]))


def prefix_of(value):
    for symbol in range(40):
        if symbol < 4:
            if value == symbol + 1:
                return symbol, 0, 0
            continue
        extra = (symbol - 2) >> 1
        base = ((2 + (symbol & 1)) << extra) + 1
        if base <= value < base + (1 << extra):
            return symbol, value - base, extra
    raise ValueError(value)


def put_pixels(out, pixels, width, cache_bits=0, copies=False, groups=None, outer=True):
    """An entropy-coded image; ``groups`` = (bits, number of each block)."""
    out.put(1 if cache_bits else 0, 1)
    if cache_bits:
        out.put(cache_bits, 4)
    if outer:
        out.put(1 if groups else 0, 1)
        if groups:
            bits, which = groups
            out.put(bits - 2, 3)
            put_pixels(out, [w << 8 for w in which], -(-width >> bits), outer=False)
    tokens, k, cache = [], 0, {}
    slot = lambda p: (webp.HASH_FACTOR * p & 0xFFFFFFFF) >> (32 - cache_bits)
    while k < len(pixels):
        best = (0, 0)
        if copies:
            for back in range(1, min(k, 300) + 1):
                n = 0
                while k + n < len(pixels) and pixels[k + n] == pixels[k + n - back] and n < 4000:
                    n += 1
                best = max(best, (n, -back))
        if best[0] >= 4:
            n, back = best[0], -best[1]
            near = next((j + 1 for j, (x, y) in enumerate(webp.NEAR) if max(1, x + y * width) == back), back + 120)
            tokens.append((k, "copy", n, near))
            for p in pixels[k : k + n]:
                cache_bits and cache.__setitem__(slot(p), p)
            k += n
            continue
        if cache_bits and cache.get(slot(pixels[k])) == pixels[k]:
            tokens.append((k, "cache", slot(pixels[k])))
        else:
            tokens.append((k, "pixel", pixels[k]))
        cache_bits and cache.__setitem__(slot(pixels[k]), pixels[k])
        k += 1
    count = max(groups[1]) + 1 if groups else 1
    at = lambda k: groups[1][(k // width >> groups[0]) * -(-width >> groups[0]) + (k % width >> groups[0])] if groups else 0
    sizes = (280 + (1 << cache_bits if cache_bits else 0), 256, 256, 256, 40)
    counts = [[np.zeros(n, int) for n in sizes] for _ in range(count)]
    plan = []
    for t in tokens:
        g = at(t[0])
        if t[1] == "pixel":
            a, r, gr, b = _split(t[2])
            parts = [(0, gr, 0, 0), (1, r, 0, 0), (2, b, 0, 0), (3, a, 0, 0)]
        elif t[1] == "cache":
            parts = [(0, 280 + t[2], 0, 0)]
        else:
            s, e, eb = prefix_of(t[2])
            d, de, db = prefix_of(t[3])
            parts = [(0, 256 + s, e, eb), (4, d, de, db)]
        for c, s, *_ in parts:
            counts[g][c][s] += 1
        plan.append((g, parts))
    tables = []
    for group in counts:
        own = []
        for n in group:
            lengths = webp.balanced_lengths(n[None, :])[0] if (n > 0).sum() > 1 else (n > 0).astype(int)
            put_code(out, lengths)
            own.append((webp.code_words(lengths[None, :])[0], lengths, (n > 0).sum() > 1))
        tables.append(own)
    for g, parts in plan:
        for c, s, e, eb in parts:
            code, lengths, many = tables[g][c]
            if many:
                put_symbol(out, code, lengths, s)
            out.put(e, eb)


def stream(image, transforms=(), **kw):
    """A VP8L stream of an ARGB image with the named transforms applied in order."""
    height, width = image.shape
    out = Writer()
    out.put(0x2F, 8), out.put(width - 1, 14), out.put(height - 1, 14), out.put(1, 1), out.put(0, 3)
    pixels, wide = [int(p) for p in image.ravel()], width
    for kind in transforms:
        out.put(1, 1), out.put(kind, 2)
        if kind == webp.SUBTRACT_GREEN:
            pixels = [_join([a, r - g, g, b - g]) for a, r, g, b in map(_split, pixels)]
        elif kind == webp.PREDICTOR:
            blocks = -(-wide >> 2) * -(-height >> 2)
            modes = [(k % 14) << 8 for k in range(blocks)]
            out.put(0, 3)
            put_pixels(out, modes, -(-wide >> 2), outer=False)
            pixels = [_join([x - y for x, y in zip(_split(p), _split(predicted(pixels, k, wide, modes, 2)), strict=True)]) for k, p in enumerate(pixels)]
        elif kind == webp.CROSS_COLOUR:
            blocks = -(-wide >> 2) * -(-height >> 2)
            rnd = random.Random(3)
            elements = [rnd.randrange(1 << 24) for _ in range(blocks)]
            out.put(0, 3)
            put_pixels(out, elements, -(-wide >> 2), outer=False)
            pixels = [cross(p, elements[(k // wide >> 2) * -(-wide >> 2) + (k % wide >> 2)], -1) for k, p in enumerate(pixels)]
        else:
            palette = sorted(set(pixels))
            out.put(len(palette) - 1, 8)
            put_pixels(out, [palette[0]] + [_join([x - y for x, y in zip(_split(b), _split(a), strict=True)]) for a, b in zip(palette, palette[1:], strict=False)], len(palette), outer=False)
            bits = 3 if len(palette) <= 2 else 2 if len(palette) <= 4 else 1 if len(palette) <= 16 else 0
            each, rows = 8 >> bits, []
            for y in range(height):
                row = [palette.index(p) for p in pixels[y * wide : (y + 1) * wide]]
                for x in range(0, wide, 1 << bits):
                    rows.append(0xFF000000 | sum(v << (each * j) for j, v in enumerate(row[x : x + (1 << bits)])) << 8)
            pixels, wide = rows, -(-wide >> bits)
    out.put(0, 1)
    put_pixels(out, pixels, wide, **kw)
    return out.bytes()


def image(seed, height=13, width=18, colours=None):
    rnd = np.random.default_rng(seed)
    if colours:
        return rnd.integers(0, 1 << 32, colours, dtype=np.uint64).astype(np.uint32)[rnd.integers(0, colours, (height, width))]
    smooth = np.cumsum(np.cumsum(rnd.integers(-2, 3, (4, height, width)), 1), 2) & 255
    return (smooth[0] << 24 | smooth[1] << 16 | smooth[2] << 8 | smooth[3]).astype(np.uint32)


@pytest.mark.parametrize("transforms", [(), (2,), (0,), (1,), (0, 1, 2), (2, 1, 0), (1, 0)])
@pytest.mark.parametrize("options", [{}, {"cache_bits": 4}, {"copies": True}, {"cache_bits": 7, "copies": True}])
def test_general_decoder_undoes_transforms(transforms, options):
    for seed in range(2):
        picture = image(seed)
        assert (webp.read_stream(stream(picture, transforms, **options)) == picture).all()


@pytest.mark.parametrize("colours", [1, 2, 3, 4, 9, 16, 17, 40])
def test_palettes_of_every_width(colours):
    picture = image(colours, colours=colours)
    assert (webp.read_stream(stream(picture, (3,), cache_bits=3, copies=True)) == picture).all()


def test_groups_of_codes():
    picture = image(5, 16, 16)
    which = [k % 3 for k in range(16)]
    assert (webp.read_stream(stream(picture, (2,), groups=(2, which), cache_bits=2)) == picture).all()


def test_copies_reach_near_and_far():
    picture = np.tile(image(8, 1, 37), (9, 1))
    assert (webp.read_stream(stream(picture, copies=True)) == picture).all()
    assert len(set(webp.NEAR)) == 120 and webp.NEAR[:4] == [(0, 1), (1, 0), (1, 1), (-1, 1)] and webp.NEAR[-1] == (8, 7)


def test_broken_streams_are_refused():
    data = webp.encode_payloads([bytes(range(256)) * 4])[0]
    with pytest.raises(ValueError):
        webp.decode_payloads([data[: len(data) // 2]])
    with pytest.raises(ValueError):
        webp.decode_payloads([b"GIF89a"])
    with pytest.raises(ValueError):
        webp.look_up_tables(np.array([[1, 2, 0]]), 2)


def test_lockstep_equals_general_decoder():
    rnd = random.Random(1)
    payloads = [webp.padded(bytes(rnd.choices(range(1 + k * 7 % 256), k=rnd.randrange(9000)))) for k in range(40)]
    files = webp.encode_payloads(payloads)
    assert webp.decode_payloads(files) == payloads
    for payload, file in zip(payloads, files, strict=True):
        slow = b"".join((webp.read_stream(s) >> 8 & 255).astype(np.uint8).tobytes() for _, _, s in webp.streams_of(file))
        assert slow == payload


def test_payloads_use_every_feature():
    rnd = random.Random(2)
    seen, modes = set(), set()
    for k in range(120):
        payload = webp.padded(" ".join(rnd.choices(["lorem", "ipsum", "dolor", "sit", "Ämet", "12", "x;"], k=1500)).encode() + bytes(rnd.randrange(200)))
        file = webp.encode_payloads([payload])[0]
        for _, _, data in webp.streams_of(file):
            found = webp.opened(data)
            seen |= {step[0] for step in found.steps}
            modes |= {int(m) for step in found.steps if step[0] == webp.PREDICTOR for m in step[3][..., 2].ravel()}
            one = webp.simple(found)
            seen |= {"cache"} if one.cache_bits and any(one.green[0][280:]) else set()
            seen |= {"copies"} if any(one.green[0][256:280]) else set()
    assert seen == {webp.PREDICTOR, webp.CROSS_COLOUR, webp.SUBTRACT_GREEN, webp.PALETTE, "cache", "copies"} and len(modes) > 2


def test_every_frame_takes_every_transform():
    rnd = random.Random(5)
    few = [bytes(rnd.choices(range(1, 1 + n), k=3000)) for n in (1, 2, 3, 4, 9, 15, 16, 17, 60, 255)]
    texts = [b"", b"x", "Ämet ".encode() * 1000, *(" ".join(rnd.choices(["lorem", "ipsum", "dolor", "12"], k=k)).encode() for k in (20, 300, 3000)), *few, *(bytes([64]) * 64 * n for n in (1, 33, 65))]
    payloads = [webp.padded(t) for t in texts]
    files = webp.encode_payloads(payloads)
    assert webp.decode_payloads(files) == payloads
    for payload, file in zip(payloads, files, strict=True):
        streams = [data for _, _, data in webp.streams_of(file)]
        for data in streams:
            found = webp.opened(data)
            assert [step[0] for step in found.steps] == [webp.PALETTE, webp.PREDICTOR, webp.SUBTRACT_GREEN, webp.CROSS_COLOUR]
            assert webp.simple(found).cache_bits == webp.CACHE_BITS
        assert b"".join((webp.read_stream(d) >> 8 & 255).astype(np.uint8).tobytes() for d in streams) == payload
        assert all((webp.read_stream(d) & 0xFFFF00FF == 0xFF000000).all() for d in streams)


@pytest.mark.parametrize("transforms", [(), (0,), (2, 1), (3,)])
def test_lockstep_takes_streams_of_other_writers(transforms):
    greens = [np.random.default_rng(k).integers(0, 40, (5 + k, 30)).astype(np.uint32) for k in range(4)]
    greens.append(np.tile(greens[0], (3, 1)))
    streams = [stream(0xFF000000 | g << 8, transforms, copies=True, cache_bits=b) for g in greens for b in (0, 11)]
    for got, wanted in zip(webp.read_greens(streams), [g for g in greens for _ in (0, 11)], strict=True):
        assert got.reshape(wanted.shape).tolist() == wanted.tolist()


@pytest.mark.parametrize("ahead", [webp.AHEAD, 24, 12])
def test_lockstep_resolves_copies_of_copies(ahead, monkeypatch):
    # With fewer bits ahead, a round of the lockstep decoder looks into the stream more than once, as for codes of 15 bits.
    monkeypatch.setattr(webp, "AHEAD", ahead)
    rnd = np.random.default_rng(4)
    greens = []
    for k in range(12):
        row = rnd.integers(0, 3 + 20 * k, 7 + k)
        for _ in range(8):  # parts of what is there, some running into their own
            at, size = rnd.integers(0, len(row)), rnd.integers(1, 90)
            row = np.concatenate([row, np.resize(row[at:], size), rnd.integers(0, 255, k % 3)])
        greens.append(np.resize(row, (len(row) // 9, 9)).astype(np.uint32))
    streams = [stream(0xFF000000 | g << 8, copies=True, cache_bits=b) for g in greens for b in (0, 11)]
    found = [webp.simple(webp.opened(s)) for s in streams]
    assert all(any(f.green[0][256:280]) for f in found)
    for batch in (streams, streams[:1], streams[::-1]):
        for data, got in zip(batch, webp._lockstep(batch, [webp.simple(webp.opened(s)) for s in batch]), strict=True):
            assert got.tolist() == (webp.read_stream(data) >> 8 & 255).ravel().tolist()


def test_lockstep_refuses_copies_out_of_bounds():
    green = np.tile(np.arange(8, dtype=np.uint32), (6, 1))
    data = stream(0xFF000000 | green << 8, copies=True)
    found = webp.simple(webp.opened(data))
    assert webp._lockstep([data], [found])[0].tolist() == green.ravel().tolist()
    for packed, height in ((8, 5), (3, 6), (7, 6)):  # the last copy leaves the image
        found = webp.simple(webp.opened(data))
        found.opened.packed, found.opened.height = packed, height
        with pytest.raises(ValueError):
            webp._lockstep([data], [found])
    found = webp.simple(webp.opened(data))
    found.opened.height = 60
    with pytest.raises(ValueError):
        webp._lockstep([data], [found])


def _texts(count):
    rnd = random.Random(11)
    words = ["".join(rnd.choices("etaoinshrdlucmfwypvbgkjqxz", range(26, 0, -1), k=rnd.randint(2, 9))) for _ in range(2000)]
    return [webp.padded(" ".join(rnd.choices(words, k=rnd.randint(300, 900))).encode()) for _ in range(count)]


def test_work_of_the_reader_for_a_frame_is_bounded():
    payloads = _texts(300)
    files = webp.encode_payloads(payloads)
    frames = sum(len(webp.streams_of(f)) for f in files)
    profile = cProfile.Profile()
    assert profile.runcall(webp.decode_payloads, files) == payloads
    # Calls of functions, which do not depend on the machine.
    assert pstats.Stats(profile).total_calls < 700 * frames


def test_memory_of_the_writer_does_not_grow_with_its_batch():
    payloads = _texts(500)
    assert sum(map(len, payloads)) > 3 * webp.ENCODED
    peaks = []
    for part in (payloads[: len(payloads) // 4], payloads):
        tracemalloc.start()
        webp.encode_payloads(part)
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    assert peaks[1] < 1.5 * peaks[0]


def test_files_do_not_depend_on_their_batch():
    payloads = [webp.padded(x) for x in (b"", b"abc" * 3000, b"\0" * 70, b"\0\1" * 70, b"\1\3" * 32, "é".encode() * 50)]
    assert webp.encode_payloads(payloads) == [webp.encode_payloads([p])[0] for p in payloads]


def test_query(spark):
    docs = documents(spark)
    rows = webp.read_media(webp.media_table(docs)).collect()
    assert len(rows) == docs.count()
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    for r in rows:
        raw = texts[r.doc_id]
        payload = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        assert (r.n_bytes, r.payload_bytes) == (len(raw), len(payload))
        assert r.payload_sha256 == hashlib.sha256(payload).hexdigest() and r.tail_crc32 == zlib.crc32(payload[-64:])
        file = webp.encode_payloads([payload])[0]
        counts = [payload.count(v) for v in range(256)]
        bins = [sum(counts[16 * b : 16 * b + 16]) for b in range(16)]
        assert r.feature == ",".join(map(str, [sum(payload), sum(c > 0 for c in counts), *bins]))
        assert (r.media_bytes, r.media_sha256) == (len(file), hashlib.sha256(file).hexdigest())
    assert webp.read_media(webp.media_table(empty(spark))).count() == 0
