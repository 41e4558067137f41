"""Lossless WebP in numpy: an encoder and a decoder of VP8L streams.

The decoder reads prefix codes, back-references and the colour cache, and undoes
the predictor, cross-colour, subtract-green and palette transforms; it follows
the public bit-stream specification.  Streams with one group of codes whose green channel
alone varies are decoded in lockstep, one symbol of every stream at a time: symbols say
where each pixel comes from, and copies are resolved afterwards for all pixels at once.
Other streams take the general entropy decoder.  Transforms are undone on whole batches
of images; the predictor moves over them in slanted wave fronts.

A payload is stored in the green channel of an image 64 pixels wide.  Beyond
``FRAME`` pixels it continues in further frames of the same file (the animated
container), so that every frame has its own prefix codes and can be decoded on
its own.  Every frame takes the whole chain: a palette (small ones pack several samples
into a pixel), predictors, subtract-green and cross-colour, then back-references to what
came before in it and a colour cache.
"""

from __future__ import annotations

import ctypes
import functools
import hashlib
import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from isallobar.llm.bpe import batch_texts
from isallobar.llm.common import slices

WIDTH, FRAME = 64, 4096
LITERALS, LENGTHS, DISTANCES = 256, 24, 40
PREDICTOR, CROSS_COLOUR, SUBTRACT_GREEN, PALETTE = range(4)
HASH_FACTOR = 0x1E35A7BD
#: Least bytes of a back-reference of the writer; the logarithm of its tiles' sides, and of its colour cache.
LEAST_COPY, TILE_BITS, CACHE_BITS = 4, 5, 10
#: Frames whose transforms are undone, or residuals found, at once.
TOGETHER = 256
#: Payload bytes, and stored bytes, that a task encodes or decodes at once.
SLICE, STORED = 2_000_000, 4_000_000
#: Payload bytes whose frames are encoded at once: the arrays of more leave the processor's caches.
ENCODED = 500_000
#: Freed bytes that a worker's allocator keeps, and the most that it does not map on its own.
KEPT, UNMAPPED = 128 << 20, 32 << 20
#: Longest prefix code of the payload writer, and of the format.
WRITER_BITS, MOST_BITS = 10, 15
# The order in which the lengths of the code length code are stored.
CODE_LENGTH_ORDER = (17, 18, 0, 1, 2, 3, 4, 5, 16, 6, 7, 8, 9, 10, 11, 12, 13, 14, 15)


def near_offsets() -> list[tuple[int, int]]:
    """The 120 short distances as (columns left, rows up): nearest first, then narrowest, left before right."""
    found = [(x, y) for y in range(8) for x in range(-7, 9) if (y or x > 0)]
    return sorted(found, key=lambda o: (o[0] ** 2 + o[1] ** 2, abs(o[0]), o[0] < 0))


NEAR = near_offsets()


def reversed_bits(bits: int) -> np.ndarray:
    """Bit reversal of every number of ``bits`` bits."""
    n = np.arange(1 << bits)
    out = np.zeros_like(n)
    for k in range(bits):
        out |= ((n >> k) & 1) << (bits - 1 - k)
    return out


REVERSED = {n: reversed_bits(n) for n in range(1, MOST_BITS + 1)}
_reversed = {n: found.tolist() for n, found in REVERSED.items()}


def code_words(lengths: np.ndarray) -> np.ndarray:
    """Canonical prefix codes of (streams x symbols) lengths, bit-reversed for writing."""
    streams, symbols = lengths.shape
    codes = np.zeros((streams, symbols), np.int64)
    first = np.zeros(streams, np.int64)
    for n in range(1, int(lengths.max(initial=0)) + 1):
        here = lengths == n
        rank = np.cumsum(here, axis=1) - 1
        codes = np.where(here, REVERSED[n][np.minimum(first[:, None] + np.maximum(rank, 0), (1 << n) - 1)], codes)
        first = (first + here.sum(axis=1)) << 1
    return codes


def look_up_tables(lengths: np.ndarray, bits: int, meanings: np.ndarray | None = None) -> np.ndarray:
    """For (streams x symbols) lengths, what each next ``bits`` bits mean: symbol * 16 + length, unless given."""
    streams, symbols = lengths.shape
    order = np.argsort(np.where(lengths, lengths, 99).astype(np.uint8), axis=1, kind="stable")
    size = np.take_along_axis(lengths, order, axis=1).astype(np.int64)
    spread = np.where(size, 1 << np.maximum(bits - size, 0), 0)
    if (spread.sum(axis=1) != 1 << bits).any():
        raise ValueError("a prefix code is not complete")
    found = (order * 16 + size).astype(np.int16 if symbols <= 2048 else np.int32) if meanings is None else np.take_along_axis(meanings, order, axis=1)
    return np.repeat(found.ravel(), spread.ravel()).reshape(streams, 1 << bits).take(REVERSED[bits], axis=1)


def balanced_lengths(counts: np.ndarray, bits: int = WRITER_BITS) -> np.ndarray:
    """Complete prefix code lengths of at most ``bits`` for (streams x symbols) counts.

    Starts from the lengths that the frequencies ask for and shortens codes, the
    largest gain first, until each code is complete.  A lone symbol gets length 0.
    """
    total = counts.sum(axis=1, keepdims=True)
    used = counts > 0
    wanted = np.ceil(np.log2(np.maximum(total, 1) / np.maximum(counts, 1)) - 1e-9)
    lengths = np.where(used, np.clip(wanted, 1, bits), 0).astype(np.int64)
    lengths[used.sum(axis=1) == 1] = 0
    weight = counts / np.maximum(total, 1)
    open_rows = np.flatnonzero(lengths.any(axis=1))
    while len(open_rows):
        part = lengths[open_rows]
        gain = np.where(part > 0, 1 << (bits - part), 0)
        slack = (1 << bits) - gain.sum(axis=1)
        left = slack > 0
        open_rows, part, gain, slack = open_rows[left], part[left], gain[left], slack[left]
        if not len(open_rows):
            break
        score = np.where((gain <= slack[:, None]) & (part > 1), gain + weight[open_rows], -1)
        at = score.argmax(axis=1)
        lengths[open_rows, at] -= 1
    return lengths


def pack_bits(parts: list[tuple[np.ndarray, np.ndarray]], words: int) -> np.ndarray:
    """Write values, least bit first, from the bit on that each has as its place, into ``words`` words of 32 bits.

    Places ascend within a part; no two values share a bit, and those of a part hold 32 bits at most.
    """
    out = np.zeros(words + 1, np.uint64)
    for values, place in parts:
        if not len(place):
            continue
        word = place >> 5
        shifted = values.astype(np.uint64)
        shifted <<= (place & 31).astype(np.uint64)
        begin = np.flatnonzero(np.concatenate([[True], word[1:] != word[:-1]]))
        sums = np.add.reduceat(shifted, begin)
        word = word[begin]
        out[word] += sums & np.uint64(0xFFFFFFFF)
        out[word + 1] += sums >> np.uint64(32)
    return out.astype("<u4")


def length_tokens(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code lengths (streams x symbols) as (value, bits, stream) tokens of a flat 16-symbol code.

    The code length code gives 4 bits to each of 0..12 and 16..18; runs of zeros use 17 and 18.
    """
    streams, symbols = lengths.shape
    flat = lengths.ravel()
    owner = np.repeat(np.arange(streams), symbols)
    run = np.concatenate([[True], (flat[1:] != flat[:-1]) | (flat[1:] > 0) | (owner[1:] != owner[:-1])])
    begin = np.flatnonzero(run)
    size = np.diff(np.append(begin, len(flat)))
    value, whose = flat[begin], owner[begin]
    parts = []
    number = np.arange(len(begin))

    def token(chosen: np.ndarray, symbol: int | np.ndarray, extra: int | np.ndarray, bits: int, turn: int) -> None:
        code = REVERSED[4][np.broadcast_to(symbol, len(chosen))]
        parts.append((chosen * 32 + turn, code | np.broadcast_to(extra, len(chosen)) << 4, np.full(len(chosen), 4 + bits)))

    token(number[value > 0], value[value > 0], 0, 0, 0)
    zero = value == 0
    whole = np.where(zero, (size - 1) // 138, 0)
    for turn in range(int(whole.max(initial=0))):
        token(number[whole > turn], 15, 127, 7, turn)
    rest = size - 138 * whole
    for low, high, symbol, bits in ((11, 138, 15, 7), (3, 10, 14, 3)):
        some = number[zero & (rest >= low) & (rest <= high)]
        token(some, symbol, rest[some] - low, bits, 30)
    for turn in (1, 2):
        token(number[zero & (rest >= turn) & (rest <= 2)], 0, 0, 0, 29 + turn)
    key, values, sizes = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(key, kind="stable")
    return values[order], sizes[order], whose[key[order] // 32]


def encode_payloads(payloads: list[bytes]) -> list[bytes]:
    """One WebP file for each payload, whose length is a positive multiple of 64."""
    frames: list[bytes] = []
    split: list[int] = []
    for payload in payloads:
        split.append(len(frames))
        frames += [payload[k : k + FRAME] for k in range(0, len(payload), FRAME)]
    streams = [stream for start, end in slices(map(len, frames), ENCODED) for stream in _encode_frames(frames[start:end])]
    out = []
    for k, payload in enumerate(payloads):
        own = streams[split[k] : split[k + 1] if k + 1 < len(split) else None]
        if len(own) == 1:
            out.append(riff(chunk(b"VP8L", own[0])))
            continue
        size = (WIDTH - 1).to_bytes(3, "little") + (len(payload) // WIDTH - 1).to_bytes(3, "little")
        parts = [chunk(b"VP8X", bytes([2, 0, 0, 0]) + size), chunk(b"ANIM", bytes(6))]
        for j, stream in enumerate(own):
            rows = min(FRAME, len(payload) - j * FRAME) // WIDTH
            head = bytes(3) + (j * FRAME // WIDTH // 2).to_bytes(3, "little") + (WIDTH - 1).to_bytes(3, "little") + (rows - 1).to_bytes(3, "little") + bytes(3) + bytes([2])
            parts.append(chunk(b"ANMF", head + chunk(b"VP8L", stream)))
        out.append(riff(b"".join(parts)))
    return out


def chunk(name: bytes, data: bytes) -> bytes:
    return name + struct.pack("<I", len(data)) + data + bytes(len(data) & 1)


def riff(data: bytes) -> bytes:
    return b"RIFF" + struct.pack("<I", len(data) + 4) + b"WEBP" + data


def chunks(data: bytes, at: int = 0) -> Iterator[tuple[bytes, bytes]]:
    """(name, data) of the chunks from ``at`` on."""
    while at + 8 <= len(data):
        size = struct.unpack_from("<I", data, at + 4)[0]
        yield data[at : at + 4], data[at + 8 : at + 8 + size]
        at += 8 + size + (size & 1)


def prefixed(value: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Prefix symbol, extra bits and their value for lengths or distance codes from 1 on."""
    w = value - 1
    high = np.maximum(np.frexp(np.maximum(w, 1).astype(float))[1] - 1, 1)
    extra = np.where(w < 4, 0, high - 1)
    return np.where(w < 4, w, 2 * high + (w >> (high - 1) & 1)), extra, w & ((1 << extra) - 1)


@functools.cache
def cache_slots(alpha: int, red: int, blue: int, bits: int) -> np.ndarray:
    """Colour cache slot of each green, beside constant other channels."""
    pixels = (alpha << 24 | red << 16 | blue) + (np.arange(256, dtype=np.int64) << 8)
    return (pixels * HASH_FACTOR & 0xFFFFFFFF) >> (32 - bits)


def _copies(data: np.ndarray, owner: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place, the distance to the last place with the same next bytes in its frame (0: none), and how far they agree."""
    size = len(data)
    distance = np.zeros(size, np.int32)
    # Frame, next bytes and place within the frame, in one number.
    whole = np.flatnonzero(owner[LEAST_COPY - 1 :] == owner[: size - LEAST_COPY + 1])
    part = owner[whole].astype(np.int64)
    part <<= 8 * LEAST_COPY
    part |= np.ndarray((size - LEAST_COPY + 1,), "<u4", data.astype(np.uint8).tobytes(), strides=(1,))[whole]
    part <<= 12
    part |= whole - starts[owner[whole]]
    order = np.sort(part)
    again = np.flatnonzero(order[1:] >> 12 == order[:-1] >> 12) + 1
    near = order[again]
    distance[starts[near >> 44] + (near & 0xFFF)] = near - order[again - 1]
    run = np.append(np.flatnonzero(np.concatenate([[True], distance[1:] != distance[:-1]])), size).astype(np.int32)
    ends = np.repeat(run[1:], np.diff(run))
    return distance, ends - np.arange(size, dtype=np.int32) + np.int32(LEAST_COPY - 1)


def _tokens(step: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Places where a token begins if each one leads ``step`` places on, for all frames at once."""
    found, at, end = [], starts, ends
    while len(at):
        found.append(at)
        at = at + step[at]
        open_ = at < end
        if np.count_nonzero(open_) < len(at):
            at, end = at[open_], end[open_]
    return np.sort(np.concatenate(found))


class Fields:
    """Values of some bits for some streams, gathered in the order in which each stream holds them."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []

    def put(self, streams: np.ndarray, values: np.ndarray | int, bits: np.ndarray | int) -> None:
        n = len(streams)
        self.parts.append((streams, np.broadcast_to(values, n), np.broadcast_to(bits, n), np.full(n, len(self.parts))))

    def lone(self, streams: np.ndarray, symbols: np.ndarray | int) -> None:
        """A simple code of one symbol below 256."""
        self.put(streams, 1 | 1 << 2 | np.asarray(symbols, np.int64) << 3, 11)

    def two(self, streams: np.ndarray, first: np.ndarray | int, second: np.ndarray | int) -> None:
        """A simple code of two symbols below 256."""
        self.put(streams, 1 | 1 << 1 | 1 << 2 | np.asarray(first, np.int64) << 3 | np.asarray(second, np.int64) << 11, 19)

    def code(self, streams: np.ndarray, lengths: np.ndarray, lone: np.ndarray) -> None:
        """A prefix code for each stream; where all lengths are 0, that of the lone symbol."""
        many = lengths.any(axis=1)
        self.lone(streams[~many], lone[~many])
        own = streams[many]
        used = set(range(13)) | {16, 17, 18}
        stored = max(k for k, s in enumerate(CODE_LENGTH_ORDER) if s in used) + 1
        for v, n in [(0, 1), (stored - 4, 4), *((4 if s in used else 0, 3) for s in CODE_LENGTH_ORDER[:stored]), (0, 1)]:
            self.put(own, v, n)
        if len(own):
            values, bits, stream = length_tokens(lengths[many])
            self.put(own[stream], values, bits)

    def joined(self, count: int, streams: np.ndarray, sizes: np.ndarray, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[bytes]:
        """All streams: the fields put, then tokens of ``sizes`` bits, in the order of their streams.

        A part has some values, the numbers of the tokens that hold them, and their first bit in there.
        """
        stream, value, size, turn = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        order = np.argsort(stream * len(self.parts) + turn, kind="stable")
        stream, value, size = stream[order], value[order], size[order]
        heads, tails = np.bincount(stream, minlength=count), np.bincount(streams, minlength=count)
        ends = [np.concatenate([[0], np.cumsum(x, dtype=np.int64)]) for x in (size, sizes)]
        bits = [np.diff(e[np.concatenate([[0], np.cumsum(n)])]) for e, n in zip(ends, (heads, tails), strict=True)]
        total = bits[0] + bits[1]
        room = (total + 31) // 32 + 1
        base = (np.cumsum(room) - room) * 32
        head = ends[0][:-1] + np.repeat(base - (np.cumsum(bits[0]) - bits[0]), heads)
        place = ends[1][:-1] + np.repeat(base + bits[0] - (np.cumsum(bits[1]) - bits[1]), tails)
        raw = pack_bits([(value, head), *((v, place[token] + at) for v, token, at in parts)], int(room.sum())).tobytes()
        return [raw[b // 8 : b // 8 + (n + 7) // 8] for b, n in zip(base.tolist(), total.tolist(), strict=True)]


def _put_header(fields: Fields, ids: np.ndarray, rows: np.ndarray) -> None:
    for v, n in ((0x2F, 8), (WIDTH - 1, 14), (rows - 1, 14), (0, 1 + 3)):
        fields.put(ids, v, n)


def _put_palette(fields: Fields, ids: np.ndarray, present: np.ndarray) -> None:
    """The palette transform of the values present: steps between greens."""
    owner, green = np.nonzero(present)
    first = np.concatenate([[True], owner[1:] != owner[:-1]])
    step = np.where(first, green, green - np.concatenate([[0], green[:-1]]))
    counts = np.bincount(owner * LITERALS + step, minlength=len(ids) * LITERALS).reshape(-1, LITERALS)
    lengths, codes = _code_of(counts)
    fields.put(ids, 1 | PALETTE << 1, 3)
    fields.put(ids, present.sum(axis=1) - 1, 8)
    fields.put(ids, 0, 1)
    fields.code(ids, np.pad(lengths, ((0, 0), (0, LENGTHS))), counts.argmax(axis=1))
    fields.lone(ids, 0), fields.lone(ids, 0), fields.two(ids, 0, 255), fields.lone(ids, 0)
    # A green, then one bit of alpha: 255 at first, no change after.
    fields.put(ids[owner], codes[owner, step] | first.astype(np.int64) << lengths[owner, step], lengths[owner, step] + 1)


def _put_predictors(fields: Fields, ids: np.ndarray, modes: np.ndarray, rows: np.ndarray) -> None:
    """The predictor transform with (streams x tiles down x tiles across) modes, two in each stream at most."""
    low, high = modes.min(axis=(1, 2)), modes.max(axis=(1, 2))
    fields.put(ids, 1 | PREDICTOR << 1 | (TILE_BITS - 2) << 3, 6)
    fields.put(ids, 0, 1)
    same = low == high
    fields.lone(ids[same], low[same])
    fields.two(ids[~same], low[~same], high[~same])
    # Red, blue, alpha and distances are constant.
    for symbol in (0, 0, 0, 0):
        fields.lone(ids, symbol)
    down = -(-rows >> TILE_BITS)
    for y in range(modes.shape[1]):
        for x in range(modes.shape[2]):
            some = ~same & (y < down)
            fields.put(ids[some], modes[some, y, x] == high[some], 1)


def _put_cross(fields: Fields, ids: np.ndarray) -> None:
    """Subtract-green, and the cross-colour elements (green to red and to blue -1) that take red and blue back to 0."""
    fields.put(ids, 1 | SUBTRACT_GREEN << 1, 3)
    fields.put(ids, 1 | CROSS_COLOUR << 1 | (TILE_BITS - 2) << 3, 6)
    fields.put(ids, 0, 1)
    for symbol in (224, 0, 224, 255, 0):
        fields.lone(ids, symbol)


def _code_of(counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    lengths = balanced_lengths(counts)
    return lengths, code_words(lengths)


def _packed(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, present: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Palette indices of each frame, several to a pixel where they are few, and the logarithm of how many."""
    colours = present.sum(axis=1)
    shift = np.where(colours <= 2, 3, np.where(colours <= 4, 2, np.where(colours <= 16, 1, 0)))
    index = (np.cumsum(present, axis=1) - 1)[np.repeat(np.arange(len(sizes)), sizes), data].astype(np.int32)
    parts = []
    for at, size, bits in zip(starts.tolist(), sizes.tolist(), shift.tolist(), strict=True):
        own = index[at : at + size]
        parts.append((own.reshape(-1, 1 << bits) << (8 >> bits) * np.arange(1 << bits)).sum(axis=1, dtype=np.int32) if bits else own)
    return parts, shift


def _residuals(data: np.ndarray, starts: np.ndarray, rows: np.ndarray, frames: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Modes of the tiles of some frames of one width, and what the predictors leave of their samples (frames x places)."""
    high = FRAME // WIDTH
    side = min(1 << TILE_BITS, width)
    place = np.arange(high * width)
    inside = place < rows[frames][:, None] * width
    grid = np.where(inside, data[np.minimum(starts[frames][:, None] + place, len(data) - 1)], 0).astype(np.int16)
    flat = np.pad(grid, ((0, 0), (width + 1, 1)))
    near = [flat[:, width + 1 - back : width + 1 - back + len(place)][:, :, None] for back in (1, width, width - 1, width + 1)]
    every = np.empty((14, *grid.shape), np.uint8)
    for mode in range(14):
        every[mode] = (grid - guess(mode, *near)[:, :, 0]) & 255
    cost = np.minimum(every, -every)
    cost *= inside
    # Rows first: 32 times 128 at most.
    cost = cost.reshape(14, len(frames), high >> TILE_BITS, 1 << TILE_BITS, width).sum(axis=3, dtype=np.uint16)
    cost = cost.reshape(14, len(frames), high >> TILE_BITS, width // side, side).sum(axis=4, dtype=np.int32)
    best = np.sort(cost.sum(axis=(2, 3)).argsort(axis=0, kind="stable")[:2], axis=0)
    pick = np.take_along_axis(cost, best[:, :, None, None], axis=0).argmin(axis=0)
    modes = np.where(pick == 0, best[0][:, None, None], best[1][:, None, None])
    low = -(-rows[frames] >> TILE_BITS) < 2
    modes[low, 1:] = modes[low, :1]
    wide = modes.repeat(1 << TILE_BITS, axis=1).repeat(side, axis=2).reshape(len(frames), -1)
    left = np.take_along_axis(every, wide[None], axis=0)[0]
    left[:, 1:width] = (grid[:, 1:width] - grid[:, : width - 1]) & 255
    left[:, 0] = grid[:, 0]
    left[:, width::width] = (grid[:, width::width] - grid[:, :-width:width]) & 255
    return modes, left


def _encode_frames(frames: list[bytes]) -> list[bytes]:
    """VP8L streams of green samples, all frames at once."""
    count = len(frames)
    sizes = np.array([len(f) for f in frames], np.int64)
    rows = sizes // WIDTH
    ids = np.arange(count)
    data = np.frombuffer(b"".join(frames), np.uint8).astype(np.int32)
    present = np.bincount(np.repeat(ids, sizes) * LITERALS + data, minlength=count * LITERALS).reshape(count, LITERALS) > 0
    fields = Fields()
    _put_header(fields, ids, rows)
    _put_palette(fields, ids, present)
    parts, shift = _packed(data, np.cumsum(sizes) - sizes, sizes, present)
    data = np.concatenate(parts)
    sizes >>= shift
    ends = np.cumsum(sizes)
    starts = ends - sizes
    owner = np.repeat(np.arange(count, dtype=np.int32), sizes)
    residuals = np.empty_like(data)
    for bits in range(4):
        own = np.flatnonzero(shift == bits)
        if not len(own):
            continue
        found = []
        for some in np.array_split(own, -(-len(own) // TOGETHER)):
            modes, left = _residuals(data, starts, rows, some, WIDTH >> bits)
            found.append(modes)
            inside = np.arange(left.shape[1]) < sizes[some][:, None]
            residuals[(starts[some][:, None] + np.arange(left.shape[1]))[inside]] = left[inside]
        _put_predictors(fields, own, np.concatenate(found), rows[own])
    data = residuals
    _put_cross(fields, ids)
    # No further transform; a colour cache; one group of codes.
    fields.put(ids, 0 | 1 << 1 | CACHE_BITS << 2, 7)

    distance, length = _copies(data, owner, starts)
    copied = distance > 0
    token = _tokens(np.where(copied, length, 1), starts, ends)
    whose, copy = owner[token], copied[token]
    symbol = np.empty(len(token), np.int64)
    symbol[~copy] = data[token[~copy]]
    # The first pixel of a colour is a literal, later ones are slots.
    first = np.empty(count * LITERALS, np.int64)
    first[(owner.astype(np.int64) * LITERALS + data)[::-1]] = np.arange(len(data))[::-1]
    again = np.flatnonzero(~copy)
    key = whose[again].astype(np.int64) * LITERALS + symbol[again]
    symbol[again] += np.where(token[again] > first[key], LITERALS + LENGTHS, 0)
    extra = np.zeros(len(token), np.int64)
    extra_bits = np.zeros(len(token), np.int64)
    name, extra_bits[copy], extra[copy] = prefixed(length[token[copy]])
    symbol[copy] = LITERALS + name
    far, far_bits, far_extra = prefixed(distance[token[copy]] + len(NEAR))

    # Of the cache's slots only those of a colour occur; they stand in the order of their hashes.
    slots = cache_slots(0, 0, 0, CACHE_BITS)
    by_slot = np.argsort(slots)
    column = np.arange(LITERALS + LENGTHS + LITERALS)
    column[LITERALS + LENGTHS + by_slot] = LITERALS + LENGTHS + np.arange(LITERALS)
    symbol = column[symbol]
    counts = np.bincount(whose * len(column) + symbol, minlength=count * len(column)).reshape(count, len(column))
    lengths, codes = _code_of(counts)
    wide = np.zeros((count, LITERALS + LENGTHS + (1 << CACHE_BITS)), np.int64)
    wide[:, : LITERALS + LENGTHS] = lengths[:, : LITERALS + LENGTHS]
    wide[:, LITERALS + LENGTHS + slots[by_slot]] = lengths[:, LITERALS + LENGTHS :]
    fields.code(ids, wide, counts[:, :LITERALS].argmax(axis=1))
    # Red, blue and alpha are foretold or taken back to 0.
    fields.lone(ids, 0), fields.lone(ids, 0), fields.lone(ids, 0)
    far_counts = np.bincount(whose[copy] * DISTANCES + far, minlength=count * DISTANCES).reshape(count, DISTANCES)
    far_lengths, far_codes = _code_of(far_counts)
    fields.code(ids, far_lengths, far_counts.argmax(axis=1))

    flat = whose * len(column) + symbol
    size = lengths.ravel()[flat]
    value = codes.ravel()[flat] | extra << size
    size += extra_bits
    # A copy has a second value, its distance.
    copy = np.flatnonzero(copy)
    flat = whose[copy] * DISTANCES + far
    far_size = far_lengths.ravel()[flat]
    after = size[copy]
    size[copy] += far_size + far_bits
    return fields.joined(count, whose, size, [(value, slice(None), 0), (far_codes.ravel()[flat] | far_extra << far_size, copy, after)])


class Reader:
    """Bits of a stream, least bit first; beyond the end they are zero."""

    def __init__(self, data: bytes, at: int = 0) -> None:
        self.data, self.at = data, at

    def peek(self, bits: int) -> int:
        b = self.at >> 3
        return int.from_bytes(self.data[b : b + (bits + 14) // 8], "little") >> (self.at & 7) & ((1 << bits) - 1)

    def read(self, bits: int) -> int:
        value = self.peek(bits)
        self.at += bits
        return value


def read_lengths(reader: Reader, symbols: int) -> tuple[list[int], int]:
    """Lengths of one prefix code, and its lone symbol or -1."""
    ahead = reader.peek(19)
    if ahead & 1:
        wide = 8 if ahead & 4 else 1
        first = ahead >> 3 & ((1 << wide) - 1)
        if not ahead & 2:
            reader.at += 3 + wide
            return [], first
        second = ahead >> 3 + wide & 255
        reader.at += 11 + wide
        lengths = [0] * max(symbols, first + 1, second + 1)
        lengths[first] = lengths[second] = 1
        return (lengths, -1) if first != second else ([], first)
    reader.at += 1
    own = [0] * 19
    ahead = reader.peek(61)
    stored = (ahead & 15) + 4
    ahead >>= 4
    for symbol in CODE_LENGTH_ORDER[:stored]:
        own[symbol] = ahead & 7
        ahead >>= 3
    reader.at += 4 + 3 * stored
    tokens = symbols
    if reader.read(1):
        tokens = 2 + reader.read(2 + 2 * reader.read(3))
    lone = [s for s, n in enumerate(own) if n]
    # A lone symbol takes no bits.
    table = [lone[0] << 4] * 128 if len(lone) == 1 else _small_table(tuple(own))
    lengths: list[int] = []
    put, last, count = lengths.append, 8, 0
    # Bits ahead in a number that is filled up as it runs out.
    data, at = reader.data, reader.at
    ahead = held = used = 0
    while count < symbols and tokens:
        tokens -= 1
        if held < 14:
            b = at + used
            ahead = int.from_bytes(data[b >> 3 : (b >> 3) + 16], "little") >> (b & 7)
            held = 120
        entry = table[ahead & 127]
        size = entry & 15
        symbol = entry >> 4
        if symbol < 16:
            put(symbol)
            count += 1
            if symbol:
                last = symbol
        else:
            extra = ahead >> size
            if symbol == 16:
                n, value = 3 + (extra & 3), last
                size += 2
            elif symbol == 17:
                n, value = 3 + (extra & 7), 0
                size += 3
            else:
                n, value = 11 + (extra & 127), 0
                size += 7
            lengths += [value] * n
            count += n
        ahead >>= size
        used += size
        held -= size
    reader.at += used
    if len(lengths) > symbols:
        raise ValueError("code lengths run over the alphabet")
    lengths += [0] * (symbols - len(lengths))
    if len(lengths) - lengths.count(0) == 1:
        return [], next(s for s, n in enumerate(lengths) if n)
    return lengths, -1


def read_codes(reader: Reader, sizes: tuple[int, ...]) -> list[tuple[list[int], int]]:
    """``read_lengths`` of one code after the other; most are of a lone symbol."""
    out = []
    for symbols in sizes:
        at = reader.at
        ahead = int.from_bytes(reader.data[at >> 3 : (at >> 3) + 3], "little") >> (at & 7)
        if ahead & 3 == 1:
            wide = 8 if ahead & 4 else 1
            out.append(([], ahead >> 3 & ((1 << wide) - 1)))
            reader.at = at + 3 + wide
        else:
            out.append(read_lengths(reader, symbols))
    return out


_tables: dict[tuple[int, ...], list[int]] = {}


def _small_table(lengths: tuple[int, ...]) -> list[int]:
    if lengths not in _tables:
        if len(_tables) > 1000:
            _tables.clear()
        _tables[lengths] = look_up_tables(np.array([lengths]), 7)[0].tolist()
    return _tables[lengths]


@functools.lru_cache(64)
def _table_of(lengths: tuple[int, ...]) -> list[int]:
    """As ``look_up_tables``, for one code."""
    bits = max(lengths)
    size = 1 << bits
    table = [0] * size
    at = 0
    for n, symbol in sorted((n, s) for s, n in enumerate(lengths) if n):
        if at >= size:
            raise ValueError("a prefix code is not complete")
        table[_reversed[bits][at] :: 1 << n] = [symbol << 4 | n] * (size >> n)
        at += size >> n
    if at != size:
        raise ValueError("a prefix code is not complete")
    return table


class Code:
    """One prefix code for the general decoder: entries (symbol * 16 + bits) for each next bits under the mask."""

    def __init__(self, lengths: list[int], lone: int) -> None:
        self.lone = lone
        self.table = _table_of(tuple(lengths)) if lone < 0 else [lone * 16]
        self.mask = len(self.table) - 1

    def next(self, reader: Reader) -> int:
        entry = self.table[reader.peek(15) & self.mask]
        reader.at += entry & 15
        return entry >> 4


def prefix_value(symbol: int, reader: Reader) -> int:
    """Length or distance code that a prefix symbol and its extra bits stand for."""
    if symbol < 4:
        return symbol + 1
    extra = (symbol - 2) >> 1
    return ((2 + (symbol & 1)) << extra) + reader.read(extra) + 1


def read_pixels(reader: Reader, width: int, height: int, outer: bool) -> list[int]:
    """The pixels of an entropy-coded image; only the outermost one may have groups of codes."""
    cache_bits = reader.read(4) if reader.read(1) else 0
    cache = [0] * (1 << cache_bits) if cache_bits else []
    group_bits, groups_wide, which = 0, 0, None
    count = 1
    if outer and reader.read(1):
        group_bits = reader.read(3) + 2
        groups_wide = -(-width >> group_bits)
        which = [p >> 8 & 0xFFFF for p in read_pixels(reader, groups_wide, -(-height >> group_bits), False)]
        count = max(which) + 1
    sizes = (LITERALS + LENGTHS + len(cache), LITERALS, LITERALS, LITERALS, DISTANCES)
    codes = [read_codes(reader, sizes) for _ in range(count)]
    total = width * height
    green, red, blue, alpha = (lone for _, lone in codes[0][:4])
    if count == 1 and min(green, red, blue, alpha) >= 0 and green < LITERALS:  # one colour, without bits
        return [alpha << 24 | red << 16 | green << 8 | blue] * total
    # Of each group: its codes of greens and distances, its other codes that take bits, and what the rest give.
    groups = []
    for green, *others, far in codes:
        others = list(zip((16, 0, 24), others, strict=True))
        apart = [(code.table, code.mask, shift) for code, shift in ((Code(*c), shift) for shift, c in others if c[1] < 0)]
        groups.append((Code(*green), Code(*far), apart, sum(lone << shift for shift, (_, lone) in others if lone >= 0)))
    green, distance, apart, constant = groups[0]
    out: list[int] = []
    kept = 0

    def keep() -> None:
        nonlocal kept
        for p in out[kept:]:
            cache[(HASH_FACTOR * p & 0xFFFFFFFF) >> (32 - cache_bits)] = p
        kept = len(out)

    data = reader.data
    # Bits ahead in a number, four symbols of a literal at least; a literal takes 15 bits for each at most.
    ahead = held = 0
    while len(out) < total:
        at = len(out)
        if which:
            green, distance, apart, constant = groups[which[(at // width >> group_bits) * groups_wide + (at % width >> group_bits)]]
        if held < 60:
            ahead = int.from_bytes(data[reader.at >> 3 : (reader.at >> 3) + 32], "little") >> (reader.at & 7)
            held = 249
        entry = green.table[ahead & green.mask]
        used, symbol = entry & 15, entry >> 4
        if symbol < LITERALS:
            pixel = symbol << 8 | constant
            for table, mask, shift in apart:
                entry = table[ahead >> used & mask]
                used += entry & 15
                pixel |= entry >> 4 << shift
            out.append(pixel)
        reader.at += used
        ahead >>= used
        held -= used
        if symbol < LITERALS:
            pass
        elif symbol < LITERALS + LENGTHS:
            held = 0
            length = prefix_value(symbol - LITERALS, reader)
            code = prefix_value(distance.next(reader), reader)
            if code > len(NEAR):
                back = code - len(NEAR)
            else:
                x, y = NEAR[code - 1]
                back = max(1, x + y * width)
            if back > at or at + length > total:
                raise ValueError("a back-reference leaves the image")
            for k in range(at - back, at - back + length):
                out.append(out[k])
        else:
            keep()
            out.append(cache[symbol - LITERALS - LENGTHS])
        if cache_bits:
            keep()
        if reader.at > 8 * len(reader.data):
            raise ValueError("the stream ends early")
    return out


def guess(mode: int, left: np.ndarray, top: np.ndarray, right: np.ndarray, corner: np.ndarray) -> np.ndarray:
    """Prediction of pixels (channels last, signed) from their left, upper, upper right and upper left neighbours."""
    pairs = {5: ((left, right), (top, top)), 6: ((left, left), (corner, corner)), 7: ((left, left), (top, top)), 8: ((corner, corner), (top, top)), 9: ((top, top), (right, right)), 10: ((left, corner), (top, right))}
    if mode in pairs:
        (a, b), (c, d) = pairs[mode]
        return ((a + b >> 1) + (c + d >> 1)) >> 1
    if 1 <= mode <= 4:
        return (left, top, right, corner)[mode - 1]
    if mode == 11:
        over, beside = np.abs(top - corner), np.abs(left - corner)
        if left.shape[-1] > 1:
            over, beside = over.sum(axis=-1, keepdims=True), beside.sum(axis=-1, keepdims=True)
        return np.where(over < beside, left, top)
    if mode == 12:
        return np.clip(left + top - corner, 0, 255)
    if mode == 13:
        half = left + top >> 1
        apart = half - corner
        return np.clip(half + (apart + (apart < 0) >> 1), 0, 255)
    return np.broadcast_to(np.array([255, 0, 0, 0], left.dtype)[: left.shape[-1]] if left.shape[-1] == 4 else np.zeros(left.shape[-1], left.dtype), left.shape)


def tiled(tiles: np.ndarray, bits: int, height: int, width: int) -> np.ndarray:
    """Values of tiles (images x down x across ...) at every pixel."""
    return tiles.repeat(1 << bits, axis=1).repeat(1 << bits, axis=2)[:, :height, :width]


def undo_predictor(pixels: np.ndarray, modes: np.ndarray) -> np.ndarray:
    """Add predictions to (images x height x width x channels) residuals, with a mode at every pixel.

    Pixels with equal ``x + 2 y`` need only pixels of smaller sums, so they are done together.
    """
    count, height, width, channels = pixels.shape
    if channels == 4 and not pixels[..., (0, 1, 3)].any():  # only green varies, so the others stay what the first pixel has
        green = undo_predictor(pixels[..., 2:3], modes)
        out = np.zeros_like(pixels)
        out[..., 0], out[..., 2] = 255, green[..., 0]
        return out
    out = pixels.astype(np.int16)
    if channels == 4:
        out[:, 0, 0, 0] += 255
    out[:, 0] = np.cumsum(out[:, 0], axis=1, dtype=np.int64) & 255
    out[:, :, 0] = np.cumsum(out[:, :, 0], axis=1, dtype=np.int64) & 255
    # Pixels of one place lie side by side, so that a front is gathered in long runs.
    flat = np.ascontiguousarray(out.reshape(count, height * width, channels).swapaxes(0, 1))
    which = np.ascontiguousarray(modes.reshape(count, height * width).T) & 15
    kinds = np.flatnonzero(np.bincount(which.ravel(), minlength=16)).tolist()
    for front in range(3, width + 2 * height - 2):
        y = np.arange(max(1, (front - width + 2) // 2), min(height - 1, (front - 1) // 2) + 1)
        if not len(y):
            continue
        at = y * width + front - 2 * y
        # Right of the last column stands the first pixel of the row itself.
        near = [flat[at - back] for back in (1, width, width - 1, width + 1)]
        mode = which[at]
        guessed = np.zeros_like(near[0])
        for kind in kinds:
            here = mode == kind
            if here.any():
                np.copyto(guessed, guess(kind, *near), where=here[:, :, None])
        flat[at] = (flat[at] + guessed) & 255
    return np.ascontiguousarray(flat.astype(np.uint8).swapaxes(0, 1)).reshape(pixels.shape)


def undo_cross(pixels: np.ndarray, elements: np.ndarray) -> np.ndarray:
    """Undo the cross-colour transform with an element at every pixel."""
    _, red_to_blue, green_to_blue, green_to_red = (elements[..., k].view(np.int8).astype(np.int32) for k in range(4))
    out = pixels.copy()
    green = pixels[..., 2].view(np.int8).astype(np.int32) if pixels.flags.c_contiguous else np.ascontiguousarray(pixels[..., 2]).view(np.int8).astype(np.int32)
    red = (pixels[..., 1] + (green_to_red * green >> 5)).astype(np.uint8)
    out[..., 1] = red
    out[..., 3] = (pixels[..., 3] + (green_to_blue * green >> 5) + (red_to_blue * red.view(np.int8).astype(np.int32) >> 5)).astype(np.uint8)
    return out


def undo_palette(pixels: np.ndarray, palettes: np.ndarray, bits: int, width: int) -> np.ndarray:
    """Look up the colours of (images x height x packed width) indices; beyond a palette's end they are clear."""
    index = pixels[..., 2]
    if bits:
        each = 8 >> bits
        x = np.arange(width)
        index = index[:, :, x >> bits] >> (each * (x & ((1 << bits) - 1))).astype(np.uint8) & ((1 << each) - 1)
    colours = np.ascontiguousarray(palettes).view(np.uint32).ravel()
    return colours.take(index + np.arange(0, len(colours), 256, dtype=np.int32)[:, None, None]).view(np.uint8).reshape(*index.shape, 4)


def channels(pixels: list[int]) -> np.ndarray:
    """ARGB numbers as (pixels x 4) bytes."""
    return np.array(pixels, ">u4").view(np.uint8).reshape(-1, 4)


@dataclass
class Opened:
    """A stream whose header and transforms are read: (kind, width before it, bits, values) of each transform."""

    reader: Reader
    width: int
    height: int
    packed: int
    steps: list[tuple[int, int, int, np.ndarray | None]]


def opened(data: bytes) -> Opened:
    """Read the header and the transforms of a VP8L stream."""
    reader = Reader(data)
    if reader.read(8) != 0x2F:
        raise ValueError("not a lossless stream")
    width, height = reader.read(14) + 1, reader.read(14) + 1
    reader.read(1)
    if reader.read(3):
        raise ValueError("unknown version")
    steps: list[tuple[int, int, int, np.ndarray | None]] = []
    wide = width
    while reader.read(1):
        kind = reader.read(2)
        if kind in (PREDICTOR, CROSS_COLOUR):
            bits = reader.read(3) + 2
            across, down = -(-wide >> bits), -(-height >> bits)
            steps.append((kind, wide, bits, channels(read_pixels(reader, across, down, False)).reshape(down, across, 4)))
        elif kind == SUBTRACT_GREEN:
            steps.append((kind, wide, 0, None))
        else:
            size = reader.read(8) + 1
            palette = np.zeros((256, 4), np.uint8)
            palette[:size] = np.cumsum(channels(read_pixels(reader, size, 1, False)), axis=0, dtype=np.int64)
            bits = 3 if size <= 2 else 2 if size <= 4 else 1 if size <= 16 else 0
            steps.append((kind, wide, bits, palette))
            wide = -(-wide >> bits)
    return Opened(reader, width, height, wide, steps)


def undone(pixels: np.ndarray, streams: list[Opened]) -> np.ndarray:
    """Undo the transforms, alike but for their values, of (images x height x width x 4) pixels."""
    count, height = pixels.shape[:2]
    for turn in reversed(range(len(streams[0].steps))):
        kind, wide, bits, _ = streams[0].steps[turn]
        if kind == SUBTRACT_GREEN:
            pixels = pixels.copy()
            pixels[..., 1] += pixels[..., 2]
            pixels[..., 3] += pixels[..., 2]
            continue
        values = [o.steps[turn][3] for o in streams]
        if kind == PALETTE:
            pixels = undo_palette(pixels, np.stack(values), bits, wide)
            continue
        tiles = np.zeros((count, *np.max([v.shape for v in values], axis=0)), np.uint8)
        for k, v in enumerate(values):
            tiles[k, : v.shape[0]] = v
        if kind == PREDICTOR:
            pixels = undo_predictor(pixels, tiled(tiles[..., 2], bits, height, wide))
        else:
            pixels = undo_cross(pixels, tiled(tiles, bits, height, wide))
    return pixels


def read_stream(data: bytes) -> np.ndarray:
    """Pixels (height x width, ARGB) of a VP8L stream, by the general entropy decoder."""
    found = opened(data)
    pixels = channels(read_pixels(found.reader, found.packed, found.height, True)).reshape(1, found.height, found.packed, 4)
    return np.ascontiguousarray(undone(pixels, [found])[0]).view(">u4")[..., 0].astype(np.uint32)


def streams_of(data: bytes) -> list[tuple[int, int, bytes]]:
    """(column, row, stream) of every lossless frame of a WebP file."""
    if data[:4] != b"RIFF" or data[8:12] != b"WEBP":
        raise ValueError("not a WebP file")
    out = []
    for name, body in chunks(data, 12):
        if name == b"VP8L":
            out.append((0, 0, body))
        elif name == b"ANMF":
            x, y = (2 * int.from_bytes(body[k : k + 3], "little") for k in (0, 3))
            out += [(x, y, inner) for kind, inner in chunks(body, 16) if kind == b"VP8L"]
    return out


@dataclass
class Simple:
    """An opened stream that the lockstep decoder takes: codes of greens and distances, the constant channels, the cache."""

    opened: Opened
    green: tuple[list[int], int]
    far: tuple[list[int], int]
    constant: tuple[int, int, int]
    cache_bits: int


def simple(found: Opened) -> Simple | None:
    """Read the codes of a stream with one group whose green alone varies, and whose cache tells all greens apart."""
    reader = found.reader
    cache_bits = reader.read(4) if reader.read(1) else 0
    if reader.read(1):
        return None
    sizes = (LITERALS + LENGTHS + (1 << cache_bits if cache_bits else 0), LITERALS, LITERALS, LITERALS, DISTANCES)
    green, red, blue, alpha, far = read_codes(reader, sizes)
    constant = (alpha[1], red[1], blue[1])
    if min(constant) < 0 or (cache_bits and len(set(cache_slots(*constant, cache_bits).tolist())) < LITERALS):
        return None
    return Simple(found, green, far, constant, cache_bits)


def read_greens(streams: list[bytes]) -> list[np.ndarray]:
    """Green samples of each stream, in row order; streams of green alone in lockstep."""
    out: list[np.ndarray | None] = [None] * len(streams)
    groups: dict[tuple, list[tuple[int, Simple]]] = {}
    for k, data in enumerate(streams):
        found = simple(opened(data))
        if found is None:
            out[k] = (read_stream(data) >> 8 & 255).astype(np.uint8).ravel()
        else:
            groups.setdefault((found.cache_bits, found.constant if found.cache_bits else None), []).append((k, found))
    # Streams without a cache go with those of the largest group that has one.
    plain = groups.pop((0, None), [])
    batches = sorted(groups.values(), key=len)
    batches = [*batches[:-1], [*(batches[-1] if batches else []), *plain]]
    for batch in batches:
        alike: dict[tuple, list[tuple[int, Simple, np.ndarray]]] = {}
        for (k, found), samples in zip(batch, _lockstep([streams[k] for k, _ in batch], [f for _, f in batch]) if batch else [], strict=True):
            if samples is None:
                out[k] = (read_stream(streams[k]) >> 8 & 255).astype(np.uint8).ravel()
                continue
            o = found.opened
            alike.setdefault((o.width, o.packed, tuple(step[:3] for step in o.steps)), []).append((k, found, samples))
        for (_, packed, steps), members in alike.items():
            if not steps:
                for k, _, samples in members:
                    out[k] = samples
                continue
            members.sort(key=lambda m: (m[1].opened.height, [step[3][..., 2].tobytes() for step in m[1].opened.steps if step[0] == PREDICTOR]))
            for start in range(0, len(members), TOGETHER):
                some = members[start : start + TOGETHER]
                height = some[-1][1].opened.height
                pixels = np.zeros((len(some), height, packed, 4), np.uint8)
                for row, (_, found, samples) in enumerate(some):
                    pixels[row, ..., 0], pixels[row, ..., 1], pixels[row, ..., 3] = found.constant
                    pixels[row, : found.opened.height, :, 2] = samples.reshape(-1, packed)
                whole = undone(pixels, [f.opened for _, f, _ in some])
                for row, (k, found, _) in enumerate(some):
                    out[k] = np.ascontiguousarray(whole[row, : found.opened.height, :, 2]).ravel()
    return out


#: What prefix symbols of lengths and distances stand for: the least value, and the extra bits.
EXTRA = np.maximum((np.arange(DISTANCES) - 2) >> 1, 0)
LEAST = np.where(np.arange(DISTANCES) < 4, np.arange(DISTANCES), (2 + (np.arange(DISTANCES) & 1)) << EXTRA) + 1
#: Marks in look-up entries of greens, above 4 bits for the size and 8 for a colour.  An entry of a copy has size 0, so
#: that looking on finds it again; its prefix symbol follows, and its real size from ``COPY_SIZE`` on.
SLOT_MARK, COPY_MARK, COPY_SIZE = 1 << 12, 1 << 13, 9
#: Codes that the lockstep decoder looks up in a round, and the bits of a stream at hand for them.
GROUP, AHEAD = 4, 57


def _entries(codes: list[tuple[list[int], int]], meaning: np.ndarray) -> tuple[np.ndarray, int]:
    """Look-up entries of each code in a row, and the index bits: the meaning of a symbol, and its size where that says."""
    size = len(meaning)
    lengths = np.frombuffer(b"".join(bytes(own).ljust(size, b"\0") for own, _ in codes), np.uint8).reshape(len(codes), size)
    lone = np.array([x for _, x in codes])
    used = np.flatnonzero(lengths.any(axis=0))
    lengths = lengths[:, used]
    bits = max(1, int(lengths.max(initial=0)))
    entries = np.empty((len(codes), 1 << bits), np.int16)
    many = lone < 0
    if many.any():
        named = meaning[used].astype(np.int16)
        entries[many] = look_up_tables(lengths[many], bits, named | lengths[many].astype(np.int16) << np.where(named & COPY_MARK, COPY_SIZE, 0).astype(np.int16))
    entries[~many] = meaning[lone[~many]][:, None]
    return entries.ravel(), bits


def _lockstep(streams: list[bytes], found: list[Simple]) -> list[np.ndarray | None]:
    """Decode streams of green alone, some symbols of each at a time; None where a cache slot is read before it is filled.

    The rounds only find out which codes there are.  A stream stays at a copy until the round ends, when the copy's
    length and distance are read.  What the codes stand for is written afterwards, for all streams at once.
    """
    count = len(streams)
    cached = next((f for f in found if f.cache_bits), None)
    symbols = LITERALS + LENGTHS + (1 << cached.cache_bits if cached else 0)
    meaning = np.arange(symbols) << 4
    meaning[LITERALS : LITERALS + LENGTHS] = COPY_MARK | np.arange(LENGTHS) << 4
    if cached:
        meaning[LITERALS + LENGTHS :] = SLOT_MARK
        meaning[LITERALS + LENGTHS + cache_slots(*cached.constant, cached.cache_bits)] = SLOT_MARK | np.arange(LITERALS) << 4
    greens, green_bits = _entries([f.green for f in found], meaning)
    fars, far_bits = _entries([f.far for f in found], np.arange(DISTANCES) << 4)

    # The eight bytes from every place on, without a copy; beyond 7 bits to skip they hold ``AHEAD``.
    raw = b"".join(s + bytes(12) for s in streams) + bytes(8)
    window = np.ndarray((len(raw) - 7,), "<i8", raw, strides=(1,))
    furthest = len(raw) - 8
    held = np.array([len(s) + 12 for s in streams])
    begin = (np.cumsum(held) - held) * 8
    place = begin + [f.opened.reader.at for f in found]
    wide = np.array([f.opened.packed for f in found])
    sizes = np.array([f.opened.packed * f.opened.height for f in found])
    stop = np.cumsum(sizes)
    first = stop - sizes
    total = int(stop[-1])
    # The codes of each round, in one number; a round gives a pixel at least.
    rounds = np.empty(total, np.int64)
    taken = np.zeros(count, np.int64)
    copies: list[tuple[np.ndarray, ...]] = []
    at, row, last, spot = first.copy(), np.arange(count), place.copy(), first.copy()
    green_mask, far_mask = (1 << green_bits) - 1, (1 << far_bits) - 1
    base, end = row << green_bits, stop
    while len(at):
        codes = np.empty((len(at), GROUP), np.int16)
        entry = np.empty(len(at), np.int16)
        for turn in range(GROUP):
            if turn % (AHEAD // green_bits) == 0:
                ahead = window[np.minimum(place >> 3, furthest)]
                ahead >>= place & 7
            index = ahead & green_mask
            index += base
            greens.take(index, out=entry, mode="clip")
            codes[:, turn] = entry
            bits = entry & 15
            ahead >>= bits
            place += bits
        rounds[spot] = codes.view(np.int64)[:, 0]
        spot += 1
        at += GROUP
        some = np.flatnonzero(entry >= COPY_MARK)
        if len(some):
            at[some] -= np.count_nonzero(codes[some] >= COPY_MARK, axis=1)
            # Beyond the last pixel there is no copy.
            some = some[at[some] < end[some]]
            own = row[some]
            name = entry[some].astype(np.int64)
            here = place[some]
            here += name >> COPY_SIZE & 15
            ahead = window[np.minimum(here >> 3, furthest)]
            ahead >>= here & 7
            name >>= 4
            name &= 31
            extra = EXTRA.take(name)
            length = ahead & ((1 << extra) - 1)
            length += LEAST.take(name)
            ahead >>= extra
            here += extra
            code = fars.take((own << far_bits) + (ahead & far_mask)).astype(np.int64)
            bits = code & 15
            code >>= 4
            extra = EXTRA.take(code)
            far = (ahead >> bits) & ((1 << extra) - 1)
            far += LEAST.take(code)
            here += bits
            here += extra
            place[some] = here
            copies.append((own, spot[some], length, far))
            at[some] += length
        open_ = at < end
        if np.count_nonzero(open_) < len(at):
            done = ~open_
            last[row[done]] = place[done]
            taken[row[done]] = spot[done] - first[row[done]]
            at, place, row, base, end, spot = (x[open_] for x in (at, place, row, base, end, spot))

    before = np.cumsum(taken) - taken
    codes = rounds[np.arange(int(taken.sum())) + np.repeat(first - before, taken)].view(np.int16)
    owner = np.repeat(np.arange(count, dtype=np.int32), taken * GROUP)
    own, spot, length, far = (np.concatenate(x) if copies else np.zeros(0, np.int64) for x in (zip(*copies, strict=True) if copies else [()] * 4))
    # A copy is the last code of its round.
    copy = (before[own] + spot - first[own]) * GROUP - 1
    step = (codes < COPY_MARK).astype(np.int32)
    literal = step.astype(bool)
    step[copy] = length
    ends = np.cumsum(step, dtype=np.int32)
    ends -= step
    starts = ends[before * GROUP]
    ends += np.repeat((first - starts).astype(np.int32), taken * GROUP)
    over = ends >= np.repeat(stop.astype(np.int32), taken * GROUP)
    spare = np.flatnonzero(over & literal)
    if (last - np.bincount(owner[spare], weights=codes[spare] & 15, minlength=count) > begin + (held - 12) * 8).any():
        raise ValueError("a stream ends early")
    literal = np.flatnonzero(literal & ~over)
    codes, owner = codes[literal], owner[literal]
    value = np.zeros(total, np.uint8)
    colour = (codes >> 4).astype(np.uint8)
    value[ends[literal]] = colour
    if len(copy):
        close = shifts_of(far, wide[own])
        spot = ends[copy].astype(np.int64)
        if (spot - close < first[own]).any() or (spot + length > stop[own]).any():
            raise ValueError("a back-reference leaves the image")
        _copy(value, spot, length, close)
    early = set()
    slot = codes & SLOT_MARK != 0
    if slot.any():
        # The first pixel of a colour is never copied.
        key = owner * LITERALS + colour
        seen = np.empty(count * LITERALS, np.int32)
        number = np.arange(len(key), dtype=np.int32)
        seen[key[::-1]] = number[::-1]
        early = set(owner[slot & (seen[key] == number)].tolist())
    return [None if k in early else value[a:b] for k, (a, b) in enumerate(zip(first.tolist(), stop.tolist(), strict=True))]


def shifts_of(far: np.ndarray, wide: np.ndarray) -> np.ndarray:
    """Pixels back that distance codes stand for, in images ``wide`` pixels wide."""
    close = np.array([(0, 0), *NEAR])[np.minimum(far, len(NEAR))]
    return np.where(far > len(NEAR), far - len(NEAR), np.maximum(1, close[:, 0] + close[:, 1] * wide))


def _copy(value: np.ndarray, spot: np.ndarray, length: np.ndarray, far: np.ndarray) -> None:
    """Make all copies of ``length`` pixels to ``spot`` from ``far`` before; sources may be copies, or run into their own."""
    before = np.cumsum(length) - length
    step = np.arange(int(length.sum())) - np.repeat(before, length)
    to = (np.repeat(spot, length) + step).astype(np.int32)
    if (far < length).any():
        step %= np.repeat(far, length)
    source = (np.repeat(spot - far, length) + step).astype(np.int32)
    where = np.arange(len(value), dtype=np.int32)
    where[to] = source
    moving = to
    while len(moving):
        further = where[source]
        moved = further != source
        moving, source = moving[moved], further[moved]
        where[moving] = source
    value[to] = value[where[to]]


def decode_payloads(files: list[bytes]) -> list[bytes]:
    """Payloads back from their files: the green samples of the frames, in order."""
    parts = [streams_of(f) for f in files]
    greens = iter(read_greens([s for own in parts for _, _, s in own]))
    return [b"".join(next(greens).tobytes() for _ in own) for own in parts]


def features(payload: bytes) -> str:
    """Sum, distinct values and a histogram of sixteen bins of the samples."""
    counts = np.bincount(np.frombuffer(payload, np.uint8), minlength=256)
    bins = counts.reshape(16, 16).sum(axis=1)
    return ",".join(map(str, [int((counts * np.arange(256)).sum()), int((counts > 0).sum()), *bins.tolist()]))


@functools.cache
def keep_memory() -> None:
    """Let the C allocator keep what arrays free, within bounds, as giving it back and asking anew costs page faults."""
    try:
        mallopt = ctypes.CDLL(None).mallopt
    except (OSError, AttributeError):
        return
    # M_TRIM_THRESHOLD and M_MMAP_THRESHOLD.
    mallopt(-1, KEPT), mallopt(-3, UNMAPPED)


def media_table(docs: DataFrame) -> DataFrame:
    """Store every whole text as a lossless WebP image.

    Returns ``doc_id``, ``n_bytes`` (of the UTF-8 text, before padding) and ``media``
    (the file).  Null and empty texts give one row of 64 zero samples.  Repeated
    rows each give a row, other columns are ignored, a null doc_id stays null, an
    empty table gives no rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_memory()
        for keys, texts in batch_texts(batches, SLICE):
            raw = [t.encode() for t in texts]
            yield pa.RecordBatch.from_arrays([keys, pa.array([len(r) for r in raw], pa.int64()), pa.array(encode_payloads([padded(r) for r in raw]), pa.binary())], names=["doc_id", "n_bytes", "media"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id {kind}, n_bytes bigint, media binary")


def padded(raw: bytes) -> bytes:
    """Bytes filled with zeros to a positive multiple of 64."""
    return raw + bytes(-len(raw) % WIDTH or (0 if raw else WIDTH))


def read_media(media: DataFrame) -> DataFrame:
    """Decode stored images and describe the samples read back.

    Returns doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes,
    media_sha256 and feature, a row for each row of ``media``.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keep_memory()
        for batch in batches:
            size = [len(x) for x in batch.column(2).to_pylist()]
            for start, end in slices(size, STORED):
                part = batch.slice(start, end - start)
                files = part.column(2).to_pylist()
                back = decode_payloads(files)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.array([len(p) for p in back], pa.int64()),
                        pa.array([hashlib.sha256(p).hexdigest() for p in back]),
                        pa.array([zlib.crc32(p[-WIDTH:]) for p in back], pa.int64()),
                        pa.array([len(f) for f in files], pa.int64()),
                        pa.array([hashlib.sha256(f).hexdigest() for f in files]),
                        pa.array([features(p) for p in back]),
                    ],
                    names=["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"],
                )

    kind = media.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, n_bytes bigint, payload_bytes bigint, payload_sha256 string, tail_crc32 bigint, media_bytes bigint, media_sha256 string, feature string"
    return media.select("doc_id", "n_bytes", "media").mapInArrow(work, shape)
