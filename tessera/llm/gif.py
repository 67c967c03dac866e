"""Media columns: GIF.

A media column holds whole GIF files as bytes. :func:`decode` reads any GIF87a/89a: LZW code
streams of every minimum code size, interlacing, global and local palettes, transparency and the
disposal rules, and gives timed frames (start and delay) as the composed canvas. :func:`frames`
turns a media column into a table of frames with colour-histogram columns; :func:`store_bytes`
keeps byte payloads losslessly as the 8-bit samples of 24 x 24 frames.

The LZW decoder works on all code streams of a slice at once: the width of a code depends only on
its index since the last clear code, so codes are cut out of the bits in one step; an entry of the
table is a piece of the output that starts where an earlier code was written, so the output is
resolved by pointer jumping in a few rounds.

Cases: a null text or payload counts as empty (one frame of padding); null media give no frames
and null digests; a damaged file raises ``ValueError`` (or gives no frames with
``errors="skip"``); repeated rows and ties give equal rows; an empty table gives an empty table;
extra columns of the input are not read, and only the named ones are carried.
"""

from __future__ import annotations

import hashlib
import struct
import zlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.arrow import map_slices

SIDE = 24
UNIT = SIDE * SIDE
DELAY_CS = 4
#: Pixels of a canvas or frame, at most: a few bytes can claim four thousand million.
PIXELS = 1 << 26
BINS = 8

# ---------------------------------------------------------------- code streams


def _widths(size: int, n: int) -> np.ndarray:
    """Bits of the codes 0..n-1 since a clear code, for a minimum code size."""
    entry = (1 << size) + 2 + np.maximum(np.arange(n) - 1, 0)
    bits = np.maximum(size + 1, np.floor(np.log2(entry)).astype(np.int64) + 1)
    return np.minimum(bits, 12)


_OFFSETS: dict[int, np.ndarray] = {}


def _offsets(size: int, n: int) -> np.ndarray:
    """Bit offset of each code since a clear code; the last is the end."""
    have = _OFFSETS.get(size)
    if have is None or len(have) <= n:
        have = np.concatenate([[0], np.cumsum(_widths(size, max(n, 2048) * 2))]).astype(np.int32)
        _OFFSETS[size] = have
    return have


def lzw_codes(data: bytes, size: int = 8) -> list[int]:
    """The codes of one stream: greedy longest match, a new table when it is full."""
    clear, end = 1 << size, (1 << size) + 1
    out = [clear]
    if not data:
        return [clear, end]
    table: dict[int, int] = {}
    get, put = table.get, out.append
    new = end + 1
    run = data[0]
    for byte in data[1:]:
        key = run << 8 | byte
        code = get(key)
        if code is not None:
            run = code
            continue
        put(run)
        run = byte
        if new < 4096:
            table[key] = new
            new += 1
        else:
            put(clear)
            table.clear()
            new = end + 1
    put(run)
    put(end)
    return out


def lzw_rows(pixels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The code streams of many short rows of 8-bit samples, in lockstep: codes and their number by row.

    Every row has an open-addressing table of its own; step ``t`` looks up sample ``t`` of all rows.
    A row is too short to fill the table of 4096 entries.
    """
    n, width = pixels.shape
    if not 1 <= width <= 4096 - 258:
        raise ValueError("rows of 1 to 3838 samples")
    bits = int(width * 3 // 2).bit_length()
    slots = (1 << bits) - 1
    # an entry holds its key (a code of 12 bits and a sample) above the new code's number
    table = np.full(n << bits, -1, np.int64 if width > 1024 - 2 else np.int32)
    room = 12 if width > 1024 - 2 else 10
    mask = (1 << room) - 1
    home = np.arange(n, dtype=np.int32) << bits
    out = np.full((n, width + 2), -1, np.int16)
    out[:, 0] = 256
    columns = np.ascontiguousarray(pixels.T).astype(table.dtype)
    run = columns[0].copy()
    new = np.zeros(n, table.dtype)
    for t in range(1, width):
        byte = columns[t]
        key = run << 8 | byte
        at = ((key * 40503 >> 7) & slots) + home
        found = table[at]
        other = ((found >> room) != key) & (found >= 0)
        if other.any():
            lost = np.flatnonzero(other)
            while len(lost):
                at[lost] = home[lost] + ((at[lost] + 1) & slots)
                again = table[at[lost]]
                found[lost] = again
                lost = lost[((again >> room) != key[lost]) & (again >= 0)]
        miss = np.flatnonzero(found < 0)
        out[miss, t] = run[miss]
        table[at[miss]] = key[miss] << room | new[miss]
        new[miss] += 1
        run = (found & mask) + 258
        run[miss] = byte[miss]
    out[:, width] = run
    out[:, width + 1] = 257
    used = out >= 0
    return out[used].astype(np.int32), used.sum(1)


def lzw_pack(codes: np.ndarray, lengths: np.ndarray, size: int = 8) -> list[bytes]:
    """Pack the codes of many streams into bytes, all at once."""
    clear = 1 << size
    # index of each code since the last clear code of its stream; a clear code itself counts on
    first = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    start = np.zeros(len(codes), np.int32)
    start[first] = first
    after = np.flatnonzero(codes == clear) + 1
    start[after[after < len(codes)]] = after[after < len(codes)]
    index = np.arange(len(codes), dtype=np.int32) - np.maximum.accumulate(start)
    # a code that follows no clear code of its stream yet is at index 0 as well
    table = _offsets(size, int(index.max(initial=0)) + 1)
    width = np.diff(table)[index]
    ends = np.cumsum(width)
    before = np.concatenate([[0], ends[first[1:] - 1]])
    n_bytes = (ends[first + lengths - 1] - before + 7) // 8
    base = np.concatenate([[0], np.cumsum(n_bytes)])
    at = ends - width + np.repeat(base[:-1] * 8 - before, lengths)
    out = np.zeros(int(base[-1]) + 3, np.uint8)
    value = codes.astype(np.int32) << (at & 7).astype(np.int32)
    byte = at >> 3
    for k in range(3):
        piece = (value >> 8 * k & 255).astype(np.uint8)
        if size >= 8:  # every code starts in a byte of its own
            out[byte + k] |= piece
        else:
            np.bitwise_or.at(out, byte + k, piece)
    raw = out.tobytes()
    return [raw[a:b] for a, b in zip(base[:-1].tolist(), base[1:].tolist())]


def lzw_decode(streams: list[bytes], size: int, together: int = 1 << 18) -> list[np.ndarray]:
    """Decode code streams of one minimum code size; one array of indices each.

    About ``together`` bytes of streams are decoded at once, which the processor's caches hold.
    """
    out: list[np.ndarray] = []
    group: list[bytes] = []
    room = together
    for s in streams:
        group.append(s)
        room -= len(s)
        if room <= 0:
            out += _lzw_group(group, size)
            group, room = [], together
    return out + (_lzw_group(group, size) if group else [])


def _lzw_group(streams: list[bytes], size: int) -> list[np.ndarray]:
    clear, end = 1 << size, (1 << size) + 1
    lengths = np.fromiter(map(len, streams), np.int64, len(streams))
    base = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    raw = np.frombuffer(b"".join(streams) + bytes(3), np.uint8)
    word = raw[:-2].astype(np.int32) | raw[1:-1].astype(np.int32) << 8 | raw[2:].astype(np.int32) << 16
    bit, stop = base[:-1] * 8, base[1:] * 8
    live = np.arange(len(streams))
    parts: list[tuple[np.ndarray, np.ndarray]] = []  # stream of each segment's codes, codes
    order = 0
    orders: list[np.ndarray] = []
    while len(live):
        # leave clear codes behind
        while True:
            room = bit[live] + size + 1 <= stop[live]
            live = live[room]
            here = bit[live]
            code = word[here >> 3] >> (here & 7) & ((2 << size) - 1)
            bit[live[code == clear]] += size + 1
            if not (code == clear).any():
                break
        live = live[code != end]
        if not len(live):
            break
        left = stop[live] - bit[live]
        table = _offsets(size, int(left.max()) // (size + 1) + 2)
        count = np.searchsorted(table, left, "right") - 1  # codes that fit
        owner = np.repeat(np.arange(len(live), dtype=np.int32), count)
        head = np.concatenate([[0], np.cumsum(count)]).astype(np.int32)
        index = np.arange(head[-1], dtype=np.int32) - head[owner]
        at = bit[live][owner] + table[index]
        code = word[at >> 3] >> (at & 7) & ((1 << np.diff(table))[index] - 1)
        special = np.flatnonzero((code == clear) | (code == end))
        first = np.full(len(live), -1)
        first[owner[special[::-1]]] = special[::-1]  # the first one of each stays
        cut = np.where(first >= 0, first - head[:-1], count)
        keep = index < cut[owner]
        parts.append((live[owner[keep]], code[keep]))
        orders.append(np.full(int(keep.sum()), order))
        order += 1
        again = (first >= 0) & (code[np.maximum(first, 0)] == clear)
        bit[live[again]] += table[cut[again] + 1]
        live = live[again]
    if not parts:
        return [np.zeros(0, np.uint8) for _ in streams]
    stream = np.concatenate([p[0] for p in parts])
    code = np.concatenate([p[1] for p in parts])
    if order > 1:
        sort = np.lexsort((np.concatenate(orders), stream))
        segment = np.concatenate(orders)[sort]
        stream, code = stream[sort], code[sort]
    else:
        segment = np.zeros(len(code), np.int64)
    n = len(code)
    fresh = np.ones(n, bool)
    fresh[1:] = (stream[1:] != stream[:-1]) | (segment[1:] != segment[:-1])
    own = np.arange(n, dtype=np.int32)
    start = np.maximum.accumulate(np.where(fresh, own, 0))
    literal = code < clear
    parent = np.where(literal, own, start + code - (end + 1)).astype(np.int32)
    if (parent >= own + literal).any():
        raise ValueError("a code before its entry")
    depth = (~literal).astype(np.int32)
    root = parent.copy()
    while True:
        more = depth[root]
        if not more.any():
            break
        depth += more
        root = root[root]
    length = depth + 1
    ends = np.cumsum(length)
    head = code[root].astype(np.uint8)  # first sample of each code's string
    last = np.where(literal, head, head[np.minimum(parent + 1, n - 1)])
    value = np.empty(int(ends[-1]), np.uint8)
    at, ancestor, left = ends - 1, own, depth
    while len(at):
        value[at] = last[ancestor]
        more = np.flatnonzero(left)
        at, ancestor, left = at[more] - 1, parent[ancestor[more]], left[more] - 1
    bounds = np.concatenate([[0], np.cumsum(np.bincount(stream, length, len(streams)).astype(np.int64))])
    return [value[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]


# ---------------------------------------------------------------- files


@dataclass
class Frame:
    """One frame as the file has it, before composition."""

    left: int
    top: int
    width: int
    height: int
    palette: np.ndarray
    interlaced: bool
    code_size: int
    data: bytes
    delay_cs: int = 0
    disposal: int = 0
    transparent: int | None = None
    indices: np.ndarray | None = None


@dataclass
class Animation:
    width: int
    height: int
    frames: list[Frame]
    loops: int | None = None


_GREY = bytes(v for k in range(256) for v in (k, k, k))
_HEAD = b"GIF89a" + struct.pack("<HHBBB", SIDE, SIDE, 0xF7, 0, 0) + _GREY
_CONTROL = b"\x21\xf9\x04" + struct.pack("<BHB", 1 << 2, DELAY_CS, 0) + b"\0" + b"\x2c" + struct.pack("<HHHHB", 0, 0, SIDE, SIDE, 0) + b"\x08"


def _blocks(data: bytes) -> bytes:
    return b"".join(bytes([len(data[k : k + 255])]) + data[k : k + 255] for k in range(0, len(data), 255)) + b"\0"


def encode_payloads(payloads: list[bytes]) -> list[bytes]:
    """GIF files whose frames' samples are the payloads, each a positive multiple of 576 bytes."""
    owners = [len(p) // UNIT for p in payloads]
    packed = lzw_pack(*lzw_rows(np.frombuffer(b"".join(payloads), np.uint8).reshape(-1, UNIT))) if payloads else []
    files, at = [], 0
    for n in owners:
        files.append(_HEAD + b"".join(_CONTROL + _blocks(d) for d in packed[at : at + n]) + b"\x3b")
        at += n
    return files


def _palette(data: bytes, at: int, n: int) -> np.ndarray:
    """Colours (red, green, blue) of ``n`` bytes."""
    if at + n > len(data):
        raise ValueError("a palette that is cut off")
    return np.frombuffer(data, np.uint8, n, at).reshape(-1, 3)


def parse(data: bytes) -> Animation:
    """The blocks of a file; pixel data stay packed. Whatever is wrong with a file is a ValueError."""
    if data[:6] not in (b"GIF87a", b"GIF89a"):
        raise ValueError("not a GIF")
    if len(data) < 13:
        raise ValueError("the file ends too early")
    width, height, flags = struct.unpack_from("<HHB", data, 6)
    if width * height > PIXELS:
        raise ValueError(f"a canvas of more than {PIXELS} pixels")
    at = 13
    shared = None
    if flags & 0x80:
        n = 3 << (flags & 7) + 1
        shared = _palette(data, at, n)
        at += n
    out = Animation(width, height, [])
    delay = disposal = 0
    transparent = None

    def blocks(at: int) -> tuple[bytes, int]:
        parts = []
        while n := data[at]:
            parts.append(data[at + 1 : at + 1 + n])
            at += 1 + n
        return b"".join(parts), at + 1

    try:
        while data[at] != 0x3B:
            kind = data[at]
            if kind == 0x21 and data[at + 1] == 0xF9:
                bits, delay, clear = struct.unpack_from("<BHB", data, at + 3)
                disposal, transparent = bits >> 2 & 7, clear if bits & 1 else None
                at += 8
            elif kind == 0x21:
                body, end = blocks(at + 2)
                if data[at + 1] == 0xFF and body[:11] == b"NETSCAPE2.0" and len(body) >= 14:
                    out.loops = int.from_bytes(body[12:14], "little")
                at = end
            elif kind == 0x2C:
                left, top, w, h, bits = struct.unpack_from("<HHHHB", data, at + 1)
                at += 10
                palette = shared
                if bits & 0x80:
                    n = 3 << (bits & 7) + 1
                    palette = _palette(data, at, n)
                    at += n
                if palette is None:
                    raise ValueError("a frame without a palette")
                if w * h > PIXELS:
                    raise ValueError(f"a frame of more than {PIXELS} pixels")
                size = data[at]
                body, at = blocks(at + 1)
                out.frames.append(Frame(left, top, w, h, palette, bool(bits & 0x40), size, body, delay, disposal, transparent))
                delay = disposal = 0
                transparent = None
            else:
                raise ValueError("an unknown block")
    except (IndexError, struct.error) as e:
        raise ValueError("the file ends too early") from e
    return out


def _rows(height: int) -> np.ndarray:
    """Rows in the order in which an interlaced frame holds them."""
    return np.concatenate([np.arange(a, height, b) for a, b in ((0, 8), (4, 8), (2, 4), (1, 2))])


def unpack(animations: list[Animation]) -> None:
    """Decode the pixel data of all frames, grouped by code size."""
    by: dict[int, list[Frame]] = {}
    for a in animations:
        for f in a.frames:
            if not 1 <= f.code_size <= 8:
                raise ValueError("a code size out of range")
            by.setdefault(f.code_size, []).append(f)
    for size, group in by.items():
        for f, pixels in zip(group, lzw_decode([f.data for f in group], size)):
            need = f.width * f.height
            if len(pixels) < need:
                raise ValueError("a frame with too few pixels")
            pixels = pixels[:need].reshape(f.height, f.width)
            if f.interlaced:
                straight = np.empty_like(pixels)
                straight[_rows(f.height)] = pixels
                pixels = straight
            f.indices = pixels


def compose(a: Animation):
    """Yield each frame's canvas (height, width, 4: red, green, blue, alpha), its start and delay in ms."""
    canvas = np.zeros((a.height, a.width), "<u4")
    start, known = 0, {}
    for f in a.frames:
        before = canvas.copy() if f.disposal == 3 else None
        part = canvas[f.top : f.top + f.height, f.left : f.left + f.width]
        index = f.indices[: part.shape[0], : part.shape[1]]
        colours = known.get(id(f.palette))
        if colours is None:  # packed; an index beyond the palette takes its last colour
            colours = np.full((256, 4), 255, np.uint8)
            colours[:, :3] = f.palette[np.minimum(np.arange(256), len(f.palette) - 1)]
            colours = known[id(f.palette)] = colours.view("<u4").ravel()
        if f.transparent is None:
            part[...] = colours[index]
        else:
            np.copyto(part, colours[index], where=index != f.transparent)
        yield canvas.view(np.uint8).reshape(a.height, a.width, 4), start, f.delay_cs * 10
        start += f.delay_cs * 10
        if f.disposal == 2:
            part[...] = 0
        elif f.disposal == 3:
            canvas = before


def histogram(canvas: np.ndarray, bins: int = BINS) -> np.ndarray:
    """Counts by channel and bin of the solid pixels, red first."""
    pixels = canvas.reshape(-1, 4)
    if not (pixels[:, 3] == 255).all():
        pixels = pixels[pixels[:, 3] > 0]
    shelf = (pixels[:, :3].astype(np.int64) * bins >> 8) + np.arange(3) * bins
    return np.bincount(shelf.ravel(), minlength=3 * bins)


def decode(files: list[bytes]) -> list[Animation]:
    """Parse and unpack files together."""
    animations = [parse(f) for f in files]
    unpack(animations)
    return animations


# ---------------------------------------------------------------- operators


def payload(text: str | None) -> tuple[bytes, int]:
    """UTF-8 bytes padded with 255 to a positive multiple of 576, and their number before."""
    raw = (text or "").encode("utf-8")
    return raw + b"\xff" * ((-len(raw)) % UNIT if raw else UNIT), len(raw)


def store_bytes(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, n_bytes, media): each whole text as the samples of a GIF file."""
    kind = df.schema[key].dataType.simpleString()

    def run(part: pa.RecordBatch) -> dict:
        made = [payload(x) for x in part.column(1).to_pylist()]
        return {key: part.column(0), "n_bytes": [n for _, n in made], "media": encode_payloads([p for p, _ in made])}

    return map_slices(df.select(key, text), run, f"`{key}` {kind}, n_bytes long, media binary", size=2 << 20)


def frames(df: DataFrame, key: str, media: str = "media", errors: str = "raise") -> DataFrame:
    """One row a frame: key, frame, start_ms, delay_ms, width, height, rgba, hist_red, hist_green, hist_blue."""
    kind = df.schema[key].dataType.simpleString()

    def run(part: pa.RecordBatch) -> dict:
        out: dict[str, list] = {k: [] for k in (key, "frame", "start_ms", "delay_ms", "width", "height", "rgba", "hist_red", "hist_green", "hist_blue")}
        for name, data in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
            if data is None:
                continue
            try:
                (a,) = decode([data])
            except ValueError:
                if errors == "skip":
                    continue
                raise
            for k, (canvas, start, delay) in enumerate(compose(a)):
                h = histogram(canvas).reshape(3, BINS).tolist()
                for c, v in zip(out, (name, k, start, delay, a.width, a.height, canvas.tobytes(), *h)):
                    out[c].append(v)
        return out

    ints = "frame int, start_ms long, delay_ms long, width int, height int, rgba binary"
    return map_slices(df.select(key, media), run, f"`{key}` {kind}, {ints}, hist_red array<long>, hist_green array<long>, hist_blue array<long>", size=1 << 20)


def digests(df: DataFrame, key: str, media: str = "media", n_bytes: str = "n_bytes") -> DataFrame:
    """What the stored files hold, by key: the payload read back from the composed frames, and features.

    ``feature`` joins the number of frames, the length in ms and the shares of eight bins of red (of
    brightness, in grey files) over the solid pixels of all frames, in thousandths.
    """
    kind = df.schema[key].dataType.simpleString()

    def run(part: pa.RecordBatch) -> dict:
        files = part.column(2).to_pylist()
        there = [f for f in files if f is not None]
        got = iter(decode(there))
        out: dict[str, list] = {k: [] for k in ("payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature", "n_frames", "duration_ms")}
        for f in files:
            if f is None:
                for column in out.values():
                    column.append(None)
                continue
            shown, end = [], 0
            a = next(got)
            for canvas, start, delay in compose(a):
                shown.append(canvas.tobytes())
                end = start + delay
            pixels = np.frombuffer(b"".join(shown), np.uint8).reshape(-1, 4)
            body = pixels[:, 0].tobytes()
            levels = np.bincount(pixels[:, 0], pixels[:, 3] > 0, 256).astype(np.int64).reshape(BINS, -1).sum(1)
            share = (levels * 1000 // max(1, int(levels.sum()))).tolist()
            feature = f"{len(a.frames)}:{end}:" + ",".join(map(str, share))
            values = (len(body), hashlib.sha256(body).hexdigest(), zlib.crc32(body[-32:]), len(f), hashlib.sha256(f).hexdigest(), feature, len(a.frames), end)
            for column, v in zip(out.values(), values):
                column.append(v)
        return out | {key: part.column(0), "n_bytes": part.column(1)}

    rest = "payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string, n_frames long, duration_ms long"
    return map_slices(df.select(key, n_bytes, media), run, f"`{key}` {kind}, n_bytes long, {rest}", size=2 << 20)
