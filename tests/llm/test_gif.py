import hashlib
import random
import struct
import zlib

import numpy as np
import pytest

from tessera.llm import gif as G


def lzw(pixels: bytes, size: int) -> bytes:
    """A plain encoder, one code at a time."""
    clear, end = 1 << size, (1 << size) + 1
    table, width, bits, n = {bytes([k]): k for k in range(clear)}, size + 1, 0, 0
    out, seen = bytearray(), b""

    def put(code):
        nonlocal bits, n
        bits |= code << n
        n += width
        while n >= 8:
            out.append(bits & 255)
            bits >>= 8
            n -= 8

    put(clear)
    for p in pixels:
        new = seen + bytes([p])
        if new in table:
            seen = new
            continue
        put(table[seen])
        if len(table) + 2 < 4096:
            table[new] = len(table) + 2
            if len(table) + 1 >= 1 << width and width < 12:
                width += 1
        else:
            put(clear)
            table, width = {bytes([k]): k for k in range(clear)}, size + 1
        seen = bytes([p])
    if seen:
        put(table[seen])
    put(end)
    if n:
        out.append(bits & 255)
    return bytes(out)


def blocks(data: bytes) -> bytes:
    return b"".join(bytes([len(data[k : k + 255])]) + data[k : k + 255] for k in range(0, len(data), 255)) + b"\0"


def frame(pixels, left, top, w, h, size=3, palette=None, disposal=0, transparent=None, delay=5, interlaced=False):
    control = b"\x21\xf9\x04" + struct.pack("<BHB", disposal << 2 | (transparent is not None), delay, transparent or 0) + b"\0"
    bits = (0x40 if interlaced else 0) | (0x80 | size - 1 if palette else 0)
    return control + b"\x2c" + struct.pack("<HHHHB", left, top, w, h, bits) + (palette or b"") + bytes([size]) + blocks(lzw(bytes(pixels), size))


SHARED = bytes(v for k in range(8) for v in (k * 30, 255 - k * 30, k))
LOCAL = bytes(v for k in range(8) for v in (255 - k, k * 10, 7 * k))


def movie(frames: list[dict], width=9, height=8) -> bytes:
    head = b"GIF89a" + struct.pack("<HHBBB", width, height, 0x80 | 2, 0, 0) + SHARED
    loop = b"\x21\xff\x0bNETSCAPE2.0\x03\x01\x02\x00\x00"
    return head + loop + b"\x21\xfe" + blocks(b"a comment") + b"".join(frame(**f) for f in frames) + b"\x3b"


def brute(frames: list[dict], width=9, height=8):
    """Canvases pixel by pixel."""
    canvas = [[(0, 0, 0, 0)] * width for _ in range(height)]
    for f in frames:
        before = [row[:] for row in canvas]
        order = [y for a, b in ((0, 8), (4, 8), (2, 4), (1, 2)) for y in range(a, f["h"], b)] if f.get("interlaced") else range(f["h"])
        palette = f.get("palette") or SHARED
        at = iter(f["pixels"])
        for y in order:
            for x in range(f["w"]):
                p = next(at)
                if p != f.get("transparent") and f["top"] + y < height and f["left"] + x < width:
                    canvas[f["top"] + y][f["left"] + x] = (*palette[3 * p : 3 * p + 3], 255)
        yield bytes(v for row in canvas for pixel in row for v in pixel)
        if f.get("disposal") == 2:
            for y in range(f["top"], min(height, f["top"] + f["h"])):
                for x in range(f["left"], min(width, f["left"] + f["w"])):
                    canvas[y][x] = (0, 0, 0, 0)
        elif f.get("disposal") == 3:
            canvas = before


def made(seed: int) -> list[dict]:
    rnd = random.Random(seed)
    out = []
    for _ in range(rnd.randrange(1, 6)):
        w, h = rnd.randrange(1, 9), rnd.randrange(1, 9)
        out.append({
            "pixels": [rnd.randrange(8) for _ in range(w * h)], "left": rnd.randrange(4), "top": rnd.randrange(4), "w": w, "h": h, "disposal": rnd.randrange(4),
            "transparent": rnd.choice([None, 3]), "palette": rnd.choice([None, LOCAL]), "interlaced": rnd.random() < 0.5, "delay": rnd.randrange(1, 50),
        })
    return out


def test_palettes_disposal_transparency_and_interlace():
    for seed in range(40):
        frames = made(seed)
        (a,) = G.decode([movie(frames)])
        shown = [(c.tobytes(), start, delay) for c, start, delay in G.compose(a)]
        assert [c for c, _, _ in shown] == list(brute(frames))
        assert [d for _, _, d in shown] == [10 * f["delay"] for f in frames]
        assert [s for _, s, _ in shown] == [10 * sum(f["delay"] for f in frames[:k]) for k in range(len(frames))] and a.loops == 2


def test_frame_table_with_histograms(spark):
    movies = {k: made(k) for k in range(8)}
    df = spark.createDataFrame([(k, bytearray(movie(m)), "x") for k, m in movies.items()] + [(99, None, "x")], "id long, media binary, frame string")
    rows = G.frames(df, "id").collect()
    assert len(rows) == sum(map(len, movies.values()))
    for k, m in movies.items():
        for f, canvas in zip(sorted((r for r in rows if r.id == k), key=lambda r: r.frame), brute(m)):
            assert bytes(f.rgba) == canvas and (f.width, f.height) == (9, 8)
            solid = [canvas[i : i + 4] for i in range(0, len(canvas), 4) if canvas[i + 3]]
            for c, hist in enumerate((f.hist_red, f.hist_green, f.hist_blue)):
                assert hist == [sum(p[c] * G.BINS >> 8 == b for p in solid) for b in range(G.BINS)]


def test_damaged_files(spark):
    good = movie(made(3))
    bad = [b"", b"GIF89a", b"PNG", good[:10], good[:20], good[:40], good[:-1], good[: len(good) // 2], b"GIF89a" + struct.pack("<HHBBB", 65535, 65535, 0, 0, 0) + b"\x3b", good[:37] + b"\x99" + good[38:]]
    for data in bad:
        with pytest.raises(ValueError):
            G.decode([data])
    df = spark.createDataFrame([(k, bytearray(d)) for k, d in enumerate([*bad, good])], "id long, media binary")
    assert {r.id for r in G.frames(df, "id", errors="skip").collect()} == {len(bad)}


def brute_row(doc, text):
    raw = (text or "").encode()
    payload = raw + b"\xff" * ((-len(raw)) % 576 or (576 if not raw else 0))
    return doc, len(raw), len(payload), hashlib.sha256(payload).hexdigest(), zlib.crc32(payload[-32:])


def test_query_against_payloads(spark, sf):
    from tessera.llm.queries import op1_gif

    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").collect()]
    got = op1_gif(spark, sf).collect()
    assert sorted(tuple(r)[:5] for r in got) == sorted(brute_row(*r) for r in rows)


def test_odd_rows(spark):
    rnd = np.random.default_rng(1)
    long = "".join(map(chr, rnd.integers(32, 0x2000, 400_000)))
    rows = [(1, None, "a"), (2, "", "b"), (3, "x" * 576, "c"), (4, "x" * 577, "d"), (4, "x" * 577, "d"), (None, "é🙂", None), (5, long, "e")]
    df = spark.createDataFrame(rows, "doc_id long, text string, media string")
    stored = G.store_bytes(df, "doc_id", "text")
    got = G.digests(stored, "doc_id").collect()
    key = lambda r: (r[0] is not None, r[0] or 0)
    assert sorted((tuple(r[c] for c in ("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32")) for r in got), key=key) == sorted((brute_row(*r[:2]) for r in rows), key=key)
    assert {(r.media_bytes, r.media_sha256) for r in got} == {(len(r.media), hashlib.sha256(r.media).hexdigest()) for r in stored.collect()}
    assert len({r.media_sha256 for r in got if r.doc_id in (1, 2)}) == 1  # equal texts, equal values
    assert G.digests(G.store_bytes(df.limit(0), "doc_id", "text"), "doc_id").count() == 0
