"""8-bit PNG: a minimal writer (grey or RGB) used to materialise image folders for tests and
stand-in inputs, and a reader of plain files (8 bits a channel, no palette, not interlaced) for
:func:`tessera.sources.images.decode_images`; all others are decoded by Spark's image source."""

from __future__ import annotations

import struct
import zlib

import numpy as np


PLAIN_START = b"\x89PNG\r\n\x1a\n\x00\x00\x00\rIHDR"
CHANNELS = {0: 1, 2: 3, 4: 2, 6: 4}  # by colour type: grey, RGB, grey and alpha, RGBA
PLAIN_KINDS = [bytes([8, t, 0, 0, 0]) for t in CHANNELS]  # file bytes 24 to 28: depth, colour type, coding, not interlaced


def _chunk(kind: bytes, data: bytes) -> bytes:
    return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data) & 0xFFFFFFFF)


def encode_png(pixels: np.ndarray) -> bytes:
    """(H, W) grey or (H, W, 3) RGB uint8 array → PNG bytes."""
    a = np.asarray(pixels, dtype=np.uint8)
    if a.ndim == 2:
        color_type, rows = 0, a
    elif a.ndim == 3 and a.shape[2] == 3:
        color_type, rows = 2, a.reshape(a.shape[0], -1)
    else:
        raise ValueError("pixels must be (H, W) or (H, W, 3)")
    h, w = a.shape[:2]
    raw = b"".join(b"\x00" + row.tobytes() for row in rows)
    ihdr = struct.pack(">IIBBBBB", w, h, 8, color_type, 0, 0, 0)
    return b"\x89PNG\r\n\x1a\n" + _chunk(b"IHDR", ihdr) + _chunk(b"IDAT", zlib.compress(raw)) + _chunk(b"IEND", b"")


def read_scanlines(data: bytes) -> np.ndarray | None:
    """A plain PNG's unpacked, still filtered lines, (H, 1 + W·channels) uint8 with the filter kinds in
    front; None if the file is damaged."""
    w, h, _, kind = struct.unpack(">IIBB", data[16:26])
    size, pos, body, unpack = h * (1 + w * CHANNELS[kind]), 33, [], zlib.decompressobj()
    while pos + 8 <= len(data):
        n, name = struct.unpack(">I4s", data[pos:pos + 8])
        if name == b"IDAT":
            body.append(data[pos + 8:pos + 8 + n])
        elif name == b"IEND":
            break
        pos += 12 + n
    try:
        lines = np.frombuffer(unpack.decompress(b"".join(body), max(size, 1)), np.uint8)
    except zlib.error:
        return None
    if size == 0 or w == 0 or len(lines) != size or lines[::1 + w * CHANNELS[kind]].max() > 4:
        return None
    return lines.reshape(h, -1)


def unfilter(lines: np.ndarray, channels: int) -> np.ndarray:
    """(N, H, 1 + W·channels) filtered lines of images of one shape → (N, H, W, channels) pixels.

    A pixel needs its left, upper and upper left one, so the pixels of an anti-diagonal (of all
    images) are restored together: ``H + W`` steps over the last two diagonals."""
    n, h, _ = lines.shape
    kind, x = lines[:, :, 0], lines[:, :, 1:].reshape(n, h, -1, channels)
    if not kind.any():
        return x
    w, out = x.shape[2], np.empty_like(x)
    now, last, before = (np.zeros((n, h + 1, channels), np.int16) for _ in range(3))  # row y at y + 1; zeros outside
    for d in range(h + w - 1):
        lo, hi = max(0, d - w + 1), min(h, d + 1)
        ys = np.arange(lo, hi)
        left, up, corner, k = last[:, lo + 1:hi + 1], last[:, lo:hi], before[:, lo:hi], kind[:, lo:hi, None]
        to_left, to_up, to_corner = np.abs(up - corner), np.abs(left - corner), np.abs(left + up - 2 * corner)
        nearest = np.where((to_left <= to_up) & (to_left <= to_corner), left, np.where(to_up <= to_corner, up, corner))
        guess = np.select([k == 1, k == 2, k == 3, k == 4], [left, up, (left + up) >> 1, nearest], 0)
        now[:, lo + 1:hi + 1] = (x[:, ys, d - ys] + guess) & 255
        out[:, ys, d - ys] = now[:, lo + 1:hi + 1]
        now, last, before = before, now, last
    return out


def filesystem(path: str):
    """(pyarrow filesystem, path in it) of a local path or a filesystem URI (hdfs://, s3://, …)."""
    import pyarrow.fs as pafs

    return pafs.FileSystem.from_uri(path) if "://" in path else (pafs.LocalFileSystem(), path)


def write_bytes(path: str, data: bytes) -> None:
    """Write to a local path or a filesystem URI via pyarrow.fs."""
    fs, p = filesystem(path)
    parent = p.rsplit("/", 1)[0]
    fs.create_dir(parent, recursive=True)
    with fs.open_output_stream(p) as f:
        f.write(data)
