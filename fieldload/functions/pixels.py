"""Pixels of one image: PNG in and out, box blur.  Helpers of the redaction step.

Arrays are height x width x channels, 8 bits, channels in the order of Spark's
``image`` source (grey; blue, green, red; blue, green, red, alpha).
"""

from __future__ import annotations

import io
import struct
import sys
import zlib

import numpy as np
from pyspark import cloudpickle

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Box blur radius in pixels; the PNG signature and its colour types by channels.
BLUR_RADIUS = 50
PNG_MAGIC = b"\x89PNG\r\n\x1a\n"
COLOUR_TYPES = {1: 0, 3: 2, 4: 6}


def _swapped(px: np.ndarray) -> np.ndarray:
    """Red and blue exchanged."""
    return px[:, :, [2, 1, 0, 3][: px.shape[2]]] if px.shape[2] > 1 else px


def encode_png(px: np.ndarray) -> bytes:
    h, w, c = px.shape

    def chunk(kind: bytes, data: bytes) -> bytes:
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    rows = np.zeros((h, 1 + w * c), np.uint8)
    rows[:, 1:] = _swapped(px).reshape(h, w * c)
    header = struct.pack(">IIBBBBB", w, h, 8, COLOUR_TYPES[c], 0, 0, 0)
    return PNG_MAGIC + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 6)) + chunk(b"IEND", b"")


def _unfiltered(rows: np.ndarray, kinds: np.ndarray, c: int) -> np.ndarray:
    """Undo the row filters; ``rows`` is height x (width * channels)."""
    out = np.zeros_like(rows)
    above = np.zeros(rows.shape[1], np.uint8)
    for y, kind in enumerate(kinds):
        row = rows[y]
        if kind == 1:
            row = np.cumsum(row.reshape(-1, c), axis=0, dtype=np.uint8).reshape(-1)
        elif kind == 2:
            row = row + above
        elif kind in (3, 4):
            row = row.copy()
            left, corner = [0] * c, [0] * c
            for i in range(len(row)):
                a, b, k = left[i % c], int(above[i]), corner[i % c]
                if kind == 3:
                    guess = (a + b) // 2
                else:
                    p = a + b - k
                    guess = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - k), 2, k))[2]
                row[i] = (int(row[i]) + guess) & 255
                left[i % c], corner[i % c] = int(row[i]), b
        elif kind != 0:
            raise ValueError(f"row filter {kind}")
        out[y] = above = row
    return out


def decode_png(data: bytes) -> np.ndarray:
    """Pixels of an 8-bit PNG, grey, RGB or RGBA, not interlaced; anything else raises ``ValueError``."""
    at, body, header = len(PNG_MAGIC), [], None
    while at + 8 <= len(data):
        n, kind = struct.unpack(">I4s", data[at : at + 8])
        part = data[at + 8 : at + 8 + n]
        crc = data[at + 8 + n : at + 12 + n]
        if len(part) < n or crc != struct.pack(">I", zlib.crc32(kind + part)):
            raise ValueError("damaged PNG")
        if kind == b"IHDR":
            header = struct.unpack(">IIBBBBB", part)
        elif kind == b"IDAT":
            body.append(part)
        elif kind == b"IEND":
            break
        at += 12 + n
    channels = {t: c for c, t in COLOUR_TYPES.items()}
    if header is None or header[2] != 8 or header[3] not in channels or header[6]:
        raise ValueError("unsupported PNG")
    w, h, c = header[0], header[1], channels[header[3]]
    try:
        raw = np.frombuffer(zlib.decompress(b"".join(body)), np.uint8)
    except zlib.error as e:
        raise ValueError("damaged PNG") from e
    if len(raw) != h * (1 + w * c):
        raise ValueError("damaged PNG")
    rows = raw.reshape(h, 1 + w * c)
    return np.ascontiguousarray(_swapped(_unfiltered(rows[:, 1:], rows[:, 0], c).reshape(h, w, c)))


def decode(data: bytes) -> np.ndarray:
    """Pixels of a file; formats other than PNG need an imaging library on the workers, ``ValueError`` without one."""
    if data.startswith(PNG_MAGIC):
        return decode_png(data)
    try:
        from PIL import Image
    except ImportError:
        raise ValueError("not a PNG") from None
    try:
        px = np.asarray(Image.open(io.BytesIO(data)).convert("RGB"))
    except OSError as e:
        raise ValueError("unreadable image") from e
    return np.ascontiguousarray(px[:, :, ::-1])


def _window_means(x: np.ndarray, axis: int, r: int, ends: tuple[bool, bool]) -> np.ndarray:
    """Mean of ``2 r + 1`` neighbours along ``axis``; beyond an end the last value goes on, or zeros where ``ends`` says so."""
    pads = []
    for zeros, edge in zip(ends, (0, -1), strict=True):
        pad = np.repeat(np.take(x, [edge], axis=axis), r, axis=axis)
        pads.append(np.zeros_like(pad) if zeros else pad)
    sums = np.cumsum(np.concatenate([pads[0], x, pads[1]], axis=axis), axis=axis)
    sums = np.concatenate([np.zeros_like(np.take(sums, [0], axis=axis)), sums], axis=axis)
    n, width = x.shape[axis], 2 * r + 1
    return (np.take(sums, np.arange(width, n + width), axis=axis) - np.take(sums, np.arange(n), axis=axis)) / width


def blur_region(px: np.ndarray, rect: tuple[int, int, int, int], radius: int = BLUR_RADIUS) -> None:
    """Blur ``rect`` (x0, y0, x1, y1) in place: crop, box mean, paste at its corner.

    The crop is black where it lies outside the image and is extended by its
    own edge values for the mean; only the part inside the image is computed,
    so a rectangle may reach any distance beyond the edges.  An empty one does
    nothing.
    """
    h, w = px.shape[:2]
    x0, y0, x1, y1 = (int(v) for v in rect)
    xa, ya, xb, yb = max(x0, 0), max(y0, 0), min(x1, w), min(y1, h)
    if xb <= xa or yb <= ya:
        return
    part = px[ya:yb, xa:xb].astype(np.float64)
    part = _window_means(part, 1, radius, (x0 < 0, x1 > w))
    part = _window_means(part, 0, radius, (y0 < 0, y1 > h))
    px[ya:yb, xa:xb] = np.clip(np.rint(part), 0, 255).astype(np.uint8)


def pixel_rects(boxes, width: int, height: int) -> list[tuple[int, int, int, int]]:
    """Boxes in fractions of the image as pixels, half to even."""
    scale = np.array([width, height, width, height], np.float64)
    return [tuple(int(v) for v in np.rint(np.array(b, np.float64) * scale)) for b in boxes]
