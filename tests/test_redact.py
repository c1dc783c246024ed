"""Pixels: PNG round trips and the blur against a window mean written out."""

import struct
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from fieldload.functions.pixels import PNG_MAGIC, blur_region, decode, decode_png, encode_png, pixel_rects
from fieldload.plans.redact import apply_regions


def picture(h, w, c=3, seed=0):
    return np.random.default_rng(seed).integers(0, 256, (h, w, c), dtype=np.uint8)


def brute_blur(px, rect, r):
    """Crop with black outside, mean over the window with the crop's edges extended, paste."""
    h, w, c = px.shape
    x0, y0, x1, y1 = rect
    out = px.copy()
    crop = {(x, y): (px[y, x].astype(float) if 0 <= x < w and 0 <= y < h else np.zeros(c)) for x in range(x0, x1) for y in range(y0, y1)}
    for y in range(max(y0, 0), min(y1, h)):
        for x in range(max(x0, 0), min(x1, w)):
            window = [crop[min(max(x + i, x0), x1 - 1), min(max(y + j, y0), y1 - 1)] for i in range(-r, r + 1) for j in range(-r, r + 1)]
            out[y, x] = np.clip(np.rint(np.mean(window, axis=0)), 0, 255)
    return out


@settings(max_examples=60, deadline=None)
@given(st.integers(-6, 10), st.integers(-6, 10), st.integers(0, 16), st.integers(0, 16), st.integers(0, 4))
def test_blur_equals_written_out_mean(x0, y0, dx, dy, r):
    px = picture(7, 9)
    got = px.copy()
    blur_region(got, (x0, y0, x0 + dx, y0 + dy), r)
    assert np.abs(got.astype(int) - brute_blur(px, (x0, y0, x0 + dx, y0 + dy), r).astype(int)).max() <= 1


def test_far_rectangle_needs_no_memory():
    px = picture(6, 8)
    blur_region(px, (-(10**9), -(10**9), 10**9, 10**9))
    assert (px <= 1).all()  # black all around


def test_constant_image_unchanged_and_regions_in_turn():
    px = np.full((6, 8, 3), 91, np.uint8)
    assert (apply_regions(px.copy(), [(0, 0, 8, 6)]) == 91).all()
    px = picture(40, 50)
    out = apply_regions(px.copy(), [(10, 5, 30, 25), (3, 3, 3, 3), (60, 60, 70, 70)])
    mask = np.zeros((40, 50), bool)
    mask[5:25, 10:30] = True
    assert (out[~mask] == px[~mask]).all() and out[mask].std() < px[mask].std()


def test_pixel_rects_round_half_to_even():
    assert pixel_rects([[0.05, 0.15, 0.25, 0.35]], 10, 10) == [(0, 2, 2, 4)]


@pytest.mark.parametrize("c", [1, 3, 4])
def test_png_round_trip(c):
    px = picture(5, 7, c)
    assert (decode(encode_png(px)) == px).all()


def filtered(px, kinds):
    """A PNG whose rows use the given filters."""
    h, w, c = px.shape
    rgb = px[:, :, ::-1].astype(int).reshape(h, w * c)
    rows = []
    for y, kind in enumerate(kinds):
        up = rgb[y - 1] if y else np.zeros(w * c, int)
        left, corner = (np.concatenate([np.zeros(c, int), v[:-c]]) for v in (rgb[y], up))
        p = left + up - corner
        d = np.stack([abs(p - left), abs(p - up), abs(p - corner)])
        guess = [0 * up, left, up, (left + up) // 2, np.choose(d.argmin(0), [left, up, corner])][kind]
        rows.append(bytes([kind]) + ((rgb[y] - guess) % 256).astype(np.uint8).tobytes())

    def chunk(kind, data):
        return struct.pack(">I", len(data)) + kind + data + struct.pack(">I", zlib.crc32(kind + data))

    header = struct.pack(">IIBBBBB", w, h, 8, 2, 0, 0, 0)
    return PNG_MAGIC + chunk(b"IHDR", header) + chunk(b"IDAT", zlib.compress(b"".join(rows))) + chunk(b"IEND", b"")


def test_png_row_filters():
    px = picture(10, 6)
    assert (decode_png(filtered(px, [0, 1, 2, 3, 4, 4, 3, 2, 1, 0])) == px).all()


@pytest.mark.parametrize("data", [b"", b"no image", PNG_MAGIC, encode_png(picture(4, 4))[:-20], encode_png(picture(4, 4)).replace(b"IDAT", b"IDAX")])
def test_damaged_files_are_told(data):
    with pytest.raises(ValueError):
        decode(data)
