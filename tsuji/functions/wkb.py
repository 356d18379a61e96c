"""WKB at the edges (G12): Arrow-batched encode/decode of lines and multipolygons.

Only the interchange boundary uses Python; everything inside the engine works on the native
array forms. 2D WKB as written by the usual geometry libraries: byte order (1 byte), type (uint32), counts
(uint32), then x/y doubles. Written little-endian; both byte orders are read. Columns of little-endian
lines, the common case, are decoded with numpy at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from .geom import LINE, MULTIPOLYGON

_HEADER = 9
_LINESTRING, _POLYGON, _MULTIPOLYGON = 2, 3, 6
_POINTS = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))


def _encode(lines: pa.Array) -> pa.Array:
    """list<struct<x, y>> -> binary WKB (null stays null)."""
    if isinstance(lines, pa.ChunkedArray):
        lines = lines.combine_chunks()
    n = len(lines)
    if n == 0:
        return pa.array([], pa.binary())
    offsets = lines.offsets.to_numpy(zero_copy_only=False).astype(np.int64)   # into lines.values
    pts = lines.values
    xy = np.empty(2 * len(pts), dtype="<f8")
    xy[0::2] = pts.field("x").to_numpy(zero_copy_only=False)
    xy[1::2] = pts.field("y").to_numpy(zero_copy_only=False)
    coords = xy.view(np.uint8)
    valid = ~lines.is_null().to_numpy(zero_copy_only=False)
    counts = np.where(valid, np.diff(offsets), 0)
    sizes = np.where(valid, _HEADER + 16 * counts, 0)
    out_off = np.zeros(n + 1, dtype=np.int64)
    np.cumsum(sizes, out=out_off[1:])
    buf = np.zeros(int(out_off[-1]), dtype=np.uint8)
    starts = out_off[:-1][valid]
    hdr = np.empty((len(starts), 2), dtype="<u4")
    hdr[:, 0] = _LINESTRING
    hdr[:, 1] = counts[valid]
    buf[starts] = 1                                         # little-endian marker
    buf[starts[:, None] + np.arange(1, 9)] = hdr.view(np.uint8).reshape(-1, 8)
    lens = counts * 16
    total = int(lens.sum())
    rel = np.arange(total) - np.repeat(np.cumsum(lens) - lens, lens)
    buf[np.repeat(out_off[:-1] + _HEADER, lens) + rel] = coords[np.repeat(offsets[:-1] * 16, lens) + rel]
    validity = pa.array(valid).buffers()[1] if not valid.all() else None
    arr = pa.Array.from_buffers(pa.large_binary(), n, [validity, pa.py_buffer(out_off), pa.py_buffer(buf)])
    return arr.cast(pa.binary())


def _decode(wkb: pa.Array) -> pa.Array:
    """binary WKB (2D LineString) -> list<struct<x, y>>."""
    if isinstance(wkb, pa.ChunkedArray):
        wkb = wkb.combine_chunks()
    n = len(wkb)
    if n == 0:
        return pa.array([], _POINTS)
    wkb = wkb.cast(pa.large_binary())
    off = np.frombuffer(wkb.buffers()[1], dtype=np.int64)[wkb.offset: wkb.offset + n + 1]
    data = np.frombuffer(wkb.buffers()[2], dtype=np.uint8) if wkb.buffers()[2] is not None else np.zeros(0, np.uint8)
    valid = ~wkb.is_null().to_numpy(zero_copy_only=False)
    starts = off[:-1]
    if valid.any():
        order = data[starts[valid]]
        if (order != 1).any():
            return pa.array([None if b is None else _Reader(b).line() for b in wkb.to_pylist()], _POINTS)
        typ = data[starts[valid, None] + np.arange(1, 5)].copy().view("<u4").ravel()
        if (typ != _LINESTRING).any():
            raise ValueError("expected a LineString")
    counts = np.zeros(n, dtype=np.int64)
    if valid.any():
        counts[valid] = data[starts[valid, None] + np.arange(5, 9)].copy().view("<u4").ravel()
    lens = counts * 16
    idx = np.repeat(starts + _HEADER, lens) + (np.arange(int(lens.sum())) - np.repeat(np.cumsum(lens) - lens, lens))
    xy = data[idx].view("<f8") if len(idx) else np.zeros(0, "<f8")
    pts = pa.StructArray.from_arrays([pa.array(xy[0::2]), pa.array(xy[1::2])], names=["x", "y"])
    list_off = np.zeros(n + 1, dtype=np.int32)
    np.cumsum(counts, out=list_off[1:])
    return pa.ListArray.from_arrays(pa.array(list_off), pts, mask=pa.array(~valid))


class _Reader:
    """Walks one WKB value."""

    def __init__(self, data: bytes):
        self.data, self.at = data, 0

    def head(self, *kinds: int) -> int:
        """Type of the geometry that begins here; sets its byte order."""
        self.order = "<" if self.data[self.at] == 1 else ">"
        self.at += 1
        kind = self.count()
        if kind not in kinds:
            raise ValueError(f"unexpected WKB type {kind}")
        return kind

    def count(self) -> int:
        self.at += 4
        return int(np.frombuffer(self.data, f"{self.order}u4", 1, self.at - 4)[0])

    def points(self) -> list[dict]:
        n = self.count()
        xy = np.frombuffer(self.data, f"{self.order}f8", 2 * n, self.at).tolist()
        self.at += 16 * n
        return [{"x": x, "y": y} for x, y in zip(xy[::2], xy[1::2])]

    def line(self) -> list[dict]:
        self.head(_LINESTRING)
        return self.points()

    def multipolygon(self) -> list[list[list[dict]]]:
        """A polygon is a multipolygon of one; the empty polygon is the empty multipolygon."""
        if self.head(_POLYGON, _MULTIPOLYGON) == _POLYGON:
            rings = self.rings()
            return [rings] if rings else []
        out = []
        for _ in range(self.count()):
            self.head(_POLYGON)
            out.append(self.rings())
        return out

    def rings(self) -> list[list[dict]]:
        return [self.points() for _ in range(self.count())]


def _uint(n: int) -> bytes:
    return int(n).to_bytes(4, "little")


def _encode_multipolygons(mpoly: pa.Array) -> pa.Array:
    """list<list<list<struct<x, y>>>> -> binary WKB (null stays null)."""
    if isinstance(mpoly, pa.ChunkedArray):
        mpoly = mpoly.combine_chunks()
    polygon_at, ring_at, point_at = (a.offsets.to_numpy() for a in (mpoly, mpoly.values, mpoly.values.values))
    points = mpoly.values.values.values
    xy = np.empty(2 * len(points), "<f8")
    xy[0::2] = points.field("x").to_numpy(zero_copy_only=False)
    xy[1::2] = points.field("y").to_numpy(zero_copy_only=False)
    out = []
    for k, missing in enumerate(mpoly.is_null().to_pylist()):
        if missing:
            out.append(None)
            continue
        parts = [b"\x01", _uint(_MULTIPOLYGON), _uint(polygon_at[k + 1] - polygon_at[k])]
        for p in range(polygon_at[k], polygon_at[k + 1]):
            parts += [b"\x01", _uint(_POLYGON), _uint(ring_at[p + 1] - ring_at[p])]
            for r in range(ring_at[p], ring_at[p + 1]):
                parts += [_uint(point_at[r + 1] - point_at[r]), xy[2 * point_at[r]:2 * point_at[r + 1]].tobytes()]
        out.append(b"".join(parts))
    return pa.array(out, pa.binary())


@arrow_udf(T.BinaryType())
def multipolygon_to_wkb(mpoly: pa.Array) -> pa.Array:
    return _encode_multipolygons(mpoly)


@arrow_udf(MULTIPOLYGON)
def multipolygon_from_wkb(wkb: pa.Array) -> pa.Array:
    """Polygons and multipolygons of either byte order, in the native form."""
    return pa.array([None if b is None else _Reader(b).multipolygon() for b in wkb.to_pylist()], pa.list_(pa.list_(_POINTS)))


@arrow_udf(T.BinaryType())
def to_wkb(lines: pa.Array) -> pa.Array:
    return _encode(lines)


@arrow_udf(LINE)
def from_wkb(wkb: pa.Array) -> pa.Array:
    return _decode(wkb)
