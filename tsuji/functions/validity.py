"""Polygon validity by plane sweep (G13): which rule a multipolygon breaks, if any.

Vertices are visited from left to right (equal x: upwards). The edges that cross the sweep line are kept
in an ordered list; at a vertex the edges that end there give way to those that begin, and only edges
that become neighbours are tested against each other. So a ring of n vertices costs n log n, whatever its
shape. The edge right below a ring's first vertex also tells which ring the new one lies in, which settles holes
outside their shell and rings inside each other without any point-in-polygon test. Orientation signs are exact:
floating point first, rational numbers where its error bound leaves the sign open.

A multipolygon is valid when every ring is closed, has at least three different points, neither crosses nor
touches itself, the holes of a polygon lie in its shell and not in each other, polygons do not overlap, and
the interior of each polygon is connected. Rings may touch each other in single points.
"""

from __future__ import annotations

import math
from fractions import Fraction
from functools import cmp_to_key

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, SparkSession
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from ..session import ship_package

Point = tuple[float, float]

_ERROR = 3.4e-16                 # relative error bound of the 2 x 2 determinant below


def side(a: Point, b: Point, p: Point) -> float:
    """Sign of p against the line from a to b: positive on its left, zero on it."""
    left = (b[0] - a[0]) * (p[1] - a[1])
    right = (b[1] - a[1]) * (p[0] - a[0])
    d = left - right
    if abs(d) > _ERROR * (abs(left) + abs(right)):
        return d
    ax, ay = Fraction(a[0]), Fraction(a[1])
    exact = (Fraction(b[0]) - ax) * (Fraction(p[1]) - ay) - (Fraction(b[1]) - ay) * (Fraction(p[0]) - ax)
    return (exact > 0) - (exact < 0)


def counter_clockwise(ring: list[Point]) -> bool:
    """Orientation of a simple ring: the turn at its lowest leftmost vertex."""
    n = len(ring)
    k = min(range(n), key=ring.__getitem__)
    return side(ring[k - 1], ring[k], ring[(k + 1) % n]) > 0


def _nested(rings_around: list[int]) -> bool:
    """May the rings whose half-edges meet a point in this circular order pass it without crossing? Each
    ring occurs twice; they do not cross if the order is a proper nesting of pairs."""
    open_rings: list[int] = []
    for r in rings_around:
        if open_rings and open_rings[-1] == r:
            open_rings.pop()
        elif r in open_rings:
            return False
        else:
            open_rings.append(r)
    return not open_rings


class Sweep:
    """State of the sweep over all rings of one multipolygon."""

    def __init__(self, rings: list[list[Point]]):
        self.lo: list[Point] = []
        self.hi: list[Point] = []
        self.ring: list[int] = []
        self.inside_above: list[bool] = []
        starts: dict[Point, list[int]] = {}
        for r, points in enumerate(rings):
            turn = counter_clockwise(points)
            for a, b in zip(points, points[1:] + points[:1]):
                e = len(self.ring)
                forward = a < b
                self.lo.append(a if forward else b)
                self.hi.append(b if forward else a)
                self.ring.append(r)
                self.inside_above.append(forward == turn)
                starts.setdefault(self.lo[e], []).append(e)
                starts.setdefault(self.hi[e], [])
        self.starts = starts
        self.active: list[int] = []
        self.parent: dict[int, int | None] = {}                  # ring a ring lies in
        self.touches: list[tuple[Point, set[int]]] = []

    def fault(self) -> str | None:
        """Runs the sweep; the first crossing, overlap or self-touch ends it."""
        for p in sorted(self.starts):
            found = self._visit(p)
            if found:
                return found
        return None

    def _first_not_below(self, p: Point) -> int:
        a, b = 0, len(self.active)
        while a < b:
            m = (a + b) // 2
            e = self.active[m]
            if side(self.lo[e], self.hi[e], p) > 0:
                a = m + 1
            else:
                b = m
        return a

    def _visit(self, p: Point) -> str | None:
        active, lo, hi, ring = self.active, self.lo, self.hi, self.ring
        low = high = self._first_not_below(p)
        while high < len(active) and side(lo[active[high]], hi[active[high]], p) == 0:
            high += 1
        here = active[low:high]                                  # edges that end in or pass through p
        after = [e for e in here if hi[e] != p] + self.starts[p]
        if len(after) == 2:
            turn = side(p, hi[after[0]], hi[after[1]])
            if turn == 0:
                return "edges overlap"
            if turn < 0:
                after.reverse()
        elif len(after) > 2:
            def upwards(e: int, f: int) -> int:
                turn = side(p, hi[e], hi[f])
                return (turn < 0) - (turn > 0)

            after.sort(key=cmp_to_key(upwards))
            if any(side(p, hi[e], hi[f]) == 0 for e, f in zip(after, after[1:])):
                return "edges overlap"
        if len(here) + len(after) > 2:
            around = [ring[e] for e in after] + [ring[e] for e in reversed(here)]
            if any(around.count(r) > 2 for r in set(around)):
                return "ring meets itself"
            if not _nested(around):
                return "rings cross"
            self.touches.append((p, set(around)))
        active[low:high] = after
        top = low + len(after)
        if low > 0 and low < len(active) and self._cross(active[low - 1], active[low]):
            return self._crossing(active[low - 1], active[low])
        if after and top < len(active) and self._cross(active[top - 1], active[top]):
            return self._crossing(active[top - 1], active[top])
        for k in range(low, top):
            r = ring[active[k]]
            if r not in self.parent:
                below = active[k - 1] if k else None
                self.parent[r] = None if below is None else ring[below] if self.inside_above[below] \
                    else self.parent[ring[below]]
        return None

    def _cross(self, e: int, f: int) -> bool:
        lo, hi = self.lo, self.hi
        return (side(lo[e], hi[e], lo[f]) * side(lo[e], hi[e], hi[f]) < 0
                and side(lo[f], hi[f], lo[e]) * side(lo[f], hi[f], hi[e]) < 0)

    def _crossing(self, e: int, f: int) -> str:
        return "ring meets itself" if self.ring[e] == self.ring[f] else "rings cross"


def _parted(touches: list[tuple[Point, set[int]]], rings: set[int]) -> bool:
    """Do the touching points of these rings form a cycle, which cuts the interior in two?"""
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for p, met in touches:
        mine = met & rings
        if len(mine) < 2:
            continue
        for r in mine:
            a, b = find(r), find(p)
            if a == b:
                return True
            root[a] = b
    return False


def multipolygon_fault(polygons: list[list[list[Point]]]) -> str | None:
    """The broken rule, or None. Rings are given with their closing point."""
    rings, shell_of = [], []
    for polygon in polygons:
        if not polygon:
            return "polygon without a ring"
        shell = len(rings)
        for points in polygon:
            if not all(map(math.isfinite, (v for p in points for v in p))):
                return "coordinate not finite"
            if len(points) < 4 or points[0] != points[-1]:
                return "ring not closed"
            distinct = [a for a, b in zip(points, points[1:]) if a != b]
            if len(set(distinct)) < 3:
                return "ring of fewer than three points"
            rings.append(distinct)
            shell_of.append(shell)
    sweep = Sweep(rings)
    found = sweep.fault()
    if found:
        return found
    for r, shell in enumerate(shell_of):
        around = sweep.parent[r]
        if r == shell:
            if around is not None and around == shell_of[around]:
                return "polygon inside another"
        elif around is None or around == shell_of[around] != shell:
            return "hole outside its shell"
        elif around != shell:
            return "hole inside a hole" if shell_of[around] == shell else "hole outside its shell"
    for shell in {s for s in shell_of}:
        if _parted(sweep.touches, {r for r, s in enumerate(shell_of) if s == shell}):
            return "interior not connected"
    return None


@arrow_udf(T.StringType())
def _fault(mpoly: pa.Array) -> pa.Array:
    if isinstance(mpoly, pa.ChunkedArray):
        mpoly = mpoly.combine_chunks()
    out: list[str | None] = []
    of_polygons, of_rings, of_points = (a.offsets.to_numpy() for a in (mpoly, mpoly.values, mpoly.values.values))
    missing = mpoly.is_null().to_numpy(zero_copy_only=False)
    x, y = (mpoly.values.values.values.field(c).to_numpy(zero_copy_only=False) for c in ("x", "y"))
    for k in range(len(mpoly)):
        if missing[k]:
            out.append(None)
            continue
        polygons = []
        for a in range(of_polygons[k], of_polygons[k + 1]):
            ends = of_points[of_rings[a]:of_rings[a + 1] + 1].tolist()
            first, last = ends[0], ends[-1]
            points = list(zip((x[first:last] + 0.0).tolist(), (y[first:last] + 0.0).tolist()))   # -0.0 is the same place as 0.0
            polygons.append([points[i - first:j - first] for i, j in zip(ends, ends[1:])])
        out.append(multipolygon_fault(polygons) if polygons else None)
    return pa.array(out, pa.string())


def polygon_fault(mpoly: Column | str) -> Column:
    """Name of the rule a multipolygon breaks; null for a valid, an empty and a missing one."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        ship_package(spark)                                      # the sweep runs in Python workers
    return _fault(mpoly)
