"""tsuji — road-network analytics as plain Spark DataFrame / Column functions.

Geometry lives in native Spark types so every operator stays inside Catalyst:

* a line is ``array<struct<x: double, y: double>>`` (x = longitude, y = latitude)
* a multipolygon is ``array<array<array<struct<x, y>>>>`` (polygons → rings, ring 0 is the shell)
* a bounding box is ``struct<xmin, ymin, xmax, ymax>`` of doubles

WKB is only produced or consumed at the edges (``tsuji.functions.wkb``).
"""

__version__ = "0.1.0"
