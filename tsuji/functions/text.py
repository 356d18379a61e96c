"""String functions as Columns: HTTP log fields (M3), URL file names and mesh codes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geom import _c

# Patterns over the stringified HTTP log struct. The request header is
# ``Range='bytes=a-b'`` ('=' after bytes) and never matches the response ``Content-Range='bytes a-b/n'``.
TYPE_RE = r"'type':\s*(\w+)"
STATUS_RE = r"'status':\s*(\w+)"
RANGE_RE = r"Range='?bytes=([0-9\-]+)"
CONTENT_LENGTH_RE = r"Content-Length='?(\d+)"
CONTENT_RANGE_TOTAL_RE = r"Content-Range='?bytes [0-9\-]+/(\d+)"

# Fixed value: archive names look like N13-24_<mesh>_..., case-insensitive.
MESH_RE = r"(?i)N13-24_(\d+)_"


def _extract_or_null(s: Column, pattern: str) -> Column:
    # every group above matches at least one character, so '' means "no match": one regex pass
    return F.nullif(F.regexp_extract(s, pattern, 1), F.lit(""))


def parse_http_message(message) -> Column:
    """``struct<method, status, range_header, content_length: bigint, total_size: bigint>``.

    Missing method/status read '?', missing numbers and range are null.
    """
    m = _c(message)
    return F.struct(
        F.coalesce(_extract_or_null(m, TYPE_RE), F.lit("?")).alias("method"),
        F.coalesce(_extract_or_null(m, STATUS_RE), F.lit("?")).alias("status"),
        _extract_or_null(m, RANGE_RE).alias("range_header"),
        _extract_or_null(m, CONTENT_LENGTH_RE).cast("bigint").alias("content_length"),
        _extract_or_null(m, CONTENT_RANGE_TOTAL_RE).cast("bigint").alias("total_size"))


def url_file_name(url) -> Column:
    """Last path segment of a URL (query and fragment ignored, trailing slashes dropped); '' if none."""
    # optional scheme, optional //authority, then the path up to the query or fragment
    path = F.regexp_extract(_c(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    return F.regexp_extract(path, r"([^/]+)/*$", 1)


def mesh_code_from_name(name, strict: bool = True) -> Column:
    """Mesh code from an archive/file name; an unparsable name raises when ``strict``."""
    n = _c(name)
    code = F.regexp_extract(n, MESH_RE, 1)
    if not strict:
        return F.when(code != "", code)
    return F.when(code != "", code).otherwise(
        F.raise_error(F.concat(F.lit("no mesh code in the name "), n)).cast("string"))
