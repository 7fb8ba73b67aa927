"""URI and object-key helpers (P16-P19) as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .grid import col

# The public HTTP endpoint form of an s3:// URI, the prefix names
# of source and converted objects, and the archive / raster suffixes.
S3_HTTP_PREFIX = "http://s3.amazonaws.com/"
SOURCE_PREFIX = "source"
CONVERTED_PREFIX = "4326"


def normalise_uri(uri, http_prefix: str = S3_HTTP_PREFIX) -> Column:
    """``s3://bucket/key`` -> ``<http_prefix>bucket/key`` (other schemes unchanged)."""
    return F.replace(col(uri), F.lit("s3://"), F.lit(http_prefix))


def uri_scheme(uri) -> Column:
    return F.regexp_extract(col(uri), r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1)


def uri_bucket(uri) -> Column:
    return F.regexp_extract(col(uri), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/]*)", 1)


def uri_key(uri) -> Column:
    return F.regexp_extract(col(uri), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*/(.*)$", 1)


def basename(uri) -> Column:
    return F.regexp_extract(col(uri), r"([^/]*)$", 1)


def target_name(uri) -> Column:
    """Converted object of a source: every 'source' -> '4326', every '.zip' -> '.tif'."""
    return F.replace(F.replace(col(uri), F.lit(SOURCE_PREFIX), F.lit(CONVERTED_PREFIX)),
                     F.lit(".zip"), F.lit(".tif"))


def archive_member(uri) -> Column:
    """Raster inside a source archive: base name with every 'zip' -> 'tif'."""
    return F.replace(basename(uri), F.lit("zip"), F.lit("tif"))


def is_archive(uri) -> Column:
    return F.contains(col(uri), F.lit("zip"))


def is_tiff(uri) -> Column:
    return col(uri).rlike(r"\.tif$")
