"""Image-path and URI grammar as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# <batch>/<batch>_<object>_IM<digits>.<ext>, both batch parts equal; Unicode classes, "\n" line ends.
STRICT_PATH = r"(?Ud)^([^/]+)/\1_(.+)_IM\d+\.\w+$"


def object_id_strict(path: Column) -> Column:
    """Object ID of a well-formed manifest path, NULL for any other path."""
    return F.nullif(F.regexp_extract(path, STRICT_PATH, 2), F.lit(""))


def object_id_positional(path: Column) -> Column:
    """Second ``_`` part of the file name, NULL when there are fewer than three parts."""
    parts = F.split(image_basename(path), "_")
    return F.when(F.size(parts) >= 3, F.get(parts, F.lit(1)))


def path_error(path: Column) -> Column:
    """Why a path has no positional object ID, NULL when it has one."""
    return F.when(
        object_id_positional(path).isNull(), F.concat(F.lit("Unexpected filename format: "), path)
    )


def batch_id(path: Column) -> Column:
    return F.substring_index(path, "/", 1)


def image_basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)


def is_object_store_uri(uri: Column) -> Column:
    return F.startswith(uri, F.lit("s3://"))


def uri_bucket(uri: Column) -> Column:
    """Authority part of a URI, empty when there is none."""
    return F.regexp_extract(uri, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1)


def uri_key(uri: Column) -> Column:
    """Path part without leading slashes; query and fragment are cut off."""
    return F.regexp_extract(uri, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)?/*([^?#]*)", 1)
