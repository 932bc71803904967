"""Object keys, URIs and result rows as text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# Fixed value: channel tags that may precede a file name; only the first is tied to the start.
CHANNEL_TAG = "^(.*?)(?:^c0_|c1_|c2_|c3_)"
URI = "^s3a?://([^/]+)/(.*)$"


def bucket(uri: Column) -> Column:
    return F.regexp_extract(uri, URI, 1)


def key(uri: Column) -> Column:
    return F.regexp_extract(uri, URI, 2)


def file_name(path: Column) -> Column:
    return F.element_at(F.split(path, "/", -1), -1)


def base_name(path: Column) -> Column:
    """File name without directory and last extension."""
    return F.regexp_extract(path, r"([^/]+?)(\.[^./]*)?$", 1)


def base_uri(uri: Column) -> Column:
    """The URI with every occurrence of its key removed."""
    return F.replace(uri, key(uri), F.lit(""))


def strip_channel_tag(name: Column) -> Column:
    """Remove the first channel tag."""
    return F.regexp_replace(name, CHANNEL_TAG, "$1")


def output_path(path: Column, in_dir: str, out_dir: str, in_ext: str, out_ext: str) -> Column:
    """Literal replacement of all occurrences, first of the directory, then of the extension."""
    moved = F.replace(path, F.lit(in_dir), F.lit(out_dir))
    return F.replace(moved, F.lit(in_ext), F.lit(out_ext))


def four_decimals(c: Column) -> Column:
    return F.format_string("%.4f", c)
