"""The detection chain in both forms."""

from __future__ import annotations

from pyspark.sql import DataFrame

from punctum.operators import detect
from punctum.params import SpotParams


def region_of(voxels: DataFrame, axes, params: SpotParams) -> DataFrame:
    """Support regions of all peaks, background subtracted; peaks, gradients and regions share one gather of the pixels."""
    return detect.regions(detect.voxel_gather(voxels, axes, params), axes, params)


def detect_voxels(voxels: DataFrame, axes, params: SpotParams) -> DataFrame:
    """The chain over voxel rows. A row is a pixel, so the shuffle is wider than that of chunks: right for moderate images."""
    return detect.spots_of(detect.voxel_gather(voxels, axes, params), axes, params)


def detect_blocks(chunks: DataFrame, axes, params: SpotParams, sizes: DataFrame | None = None) -> DataFrame:
    """The chain over chunk rows, block by block. Right for large images."""
    return detect.detect(chunks, axes, params, sizes)


def detect_in_place(chunks: DataFrame, axes, params: SpotParams, chunk) -> DataFrame:
    """The chain over a table in buckets (``images.write_bucketed``) with chunks of the size ``chunk``: they are the blocks and stay where
    they are, and only their surroundings move. Right for images that are stored once and searched often."""
    return detect.spots_of(detect.in_place_gather(chunks, axes, params, chunk), axes, params)


def detect_images(chunks: DataFrame, axes, params: SpotParams, sizes: DataFrame | None = None) -> DataFrame:
    """Many images, each with its own intensity range if none is given.

    An image larger than a block is still cut into blocks, so one huge image is never one task;
    the range is then the image's, and the result equals that of one block per image.
    """
    return detect.detect(chunks, axes, params.with_(range_scope="image"), sizes)
