"""Registered queries: every operator over images, listings and logs derived from whole tables."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession, functions as F

from punctum.functions import geometry as geo
from punctum.functions import text
from punctum.functions.numeric import rounded
from punctum.operators import blocks as blk
from punctum.operators import compare, detect, filters, intensity, localize, progress, support, worklist
from punctum.params import (
    AXES, BG_MEAN, BG_MEDIAN, BG_RANSAC_MEAN, BG_RANSAC_MEDIAN, MULTICONSENSUS, NO_RANSAC, SpotParams,
)
from punctum.plans import spots as chain
from punctum.session import scratch_path, written
from punctum.sinks import spots as sink
from punctum.sources import containers, images as img
from punctum.sources import listing as files
from punctum.sources import tables
from punctum.streaming import outputs as stream

P2 = SpotParams(max_intensity=79999.0, block_size=(64, 24))
P3 = SpotParams(max_intensity=10.0, anisotropy=0.7, block_size=(64, 48, 11))
SETTINGS = {2: P2, 3: P3}
CROP = {2: ((5, 3), (120, 27)), 3: ((7, 5, 1), (90, 44, 9))}
MULTI = {2: dict(ransac=MULTICONSENSUS, min_inliers=8, n_stdev1=2.0, n_stdev2=1.5), 3: dict(ransac=MULTICONSENSUS, min_inliers=24, n_stdev1=2.0, n_stdev2=1.5)}
BUCKETS = 16
REACH = max(P2.halo(2))
SCALARS = "-i0 4166.0 -i1 46562.0 -a 1.0"
BASE = "s3://images/"


def voxels(spark, sf, n) -> DataFrame:
    return tables.event_voxels(spark, sf) if n == 2 else tables.order_voxels(spark, sf)


def chunks(spark, sf, n, dense=False) -> DataFrame:
    return tables.event_chunks(spark, sf, dense) if n == 2 else tables.order_chunks(spark, sf, dense)


def normalized(spark, sf, n) -> DataFrame:
    p = SETTINGS[n]
    return filters.normalize_fixed(voxels(spark, sf, n), p.min_intensity, p.max_intensity)


def sizes(spark, sf, n) -> DataFrame:
    """One row per image with its size."""
    return chunks(spark, sf, n).groupBy("image").agg(*[F.max("n" + a).alias("n" + a) for a in AXES[n]])


def stored(table: DataFrame, label: str) -> str:
    path = scratch_path(table.sparkSession, label)
    img.write_images(table, path)
    return path


def pick(df: DataFrame, *exact: str, **digits: int) -> DataFrame:
    return df.select(*exact, *[rounded(F.col(c), d).alias(c) for c, d in digits.items()])


# --- sources -----------------------------------------------------------------------------


def scan_chunks(spark, sf, n=2):
    path = stored(chunks(spark, sf, n, dense=True), "chunks")
    return img.scan_images(spark, path, AXES[n]).select("image", *AXES[n], "v")


def scan_object_store(spark, sf):
    """The chunk scan through a URI with a scheme."""
    path = stored(chunks(spark, sf, 2, dense=True), "store")
    uri = path if ":/" in path else "file:" + path
    return img.scan_images(spark, uri, AXES[2]).select("image", "x", "y", "v")


def scan_chunks_alt_layout(spark, sf):
    path = stored(tables.vector_lines(spark, sf), "lines")
    return pick(img.scan_images(spark, path, AXES[2], layout="lines"), "image", "x", "y", v=6)


def scan_dataset_meta(spark, sf, n=2):
    """Sizes from the footers of stored chunks."""
    path = stored(chunks(spark, sf, n), "sizes")
    return img.footer_size(spark, path, AXES[n]).drop("chunks").withColumn("ndim", F.lit(n))


def read_dataset_attributes(spark, sf):
    """Attributes files, one per image, written and read back."""
    path = scratch_path(spark, "attributes")
    sizes_ = sizes(spark, sf, 2)
    fields = sizes_.select(
        "image", F.array("nx", "ny").alias("dimensions"), F.array(*map(F.lit, tables.EVENT_CHUNK)).alias("blockSize"), F.lit("uint32").alias("dataType"),
        F.struct(F.lit("raw").alias("type")).alias("compression"),
        F.struct(F.lit("nm").alias("unit"), F.array(F.lit(80.5), F.lit(81.0)).alias("dimensions")).alias("pixelResolution"))
    fields.write.partitionBy("image").json(path)
    return img.dataset_meta(spark, path).select(
        "image", "ndim", F.col("dimensions")[0].alias("nx"), F.col("dimensions")[1].alias("ny"), F.col("blockSize")[0].alias("block_x"), F.col("blockSize")[1].alias("block_y"),
        F.col("dataType").alias("pixel"), F.col("pixelResolution.unit").alias("unit"), F.col("pixelResolution.dimensions")[0].alias("step"))


def scan_chunks_named(spark, sf):
    """Image names with leading zeros stay as they are."""
    name = F.format_string("%06d", F.length("image") * 1000 + F.ascii("image"))
    path = stored(chunks(spark, sf, 2, dense=True).withColumn("image", name), "named")
    return img.scan_images(spark, path, AXES[2]).select("image", "x", "y", "v")


def scan_whole_images(spark, sf, n=2):
    return voxels(spark, sf, n).groupBy("image").agg(
        F.count("*").alias("pixels"), F.sum("v").alias("total"), F.min("v").alias("low"), F.max("v").alias("high"))


def list_objects(spark, sf):
    """Listing of texts of known length, written by source: folders of the keys and bytes."""
    path = scratch_path(spark, "objects")
    tables.table(spark, sf, "documents").select("text", "source").write.partitionBy("source").text(path)
    objects = files.list_objects(spark, path).withColumn("source", F.regexp_extract("key", "/source=([^/]+)/part-[^/]+[.]txt$", 1))
    return objects.filter("source <> ''").groupBy("source").agg(F.sum("size").alias("size"), F.count_if(F.col("modified").isNull()).alias("undated"))


def read_accept_list(spark, sf):
    path = scratch_path(spark, "accept")
    good = tables.table(spark, sf, "labels").filter("quality = 1")
    named = good.select("doc_id", F.concat(F.lit("d"), F.col("doc_id").cast("string"), F.lit(".tif")).alias("file"))
    named.write.option("header", True).option("quoteAll", True).csv(path)
    return files.read_accept_list(spark, path)


def read_task_params(spark, sf):
    path = scratch_path(spark, "tasks")
    sink.write_manifests(task_texts(spark, sf), path)
    return worklist.task_inputs(files.read_task_texts(spark, path))


def task_tokens(spark, sf):
    return worklist.task_tokens(task_texts(spark, sf)).filter(~F.col("flag").isin("-i", "-o"))


def read_spots_csv(spark, sf):
    path = scratch_path(spark, "set")
    first, _ = tables.spot_sets(spark, sf)
    sink.write_csv(first.withColumn("intensity", F.lit(1.0)), AXES[2], path)
    return compare.sort_spots(sink.read_csv(spark, path, AXES[2]), AXES[2])


# --- sinks -------------------------------------------------------------------------------


def lsq_spots(spark, sf, n=2):
    return detect.detect(chunks(spark, sf, n), AXES[n], SETTINGS[n].with_(ransac=NO_RANSAC))


def write_spots_csv(spark, sf, n=2):
    path = scratch_path(spark, "spots")
    sink.write_csv(lsq_spots(spark, sf, n), AXES[n], path)
    return sink.read_csv(spark, path, AXES[n])


def write_object_store(spark, sf):
    path = scratch_path(spark, "spots")
    uri = path if ":/" in path else "file:" + path
    sink.write_csv(lsq_spots(spark, sf), AXES[2], uri)
    return sink.read_csv(spark, uri, AXES[2])


def write_spots_per_image(spark, sf):
    path = scratch_path(spark, "per-image")
    sink.write_csv_per_image(written(lsq_spots(spark, sf), "found"), AXES[2], path)
    return sink.read_csv_per_image(spark, path, AXES[2])


def write_objects_per_image(spark, sf):
    path = scratch_path(spark, "objects-per-image")
    sink.write_objects_per_image(written(lsq_spots(spark, sf), "found"), AXES[2], path)
    return sink.read_objects_per_image(spark, path, AXES[2])


def write_every_image(spark, sf):
    """Spots per image counted from the files; images without spots have a file with the header alone."""
    path = scratch_path(spark, "every-image")
    bright = written(intensity.intensity_threshold(lsq_spots(spark, sf), 21000.0), "bright")
    sink.write_csv_per_image(bright, AXES[2], path, sizes(spark, sf, 2))
    return sink.count_per_image(spark, path)


def format_spot_row(spark, sf):
    first, _ = tables.spot_sets(spark, sf)
    return sink.formatted(first.withColumn("intensity", F.col("x") * F.lit(3.0) - F.col("y")), AXES[2], "id")


def empty_output_guarantee(spark, sf):
    bright = intensity.intensity_threshold(lsq_spots(spark, sf), 21000.0)
    return progress.every_image(bright, sizes(spark, sf, 2))


def task_inputs(spark, sf):
    source = F.concat(F.lit(BASE), F.col("key"))
    return worklist.summaries(tables.listing(spark, sf), "data/", ".tif"), source, text.output_path(source, "data", "results/data", ".tif", ".csv")


def task_texts(spark, sf):
    inputs, source, target = task_inputs(spark, sf)
    return worklist.manifests(worklist.chunk_manifest(inputs, 40), source, target, SCALARS)


def write_manifest_single(spark, sf):
    """The whole listing as one manifest, in parts of ordered lines."""
    path = scratch_path(spark, "manifest")
    inputs, source, target = task_inputs(spark, sf)
    entries = worklist.chunk_manifest(inputs, 0).select("chunk", "rn", worklist.manifest_entry(source, target).alias("txt"))
    sink.write_manifest_parts(entries, path, SCALARS, lines=100)
    return files.read_manifest_parts(spark, path)


# --- projections and geometry ------------------------------------------------------------


def scan_chunk_files(spark, sf, n=2):
    """A crop read from a file per chunk; only the files it touches are opened."""
    path, every = scratch_path(spark, "container"), written(chunks(spark, sf, n, dense=True), "every")
    block = every.agg(*[F.max("w" + a) for a in AXES[n]]).first()
    containers.write_container(every, path, AXES[n], list(block), packing="gzip" if n == 2 else "raw")
    found = img.voxels_of_chunks(containers.read_container(spark, path, AXES[n], CROP[n]), AXES[n])
    return img.crop_voxels(found, AXES[n], *CROP[n]).select("image", *AXES[n], "v")


def crop_interval(spark, sf, n=2):
    path = stored(chunks(spark, sf, n, dense=True), "crop")
    return img.scan_images(spark, path, AXES[n], crop=CROP[n]).select("image", *AXES[n], "v")


def _doc_options(spark, sf):
    d = F.col("doc_id")
    return tables.table(spark, sf, "documents").select("doc_id", (2 + d % 2).cast("int").alias("ndim"), F.concat_ws(
        ",", (d % 500 + 3).cast("string"), F.col("n_chars").cast("string"), F.when(d % 2 == 1, (d % 7 + 3).cast("string"))).alias("given"))


def parse_int_list(spark, sf):
    parsed = geo.parse_int_list(F.col("given"), F.col("ndim"))
    return _doc_options(spark, sf).select("doc_id", F.size(parsed).alias("arity"), parsed[0].alias("first"), parsed[1].alias("second"), F.get(parsed, 2).alias("third"))


def block_size_default(spark, sf):
    given = F.when(F.col("doc_id") % 3 == 0, geo.parse_int_list(F.col("given"), F.col("ndim")))
    size = geo.block_size_or_default(given, F.col("ndim"))
    return _doc_options(spark, sf).select("doc_id", "ndim", F.array_join(size.cast("array<string>"), ",").alias("size"))


def intensity_mode(spark, sf):
    cents = F.round(F.col("value") * 100).cast("bigint")
    users = tables.table(spark, sf, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.min(cents).alias("low"), F.max(cents).alias("high"))
    return users.select("user_id", F.date_format("day", "yyyy-MM-dd").alias("day"), geo.intensity_mode(F.col("low"), F.col("high")).alias("mode"))


def zip_inputs_outputs(spark, sf):
    """Pairs from two lists per work chunk; a chunk's size bounds its lists."""
    chunked = worklist.chunk_manifest(tables.listing(spark, sf), 50)
    names = F.sort_array(F.collect_list("key"))
    lists = chunked.groupBy("chunk").agg(names.alias("inputs"))
    return worklist.zip_lists(lists.withColumn("outputs", F.transform("inputs", lambda k: F.concat(k, F.lit(".out")))), "chunk")


def derive_output_path(spark, sf):
    key = F.concat(F.lit(BASE), F.col("key"))
    return tables.listing(spark, sf).select("key", text.output_path(key, "data", "results/data", ".tif", ".csv").alias("output"))


def uri_parts(spark, sf):
    uri = F.concat(F.lit(BASE), F.col("key"))
    return tables.listing(spark, sf).select(
        uri.alias("uri"), text.bucket(uri).alias("bucket"), text.key(uri).alias("object"),
        text.file_name(text.key(uri)).alias("file"), text.base_uri(uri).alias("base"))


def strip_channel_tag(spark, sf):
    name = text.file_name(F.col("key"))
    twice = F.concat(F.lit("a_c1_"), name)
    return tables.listing(spark, sf).select("key", text.strip_channel_tag(name).alias("plain"), text.strip_channel_tag(twice).alias("once"))


def _results(spark, sf):
    """Per-block results ``image, block_id, points``; a block without spots has a null result."""
    found = lsq_spots(spark, sf)
    points = found.groupBy("image", "block_id").agg(F.collect_list(F.struct("x", "y", "intensity")).alias("points"))
    return blk.split_blocks(sizes(spark, sf, 2), AXES[2], P2.block(2)).select("image", "block_id").join(points, ["image", "block_id"], "left")


def drop_null_results(spark, sf):
    return progress.drop_null_results(_results(spark, sf)).select("image", "block_id", F.size("points").alias("spots"))


def merge_blocks(spark, sf):
    return pick(progress.merge_blocks(_results(spark, sf)), "image", "block_id", x=4, y=4, intensity=3)


def split_blocks(spark, sf, n=2):
    return blk.split_blocks(sizes(spark, sf, n), AXES[n], SETTINGS[n].block(n))


def split_blocks_crop(spark, sf, n=2):
    return blk.split_blocks(sizes(spark, sf, n), AXES[n], (20,) * (n - 1) + (8,), *CROP[n])


def udtf_split_blocks(spark, sf):
    spark.udtf.register("split_blocks_2d", blk.SplitBlocks2D)
    sizes(spark, sf, 2).createOrReplaceTempView("image_sizes")
    return spark.sql(
        "SELECT s.image, b.* FROM image_sizes s, LATERAL split_blocks_2d(0L, s.nx - 1, 0L, s.ny - 1, 64, 24) b")


def udtf_split_blocks_3d(spark, sf):
    spark.udtf.register("split_blocks_3d", blk.SplitBlocks3D)
    sizes(spark, sf, 3).createOrReplaceTempView("volume_sizes")
    return spark.sql(
        "SELECT s.image, b.* FROM volume_sizes s, LATERAL split_blocks_3d(0L, s.nx - 1, 0L, s.ny - 1, 0L, s.nz - 1, 64, 48, 11) b")


def block_voxels(spark, sf, n=2):
    p = SETTINGS[n]
    out = blk.read_by_blocks(voxels(spark, sf, n), AXES[n], p.block(n), [0] * n)
    return out.select("image", "block_id", *AXES[n], "v")


def block_owner(spark, sf, n=2):
    p, v = SETTINGS[n], voxels(spark, sf, n)
    lo, hi = blk.bounds(AXES[n])
    owner = [geo.block_owner(a, lo[d], hi[d], p.block(n)[d]) for d, a in enumerate(AXES[n])]
    counts = [geo.block_count(lo[d], hi[d], p.block(n)[d]) for d in range(n)]
    return v.filter(blk.evaluated(AXES[n])).selectExpr("image", *AXES[n], f"{geo.linear_id(owner, counts)} AS block_id")


def halo_voxels(spark, sf, n=2):
    p = SETTINGS[n]
    out = blk.read_by_blocks(voxels(spark, sf, n), AXES[n], p.block(n), [2] * n)
    return out.groupBy("image", "block_id").agg(
        F.count("*").alias("pixels"), F.sum("v").alias("total"), F.count_if("inside").alias("inside"), F.count_if("owned").alias("owned"),
        *[f(a).alias(f.__name__ + "_" + a) for a in AXES[n] for f in (F.min, F.max)])


def mirror_extend(spark, sf):
    border = F.least("x", F.col("nx") - 1 - F.col("x"), "y", F.col("ny") - 1 - F.col("y")) < REACH
    v = voxels(spark, sf, 2).filter(border).selectExpr("image", "x", "y", "nx", "ny", f"explode(sequence(-{REACH}L, {REACH}L)) AS i")
    return v.selectExpr("image", "x", "y", "i", f"{geo.mirror('(y + i)', 'ny')} AS at", f"{geo.mirror('(x + i)', 'nx')} AS along")


# --- pixel filters -----------------------------------------------------------------------


def normalize_fixed(spark, sf, n=2):
    return pick(normalized(spark, sf, n), "image", *AXES[n], v=8)


def normalize_auto(spark, sf, n=2, scope="block"):
    out = blk.read_by_blocks(voxels(spark, sf, n), AXES[n], SETTINGS[n].block(n), [0] * n).repartition("image", "block_id")
    return pick(filters.normalize_auto(out, scope), "image", "block_id", *AXES[n], v=8)


def gauss_smooth(spark, sf, n=2):
    return pick(filters.gauss_smooth(voxels(spark, sf, n), AXES[n], SETTINGS[n].sigmas(n)), "image", *AXES[n], v=4)


def gauss_smooth_raster(spark, sf):
    return pick(filters.gauss_smooth(tables.vector_voxels(spark, sf), AXES[2], (1.5, 1.5)), "image", "x", "y", v=6)


def dog(spark, sf, n=2):
    return pick(filters.dog(normalized(spark, sf, n), AXES[n], SETTINGS[n]), "image", *AXES[n], dog=6)


def dog_raster(spark, sf):
    return pick(filters.dog(tables.vector_voxels(spark, sf), AXES[2], P2), "image", "x", "y", dog=6)


def dog_peaks(spark, sf, n=2):
    return pick(filters.dog_peaks(voxels(spark, sf, n), AXES[n], SETTINGS[n]), "image", "block_id", *AXES[n], dog=6)


def dog_peaks_auto(spark, sf, scope="block"):
    p = P2.with_(max_intensity=0.0, range_scope=scope)
    return pick(filters.dog_peaks(voxels(spark, sf, 2), AXES[2], p), "image", "block_id", *AXES[2], dog=6)


def gradients(spark, sf, n=2):
    p = SETTINGS[n]
    out = filters.gradients(normalized(spark, sf, n), AXES[n], p.anisotropy)
    return pick(out, "image", *AXES[n], **{"g" + a: 8 for a in AXES[n]})


# --- support regions, background, centres ------------------------------------------------


def support_region(spark, sf, n=2):
    out = chain.region_of(voxels(spark, sf, n), AXES[n], SETTINGS[n])
    return pick(out, *support.spot_key(AXES[n]), *["d" + a for a in AXES[n]], **{"g" + a: 8 for a in AXES[n]})


def background(spark, sf, method, n=2):
    p = SETTINGS[n]
    region = chain.region_of(voxels(spark, sf, n), AXES[n], p)
    out = support.background(region, AXES[n], p.support_radius, method, p.background_max_error, p.background_min_inlier_ratio)
    return pick(out, *support.spot_key(AXES[n]), **{"bg" + a: 7 for a in AXES[n]})


def localized(spark, sf, n=2, **changes):
    p = SETTINGS[n].with_(**changes)
    out = localize.localize(chain.region_of(voxels(spark, sf, n), AXES[n], p), AXES[n], p)
    return pick(out, *support.spot_key(AXES[n]), "gradients", "inliers", "round", **{a: 4 for a in AXES[n]})


def multiconsensus_filter(spark, sf):
    p = P2.with_(inlier_ratio=0.0)
    out = localize.localize(chain.region_of(voxels(spark, sf, 2), AXES[2], p), AXES[2], p)
    return localize.drop_weak_counts(written(out, "centres"), p.with_(n_stdev1=1.5, n_stdev2=1.0)).select(*support.spot_key(AXES[2]), "inliers")


def detected(spark, sf, n=2, relational=False, whole=False, **changes):
    p = SETTINGS[n].with_(**changes)
    if relational:
        out = chain.detect_voxels(voxels(spark, sf, n), AXES[n], p)
    elif whole:
        out = chain.detect_images(chunks(spark, sf, n), AXES[n], p.with_(block_size=None))
    else:
        out = chain.detect_blocks(chunks(spark, sf, n), AXES[n], p)
    return pick(out, *support.spot_key(AXES[n]), "inliers", **{a: 4 for a in AXES[n]}, intensity=3)


def detected_in_place(spark, sf, n=2, **changes):
    """Chunks in buckets are the blocks; only their surroundings move."""
    path, shape = scratch_path(spark, "buckets"), {2: tables.EVENT_CHUNK, 3: tables.ORDER_CHUNK}[n]
    table = img.write_bucketed(chunks(spark, sf, n), path.rpartition("/")[2].replace("-", "_"), path, AXES[n], BUCKETS)
    out = chain.detect_in_place(table, AXES[n], SETTINGS[n].with_(range_scope="image", **changes), shape)
    return pick(out, *support.spot_key(AXES[n]), "inliers", **{a: 4 for a in AXES[n]}, intensity=3)


def detected_in_crop(spark, sf, n=2):
    """Each image's own range inside the crop, from the zone maps of stored chunks."""
    path = stored(chunks(spark, sf, n), "zones")
    table = spark.read.schema(img.chunk_schema(AXES[n], zones=True)).parquet(path)
    lo, hi = CROP[n]
    found = SETTINGS[n].with_(max_intensity=0.0, block_size=None, crop_min=lo, crop_max=hi)
    out = chain.detect_images(table, AXES[n], found, img.footer_size(spark, path, AXES[n]))
    return pick(out, *support.spot_key(AXES[n]), "inliers", **{a: 4 for a in AXES[n]}, intensity=3)


def _arrivals(spark, sf, least=0.0):
    """Half of the chunks arrive, are detected, and then the rest: what was found first at the gaps must go."""
    source, target, state = (scratch_path(spark, label) for label in ("arriving", "arrived", "arrived-state"))
    p, every = P2.with_(ransac=NO_RANSAC, intensity_threshold=least), written(chunks(spark, sf, 2), "every")
    for rest in (0, 1):
        img.write_images(every.filter(F.col("chunk_id") % 2 == rest), source, mode="append")
        stream.detect_arrivals(spark, source, AXES[2], p, target, state).awaitTermination()
    return target


def stream_incremental_detect(spark, sf):
    found = stream.arrived(spark, _arrivals(spark, sf), AXES[2])
    return pick(found, "image", "sx", "sy", "inliers", x=4, y=4, intensity=3)


def stream_every_image(spark, sf):
    """Spots per image of the stream, 0 for images that have none."""
    target = _arrivals(spark, sf, least=21000.0)
    images = stream.versions(spark, target).select("image").distinct()
    return progress.every_image(stream.arrived(spark, target, AXES[2]), images)


# --- comparison, listings, progress ------------------------------------------------------


def spots_nearest(spark, sf):
    return pick(compare.nearest(*tables.spot_sets(spark, sf), AXES[2]), "id", "match_id", distance=6)


def spots_unmatched(spark, sf):
    return pick(compare.unmatched(*tables.spot_sets(spark, sf), AXES[2]), "id", distance=6)


def sort_spots(spark, sf):
    return pick(compare.sort_spots(tables.spot_sets(spark, sf)[0], AXES[2]), "id", x=6, y=6)


def on_listing(fn):
    return lambda spark, sf: fn(tables.listing(spark, sf))


def pending_inputs(spark, sf):
    return worklist.pending(tables.listing(spark, sf), tables.finished_names(spark, sf))


def accepted_inputs(spark, sf):
    return worklist.accepted(tables.listing(spark, sf), tables.accept_names(spark, sf))


def chunk_manifest(spark, sf):
    return worklist.chunk_manifest(worklist.summaries(tables.listing(spark, sf), "data/", ".tif"), 64)


def write_manifest(spark, sf):
    path = scratch_path(spark, "manifest")
    sink.write_manifests(task_texts(spark, sf), path)
    return files.read_task_texts(spark, path)


def spots_per_block(spark, sf, n=2):
    blocks = blk.split_blocks(sizes(spark, sf, n), AXES[n], SETTINGS[n].block(n))
    return progress.per_block(lsq_spots(spark, sf, n), blocks)


def spots_per_image(spark, sf):
    return progress.per_image(lsq_spots(spark, sf))


def spots_total(spark, sf, n=2):
    return lsq_spots(spark, sf, n).agg(F.count("*").alias("spots"))


def poll_delta(spark, sf, interval="1 hour"):
    return progress.poll_delta(progress.poll_bins(tables.table(spark, sf, "events").select("ts"), interval), interval)


def stream_output_count(spark, sf, interval="1 hour"):
    return stream.output_count(spark, sf, "ts timestamp_ntz", pattern="events.parquet", interval=interval)


def task_durations(spark, sf):
    return progress.task_durations(progress.parse_time_log(tables.time_log(spark, sf)))


def registry():
    three = lambda fn, **kw: partial(fn, n=3, **kw)
    lsq = dict(ransac=NO_RANSAC)
    return {
        "scan_chunks": scan_chunks, "scan_chunks_3d": three(scan_chunks),
        "scan_chunks_alt_layout": scan_chunks_alt_layout,
        "scan_dataset_meta": scan_dataset_meta, "scan_dataset_meta_3d": three(scan_dataset_meta),
        "scan_whole_images": scan_whole_images, "scan_whole_images_3d": three(scan_whole_images),
        "scan_object_store": scan_object_store,
        "list_objects": list_objects,
        "list_by_prefix_ext": on_listing(lambda t: worklist.by_prefix_ext(t, "src1", ".tif", BASE)),
        "list_summaries": on_listing(lambda t: worklist.summaries(t, "src1", ".tif")),
        "list_basenames": on_listing(lambda t: worklist.base_names(t, "src1")),
        "read_task_params": read_task_params, "task_scalars": task_tokens,
        "read_accept_list": read_accept_list, "read_spots_csv": read_spots_csv,
        "input_exists": on_listing(lambda t: worklist.input_exists(t, "data/src1")),
        "write_spots_csv": write_spots_csv, "write_spots_csv_3d": three(write_spots_csv),
        "write_spots_per_image": write_spots_per_image, "write_objects_per_image": write_objects_per_image, "write_object_store": write_object_store,
        "empty_output_guarantee": empty_output_guarantee, "write_manifest": write_manifest,
        "scan_chunk_files": scan_chunk_files, "scan_chunk_files_3d": three(scan_chunk_files),
        "crop_interval": crop_interval, "crop_interval_3d": three(crop_interval),
        "parse_int_list": parse_int_list, "block_size_default": block_size_default,
        "intensity_mode": intensity_mode, "zip_inputs_outputs": zip_inputs_outputs,
        "derive_output_path": derive_output_path, "uri_parts": uri_parts,
        "strip_channel_tag": strip_channel_tag, "format_spot_row": format_spot_row,
        "drop_null_results": drop_null_results,
        "split_blocks": split_blocks, "split_blocks_3d": three(split_blocks),
        "split_blocks_crop": split_blocks_crop, "split_blocks_crop_3d": three(split_blocks_crop),
        "udtf_split_blocks": udtf_split_blocks,
        "block_voxels": block_voxels, "block_voxels_3d": three(block_voxels),
        "block_owner": block_owner, "block_owner_3d": three(block_owner),
        "halo_voxels": halo_voxels, "halo_voxels_3d": three(halo_voxels),
        "mirror_extend": mirror_extend,
        "normalize_fixed": normalize_fixed, "normalize_fixed_3d": three(normalize_fixed),
        "normalize_auto": normalize_auto, "normalize_auto_image": partial(normalize_auto, scope="image"),
        "gauss_smooth": gauss_smooth, "gauss_smooth_3d": three(gauss_smooth), "gauss_smooth_raster": gauss_smooth_raster,
        "dog": dog, "dog_anisotropic": three(dog), "dog_raster": dog_raster,
        "dog_peaks": dog_peaks, "dog_peaks_3d": three(dog_peaks),
        "dog_peaks_auto": dog_peaks_auto, "dog_peaks_auto_image": partial(dog_peaks_auto, scope="image"),
        "gradients": gradients, "gradients_3d": three(gradients),
        "support_region": support_region, "support_region_3d": three(support_region),
        "background_mean": partial(background, method=BG_MEAN),
        "background_median": partial(background, method=BG_MEDIAN),
        "background_ransac_mean": partial(background, method=BG_RANSAC_MEAN),
        "background_ransac_median": partial(background, method=BG_RANSAC_MEDIAN),
        "background_mean_3d": three(background, method=BG_MEAN),
        "background_median_3d": three(background, method=BG_MEDIAN),
        "background_ransac_mean_3d": three(background, method=BG_RANSAC_MEAN),
        "background_ransac_median_3d": three(background, method=BG_RANSAC_MEDIAN),
        "localize_lsq": partial(localized, **lsq), "localize_lsq_3d": three(localized, **lsq),
        "localize_lsq_background": partial(localized, background=BG_MEAN, **lsq),
        "localize_ransac": partial(localized, inlier_ratio=0.0), "localize_ransac_3d": three(localized, inlier_ratio=0.0),
        "ransac_inlier_ratio": partial(localized, inlier_ratio=0.6),
        "ransac_inlier_ratio_3d": three(localized, inlier_ratio=0.2),
        "localize_multiconsensus": partial(localized, **MULTI[2]), "localize_multiconsensus_3d": three(localized, **MULTI[3]),
        "detect_blocks_multiconsensus": partial(detected, **MULTI[2]),
        "multiconsensus_filter": multiconsensus_filter,
        "spot_intensity": partial(detected, relational=True, **lsq),
        "spot_intensity_3d": three(detected, relational=True, **lsq),
        "intensity_threshold": partial(detected, relational=True, intensity_threshold=15000.0, **lsq),
        "detect_blocks": detected, "detect_blocks_3d": three(detected),
        "detect_blocks_lsq": partial(detected, **lsq), "detect_blocks_lsq_3d": three(detected, **lsq),
        "detect_blocks_background_3d": three(detected, background=BG_MEDIAN, **lsq),
        "detect_images": partial(detected, whole=True), "detect_images_3d": three(detected, whole=True),
        "spots_nearest": spots_nearest, "spots_unmatched": spots_unmatched, "sort_spots": sort_spots,
        "pending_inputs": pending_inputs, "accepted_inputs": accepted_inputs,
        "listing_funnel": on_listing(lambda t: worklist.funnel(t, "data/src1", ".tif")),
        "nonzero_outputs": on_listing(lambda t: worklist.nonzero(t, "data/src1", ".tif")),
        "spots_per_block": spots_per_block, "spots_per_block_3d": three(spots_per_block),
        "spots_per_image": spots_per_image, "spots_total": spots_total, "spots_total_3d": three(spots_total),
        "chunk_manifest": chunk_manifest, "merge_blocks": merge_blocks,
        "poll_delta": poll_delta, "stream_output_count": stream_output_count,
        "poll_delta_minute": partial(poll_delta, interval="1 minute"), "stream_output_count_minute": partial(stream_output_count, interval="1 minute"),
        "stream_incremental_detect": stream_incremental_detect, "stream_every_image": stream_every_image, "task_durations": task_durations,
        "scan_chunks_named": scan_chunks_named, "read_dataset_attributes": read_dataset_attributes, "write_every_image": write_every_image,
        "write_manifest_single": write_manifest_single, "udtf_split_blocks_3d": udtf_split_blocks_3d,
        "detect_images_auto": partial(detected, whole=True, max_intensity=0.0),
        "detect_in_place": detected_in_place, "detect_in_place_3d": three(detected_in_place),
        "detect_in_place_crop": partial(detected_in_place, max_intensity=0.0, crop_min=CROP[2][0], crop_max=CROP[2][1]),
        "detect_images_auto_crop": detected_in_crop, "detect_images_auto_crop_3d": three(detected_in_crop),
    }
