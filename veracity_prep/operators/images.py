"""Image jobs: geometry, resampling to a fixed size and EXIF tags."""

from __future__ import annotations

import sys

from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veracity_prep.functions.scores import aspect_ratio
from veracity_prep.functions.urls import format_name
from veracity_prep.options import ImageOptions
from veracity_prep.schemas import EXIF_TYPE, PIXELS

# Tasks receive the functions of this module by value, so executors need no installed copy.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# EXIF tag number -> name, in the main and in the detail directory, and the pointers to the latter.
MAIN_TAGS = {0x010F: "Make", 0x0110: "Model", 0x0131: "Software"}
DETAIL_TAGS = {0x9003: "DateTime"}
DETAIL_POINTER = 0x8769
GPS_POINTER = 0x8825


def image_geometry(images: DataFrame) -> DataFrame:
    """``path, width, height, aspect_ratio, format`` of decoded images; undecodable ones are dropped."""
    valid = images.where((F.col("image.width") > 0) & (F.col("image.height") > 0))
    width, height = F.col("image.width"), F.col("image.height")
    return valid.select(
        F.col("image.origin").alias("path"),
        width.alias("width"),
        height.alias("height"),
        aspect_ratio(width, height).alias("aspect_ratio"),
        format_name(F.col("image.origin")).alias("format"),
    )


def lanczos_weights(size: int, target: int):
    """For each output position the first input position and the fixed-point weights of a 3-lobed Lanczos filter."""
    import numpy as np

    scale = size / target
    stretch = max(scale, 1.0)
    radius = 3.0 * stretch
    out = []
    for i in range(target):
        centre = (i + 0.5) * scale
        low = max(int(centre - radius + 0.5), 0)
        high = min(int(centre + radius + 0.5), size)
        x = (np.arange(low, high) - centre + 0.5) / stretch
        w = np.where(np.abs(x) < 3.0, np.sinc(x) * np.sinc(x / 3.0), 0.0)
        w = w / w.sum()
        out.append((low, np.trunc(w * (1 << 22) + np.copysign(0.5, w))))
    return out


def _resample_axis(pixels, target: int, known: dict):
    """Resample the first axis of a float array of whole numbers, with rounding to 8 bits; ``known`` keeps weights of sizes."""
    import numpy as np

    size = pixels.shape[0]
    if (size, target) not in known:
        if len(known) >= 64:
            known.clear()
        known[size, target] = lanczos_weights(size, target)
    rows = np.ascontiguousarray(pixels).reshape(size, -1)
    out = np.empty((target, rows.shape[1]))
    for i, (low, w) in enumerate(known[size, target]):
        np.dot(w, rows[low : low + len(w)], out=out[i])
    # Sums stay below 2**53, so this is exact integer arithmetic.
    return np.clip(np.floor((out + (1 << 21)) / (1 << 22)), 0, 255).reshape(target, *pixels.shape[1:])


def resample_pixels(data: bytes, height: int, width: int, channels: int, target: tuple[int, int], known: dict | None = None) -> bytes:
    """RGB bytes of size ``target`` (width, height) from rows of gray, BGR or BGRA bytes; alpha is dropped.

    ``known`` keeps the weights of sizes from one image to the next.
    """
    import numpy as np

    known = {} if known is None else known

    pixels = np.frombuffer(data, np.uint8, height * width * channels).reshape(height, width, channels)
    rgb = pixels[:, :, [0, 0, 0]] if channels == 1 else pixels[:, :, 2::-1]
    columns = _resample_axis(rgb.astype(float).transpose(1, 0, 2), target[0], known)
    rows = _resample_axis(columns.transpose(1, 0, 2), target[1], known)
    return rows.astype(np.uint8).tobytes()


def resample_images(images: DataFrame, options: ImageOptions | None = None) -> DataFrame:
    """``path, height, width, pixels``: every decodable image as RGB bytes of the configured size.

    Map-only. Spark cuts the Arrow batches of large rows by bytes (64 MB unless configured), and one image is
    resampled at a time.
    """
    target = (options or ImageOptions()).resize

    def run(batches):
        import pyarrow as pa

        schema = pa.schema(
            [("path", pa.string()), ("height", pa.int32()), ("width", pa.int32()), ("pixels", pa.binary())]
        )
        known = {}
        for batch in batches:
            for i in range(batch.num_rows):
                path, height, width, channels, data = (column[i] for column in batch.columns)
                pixels = resample_pixels(data.as_buffer(), height.as_py(), width.as_py(), channels.as_py(), target, known)
                yield pa.RecordBatch.from_arrays([[path.as_py()], [target[1]], [target[0]], [pixels]], schema=schema)

    decoded = images.where((F.col("image.width") > 0) & (F.col("image.height") > 0)).select(
        F.col("image.origin").alias("path"),
        F.col("image.height").alias("height"),
        F.col("image.width").alias("width"),
        F.col("image.nChannels").alias("channels"),
        F.col("image.data").alias("data"),
    )
    return decoded.mapInArrow(run, PIXELS)


def decoded_images(images: DataFrame, options: ImageOptions | None = None) -> DataFrame:
    """Size and resampled pixels of images from one decoding: ``path, width, height, pixels``.

    A file that can't be decoded keeps its row, with width -1 and without pixels.
    """
    target = (options or ImageOptions()).resize

    def run(batches):
        import pyarrow as pa

        schema = pa.schema([("path", pa.string()), ("width", pa.int32()), ("height", pa.int32()), ("pixels", pa.binary())])
        known = {}
        for batch in batches:
            for i in range(batch.num_rows):
                path, height, width, channels, data = (column[i] for column in batch.columns)
                size, pixels = (width.as_py(), height.as_py()), None
                if min(size) > 0:
                    pixels = resample_pixels(data.as_buffer(), size[1], size[0], channels.as_py(), target, known)
                yield pa.RecordBatch.from_arrays([[path.as_py()], [size[0]], [size[1]], [pixels]], schema=schema)

    fields = [F.col(f"image.{c}").alias(c) for c in ("origin", "height", "width", "nChannels", "data")]
    return images.select(*fields).mapInArrow(run, "path string, width int, height int, pixels binary")


def _entries(tiff: bytes, order: str, at: int) -> dict[int, tuple[int, int, bytes]]:
    """Tag number -> (type, count, value field) of one directory."""
    count = int.from_bytes(tiff[at : at + 2], order)
    out = {}
    for i in range(count):
        e = tiff[at + 2 + 12 * i : at + 14 + 12 * i]
        if len(e) == 12:
            out[int.from_bytes(e[:2], order)] = (int.from_bytes(e[2:4], order), int.from_bytes(e[4:8], order), e[8:])
    return out


def _ascii(tiff: bytes, order: str, entry: tuple[int, int, bytes]) -> str | None:
    kind, count, value = entry
    if kind != 2:
        return None
    if count > 4:
        start = int.from_bytes(value, order)
        value = tiff[start : start + count]
    return value[:count].split(b"\0")[0].decode("utf-8", "replace").strip()


def exif_tags(content: bytes) -> dict[str, str]:
    """DateTime, Make, Model, Software and GPSInfo of a JPEG; empty when there are none or they cannot be read."""
    if content[:2] != b"\xff\xd8":
        return {}
    at, tiff = 2, b""
    while at + 4 <= len(content) and content[at] == 0xFF and content[at + 1] != 0xDA:
        size = int.from_bytes(content[at + 2 : at + 4], "big")
        if content[at + 1] == 0xE1 and content[at + 4 : at + 10] == b"Exif\0\0":
            tiff = content[at + 10 : at + 2 + size]
            break
        at += 2 + size
    order = {b"II": "little", b"MM": "big"}.get(tiff[:2])
    if order is None:
        return {}
    main = _entries(tiff, order, int.from_bytes(tiff[4:8], order))
    found = {name: _ascii(tiff, order, main[tag]) for tag, name in MAIN_TAGS.items() if tag in main}
    if DETAIL_POINTER in main:
        detail = _entries(tiff, order, int.from_bytes(main[DETAIL_POINTER][2], order))
        found |= {name: _ascii(tiff, order, detail[tag]) for tag, name in DETAIL_TAGS.items() if tag in detail}
    if GPS_POINTER in main:
        found["GPSInfo"] = str(int.from_bytes(main[GPS_POINTER][2], order))
    return {k: v for k, v in found.items() if v}


def image_tags(files: DataFrame) -> DataFrame:
    """``path, exif`` from the bytes of image files (``path, content``)."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            contents = batch.column("content")
            tags = [list(exif_tags(c.as_buffer().to_pybytes()).items()) if c.is_valid else [] for c in contents]
            exif = pa.array(tags, pa.map_(pa.string(), pa.string()))
            yield pa.RecordBatch.from_arrays([batch.column("path"), exif], ["path", "exif"])

    return files.select("path", "content").mapInArrow(run, f"path string, exif {EXIF_TYPE}")
