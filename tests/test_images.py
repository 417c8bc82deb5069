"""Image scans and jobs."""

import math
import os
import random

import numpy as np
from pyspark.sql import functions as F
from trees import article_images, images, jpeg_with_tags, png, write

from veracity_prep.operators.images import exif_tags, image_tags, resample_images, resample_pixels
from veracity_prep.options import ImageOptions
from veracity_prep.plans.image_corpora import inventory_keys, listed_image_plan, load_article_images, load_listed_images, pixels_of
from veracity_prep.sources.images import image_paths, path_batches, read_image_list, read_images, read_manifest
from veracity_prep.sources.processed import image_summary


def test_listed_images(spark, tmp_path):
    done = load_listed_images(spark, str(images(tmp_path)), "/out").records
    rows = {r["image_id"]: r for r in done.collect()}
    # i2 is broken, i4 has no file, i9 has an upper-case extension, i5 is of another class.
    assert set(rows) == {"i1", "i3"}
    one = rows["i1"]
    assert (one["annotation"], one["event"], one["image_url"], one["format"]) == ("fake", "e1", "http://x/1", "png")
    assert (one["original_size"], one["aspect_ratio"], one["processed_path"]) == ([4, 2], 2.0, "/out/fake/i1.png")
    assert (sorted(one["tweet_ids"]), one["tweet_count"], one["exif"]) == (["t1", "t2"], 2, {})
    assert (rows["i3"]["original_size"], rows["i3"]["tweet_ids"], rows["i3"]["tweet_count"]) == ([3, 9], None, None)
    summary = {r["image_id"]: tuple(r)[1:] for r in image_summary(done, "image_id").collect()}
    assert summary["i3"] == ("/out/real/i3.png", "3x9", "0.33", False)


def test_list_in_raw_directory_wins(spark, tmp_path):
    root = images(tmp_path)
    (root / "raw").mkdir()
    (root / "raw" / "set_images.txt").write_text("i1\thttp://x/raw\tfake\te1\n")
    rows = load_listed_images(spark, str(root), "/out").records.collect()
    assert [r["image_url"] for r in rows] == ["http://x/raw"]


def test_article_images(spark, tmp_path):
    root = article_images(tmp_path)
    rows = load_article_images(spark, str(root), read_manifest(spark, str(root / "metadata" / "list.json")), "/out").records.collect()
    assert [(r["article_id"], r["original_filename"], r["original_size"], r["content_file"]) for r in rows] == [("g-1", "a.png", [4, 2], "c")]
    assert rows[0]["processed_path"] == "/out/gossipcop/fake/g-1_a.png"
    keys = inventory_keys(image_paths(spark, str(root / "images")))
    assert {tuple(r) for r in keys.collect()} == {("gossipcop", "fake", "g-1", "a.png"), ("gossipcop", "fake", "g-1", "b.png")}


def test_fetch_plan(spark, tmp_path):
    listed = read_image_list(spark, str(images(tmp_path) / "set_images.txt"))
    there = spark.createDataFrame([("/o/fake/i1.jpg",)], "path string")
    plan = {r["image_id"]: (r["bucket"], r["target"]) for r in listed_image_plan(listed, "/o", there).collect()}
    assert set(plan) == {"i2", "i3", "i4", "i5", "i9"}
    assert plan["i5"] == ("unknown", "/o/unknown/i5.jpg")


def lanczos(x):
    return 0.0 if abs(x) >= 3 else 1.0 if x == 0 else math.sin(math.pi * x) * math.sin(math.pi * x / 3) * 3 / (math.pi * x) ** 2


def brute_axis(values, target):
    """One channel of one line, by the definition of the filter."""
    n = len(values)
    scale = n / target
    stretch = max(scale, 1.0)
    out = []
    for i in range(target):
        centre = (i + 0.5) * scale
        low, high = max(int(centre - 3 * stretch + 0.5), 0), min(int(centre + 3 * stretch + 0.5), n)
        weights = [lanczos((k - centre + 0.5) / stretch) for k in range(low, high)]
        total = sum(weights)
        fixed = [int(math.copysign(abs(w / total) * (1 << 22) + 0.5, w)) for w in weights]
        out.append(min(max((sum(f * v for f, v in zip(fixed, values[low:high], strict=True)) + (1 << 21)) >> 22, 0), 255))
    return out


def test_resampling_against_definition():
    rnd = random.Random(5)
    for width, height, channels, target in ((7, 5, 3, (4, 3)), (3, 4, 4, (6, 9)), (9, 2, 1, (9, 2)), (20, 31, 3, (5, 5))):
        data = bytes(rnd.randrange(256) for _ in range(width * height * channels))
        got = np.frombuffer(resample_pixels(data, height, width, channels, target), np.uint8).reshape(target[1], target[0], 3)
        pixel = np.frombuffer(data, np.uint8).reshape(height, width, channels)
        for c in range(3):
            plane = pixel[:, :, 0 if channels == 1 else 2 - c].tolist()
            lines = [brute_axis(line, target[0]) for line in plane]
            columns = [brute_axis([line[x] for line in lines], target[1]) for x in range(target[0])]
            assert got[:, :, c].T.tolist() == columns


def test_pixels_of_files(spark, tmp_path):
    root = images(tmp_path)
    rows = resample_images(read_images(spark, str(root / "images")), ImageOptions(resize=(2, 2))).collect()
    got = {r["path"].rsplit("/", 2)[1] + "/" + r["path"].rsplit("/", 1)[1]: (r["height"], r["width"], bytes(r["pixels"])) for r in rows}
    red, blue = bytes([255, 0, 0]) * 4, bytes([0, 0, 255]) * 4
    assert got == {"fake/i1.png": (2, 2, red), "real/i1.png": (2, 2, red), "real/i3.png": (2, 2, blue)}


def test_odd_names_and_broken_winners(spark, tmp_path):
    good, names = png(2, 1, bytes([255, 0, 0] * 2)), ["a b", "50%", "x+y", "n#1", "50%25", "q?", "[ab]", "{c,d}", "star*"]
    for name in names:
        write(tmp_path / "images" / "fake" / f"{name}.png", good)
    write(tmp_path / "images" / "fake" / "d.jpeg", good)
    write(tmp_path / "images" / "fake" / "d.png", b"broken")  # the later extension wins, then fails
    write(tmp_path / "images" / "fake" / "unlisted.png", good)
    write(tmp_path / "set_images.txt", "".join(f"{n}\thttp://x.org/a.png\tfake\tev\n" for n in [*names, "d"]))
    records, decoded = load_listed_images(spark, str(tmp_path), "/out", options=ImageOptions(resize=(1, 1)))
    rows = {r["image_id"]: r for r in records.collect()}
    assert set(rows) == set(names)
    assert {r["original_path"] for r in rows.values()} == {f"{tmp_path}/images/fake/{n}.png" for n in names}
    pixels = pixels_of(records, decoded, ImageOptions(resize=(1, 1)))
    assert {tuple(r)[1:] for r in pixels.collect()} == {(1, 1, bytes([255, 0, 0]))}
    assert {r["processed_path"] for r in pixels.collect()} == {r["processed_path"] for r in rows.values()}


def unread(path):
    """Whether a file was left closed since its access time was set back."""
    return os.stat(path).st_atime < 1_000_000


def test_only_wanted_files_are_opened(spark, tmp_path):
    root, table = images(tmp_path / "raw"), str(tmp_path / "table")
    write(root / "images" / "fake" / "unlisted.png", png(2, 1, bytes(6)))
    write(root / "images" / "fake" / "i5.png", png(2, 1, bytes(6)))  # listed under another class
    files = [p for p in (root / "images").rglob("*.*") if p.suffix != ".crc"]

    def load():
        for f in files:
            os.utime(f, (500_000, os.stat(f).st_mtime))
        records, decoded = load_listed_images(spark, str(root), "/out", table=table, options=ImageOptions(resize=(2, 2)))
        found = {(r["original_path"].split("/images/")[1], r["format"]) for r in records.collect()}
        assert pixels_of(records, decoded, ImageOptions(resize=(2, 2))).where("octet_length(pixels) = 12").count() == len(found)
        return found, {str(f).split("/images/")[1] for f in files if not unread(f)}

    # i1.png wins over i1.jpg; i2 is broken, but only opening tells.
    first = {("fake/i1.png", "png"), ("real/i3.png", "png")}
    found, opened = load()
    assert found == first and opened == {"fake/i1.png", "fake/i2.png", "real/i3.png"}
    assert load() == (first, set())
    write(root / "images" / "fake" / "i2.png", png(2, 1, bytes(6)))
    found, opened = load()
    assert found == first | {("fake/i2.png", "png")} and opened == {"fake/i2.png"}


def test_batches_of_paths(spark):
    paths = spark.range(1000).select(F.concat(F.lit("/p/"), "id").alias("path"))
    batches = list(path_batches(paths, 100))
    assert len(batches) == 10 and sorted(p for b in batches for p in b) == sorted(f"/p/{i}" for i in range(1000))
    assert list(path_batches(paths.limit(0))) == []


def test_tags():
    for order in ("big", "little"):
        assert exif_tags(jpeg_with_tags(order)) == {"Make": "Cam", "Software": "Editor 1.0", "DateTime": "2020:01:02 03:04:05", "GPSInfo": "999"}
    whole = jpeg_with_tags("big")
    for end in range(len(whole)):
        exif_tags(whole[:end])
    assert exif_tags(b"") == exif_tags(b"\xff\xd8\xff\xe1") == exif_tags(png(1, 1, b"abc")) == {}


def test_tag_job(spark):
    df = spark.createDataFrame([("a", jpeg_with_tags("big")), ("b", b"x"), ("c", None)], "path string, content binary")
    rows = {r["path"]: r["exif"] for r in image_tags(df).collect()}
    assert rows["a"]["Make"] == "Cam" and rows["b"] == rows["c"] == {}
    assert image_tags(df).select(F.size("exif")).schema.fields[0].dataType.typeName() == "integer"


def test_weights_of_a_size_are_made_once(monkeypatch):
    from veracity_prep.operators import images

    made, plain = [], images.lanczos_weights
    monkeypatch.setattr(images, "lanczos_weights", lambda size, target: made.append((size, target)) or plain(size, target))
    known = {}
    for k in range(5):
        images.resample_pixels(bytes(range(k, k + 60)), 4, 5, 3, (7, 9), known)
    assert sorted(made) == [(4, 9), (5, 7)]
