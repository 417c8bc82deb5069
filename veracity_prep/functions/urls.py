"""File names, extensions and image addresses taken from URLs and HTML."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from veracity_prep.functions.text import bind, strip_space


def base_name(path: Column) -> Column:
    """What follows the last slash."""
    return F.substring_index(path, "/", -1)


def extension(name: Column) -> Column:
    """From the last dot of a base name, dot included; dots in front of the name do not count."""
    return F.regexp_extract(name, r"(?s)^\.*[^.].*?(\.[^.]*)\z", 1)


def stem(name: Column) -> Column:
    """A base name without its extension."""
    return F.substring(name, F.lit(1), F.length(name) - F.length(extension(name)))


def format_name(path: Column) -> Column:
    """Lower-case extension without the dot, empty when there is none."""
    return F.substring(F.lower(extension(base_name(path))), F.lit(2), F.length(path))


def extension_or_jpg(url: Column) -> Column:
    """Extension of the last segment of a URL, ``.jpg`` when it has none."""
    ext = extension(base_name(url))
    return F.when(ext == "", ".jpg").otherwise(ext)


def is_http(url: Column) -> Column:
    """True for addresses a download could fetch."""
    return F.coalesce(url.startswith("http://") | url.startswith("https://"), F.lit(False))


def _percent_decode(c: Column) -> Column:
    """Percent-decode as UTF-8; ``+`` and broken escapes stay as they are."""
    safe = F.regexp_replace(c, r"%(?![0-9A-Fa-f]{2})", "%25")
    return F.url_decode(F.replace(safe, F.lit("+"), F.lit("%2B")))


def _url_base(url: Column) -> Column:
    trimmed = F.regexp_replace(F.regexp_replace(url, r"^[\x00-\x20]+", ""), r"[\t\r\n]", "")
    path = F.regexp_extract(trimmed, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)
    without_params = F.regexp_replace(path, r";[^/]*\z", "")
    return base_name(_percent_decode(without_params))


def fallback_name(url: Column) -> Column:
    """Name from a hash of the URL, for addresses that end in no file name."""
    number = F.pmod(F.conv(F.substring(F.md5(url), 1, 8), 16, 10).cast("bigint"), F.lit(10000))
    return F.format_string("image_%04d.jpg", number)


def file_name(url: Column) -> Column:
    """Safe file name for a download: letters, numbers, ``.``, ``_`` and ``-``, stem cut to 95 when over 100."""

    def shortened(safe: Column) -> Column:
        short = F.concat(F.substring(stem(safe), 1, 95), extension(safe))
        return F.when(F.length(safe) > 100, short).otherwise(safe)

    def named(base: Column) -> Column:
        whole = F.when(extension(base) == "", F.concat(base, F.lit(".jpg"))).otherwise(base)
        safe = F.regexp_replace(F.substring_index(whole, "?", 1), r"[^\p{L}\p{N}._\-]", "")
        return F.when(base == "", fallback_name(url)).otherwise(bind(safe, shortened))

    return bind(_url_base(url), named)


def html_image_urls(html: Column) -> Column:
    """The first quoted ``src`` of each ``<img`` segment, except empty and inline ones."""
    segments = F.split(html, "<img", -1)
    tails = F.slice(segments, F.lit(2), F.greatest(F.size(segments) - 1, F.lit(0)))
    found = F.transform(tails, lambda s: strip_space(F.regexp_extract(s, r'src="([^"]*)"', 1)))
    kept = F.filter(found, lambda u: (u != "") & ~u.startswith("data:"))
    return F.coalesce(kept, F.array().cast("array<string>"))


def all_image_urls(images: Column, html: Column, image: Column) -> Column:
    """Distinct addresses from an image list, an HTML text and a single field, in order."""
    none = F.array().cast("array<string>")
    single = F.when(image != "", F.array(image)).otherwise(none)
    return F.array_sort(F.array_distinct(F.concat(F.coalesce(images, none), html_image_urls(html), single)))


def declared_image_urls(images: Column, image: Column) -> Column:
    """The image list followed by the single image, repeats kept."""
    none = F.array().cast("array<string>")
    return F.concat(F.coalesce(images, none), F.when(image != "", F.array(image)).otherwise(none))
