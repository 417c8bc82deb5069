"""Explicit schemas: nothing is inferred from data."""

from __future__ import annotations

# Columns of the statement files, in file order.
STATEMENT_FILE = """
    id string, label string, statement string, subject string, speaker string, job_title string,
    state_info string, party string, barely_true_counts double, false_counts double, half_true_counts double,
    mostly_true_counts double, pants_on_fire_counts double, context string
"""

# What a statement file may write for a missing value.
MISSING_MARKS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)

HISTORY = "struct<barely_true: int, `false`: int, half_true: int, mostly_true: int, pants_on_fire: int>"

STATEMENT = f"""
    id string, split string, raw_text string, processed_text string, original_label string, label string,
    metadata struct<id: string, subject: string, speaker: string, speaker_job: string, state: string,
        party: string, context: string, speaker_history: {HISTORY}, total_statements: int,
        reliability_score: double>,
    position struct<file: string, block: bigint, row: bigint>
"""

THREAD = """
    id string, event string, raw_text string, processed_text string, label string, reactions array<string>,
    reaction_count bigint, is_rumor boolean,
    metadata struct<
        user: struct<id: string, screen_name: string, verified: boolean, followers_count: bigint,
            friends_count: bigint, statuses_count: bigint, created_at: string>,
        tweet: struct<id: string, created_at: string, retweet_count: bigint, favorite_count: bigint,
            lang: string, has_media: boolean>,
        urls: array<string>, hashtags: array<string>, event: string, rumor_id: string, non_rumor_id: string,
        reaction_count: bigint, is_rumor: boolean>,
    position string
"""

ARTICLE = """
    id string, source string, raw_text string, processed_text string, original_label string, label string,
    metadata struct<source: string, label: string, article_id: string, title: string, url: string,
        date_published: string, authors: array<string>, image_urls: array<string>, image_count: int,
        keywords: array<string>, description: string, tweet_count: bigint>,
    position string
"""

# Image lists with tab-separated lines.
IMAGE_LIST = ("image_id", "image_url", "annotation", "event")
TWEET_IMAGES = ("tweet_id", "image_id", "annotation", "event")

IMAGE_MANIFEST = """
    source string, label string, article_id string, image_count bigint, images array<string>, content_file string
"""

EXIF_TYPE = "map<string, string>"
PIXELS = "path string, height int, width int, pixels binary"
DECODED = f"path string, modified timestamp, width int, height int, exif {EXIF_TYPE}, pixels binary"

_IMAGE = f"""
    original_path string, processed_path string, original_size array<int>, aspect_ratio double, format string,
    exif {EXIF_TYPE}
"""
LISTED_IMAGE = f"""
    image_id string, annotation string, event string, image_url string, {_IMAGE}, tweet_count bigint,
    tweet_ids array<string>
"""
ARTICLE_IMAGE = f"""
    source string, label string, article_id string, original_filename string, content_file string, {_IMAGE}
"""

METADATA = """
    dataset string, id string, source string, label string, original_label string, has_text boolean,
    has_images boolean
"""
