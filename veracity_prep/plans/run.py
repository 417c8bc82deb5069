"""The whole preparation in stages, and the registry of text corpora."""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity_prep import schemas
from veracity_prep.operators.metadata import article_image_links
from veracity_prep.operators.splits import fold_report, make_splits, split_report
from veracity_prep.operators.stats import dataset_statistics, part_counts, thread_counts
from veracity_prep.options import Options
from veracity_prep.plans.articles import article_image_plan, article_image_urls, build_articles, load_articles, rejected_articles
from veracity_prep.plans.image_corpora import (
    IMAGE_LIST_FILE,
    TWEET_LIST_FILE,
    article_manifest,
    image_tweets,
    inventory_keys,
    list_candidates,
    listed_image_plan,
    load_article_images,
    load_listed_images,
    pixels_of,
    plain_root,
)
from veracity_prep.plans.integrate import ARTICLES, IMAGES, TEXT_KEYS, build_metadata, integrate, simplify
from veracity_prep.plans.ledger import commit, fingerprint, is_done
from veracity_prep.plans.statements import load_statements
from veracity_prep.plans.threads import build_threads, load_threads, rejected_threads
from veracity_prep.sources.articles import compact_articles
from veracity_prep.sources.images import image_paths, read_image_list, read_manifest, read_tweet_images
from veracity_prep.sources.processed import (
    image_summary,
    read_buckets,
    read_existing,
    read_table,
    write_buckets,
    write_counted,
    write_table,
)
from veracity_prep.sources.threads import compact_threads

STAGES = ("text", "fetches", "images", "metadata", "splits")


@dataclass(frozen=True)
class Corpus:
    """A text corpus: how to load it from a path, how its table is partitioned, and its schema.

    A corpus of many small files also has ``compact``, which brings a table of them up to date and returns its files by
    role, and ``build``, which makes the corpus from those. :func:`run` then reads new files only. ``rejected`` names the
    files that yield no item, and ``counts`` are aggregates over the items; both are reported.
    """

    load: Callable[..., DataFrame]
    parts: tuple[str, ...] = ()
    schema: str = ""
    compact: Callable[[SparkSession, str, str], Any] | None = None
    build: Callable[..., DataFrame] | None = None
    rejected: Callable[[Any], DataFrame] | None = None
    counts: Callable[[], list[Column]] = list


CORPORA: dict[str, Corpus] = {}


def register_corpus(name: str, corpus: Corpus) -> None:
    """Make a corpus known to :func:`run`.

    Its loader takes ``(spark, path, options, lexicon)`` and returns at least ``id, label, raw_text,
    processed_text, position``; metadata, statistics, integration and splits then cover it unchanged.
    """
    CORPORA[name] = corpus


register_corpus("statements", Corpus(load_statements, ("split",), schemas.STATEMENT))
register_corpus(
    "threads",
    Corpus(load_threads, ("event",), schemas.THREAD, compact_threads, build_threads, rejected_threads, thread_counts),
)
register_corpus(
    ARTICLES,
    Corpus(
        load_articles, ("source", "original_label"), schemas.ARTICLE, compact_articles, build_articles, rejected_articles
    ),
)


@dataclass(frozen=True)
class Paths:
    """Where inputs lie and outputs go. ``corpora`` maps corpus names to their raw directories.

    ``article_manifest`` is a JSON array; without one, the manifest of the stage ``fetches`` is used.
    """

    output: str
    corpora: dict[str, str]
    listed_images: str | None = None
    article_images: str | None = None
    article_manifest: str | None = None

    def table(self, *names: str) -> str:
        return "/".join([self.output, *names])


def _write_text(spark: SparkSession, paths: Paths, options: Options, lexicon: DataFrame | None) -> None:
    for name, path in paths.corpora.items():
        corpus = CORPORA[name]
        if corpus.compact and corpus.build:
            files = corpus.compact(spark, path, paths.table("files", name))
            items = corpus.build(files, options, lexicon)
            if corpus.rejected:
                write_table(corpus.rejected(files), paths.table("reports", "rejected", name))
        else:
            items = corpus.load(spark, path, options, lexicon)
        counts = [F.count(F.lit(1)).alias("items"), *corpus.counts()]
        report = write_counted(items, paths.table("text", name), *corpus.parts, counts=counts)
        write_table(report, paths.table("reports", "items", name))
        if corpus.parts:
            done = part_counts(read_existing(spark, paths.table("text", name)), *corpus.parts)
            write_table(done, paths.table("reports", "parts", name))


def _write_fetches(spark: SparkSession, paths: Paths, options: Options) -> None:
    if paths.listed_images:
        listed = read_image_list(spark, *list_candidates(paths.listed_images, IMAGE_LIST_FILE))
        root = f"{paths.listed_images}/images"
        write_table(listed, paths.table("fetches", "image_list"), fmt="csv")
        plan = listed_image_plan(listed, plain_root(root), image_paths(spark, root))
        write_table(plan, paths.table("fetches", "images"), "bucket")
    if paths.article_images and ARTICLES in paths.corpora:
        contents = compact_articles(spark, paths.corpora[ARTICLES], paths.table("files", ARTICLES)).contents
        root = f"{paths.article_images}/images"
        there = image_paths(spark, root)
        plan = article_image_plan(article_image_urls(contents), plain_root(root), there)
        write_table(plan, paths.table("fetches", "article_images"))
        place = F.concat_ws("/", F.lit(paths.corpora[ARTICLES]), "source", "label", "article_id", "file")
        manifest = article_manifest(inventory_keys(there), contents.withColumn("content_file", place), options.list_rows)
        write_table(manifest, paths.table("fetches", "article_manifest"), fmt="json")


def _write_images(spark: SparkSession, paths: Paths, options: Options) -> None:
    if paths.listed_images:
        table = paths.table("images", IMAGES)
        processed = paths.table("images", "pixels")
        mapping = read_tweet_images(spark, *list_candidates(paths.listed_images, TWEET_LIST_FILE))
        write_table(image_tweets(mapping, options.list_rows), paths.table("images", "tweets"))
        tweets = read_existing(spark, paths.table("images", "tweets"))
        kept = paths.table("files", IMAGES)
        loaded = load_listed_images(spark, paths.listed_images, processed, tweets, kept, options.image)
        write_table(loaded.records, table)
        done = read_existing(spark, table)
        summary = image_summary(done, "image_id", "annotation", "event")
        write_table(summary, paths.table("images", "summary", IMAGES), fmt="csv")
        write_table(pixels_of(done, loaded.decoded, options.image), paths.table("images", "pixels", IMAGES))
    if paths.article_images:
        # Without a manifest of its own, the corpus has the one written from what is on disk.
        own = paths.article_manifest is not None
        entries = paths.article_manifest if own else paths.table("fetches", "article_manifest")
        manifest = read_manifest(spark, entries, lines=not own)
        table = paths.table("images", ARTICLES)
        processed = paths.table("images", "pixels")
        kept = paths.table("files", "article_images")
        loaded = load_article_images(spark, paths.article_images, manifest, processed, kept, options.image)
        write_table(loaded.records, table)
        ids = ("source", "label", "article_id", "original_filename")
        done = read_existing(spark, table)
        summary = image_summary(done, *ids)
        write_table(summary, paths.table("images", "summary", ARTICLES), fmt="csv")
        write_table(pixels_of(done, loaded.decoded, options.image), paths.table("images", "pixels", ARTICLES))


def _text_tables(spark: SparkSession, paths: Paths) -> dict[str, DataFrame]:
    out = {}
    for name in paths.corpora:
        schema = CORPORA[name].schema
        table = paths.table("text", name)
        out[name] = read_table(spark, table, schema) if schema else read_existing(spark, table)
    return out


def _write_metadata(spark: SparkSession, paths: Paths, options: Options) -> None:
    corpora = _text_tables(spark, paths)
    images = read_table(spark, paths.table("images", IMAGES), schemas.LISTED_IMAGE)
    article_images = read_table(spark, paths.table("images", ARTICLES), schemas.ARTICLE_IMAGE)
    write_table(article_image_links(article_images, options.list_rows), paths.table("metadata", "article_image_links"))
    links = read_existing(spark, paths.table("metadata", "article_image_links"))
    tables = build_metadata(corpora, links, spark)
    for name, metadata in tables.by_corpus.items():
        write_table(metadata, paths.table("metadata", "corpora", name), fmt="csv")
    write_table(tables.combined, paths.table("metadata", "combined"), "dataset")
    combined = read_existing(spark, paths.table("metadata", "combined"))
    write_table(dataset_statistics(combined), paths.table("metadata", "statistics"))

    buckets = options.buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    integrated = integrate(combined, corpora, images, article_images, options.list_rows, buckets)
    texts = paths.table("integrated", "texts")
    write_buckets(integrated.texts, texts, TEXT_KEYS, buckets)
    write_table(integrated.images, paths.table("integrated", "images"))
    write_table(integrated.article_images, paths.table("integrated", "article_images"))
    integrated = integrated._replace(
        texts=read_buckets(spark, texts, TEXT_KEYS, buckets),
        article_images=read_existing(spark, paths.table("integrated", "article_images")),
    )
    write_table(simplify(integrated), paths.table("integrated", "simplified"), "dataset")


def _write_splits(spark: SparkSession, paths: Paths, options: Options) -> None:
    metadata = read_existing(spark, paths.table("metadata", "combined"))
    for name, split in make_splits(metadata, options.split).items():
        folds = name == "folds"
        write_table(split, paths.table("splits", name), "fold" if folds else "split")
        done = read_existing(spark, paths.table("splits", name))
        if folds:
            write_table(fold_report(done), paths.table("reports", "splits", name))
            continue
        for by in ("label", "source"):
            if by in done.columns:
                write_table(split_report(done, by), paths.table("reports", "splits", name, by))


def _inputs(paths: Paths, options: Options, stage: str) -> tuple[list[str], object]:
    """Roots a stage reads, and the settings it depends on."""
    images = [p for p in (paths.listed_images, paths.article_images) if p]
    own = [paths.article_manifest] if paths.article_manifest else [paths.table("fetches", "article_manifest")]
    articles = [paths.corpora[ARTICLES]] if ARTICLES in paths.corpora else []
    of_stage = {
        "text": ([*paths.corpora.values()], (options.text, options.reaction_cut)),
        "fetches": ([*images, *articles], options.list_rows),
        "images": ([*images, *own], (options.image, options.list_rows)),
        "metadata": ([paths.table("text"), paths.table("images")], (options.list_rows, options.buckets)),
        "splits": ([paths.table("metadata", "combined")], options.split),
    }
    roots, settings = of_stage[stage]
    return roots, (paths, settings)


def run(
    spark: SparkSession,
    paths: Paths,
    options: Options | None = None,
    stages: Iterable[str] = ("all",),
    lexicon: DataFrame | None = None,
    resume: bool = False,
) -> list[str]:
    """Run the chosen stages (``all`` for every one) and return those that had work to do.

    Each stage reads what the one before it wrote, and is noted in the table ``ledger`` with a fingerprint of its inputs
    once it is finished. With ``resume`` a stage whose inputs and settings are those of its last finish is skipped.
    """
    options = options or Options()
    wanted = set(STAGES) if "all" in (chosen := set(stages)) else chosen
    if unknown := wanted - set(STAGES):
        raise ValueError(f"unknown stages: {sorted(unknown)}")
    work = {
        "text": lambda: _write_text(spark, paths, options, lexicon),
        "fetches": lambda: _write_fetches(spark, paths, options),
        "images": lambda: _write_images(spark, paths, options),
        "metadata": lambda: _write_metadata(spark, paths, options),
        "splits": lambda: _write_splits(spark, paths, options),
    }
    done = []
    for stage in (s for s in STAGES if s in wanted):
        tables = [lexicon] if stage == "text" and lexicon is not None else []
        mark, files = fingerprint(spark, *_inputs(paths, options, stage), tables)
        if resume and is_done(spark, paths.table("ledger"), stage, mark):
            continue
        work[stage]()
        commit(spark, paths.table("ledger"), stage, mark, files)
        done.append(stage)
    return done
