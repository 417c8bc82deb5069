"""Statement corpus: files to processed items."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity_prep.functions.labels import statement_label
from veracity_prep.functions.scores import count_or_zero, reliability_score, speaker_total
from veracity_prep.operators.text import preprocess
from veracity_prep.options import Options
from veracity_prep.sources.statements import read_statements

# History field -> file column.
HISTORY_COLUMNS = {
    "barely_true": "barely_true_counts",
    "false": "false_counts",
    "half_true": "half_true_counts",
    "mostly_true": "mostly_true_counts",
    "pants_on_fire": "pants_on_fire_counts",
}


def build_statements(raw: DataFrame, options: Options | None = None, lexicon: DataFrame | None = None) -> DataFrame:
    """Processed statements from raw rows that carry ``split`` and ``position``.

    The raw rows are dealt out first: they may come from few tasks (files that can't be split, a small side of a join), and
    cleaning them takes far more time than moving them.
    """
    options = options or Options()
    history = {name: count_or_zero(F.col(column)) for name, column in HISTORY_COLUMNS.items()}
    metadata = F.struct(
        "id",
        "subject",
        "speaker",
        F.col("job_title").alias("speaker_job"),
        F.col("state_info").alias("state"),
        "party",
        "context",
        F.struct(*[c.alias(n) for n, c in history.items()]).alias("speaker_history"),
        speaker_total(history).alias("total_statements"),
        reliability_score(history).alias("reliability_score"),
    )
    items = raw.repartition("position", "id").select(
        "id",
        "split",
        F.col("statement").alias("raw_text"),
        F.col("label").alias("original_label"),
        statement_label(F.col("label")).alias("label"),
        metadata.alias("metadata"),
        "position",
    )
    done = preprocess(items, "raw_text", "processed_text", options.text, lexicon, ["position"])
    return done.select(
        "id", "split", "raw_text", "processed_text", "original_label", "label", "metadata", "position"
    )


def load_statements(
    spark: SparkSession,
    path: str,
    options: Options | None = None,
    lexicon: DataFrame | None = None,
    name_glob: str = "*.tsv",
) -> DataFrame:
    """Processed statements of a directory of files."""
    return build_statements(read_statements(spark, path, name_glob=name_glob), options, lexicon)
