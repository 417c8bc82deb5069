"""Statement files: tab-separated, 14 columns, no header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veracity_prep.schemas import MISSING_MARKS, STATEMENT_FILE
from veracity_prep.sources.files import or_empty


def read_statements(
    spark: SparkSession, path: str, strict_quotes: bool = False, name_glob: str = "*.tsv"
) -> DataFrame:
    """The statement files of a directory, with ``split`` (the file stem) and ``position``.

    By default a line is a record, so files are split over tasks and an unbalanced leading quote damages one
    record only. ``strict_quotes`` lets quotes span lines.
    """

    def scan() -> DataFrame:
        return (
            spark.read.schema(STATEMENT_FILE)
            .options(sep="\t", quote='"', escape='"', multiLine=strict_quotes, pathGlobFilter=name_glob)
            .csv(path)
            .select(
                "*",
                F.regexp_extract("_metadata.file_name", r"^(.*)\.[^.]*$", 1).alias("split"),
                # Blocks of a file are ordered, and so are the rows that one task reads from a block.
                F.struct(
                    F.col("_metadata.file_path").alias("file"),
                    F.col("_metadata.file_block_start").alias("block"),
                    F.monotonically_increasing_id().alias("row"),
                ).alias("position"),
            )
        )

    schema = f"{STATEMENT_FILE}, split string, position struct<file: string, block: bigint, row: bigint>"
    raw = or_empty(spark, scan, schema)
    texts = [f.name for f in raw.schema.fields if f.dataType.typeName() == "string" and f.name != "split"]
    return raw.withColumns({c: F.when(~F.col(c).isin(*MISSING_MARKS), F.col(c)) for c in texts})
