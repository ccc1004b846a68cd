"""Readers and writers.

Formats are parameters: match documents may be Parquet or JSON, or any
format whose connector is on the classpath (``fmt`` + ``options``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from playlog import schemas
from playlog.functions.scalars import FIELD_SEP

# Roster file layout: tab-separated; column 1 is the name as written in the log,
# column 2 the full name, column 4 the team code; columns 0 and 3 are unused.
ROSTER_NAME_FIELD = 1
ROSTER_TRUE_NAME_FIELD = 2
ROSTER_TEAM_FIELD = 4


def read_play_log(spark: SparkSession, path: str | list[str], with_source: bool = False) -> DataFrame:
    """SRC-2: one row per log line (``value``); ``with_source`` adds the file it came from."""
    df = spark.read.text(path)
    return df.select("value", F.col("_metadata.file_path").alias("source_file")) if with_source else df


def read_ordered_log(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """SRC-2 with each line's physical place: ``value``, ``log_split`` (file name
    and first byte of the input split, comparable as text) and ``log_row`` (grows
    along the lines of a split).

    (log_split, log_row) orders all lines as the files hold them, files by name.
    A split's lines are read by one task in order; a line that crosses into the
    next split counts to the one where it begins. Compressed files are one split.
    """
    place = F.concat(F.col("_metadata.file_path"), F.lit("\u0000"),
                     F.lpad(F.col("_metadata.file_block_start").cast("string"), 19, "0"))
    return spark.read.text(path).select("value", place.alias("log_split"),
                                        F.monotonically_increasing_id().alias("log_row"))


def parse_roster(lines: DataFrame, ord_col: Column | None = None, value_col: str = "value") -> DataFrame:
    """SRC-3: TSV roster lines -> (name, true_name, team, ord).

    ``ord`` (any orderable column) keeps file order for the last-match-wins
    rule; without an explicit column it is ``monotonically_increasing_id``,
    which follows line order inside one partition.
    """
    parts = F.split(F.col(value_col), FIELD_SEP)
    ord_expr = ord_col if ord_col is not None else F.monotonically_increasing_id()
    return lines.select(
        F.get(parts, ROSTER_NAME_FIELD).alias("name"),
        F.trim(F.get(parts, ROSTER_TRUE_NAME_FIELD)).alias("true_name"),  # FN-15: names compare trimmed
        F.get(parts, ROSTER_TEAM_FIELD).alias("team"),
        ord_expr.alias("ord"),
    )


def read_roster(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """SRC-3 from one or more files.

    ``ord`` is (file path, split start, row id): file-name order, then
    position. Spark packs input files by size, so partition order alone
    would not follow the files' order.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("_pl_file"), F.col("_metadata.file_block_start").alias("_pl_at"))
    return parse_roster(lines, ord_col=F.struct("_pl_file", "_pl_at", F.monotonically_increasing_id()))


def read_text(spark: SparkSession, path: str | list[str], cache: bool = True) -> DataFrame:
    """SRC-4: plain text lines (ended by a line feed), cached for several counts over the same file."""
    df = spark.read.text(path, lineSep="\n")
    return df.cache() if cache else df


def read_matches(spark: SparkSession, path: str, fmt: str = "parquet", options: dict | None = None) -> DataFrame:
    """SRC-1: nested match documents with the fixed schema (no inference)."""
    return spark.read.format(fmt).options(**(options or {})).schema(schemas.MATCH).load(path)


def write_matches(docs: DataFrame, path: str, fmt: str = "parquet", mode: str = "append",
                  options: dict | None = None) -> None:
    """SNK-1 / SNK-2: append (or overwrite) match documents.

    JSON output is a folder of part files, one document per line.
    """
    docs.write.format(fmt).mode(mode).options(**(options or {})).save(path)


def write_log(lines: DataFrame, path: str, mode: str = "overwrite", value_col: str = "value") -> None:
    """SNK-3: write log lines as text."""
    lines.select(value_col).write.mode(mode).text(path)


def write_events(events: DataFrame, path: str, mode: str = "overwrite", rebalance: bool = False) -> None:
    """Flat event table partitioned by season, so season filters prune files.

    Each write task writes one file per season in its input. Logs arrive by
    date, so a task usually holds one season; when the input mixes seasons,
    ``rebalance=True`` adds one shuffle (``REBALANCE(season_start)``, which AQE
    splits to the advisory partition size) for fewer, larger files.
    """
    if rebalance:
        events = events.hint("rebalance", "season_start")
    events.write.mode(mode).partitionBy("season_start").parquet(path)


def format_rows(df: DataFrame, template: str, *cols: str, name: str = "line") -> DataFrame:
    """SNK-4: the printable text form of result rows (``'%d %s %s %d'``)."""
    return df.select("*", F.format_string(template, *[F.col(c) for c in cols]).alias(name))
