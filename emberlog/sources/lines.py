"""Raw text sources: firewall lines and network CSV records.

Bytes that are no UTF-8 are left out, as the replay senders do, and nothing else
is: a replacement character that a file really holds stays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import strip_ws
from ..schemas import NETWORK_CSV_SCHEMA


def decodable(c: Column) -> Column:
    """A text read as raw bytes, without the bytes that do not decode.

    Only rows with such bytes are rewritten: a U+FFFD that the text holds is set
    aside (``\\x1a`` escapes itself and it), what does not decode becomes U+FFFD,
    these go, and the text's own come back.
    """
    aside = F.replace(F.replace(c, F.lit("\x1a"), F.lit("\x1ao")), F.lit("\ufffd"), F.lit("\x1ar"))
    left = F.replace(F.make_valid_utf8(aside), F.lit("\ufffd"), F.lit(""))
    back = F.replace(F.replace(left, F.lit("\x1ar"), F.lit("\ufffd")), F.lit("\x1ao"), F.lit("\x1a"))
    return F.when(F.is_valid_utf8(c), c).otherwise(back)


def read_lines(spark: SparkSession, path: str, with_position: bool = True) -> DataFrame:
    """Text lines (UTF-8) of every file under ``path`` (glob allowed).

    ``with_position`` adds ``source`` (file path) -- a text file has no
    line offsets, so a replay-stable id uses file + content.
    """
    value = decodable(F.col("value")).alias("value")
    position = [F.col("_metadata.file_path").alias("source")] if with_position else []
    return spark.read.text(path).select(value, *position)


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """value, source, line_no: lines with their number in their file, of files that Spark cuts into splits.

    Two passes: the first counts the lines of each split (a split of a file is
    named by where it starts), and the splits before it give a split its first
    number; the second numbers the lines inside their split.  Only one row for
    each split meets by file; no file is one row or one task.
    """
    at = ["source", "start", "part"]
    raw = spark.read.text(path).select(F.col("value"), F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("start"),
                                       F.monotonically_increasing_id().alias("nth"))
    rows = raw.withColumn("part", F.shiftright("nth", 33))  # a task may read several splits, one after another
    before = Window.partitionBy("source").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = (rows.groupBy(*at).agg(F.count(F.lit(1)).alias("n"), F.min("nth").alias("low"))
              .select(*at, (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("low")).alias("shift")))
    return rows.join(splits, at).select(decodable(F.col("value")).alias("value"), "source", (F.col("nth") + F.col("shift")).alias("line_no"))


def non_blank(df: DataFrame, value_col: str = "value") -> DataFrame:
    """Strip lines and skip blank ones (the line-replay source behaviour)."""
    v = strip_ws(F.col(value_col))
    return df.withColumn(value_col, v).where(F.col(value_col) != "")


def _file_number() -> Column:
    return F.pmod(F.xxhash64("_metadata.file_path"), F.lit((1 << 31) - 1)).cast("int")


def stream_lines(spark: SparkSession, path: str, max_files: int | None = None,
                 positions: bool = False) -> DataFrame:
    """Continuous line feed from files landing in ``path`` (sorted by name).

    Spark cuts the files, so no file has to fit in a task.  ``positions`` adds
    ``line_no``, a position that rises from line to line of a file and that no
    two of its lines share (a line's number, counted from where its split
    starts), and ``split``, a number of the file.  With ``positions=False``
    ``line_no`` is a hash of file and line, the same however a file is cut.
    """
    r = spark.readStream.format("text")
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    if not positions:
        lines = r.load(path)
        return lines.select(decodable(F.col("value")).alias("value"), F.xxhash64("_metadata.file_path", "value").alias("line_no"), _file_number().alias("split"))
    cut = r.option("lineSep", "\n").load(path).select(decodable(F.col("value")).alias("value"), F.col("_metadata.file_block_start").alias("line_no"), _file_number().alias("split"))
    return cut.mapInArrow(_numbered_in_splits(), "value string, line_no long, split int")


def _numbered_in_splits():
    """Arrow batches whose ``line_no`` is where the row's split starts -> the same with the line's position.

    A split of a file holds the lines that begin behind its first byte (the
    file's first also the one on it) up to the next one's first byte, so the start plus the
    number within the split stays below all positions of the next split.
    """
    def number(batches):  # nested, so that it travels by value and workers need no package
        import numpy as np
        import pyarrow as pa

        last, nth = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            start, split = (batch.column(k).to_numpy() for k in (1, 2))
            new = np.ones(len(start), bool)
            new[1:] = (start[1:] != start[:-1]) | (split[1:] != split[:-1])
            first = np.flatnonzero(new)
            at = np.arange(len(start)) - np.repeat(first, np.diff(np.append(first, len(start))))
            if last == (start[0], split[0]):  # the split goes on from the batch before
                at[: first[1] if len(first) > 1 else None] += nth
            last, nth = (start[-1], split[-1]), int(at[-1]) + 1
            line_no = start + at + (start > 0)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(line_no, pa.int64()), batch.column(2)], ["value", "line_no", "split"])
    return number


def _csv_text(df: DataFrame) -> DataFrame:
    """Fields that were read byte by byte (Latin-1 keeps each) as UTF-8."""
    return df.select(*(decodable(F.encode(c, "ISO-8859-1").cast("string")).alias(c) for c in df.columns))


def read_network_csv(spark: SparkSession, path: str) -> DataFrame:
    """``timestamp;device_id;program;msg`` files with a header line."""
    return _csv_text(spark.read.schema(NETWORK_CSV_SCHEMA)
                     .option("sep", ";").option("header", "true").option("encoding", "ISO-8859-1")
                     .option("quote", '"').option("escape", '"')
                     .option("mode", "PERMISSIVE").csv(path))


def stream_network_csv(spark: SparkSession, path: str,
                       max_files: int | None = None) -> DataFrame:
    r = (spark.readStream.schema(NETWORK_CSV_SCHEMA)
         .option("sep", ";").option("header", "true").option("encoding", "ISO-8859-1")
         .option("quote", '"').option("escape", '"'))
    if max_files:
        r = r.option("maxFilesPerTrigger", str(max_files))
    return _csv_text(r.csv(path))
