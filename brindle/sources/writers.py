"""Text outputs. Every writer makes a folder of part files and fails if it exists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_tsv(df: DataFrame, path: str, lists: Sequence[str] = (), compression: str = "none") -> None:
    """One line per row, fields joined by tabs, no header, nothing quoted.

    Nothing is quoted, so a text with a tab or line break in it fails the job. Columns in
    ``lists`` hold several fields that the caller has joined by tabs. With ``compression`` ("gzip") the part files are
    smaller, and each is read by one task.
    """

    def field(column: T.StructField):
        text = F.coalesce(F.col(column.name).cast("string"), F.lit(""))
        if not isinstance(column.dataType, T.StringType):
            return text
        forbidden = "[\n\r]" if column.name in lists else "[\t\n\r]"
        fault = F.raise_error(F.lit(f"column {column.name}: a tab or line break in a text of a TSV file"))
        return F.when(text.rlike(forbidden), fault.cast("string")).otherwise(text)

    fields = [field(c) for c in df.schema.fields]
    df.select(F.concat_ws("\t", *fields).alias("value")).write.mode("errorifexists").option("compression", compression).text(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Comma-separated part files with a header line, written in parallel.

    Blanks at the ends of a text, empty texts and quotes come back as they were through ``read_csv``; texts with
    line breaks need its ``multi_line``. NULL is an empty field, an empty text a quoted one.
    """
    (
        df.write.mode("errorifexists")
        .option("header", True)
        .option("escape", '"')
        .option("emptyValue", '""')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
