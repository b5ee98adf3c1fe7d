"""CSV sources."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.text import na_to_null

_MALFORMED = "_malformed_row"
_END = "\x01"


def scan_listing_csv(
    spark: SparkSession, path: str, multi_line: bool | None = None
) -> DataFrame:
    """A CSV file, or a directory of files with one header, all columns strings.

    Missing-value tokens become NULL and short rows are filled up with NULL. A
    row with surplus values or a file with another header fails the job.

    Files whose quoted values hold line breaks cannot be split: one task reads
    each. Unless told by `multi_line`, a first pass finds out whether there are
    such values; without them, large files are read by many tasks.
    """
    if multi_line is None:
        multi_line = not spark.read.text(path).where(_may_go_on(F.col("value"))).isEmpty()
    reader = (
        spark.read.option("header", True).option("escape", '"').option("multiLine", multi_line)
    )
    names = reader.csv(path).columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in [*names, _MALFORMED]])
    rows = (
        reader.option("columnNameOfCorruptRecord", _MALFORMED)
        .option("enforceSchema", False)
        .option("columnPruning", False)  # or the number of values is not seen
        .schema(schema)
        .csv(path)
    )
    message = F.concat(
        F.lit(f"row with more than {len(names)} values: "), F.coalesce(names[0], F.lit("")), F.lit(", ...")
    )
    accepted = (
        F.when(F.col(_MALFORMED).isNull(), True)
        .when(_is_short(F.col(_MALFORMED), len(names)), True)
        .otherwise(F.raise_error(message).cast("boolean"))
    )
    return rows.where(accepted).withColumns({n: na_to_null(F.col(n)) for n in names}).drop(_MALFORMED)


def _may_go_on(line: Column) -> Column:
    """Whether a line may end within a quoted value.

    It has an odd number of quotes then, unless one stands inside unquoted text,
    where it is a character like any other.
    """
    quotes = F.length(line) - F.length(F.replace(line, F.lit('"'), F.lit("")))
    return (quotes % 2 == 1) | line.rlike('[^,"]"[^,"]')


def _is_short(row: Column, width: int) -> Column:
    """Whether an end mark put behind a row's text falls within the width."""
    fields = [f"c{i}" for i in range(width)]
    schema = ", ".join(f"{name} STRING" for name in fields)
    parsed = F.from_csv(F.concat(row, F.lit(f",{_END}")), F.lit(schema), {"escape": '"'})
    return F.array_contains(F.array(*[parsed.getField(name) for name in fields]), _END)
