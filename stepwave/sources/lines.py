"""Reading lines: comma-separated text to typed rows, bad lines kept apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.vectors import norm
from ..schema import READING, READING_FIELDS

BLANKS = " \t\r\n"


def line_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """Text files that appear in ``folder``, one row per line."""
    reader = spark.readStream
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(folder)


def reading_files(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV files with typed columns."""
    return spark.read.schema(READING).csv(path, header=True, ignoreLeadingWhiteSpace=True, ignoreTrailingWhiteSpace=True)


def split_lines(payloads: DataFrame, column: str = "value") -> DataFrame:
    others = [c for c in payloads.columns if c != column]
    return payloads.select(*others, F.explode(F.split(column, "\n")).alias(column))


def field(parts: Column, position: int) -> Column:
    return F.get(parts, F.lit(position))


def user_of(line: Column) -> Column:
    return F.trim(field(F.split(line, ","), 1), F.lit(BLANKS))


def keyed(lines: DataFrame, column: str = "value") -> DataFrame:
    """Each line beside the user it belongs to."""
    return lines.withColumn("userID", user_of(F.col(column)))


def _typed(lines: DataFrame, line: str, kinds: dict[str, str]) -> DataFrame:
    """Add the comma-separated fields of ``line`` with the given types, and ``_suffix``.

    ``_suffix`` marks a double with a trailing d or f, which a Java parser takes for a number.  The
    fields are generated as one row, so later filters read them instead of parsing again.
    """
    parts = F.col("_parts")
    fields = {
        name: F.trim(field(parts, i), F.lit(BLANKS)) if kind == "string" else field(parts, i).try_cast(kind)
        for i, (name, kind) in enumerate(kinds.items())
    }
    doubles = [i for i, kind in enumerate(kinds.values()) if kind == "double"]
    suffix = F.col(line).rlike(rf"^([^,]*,){{{doubles[0]},{doubles[-1]}}}[^,]*[0-9.][dDfF]\s*(,|$)")
    row = F.struct(*(v.alias(n) for n, v in fields.items()), suffix.alias("_suffix"))
    return lines.withColumn("_parts", F.split(line, ",")).select(*lines.columns, F.inline(F.array(row)))


def parsed(lines: DataFrame, column: str = "value") -> DataFrame:
    """Add the reading fields and ``problem``, NULL for a good line.  Fields beyond the seventh are ignored."""
    return with_problem(_typed(lines, column, {f.name: f.dataType.simpleString() for f in READING.fields}))


def with_problem(rows: DataFrame) -> DataFrame:
    missing, not_number = F.coalesce("_suffix", F.lit(True)), F.lit(False)
    for f in READING.fields:
        missing = missing | F.col(f.name).isNull()
        if f.dataType.simpleString() == "double":
            not_number = not_number | F.isnan(f.name)
    empty_user = F.col("userID") == ""
    problem = F.when(missing | empty_user, "missing").when(not_number, "not a number")
    return rows.withColumn("problem", problem).drop("_suffix")


def good(rows: DataFrame) -> DataFrame:
    return rows.filter(F.col("problem").isNull()).select(*READING_FIELDS)


def quarantined(rows: DataFrame, column: str = "value") -> DataFrame:
    others = [c for c in rows.columns if c not in READING_FIELDS and c not in (column, "problem")]
    return rows.filter(F.col("problem").isNotNull()).select(*others, column, "problem")


def parsed_xyz4(points: DataFrame, column: str = "point", user: str = "uuid", position: str = "index") -> DataFrame:
    """The four-field layout ``timestamp, x, y, z``: position, user and strength come from around the line."""
    typed = _typed(points, column, {"timeMs": "bigint", "accX": "double", "accY": "double", "accZ": "double"})
    around = {
        "index": F.col(position).cast("bigint"),
        "userID": F.trim(user),
        "vSum": norm(F.col("accX"), F.col("accY"), F.col("accZ")),
    }
    return with_problem(typed.withColumns(around))
