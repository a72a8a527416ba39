"""Bronze CSV scan and typed read-back of silver and gold."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A name that every header normalisation leaves as it is.
CORRUPT = "corrupt_record"


def csv_options(encoding: str = "UTF-8", multiline: bool = False) -> dict[str, str]:
    """Reader options of an order file.

    Quotes inside a quoted field are doubled.  Parser-level column pruning is
    off because with it a row of the wrong width is not noticed, and a count
    would then see other rejects than a full read.
    """
    return {
        "header": "true",
        "escape": '"',
        "encoding": encoding,
        "multiLine": str(multiline).lower(),
        "mode": "PERMISSIVE",
        "columnPruning": "false",
        "enforceSchema": "false",
    }


def text_schema(names: list[str]) -> T.StructType:
    """All-string schema plus the column that holds rows of the wrong width."""
    return T.StructType([T.StructField(n, T.StringType()) for n in [*names, CORRUPT]])


def csv_header(spark: SparkSession, path: str, encoding: str = "UTF-8") -> list[str]:
    """Header names as they are written: the first line of one file, blank names empty.

    A file without a line has none.
    """
    options = {"header": "false", "escape": '"', "encoding": encoding}
    first = spark.read.options(**options).csv(path).first()
    return [name or "" for name in first] if first is not None else []


def unique_names(header: list[str]) -> list[str]:
    """Column names for a header: blank ones by their place, repeated ones with ``_2``, ``_3``.

    Names that differ only in case count as repeated, as Spark resolves them alike.
    """
    taken: set[str] = set()
    names = []
    for place, name in enumerate(header, start=1):
        base = name if name.strip() else f"column_{place}"
        candidate, n = base, 1
        while candidate.lower() in taken:
            n += 1
            candidate = f"{base}_{n}"
        taken.add(candidate.lower())
        names.append(candidate)
    return names


def read_bronze(
    spark: SparkSession,
    path: str | list[str],
    encoding: str = "UTF-8",
    multiline: bool = False,
    header: list[str] | None = None,
) -> DataFrame:
    """Headered CSV as text, one scan, no inference.

    Files whose header differs from the first one's fail the read instead of
    shifting columns; ``header`` says that it was read of every file.  Blank and
    repeated names are made unique (Spark cannot compare such a header itself).  ``multiline`` allows line breaks inside quotes but makes
    a file one task, so keep it off for large files.
    """
    known = header is not None
    header = header if known else csv_header(spark, path, encoding)
    names = unique_names(header)
    compared = not known and names == header
    return (
        spark.read.options(**csv_options(encoding, multiline))
        .option("enforceSchema", str(not compared).lower())
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(text_schema(names))
        .csv(path)
    )


def read_silver(
    spark: SparkSession,
    path: str,
    columns: list[str] | None = None,
    start: tuple[int, int] | None = None,
    end: tuple[int, int] | None = None,
) -> DataFrame:
    """Silver rows of the months ``start``..``end``, each a (year, month).

    The bounds touch partition columns only, so files of other months are listed but
    not read; plain bounds on the year can be pushed to a catalog as well.
    """
    df = spark.read.parquet(path)
    ordinal = F.col("year") * 12 + F.col("month")
    if start is not None:
        df = df.where((F.col("year") >= start[0]) & (ordinal >= start[0] * 12 + start[1]))
    if end is not None:
        df = df.where((F.col("year") <= end[0]) & (ordinal <= end[0] * 12 + end[1]))
    return df.select(*columns) if columns else df


def read_csv_folder(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame:
    """The CSV parts of a folder as one table; of the folders below it if it has none itself.

    With a schema the columns are typed, so sorting months is numeric.  A folder
    without any part is an error, not an empty table.
    """
    for where in ({}, {"recursiveFileLookup": "true"}):
        # a listing without content: is there a part at all
        parts = spark.read.format("binaryFile").options(pathGlobFilter="*.csv", **where)
        own = parts.load(path).select("path", F.element_at(F.split("path", "/"), -2).alias("folder"))
        if not where:
            name = path.rstrip("/").rpartition("/")[2]
            own = own.where(F.col("folder") == name)
        if own.limit(1).count():
            options = {"header": "true", "escape": '"', "pathGlobFilter": "*.csv", **where}
            reader = spark.read.options(**options)
            target = path if where else f"{path.rstrip('/')}/*.csv"
            return (reader.schema(schema) if schema else reader).csv(target)
    raise FileNotFoundError(f"No CSV files in {path}")


def read_optional(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """A Parquet table, or None where it does not exist."""
    try:
        reader = spark.read
        return (reader.schema(schema) if schema else reader).parquet(path)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise
