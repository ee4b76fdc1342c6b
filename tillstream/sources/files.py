"""Scans of landed files. Schemas are explicit; nothing is inferred from the data."""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.expressions import lenient_timestamp
from tillstream.schemas import CLICK_JSON, RAW_SCHEMAS
from tillstream.settings import COMMERCE_FILES


#: Name of the column that holds the text of CSV records which do not fit the header.
MISFIT = "misfit_record"


def scan_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """CSV records with the columns of the header, all text, and ``misfit_record``.

    Cells may be quoted; a quote in one is doubled, and with ``multi_line`` it may hold line
    breaks. Such files are read as a whole by one task each, so a large table should come as many
    files; without ``multi_line`` a file is split. A record with fewer cells than the header lacks
    the last ones, of one with more the first count; both have their text in ``misfit_record``,
    which is null for all others. Files of one folder must have the same header.
    """
    options = {"header": True, "quote": '"', "escape": '"', "multiLine": multi_line, "enforceSchema": False}
    columns = spark.read.options(**options).csv(path).columns
    if MISFIT in columns:
        raise ValueError(f"{path} has a column {MISFIT}")
    schema = ", ".join(f"`{name.replace('`', '``')}` string" for name in [*columns, MISFIT])
    return spark.read.schema(schema).options(**options).option("columnNameOfCorruptRecord", MISFIT).csv(path)


def read_table_csv(spark: SparkSession, path: str, table: str, multi_line: bool = True, misfits: bool = False) -> DataFrame:
    """CSV with a header as the raw table ``table``, see ``scan_csv``.

    Columns are taken by their names in the header, so their order and further columns don't matter;
    a missing one is an error, and so are files of one folder with different headers. An unreadable
    number or time becomes null. With ``misfits`` the column ``misfit_record`` is kept.
    """
    fields = [part.split(maxsplit=1) for part in _split_ddl(RAW_SCHEMAS[table])]
    scanned = scan_csv(spark, path, multi_line)
    missing = [name for name, _ in fields if name not in scanned.columns]
    if missing:
        raise ValueError(f"{path} has no column {', '.join(missing)}")
    return scanned.select(*(_from_text(name, kind).alias(name) for name, kind in fields), *([MISFIT] if misfits else []))


def misfit_records(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """(file, misfit_record) of the records that do not fit the header of their file."""
    found = scan_csv(spark, path, multi_line).withColumn("file", F.element_at(F.split(F.input_file_name(), "/"), -1))
    # Spark refuses to read the text of a record alone, so the condition, always true, asks for a cell.
    cell = F.coalesce(F.length(F.col(f"`{found.columns[0]}`")), F.lit(0)) >= 0
    return found.where(F.col(MISFIT).isNotNull() & cell).select("file", MISFIT)


def _from_text(name: str, kind: str) -> Column:
    if kind == "timestamp":
        return lenient_timestamp(F.col(name))
    return F.col(name) if kind == "string" else F.col(name).try_cast(kind)


def wanted_files(listed: Iterable[str] | None) -> dict[str, str]:
    """File to table map, narrowed to the listed names; unknown names count for nothing."""
    chosen = {name: COMMERCE_FILES[name] for name in listed or () if name in COMMERCE_FILES}
    return chosen or dict(COMMERCE_FILES)


def read_commerce_files(
    spark: SparkSession, folder: str, listed: Iterable[str] | None = None
) -> dict[str, DataFrame]:
    """The commerce files of a folder by table name, each a lazy scan."""
    return {
        table: read_table_csv(spark, f"{folder}/{name}", table)
        for name, table in sorted(wanted_files(listed).items())
    }


def manifest_files(spark: SparkSession, path: str) -> list[str]:
    """The commerce files that a manifest names, one name a line, sorted.

    Blank lines, repeated and unknown names count for nothing, so the driver sees a handful of names
    however long the manifest is.
    """
    name = F.trim(F.regexp_replace("value", r"\r$", ""))
    known = spark.read.text(path).select(name.alias("name")).where(F.col("name").isin(*COMMERCE_FILES))
    return sorted(row["name"] for row in known.distinct().collect())


def listed_counts(spark: SparkSession, folder: str, listed: Iterable[str] | None = None, multi_line: bool = True) -> DataFrame:
    """(table_name, file_count, record_count, misfit_count) of the listed commerce files of a folder.

    Only listed files are read, and a name may stand for a folder of files. Each table is one scan
    that combines its counts per file before the shuffle. A file with a header alone counts for nothing.
    """
    counted = []
    for name, table in sorted(wanted_files(listed).items()):
        scanned = scan_csv(spark, f"{folder}/{name}", multi_line)
        first = F.col(f"`{scanned.columns[0]}`")
        per_file = scanned.groupBy(F.col("_metadata.file_path").alias("file")).agg(
            F.count(F.lit(1)).alias("records"), F.count(F.when(F.col(MISFIT).isNotNull(), F.coalesce(first, F.lit("")))).alias("misfits")
        )
        total = per_file.agg(
            F.count(F.lit(1)).alias("file_count"),
            F.coalesce(F.sum("records"), F.lit(0)).alias("record_count"),
            F.coalesce(F.sum("misfits"), F.lit(0)).alias("misfit_count"),
        )
        counted.append(total.select(F.lit(table).alias("table_name"), "*"))
    return reduce(DataFrame.unionByName, counted)


def read_json_lines(spark: SparkSession, path: str, schema: str = CLICK_JSON) -> DataFrame:
    """JSON lines; blank lines are skipped and a broken line fails the job."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_click_lines(spark: SparkSession, path: str) -> DataFrame:
    """Click events; a broken line gives an all-null row, a missing path fails at once."""
    return spark.read.schema(CLICK_JSON).json(path)


def read_document(spark: SparkSession, path: str, schema: str, **about: Column) -> DataFrame:
    """Files holding one JSON document (or one array) each, as parsed columns and the text ``received``.

    The text holds fields that the schema doesn't name, too. ``about`` adds columns on the file.
    """
    texts = spark.read.text(path, wholetext=True).where(F.col("value").rlike(r"\S"))
    listed = F.when(F.col("value").rlike(r"^\s*\["), F.from_json("value", "array<string>"))
    one = F.coalesce(listed, F.array("value"))
    named = texts.select(one.alias("texts"), *(column.alias(name) for name, column in about.items()))
    entries = named.select(F.explode("texts").alias("received"), *about)
    return entries.withColumn("parsed", F.from_json("received", schema)).select("parsed.*", "received", *about)


def _split_ddl(ddl: str) -> list[str]:
    return [part.strip() for part in ddl.replace(", ", "\n").split("\n")]
