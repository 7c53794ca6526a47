"""Delimited text: readers with an explicit schema and a pinned policy for malformed records, and the writer."""

from collections.abc import Iterable
from dataclasses import asdict, dataclass
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from palaver.workspace import matching, remove, write_once

MALFORMED = "_malformed_record"
SOURCE = "_source_file"


@dataclass(frozen=True)
class Dialect:
    """How a delimited file is written. The defaults are those of the feeds and stored tables."""

    header: bool = True
    delimiter: str = ","
    quote: str = '"'
    escape: str = "\\"
    encoding: str = "UTF-8"
    dateFormat: str = "yyyy-MM-dd"
    multiLine: bool = False
    timestampFormat: str | None = None

    def options(self) -> dict:
        return {k: v for k, v in asdict(self).items() if v is not None}


TABS = Dialect(delimiter="\t")
SEMICOLONS = Dialect(delimiter=";")


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType,
    dialect: Dialect = Dialect(),
    bad_records_path: str | None = None,
) -> DataFrame:
    """Read a file, a folder, a glob or a list of them; ``.gz`` files are decompressed.

    Records with a wrong type, too many or too few fields are dropped. With ``bad_records_path`` the dropped records
    are also written there (``read_and_quarantine``), in place of those of an earlier read of the same file. An unquoted
    empty field and a quoted one are both read as null.
    """
    if bad_records_path is not None:
        return read_and_quarantine(spark, path, schema, bad_records_path, dialect).select(*schema.names)
    reader = spark.read.options(**dialect.options()).option("columnPruning", False)
    return _parse_whole(reader.option("mode", "DROPMALFORMED").schema(schema).csv(path))


def read_and_quarantine(
    spark: SparkSession, path: str | list[str], schema: StructType, bad_records_path: str, dialect: Dialect = Dialect()
) -> DataFrame:
    """The good records with their ``_source_file``, from a working table; the malformed ones go to ``bad_records_path``.

    The text is parsed once, into a working table of all its records, from which both are read. The quarantine keeps a
    folder per source file, replaced when the file is read again and removed when it then has no malformed record.
    """
    parsed = parsed_records(spark, path, schema, dialect)
    # Named as in the column: file:/ and file:/// are one.
    files = {spark._jvm.org.apache.hadoop.fs.Path(name).toString() for name in parsed.inputFiles()}
    stored = write_once(parsed.hint("rebalance"), "parsed")
    bad = stored.filter(F.col(MALFORMED).isNotNull()).withColumn("source_", F.col(SOURCE))
    still = {row["source_"] for row in bad.select("source_").distinct().collect()}
    for folder in _folders_of(spark, bad_records_path, sorted(files - still)):
        remove(spark, folder)
    writer = bad.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("source_").parquet(bad_records_path)
    return stored.filter(F.col(MALFORMED).isNull()).drop(MALFORMED)


def _folders_of(spark: SparkSession, bad_records_path: str, files: list[str]) -> list[str]:
    """The folders of the quarantine that hold records of these files; no other folder is read."""
    if not files or not matching(spark, f"{bad_records_path.rstrip('/')}/source_=*"):
        return []
    kept = spark.read.parquet(bad_records_path).filter(F.col("source_").isin(files))
    folder = F.regexp_replace("_metadata.file_path", "/[^/]*$", "").alias("folder")
    return [unquote(row["folder"]) for row in kept.select(folder).distinct().collect()]


def _parse_whole(rows: DataFrame) -> DataFrame:
    """Make dropping a record independent of the columns a query selects.

    Without column pruning in the parser the number of fields is always checked, but only the fields a query needs are
    converted. The filter is true for every row; it needs each column whose conversion can fail.
    """
    typed = [f.name for f in rows.schema if not isinstance(f.dataType, StringType)]
    return rows.filter(F.pmod(F.xxhash64(*typed), F.lit(2)) < 2) if typed else rows


def malformed_records(
    spark: SparkSession, path: str | list[str], schema: StructType, dialect: Dialect = Dialect()
) -> DataFrame:
    """The records ``read_delimited`` drops: what could be parsed, the raw text and the file. Write it before counting.

    (Spark refuses to evaluate the raw text alone straight from a file, as a bare count would.)
    """
    rows = parsed_records(spark, path, schema, dialect)
    return rows.filter(rows[MALFORMED].isNotNull())


def parsed_records(spark: SparkSession, path: str | list[str], schema: StructType, dialect: Dialect = Dialect()) -> DataFrame:
    """All records: what could be parsed, the raw text of malformed ones, and the file."""
    probed = StructType([*schema.fields, StructField(MALFORMED, StringType())])
    rows = (
        spark.read.options(**dialect.options())
        .option("columnPruning", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", MALFORMED)
        .schema(probed)
        .csv(path)
    )
    return rows.select("*", rows["_metadata.file_path"].alias(SOURCE))


def read_many(
    spark: SparkSession,
    folder: str,
    names: Iterable[str],
    schema: StructType,
    dialect: Dialect = Dialect(),
    bad_records_path: str | None = None,
) -> DataFrame:
    """Several files of one folder and one schema as one DataFrame, in one scan."""
    paths = [f"{folder.rstrip('/')}/{name}" for name in names]
    return read_delimited(spark, paths, schema, dialect, bad_records_path)


def write_delimited(
    df: DataFrame,
    path: str,
    dialect: Dialect = Dialect(),
    *,
    null_value: str = "",
    empty_value: str | None = None,
    quote_all: bool = False,
    compression: str | None = None,
    sort_by: list[str] | None = None,
) -> None:
    """Overwrite ``path`` with delimited text.

    Leading and trailing blanks are kept. ``sort_by`` sorts the whole table, file names in order.
    """
    if sort_by:
        df = df.orderBy(*sort_by)

    options = {k: v for k, v in dialect.options().items() if k != "multiLine"}
    options |= {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    writer = df.write.mode("overwrite").options(**options).options(nullValue=null_value, quoteAll=quote_all)
    if empty_value is not None:
        writer = writer.option("emptyValue", empty_value)
    if compression is not None:
        writer = writer.option("compression", compression)
    writer.csv(path)
