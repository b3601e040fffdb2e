"""Delimited extracts under a declared schema, with bad lines set aside."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from siltwork.operators.checks import any_of
from siltwork.session import loading_session
from siltwork.sources.staging import StagedBatch, stage

BAD_LINE = "_bad_line"
#: A header line is read up to so many bytes.
_HEADER_BYTES = 1 << 20
_BLANK = r"^[\x00-\x20]*$"


class RejectLimitExceeded(RuntimeError):
    """More bad lines than a load tolerates."""


class HeaderMismatch(ValueError):
    """A file's header does not name the declared columns."""


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType,
    delimiter: str = ",",
    check_header: bool = False,
) -> DataFrame:
    """Lines of ``path`` after each file's header line, columns bound by position.

    Quotes are ordinary characters, empty fields are NULL and blanks are kept. A
    line with too few or too many fields, or a field that does not fit its type,
    arrives whole in ``_bad_line``, which is NULL for good lines. Blank lines are passed
    over. With ``check_header`` a file whose header names other columns is an error.
    """
    return (
        spark.read.schema(T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())]))
        .option("header", True)
        .option("enforceSchema", not check_header)
        .option("sep", delimiter)
        .option("quote", "")
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", BAD_LINE)
        .csv(path)
    )


def write_delimited(df: DataFrame, path: str, delimiter: str = ",") -> None:
    """Write an extract that ``read_delimited`` reads back unchanged."""
    (
        df.write.option("header", True)
        .option("sep", delimiter)
        .option("quote", "")
        .option("emptyValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def stage_delimited(
    spark: SparkSession,
    source: str | list[str],
    schema: T.StructType,
    target: str,
    delimiter: str = ",",
    check_header: bool = False,
) -> StagedBatch:
    """Read ``source`` once; write good rows and bad lines side by side.

    Every line but each file's header, its first line that is not blank, is a good row or
    a bad line kept as it stands in the file: too few or too many fields, a value that
    does not fit its type or, where ``schema`` declares ``varchar``, its length, or a blank
    line. With ``check_header`` headers must name the columns in order, in any case.
    """
    own = loading_session(spark)
    lines = own.read.text(source)
    headers = _headers(own, lines)
    if check_header:
        _check(headers, schema, delimiter)
    plain = [T.StructField(f.name, T.StringType() if _limit(f) else f.dataType) for f in schema]
    parsed_as = [*plain, T.StructField(BAD_LINE, T.StringType())]
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in parsed_as)

    def parsed(rows: DataFrame) -> DataFrame:
        options = {
            "sep": delimiter,
            "quote": "",
            "mode": "PERMISSIVE",
            "columnNameOfCorruptRecord": BAD_LINE,
        }
        row = rows.select("value", F.from_csv("value", ddl, options).alias("row"))
        row = row.select("value", "row.*")
        too_long = [F.length(f.name) > _limit(f) for f in schema if _limit(f)]
        bad = [F.col("value").rlike(_BLANK), *too_long]
        whole = F.when(F.coalesce(any_of(bad), F.lit(False)), F.col("value"))
        return row.select(*schema.names, F.coalesce(BAD_LINE, whole).alias(BAD_LINE))

    # A header line is known by its text. Should a file hold the same line again, the
    # writing tasks have counted one too many, and the others are added as data.
    texts = list(headers)
    at = [_is_header(text, headers) for text in texts]
    seen = Observation()
    if texts:
        counts = [F.count_if(hit).alias(f"header_{i}") for i, hit in enumerate(at)]
        lines = lines.observe(seen, *counts).where(~any_of(at))
    staged = stage(parsed(lines), BAD_LINE, target)
    rows, rejected = staged.rows, staged.rejected
    for i, text in enumerate(texts):
        again = (seen.get.get(f"header_{i}") or 0) - len(headers[text])
        if again > 0:
            copies = own.range(again).select(F.lit(text).alias("value"))
            more = stage(parsed(copies), BAD_LINE, target, mode="append")
            rows, rejected = rows + more.rows, rejected + more.rejected
    written = spark.read.schema(staged.written.schema).parquet(target)
    return StagedBatch(target, written, BAD_LINE, rows, rejected)


def _limit(field: T.StructField) -> int | None:
    return field.dataType.length if isinstance(field.dataType, T.VarcharType) else None


def _is_header(text: str, headers: dict[str, list[str]]) -> Column:
    same = F.col("value") == F.lit(text)
    if len(headers) > 1:
        same &= F.input_file_name().isin(headers[text])
    return same


def _headers(spark: SparkSession, lines: DataFrame) -> dict[str, list[str]]:
    """Header lines with the files they head; only the start of each file is read."""
    java, settings = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    codecs = java.org.apache.hadoop.io.compress.CompressionCodecFactory(settings)
    found: dict[str, list[str]] = {}
    for name in lines.inputFiles():
        path = java.org.apache.hadoop.fs.Path(java.java.net.URI(name))
        stream = path.getFileSystem(settings).open(path)
        codec = codecs.getCodec(path)
        reader = java.org.apache.hadoop.util.LineReader(
            codec.createInputStream(stream) if codec else stream, settings
        )
        line = java.org.apache.hadoop.io.Text()
        try:
            while reader.readLine(line, _HEADER_BYTES):
                text = line.toString()
                if text.strip("".join(map(chr, range(33)))):
                    found.setdefault(text, []).append(name)
                    break
        finally:
            reader.close()
    return found


def _check(headers: dict[str, list[str]], schema: T.StructType, delimiter: str) -> None:
    wanted = [name.lower() for name in schema.names]
    for text, files in headers.items():
        if [name.strip().lower() for name in text.split(delimiter)] != wanted:
            raise HeaderMismatch(f"{files[0]} is headed {text!r}, not {delimiter.join(schema.names)!r}")
