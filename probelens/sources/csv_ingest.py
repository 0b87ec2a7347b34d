"""Raw CSV ingest and validation (SRC-1, SRC-2, VAL-1, VAL-2, VAL-3).

One function reads local paths and object-store URIs alike; the path is a
parameter. The declared schema is used (no inference pass over the data).

VAL-1 comes before the scan (D1): :func:`file_headers` reads the first line of
every file through Spark's file system layer, and :func:`check_headers` refuses
the input, naming the files, before any job runs. The scan that follows converts only
the columns its plan keeps; ``enforceSchema=false`` stays on, so that a file that
is replaced in between still fails.

:func:`rejected_rows` lists what VAL-3 drops, by file and reason, with the text
of records that do not parse.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from dataclasses import dataclass
from itertools import islice

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from probelens import config as C

class DataValidationError(ValueError):
    """Raised when raw input is missing, empty or malformed."""


@dataclass
class RawInput:
    """Observed raw readings plus their data-quality observation.

    ``quality.get`` is filled by the first action that runs over ``df``
    (a write, normally): row count and null count per column.
    """

    df: DataFrame
    quality: Observation


def read_raw_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """SRC-1/SRC-2: scan CSV files with a header row using the declared schema.

    Values that do not parse as the declared type become null (N1).
    """
    return (
        spark.read.schema(C.RAW_SCHEMA)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .csv(path)
    )


#: A header longer than this is not one.
HEADER_BYTES = 1 << 20


def first_line(spark: SparkSession, file: str) -> str | None:
    """The first line of a file that Spark lists, decompressed by its ending; None where it is empty."""
    jvm = spark.sparkContext._jvm
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(file))
    stream = path.getFileSystem(conf).open(path)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
        text = codec.createInputStream(stream) if codec is not None else stream
        bounded = jvm.org.apache.commons.io.input.BoundedInputStream(text, HEADER_BYTES)
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(bounded, "UTF-8")).readLine()
    finally:
        stream.close()


def file_headers(spark: SparkSession, path: str | list[str], threads: int = 16) -> Iterator[tuple[str, str]]:
    """(file, first line) of every file that is not empty.

    One small read per file and no job: a Spark task cannot stop at a file's
    first line (a limit is per query, and a Python task has its input sent to the
    end), so a header job would scan the whole input. The names are those Spark
    has listed; lines are handed on one by one.
    """
    files = spark.read.text(path).inputFiles()
    with ThreadPoolExecutor(threads) as pool:
        for file, line in zip(files, pool.map(lambda f: first_line(spark, f), files), strict=True):
            if line is not None:
                yield file, line


def _names(header: str) -> list[str]:
    found = next(csv.reader([header.removeprefix("\ufeff")]), [])
    return [n.lower() for n in found]


def check_headers(spark: SparkSession, path: str | list[str], show: int = 5) -> None:
    """VAL-1: refuse input of which a file's header is not the declared layout (names compared without case)."""
    expected = [f.name.lower() for f in C.RAW_SCHEMA.fields]
    wrong = list(islice(((f, h) for f, h in file_headers(spark, path) if _names(h) != expected), show))
    if wrong:
        named = "; ".join(f"{f}: {h[:500]}" for f, h in wrong)
        raise DataValidationError(f"CSV header does not fit the declared columns ({show} files at most are named). {named}")


@contextmanager
def header_errors():
    """VAL-1: a header that does not fit the declared layout, as the error of this module.

    Spark compares each file's header when it reads the file, so the job that
    reads it fails; what that job has written so far is in a new place.
    """
    try:
        yield
    except Exception as exc:
        if "CSV header does not conform" in str(exc):
            found = re.search(r"Header: [^\n]*", str(exc))
            raise DataValidationError(f"CSV header does not fit the declared columns. {found[0] if found else ''}".strip()) from exc
        raise


def check_not_empty(df: DataFrame, what: str = "input") -> None:
    """VAL-2: fail on empty input without a full count (one limit-1 job)."""
    if df.isEmpty():
        raise DataValidationError(f"no rows in {what}")


def required_present(required=C.REQUIRED_COLUMNS) -> Column:
    """VAL-3 as a conjunction of ``IS NOT NULL`` (each conjunct pushes down)."""
    cond = F.lit(True)
    for c in required:
        cond = cond & F.col(c).isNotNull()
    return cond


def drop_incomplete(df: DataFrame, required=C.REQUIRED_COLUMNS) -> DataFrame:
    """VAL-3: drop rows null in any required column."""
    return df.where(required_present(required))


def observe_quality(df: DataFrame, name: str = "raw_quality", columns: list[str] | None = None) -> RawInput:
    """Attach row and per-column null counts (all columns unless given)."""
    obs = Observation(name)
    metrics = [F.count(F.lit(1)).alias("rows")]
    metrics += [F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in (columns or df.columns)]
    return RawInput(df.observe(obs, *metrics), obs)


def load_probe_csv(spark: SparkSession, path: str | list[str], check_all_columns: bool = False) -> RawInput:
    """Check, scan and observe raw CSV readings; rows are not yet cleaned.

    Raises :class:`DataValidationError` if a file's header is not the declared
    one, or if the path holds no data rows.

    By default nulls are counted in the required columns only, and the scan
    converts just the columns its plan keeps. With ``check_all_columns`` nulls
    are counted in all 20 columns; the price is converting the 14 radio columns
    that no aggregate uses.
    """
    check_headers(spark, path)
    raw = read_raw_csv(spark, path)
    with header_errors():
        check_not_empty(raw, f"raw CSV at {path}")
    return observe_quality(raw, columns=None if check_all_columns else list(C.REQUIRED_COLUMNS))


def rejected_rows(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, reason, record) of every row that VAL-3 drops.

    ``reason`` names each required column as missing (the field is empty) or
    unreadable (it is not of the declared type); ``record`` is the line's text
    where one of its required fields is unreadable, else null. One scan that
    converts the required columns only.
    """
    required = [f for f in C.RAW_SCHEMA.fields if f.name in C.REQUIRED_COLUMNS]
    schema = T.StructType([*C.RAW_SCHEMA.fields, T.StructField(RECORD, T.StringType())])
    raw = (
        spark.read.schema(schema)
        .option("header", True)
        .option("enforceSchema", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", RECORD)
        .csv(path)
    )
    texts = ", ".join(f"`{f.name}` string" for f in C.RAW_SCHEMA.fields)
    fields = F.from_csv(F.col(RECORD), F.lit(texts))
    reasons = [
        F.when(F.col(f.name).isNull(), F.concat(F.lit(f.name), F.when(fields.getField(f.name).isNotNull(), " unreadable").otherwise(" missing")))
        for f in required
    ]
    bad = raw.select(F.col("_metadata.file_path").alias("file"), RECORD, *[f.name for f in required]).where(~required_present())
    return bad.select("file", F.concat_ws(", ", *reasons).alias("reason"), F.col(RECORD).alias("record"))


RECORD = "_record"
