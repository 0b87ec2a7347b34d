"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys
import tempfile
import uuid
from collections.abc import Callable

from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words are runs of anything but ASCII white space.
WORD_GAP = r"[\x20\x09-\x0D]+"
#: A line or text that holds a word.
HAS_WORD = r"[^\x20\x09-\x0D]"
#: Key that stands for a missing document id: larger than any real id.
NO_ID = (1 << 63) - 1


def ship(module: str) -> None:
    """Send a module's functions to the workers by value.

    Workers then need numpy, pyarrow and the like, but not this package on
    their path, wherever the session was started.
    """
    cloudpickle.register_pickle_by_value(sys.modules[module])


def words(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_GAP), "")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    An expression that is used in a lambda is evaluated for each element, also
    when it was a column of an inner select that the optimizer has merged; a
    lambda's variable is not.
    """
    return F.get(F.transform(F.array(value), body), 0)


def lines(text: Column) -> Column:
    r"""The ``\n``-separated lines of a text; a null text has one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``.

    Where the setting is missing a local session (tests) gets a temporary
    folder; a cluster session is refused, since its executors share none.
    """
    if found := spark.conf.get("spark.checkpoint.dir", None):
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    found = tempfile.mkdtemp(prefix="probelens-")
    spark.conf.set("spark.checkpoint.dir", found)
    return found


def staged(df: DataFrame) -> DataFrame:
    """Write a frame to the shared folder and read it back.

    Cuts the lineage: an executor lost later costs a re-read of these files,
    and no result depends on blocks that only one executor holds.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def without(df: DataFrame, *names: str) -> DataFrame:
    """Drop input columns that clash with result columns, whatever their case."""
    taken = {n.lower() for n in names}
    return df.drop(*[c for c in df.columns if c.lower() in taken])


def set_aside(df: DataFrame, names: tuple[str, ...]) -> tuple[DataFrame, list[Column]]:
    """The frame with columns that clash with ``names`` under other names, and the columns as they were."""
    clash = {c: f"__own_{c}" for c in df.columns if c.lower() in names}
    return df.withColumnsRenamed(clash), [F.col(f"`{clash.get(c, c)}`").alias(c) for c in df.columns]


def identity(*columns: Column | str) -> Column:
    """128 bits that stand for the values: two hashes, so that no two of 10^10 texts share them by chance."""
    return F.struct(F.xxhash64(*columns).alias("a"), F.xxhash64(F.lit(7), *columns).alias("b"))


def row_key(df: DataFrame) -> Column:
    """128 bits over all columns of a row; which of them are null counts too."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    plain = [F.to_json(F.struct(c)) if "map<" in kind or kind in ("void", "variant") else c for c, (_, kind) in zip(columns, df.dtypes, strict=True)]
    return identity(*plain, F.concat(*[c.isNull().cast("string") for c in columns]))
