"""Stages that a build can resume (PIPE-2).

A build writes each table to a work folder of its own, puts a marker with the
input's fingerprint and the stage's figures into it, and moves the folder to its
final name in one step. A table at its final name is therefore whole, and a build
that is run again over the same input takes up what is there: a build that died
writing the daily table does not read the raw input again. A root that holds
another input's tables, or tables without a marker, is refused. What a dead
attempt has left lies under ``_work`` and is never read.

The file system has to rename a folder in one step (HDFS, local and mounted file
systems do).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from probelens.sources.paths import exists, move_to_new, read_text, write_text
from probelens.sources.tables import table_path

MARKER = "_STAGE.json"


def input_fingerprint(spark: SparkSession, path: str | list[str], **settings) -> str:
    """A name for the files at ``path`` (names, lengths, times of change) and the settings of a build.

    Spark lists the files; their content is not read.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length", F.unix_micros("modificationTime").alias("changed"))
    row = files.agg(F.count("*"), F.sum("length"), F.bit_xor(F.xxhash64("path", "length", "changed")), F.sum(F.xxhash64("changed", "path") % (1 << 20))).first()
    return json.dumps([*row, sorted(settings.items())], default=str)


class Journal:
    """The stages of one build under ``root``; without a fingerprint nothing can be resumed."""

    def __init__(self, spark: SparkSession, root: str, fingerprint: str | None = None):
        self.spark, self.root, self.fingerprint = spark, root.rstrip("/"), fingerprint

    def done(self, name: str) -> dict | None:
        """The figures of a finished stage, or None; another build's table is refused."""
        path = table_path(self.root, name)
        if not exists(self.spark, path):
            return None
        found = read_text(self.spark, f"{path}/{MARKER}")
        if found is None or self.fingerprint is None or json.loads(found)["input"] != self.fingerprint:
            raise FileExistsError(f"output exists, write to a new place: {path}")
        return json.loads(found)["figures"]

    def run(self, name: str, write: Callable[[str], dict | None]) -> dict:
        """The stage's figures; ``write`` puts the table under the folder it is given, unless it is done."""
        if (figures := self.done(name)) is not None:
            return figures
        work = f"{self.root}/_work/{uuid.uuid4().hex}"
        figures = write(work) or {}
        written = table_path(work, name)
        write_text(self.spark, f"{written}/{MARKER}", json.dumps({"input": self.fingerprint, "figures": figures}))
        move_to_new(self.spark, written, table_path(self.root, name))
        return figures
