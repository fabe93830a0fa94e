"""Lines of text files with trustworthy numbers, and the tail of growing files."""

from __future__ import annotations

import os
from collections.abc import Iterator
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that one scan reads of a file at most.
SCAN_BYTES = 8 << 20


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """path, line_no (from 0) and line of every line, carriage returns stripped.

    A file is the unit of work, as its order carries meaning: parsers with state need all lines
    before theirs.
    """
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), "value")
    return whole.select("path", F.posexplode(F.split("value", "\n")).alias("line_no", "line")).select("path", F.col("line_no").cast("long"), F.regexp_replace("line", "\r+$", "").alias("line"))


def plain_lines(spark: SparkSession, path: str) -> DataFrame:
    """Lines for parsers without state: files are split and read in parallel."""
    return spark.read.text(path).select(F.col("_metadata.file_path").alias("path"), F.regexp_replace("value", "\r+$", "").alias("line"))


class Tail:
    """Complete new lines of the files in a folder since the last scan.

    State is a byte offset per file. A file shorter than its offset is read from its start.
    Subfolders are skipped, blank lines dropped; a folder that isn't there yet and files that go
    meanwhile have nothing new. For one poller on the host that has the files;
    what it yields goes on as a DataFrame.
    """

    def __init__(self, folder: str, offsets: dict[str, int] | None = None):
        self.folder, self.offsets = folder, dict(offsets or {})
        self.truncated: list[str] = []

    def scan(self) -> Iterator[tuple[str, str]]:
        self.truncated = []
        try:
            entries = sorted(os.scandir(self.folder), key=lambda x: x.name)
        except FileNotFoundError:
            return
        for entry in entries:
            try:
                if entry.is_file():
                    yield from self._file(entry.path)
            except FileNotFoundError:
                continue

    def _file(self, path: str) -> Iterator[tuple[str, str]]:
        size, at = os.path.getsize(path), self.offsets.get(path, 0)
        if size < at:
            self.truncated.append(path)
            at = 0
        with Path(path).open("rb") as file:
            file.seek(at)
            data = file.read(SCAN_BYTES)
            while data and b"\n" not in data and (more := file.read(SCAN_BYTES)):  # a line longer than a scan
                data += more
        whole = data[: data.rfind(b"\n") + 1]
        self.offsets[path] = at + len(whole)
        for line in whole.decode(errors="replace").split("\n"):
            line = line.rstrip("\r")
            if line:
                yield path, line
