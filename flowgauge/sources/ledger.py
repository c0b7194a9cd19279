"""What the day files of a folder hold, found by decoding each of them on the executors."""

import bz2
import csv
import datetime
import os
import re
import zlib
from collections.abc import Callable, Iterator
from urllib.parse import unquote

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowgauge.session import scratch_path

# What a swipe file must have to be rolled up.
NEEDED = ("time", "stationID", "status")
DATE_IN_PATH = r".*(\d{4}-\d{2}-\d{2})"
#: Bytes that a decoder gives at once.
STEP = 1 << 20


def _zstd():
    import zstandard

    return zstandard.ZstdDecompressor().decompressobj()


# Decoders of one stream by the file's ending; a file may hold several streams in a row.
DECODERS: dict[str, Callable] = {
    ".gz": lambda: zlib.decompressobj(31),
    ".deflate": zlib.decompressobj,
    ".bz2": bz2.BZ2Decompressor,
    ".zst": _zstd,
}


def date_in(path: str) -> Column:
    return F.try_to_date(F.regexp_extract(path, DATE_IN_PATH, 1))


def _date_of(path: str) -> datetime.date | None:
    found = re.match(DATE_IN_PATH, path)
    try:
        return datetime.date.fromisoformat(found[1]) if found else None
    except ValueError:
        return None


def _plain(path: str) -> str:
    """A path in one form: Spark writes a missing host and special letters in several ways."""
    return re.sub(r"^(\w+):/+", r"\1:/", unquote(path))


def _ending(path: str) -> str:
    return os.path.splitext(path)[1].lower()


def decoded(data: bytes, ending: str) -> Iterator[bytes]:
    """The decoded content in pieces; ValueError where a stream is broken or cut off."""
    left, view = None, memoryview(data)
    for start in range(0, len(view), STEP):
        piece = bytes(view[start : start + STEP])
        while piece:
            left = left or DECODERS[ending]()
            try:
                out = left.decompress(piece)
            except Exception as error:  # each library has its own
                raise ValueError(str(error)) from None
            if out:
                yield out
            piece = left.unused_data if left.eof else b""
            left = None if left.eof else left
    if left is not None:
        raise ValueError("cut off before its end")


def first_and_rows(pieces: Iterator[bytes]) -> tuple[bytes, int]:
    """The first line that isn't blank, and how many follow."""
    first, lines, rest = b"", 0, b""
    for piece in pieces:
        *whole, rest = (rest + piece).split(b"\n")
        for line in whole:
            if line.strip():
                first = first or line
                lines += 1
    if rest.strip():
        first = first or rest
        lines += 1
    return first, max(0, lines - 1)


def _decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for key, data in zip(batch.column("key").to_pylist(), batch.column("content"), strict=True):
            first, rows, fault = b"", 0, None
            try:
                first, rows = first_and_rows(decoded(data.as_buffer(), _ending(key)))
            except ValueError as error:
                fault = f"unreadable: {error}"
            line = first.decode("utf-8", "replace")
            yield pa.RecordBatch.from_pydict({"key": [key], "line": [line], "rows": [rows], "fault": pa.array([fault], pa.string())})


def column_names(line: str) -> tuple[str, ...]:
    """Names in a header line; a blank one, or one that stands there already, gets its place."""
    names: list[str] = []
    for i, name in enumerate(next(csv.reader([line.lstrip("\ufeff").rstrip("\r\n")]), [])):
        seen = {n.lower() for n in names}
        names.append(name if name and name.lower() not in seen else f"{name or '_c'}{i}")
    return tuple(names)


def _header_and_fault(line: str | None, fault: str | None) -> tuple[tuple[str, ...], str | None]:
    header = column_names(line or "")
    lacking = [c for c in NEEDED if c not in header]
    return header, fault or (f"no column {', '.join(lacking)}" if lacking else None)


def file_ledger(spark: SparkSession, folder: str, start: datetime.date, end: datetime.date) -> DataFrame:
    """``path``, ``date``, ``header``, ``rows`` and ``fault`` of the files of a range of days and of those without a day.

    ``rows`` counts the lines behind the header, blank ones aside. ``fault`` is null for a file that can be read as a
    whole and has what a roll-up needs; else it says why the file is left out. Files of other days are not opened.

    Files without compression are read as lines, a large one by many tasks; those that end in one of ``DECODERS``, which no reader
    can split, are decoded by one task each, to their very end. Other endings are left to Spark's reader, whose errors end
    the read, as do those of the storage. The number of jobs does not depend on the number of files. The table is
    written once; what the driver holds are the files' paths, as any scan does.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder).inputFiles()
    listed = [(path, _date_of(path)) for path in sorted(map(unquote, files))]
    listed = [(path, date) for path, date in listed if date is None or start <= date <= end]
    packed = [path for path, date in listed if date and _ending(path) in DECODERS]
    plain = [path for path, date in listed if date and _ending(path) not in DECODERS]
    found = spark.createDataFrame([], "key string, line string, rows long, fault string")
    if plain:
        lines = spark.read.text(plain).where(F.trim("value") != "")
        place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
        lines = lines.select(F.col("_metadata.file_path").alias("key"), place.alias("place"), "value")
        counted = lines.groupBy("key").agg(F.min_by("value", "place").alias("line"), (F.count("*") - 1).alias("rows"))
        found = found.unionByName(counted.withColumn("fault", F.lit(None).cast("string")))
    if packed:
        content = spark.read.format("binaryFile").load(packed)
        content = content.select(F.col("_metadata.file_path").alias("key"), "content")
        found = found.unionByName(content.mapInArrow(_decode, "key string, line string, rows long, fault string"))
    known = {_plain(r["key"]): r for r in found.collect()}
    rows = []
    for path, date in listed:
        of = known.get(_plain(path))
        header, fault = _header_and_fault(of and of["line"], of and of["fault"]) if date else ((), "no date in its path")
        rows.append((path, date, list(header), of["rows"] if of else 0, fault))
    out = scratch_path(spark, "ledger")
    schema = "path string, date date, header array<string>, rows long, fault string"
    spark.createDataFrame(rows, schema).write.parquet(out)
    return spark.read.schema(schema).parquet(out)
