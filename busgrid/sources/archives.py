"""Zips of any size, and zips inside zips at any depth, as members that are tasks of their own.

The central directories of all archives of one level give a manifest: a row per member with
its place in the file and its packed length. Inner zips are unpacked to the shared folder,
each by a task of its own, and are the archives of the next level, until there are none.
Text members are checked against their checksums first and read by their byte range after;
no archive is opened whole, and there is one way for all sizes.

An archive that cannot be listed, or one of whose text members is damaged, encrypted or
oddly packed, gives a row with the problem and none of its own texts; an inner zip that
cannot be unpacked gives one under its own name. Other archives around or inside it are not
touched by that. An archive that contains itself would never end and is a problem, too.
"""

from __future__ import annotations

import bz2
import posixpath
import struct
import uuid
import zipfile
import zlib
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from busgrid.session import shuffle_partitions, work_folder, written
from busgrid.sources.records import ENCODING, RECORDS, texts_of_stream

PART_BYTES = 1 << 20
ROWS_PER_BATCH = 20_000
# What a damaged, encrypted or oddly compressed archive raises.
ZIP_ERRORS = (
    zipfile.BadZipFile, zlib.error, EOFError, RuntimeError, NotImplementedError, OSError, ValueError,
    struct.error,
)

ARCHIVES = "archive string, place string, ancestors string"
MEMBERS = (
    "archive string, place string, ancestors string, member string, is_zip boolean, at long, "
    "packed long, length long, method int, checksum long, encrypted boolean, problem string"
)
#: Fixed values of the format: the header before a member's bytes, and the ways to pack them.
LOCAL_HEADER = struct.Struct("<4s5H3I2H")
LOCAL_MARK = b"PK\x03\x04"
STORED, DEFLATED, BZIP2 = zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED, zipfile.ZIP_BZIP2


def _schema(text: str) -> pa.Schema:
    kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "boolean": pa.bool_()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in text.split(", "))])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema
    )


def _batches(rows: Iterable[tuple], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= ROWS_PER_BATCH:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _file_system(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


def opened(path: str):
    """A file of the shared file system, to be read at any place."""
    files, place = _file_system(path)
    if isinstance(files, fs.LocalFileSystem):
        return open(place, "rb")
    return files.open_input_file(place)


# --- members


def _members(wanted: Callable[[str], bool]):
    """Members of archives that are zips or ``wanted``; an unreadable archive is one row."""
    schema = _schema(MEMBERS)

    def members_of(row):
        archive, place, ancestors = row["archive"], row["place"], row["ancestors"]
        try:
            with opened(place) as stream, zipfile.ZipFile(stream) as listed:
                infos = listed.infolist()
        except ZIP_ERRORS as error:
            yield (archive, place, ancestors, *[None] * 8, f"{type(error).__name__}: {error}")
            return
        for info in infos:
            is_zip = info.filename.lower().endswith(".zip")
            if is_zip or wanted(info.filename):
                yield (
                    archive, place, ancestors, info.filename, is_zip, info.header_offset,
                    info.compress_size, info.file_size, info.compress_type, info.CRC,
                    bool(info.flag_bits & 1), None,
                )

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield from _batches(members_of(row), schema)

    return run


def _unpacker(method: int):
    if method == STORED:
        return None
    if method == DEFLATED:
        return zlib.decompressobj(-zlib.MAX_WBITS)
    if method == BZIP2:
        return bz2.BZ2Decompressor()
    raise NotImplementedError(f"packed by method {method}")


def member_parts(row: dict) -> Iterator[bytes]:
    """The bytes of a member in parts; its length and checksum are verified at the end."""
    if row["encrypted"]:
        raise RuntimeError("encrypted")
    unpacker = _unpacker(row["method"])
    with opened(row["place"]) as stream:
        stream.seek(row["at"])
        header = LOCAL_HEADER.unpack(stream.read(LOCAL_HEADER.size))
        if header[0] != LOCAL_MARK:
            raise zipfile.BadZipFile("no header where the directory has a member")
        stream.seek(row["at"] + LOCAL_HEADER.size + header[-2] + header[-1])
        left, length, checksum = row["packed"], 0, 0
        while left:
            part = stream.read(min(PART_BYTES, left))
            if not part:
                raise EOFError("a member ends early")
            left -= len(part)
            while part:
                if unpacker is None:
                    out, part = part, b""
                elif isinstance(unpacker, bz2.BZ2Decompressor):
                    out, part = unpacker.decompress(part), b""
                else:  # bounded, however well it is packed
                    out = unpacker.decompress(part, PART_BYTES)
                    part = unpacker.unconsumed_tail
                length, checksum = length + len(out), zlib.crc32(out, checksum)
                yield out
        if isinstance(unpacker, type(zlib.decompressobj())):
            out = unpacker.flush()
            length, checksum = length + len(out), zlib.crc32(out, checksum)
            yield out
        if length != row["length"] or checksum != row["checksum"]:
            raise zipfile.BadZipFile(f"damaged member {row['member']}")


def _settle(folder: str):
    """Checks text members; unpacks inner zips to files of their own, told in ``place``."""
    schema = _schema(MEMBERS)

    def settled(row):
        if row["problem"] is not None:
            return row
        own = f"{row['checksum']}:{row['length']}"
        try:
            if not row["is_zip"]:
                for _ in member_parts(row):
                    pass
            elif own in row["ancestors"].split("/"):
                raise zipfile.BadZipFile("an archive that contains itself")
            else:
                # A task that runs again writes another file; only what it returns is read.
                place = f"{folder}/{uuid.uuid4().hex}.zip"
                files, name = _file_system(place)
                files.create_dir(posixpath.dirname(name), recursive=True)
                with files.open_output_stream(name) as out:
                    for part in member_parts(row):
                        out.write(part)
                row = {**row, "place": place, "ancestors": f"{row['ancestors']}/{own}"}
        except ZIP_ERRORS as error:
            row = {**row, "problem": f"{type(error).__name__}: {error}"}
        return row

    def run(batches):
        for batch in batches:
            rows = (tuple(settled(row).values()) for row in batch.to_pylist())
            yield from _batches(rows, schema)

    return run


def _name_inside() -> Column:
    """The name of an inner zip: the path of the archive around it, then its own."""
    return F.concat_ws("/", "archive", "member")


def members(files: DataFrame, wanted: Callable[[str], bool]) -> DataFrame:
    """Checked members of all archives (path) and of all archives inside them, written."""
    spark = files.sparkSession
    partitions = shuffle_partitions(spark)
    level = files.select(F.col("path").alias("archive"), F.col("path").alias("place"), F.lit("").alias("ancestors"))
    found = None
    while True:
        # An archive, and then a member, is a task's unit; neither is ever held whole.
        listed = level.repartition(partitions, "place").mapInArrow(_members(wanted), MEMBERS)
        dealt = listed.repartition(partitions, "place", "at")
        here = written(dealt.mapInArrow(_settle(work_folder(spark, "inner-zips")), MEMBERS), "members")
        found = here if found is None else found.unionByName(here)
        inner = here.where("is_zip and problem is null")
        if inner.isEmpty():
            return found
        level = inner.select(_name_inside().alias("archive"), "place", "ancestors")


# --- records


def _read(table_of: Callable[[str], str | None]):
    schema = _schema(RECORDS)

    def records_of(row):
        table = table_of(row["member"])
        feed = posixpath.join(row["archive"], posixpath.dirname(row["member"])).rstrip("/")
        for number, (text, problem) in enumerate(texts_of_stream(member_parts(row), ENCODING), 1):
            yield feed, table, number, text, problem

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                yield from _batches(records_of(row), schema)

    return run


def records(files: DataFrame, table_of: Callable[[str], str | None]) -> DataFrame:
    """Record texts (feed_id, table, line_no, text, problem) of the zips given as (path).

    ``table_of`` names the table of a member, or None for members that are not read. A feed
    has the path of its zip as name, with the names of the zips around it before.
    """
    every = members(files, lambda name: table_of(name) is not None)
    failed = F.col("problem").isNotNull()
    problems = every.where(failed)
    # An inner zip that cannot be unpacked is told by its own name; so are unreadable archives.
    name = F.when(F.col("is_zip"), _name_inside()).otherwise(F.col("archive"))
    told = (
        problems.groupBy(name.alias("feed_id"))
        .agg(F.min("problem").alias("problem"))
        .select(
            "feed_id",
            F.lit(None).cast("string").alias("table"),
            F.lit(None).cast("long").alias("line_no"),
            F.lit(None).cast("string").alias("text"),
            "problem",
        )
    )
    bad = problems.where("not coalesce(is_zip, false)").select("archive").distinct()
    sound = every.where(~failed & ~F.col("is_zip")).join(bad, "archive", "left_anti")
    partitions = shuffle_partitions(files.sparkSession)
    read = sound.select(every.columns).repartition(partitions, "place", "at")
    return read.mapInArrow(_read(table_of), RECORDS).unionByName(told)
