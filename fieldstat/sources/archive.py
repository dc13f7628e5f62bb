"""Read named members of zip exports, in parallel across members.

A first pass lists (archive, member) pairs from the zip directories; the pairs
are then dealt out, so the members of one archive are read by different tasks.
A task opens the archive by its path (``pyarrow.fs``), reads the zip by random
access and streams its member as *blocks*: rows of ``(archive, member,
first_line, n_lines, lines)`` with a bounded number of consecutive lines.  No
archive and no member is ever held whole, whatever its size.  ``records`` (in
``sources.records``) cuts stored blocks into records, whose quoted fields may
hold line breaks; ``archive_lines`` gives plain lines.  The typed frame comes
from ``from_csv`` on the line column (JVM side).  ``line_no`` keeps the
export's row order within a member, ``source_no`` over all archives.

Archives that already are rows (``path`` and ``content``) are read from the
content instead (``explode_archives``, ``explode_blocks``).
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

def _open_path(path: str):
    """A seekable file for a Spark path (file:, hdfs:, s3a:, gs:, abfs: ...)."""
    from pyarrow import fs
    if path.startswith("file:"):
        local = path[len("file:"):]
        while local.startswith("//"):
            local = local[1:]
        return fs.LocalFileSystem().open_input_file(local)
    uri = "s3://" + path.split("://", 1)[1] if path.startswith(("s3a://", "s3n://")) else path
    filesystem, inner = fs.FileSystem.from_uri(uri)
    return filesystem.open_input_file(inner)


BLOCK_SCHEMA = T.StructType([
    T.StructField("archive", T.StringType()),
    T.StructField("member", T.StringType()),
    T.StructField("first_line", T.LongType()),
    T.StructField("n_lines", T.LongType()),
    T.StructField("lines", T.ArrayType(T.StringType())),
])

#: Lines of a block, and characters after which it ends early.
BLOCK_LINES = 4096
BLOCK_CHARS = 4 << 20


def _blocks(path: str, zf: zipfile.ZipFile, member: str, block_lines: int, header_only: bool) -> Iterator[pd.DataFrame]:
    def block(first: int, rows: list[str]) -> pd.DataFrame:
        return pd.DataFrame({"archive": [path], "member": [member], "first_line": [first], "n_lines": [len(rows)],
                             "lines": [rows]})

    first, rows, held = 0, [], 0
    with zf.open(member) as fh:
        # lines end at "\n" only (a stray "\r" inside a field stays in it); a
        # bad byte becomes U+FFFD instead of failing the task, as readr
        # tolerates it
        for line in io.TextIOWrapper(fh, encoding="utf-8-sig", newline="\n", errors="replace"):
            rows.append(line.removesuffix("\n"))
            held += len(line)
            if header_only:
                break
            if len(rows) >= block_lines or held >= BLOCK_CHARS:
                yield block(first, rows)
                first, rows, held = first + len(rows), [], 0
    if rows:
        yield block(first, rows)


def _members(zf: zipfile.ZipFile, wanted: set[str] | None) -> list[str]:
    return [i.filename for i in zf.infolist() if not i.is_dir() and (wanted is None or i.filename in wanted)]


def as_lines(blocks: DataFrame) -> DataFrame:
    """Blocks as rows of one line each."""
    rows = blocks.select("archive", "member", "first_line", F.posexplode("lines").alias("at", "line"))
    return rows.select("archive", "member", (F.col("first_line") + F.col("at")).alias("line_no"),
                       F.rtrim("line", F.lit("\r")).alias("line"))


def explode_blocks(files: DataFrame, members: Iterable[str] | None = None, block_lines: int = BLOCK_LINES,
                   header_only: bool = False) -> DataFrame:
    """Blocks of the wanted members of archives held as rows (``path``, ``content``)."""
    wanted = set(members) if members else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for path, content in zip(pdf["path"], pdf["content"]):
                with zipfile.ZipFile(io.BytesIO(content)) as zf:
                    for member in _members(zf, wanted):
                        yield from _blocks(path, zf, member, block_lines, header_only)

    return files.select("path", "content").mapInPandas(run, BLOCK_SCHEMA)


def explode_archives(files: DataFrame, members: Iterable[str] | None = None,
                     block_lines: int = BLOCK_LINES, header_only: bool = False) -> DataFrame:
    """Lines of the wanted members of archives held as rows.  ``line_no`` 0 is
    a member's header line; ``header_only`` reads just that line."""
    return as_lines(explode_blocks(files, members, block_lines, header_only))


def archive_members(spark: SparkSession, path: str, members: Iterable[str] | None = None,
                    glob: str = "*.zip") -> DataFrame:
    """(archive, member) of the wanted members of every archive under
    ``path``, dealt one to a task (within what the session's cores can use).
    Only the zip directories are read."""
    wanted = set(members) if members else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name in pdf["path"]:
                with _open_path(name) as source, zipfile.ZipFile(source) as zf:
                    found = _members(zf, wanted)
                yield pd.DataFrame({"archive": name, "member": pd.Series(found, dtype=object)})

    files = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path")
    spread = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    pairs = files.repartition(spread).mapInPandas(run, "archive string, member string")
    return pairs.repartition(max(1, min(pairs.count(), 8 * spread)))


def archive_blocks(spark: SparkSession, path: str, members: Iterable[str] | None = None, glob: str = "*.zip",
                   block_lines: int = BLOCK_LINES, header_only: bool = False) -> DataFrame:
    """``unzip(zip, member)`` for every archive under ``path``, as blocks of lines."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for name, member in zip(pdf["archive"], pdf["member"]):
                with _open_path(name) as source, zipfile.ZipFile(source) as zf:
                    yield from _blocks(name, zf, member, block_lines, header_only)

    return archive_members(spark, path, members, glob).mapInPandas(run, BLOCK_SCHEMA)


def archive_lines(spark: SparkSession, path: str, members: Iterable[str] | None = None, glob: str = "*.zip",
                  block_lines: int = BLOCK_LINES) -> DataFrame:
    """``unzip(zip, member)`` for every archive under ``path``, as lines."""
    return as_lines(archive_blocks(spark, path, members, glob, block_lines))


def archive_headers(spark: SparkSession, path: str, members: Iterable[str] | None = None,
                    glob: str = "*.zip") -> DataFrame:
    """The header line of every wanted member of every archive, reading one
    line per member (no full pass over the data)."""
    return as_lines(archive_blocks(spark, path, members, glob, 1, True))


def check_headers(headers: DataFrame, expected: dict[str, list[str]], sep: str = "\t") -> None:
    """Fail early when a member of ``expected`` is in no archive, or when any
    archive's header differs from the names given.  Headers are compared where
    they are; one row per member reaches the driver."""
    names = F.transform(F.split("line", F.concat(F.lit("\\Q"), F.lit(sep), F.lit("\\E"))),
                        lambda x: F.btrim(x, F.lit('"')))
    wanted = F.lit(None).cast("array<string>")
    for member, columns in expected.items():
        wanted = F.when(F.col("member") == member, F.array(*[F.lit(c) for c in columns])).otherwise(wanted)
    found = (headers.where(F.col("member").isin(list(expected)))
             .select("member", F.when(names != wanted, F.col("line")).alias("other"))
             .groupBy("member").agg(F.min("other").alias("other")).collect())
    for member in expected:
        if member not in {r["member"] for r in found}:
            raise FileNotFoundError(f"member {member!r} not found in any archive")
    for r in found:
        if r["other"] is not None:
            raise ValueError(f"member {r['member']!r}: header {r['other']!r} does not match schema "
                             f"{expected[r['member']]}")


def read_member(lines: DataFrame, member: str, schema: T.StructType, sep: str = "\t",
                null_value: str = "NA", check_header: bool = True,
                headers: DataFrame | None = None) -> DataFrame:
    """Typed rows of one member (``read_delim(unzip(zip, member))``): the
    member's columns in header order, then ``archive`` and ``line_no`` for
    provenance and source order; ``line_no`` is the number over all archives
    where ``lines`` has one (``number_records``).

    ``check_header`` fails early when the member is missing or a header
    differs from ``schema``.  Pass ``headers`` (from ``archive_headers``) to
    check by reading one line per member; without it the check filters
    ``lines`` for the header rows, which streams the archives once more.
    """
    rows = lines.where(F.col("member") == member)
    if check_header:
        heads = headers if headers is not None else rows.where(F.col("line_no") == 0)
        check_headers(heads, {member: schema.fieldNames()}, sep)
    # a quote inside a quoted field is doubled; a backslash is an ordinary character
    opts = {"sep": sep, "nullValue": null_value, "mode": "PERMISSIVE", "escape": '"'}
    # readr skips blank lines
    parsed = rows.where((F.col("line_no") > 0) & (F.col("line") != "")).select(
        "archive", F.col("source_no" if "source_no" in rows.columns else "line_no").alias("line_no"), F.from_csv("line", schema.simpleString(), opts).alias("r"))
    out = parsed.select("r.*", "archive", "line_no")
    # readr reads an empty field as missing for every type, text included
    return out.withColumns({f.name: F.when(F.col(f"`{f.name}`") != "", F.col(f"`{f.name}`"))
                            for f in schema.fields if isinstance(f.dataType, T.StringType)})
