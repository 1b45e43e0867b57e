"""Log files by byte ranges: a Python data source of lines with their place in the file (ST1, N7).

``spark.read.format("loglynx_lines")`` reads whole files, ``spark.readStream`` follows
growing ones.  Rows: file_path, line_at (the byte where the line begins), value.  Options:
``path`` (comma-separated files, folders or glob patterns of any store that pyarrow opens
by its URI), ``start`` (``end``: only what is written after the query's first start;
``start``: all), ``split_bytes`` (a file's new bytes are cut into ranges of this size, each
read by a task of its own).

Following.  The offset has, for each file, the byte behind its last whole line: a line that
is half written waits for its end.  A file is known by its folder, its name without a
rotation suffix (``.1``, ``-20240131``) and its first line.  So a file that was renamed goes on
where it was, with what was written just before; one that was emptied or replaced is a new
file and is read from its beginning; an older file that shows up with another first line is
new too.  The last line of a file with a rotation suffix needs no line end.  Nothing is
remembered outside the offset, so a restart from the checkpoint goes on as if it had not
stopped, and a batch that is run again reads the same bytes.

Only ``\\n`` ends a line (a ``\\r`` before it goes); bytes that are not UTF-8 become U+FFFD; a
line is read by the task in whose range it begins, however long it is.  Files that vanish
before they are read, or have no whole line yet, have no rows; compressed files are read
whole in a batch and not followed.  The offset grows with the number of files followed, not with their size.
"""

from __future__ import annotations

import fnmatch
import os
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "file_path string, line_at long, value string"
BLOCK = 4 << 20
PACKED = (".gz", ".bz2", ".zst", ".lz4")  # read whole, by one task each; places are those of the unpacked bytes
FIRST_LINE = 4096  # bytes of the first line that tell a file from another
SPLIT = 64 << 20
ROTATED = re.compile(r"(\.\d+|-\d{8})$")


def _store(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", uri)) if ":" in uri else pafs.FileSystem.from_uri(os.path.abspath(uri))


def files(paths: str) -> list[tuple[str, int]]:
    """(URI, size) of the files that the patterns name; hidden files are left out."""
    found = {}
    for pattern in filter(None, (p.strip() for p in paths.split(","))):
        fs, path = _store(pattern)
        prefix = pattern[: len(pattern) - len(path)] if pattern.endswith(path) else ""
        parts = path.split("/")
        fixed = next((i for i, p in enumerate(parts) if re.search(r"[*?\[]", p)), len(parts))
        base = "/".join(parts[:fixed]) or "/"
        info = fs.get_file_info(base)
        if info.type == pafs.FileType.File:
            infos, want = [info], None
        elif info.type == pafs.FileType.Directory:
            infos = fs.get_file_info(pafs.FileSelector(base, recursive=fixed < len(parts) - 1))
            want = path.rstrip("/") if fixed < len(parts) else None
        else:
            continue
        for f in infos:
            same_depth = want is None or (f.path.count("/") == want.count("/") and fnmatch.fnmatchcase(f.path, want))
            if f.type == pafs.FileType.File and same_depth and not os.path.basename(f.path).startswith((".", "_")):
                found[prefix + f.path] = f.size
    return sorted(found.items())


def identity(uri: str) -> str | None:
    """What a file is known by, if it has a whole first line."""
    fs, path = _store(uri)
    with fs.open_input_file(path) as f:
        head = f.read(FIRST_LINE)
    if b"\n" not in head and len(head) < FIRST_LINE:
        return None
    return f"{ROTATED.sub('', uri)}#{zlib.crc32(head.split(b'\n', 1)[0]):08x}"


def last_line_end(uri: str, size: int) -> int:
    """The byte behind the last line end of the first ``size`` bytes; all of them for a rotated file."""
    if ROTATED.search(uri):
        return size
    fs, path = _store(uri)
    with fs.open_input_file(path) as f:
        to = size
        while to > 0:
            at = max(0, to - (64 << 10))
            f.seek(at)
            i = f.read(to - at).rfind(b"\n")
            if i >= 0:
                return at + i + 1
            to = at
    return 0


def ends(paths: str) -> dict:
    """{identity: [URI, byte behind the last whole line]} of the files as they are now."""
    out: dict[str, list] = {}
    for uri, size in files(paths):
        if uri.endswith(PACKED):
            continue
        try:
            who = identity(uri)
            at = last_line_end(uri, size) if who else 0
        except OSError:
            continue  # gone meanwhile
        if who and at >= out.get(who, ["", -1])[1]:  # of a file and a copy of it the longer
            out[who] = [uri, at]
    return out


@dataclass
class Range(InputPartition):
    uri: str
    begin: int
    end: int
    whole: bool  # the range begins with a line
    limit: int  # bytes behind are not looked at: they may be written just now


NOTHING = Range("", 0, 0, True, 0)


def ranges(uri: str, begin: int, end: int, split: int) -> list[Range]:
    return [Range(uri, at, min(at + split, end), at == begin, end) for at in range(begin, end, split)] if begin < end else []


def read_range(part: Range) -> Iterator[pa.RecordBatch]:
    """The lines that begin in the range."""
    if part.begin >= part.end:
        return
    fs, path = _store(part.uri)
    packed = part.uri.endswith(PACKED)
    try:
        f = fs.open_input_stream(path, compression="detect") if packed else fs.open_input_file(path)
    except OSError:
        return
    with f:
        at = part.begin
        if not packed:
            f.seek(at if part.whole else at - 1)
        skip = not part.whole  # a line that began before belongs to the range before
        at -= skip
        rest = b""
        while True:
            block = f.read(max(0, min(BLOCK, part.limit - at - len(rest))))
            data = rest + block
            lines = data.split(b"\n")
            rest = lines.pop()
            if not block and rest:
                lines, rest = [*lines, rest], b""
            places, values = [], []
            for line in lines:
                if not skip and at < part.end:
                    places.append(at)
                    values.append((line[:-1] if line.endswith(b"\r") else line).decode("utf-8", "replace"))
                skip = False
                at += len(line) + 1
            if values:
                yield pa.RecordBatch.from_arrays([pa.array([part.uri] * len(values)), pa.array(places, pa.int64()), pa.array(values)],
                                                 names=["file_path", "line_at", "value"])
            if not block or at >= part.end:
                return


class _Reader(DataSourceReader):
    def __init__(self, paths: str, split: int):
        self.paths, self.split = paths, split

    def partitions(self):
        found = files(self.paths)
        return [r for uri, size in found if not uri.endswith(PACKED) for r in ranges(uri, 0, size, self.split)
                ] + [Range(uri, 0, 1 << 62, True, 1 << 62) for uri, _ in found if uri.endswith(PACKED)] or [NOTHING]

    def read(self, part: Range):
        yield from read_range(part)


class _Follower(DataSourceStreamReader):
    def __init__(self, paths: str, start: str, split: int):
        self.paths, self.start, self.split = paths, start, split

    def initialOffset(self) -> dict:
        return ends(self.paths) if self.start == "end" else {}

    def latestOffset(self) -> dict:
        return ends(self.paths)

    def partitions(self, start: dict, end: dict):
        return [r for who, (uri, to) in sorted(end.items()) for r in ranges(uri, start.get(who, [uri, 0])[1], to, self.split)
                ] or [NOTHING]

    def read(self, part: Range):
        yield from read_range(part)

    def commit(self, end: dict) -> None:
        pass


class LineSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "loglynx_lines"

    def schema(self) -> str:
        return SCHEMA

    def _options(self) -> tuple[str, str, int]:
        start = self.options.get("start", "end")
        if "path" not in self.options or start not in ("start", "end"):
            raise ValueError("path is required, and start is 'start' or 'end'")
        return self.options["path"], start, int(self.options.get("split_bytes", SPLIT))

    def reader(self, schema):
        paths, _, split = self._options()
        return _Reader(paths, split)

    def streamReader(self, schema):
        return _Follower(*self._options())


def _paths(paths) -> str:
    return paths if isinstance(paths, str) else ",".join(paths)


def placed_lines(spark: SparkSession, paths, split_bytes: int = SPLIT) -> DataFrame:
    """Lines of files with their places; like ``logs.read_lines``, but equal lines of a file can be told apart."""
    spark.dataSource.register(LineSource)
    return spark.read.format("loglynx_lines").option("path", _paths(paths)).option("split_bytes", split_bytes).load()


def tail_lines(spark: SparkSession, paths, start: str = "end", split_bytes: int = SPLIT) -> DataFrame:
    """ST1: lines appended to growing files, as a stream."""
    spark.dataSource.register(LineSource)
    return spark.readStream.format("loglynx_lines").options(path=_paths(paths), start=start, split_bytes=split_bytes).load()
