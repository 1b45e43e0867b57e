"""WARC archives as a PySpark Python data source, for reading and writing.

Reading plans partitions from the files' sizes: small files are packed together, large
ones that have an index of record offsets beside them are cut into ranges.  Predicates
on the record type and on header columns are pushed down; each record's headers are
parsed first, and the payload of a record that is not wanted (by predicate, or by the
option ``payload``) is neither inflated further than its headers, where the index gives
the next record, nor decoded.

Writing gives each task files of its own (one gzip member per record, rolled at
``max_file_bytes``) with an index; ``commit`` writes a manifest that names them, and
readers take only files that a manifest names, if there is any manifest.  Files of
failed or repeated tasks are therefore never read.  Files are reached through
``pyarrow.fs``, by the URI's scheme.

Options for reading: ``payload`` (``all``, ``none`` or record types separated by commas),
``split_bytes``, ``verify`` (payloads against their digests, default true).
Options for writing: ``max_file_bytes``, ``level``, ``date``.

Defined cases: a null payload is empty; a null target or refers_to is left out and read
back as null; control characters and spaces in header values are percent-encoded;
records of any length are handled one at a time; repeated rows are records of their own;
an empty table writes an empty manifest and reads back as no rows; columns other than
those of ``FIELDS`` are refused.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import (DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition,
                                    IsNotNull, StringStartsWith, WriterCommitMessage)

from loglynx.llm.common import cut, join_hot
from loglynx.session import work_dir

FIELDS = ("record_id string, record_type string, target_uri string, refers_to string, payload_digest string, "
          "payload_bytes long, content_type string, content_length long, payload binary")
WRITE_FIELDS = ["record_id", "record_type", "target_uri", "refers_to", "payload"]
HEADERS = {"record_id": "warc-record-id", "record_type": "warc-type", "target_uri": "warc-target-uri",
           "refers_to": "warc-refers-to", "payload_digest": "warc-payload-digest", "content_type": "content-type"}
MAX_BROADCAST_DIGESTS = 500_000
BATCH_BYTES = 16 << 20
READ = 1 << 16


def filesystem(path: str) -> tuple[pafs.FileSystem, str]:
    path = re.sub(r"^file:/(?!/)", "file:///", path)
    return pafs.FileSystem.from_uri(path)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def header_value(value: str) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value)


def record(record_id: str, record_type: str, target_uri: str | None, refers_to: str | None, payload: bytes, date: str) -> bytes:
    """One record.  A revisit has its payload's digest and length, but not the payload."""
    if record_type == "response":
        block = (f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n").encode() + payload
    else:
        block = b""
    lines = ["WARC/1.1", f"WARC-Type: {header_value(record_type)}", f"WARC-Record-ID: <{header_value(record_id)}>", f"WARC-Date: {date}"]
    if target_uri is not None:
        lines.append(f"WARC-Target-URI: {header_value(target_uri)}")
    if record_type == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    if refers_to is not None:
        lines.append(f"WARC-Refers-To: <{header_value(refers_to)}>")
    lines += [f"WARC-Payload-Digest: sha1:{digest(payload)}", f"X-Payload-Length: {len(payload)}",
              "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


@dataclass
class Written(WriterCommitMessage):
    files: list


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, path: str, options: dict):
        self.path = path
        self.limit = int(options.get("max_file_bytes", 512 << 20))
        self.level = int(options.get("level", 4))
        self.date = options.get("date", "1970-01-01T00:00:00Z")

    def write(self, iterator) -> Written:
        fs, root = filesystem(self.path)
        fs.create_dir(root, recursive=True)
        files, out, offsets = [], None, []

        def close():
            out.close()
            with fs.open_output_stream(f"{root}/{files[-1]}.idx") as idx:
                idx.write(np.array(offsets, "<i8").tobytes())

        for batch in iterator:
            cols = {c: batch.column(batch.schema.get_field_index(c)) for c in WRITE_FIELDS}
            for i in range(batch.num_rows):
                if out is None or out.tell() >= self.limit:
                    if out is not None:
                        close()
                    files.append(f"part-{uuid.uuid4().hex}.warc.gz")
                    out, offsets = fs.open_output_stream(f"{root}/{files[-1]}", compression=None), []
                offsets.append(out.tell())
                v = [cols[c][i].as_py() for c in WRITE_FIELDS]
                pack = zlib.compressobj(self.level, zlib.DEFLATED, 31)
                out.write(pack.compress(record(v[0], v[1], v[2], v[3], v[4] or b"", self.date)) + pack.flush())
        if out is not None:
            close()
        return Written(files)

    def commit(self, messages) -> None:
        fs, root = filesystem(self.path)
        fs.create_dir(root, recursive=True)
        names = [f for m in messages if m is not None for f in m.files]
        with fs.open_output_stream(f"{root}/manifest-{uuid.uuid4().hex}.json") as out:
            out.write(json.dumps(names).encode())

    def abort(self, messages) -> None:
        fs, root = filesystem(self.path)
        for name in (f for m in messages if m is not None for f in m.files):
            for x in (name, f"{name}.idx"):
                if fs.get_file_info(f"{root}/{x}").type != pafs.FileType.NotFound:
                    fs.delete_file(f"{root}/{x}")


@dataclass
class Ranges(InputPartition):
    ranges: list  # (file, first byte, end byte or None)


def headers(block: bytes) -> dict[str, str]:
    """The named fields, names in lower case, of a header block without its first line."""
    out = {}
    for line in block.split(b"\r\n")[1:]:
        name, _, value = line.partition(b":")
        out[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return out


class Stream:
    """Records of a byte range, headers first.  ``offsets`` (of the records, if known) allow to skip."""

    def __init__(self, source, gz: bool, start: int, end: int | None, offsets: np.ndarray | None):
        self.source, self.gz, self.end, self.offsets = source, gz, end, offsets
        self.size = source.size()
        self.at = start  # of the record in the file
        self.seek(start)

    def seek(self, at: int) -> None:
        self.source.seek(at)
        self.inflate = zlib.decompressobj(31) if self.gz else None
        self.buffer = b""

    def more(self) -> bool:
        if self.inflate is None:
            data = self.source.read(READ)
            self.buffer += data
            return bool(data)
        while True:
            if self.inflate.eof:  # the next member
                rest = self.inflate.unused_data
                self.inflate = zlib.decompressobj(31)
                data = rest or self.source.read(READ)
            else:
                data = self.inflate.unconsumed_tail or self.source.read(READ)
            if not data:
                return False
            out = self.inflate.decompress(data, READ)
            if out:
                self.buffer += out
                return True

    def take(self, n: int) -> bytes:
        parts, have = [self.buffer], len(self.buffer)
        while have < n:
            self.buffer = b""
            if not self.more():
                raise EOFError("a record is cut short")
            parts.append(self.buffer)
            have += len(self.buffer)
        data = b"".join(parts)
        self.buffer = data[n:]
        return data[:n]

    def drop(self, n: int) -> None:
        while len(self.buffer) < n:
            n -= len(self.buffer)
            self.buffer = b""
            if not self.more():
                raise EOFError("a record is cut short")
        self.buffer = self.buffer[n:]

    def head(self) -> bytes | None:
        """The next record's header block, None at the end."""
        while True:
            self.buffer = self.buffer.lstrip(b"\r\n") if not self.buffer.startswith(b"WARC/") else self.buffer
            cut = self.buffer.find(b"\r\n\r\n")
            if cut >= 0:
                block, self.buffer = self.buffer[:cut], self.buffer[cut + 4:]
                return block
            if not self.more():
                if self.buffer.strip():
                    raise EOFError("a header is cut short")
                return None

    def records(self, wanted, payload) -> Iterator[tuple[dict, bytes | None]]:
        """(headers, block or None) of the records that ``wanted`` (by headers); the block where ``payload`` says so."""
        known = self.offsets is not None
        for at in (self.offsets.tolist() if known else iter(int, 1)):
            if known:
                self.seek(at)
            block = self.head()
            if block is None:
                return
            h = headers(block)
            n = int(h.get("content-length", "0"))
            if wanted(h):
                if payload(h):
                    yield h, self.take(n)
                    n = 0
                else:
                    yield h, None
            if not known and n:
                self.drop(n)


class WarcReader(DataSourceReader):
    def __init__(self, path: str, options: dict):
        self.path = path
        self.split = int(options.get("split_bytes", 128 << 20))
        self.verify = options.get("verify", "true").lower() != "false"
        self.payload = options.get("payload", "all")
        self.tests: list[tuple[str, str, object]] = []  # header, test, value

    def pushFilters(self, filters):
        for f in filters:
            name = HEADERS.get(f.attribute[0]) if hasattr(f, "attribute") and len(f.attribute) == 1 else None
            if isinstance(f, EqualTo) and name:
                self.tests.append((name, "in", [f.value]))
            elif isinstance(f, In) and name:
                self.tests.append((name, "in", list(f.value)))
            elif isinstance(f, StringStartsWith) and name:
                self.tests.append((name, "start", f.value))
            elif isinstance(f, IsNotNull) and name:
                self.tests.append((name, "there", None))
            else:
                yield f

    def partitions(self):
        fs, root = filesystem(self.path)
        infos = fs.get_file_info(pafs.FileSelector(root, recursive=True, allow_not_found=True))
        manifests = [i.path for i in infos if re.search(r"/manifest-[0-9a-f]+\.json$", i.path)]
        named = set()
        for m in manifests:
            with fs.open_input_stream(m) as f:
                named |= {f"{m.rpartition('/')[0]}/{x}" for x in json.loads(f.read())}
        sizes = {i.path: i.size for i in infos if re.search(r"\.warc(\.gz)?$", i.path) and (not manifests or i.path in named)}
        indexed = {i.path.removesuffix(".idx") for i in infos if i.path.endswith(".idx")}
        out, pack, held = [], [], 0
        for path in sorted(sizes):
            size = sizes[path]
            if size > self.split and path in indexed:
                with fs.open_input_stream(f"{path}.idx") as f:
                    offs = np.frombuffer(f.read(), "<i8")
                cuts = offs[np.unique(np.searchsorted(offs, np.arange(0, size, self.split)).clip(max=len(offs) - 1))].tolist()
                out += [Ranges([(path, a, b, True)]) for a, b in zip(cuts, [*cuts[1:], size])]
                continue
            if pack and held + size > self.split:
                out.append(Ranges(pack))
                pack, held = [], 0
            pack.append((path, 0, size, path in indexed))
            held += size
        return out + ([Ranges(pack)] if pack else []) or [Ranges([])]

    def wanted(self, h: dict) -> bool:
        for name, test, value in self.tests:
            own = clean(name, h.get(name))
            if own is None or test == "in" and own not in value or test == "start" and not own.startswith(value):
                return False
        return True

    def read(self, partition):
        fs, _ = filesystem(self.path)
        types = None if self.payload == "all" else set() if self.payload == "none" else set(self.payload.split(","))
        wants = lambda h: types is None or h.get("warc-type") in types
        rows, held = [], 0
        for path, a, b, indexed in partition.ranges:
            offsets = None
            if indexed:
                with fs.open_input_stream(f"{path}.idx") as f:
                    offsets = np.frombuffer(f.read(), "<i8")
                offsets = offsets[(offsets >= a) & (offsets < b)]
            with fs.open_input_file(path) as source:
                for h, block in Stream(source, path.endswith(".gz"), a, b, offsets).records(self.wanted, wants):
                    rows.append(self.row(h, block))
                    held += len(block or b"") + 500
                    if held >= BATCH_BYTES:
                        yield to_batch(rows)
                        rows, held = [], 0
        if rows:
            yield to_batch(rows)

    def row(self, h: dict, block: bytes | None) -> dict:
        out = {c: clean(name, h.get(name)) for c, name in HEADERS.items()}
        out["content_length"] = int(h.get("content-length", "0"))
        out["payload_bytes"] = int(h["x-payload-length"]) if "x-payload-length" in h else None
        out["payload"] = None
        if block is not None and out["record_type"] != "revisit":
            http = (out["content_type"] or "").startswith("application/http")
            payload = block.partition(b"\r\n\r\n")[2] if http else block
            if self.verify and out["payload_digest"] and digest(payload) != out["payload_digest"]:
                raise ValueError(f"{out['record_id']}: the payload does not match its digest")
            out["payload"], out["payload_bytes"] = payload, len(payload)
        return out


def clean(name: str, value: str | None) -> str | None:
    """A header's value without brackets or the digest's algorithm."""
    if value is None:
        return None
    if name in ("warc-record-id", "warc-refers-to"):
        return value.removeprefix("<").removesuffix(">")
    return value.removeprefix("sha1:") if name == "warc-payload-digest" else value


ARROW = pa.schema([(f.split()[0], {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[f.split()[1]]) for f in FIELDS.split(", ")])


def to_batch(rows: list[dict]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[f.name] for r in rows], f.type) for f in ARROW], schema=ARROW)


class WarcSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "loglynx_warc"

    def schema(self) -> str:
        return FIELDS

    def reader(self, schema) -> WarcReader:
        return WarcReader(self.options["path"], dict(self.options))

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        if overwrite:
            raise ValueError("archives are only appended to")
        if extra := set(schema.names) ^ set(WRITE_FIELDS):
            raise ValueError(f"columns to write are {WRITE_FIELDS}; differing: {sorted(extra)}")
        return WarcWriter(self.options["path"], dict(self.options))


def register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(WarcSource)


def write(records: DataFrame, path: str, **options) -> None:
    """``records`` (columns WRITE_FIELDS) as archives under ``path``."""
    register(records.sparkSession)
    records.select(*WRITE_FIELDS).write.format("loglynx_warc").options(**options).mode("append").save(path)


def read(spark: SparkSession, path: str, **options) -> DataFrame:
    register(spark)
    return spark.read.format("loglynx_warc").options(**options).load(path)


def deduplicated(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html", min_bytes: int = 0) -> DataFrame:
    """Records of ``pages``: of equal payloads with at least ``min_bytes`` bytes the row with the largest
    key is a response and the others revisit it (rows that share that key and payload are all responses).
    A null key is the smallest; payloads whose keys are all null stay responses.

    Only digests that occur twice or more are joined back, by broadcast up to MAX_BROADCAST_DIGESTS."""
    rows = pages.select(F.col(key).alias("k"), F.col(url).cast("string").alias("target_uri"),
                        F.coalesce(F.encode(F.col(body).cast("string"), "utf-8"), F.lit(b"")).alias("payload"))
    rows = rows.withColumn("sha", F.sha1("payload"))
    dup = cut(rows.where(F.octet_length("payload") >= min_bytes).groupBy("sha").agg(
        F.max("k").alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1"))
    if dup.count() <= MAX_BROADCAST_DIGESTS:
        j = rows.join(F.broadcast(dup), "sha", "left")
    else:
        j = join_hot(rows, dup, "sha", "n", rows.count())
    revisit = F.col("n").isNotNull() & F.col("top").isNotNull() & ~F.col("k").eqNullSafe(F.col("top"))
    urn = lambda c: F.concat(F.lit("urn:page:"), F.coalesce(c.cast("string"), F.lit("null")))
    return j.select(urn(F.col("k")).alias("record_id"), F.when(revisit, "revisit").otherwise("response").alias("record_type"),
                    "target_uri", F.when(revisit, urn(F.col("top"))).alias("refers_to"), "payload")


def round_trip(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html", min_bytes: int = 0) -> DataFrame:
    """Write the archives of ``pages`` to the shared folder and read them back: one row per page."""
    spark = pages.sparkSession
    path = f"{work_dir(spark, 'warc')}/archive"
    write(deduplicated(pages, key, url, body, min_bytes), path)
    back = read(spark, path, payload="response")
    kind = pages.schema[key].dataType
    own = lambda c: F.nullif(F.regexp_extract(c, "^urn:page:(.*)$", 1), F.lit("null")).cast(kind)
    return back.select(own(F.col("record_id")).alias(key), "payload_bytes", "payload_digest", "record_type", own(F.col("refers_to")).alias("refers_to"))
