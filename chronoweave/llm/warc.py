"""WARC archives as a data source: ``spark.read.format("warc")`` and ``df.write.format("warc")``.

*Reading.* The driver lists the files once and plans partitions of whole files, small ones together. A task parses a
record's header first. Predicates on the record type and on headers decide there, from pushed filters (option ``pushdown``) or from the options below; of a record that fails, or whose payload nobody
wants, the payload is passed over without being gathered: sought past in plain files, inflated in small pieces and dropped in
compressed ones.

*Writing.* A task writes files of about ``file_bytes`` with a gzip member for each record, after one ``warcinfo`` record that says
what the file is (option ``info``); a job's files count once its manifest is written, so what failed or repeated attempts leave
behind is never read.

Options: ``pushdown`` (``true``: see ``PushingReader``), ``types`` (record types, by comma), ``payload`` (``all``, ``none`` or the types whose payload is wanted),
``header.<Name>`` (a header's value), ``split_bytes``, ``file_bytes``, ``level``, ``info`` (``true``: see above; else no such record).

Columns: see ``COLUMNS``. A null payload is empty; null headers are left out; a header's control characters are escaped.
The files are reached by ``pyarrow.fs``: any folder whose URI it knows (local and shared file systems, HDFS, object stores).
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, In, InputPartition, WriterCommitMessage

from chronoweave.llm.store import fresh_path

#: Column, header it stands for.
HEADERS = {
    "record_type": "WARC-Type", "record_id": "WARC-Record-ID", "target_uri": "WARC-Target-URI", "warc_date": "WARC-Date",
    "payload_digest": "WARC-Payload-Digest", "refers_to": "WARC-Refers-To", "profile": "WARC-Profile", "payload_length": "X-Payload-Length",
}
COLUMNS = [*HEADERS, "content_length", "payload"]
_SCHEMA = ", ".join([*(f"{c} string" for c in HEADERS), "content_length long", "payload binary"])
_ARROW = pa.schema([*((c, pa.string()) for c in HEADERS), ("content_length", pa.int64()), ("payload", pa.binary())])
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
CHUNK = 64 << 10
BATCH_BYTES = 4 << 20


def _file_system(path: str):
    from pyarrow import fs

    if "://" not in path:
        return fs.LocalFileSystem(), path.removeprefix("file:")
    return fs.FileSystem.from_uri(path)


class _Plain:
    """A record stream of an uncompressed file."""

    def __init__(self, file):
        self.file, self.held = file, b""

    def more(self) -> bool:
        chunk = self.file.read(CHUNK)
        self.held += chunk
        return bool(chunk)

    def take(self, n: int) -> bytes:
        parts, have = [self.held[:n]], min(n, len(self.held))
        self.held = self.held[n:]
        if have < n:
            parts.append(self.file.read(n - have))
        return b"".join(parts)

    def skip(self, n: int) -> None:
        have = min(n, len(self.held))
        self.held = self.held[have:]
        if n > have:
            self.file.seek(n - have, 1)


class _Gzip(_Plain):
    """The same of a file of gzip members."""

    def __init__(self, file):
        super().__init__(file)
        self.zip, self.raw = zlib.decompressobj(31), b""

    def _inflate(self) -> bytes:
        """Some bytes more, none at the file's end."""
        while True:
            if self.zip.eof:
                self.raw = self.zip.unused_data
                self.zip = zlib.decompressobj(31)
            raw = self.raw or self.file.read(CHUNK)
            if not raw:
                return b""
            out = self.zip.decompress(raw, CHUNK)
            self.raw = self.zip.unconsumed_tail
            if out:
                return out

    def more(self) -> bool:
        out = self._inflate()
        self.held += out
        return bool(out)

    def take(self, n: int) -> bytes:
        parts, have = [self.held], len(self.held)
        while have < n and (out := self._inflate()):
            parts.append(out)
            have += len(out)
        whole = b"".join(parts)
        self.held = whole[n:]
        return whole[:n]

    def skip(self, n: int) -> None:
        while len(self.held) < n:
            n -= len(self.held)
            self.held = self._inflate()
            if not self.held:
                return
        self.held = self.held[n:]


def records(file, compressed: bool, wanted, payload_of) -> Iterator[tuple[dict[str, str], bytes | None]]:
    """(headers, block or None) of the records that ``wanted(headers)`` accepts."""
    stream = (_Gzip if compressed else _Plain)(file)
    while True:
        while (end := stream.held.find(b"\r\n\r\n")) < 0 or not stream.held.strip(b"\r\n"):
            if not stream.more():
                if stream.held.strip(b"\r\n"):
                    raise ValueError("the archive ends within a record's header")
                return
        if end == 0:
            stream.held = stream.held[4:]
            continue
        head = stream.take(end + 4).decode("utf-8", "replace").strip("\r\n").split("\r\n")
        if not head[0].startswith("WARC/"):
            raise ValueError(f"not a WARC record: {head[0][:40]!r}")
        headers: dict[str, str] = {}
        for line in head[1:]:
            name, _, value = line.partition(":")
            headers[name.strip().lower()] = value.strip()
        n = int(headers.get("content-length", 0))
        if not wanted(headers):
            stream.skip(n)
        elif not payload_of(headers):
            stream.skip(n)
            yield headers, None
        else:
            block = stream.take(n)
            if len(block) < n:
                raise ValueError("the archive ends within a record's block")
            yield headers, block


@dataclass
class _Files(InputPartition):
    paths: list


class WarcReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = options
        self.root = options["path"]
        self.tests: list[tuple[str, frozenset]] = []
        if options.get("types"):
            self.tests.append(("warc-type", frozenset(x.strip() for x in options["types"].split(","))))
        for name, value in options.items():
            if name.lower().startswith("header."):
                self.tests.append((name[7:].lower(), frozenset([value])))

    def partitions(self) -> list[_Files]:
        from pyarrow import fs

        system, root = _file_system(self.root)
        found = {i.base_name: i for i in system.get_file_info(fs.FileSelector(root, recursive=False)) if i.is_file}
        manifests = [i for n, i in found.items() if n.startswith("_committed-")]
        names = sorted(n for n in found if n.endswith((".warc", ".warc.gz")))
        if manifests:
            good = set()
            for i in manifests:
                with system.open_input_stream(i.path) as f:
                    good |= set(json.loads(f.read()))
            names = [n for n in names if n in good]
        most, out, held = int(self.options.get("split_bytes", 64 << 20)), [], 0
        for n in names:
            if not out or held + found[n].size > most:
                out.append(_Files([]))
                held = 0
            out[-1].paths.append(found[n].path)
            held += found[n].size
        return out or [_Files([])]

    def read(self, partition: _Files):
        system, _ = _file_system(self.root)
        kinds = self.options.get("payload", "all")
        chosen = frozenset(x.strip() for x in kinds.split(","))

        def wanted(h: dict) -> bool:
            return all(h.get(name) in values for name, values in self.tests)

        def payload_of(h: dict) -> bool:
            return kinds == "all" or h.get("warc-type") in chosen

        rows, held = [], 0
        for path in partition.paths:
            with system.open_input_file(path) as file:
                for h, block in records(file, path.endswith(".gz"), wanted, payload_of):
                    if block is not None and h.get("content-type", "").startswith("application/http"):
                        block = block.partition(b"\r\n\r\n")[2]
                    rows.append((*(h.get(x.lower()) for x in HEADERS.values()), int(h.get("content-length", 0)), block))
                    held += 256 + len(block or b"")
                    if held > BATCH_BYTES:
                        yield _batch(rows)
                        rows, held = [], 0
        if rows:
            yield _batch(rows)


class PushingReader(WarcReader):
    """Takes pushed filters. Spark 4.1 keeps what was pushed with the relation, also for other queries on it, so this reader is
    chosen by an option, and a relation read with it serves one query."""

    def pushFilters(self, filters):
        """Takes equality and IN on the header columns; Spark applies the others."""
        for f in filters:
            if isinstance(f, EqualTo | In) and len(f.attribute) == 1 and f.attribute[0] in HEADERS:
                values = [f.value] if isinstance(f, EqualTo) else f.value
                self.tests.append((HEADERS[f.attribute[0]].lower(), frozenset(values)))
            else:
                yield f


def _batch(rows: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), _ARROW, strict=True)], schema=_ARROW)


@dataclass
class _Written(WriterCommitMessage):
    names: list


class WarcWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.options = options
        self.root = options["path"]

    def write(self, batches: Iterator[pa.RecordBatch]) -> _Written:
        system, root = _file_system(self.root)
        system.create_dir(root, recursive=True)
        most, level = int(self.options.get("file_bytes", 64 << 20)), int(self.options.get("level", 1))
        names, out, size = [], None, 0
        try:
            for batch in batches:
                for row in batch.to_pylist():
                    if out is None:
                        names.append(f"part-{uuid.uuid4().hex}.warc.gz")
                        out, size = system.open_output_stream(f"{root}/{names[-1]}", compression=None), 0
                        if self.options.get("info") == "true":
                            size += out.write(member({"record_type": "warcinfo", "record_id": f"<urn:file:{names[-1]}>", "warc_date": row.get("warc_date"), "payload": b"format: WARC File Format 1.1\r\n"}, level))
                    size += out.write(member(row, level))
                    if size >= most:
                        out.close()
                        out = None
        finally:
            if out is not None:
                out.close()
        return _Written(names)

    def commit(self, messages: list) -> None:
        system, root = _file_system(self.root)
        system.create_dir(root, recursive=True)
        with system.open_output_stream(f"{root}/_committed-{uuid.uuid4().hex}.json", compression=None) as f:
            f.write(json.dumps([n for m in messages if m for n in m.names]).encode())

    def abort(self, messages: list) -> None:
        system, root = _file_system(self.root)
        for m in messages:
            for n in m.names if m else ():
                system.delete_file(f"{root}/{n}")


def member(row: dict, level: int = 1) -> bytes:
    """A record as a gzip member of its own."""
    zipped = zlib.compressobj(level, zlib.DEFLATED, 31)
    head, block = record_of(row)
    return zipped.compress(head) + zipped.compress(block) + zipped.compress(b"\r\n\r\n") + zipped.flush()


def record_of(row: dict) -> tuple[bytes, bytes]:
    """Header and block of a record; a response's or revisit's block is an HTTP message."""
    http = row["record_type"] in ("response", "revisit")
    block = (HTTP if http else b"") + (row.get("payload") or b"")
    lines = [f"{name}: {quote(row[c], safe=_SAFE)}" for c, name in HEADERS.items() if row.get(c) is not None]
    kind = "application/http;msgtype=response" if http else "application/octet-stream"
    return "\r\n".join(["WARC/1.1", *lines, f"Content-Type: {kind}", f"Content-Length: {len(block)}", "", ""]).encode(), block


_SAFE = "".join(chr(i) for i in range(33, 127))


class WarcDataSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "warc"

    def schema(self) -> str:
        return _SCHEMA

    def reader(self, schema) -> WarcReader:
        options = dict(self.options)
        return (PushingReader if options.get("pushdown") == "true" else WarcReader)(options)

    def writer(self, schema, overwrite: bool) -> WarcWriter:
        return WarcWriter(dict(self.options))


def with_revisits(pages: DataFrame, least_bytes: int = 0, salts: int = 16) -> DataFrame:
    """page_id, url, payload, sha1, refers_to: of equal payloads of ``least_bytes`` or more, all but the one with the largest
    id refer to that one.

    Which payload repeats is found on ids and digests alone, hot digests salted; the payloads are shuffled once, by id.
    A null id is the smallest, a null html empty; rows that repeat id and payload are all alike.
    """
    html = F.encode(F.coalesce(F.col("html").cast("string"), F.lit("")), "UTF-8")
    ident = F.col("page_id").cast("long")
    rows = pages.select(F.coalesce(ident, F.lit(-(2**63))).alias("pid"), F.sha1(html).alias("sha1"), ident.alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("payload"))
    thin = rows.filter(F.octet_length("payload") >= least_bytes).select("pid", "sha1")
    last = thin.groupBy("sha1").agg(F.max("pid").alias("last"), F.min("pid").alias("first")).filter("last > first").select("sha1", "last")
    last = last.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    thin = thin.withColumn("salt", F.pmod(F.xxhash64("pid"), F.lit(salts)).cast("int"))
    again = thin.join(last, ["sha1", "salt"]).filter("pid < last").select("pid", "sha1", F.col("last").alias("refers_to")).distinct()
    return rows.join(again, ["pid", "sha1"], "left")


def archive(rows: DataFrame, path: str, date: str = "2000-01-01T00:00:00Z", **options) -> None:
    """Writes the rows of ``with_revisits`` as response and revisit records."""
    register(rows.sparkSession)
    revisit = F.col("refers_to").isNotNull()

    def urn(ident):
        return F.concat(F.lit("<urn:page:"), F.coalesce(ident.cast("string"), F.lit("")), F.lit(":"), F.col("sha1"), F.lit(">"))

    rows.select(
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        urn(F.col("page_id")).alias("record_id"),
        F.coalesce("url", F.lit("about:blank")).alias("target_uri"),
        F.lit(date).alias("warc_date"),
        F.concat(F.lit("sha1:"), base32(F.col("sha1"))).alias("payload_digest"),
        F.when(revisit, urn(F.col("refers_to"))).alias("refers_to"),
        F.when(revisit, "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest").alias("profile"),
        F.octet_length("payload").cast("string").alias("payload_length"),
        F.lit(None).cast("long").alias("content_length"),
        F.when(~revisit, F.col("payload")).alias("payload"),
    ).write.format("warc").options(**options).mode("append").save(path)


def base32(hexadecimal):
    """Upper-case base32 of 40 hexadecimal digits: 5 digits are 4 letters."""
    five = [F.conv(F.substring(hexadecimal, 1 + 5 * i, 5), 16, 10).cast("int") for i in range(8)]
    letter = lambda x: F.substring(F.lit("ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"), x + 1, F.lit(1))
    return F.concat(*[letter(F.shiftright(x, 15 - 5 * j).bitwiseAND(31)) for x in five for j in range(4)])


def register(spark: SparkSession) -> None:
    """Makes the format known to a session; Spark asks Python sources for pushed filters only under this setting."""
    spark.dataSource.register(WarcDataSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")


def read_archive(spark: SparkSession, path: str, **options) -> DataFrame:
    register(spark)
    return spark.read.format("warc").options(**options).load(path)


def round_trip(spark: SparkSession, pages: DataFrame, path: str | None = None, least_bytes: int = 0) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to, from archives written and read back.

    A response's bytes and digest come from the payload read; a revisit's from its header, as it has none. The predicate on the
    record type is pushed into the reader, which passes over the files' own records by their headers.
    """
    path = path or fresh_path(spark, "warc")
    archive(with_revisits(pages, least_bytes), path, info="true")
    back = read_archive(spark, path, pushdown="true", payload="response").filter(F.col("record_type").isin("response", "revisit"))
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d*):", 1)
    here = F.col("payload").isNotNull()
    return back.select(
        F.nullif(page("record_id"), F.lit("")).cast("long").alias("page_id"),
        F.when(here, F.octet_length("payload")).otherwise(F.col("payload_length").cast("long")).cast("long").alias("payload_bytes"),
        F.when(here, base32(F.sha1("payload"))).otherwise(F.substring("payload_digest", 6, 32)).alias("payload_digest"),
        "record_type",
        F.when(F.col("refers_to").isNotNull(), page("refers_to").cast("long")).alias("refers_to"),
    )
