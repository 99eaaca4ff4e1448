"""Conversion of legacy ARC archives to WARC.

An ARC file starts with a version block whose first line names the version and whose second line names the fields of
every header line; a record is such a line and then as many bytes as the line declares. The
converter reads the fields by the file's own version and writes a WARC record for each: identifier from the
record's place, date, type and digests from its content. Records whose payloads are equal and long enough become
revisits of one of them.

Files are read and written through Spark, so they can lie in any store. Compressed archives stream line by line;
archives are split over tasks by file. Payloads are not shuffled while the list of revisits is small.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Callable, Iterator
from urllib.parse import quote

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brindle.llm.tables import measured
from brindle.scratch import materialize

LEAST_PAYLOAD = 1000
# Archives are large and compressing them is most of the work; the fastest level saves more time than it costs space.
GZIP = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
ID_HEADER = "X-Page-Id"

# Names of the header fields in both versions of the ARC format, and the profile of a revisit.
ARC_FIELDS = {
    1: "URL IP-address Archive-date Content-type Archive-length",
    2: "URL IP-address Archive-date Content-type Result-code Checksum Location Offset Filename Archive-length",
}
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
WARC_BREAK = "\r\n\r\n"


def _version_block(version: int, name: str) -> bytes:
    body = f"{version} 0 brindle\n{ARC_FIELDS[version]}\n"
    return f"filedesc://{name} 0.0.0.0 20240101000000 text/plain {_middle(version, name)}{len(body)}\n{body}".encode()


def _middle(version: int, name: str, status: str = "200", checksum: str = "-") -> str:
    return "" if version == 1 else f"{status} {checksum} - 0 {name} "


def write_arc(pages: DataFrame, path: str, version: int = 1) -> None:
    """Write page_id, url and html as gzipped ARC files of ``version`` 1 or 2, an HTTP response per row.

    The payload is the html in UTF-8, empty for NULL. The id travels in an HTTP header; a NULL id or url is left empty.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = False
        for batch in batches:
            rows = []
            if not opened:
                rows.append(_version_block(version, "pages.arc"))
                opened = True
            for page, url, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                payload = html or b""
                head = f"HTTP/1.0 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n{ID_HEADER}: {'' if page is None else page}\r\nContent-Length: {len(payload)}\r\n\r\n"
                block = head.encode() + payload
                target = quote(url or "", safe="!#$%&'()*+,/:;=?@[]~")
                checksum = hashlib.md5(payload).hexdigest()
                line = f"{target} 0.0.0.0 20240101000000 text/html {_middle(version, 'pages.arc', '200', checksum)}{len(block)}\n"
                rows.append(line.encode() + block)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.binary())], names=["value"])

    rows = pages.select("page_id", "url", F.col("html").cast("binary").alias("html"))
    rows.mapInArrow(run, "value binary").select(F.col("value").cast("string")).write.options(lineSep="\n", **GZIP).text(path)


class ArcParser:
    """Records of one ARC file from its bytes, fed in pieces."""

    def __init__(self, name: str):
        self.name, self.buffer, self.read = name, bytearray(), 0
        self.fields: list[str] | None = None
        self.header: dict[str, str] | None = None

    def feed(self, data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
        """Offset, header fields and content of each record that ``data`` completes; the version block is not one."""
        self.buffer += data
        start = 0
        while True:
            if self.header is None:
                end = self.buffer.find(b"\n", start)
                if end < 0:
                    break
                line = self.buffer[start:end].decode("utf-8", "replace").rstrip("\r")
                self.at = self.read + start
                start = end + 1
                if line.strip():
                    self.header = self._header(line)
                continue
            length = int(self.header["Archive-length"])
            if len(self.buffer) - start < length:
                break
            content = bytes(self.buffer[start : start + length])
            start += length
            header, self.header = self.header, None
            if self.fields is None:
                self._version(content)
            else:
                yield self.at, header, content
        del self.buffer[:start]
        self.read += start

    def _header(self, line: str) -> dict[str, str]:
        if self.fields is None:
            if not line.startswith("filedesc://"):
                raise ValueError(f"{self.name} does not start with a version block")
            return {"Archive-length": line.rsplit(" ", 1)[-1]}
        # An unescaped blank can only be part of the first field, the URL.
        values = line.rsplit(" ", len(self.fields) - 1)
        if len(values) != len(self.fields) or not values[-1].isdigit():
            raise ValueError(f"{self.name}, offset {self.at}: not a header line: {line[:200]}")
        return dict(zip(self.fields, values))

    def _version(self, content: bytes) -> None:
        lines = content.decode("utf-8", "replace").split("\n")
        version = lines[0].split(" ")[0]
        if version not in ("1", "2") or len(lines) < 2:
            raise ValueError(f"{self.name}: unknown ARC version {lines[0][:100]}")
        self.fields = lines[1].strip().split(" ")
        if self.fields[-1] != "Archive-length":
            raise ValueError(f"{self.name}: unknown ARC fields {lines[1][:200]}")

    def close(self) -> None:
        if self.header is not None or self.buffer.strip():
            raise ValueError(f"{self.name} ends inside a record")


class WarcParser:
    """Records of one WARC file from its bytes, fed in pieces."""

    def __init__(self, name: str):
        self.name, self.buffer, self.header = name, bytearray(), None

    def feed(self, data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
        self.buffer += data
        start = 0
        while True:
            if self.header is None:
                while self.buffer[start : start + 2] == b"\r\n":
                    start += 2
                end = self.buffer.find(b"\r\n\r\n", start)
                if end < 0:
                    break
                first, *lines = self.buffer[start:end].decode("utf-8", "replace").split("\r\n")
                if not first.startswith("WARC/1."):
                    raise ValueError(f"{self.name}: not a record header: {first[:100]}")
                self.header = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
                start = end + 4
            length = int(self.header["Content-Length"])
            if len(self.buffer) - start < length:
                break
            content = bytes(self.buffer[start : start + length])
            start += length
            header, self.header = self.header, None
            yield 0, header, content
        del self.buffer[:start]

    def close(self) -> None:
        if self.header is not None or self.buffer.strip():
            raise ValueError(f"{self.name} ends inside a record")


def _records(spark: SparkSession, path: str | list[str], parser: type, row: Callable, schema: pa.Schema, ddl: str) -> DataFrame:
    """Rows that ``row`` makes of each record of the gzipped archives under ``path``, in file order.

    A gzipped file is not split, so a task sees whole files, line by line.
    """
    lines = spark.read.text(path, lineSep="\n").select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = None
        for batch in batches:
            if batch.num_rows == 0:
                continue
            files = batch.column("file").to_pylist()
            changes = [0, *(i for i in range(1, len(files)) if files[i] != files[i - 1]), len(files)]
            found = []
            for a, b in zip(changes, changes[1:]):
                if state is None or state.name != files[a]:
                    if state is not None:
                        state.close()
                    state = parser(files[a])
                data = b"\n".join(batch.column("value").slice(a, b - a).to_pylist()) + b"\n"
                found += [row(state.name, *record) for record in state.feed(data)]
            yield pa.RecordBatch.from_pylist([f for f in found if f is not None], schema=schema)
        if state is not None:
            state.close()

    return lines.mapInArrow(run, ddl)


def _http(content: bytes) -> tuple[bytes, bytes, dict[str, str]]:
    """HTTP head with its final blank line, payload, and header fields in lower case."""
    end = content.find(b"\r\n\r\n")
    if not content.startswith(b"HTTP/") or end < 0:
        return b"", content, {}
    lines = content[:end].decode("utf-8", "replace").split("\r\n")[1:]
    fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
    return content[: end + 4], content[end + 4 :], fields


def _id(fields: dict[str, str]) -> int | None:
    value = fields.get(ID_HEADER.lower(), "")
    return int(value) if value.lstrip("-").isdigit() else None


def _record_id(name: str, offset: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{name}#{offset}')}>"


_SEEN = pa.schema([("record_id", pa.string()), ("page_id", pa.int64()), ("sha1", pa.binary()), ("payload_bytes", pa.int64())])
_WHOLE = pa.schema([("record_id", pa.string()), ("url", pa.string()), ("ip", pa.string()), ("date", pa.string()), ("content", pa.binary())])


def _seen(name: str, offset: int, header: dict[str, str], content: bytes) -> dict:
    _, payload, fields = _http(content)
    return {"record_id": _record_id(name, offset), "page_id": _id(fields), "sha1": hashlib.sha1(payload).digest(), "payload_bytes": len(payload)}


def _whole(name: str, offset: int, header: dict[str, str], content: bytes) -> dict:
    return {
        "record_id": _record_id(name, offset), "url": header["URL"], "ip": header.get("IP-address", ""), "date": header.get("Archive-date", ""), "content": content,
    }


def warc_record(record_id: str, url: str, ip: str, date: str, content: bytes, refers_to: str | None) -> bytes:
    """A WARC record without the blank lines that end it; a revisit keeps the HTTP head as its block."""
    head, payload, _ = _http(content)
    kind = "revisit" if refers_to else "response" if head else "resource"
    date = date.ljust(14, "0")
    stamp = f"{date[:4]}-{date[4:6]}-{date[6:8]}T{date[8:10]}:{date[10:12]}:{date[12:14]}Z"
    block = head if refers_to else content
    digest = lambda data: "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()
    fields = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: {record_id}", f"WARC-Date: {stamp}", f"WARC-Target-URI: {url}", f"WARC-IP-Address: {ip}",
        f"WARC-Payload-Digest: {digest(payload)}", f"WARC-Block-Digest: {digest(block)}", f"WARC-Payload-Length: {len(payload)}",
        *([f"WARC-Refers-To: {refers_to}", f"WARC-Profile: {PROFILE}"] if refers_to else []),
        f"Content-Type: {'application/http;msgtype=response' if head else 'application/octet-stream'}", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + block


def _info(name: str) -> bytes:
    body = b"software: brindle\r\nformat: WARC File Format 1.1\r\n"
    stamp = "2024-01-01T00:00:00Z"
    fields = ["WARC/1.1", "WARC-Type: warcinfo", f"WARC-Record-ID: {_record_id(name, -1)}", f"WARC-Date: {stamp}", "Content-Type: application/warc-fields", f"Content-Length: {len(body)}"]
    return "\r\n".join(fields).encode() + b"\r\n\r\n" + body


def convert(spark: SparkSession, arc_path: str | list[str], warc_path: str, least_payload: int = LEAST_PAYLOAD) -> None:
    """Write the records of the gzipped ARC files under ``arc_path`` as gzipped WARC files.

    Of records whose payloads of at least ``least_payload`` bytes are equal, the one with the largest id (then record identifier) is the
    response and the others become revisits of it. A record without an id counts as smaller than all others.
    A block that is no HTTP response becomes a resource. Archives without records give files without responses. A header line
    that its version does not allow, or a file that ends inside a record, is an error.
    """
    seen = materialize(
        _records(spark, arc_path, ArcParser, _seen, _SEEN, "record_id string, page_id long, sha1 binary, payload_bytes long"), "arc-records"
    )
    large = seen.where(F.col("payload_bytes") >= least_payload)
    order = F.struct(F.coalesce("page_id", F.lit(-(1 << 63))).alias("p"), F.col("record_id").alias("r"))
    groups = large.groupBy("sha1", "payload_bytes").agg(F.max(order).alias("top"), F.count(F.lit(1)).alias("n")).where("n > 1")
    revisits = large.join(groups, ["sha1", "payload_bytes"]).where("record_id <> top.r")
    revisits = materialize(revisits.select("record_id", F.col("top.r").alias("refers_to")), "revisits")

    whole = _records(spark, arc_path, ArcParser, _whole, _WHOLE, "record_id string, url string, ip string, date string, content binary")
    rows = whole.join(measured(revisits), "record_id", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = False
        for batch in batches:
            names = ("record_id", "url", "ip", "date", "content", "refers_to")
            values = [warc_record(*r) for r in zip(*(batch.column(c).to_pylist() for c in names))]
            if values and not opened:
                values.insert(0, _info(batch.column("record_id")[0].as_py()))
                opened = True
            yield pa.RecordBatch.from_arrays([pa.array(values, pa.binary())], names=["value"])

    rows.mapInArrow(run, "value binary").select(F.col("value").cast("string")).write.options(lineSep=WARC_BREAK, **GZIP).text(warc_path)


_READ = pa.schema(
    [("record_id", pa.string()), ("record_type", pa.string()), ("url", pa.string()), ("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("refers_to_record", pa.string())]
)


def _read(name: str, offset: int, header: dict[str, str], content: bytes) -> dict | None:
    if header["WARC-Type"] == "warcinfo":
        return None
    head, payload, fields = _http(content)
    digest = base64.b32decode(header["WARC-Payload-Digest"].removeprefix("sha1:"))
    if header["WARC-Type"] != "revisit" and hashlib.sha1(payload).digest() != digest:
        raise ValueError(f"{name}: wrong payload digest in {header['WARC-Record-ID']}")
    return {
        "record_id": header["WARC-Record-ID"], "record_type": header["WARC-Type"], "url": header["WARC-Target-URI"], "page_id": _id(fields),
        "payload_bytes": int(header["WARC-Payload-Length"]), "payload_digest": digest.hex(), "refers_to_record": header.get("WARC-Refers-To"),
    }


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """Records of gzipped WARC files: record_id, record_type, url, page_id, payload_bytes, payload_digest, refers_to_record.

    Payload digests are checked against the payloads, except for revisits, which have none.
    """
    ddl = "record_id string, record_type string, url string, page_id long, payload_bytes long, payload_digest string, refers_to_record string"
    return _records(spark, path, WarcParser, _read, _READ, ddl)
