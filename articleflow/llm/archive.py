"""Legacy ARC archives, their conversion to WARC, and reading WARC back.

An archive file is written and converted by one task each: gzip members, one for each record, so
a reader needs one record at a time. A file's name is fixed by its number and appears only when
it is complete, so a repeated or concurrent attempt does no harm.
"""

from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from datetime import UTC, datetime
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from articleflow.llm.files import Output
from articleflow.session import settle, work_dir

# Bytes read and unpacked at a time.
CHUNK = 1 << 20
# Records in one archive file.
FILE_RECORDS = 5000
# Fixed: the fields of the record lines of both ARC versions, and lines that name them.
V1_FIELDS = ("URL", "IP-address", "Archive-date", "Content-type", "Archive-length")
V2_FIELDS = ("URL", "IP-address", "Archive-date", "Content-type", "Result-code", "Checksum", "Location", "Offset", "Filename", "Archive-length")
FIELDS = {1: V1_FIELDS, 2: V2_FIELDS}
NO_IP = "0.0.0.0"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
ID_HEADER = "X-Page-Id"


class ArchiveError(ValueError):
    """A file that doesn't follow its format."""


# ---- files -----------------------------------------------------------------------------


def member(content: bytes) -> bytes:
    pack = zlib.compressobj(1, zlib.DEFLATED, 31)
    return pack.compress(content) + pack.flush()


class Input:
    """Unpacked bytes of a file of gzip members (or a plain file), read as needed."""

    def __init__(self, path: str):
        system, place = fs.FileSystem.from_uri(path)
        self.source = system.open_input_stream(place, compression=None)
        self.buffer, self.start, self.raw = bytearray(), 0, b""
        self.unpack = None
        self.plain: bool | None = None

    def _more(self) -> bool:
        if not self.raw:
            self.raw = self.source.read(CHUNK)
            if not self.raw:
                if self.unpack is not None and not self.unpack.eof:
                    raise ArchiveError("the last gzip member is cut off")
                return False
        if self.plain is None:
            self.plain = self.raw[:2] != b"\x1f\x8b"
        if self.plain:
            self.buffer += self.raw
            self.raw = b""
            return True
        if self.unpack is None or self.unpack.eof:
            self.unpack = zlib.decompressobj(31)
        self.buffer += self.unpack.decompress(self.raw, CHUNK)
        self.raw = self.unpack.unused_data if self.unpack.eof else self.unpack.unconsumed_tail
        return True

    def _trim(self) -> None:
        if self.start >= CHUNK:
            del self.buffer[: self.start]
            self.start = 0

    def line(self) -> bytes | None:
        """The next line without its end, or None at the end of the file."""
        self._trim()
        while (at := self.buffer.find(b"\n", self.start)) < 0:
            if not self._more():
                if self.start == len(self.buffer):
                    return None
                at = len(self.buffer)
                break
        got = bytes(self.buffer[self.start : at])
        self.start = min(at + 1, len(self.buffer))
        return got.removesuffix(b"\r")

    def take(self, n: int) -> bytes:
        self._trim()
        while len(self.buffer) - self.start < n:
            if not self._more():
                raise ArchiveError(f"{n} bytes declared, {len(self.buffer) - self.start} left")
        got = bytes(self.buffer[self.start : self.start + n])
        self.start += n
        return got


# ---- ARC -------------------------------------------------------------------------------


def arc_head(version: int, name: str, date: str) -> bytes:
    """The record that opens a file and names the fields of the others."""
    body = f"{version} 0 articleflow\n{' '.join(FIELDS[version])}\n\n".encode()
    values = {"URL": f"filedesc://{name}", "IP-address": NO_IP, "Archive-date": date, "Content-type": "text/plain", "Archive-length": str(len(body))}
    return " ".join(values.get(f, "-") for f in FIELDS[version]).encode() + b"\n" + body


def arc_record(version: int, url: str, date: str, kind: str, content: bytes, name: str = "-", offset: int = 0, status: int = 200) -> bytes:
    values = {
        "URL": url, "IP-address": NO_IP, "Archive-date": date, "Content-type": kind, "Result-code": str(status),
        "Checksum": hashlib.md5(content).hexdigest(), "Location": "-", "Offset": str(offset), "Filename": name, "Archive-length": str(len(content)),
    }
    return " ".join(values[f] for f in FIELDS[version]).encode() + b"\n" + content + b"\n"


@dataclass
class ArcRecord:
    url: str
    date: str
    kind: str
    content: bytes
    number: int

    def payload_at(self) -> int:
        """Where the payload begins: after the response's head, else at once."""
        if self.content.startswith(b"HTTP/"):
            for mark in (b"\r\n\r\n", b"\n\n"):
                if (at := self.content.find(mark)) >= 0:
                    return at + len(mark)
        return 0

    def header(self, name: str) -> str | None:
        head = self.content[: self.payload_at()]
        found = re.search(rb"(?im)^" + name.encode() + rb":[ \t]*(.*?)\r?$", head)
        return found[1].decode("utf-8", "replace") if found else None


def read_arc(path: str) -> Iterator[ArcRecord]:
    """Records of one ARC file, without the one that opens it; the version line decides which
    fields a record line has, and the declared length where the record ends."""
    source = Input(path)
    fields: tuple[str, ...] | None = None
    number = 0
    while (line := source.line()) is not None:
        if not line:
            continue
        parts = line.decode("utf-8", "surrogateescape").split(" ")
        try:
            length = int(parts[-1])
        except ValueError:
            raise ArchiveError(f"no length in record line {line[:200]!r}") from None
        content = source.take(length)
        if fields is None:
            if not parts[0].startswith("filedesc://"):
                raise ArchiveError("the file doesn't begin with a file description")
            version, names = content.split(b"\n")[:2]
            fields = FIELDS.get(int(version.split()[0]))
            if fields is None or tuple(names.decode().split()) != fields:
                raise ArchiveError(f"unknown version or fields {content[:200]!r}")
            continue
        if len(parts) < len(fields):
            raise ArchiveError(f"{len(parts)} fields instead of {len(fields)} in {line[:200]!r}")
        extra = len(parts) - len(fields)  # an address with blanks
        values = dict(zip(fields, [" ".join(parts[: extra + 1]), *parts[extra + 1 :]], strict=True))
        yield ArcRecord(values["URL"], values["Archive-date"], values["Content-type"], content, number)
        number += 1


# ---- WARC ------------------------------------------------------------------------------


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def warc_date(date: str) -> str:
    """Fourteen digits, or fewer with the rest at its start, as an ISO time."""
    digits = re.sub(r"\D", "", date)[:14]
    full = digits + "00000101000000"[len(digits) :]
    return datetime.strptime(full, "%Y%m%d%H%M%S").replace(tzinfo=UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def record_id(file: str, number: int) -> str:
    """The same for the same record at every attempt."""
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{file}#{number}')}>"


def warc_record(headers: dict[str, str], block: bytes) -> bytes:
    lines = [f"{k}: {v}\r\n" for k, v in {**headers, "Content-Length": str(len(block))}.items()]
    return f"WARC/1.1\r\n{''.join(lines)}\r\n".encode("utf-8", "surrogateescape") + block + b"\r\n\r\n"


def convert(record: ArcRecord, file: str, refers: tuple[str, str] | None) -> bytes:
    """One WARC record; ``refers`` is the id and page id of the response this one repeats.

    A revisit keeps the response's head, which has the payload's length, and leaves out the
    payload. A record without such a head becomes a resource.
    """
    at = record.payload_at()
    payload = record.content[at:]
    headers = {
        "WARC-Type": "response" if at else "resource",
        "WARC-Record-ID": record_id(file, record.number),
        "WARC-Date": warc_date(record.date),
        "WARC-Target-URI": record.url,
        "WARC-Payload-Digest": f"sha1:{digest(payload)}",
    }
    block = record.content
    if refers is not None:
        block = record.content[:at]
        headers |= {"WARC-Type": "revisit", "WARC-Profile": REVISIT, "WARC-Refers-To": refers[0], "WARC-Refers-To-Page": refers[1]}
    headers |= {"WARC-Block-Digest": f"sha1:{digest(block)}", "Content-Type": "application/http;msgtype=response" if at else record.kind}
    return warc_record(headers, block)


def read_warc(path: str) -> Iterator[tuple[dict[str, str], bytes]]:
    source = Input(path)
    while (line := source.line()) is not None:
        if not line:
            continue
        if not line.startswith(b"WARC/"):
            raise ArchiveError(f"no record begins with {line[:80]!r}")
        headers: dict[str, str] = {}
        while line := source.line():
            name, _, value = line.decode("utf-8", "surrogateescape").partition(":")
            headers[name] = value.strip()
        block = source.take(int(headers["Content-Length"]))
        if headers.get("WARC-Block-Digest", "").removeprefix("sha1:") not in ("", digest(block)):
            raise ArchiveError(f"{headers.get('WARC-Record-ID')}: the block doesn't have its digest")
        yield headers, block


# ---- Spark -----------------------------------------------------------------------------


def _batch(rows: list[tuple], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[] for _ in types]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[str(i) for i in range(len(types))])


def write_arc(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", date: str = "20240101000000", records: int = FILE_RECORDS) -> DataFrame:
    """Write ``pages`` as ARC files, versions 1 and 2 in turn; rows (file), one for each file.

    The payload is the page in UTF-8 behind a response head with its length and page id; a null
    page is empty. A missing id or address gives an empty id and ``about:blank``.
    """
    rows = pages.select(F.col(page_id).cast("long"), F.col(url).cast("string"), F.col(html).cast("binary"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, files = TaskContext.get().partitionId(), []
        todo = (r for b in batches for r in zip(*(c.to_pylist() for c in b.columns), strict=True))
        row = next(todo, None)
        while row is not None:
            version = len(files) % 2 + 1
            name = f"pages-{task:06d}-{len(files):06d}.arc.gz"
            with Output(f"{folder}/{name}") as out:
                out.write(member(arc_head(version, name, date)))
                for _ in range(records):
                    key, address, page = row
                    page = page or b""
                    head = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
                    head += f"{ID_HEADER}: {'' if key is None else key}\r\nContent-Length: {len(page)}\r\n\r\n"
                    address = quote(address or "about:blank", safe="/:?#[]@!$&'()*+,;=%-._~")
                    out.write(member(arc_record(version, address, date, "text/html", head.encode() + page, name)))
                    if (row := next(todo, None)) is None:
                        break
            files.append((f"{folder}/{name}",))
        yield _batch(files, [pa.string()])

    return settle(rows.mapInArrow(run, "file string"), "arc-files")


def _page_id(record: ArcRecord) -> int | None:
    found = record.header(ID_HEADER)
    return int(found) if found else None


def to_warc(files: DataFrame, folder: str) -> DataFrame:
    """Convert the ARC files named in ``files`` (file) to WARC files; rows (file).

    Records with equal payloads (SHA-1 and length) become one response, the one with the smallest
    page id (then file and place; no id comes last), and revisits that refer to it. Only keys are
    shuffled: the first record of each payload is found by a partial aggregation, so a payload
    that a third of all records share is no load, and each file's decisions go to the task that
    converts it.
    """
    spark = files.sparkSession
    tasks = max(1, files.count())
    each = files.repartition(tasks, "file")

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows = []
                for r in read_arc(file):
                    payload = r.content[r.payload_at() :]
                    rows.append((file, r.number, _page_id(r), hashlib.sha1(payload).digest(), len(payload)))
                yield _batch(rows, [pa.string(), pa.int64(), pa.int64(), pa.binary(), pa.int64()])

    found = settle(each.mapInArrow(keys, "file string, number long, page long, sha binary, size long"), "payloads")
    order = F.struct(F.col("page").isNull().alias("none"), "page", "file", "number")
    shared = found.groupBy("sha", "size").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    place = F.struct("file", "number")
    repeats = found.join(shared, ["sha", "size"]).where(place != F.struct("first.file", "first.number"))
    decisions = repeats.select("file", "number", F.col("first.file").alias("to_file"), F.col("first.number").alias("to_number"), F.col("first.page").alias("to_page"))
    # A file without revisits still has to be converted: every file gives a row of its own.
    jobs = decisions.unionByName(files.select("file", F.lit(-1).cast("long").alias("number")), allowMissingColumns=True)

    def work(pdf: pd.DataFrame) -> pd.DataFrame:
        file = pdf["file"].iloc[0]
        to_page = pdf["to_page"].astype("Int64")
        refers = {
            int(n): (record_id(f, int(k)), "" if p is pd.NA else str(int(p)))
            for n, f, k, p in zip(pdf["number"], pdf["to_file"], pdf["to_number"], to_page, strict=True)
            if n >= 0
        }
        target = f"{folder}/{file.rsplit('/', 1)[1].replace('.arc', '.warc')}"
        with Output(target) as out:
            for r in read_arc(file):
                out.write(member(convert(r, file, refers.get(r.number))))
        return pd.DataFrame({"file": [target]})

    # The decisions are small beside the files they open: their size must not set the number of tasks.
    return settle(jobs.repartition(tasks, "file").groupBy("file").applyInPandas(work, "file string"), "warc-files")


def read_pages(files: DataFrame) -> DataFrame:
    """Rows of the WARC files named in ``files``: page_id, payload_bytes, payload_digest,
    record_type, refers_to, url, record_id, date. A response's payload is measured again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file in batch.column(0).to_pylist():
                rows = []
                for h, block in read_warc(file):
                    inner = ArcRecord("", "", "", block, 0)
                    sha = h["WARC-Payload-Digest"].removeprefix("sha1:")
                    size = int(inner.header("Content-Length") or 0)
                    if h["WARC-Type"] != "revisit":
                        payload = block[inner.payload_at() :]
                        if (len(payload), digest(payload)) != (size, sha):
                            raise ArchiveError(f"{h['WARC-Record-ID']}: the payload doesn't have its length and digest")
                    to = h.get("WARC-Refers-To-Page") or None
                    rows.append((_page_id(inner), size, sha, h["WARC-Type"], None if to is None else int(to), h["WARC-Target-URI"], h["WARC-Record-ID"], h["WARC-Date"]))
                text, long = pa.string(), pa.int64()
                yield _batch(rows, [long, long, text, text, long, text, text, text])

    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, url string, record_id string, date string"
    return files.repartition(max(1, files.count()), "file").mapInArrow(run, schema)


def archive(spark: SparkSession, pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Pages through ARC files and WARC files and back: one row for each row of ``pages``.

    An empty table gives none. Repeated rows are records of their own, of which one is the
    response. Further columns are ignored.
    """
    arc = write_arc(pages, work_dir(spark, "arc"), page_id, url, html)
    return read_pages(to_warc(arc, work_dir(spark, "warc")))
