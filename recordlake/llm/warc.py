"""WARC archives: writing with revisit records, and reading that salvages damaged files."""

from __future__ import annotations

import base64
import gzip
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha1

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField

from recordlake.llm.batches import quoted, steps, stored

#: Fixed values of the format.
VERSION = re.compile(rb"WARC/1\.[01]\r\n")
MEMBER = b"\x1f\x8b\x08"
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
END = b"\r\n\r\n"

#: A record's id holds the page's key.
RECORD_ID = "<urn:page:{}>"
#: A line that no header holds begins so: before it a header that has no end is over.
VERSION_LINE, VERSION_MARK = b"\nWARC/1.", b"WARC/1."
#: Bytes of an archive that a writer aims at; a longer record has one of its own.
FILE_BYTES = 1 << 25
#: Stands between records in compressed archives: a member without content, which readers skip.
EMPTY_MEMBER = gzip.compress(b"", mtime=0)


def digest(data: bytes | memoryview) -> str:
    return base64.b32encode(sha1(data).digest()).decode()


def record_bytes(page, url, payload: bytes, revisits, is_revisit: bool, date: str) -> bytes:
    """One record without the line ends that close it."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if is_revisit else http + payload
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if is_revisit else 'response'}",
        f"WARC-Record-ID: {RECORD_ID.format('' if page is None else page)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        f"WARC-Block-Digest: sha1:{digest(block)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:  # control characters would end the line
        lines.append("WARC-Target-URI: " + re.sub(r"[\x00-\x1f\x7f]", lambda m: f"%{ord(m[0]):02X}", url))
    if is_revisit:
        lines += [f"WARC-Profile: {REVISIT}", f"WARC-Refers-To: {RECORD_ID.format(revisits)}"]
    return "\r\n".join(lines).encode() + END + block


def write_archives(
    df: DataFrame,
    path: str,
    key: str = "page_id",
    url: str = "url",
    payload: str = "html",
    compressed: bool = True,
    min_revisit_bytes: int = 0,
    file_bytes: int = FILE_BYTES,
    date: str = "2000-01-01T00:00:00Z",
) -> None:
    """Write a record per row into archives under ``path``, one or more per task.

    The payload is a text in UTF-8; null is empty. Of rows with equal payloads (SHA-1 and length)
    of at least ``min_revisit_bytes`` bytes, that with the largest key is a response and the
    others are revisits of it; rows with that same largest key, or with no key but null, are all
    responses. A null URL is left out; other columns are not read. An empty table gives archives
    without records.

    Payload groups are counted by digest, which combines before the shuffle; only groups of two
    or more come back to the pages. Spark's text sink writes the bytes, so ``path`` may lie in any
    store that Spark writes to: what a file holds is one line, and the line end is what closes its
    last record. A file has ``file_bytes`` bytes at most, or one record that is longer.
    """
    text = F.coalesce(F.col(quoted(payload)), F.lit(""))
    pages = df.select(F.col(quoted(key)).alias("page"), F.col(quoted(url)).alias("url"), text.alias("payload"))
    size = F.octet_length("payload")
    pages = pages.withColumns({"size": size, "sha": F.sha1(F.col("payload").cast("binary"))})
    groups = (
        pages.where(F.col("size") >= min_revisit_bytes)
        .groupBy("sha", "size")
        .agg(F.max("page").alias("largest"), F.count("*").alias("copies"))
        .where("copies > 1 and largest is not null")
    )
    groups = stored(groups.select("sha", "size", "largest"), "payload-groups")
    # Written first, so its true size decides whether the pages are shuffled at all.
    known = pages.join(groups, ["sha", "size"], "left").select("payload", "page", "url", "largest")

    end = EMPTY_MEMBER if compressed else END

    def run(batches):
        held, size = [], 0

        def file():
            return pa.RecordBatch.from_arrays([pa.array([end.join(held)], pa.binary())], names=["records"])

        for batch in batches:
            for step in steps(batch):
                for row in step.to_pylist():
                    revisit = row["largest"] is not None and row["page"] != row["largest"]
                    data = record_bytes(
                        row["page"], row["url"], row["payload"].encode(), row["largest"], revisit, date
                    )
                    data = gzip.compress(data + END, 6, mtime=0) if compressed else data
                    if held and size + len(data) > file_bytes:
                        yield file()
                        held, size = [], 0
                    held.append(data)
                    size += len(data) + len(end)
        if held:
            yield file()

    files = known.mapInArrow(run, "records binary").select(F.col("records").cast("string").alias("value"))
    writer = files.write.option("maxRecordsPerFile", 1).option("encoding", "ISO-8859-1")
    writer.option("lineSep", end.decode("latin-1")).text(path)


class Damaged(Exception):
    """What stands here is no whole record."""


@dataclass
class Record:
    headers: dict[str, str]
    block: memoryview

    @property
    def http(self) -> tuple[dict[str, str], memoryview]:
        looked = 1 << 12
        while True:
            some = bytes(self.block[:looked])
            head = some.find(END)
            if head >= 0:
                return named(some[:head]), self.block[head + len(END) :]
            if looked >= len(self.block):
                raise Damaged("no HTTP header")
            looked *= 8


def named(head: bytes) -> dict[str, str]:
    """Header lines by lower-case name; the first line is none."""
    pairs = (line.decode("utf-8", "replace").partition(":") for line in head.split(b"\r\n")[1:])
    return {name.strip().lower(): value.strip() for name, _, value in pairs}


class Stream:
    """Bytes that arrive in pieces, searched by their place in the whole.

    What lies before ``drop`` is forgotten. The next place of a mark is kept until it is passed, so
    that searches which follow one another take one pass over the bytes.
    """

    def __init__(self, pieces: Iterator[bytes]):
        self.pieces, self.data, self.base, self.done = pieces, b"", 0, False
        self.found: dict[bytes, int] = {}

    @classmethod
    def of(cls, data: bytes) -> Stream:
        made = cls(iter(()))
        made.data, made.done = data, True
        return made

    @property
    def end(self) -> int:
        return self.base + len(self.data)

    def reach(self, place: int) -> bool:
        """Whether there are bytes up to a place; reads on until it is known."""
        some = []
        size = self.end
        while size < place and not self.done:
            piece = next(self.pieces, None)
            if piece is None:
                self.done = True
            else:
                some.append(piece)
                size += len(piece)
        if some:
            self.data = b"".join([self.data, *some])
        return size >= place

    def drop(self, place: int) -> None:
        """Forget what lies before a place, once it is the larger part of what is held."""
        if not self.done and place - self.base > max(1 << 16, len(self.data) // 2):
            self.data, self.base = self.data[place - self.base :], place

    def between(self, start: int, stop: int) -> memoryview:
        return memoryview(self.data)[start - self.base : stop - self.base]

    def find(self, mark: bytes, start: int, stop: int | None = None) -> int:
        """The first place of a mark from ``start`` on, or -1; not beyond ``stop``, if given."""
        kept = self.found.get(mark)
        if kept is not None and kept >= start:
            return kept if stop is None or kept < stop else -1
        at = start
        while True:
            place = self.data.find(mark, max(0, at - self.base))
            if place >= 0:
                place += self.base
                break
            at = max(start, self.end - len(mark) + 1)
            if (stop is not None and at >= stop) or not self.reach(self.end + 1):
                place = self.end if self.done else -1
                break
        if place < 0:
            return -1
        self.found[mark] = place  # the end, if there is none
        missing = place >= self.end and self.done
        return -1 if missing or (stop is not None and place >= stop) else place


def record_at(stream: Stream, start: int) -> tuple[Record, int]:
    """The record that begins at a place, and its end; all its checks hold."""
    stream.reach(start + 16)
    if not VERSION.match(stream.between(start, start + 16)):
        raise Damaged("no version line")
    # A header is over before the next version line, so a missing end is not looked for beyond.
    following = stream.find(VERSION_LINE, start + 1)
    head = stream.find(END, start, None if following < 0 else following + 1)
    if head < 0:
        raise Damaged("no end of the header")
    headers = named(bytes(stream.between(start, head)))
    length = headers.get("content-length", "")
    if not length.isdecimal():
        raise Damaged("no length")
    first, end = head + len(END), head + len(END) + int(length)
    if not stream.reach(end + len(END)) or stream.between(end, end + len(END)) != END:
        raise Damaged("the block does not end where it should")
    record = Record(headers, memoryview(bytes(stream.between(first, end))))
    check(headers.get("warc-block-digest"), record.block)
    if headers.get("warc-type") == "response":
        http, body = record.http
        if http.get("content-length", str(len(body))) != str(len(body)):
            raise Damaged("the payload's length differs")
        check(headers.get("warc-payload-digest"), body)
    return record, end + len(END)


def check(wanted: str | None, data: memoryview) -> None:
    if wanted and wanted.lower().startswith("sha1:") and wanted[5:].upper() != digest(data):
        raise Damaged("a digest differs")


def records_of(stream: Stream) -> Iterator[tuple[int, int, Record | None, str]]:
    """All whole records of uncompressed bytes, and the gaps between them: start, end, record, reason."""
    at, gap, reason = 0, None, ""
    while stream.reach(at + 1):
        try:
            record, end = record_at(stream, at)
        except Damaged as error:
            if gap is None:
                gap, reason = at, str(error)
            at = stream.find(VERSION_MARK, at + 1)
            if at < 0:
                break
        else:
            if gap is not None:
                yield gap, at, None, reason
                gap = None
            yield at, end, record, ""
            at = end
        stream.drop(at)
    if gap is not None:
        yield gap, stream.end, None, reason


class Member:
    """A compressed member of an archive, unpacked piece by piece as far as it goes."""

    def __init__(self, data: bytes, start: int):
        self.data, self.at, self.error = data, start, ""

    def pieces(self) -> Iterator[bytes]:
        unpack, step = zlib.decompressobj(31), 1 << 16
        while not unpack.eof:
            if self.at >= len(self.data):
                if piece := unpack.decompress(b"", 1 << 22):  # held back by the limit
                    yield piece
                    continue
                if not unpack.eof:
                    self.error = "the member is cut off"
                    return
                break
            before = unpack.copy()
            try:
                # A little of the input may hold much: it is unpacked in pieces as well.
                piece = unpack.decompress(self.data[self.at : self.at + step], 1 << 22)
            except zlib.error:
                if step == 1:
                    self.error = "the member is broken"
                    return
                unpack, step = before, step // 16  # again, up to the byte that is wrong
                continue
            self.at += len(self.data[self.at : self.at + step]) - len(unpack.unconsumed_tail)
            yield piece
        self.at -= len(unpack.unused_data)


def salvage(data: bytes) -> Iterator[tuple[int, int, Record | None, str, tuple[int, int] | None]]:
    """All whole records of an archive, and the byte gaps between them, in one pass.

    Yields start, end, either a record or None with the reason of the gap, and the inner range.
    Where a check fails, the search goes on from the next byte for a compressed member or a
    version line that begins a whole record; what lies between is one gap. So a whole record
    inside the payload of a damaged one is recovered as a record.

    A member may hold any number of records, and is searched in the same way after unpacking, as
    far as it can be unpacked: its records and gaps have their range within the unpacked bytes, and
    the bytes of the archive that were read for them. A member that gives no record at all is
    part of a gap of the archive. All searches go forward, so damage does not make them slower.
    """
    archive, at, gap, reason = Stream.of(data), 0, None, ""
    while at < len(data):
        if not data.startswith(MEMBER, at):
            try:
                record, end = record_at(archive, at)
            except Damaged as error:
                if gap is None:
                    gap, reason = at, str(error)
                at = next_start(archive, at + 1)
                continue
            if gap is not None:
                yield gap, at, None, reason, None
                gap = None
            yield at, end, record, "", None
            at = end
            continue
        member = Member(data, at)
        unpacked, recovered, lost, told = Stream(member.pieces()), False, [], ""
        for a, b, record, why in records_of(unpacked):
            if record is None and not recovered:
                lost.append((a, b, why))
                continue
            if gap is not None:
                yield gap, at, None, reason, None
                gap = None
            for x, y, earlier in lost:
                yield at, member.at, None, earlier, (x, y)
            lost, recovered = [], True
            unpacked.reach(b + 1)  # so that the last record's range ends with the member
            yield at, member.at, record, why, (a, b)
            told = why
        if recovered:
            if member.error:
                if not told:
                    yield at, member.at, None, member.error, (unpacked.end, unpacked.end)
                if member.at < len(data):
                    gap, reason = member.at, member.error
                    following = next_start(archive, member.at)
                    at = following
                    if gap == at:
                        gap = None
                    continue
            at = member.at
        elif member.error or lost:
            if gap is None:
                gap, reason = at, member.error or lost[0][2]
            at = next_start(archive, at + 1) if member.error else member.at
        else:
            at = member.at  # an empty member
    if gap is not None:
        yield gap, len(data), None, reason, None


def next_start(archive: Stream, at: int) -> int:
    """Where the next member or version line may begin."""
    found = (archive.find(MEMBER, at), archive.find(VERSION_MARK, at))
    return min([x for x in found if x >= 0], default=archive.end)


ARCHIVE = (
    "file string, start bigint, end bigint, gap string, record_type string, page bigint, url string, "
    "payload_bytes bigint, payload_digest string, refers_to bigint, payload binary, "
    "inner_start bigint, inner_end bigint"
)


def read_archives(spark: SparkSession, path: str, with_payload: bool = False) -> DataFrame:
    """Every record and every gap of the archives under ``path``, compressed or not.

    A record has ``gap`` null; a gap has its reason there, its bytes in ``start`` and ``end``, and
    nulls elsewhere. What was found inside a compressed member has its range of the unpacked bytes
    in ``inner_start`` and ``inner_end``, and in ``start`` and ``end`` that of the member as far as
    it was read. ``payload_bytes`` and ``payload_digest`` are those of the full payload, for
    revisits too; ``page`` and ``refers_to`` are null if the record's ids are none of this
    module's. A file is read as a whole by one task, so archives must stay below 2 GB; files are
    independent. An empty file, or one of empty members, has no rows.
    """
    def run(batches):
        names = [f.split()[0] for f in ARCHIVE.split(", ")]
        schema = pa.schema(list(zip(names, [
            pa.string(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(),
            pa.int64(), pa.string(), pa.int64(), pa.binary(), pa.int64(), pa.int64(),
        ])))
        for batch in batches:
            for file, data in zip(batch.column(0).to_pylist(), batch.column(1)):
                rows, size = [], 0
                for start, end, record, reason, inner in salvage(data.as_buffer().to_pybytes()):
                    place = {"file": file, "start": start, "end": end}
                    place |= dict(zip(("inner_start", "inner_end"), inner or (None, None)))
                    rows.append(place | described(record, reason, with_payload))
                    size += len(rows[-1]["payload"] or b"")
                    if len(rows) >= 10_000 or size >= 1 << 24:
                        yield pa.RecordBatch.from_pylist(rows, schema)
                        rows, size = [], 0
                yield pa.RecordBatch.from_pylist(rows, schema)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    return files.mapInArrow(run, ARCHIVE)


def whole(records: DataFrame) -> DataFrame:
    """The records of archives that must have no gap: a gap fails the job that meets it."""
    place = F.concat_ws(" ", F.lit("gap in"), "file", F.lit("from byte"), "start", F.lit("to"), "end")
    failed = F.raise_error(F.concat_ws(": ", place, "gap")).cast("boolean")
    return records.where(F.when(F.col("gap").isNull(), F.lit(True)).otherwise(failed))


def described(record: Record | None, reason: str, with_payload: bool) -> dict:
    row = dict.fromkeys(
        ("record_type", "page", "url", "payload_bytes", "payload_digest", "refers_to", "payload")
    )
    if record is None:
        return row | {"gap": reason}
    headers = record.headers
    row |= {
        "gap": None,
        "record_type": headers.get("warc-type"),
        "page": page_of(headers.get("warc-record-id")),
        "url": headers.get("warc-target-uri"),
        "payload_digest": (headers.get("warc-payload-digest") or "").removeprefix("sha1:") or None,
        "refers_to": page_of(headers.get("warc-refers-to")),
    }
    if row["record_type"] in ("response", "revisit"):
        http, body = record.http
        length = http.get("content-length", "")
        row["payload_bytes"] = int(length) if length.isdecimal() else None
        row["payload"] = bytes(body) if with_payload and row["record_type"] == "response" else None
    return row


def page_of(record_id: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", record_id or "")
    return int(found[1]) if found else None
