"""WARC archives: written through Spark's text sink, read by splittable byte ranges.

Every record is a gzip member of its own. The text sink writes one member per row; as a row ends with
a separator byte, a row holds the member without its last byte, which is the highest byte of the
content's size and zero below 16 MiB (a larger record is followed by an empty member). So the files
are plain concatenations of members that other tools read too. Names must not end in ``.gz``, or
Spark's readers would unpack whole files.

The reader lets Spark scan byte ranges for the three bytes that start a gzip member: each range gives
the pieces that begin inside it, the last one up to the next such bytes even beyond its end. A piece
starts a record if its header decodes to a WARC version line; pieces that start nothing belong to the
record before, as the three bytes may stand inside packed data. Records cut by a range's end at such
a place are put together in a second step over the rest pieces alone.

Records with equal payloads of at least ``min_bytes`` bytes are stored once: the smallest page id's
record is the response, the others are revisits that name it.

Defined results: a null payload is empty; pages without an id are never a response that others
revisit; they revisit one with an id if there is one, else they are responses; repeated rows are
records each, and rows that repeat the smallest id are all responses; an empty table gives no
records. A record whose packed data or payload digest are broken is an error.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from portloom.llm.frames import small_batches
from portloom.llm.staging import staged

#: Start of a gzip member with deflate, WARC version, date of records without one.
MAGIC = b"\x1f\x8b\x08"
VERSION = "WARC/1.1"
DATE = "1970-01-01T00:00:00Z"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
LEVEL = 4

RECORD = "page_id long, url string, record_type string, refers_to long, payload_digest string, payload_bytes long, payload binary"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _one_line(text: str) -> str:
    return "".join(c if c.isprintable() else f"%{ord(c):02X}" for c in text)


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One record; ``page_id`` and the payload's full size stand in headers of their own."""
    block = b"" if revisit else payload
    headers = [
        ("WARC-Type", "revisit" if revisit else "response"),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
        ("X-Payload-Length", str(len(payload))),
        ("Content-Type", "text/html"),
        ("Content-Length", str(len(block))),
    ]
    if url is not None:
        headers.append(("WARC-Target-URI", _one_line(url)))
    if revisit:
        headers += [("WARC-Profile", REVISIT_PROFILE), ("WARC-Refers-To", f"<urn:page:{refers_to}>")]
    head = "".join(f"{k}: {v}\r\n" for k, v in headers)
    return f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def _member(content: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(content) + packer.flush()


_EMPTY_MEMBER = _member(b"")


def row_of(content: bytes) -> bytes:
    """A member, or two, without the last byte, which is zero."""
    member = _member(content)
    return (member if member[-1] == 0 else member + _EMPTY_MEMBER)[:-1]


def with_references(pages: DataFrame, min_bytes: int, page_id: str, html: str) -> DataFrame:
    """(page_id, url, payload, refers_to, revisit) of every page."""
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(page_id).alias("page_id"), "url", payload.alias("payload")).withColumn(
        "digest", F.when(F.length("payload") >= min_bytes, F.sha1("payload"))
    )
    firsts = (
        rows.where("digest is not null")
        .groupBy("digest")
        .agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
        .where("n > 1 and first is not null")
        .select("digest", "first")
    )
    found = rows.join(staged(firsts, "repeated-payloads"), "digest", "left")
    return found.select(
        "page_id",
        "url",
        "payload",
        F.col("first").alias("refers_to"),
        (F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))).alias("revisit"),
    )


def write_archives(
    pages: DataFrame, folder: str, min_bytes: int = 0, page_id: str = "page_id", html: str = "html"
) -> None:
    """Writes one record per page."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in small_batches(whole, "payload"):
                columns = (batch.column(c).to_pylist() for c in batch.schema.names)
                out = [row_of(record(i, u, p, r if v else None, v)) for i, u, p, r, v in zip(*columns, strict=True)]
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], names=["member"])

    rows = with_references(pages, min_bytes, page_id, html)
    members = rows.mapInArrow(build, "member binary").select(F.col("member").cast("string").alias("value"))
    members.write.option("lineSep", "\0").text(folder)


def parse(content: bytes) -> tuple | None:
    """The record's fields, or None if the bytes are no WARC record."""
    if not content.startswith(b"WARC/"):
        return None
    head, mark, rest = content.partition(b"\r\n\r\n")
    if not mark:
        return None
    fields = dict(line.split(": ", 1) for line in head.decode("utf-8", "replace").split("\r\n")[1:] if ": " in line)
    kind = fields.get("WARC-Type")
    payload = rest[: int(fields.get("Content-Length", 0))]
    digest = fields.get("WARC-Payload-Digest", "").removeprefix("sha1:") or None
    if kind == "response" and digest is not None and payload_digest(payload) != digest:
        raise ValueError(f"payload of {fields.get('WARC-Record-ID')} does not have its digest")
    size = fields.get("X-Payload-Length")

    def page(name: str) -> int | None:
        number = fields.get(name, "").removeprefix("<urn:page:").rstrip(">")
        return int(number) if number.lstrip("-").isdigit() else None

    refers_to = page("WARC-Refers-To")
    return (
        page("WARC-Record-ID"),
        fields.get("WARC-Target-URI"),
        kind,
        refers_to,
        digest,
        len(payload) if size is None else int(size),
        payload,
    )


def starts_record(pieces: list[bytes]) -> bool | None:
    """Whether the member that the pieces begin holds a WARC header; None if more of it is needed to tell."""
    unpacker, head, want = zlib.decompressobj(31), b"", b"WARC/"
    try:
        for piece in pieces:
            for part in (MAGIC, *(piece[at : at + 256] for at in range(0, len(piece), 256))):
                head += unpacker.decompress(part, len(want) - len(head))
                if unpacker.eof or not want.startswith(head) or head == want:
                    return head == want
    except zlib.error:
        return False
    return None


class _Assembly:
    """Puts the pieces of one byte range together, in order."""

    def __init__(self, at_file_start: bool):
        self._lead: list[bytes] = []  # pieces before the first record, which end one of an earlier range
        self._leading = not at_file_start
        self._maybe: list[bytes] = []  # pieces that are too little to tell whether a record starts
        self._open: list[bytes] = []
        self._unpacker = None

    def add(self, piece: bytes) -> list[bytes]:
        """The contents of the records that the piece completes."""
        if self._unpacker is not None:
            return self._unpack([piece])
        self._maybe.append(piece)
        starts = starts_record(self._maybe)
        if starts is None:
            return []
        if not starts:
            return self._skip()
        pieces, self._maybe = self._maybe, []
        self._leading, self._unpacker, self._content = False, zlib.decompressobj(31), []
        return self._unpack(pieces)

    def _unpack(self, pieces: list[bytes]) -> list[bytes]:
        for piece in pieces:
            self._open.append(piece)
            self._content.append(self._unpacker.decompress(MAGIC + piece))
        if not self._unpacker.eof:
            return []
        self._unpacker, self._open = None, []
        return [b"".join(self._content)]

    def _skip(self) -> list[bytes]:
        """Gives up the first undecided piece; a record may start at each of the others."""
        first, *others = self._maybe
        self._maybe = []
        if self._leading:
            self._lead.append(first)
        return [content for piece in others for content in self.add(piece)]

    def finish(self) -> list[bytes]:
        """The contents that are left when no piece follows."""
        found = []
        while self._maybe:
            found += self._skip()
        return found

    def rest(self) -> list[tuple[bool | None, list[bytes]]]:
        """(lead, pieces) that the range does not complete: what ends a record of an earlier range, then
        those of a record or of a possible one; lead is null if they may do either."""
        tail = (None if self._leading else False, self._open or self._maybe)
        return [(lead, pieces) for lead, pieces in ((True, self._lead), tail) if pieces]


def _pieces(spark: SparkSession, folder: str) -> DataFrame:
    """(file, range, piece) in file order within each range; the separator is the magic itself."""
    scan = (
        spark.read.option("encoding", "ISO-8859-1").option("lineSep", MAGIC.decode("latin-1")).text(folder)
    )
    return scan.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("range"),
        F.col("value").cast("binary").alias("piece"),
    )


def read_archives(spark: SparkSession, folder: str) -> DataFrame:
    """The records of all archives of a folder, see ``RECORD``."""
    schema = f"{RECORD}, file string, range long, lead boolean, pieces array<binary>"
    names = [c.split()[0] for c in RECORD.split(", ")]
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.binary()]
    rest_kinds = [pa.string(), pa.int64(), pa.bool_(), pa.list_(pa.binary())]

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        columns = zip(*rows, strict=True) if rows else [[] for _ in kinds + rest_kinds]
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds + rest_kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=[*names, "file", "range", "lead", "pieces"])

    def rest(place: tuple, reader: _Assembly) -> list[tuple]:
        return [(*(None,) * len(kinds), *place, lead, pieces) for lead, pieces in reader.rest()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, reader = None, _Assembly(True)
        for whole in batches:
            for batch in small_batches(whole, "piece"):
                rows = []
                for file, start, piece in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    if (file, start) != place:
                        if place:
                            rows += rest(place, reader)
                        place, reader = (file, start), _Assembly(start == 0)
                    for content in reader.add(piece):
                        if (found := parse(content)) is not None:
                            rows.append((*found, None, None, None, None))
                yield batch_of(rows)
        if place:
            yield batch_of(rest(place, reader))

    found = staged(_pieces(spark, folder).mapInArrow(run, schema), "records")
    whole = found.where("file is null").select(*names)
    # a record that its range did not complete goes on with the leading pieces of the next ones
    cut = found.where("file is not null").select("file", "range", "lead", "pieces")
    # (lead pieces before anything that may start a record belong to none)
    order = Window.partitionBy("file").orderBy("range", F.desc("lead"))
    begun = F.max(F.coalesce(~F.col("lead"), F.lit(True))).over(order)
    chain = F.sum(F.when(~F.col("lead"), 1).otherwise(0)).over(order)
    chains = cut.withColumn("begun", begun).withColumn("chain", chain).where("begun").groupBy("file", "chain")

    def join(key, rows):
        leads = [lead is not True for lead in rows["lead"].to_pylist()]  # a range's lead comes first
        parts = sorted(zip(rows["range"].to_pylist(), leads, rows["pieces"].to_pylist(), strict=True))
        reader = _Assembly(True)
        contents = [c for *_, pieces in parts for piece in pieces for c in reader.add(piece)] + reader.finish()
        out = [one for c in contents if (one := parse(c)) is not None]
        columns = zip(*out, strict=True) if out else [[] for _ in kinds]
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    return whole.unionAll(chains.applyInArrow(join, RECORD))
