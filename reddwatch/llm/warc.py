"""Web archives as seekable Zstandard bundles.

Records that follow each other in a bundle share frames of about FRAME plain bytes, each of which can be
read without the others; any reader of Zstandard gets the records one after another. The footer is a seek table in
a skippable frame, with the compressed and plain size of each frame, as in Zstandard's seekable format. The
index maps a record identifier to its bundle, its frame, and the offset and size of the record in the plain
frame: reading a record takes the bytes of one frame. Bundles are rows of a table in the shared folder, written
and read by Spark.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reddwatch.llm.common import partitions, picked, written

# Plain bytes of a bundle and of a frame; a longer record is a bundle or a frame of its own.
BUNDLE, FRAME = 8 << 20, 128 << 10
# Fixed values of the seekable format: magic numbers of the skippable frame and of its last bytes.
SKIPPABLE, SEEKABLE = 0x184D2A5E, 0x8F92EAB1
DATE = "2025-01-01T00:00:00Z"

BUNDLES = "bundle long, data binary, records binary"
INDEX = "record_id string, page_id long, bundle long, frame long, place long, length long, offset long, size long"
INDEXED = pa.schema([
    ("record_id", pa.string()), ("page_id", pa.int64()), ("frame", pa.int64()), ("place", pa.int64()), ("length", pa.int64()),
    ("offset", pa.int64()), ("size", pa.int64()),
])
RECORD = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long"
)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_uri(page_id: int | None, row: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'page:{page_id}:{row}')}>"


def one_line(text: str) -> str:
    """A header's value: percent signs and control characters are percent-encoded."""
    return "".join(f"%{ord(c):02X}" if c == "%" or ord(c) < 33 or ord(c) == 127 else c for c in text)


def plain_text(line: str) -> str:
    parts = line.split("%")
    return parts[0] + "".join(chr(int(p[:2], 16)) + p[2:] for p in parts[1:])


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, row: int, sha1: str) -> bytes:
    """A response with the payload, or a revisit that refers to the page that has it."""
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: {record_uri(page_id, row)}", f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{sha1}",
    ]
    if url is not None:
        head.append(f"WARC-Target-URI: {one_line(url)}")
    if page_id is not None:
        head.append(f"WARC-Page-Id: {page_id}")
    if refers_to is not None:
        head += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To-Page-Id: {refers_to}",
        ]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (payload if refers_to is None else b"")
    head += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(data: bytes) -> tuple[dict[str, str], int, bytes]:
    """Headers, the payload's length as its HTTP header says, and the payload that is there."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a record: {lines[0][:40]!r}")
    headers = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(headers["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("the record's length is wrong")
    http, _, payload = block.partition(b"\r\n\r\n")
    length = next(int(x.split(b": ")[1]) for x in http.split(b"\r\n") if x.startswith(b"Content-Length"))
    return headers, length, payload


def seek_table(sizes: list[tuple[int, int]]) -> bytes:
    """A skippable frame with the compressed and plain size of each frame before it."""
    body = np.array(sizes, dtype="<u4").tobytes()
    body += np.array([len(sizes)], dtype="<u4").tobytes() + b"\0" + np.array([SEEKABLE], dtype="<u4").tobytes()
    return np.array([SKIPPABLE, len(body)], dtype="<u4").tobytes() + body


def frames(bundle: bytes) -> list[tuple[int, int]]:
    """Place and compressed length of each frame, from the footer alone."""
    if int(np.frombuffer(bundle[-4:], "<u4")[0]) != SEEKABLE:
        raise ValueError("no seek table")
    n = int(np.frombuffer(bundle[-9:-5], "<u4")[0])
    sizes = np.frombuffer(bundle[len(bundle) - 9 - 8 * n : len(bundle) - 9], "<u4").reshape(n, 2)[:, 0].astype(np.int64)
    return list(zip((np.cumsum(sizes) - sizes).tolist(), sizes.tolist()))


def frame(bundle: bytes, place: int, length: int) -> bytes:
    return zstandard.ZstdDecompressor().decompress(bundle[place : place + length])


def decided(pages: DataFrame, least: int, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """Pages with their payload, its length and digest, and the page they refer to.

    Pages with equal payloads are known by length and digest; which page of them is the largest is summed up before
    the shuffle, so a payload that a third of all pages share costs a row for each task there. Where pages meet
    what was found, such a group is dealt over as many tasks as its rows fill.
    """
    rows = picked(pages, page_id=(id_col, "long"), url=(url_col, "string"), html=(html_col, "string"))
    rows = rows.withColumn("payload", F.coalesce("html", F.lit("")).cast("binary")).drop("html")
    rows = rows.withColumn("payload_bytes", F.octet_length("payload").cast("long"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    same = ["sha1", "payload_bytes"]
    first = rows.groupBy(*same).agg(F.max("page_id").alias("largest"), F.count("*").alias("n"))
    first = written(first.filter((F.col("n") > 1) & (F.col("payload_bytes") >= least)), "payloads")
    # Groups larger than what a task gets on average; fewer than there are tasks, so their list is short.
    mean = max(1, pages.count() // partitions(pages.sparkSession))
    large = F.broadcast(first.filter(F.col("n") > mean).select(*same, F.ceil(F.col("n") / mean).alias("parts")))
    dealt = rows.join(large, same, "left").withColumn(
        "part", F.pmod(F.xxhash64("page_id", "url"), F.coalesce("parts", F.lit(1)))
    )
    parts = F.greatest(F.ceil(F.col("n") / mean), F.lit(1))
    first = first.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)))
    joined = dealt.join(first.select(*same, "part", "largest"), [*same, "part"], "left")
    return joined.select(
        "page_id", "url", "payload", "payload_bytes",
        F.when(~F.col("page_id").eqNullSafe(F.col("largest")), F.col("largest")).alias("refers_to"),
    )


def bundles(
    pages: DataFrame, least: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    bundle: int = BUNDLE, frame: int = FRAME,
) -> DataFrame:
    """Archives: bundle, data (a .warc.zst file with a seek table) and records (their index; page ids null as absent).

    A null html is an empty payload, a null url gives no target header. Of pages with equal payloads of at
    least `least` bytes the one with the largest page_id is the response and the others revisit it; rows
    that repeat the largest page_id with that payload are responses too, and pages with a null id revisit
    it. Payloads whose pages all have null ids are all responses.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = TaskContext.get().partitionId() << 33
        row = number = 0
        open_bundle = Bundle()
        for batch in batches:
            for page_id, url, payload, refers_to in zip(
                *(batch[c].to_pylist() for c in ("page_id", "url", "payload", "refers_to"))
            ):
                plain = record(page_id, url, payload, refers_to, first + row, digest(payload))
                if open_bundle.size and open_bundle.size + len(plain) > bundle:
                    yield open_bundle.closed(first + number)
                    number, open_bundle = number + 1, Bundle()
                open_bundle.add(record_uri(page_id, first + row), page_id, plain, frame)
                row += 1
        if open_bundle.size:
            yield open_bundle.closed(first + number)

    rows = decided(pages, least, id_col, url_col, html_col)
    return rows.mapInArrow(run, BUNDLES)


class Bundle:
    """An archive that is being written: closed frames, and the records of the open one."""

    def __init__(self) -> None:
        self.size = self.place = 0
        self.frames: list[bytes] = []
        self.sizes: list[tuple[int, int]] = []
        self.waiting: list[tuple[str, int | None, bytes]] = []
        self.filled = 0
        self.index: list[tuple] = []

    def add(self, record_id: str, page_id: int | None, plain: bytes, frame: int) -> None:
        if self.filled and self.filled + len(plain) > frame:
            self.close_frame()
        self.waiting.append((record_id, page_id, plain))
        self.filled += len(plain)
        self.size += len(plain)

    def close_frame(self) -> None:
        data = zstandard.ZstdCompressor(level=3).compress(b"".join(plain for _, _, plain in self.waiting))
        offset = 0
        for record_id, page_id, plain in self.waiting:
            self.index.append((record_id, page_id, len(self.frames), self.place, len(data), offset, len(plain)))
            offset += len(plain)
        self.frames.append(data)
        self.sizes.append((len(data), offset))
        self.place += len(data)
        self.waiting, self.filled = [], 0

    def closed(self, number: int) -> pa.RecordBatch:
        self.close_frame()
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, INDEXED) as writer:
            writer.write_batch(pa.RecordBatch.from_arrays(
                [pa.array(column, kind) for column, kind in zip(zip(*self.index), INDEXED.types)], schema=INDEXED
            ))
        data = b"".join(self.frames) + seek_table(self.sizes)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([number], pa.int64()), pa.array([data], pa.binary()),
                pa.array([sink.getvalue().to_pybytes()], pa.binary()),
            ],
            names=["bundle", "data", "records"],
        )


def index(archives: DataFrame) -> DataFrame:
    """Where each record is: record_id, page_id, bundle, frame, the frame's place and length in the bundle, and the
    record's offset and size in the plain frame."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, records in zip(batch["bundle"].to_pylist(), batch["records"].to_pylist()):
                found = pa.ipc.open_stream(records).read_all()
                found = found.add_column(2, "bundle", pa.array([number] * found.num_rows, pa.int64()))
                yield from found.combine_chunks().to_batches()

    return archives.select("bundle", "records").mapInArrow(run, INDEX)


def records(data: bytes, indexed: bytes) -> Iterator[tuple[str, bytes]]:
    """Identifier and plain bytes of each record of a bundle, as its index places them; a frame is read once."""
    known = frames(data)
    at, plain = None, b""
    for entry in pa.ipc.open_stream(indexed).read_all().to_pylist():
        if entry["frame"] != at:
            at = entry["frame"]
            if known[at] != (entry["place"], entry["length"]):
                raise ValueError(f"index and seek table differ on frame {at}")
            plain = frame(data, *known[at])
        yield entry["record_id"], plain[entry["offset"] : entry["offset"] + entry["size"]]


def read(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """Each record as the index places it in its frame: page_id, url, payload_bytes, payload_digest, record_type,
    refers_to, and `payload` (null for revisits) if asked for. Identifiers, and digests of responses, are checked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, indexed in zip(batch["data"], batch["records"]):
                rows = []
                for record_id, plain in records(data.as_py(), indexed.as_py()):
                    headers, size, payload = parsed(plain)
                    kind = headers["WARC-Type"]
                    sha1 = headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    if headers["WARC-Record-ID"] != record_id:
                        raise ValueError(f"the index has {record_id} where {headers['WARC-Record-ID']} is")
                    if kind == "response" and (digest(payload) != sha1 or len(payload) != size):
                        raise ValueError(f"payload of {record_id} is damaged")
                    page_id, refers_to = headers.get("WARC-Page-Id"), headers.get("WARC-Refers-To-Page-Id")
                    url = headers.get("WARC-Target-URI")
                    rows.append((
                        None if page_id is None else int(page_id), None if url is None else plain_text(url), size, sha1,
                        kind, None if refers_to is None else int(refers_to), payload if kind == "response" else None,
                    ))
                kinds = [pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.binary()]
                names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]
                n = 7 if payloads else 6
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays([pa.array(columns[i], kinds[i]) for i in range(n)], names=names[:n])

    return archives.select("data", "records").mapInArrow(run, RECORD + (", payload binary" if payloads else ""))


def lookup(archives: DataFrame, wanted: DataFrame, by: str = "record_id") -> DataFrame:
    """record_id, page_id and record (its plain bytes) of the wanted records, by `record_id` or by `page_id`.

    A frame that has wanted records is read once, and no other one. Null and unknown identifiers give no row, repeated
    ones no further row.
    """
    found = index(archives).join(wanted.select(by).distinct(), by)
    entries = F.collect_list(F.struct("record_id", "page_id", "offset", "size")).alias("entries")
    found = found.groupBy("bundle", "frame", "place", "length").agg(entries)
    rows = archives.select("bundle", "data").join(found, "bundle").select(
        "entries", F.expr("substring(data, cast(place as int) + 1, cast(length as int))").alias("frame")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, entries in zip(batch["frame"], batch["entries"].to_pylist()):
                plain = zstandard.ZstdDecompressor().decompress(data.as_py())
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([e["record_id"] for e in entries], pa.string()),
                        pa.array([e["page_id"] for e in entries], pa.int64()),
                        pa.array([plain[e["offset"] : e["offset"] + e["size"]] for e in entries], pa.binary()),
                    ],
                    names=["record_id", "page_id", "record"],
                )

    return rows.mapInArrow(run, "record_id string, page_id long, record binary")


def archived(
    pages: DataFrame, least: int = 0, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    bundle: int = BUNDLE, frame: int = FRAME,
) -> DataFrame:
    """What `read` gives of the archives of these pages, written to the shared folder and read back.

    An empty table gives no archives and no rows; repeated rows are records of their own; further columns
    are ignored, whatever their names.
    """
    return read(written(bundles(pages, least, id_col, url_col, html_col, bundle, frame), "archives"))
