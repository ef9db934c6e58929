"""WARC archives of Zstandard frames that share a dictionary.

An archive begins with a skippable frame that holds the dictionary, built from its own records; each record after it is a
frame of its own, so that any record can be read alone. Spark writes the archives as it writes any table: on every file
system that it knows, a failed task leaves nothing, and a file is there as a whole or not at all. What closes a row of its
text format, one line feed, is the content of a skippable frame that ends each row.

Payloads are named by their SHA-1. Where several records have the same payload, one keeps it (response) and the others
refer to it (revisit).
"""

from __future__ import annotations

import hashlib
import re
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tideline.llm.shared import new_path, spread_join

#: Fixed values of the format: the frame of the dictionary, any other skippable frame, and a dictionary's own first bytes.
DICTIONARY_FRAME = (0x184D2A5D).to_bytes(4, "little")
SKIPPED_FRAME = (0x184D2A50).to_bytes(4, "little")
DICTIONARY = (0xEC30A437).to_bytes(4, "little")
ZSTD_FRAME = (0xFD2FB528).to_bytes(4, "little")
#: Ends a row; the line feed that Spark writes behind it is its content.
ROW_END = SKIPPED_FRAME + (1).to_bytes(4, "little")
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: The dictionary's size and the bytes of an archive's first records that it is built from; bytes of frames in a row and
#: rows in a file. A longer record is a row of its own.
DICTIONARY_BYTES, SAMPLE_BYTES, ROW_BYTES, FILE_ROWS = 64 << 10, 2 << 20, 1 << 20, 64
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"


def base32_sha1(payload: Column) -> Column:
    """The SHA-1 of a binary column in upper-case base32: 40 hexadecimal digits are 32 of 5 bits."""
    digits = F.sha1(payload)
    five = [F.conv(F.substring(digits, 1 + 5 * g, 5), 16, 10).cast("int") for g in range(8)]
    return F.concat(*(F.substring(F.lit(_BASE32), F.shiftright(x, s).bitwiseAND(31) + 1, F.lit(1)) for x in five for s in (15, 10, 5, 0)))


def archive_rows(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, digest, first, copies: what is to be written for each row of pages (page_id, url, html).

    first is the page_id and url of the response with the same payload, null where a row has no other to refer to: its
    payload is shorter than least_bytes or nobody else's. Rows that are alike in all columns are one row with `copies`.
    """
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", base32_sha1(F.col("payload")))
    #: Keys only; rows of one payload add up before they are sent.
    long = rows.where(F.octet_length("payload") >= least_bytes)
    named = F.when(F.col("page_id").isNotNull(), F.struct("page_id", "url"))
    groups = long.groupBy("digest").agg(F.count("*").alias("n"), F.min(named).alias("first")).where("n > 1")
    marked = spread_join(rows.withColumn("key", F.when(F.octet_length("payload") >= least_bytes, F.col("digest")).otherwise(F.lit(""))), groups.withColumnRenamed("digest", "key"), "key", "n")
    marked = marked.drop("key", "n")
    #: Rows alike in page_id, url and payload are rare; they are counted by keys, and only they are brought together.
    keys = F.struct(F.lit(1).alias("_"), "page_id", "url", "digest")
    twins = marked.where(F.col("first.page_id") == F.col("page_id")).groupBy(F.xxhash64(F.lit(1), keys).alias("t1"), F.xxhash64(keys, F.lit(2)).alias("t2")).agg(F.count("*").alias("n")).where("n > 1")
    tagged = spread_join(marked.withColumns({"t1": F.xxhash64(F.lit(1), keys), "t2": F.xxhash64(keys, F.lit(2))}), twins, ["t1", "t2"], "n")
    single = tagged.where("n is null").select("page_id", "url", "payload", "digest", "first", F.lit(1).cast("long").alias("copies"))
    several = tagged.where("n is not null").groupBy("page_id", "url", "digest").agg(F.first("payload").alias("payload"), F.first("first").alias("first"), F.count("*").alias("copies"))
    return single.unionByName(several.select(single.columns))


@dataclass
class Record:
    """A record as it stands in an archive: its headers and its block."""

    headers: dict[str, str]
    block: bytes

    def to_bytes(self) -> bytes:
        lines = [f"{k}: {v}\r\n" for k, v in self.headers.items()]
        return b"".join([b"WARC/1.1\r\n", "".join(lines).encode(), f"Content-Length: {len(self.block)}\r\n\r\n".encode(), self.block, b"\r\n\r\n"])

    @staticmethod
    def from_bytes(raw: bytes) -> Record:
        head, _, rest = raw.partition(b"\r\n\r\n")
        version, *lines = head.decode().split("\r\n")
        headers = dict(line.split(": ", 1) for line in lines)
        size = int(headers.pop("Content-Length"))
        if not version.startswith("WARC/") or rest[size:] != b"\r\n\r\n":
            raise ValueError("not a WARC record")
        return Record(headers, rest[:size])


def one_line(text: str) -> str:
    """Control characters of a header's value are escaped as in an address."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def record_id(*parts: object) -> str:
    return f"<urn:uuid:{uuid.UUID(hashlib.md5('|'.join(map(str, parts)).encode()).hexdigest())}>"


def page_record(page: dict, revisit: bool, date: str, place: str) -> Record:
    """The response or revisit of a page. `place` names the record where no page does."""
    first = page["first"]
    named = first is not None and not revisit
    headers = {"WARC-Type": "revisit" if revisit else "response", "WARC-Record-ID": record_id(page["digest"], page["page_id"]) if named else record_id(page["digest"], page["page_id"], place), "WARC-Date": date}
    if page["url"] is not None:
        headers["WARC-Target-URI"] = one_line(page["url"])
    headers["WARC-Payload-Digest"] = f"sha1:{page['digest']}"
    if page["page_id"] is not None:
        headers["X-Page-ID"] = str(page["page_id"])
    if revisit:
        headers |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": record_id(page["digest"], first["page_id"]), "WARC-Refers-To-Date": date, "X-Refers-To-Page-ID": str(first["page_id"])}
        if first["url"] is not None:
            headers["WARC-Refers-To-Target-URI"] = one_line(first["url"])
    headers["Content-Type"] = "application/http;msgtype=response"
    answer = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(page['payload'])}\r\n\r\n".encode()
    return Record(headers, answer if revisit else answer + page["payload"])


def page_records(page: dict, date: str, place: str) -> Iterator[Record]:
    """A record for each copy of a page; of those, one is the response if the page is the first of its payload."""
    first = page["first"]
    is_first = first is None or (page["page_id"] == first["page_id"] and page["url"] == first["url"])
    for i in range(page["copies"]):
        yield page_record(page, not is_first or (i > 0 and first is not None), date, f"{place}-{i}")


def build_dictionary(samples: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from records. Too few of them can't be trained on; their bytes themselves are one then."""
    try:
        return zstandard.train_dictionary(min(size, max(1024, sum(map(len, samples)) // 8)), samples, k=1024, d=8).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:size] or b"WARC/1.1\r\n"


def dictionary_frame(dictionary: bytes) -> bytes:
    return DICTIONARY_FRAME + len(dictionary).to_bytes(4, "little") + dictionary


def as_dictionary(raw: bytes) -> zstandard.ZstdCompressionDict:
    if raw[:4] == ZSTD_FRAME:
        raw = zstandard.ZstdDecompressor().decompress(raw)
    return zstandard.ZstdCompressionDict(raw, zstandard.DICT_TYPE_FULLDICT if raw[:4] == DICTIONARY else zstandard.DICT_TYPE_RAWCONTENT)


def frame_end(data: bytes, at: int) -> int:
    """Where the frame that begins at `at` ends: a frame's blocks say how long they are."""
    head = data[at : at + 18]
    with_checksum = zstandard.get_frame_parameters(head).has_checksum
    at += zstandard.frame_header_size(head)
    last = False
    while not last:
        block = int.from_bytes(data[at : at + 3], "little")
        last, kind, size = block & 1, block >> 1 & 3, block >> 3
        at += 3 + (1 if kind == 1 else size)
    return at + 4 * with_checksum


def read_archive(data: bytes) -> Iterator[Record]:
    """The records of an archive, in their order."""
    at, reader = 0, zstandard.ZstdDecompressor()
    while at < len(data):
        magic = int.from_bytes(data[at : at + 4], "little")
        if magic >> 4 == 0x184D2A5:
            end = at + 8 + int.from_bytes(data[at + 4 : at + 8], "little")
            if at == 0 and data[:4] == DICTIONARY_FRAME:
                reader = zstandard.ZstdDecompressor(dict_data=as_dictionary(data[8:end]))
        else:
            end = frame_end(data, at)
            yield Record.from_bytes(reader.decompress(data[at:end]))
        at = end


def write_archives(rows: DataFrame, path: str, date: str = "2024-01-01T00:00:00Z", level: int = 3, file_rows: int = FILE_ROWS) -> None:
    """Write archive_rows() as archives below `path`. A task's records have one dictionary, which each of its files holds;
    a file has up to file_rows rows of about ROW_BYTES. Without rows no file is written."""

    def run(batches):
        part = TaskContext.get().partitionId()
        held: list[bytes] = []
        size = sent = 0
        squeeze = None
        frames: list[bytes] = []

        def begin() -> bytes:
            info = Record({"WARC-Type": "warcinfo", "WARC-Record-ID": record_id("info", part, sent), "WARC-Date": date, "Content-Type": "application/warc-fields"}, b"software: tideline\r\nformat: WARC File Format 1.1\r\n")
            return front + squeeze.compress(info.to_bytes())

        def flush():
            nonlocal frames, size, sent
            head = begin() if sent % file_rows == 0 else b""
            out = pa.RecordBatch.from_arrays([pa.array([b"".join([head, *frames, ROW_END])], pa.binary())], ["frames"])
            frames, size, sent = [], 0, sent + 1
            return out

        def train():
            nonlocal squeeze, front, size
            raw = build_dictionary(held)
            front, squeeze = dictionary_frame(raw), zstandard.ZstdCompressor(level=level, dict_data=as_dictionary(raw), write_checksum=True)
            size = 0

        front, number = b"", 0

        def compressed(raw: bytes):
            nonlocal size
            frames.append(squeeze.compress(raw))
            size += len(frames[-1])

        for batch in batches:
            for i in range(batch.num_rows):
                (page,) = batch.slice(i, 1).to_pylist()
                for record in page_records(page, date, f"{part}-{number}"):
                    raw = record.to_bytes()
                    if squeeze is None:
                        held.append(raw)
                        size += len(raw)
                        if size >= SAMPLE_BYTES:
                            train()
                            for x in held:
                                compressed(x)
                                if size >= ROW_BYTES:
                                    yield flush()
                            held = []
                    else:
                        compressed(raw)
                    if squeeze is not None and size >= ROW_BYTES:
                        yield flush()
                number += 1
        if held:
            train()
            for x in held:
                compressed(x)
                if size >= ROW_BYTES:
                    yield flush()
        if frames:
            yield flush()

    frames = rows.select("page_id", "url", "payload", "digest", "first", "copies").mapInArrow(run, "frames binary")
    frames.select(F.col("frames").cast("string").alias("value")).write.options(maxRecordsPerFile=file_rows, lineSep="\n", compression="none").text(path)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """page_id, url, record_type, payload_bytes, payload_digest, payload, refers_to of each record of the archives below
    `path`, from them alone. payload is null for revisits; the digest and length of a response are those of the payload
    found, and a payload that isn't what its record says is an error. A file is read as a whole, by one task."""
    kinds = "page_id long, url string, record_type string, payload_bytes long, payload_digest string, payload binary, refers_to long"
    names = [k.split()[0] for k in kinds.split(", ")]
    types = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary(), pa.int64()]
    schema = pa.schema(list(zip(names, types, strict=True)))
    number = lambda x: None if x is None else int(x)

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                out, size = [], 0
                for record in read_archive(batch.column("content")[i].as_py()):
                    h = record.headers
                    if h["WARC-Type"] not in ("response", "revisit"):
                        continue
                    answer, _, payload = record.block.partition(b"\r\n\r\n")
                    stated, length = h["WARC-Payload-Digest"].removeprefix("sha1:"), int(re.search(rb"(?i)\r\ncontent-length: *(\d+)", answer)[1])
                    own = h["WARC-Type"] == "response"
                    if own and (base32(hashlib.sha1(payload).digest()) != stated or len(payload) != length):
                        raise ValueError(f"the payload of {h['WARC-Record-ID']} is not what its record says")
                    out.append((number(h.get("X-Page-ID")), h.get("WARC-Target-URI"), h["WARC-Type"], length, stated, payload if own else None, number(h.get("X-Refers-To-Page-ID"))))
                    size += len(payload)
                    if size >= 4 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], schema=schema)
                        out, size = [], 0
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], schema=schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("content").mapInArrow(run, kinds)


def base32(raw: bytes) -> str:
    import base64

    return base64.b32encode(raw).decode()


def archive_pages(pages: DataFrame, path: str | None = None, least_bytes: int = 0) -> DataFrame:
    """read_archives() of what write_archives() wrote for pages: a row for each row of pages (page_id, url, html).

    Of rows with equal payloads of at least least_bytes, the one with the smallest page_id (ties: the smallest url) is a
    response, and the others revisit it. A null html is an empty payload; a null url has no address, and control
    characters in one are escaped. A row without a page_id is never the one that others refer to; where all of a payload
    are without one, each is a response. Rows that repeat are records that repeat: of alike ones that are first, one is the
    response. Texts of any length up to 2 GB are whole records; other columns are left out, whatever they are called. An
    empty table writes no file, and its result is empty.
    """
    path = path or new_path(pages.sparkSession, "archives")
    write_archives(archive_rows(pages, least_bytes), path)
    return read_archives(pages.sparkSession, path)
