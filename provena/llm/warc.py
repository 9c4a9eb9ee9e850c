"""WARC archives in Zstandard: write records with a per-archive dictionary, read and validate them.

An archive begins with a skippable frame that holds its dictionary; every record after it is one Zstandard frame that
needs the dictionary.  The writer trains the dictionary on the archive's first records (``SAMPLE_BYTES`` at most, which
touches the size of the file and never its content); where there is too little to train on, the archive has none.  The
reader accepts a raw or a compressed dictionary, decodes frame by frame, and checks the version line, the header
syntax, that the mandatory fields are there once each, that the block has ``Content-Length`` bytes and ends in two line
ends, and that payload and block digests fit; anything else raises ``WarcError`` with file and offset.

Payloads of at least ``MIN_REVISIT`` bytes that are equal (by SHA-1 and size) are kept once: the record of the largest
``page_id`` is the response, the others are revisits that refer to it.  The pairing goes by page_id, size and digest, so
two payloads of one page_id are decided apart; it moves these three only, and the many copies of one payload are combined
before the shuffle.  Pages without an id, and rows that repeat ``OFTEN`` times or more, are spread over all archives.

Defined results: null html is an empty payload; a null ``page_id`` is written as a record without that field and read
back as null (it counts as smaller than any id); a null url becomes an empty target; repeated rows of one ``page_id``
are a record each; an empty table gives no archives and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import io
import re
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, slices, stored
from .tokenfile import store_of

#: Fixed values of the formats: Zstandard's frame, dictionary and WARC's skippable frame numbers.
FRAME_MAGIC, DICT_MAGIC, SKIP_MAGIC = 0xFD2FB528, 0xEC30A437, 0x184D2A5D
MIN_REVISIT = 1000
KEY = ("page_id", "size", "digest")
#: A row repeated so often is spread over all archives; so many of them at most (a broadcast), the most frequent first.
OFTEN, MOST = 1000, 1 << 16
SAMPLE_BYTES, DICT_BYTES = 512 << 10, 32 << 10
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2020-01-01T00:00:00Z"
_CR = "\r\n"


class WarcError(ValueError):
    """An archive that breaks the format."""


def record_bytes(page: dict) -> bytes:
    """One WARC record: headers, then the HTTP message (a revisit keeps the HTTP headers only)."""
    payload, digest = page["payload"], page["digest"]
    http = f"HTTP/1.1 200 OK{_CR}Content-Type: text/html; charset=utf-8{_CR}Content-Length: {len(payload)}{_CR}{_CR}".encode()
    revisit = page["refers_to"] is not None
    block = http if revisit else http + payload
    sha = lambda b: base64.b32encode(b).decode()
    name = f"{page['page_id']}-{page['row']}"
    head = [("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, name)}>"),
            ("WARC-Date", DATE), ("WARC-Target-URI", re.sub(r"[\x00-\x20]+", "%20", page["url"] or "")),
            ("Content-Type", "application/http; msgtype=response"),
            ("WARC-Payload-Digest", "sha1:" + sha(bytes.fromhex(digest))),
            ("WARC-Block-Digest", "sha1:" + sha(hashlib.sha1(block).digest()))]
    if page["page_id"] is not None:
        head.append(("Page-ID", str(page["page_id"])))
    if revisit:
        head += [("WARC-Profile", REVISIT_PROFILE), ("Refers-To-Page", str(page["refers_to"]))]
    head.append(("Content-Length", str(len(block))))
    text = "WARC/1.1" + _CR + "".join(f"{k}: {v}{_CR}" for k, v in head) + _CR
    return text.encode() + block + b"\r\n\r\n"


def dictionary_of(sample: list[bytes]) -> bytes:
    """A dictionary trained on records, or nothing where they are too few."""
    if len(sample) < 16 or sum(map(len, sample)) < 8 * DICT_BYTES // 4:
        return b""
    try:
        return zstandard.train_dictionary(min(DICT_BYTES, sum(map(len, sample)) // 8), sample).as_bytes()
    except zstandard.ZstdError:  # e.g. records that are all the same
        return b""


class ArchiveWriter:
    """One archive; the first records wait until the dictionary is trained on them."""

    def __init__(self, folder: str, name: str):
        self.fs, base = store_of(folder)
        self.fs.create_dir(base, recursive=True)
        self.path, self.part = f"{base}/{name}", f"{base}/_{name}.{uuid.uuid4().hex}"
        self.out = self.fs.open_output_stream(self.part, compression=None)
        self.wait: list[bytes] = []
        self.waiting = 0
        self.frames = None

    def add(self, record: bytes) -> None:
        if self.frames is None:
            self.wait.append(record)
            self.waiting += len(record)
            if self.waiting < SAMPLE_BYTES:
                return
            self._begin()
        else:
            self.out.write(self.frames.compress(record))

    def _begin(self) -> None:
        d = dictionary_of(self.wait)
        if d:
            packed = zstandard.ZstdCompressor(level=9).compress(d)
            self.out.write(struct.pack("<II", SKIP_MAGIC, len(packed)) + packed)
            self.frames = zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(d), write_content_size=True)
        else:
            self.frames = zstandard.ZstdCompressor(level=3, write_content_size=True)
        for r in self.wait:
            self.out.write(self.frames.compress(r))
        self.wait = []

    def close(self) -> None:
        if self.frames is None:
            self._begin()
        self.out.close()
        self.fs.move(self.part, self.path)


def read_frames(stream, where: str = "archive") -> Iterator[tuple[int, bytes]]:
    """(offset, decoded record) of each frame of a stream, one frame at a time."""
    head = stream.read(8)
    d = None
    if len(head) == 8 and struct.unpack("<I", head[:4])[0] == SKIP_MAGIC:
        size = struct.unpack("<I", head[4:])[0]
        raw = stream.read(size)
        if len(raw) != size:
            raise WarcError(f"{where}: dictionary of {len(raw)} bytes, not {size}")
        magic = struct.unpack("<I", raw[:4])[0] if size >= 4 else 0
        if magic == FRAME_MAGIC:
            raw = zstandard.ZstdDecompressor().decompress(raw, max_output_size=256 << 20)
            magic = struct.unpack("<I", raw[:4])[0]
        if magic != DICT_MAGIC:
            raise WarcError(f"{where}: the leading skippable frame holds no dictionary")
        d = zstandard.ZstdCompressionDict(raw)
        buffer, at = b"", 8 + size
    else:
        buffer, at = head, 0
    reader = zstandard.ZstdDecompressor(dict_data=d) if d else zstandard.ZstdDecompressor()
    while True:
        one = reader.decompressobj()
        parts, used = [], 0
        while not one.eof:
            if not buffer:
                buffer = stream.read(256 << 10)
                if not buffer:
                    break
            try:
                parts.append(one.decompress(buffer))
            except zstandard.ZstdError as e:
                raise WarcError(f"{where} at {at}: {e}") from e
            used += len(buffer)
            buffer = b""
        if not one.eof:
            if used:
                raise WarcError(f"{where} at {at}: the last frame is cut off")
            return
        buffer = one.unused_data
        yield at, b"".join(parts)
        at += used - len(buffer)


_FIELD = re.compile(r"([!-9;-~]+):[ \t]*(.*)")
MANDATORY = ("warc-type", "warc-record-id", "warc-date", "content-length")


def parse_record(data: bytes, where: str) -> dict:
    """Headers (lower-case names) and block of one record, validated."""
    end = data.find(b"\r\n\r\n")
    if end < 0:
        raise WarcError(f"{where}: no end of the headers")
    first, *lines = data[:end].decode("utf-8").split(_CR)
    if not re.fullmatch(r"WARC/\d\.\d", first):
        raise WarcError(f"{where}: version line {first[:20]!r}")
    fields: dict[str, str] = {}
    for line in lines:
        m = _FIELD.fullmatch(line)
        if not m:
            raise WarcError(f"{where}: header line {line[:40]!r}")
        name = m[1].lower()
        if name in fields and name in MANDATORY:
            raise WarcError(f"{where}: {m[1]} twice")
        fields[name] = m[2]
    for name in MANDATORY:
        if name not in fields:
            raise WarcError(f"{where}: no {name}")
    if not fields["content-length"].isdigit():
        raise WarcError(f"{where}: content-length {fields['content-length']!r}")
    block, tail = data[end + 4:end + 4 + int(fields["content-length"])], data[end + 4 + int(fields["content-length"]):]
    if len(block) != int(fields["content-length"]) or tail != b"\r\n\r\n":
        raise WarcError(f"{where}: content-length {fields['content-length']}, the block and its end have {len(data) - end - 4} bytes")
    content = {"block": block} | _payload(fields, block, where)
    for name, part in content.items():
        name = f"warc-{name}-digest"
        if not isinstance(part, bytes) or name not in fields:
            continue
        kind, _, value = fields[name].partition(":")
        if kind.lower() == "sha1" and value.upper() not in (base64.b32encode(hashlib.sha1(part).digest()).decode(), hashlib.sha1(part).hexdigest().upper()):
            raise WarcError(f"{where}: {name} doesn't fit")
    if "payload-length" in fields and (not fields["payload-length"].isdigit() or int(fields["payload-length"]) != content.get("payload-bytes")):
        raise WarcError(f"{where}: payload-length {fields['payload-length']}, the payload has {content.get('payload-bytes')} bytes")
    return fields | content


def _payload(fields: dict, block: bytes, where: str) -> dict:
    """The payload of a record and its size, by its type.  An HTTP message's payload is what follows its headers, and has
    the ``Content-Length`` that these tell; a revisit has the headers of a message that is kept elsewhere, so only the
    size is known.  What is no HTTP message is its own payload; warcinfo and metadata records count as such."""
    http = fields.get("content-type", "").replace(" ", "").lower().startswith("application/http")
    if not http:
        return {} if fields["warc-type"] == "revisit" else {"payload": block, "payload-bytes": len(block)}
    end = block.find(b"\r\n\r\n")
    if end < 0:
        raise WarcError(f"{where}: no end of the HTTP headers")
    told = re.search(rb"(?im)^content-length:[ \t]*(\d+)[ \t]*\r?$", block[:end])
    whole = re.search(rb"(?im)^transfer-encoding:", block[:end]) is None
    if fields["warc-type"] == "revisit":
        return {"payload-bytes": int(told[1])} if told else {}
    payload = block[end + 4:]
    if fields["warc-type"] == "response" and told and whole and int(told[1]) != len(payload) and "warc-truncated" not in fields:
        raise WarcError(f"{where}: the HTTP message tells {int(told[1])} bytes and has {len(payload)}")
    return {"payload": payload, "payload-bytes": len(payload)}


def _digest(record: dict) -> str | None:
    """SHA-1 of the payload in hex: as the record's header has it, or worked out where the payload is there."""
    kind, _, value = record.get("warc-payload-digest", "").partition(":")
    if kind.lower() == "sha1":
        return base64.b32decode(value.upper()).hex() if len(value) == 32 else value.lower()
    return hashlib.sha1(record["payload"]).hexdigest() if "payload" in record else None


def _known(pages: DataFrame) -> DataFrame:
    """page_id, url, html, size and SHA-1 (hex) of the payload."""
    payload = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    return pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html",
                        F.octet_length(payload).alias("size"), F.sha1(payload).alias("digest"))


def pair_copies(keys: DataFrame, minimum: int = MIN_REVISIT) -> DataFrame:
    """(page_id, size, digest, refers_to), one row per key, of the keys whose payload a page with a larger id keeps.
    ``keys`` has one row per (page_id, size, digest)."""
    long = keys.where((F.col("size") >= minimum) & F.col("page_id").isNotNull()).select(*KEY)
    # the many copies of one payload are combined in each task before they move
    keep = (long.groupBy("digest", "size").agg(F.max("page_id").alias("refers_to"), F.min("page_id").alias("least"))
            .where("least < refers_to").drop("least"))
    return long.join(keep, ["digest", "size"]).where("page_id < refers_to").select(*KEY, "refers_to")


def write_archives(pages: DataFrame, folder: str, archives: int | None = None, minimum: int = MIN_REVISIT) -> DataFrame:
    """Write one record per page into ``archives`` files (the session's shuffle partitions by default), dealt by
    page and payload; returns the stored list of files."""
    spark = pages.sparkSession
    ship(spark)
    n = archives or int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = _known(pages)
    keys = stored(src.where("page_id IS NOT NULL").groupBy(*KEY).agg(F.count(F.lit(1)).alias("times")), "warc-keys")
    copies = stored(pair_copies(keys, minimum), "warc-copies")
    # rows that repeat often, the most frequent of them, are spread over all archives; their pairs come by broadcast
    often = (keys.where(F.col("times") >= OFTEN).orderBy(F.desc("times"), *KEY).limit(MOST).drop("times")
             .join(copies, [*KEY], "left").select(*KEY, F.col("refers_to").alias("often_to"), F.lit(True).alias("often")))
    spread = F.xxhash64(*KEY, F.when(F.col("page_id").isNull() | F.col("often").isNotNull(), F.monotonically_increasing_id()))
    # dealt once: the join keeps that dealing, and the tasks that write get it
    dealt = src.join(F.broadcast(stored(often, "warc-often")), [*KEY], "left").withColumn("deal", spread).repartition(n, "deal", *KEY)
    rows = (dealt.join(copies.withColumn("deal", F.xxhash64(*KEY, F.lit(None).cast("long"))), ["deal", *KEY], "left")
            .withColumn("refers_to", F.coalesce("refers_to", "often_to"))
            .withColumn("tie", F.xxhash64("url", "html")).sortWithinPartitions("page_id", "tie")
            .select("page_id", "url", "html", "refers_to", "digest"))

    def write(batches):
        part, out, row = TaskContext.get().partitionId(), None, 0
        name = f"part-{part:06d}.warc.zst"
        for b in slices(batches, "html"):
            out = out or ArchiveWriter(folder, name)
            for page_id, url, html, refers_to, digest in zip(*(b.column(i).to_pylist() for i in range(5))):
                out.add(record_bytes({"page_id": page_id, "url": url, "payload": (html or "").encode(), "refers_to": refers_to,
                                      "row": f"{part}-{row}", "digest": digest}))
                row += 1
        if out:
            out.close()
            yield pa.RecordBatch.from_arrays([pa.array([name]), pa.array([row], pa.int64())], names=["file", "n_records"])

    path = f"{folder}/_files"
    made = rows.mapInArrow(write, "file string, n_records long")
    made.write.mode("overwrite").parquet(path)
    return spark.read.schema(made.schema).parquet(path)


def read_archives(files: DataFrame, folder: str, with_payload: bool = True) -> DataFrame:
    """One row per record, of whatever type: page_id and refers_to (null where the record has no such field), url, record_type,
    record_id, refers_to_record, payload_bytes (measured; of a revisit as its HTTP headers tell), payload_digest (SHA-1,
    hex), payload (binary, null for a revisit)."""
    ship(files.sparkSession)
    schema = ("page_id long, url string, record_type string, record_id string, refers_to long, refers_to_record string, payload_bytes long, "
              "payload_digest string"
              + (", payload binary" if with_payload else ""))

    def rows(name: str):
        fs, base = store_of(folder)
        with fs.open_input_stream(f"{base}/{name}", compression=None) as stream:
            for at, data in read_frames(stream, name):
                yield parse_record(data, f"{name} at {at}")

    def batch(records: list[dict]) -> pa.RecordBatch:
        number = lambda r, k: int(r[k]) if re.fullmatch("-?[0-9]+", r.get(k, "")) else None
        cols = [pa.array([number(r, "page-id") for r in records], pa.int64()),
                pa.array([r.get("warc-target-uri") for r in records], pa.string()),
                pa.array([r["warc-type"] for r in records], pa.string()),
                pa.array([r["warc-record-id"] for r in records], pa.string()),
                pa.array([number(r, "refers-to-page") for r in records], pa.int64()),
                pa.array([r.get("warc-refers-to") for r in records], pa.string()),
                pa.array([r.get("payload-bytes") for r in records], pa.int64()),
                pa.array([_digest(r) for r in records], pa.string())]
        names = ["page_id", "url", "record_type", "record_id", "refers_to", "refers_to_record", "payload_bytes", "payload_digest"]
        if with_payload:
            cols.append(pa.array([r.get("payload") for r in records], pa.binary()))
            names.append("payload")
        return pa.RecordBatch.from_arrays(cols, names=names)

    def read(batches):
        for b in batches:
            for name in b.column(0).to_pylist():
                held, size = [], 0
                for r in rows(name):
                    held.append(r)
                    size += len(r["block"])
                    if size > 2 << 20 or len(held) >= 2000:
                        yield batch(held)
                        held, size = [], 0
                if held:
                    yield batch(held)

    n = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return files.select("file").repartition(n).mapInArrow(read, schema)


def archive_from_bytes(data: bytes) -> list[dict]:
    """The records of an archive held in memory."""
    return [parse_record(r, f"offset {at}") for at, r in read_frames(io.BytesIO(data))]
