"""WARC archives: records written one gzip member each, and a sequential reader that checks them.

Writing: equal payloads are told by SHA-256; of a group the smallest page_id keeps the payload as a ``response``, the others
become ``revisit`` records that refer to it and hold only the header block, with the payload's length and digest. Tasks write
files of ``FILE_BYTES`` under names of their own in the shared folder; a file counts only if the table of files that the
whole job stores names it, so attempts that were lost or ran twice leave nothing that anybody reads.

Reading: a task takes a file from its start, inflates in pieces of ``CHUNK`` bytes, frames the block by Content-Length,
hashes it as it goes, and holds no more than a piece unless the payload is asked for. Each record says what is wrong with it
(``error``): a digest, a length, a header, data beyond the record. The next member is read nonetheless; a member that can't be inflated
ends its file, as nothing says where the next one starts.

Groups: rows of the ``HEAVY`` commonest payloads, and of payloads too short to be judged, go to the writers without a shuffle
(the former by a broadcast of HEAVY rows at most); the others meet their group's smallest page_id by a join on the digest, where no group is
larger than 1 / HEAVY of the rows.

Defined cases: a null html is an empty payload, a null url gives no target URI; a null page_id has no number in its record id, and is the response only
of a group without any other; rows that repeat the smallest page_id are all responses; control characters and spaces of a URL are
percent-encoded in the header; other columns are ignored; an empty table gives no records.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lacuna.llm.text import mapped, stored
from lacuna.session import shared_folder

#: Payloads of fewer bytes are never revisits; size after which a writer begins another file.
LEAST, FILE_BYTES = 100, 1 << 27
HEAVY = 1000
CHUNK, LONGEST_HEADER = 1 << 18, 1 << 16
IDENTITY = "urn:page:"

#: The format's version, and the profile of a record whose payload equals another's.
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

FILES = "path string, bytes long, records long"
RECORDS = "path string, place long, type string, record_id string, target_uri string, refers_to string, payload_bytes long, payload_digest string, payload binary, error string"


def assigned(pages: DataFrame, least: int = LEAST, heavy: int = HEAVY) -> DataFrame:
    """page_id, url, payload (binary, null in revisits), payload_bytes, digest (binary), record_type, refers_to."""
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload")).select(
        "*", F.octet_length("payload").cast("long").alias("payload_bytes"), F.unhex(F.sha2("payload", 256)).alias("digest")
    )
    judged = rows.where(F.col("payload_bytes") >= least)
    groups = stored(judged.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1"))
    common = groups.orderBy(F.desc("n"), "digest").limit(heavy)
    by_task = judged.join(F.broadcast(common.select("digest", "first")), "digest")  # HEAVY rows
    others = judged.join(F.broadcast(common.select("digest")), "digest", "left_anti").join(groups.select("digest", "first"), "digest", "left")
    every = rows.where(F.col("payload_bytes") < least).withColumn("first", F.lit(None).cast("long")).unionByName(by_task).unionByName(others)
    revisits = F.col("first").isNotNull() & ~F.col("first").eqNullSafe(F.col("page_id"))
    return every.select(
        "page_id", "url", F.when(~revisits, F.col("payload")).alias("payload"), "payload_bytes", "digest",
        F.when(revisits, "revisit").otherwise("response").alias("record_type"), F.when(revisits, F.col("first")).alias("refers_to"),
    )


def record_id(page_id: int | None) -> str:
    return f"<{IDENTITY}{'' if page_id is None else page_id}>"


def member(headers: list[tuple[str, str]], block: bytes) -> bytes:
    """A record as one gzip member. Its block digest and length are added."""
    lines = [VERSION, *(f"{k}: {v}" for k, v in headers), f"WARC-Block-Digest: sha256:{hashlib.sha256(block).hexdigest()}", f"Content-Length: {len(block)}"]
    z = zlib.compressobj(6, zlib.DEFLATED, 31)
    return z.compress("\r\n".join(lines).encode() + b"\r\n\r\n") + z.compress(block) + z.compress(b"\r\n\r\n") + z.flush()


def page_record(page_id: int | None, url: str | None, payload: bytes | None, size: int, digest: bytes, kind: str, refers_to: int | None) -> bytes:
    headers = [("WARC-Type", kind), ("WARC-Record-ID", record_id(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        headers.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)))
    if kind == "revisit":
        headers += [("WARC-Refers-To", record_id(refers_to)), ("WARC-Profile", PROFILE)]
    headers += [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha256:{digest.hex()}")]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    return member(headers, http + (payload or b""))


def opened(path: str, how: str = "input"):
    """A stream of a file in the store that its URI names."""
    from pyarrow import fs

    store, at = (fs.LocalFileSystem(), path.removeprefix("file:")) if path.startswith(("file:", "/")) else fs.FileSystem.from_uri(path)
    if how == "output":
        store.create_dir(at.rsplit("/", 1)[0], recursive=True)
        return store.open_output_stream(at, compression=None)
    return store.open_input_stream(at, compression=None)


def write_archives(rows: DataFrame, folder: str, file_bytes: int = FILE_BYTES) -> DataFrame:
    """FILES: the archives of rows of ``assigned``, stored; only these files count, whatever else is in the folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, path, size, records = None, "", 0, 0

        def closed() -> pa.RecordBatch:
            out.close()
            return pa.RecordBatch.from_pylist([{"path": path, "bytes": size, "records": records}])

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    path, records = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0
                    out = opened(path, "output")
                    first = member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:uuid:{uuid.uuid4()}>"), ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n")
                    out.write(first)
                    size = len(first)
                data = page_record(*row)
                out.write(data)
                size, records = size + len(data), records + 1
                if size >= file_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    columns = ["page_id", "url", "payload", "payload_bytes", "digest", "record_type", "refers_to"]
    return stored(mapped(rows.select(*columns), run, FILES))


class Damaged(Exception):
    """What is wrong with a record."""


class Members:
    """The gzip members of a stream, one after the other, inflated piece by piece."""

    def __init__(self, stream):
        self.stream, self.raw, self.place = stream, b"", 0

    def begin(self) -> bool:
        """Whether there is another member. It starts at ``place``."""
        if not self.raw:
            self._fill()
        self.start, self.z, self.out = self.place - len(self.raw), zlib.decompressobj(31), b""
        return bool(self.raw)

    def _fill(self) -> None:
        self.raw = bytes(self.stream.read(CHUNK))
        self.place += len(self.raw)

    def more(self) -> bool:
        """Adds a piece to ``out``; False at the member's end."""
        while not self.z.eof:
            if not self.raw:
                self._fill()
            last = not self.raw
            try:
                piece = self.z.decompress(self.raw, CHUNK)
            except zlib.error as e:
                raise EOFError(f"can't be inflated: {e}") from None
            self.raw = self.z.unused_data if self.z.eof else self.z.unconsumed_tail
            if piece:
                self.out += piece
                return True
            if last and not self.z.eof:
                raise EOFError("the file ends within a record")
        return False

    def until(self, mark: bytes, most: int) -> bytes:
        """What comes before the next ``mark``, which is passed."""
        while (at := self.out.find(mark)) < 0:
            if len(self.out) > most:
                raise Damaged(f"no end of the header within {most} bytes")
            if not self.more():
                raise Damaged("no end of the header")
        found, self.out = self.out[:at], self.out[at + len(mark) :]
        return found

    def pieces(self, size: int) -> Iterator[bytes]:
        while size:
            if not self.out and not self.more():
                raise Damaged(f"{size} bytes of the block are missing")
            piece, self.out = self.out[:size], self.out[size:]
            size -= len(piece)
            yield piece

    def rest(self) -> bytes:
        """What is left of the member, its first bytes only if there are many; afterwards the next one can begin."""
        found = self.out
        while True:
            self.out = b""
            if not self.more():
                return found
            found = (found + self.out)[:16]


def fields(head: bytes) -> tuple[str, dict[str, str]]:
    """(first line, fields by lower-case name); folded lines are joined."""
    lines = re.sub(r"\r\n[ \t]+", " ", head.decode("utf-8", errors="replace")).split("\r\n")
    pairs = [line.partition(":") for line in lines[1:]]
    if bad := [a for a, colon, _ in pairs if not colon]:
        raise Damaged(f"a header line without a colon: {bad[0][:40]!r}")
    return lines[0], {a.strip().lower(): b.strip() for a, _, b in pairs}


def _whole(text: str | None, what: str) -> int:
    if text is None or not re.fullmatch(r"[0-9]{1,18}", text):
        raise Damaged(f"{what} isn't a length: {text!r}")
    return int(text)


def _same(declared: str | None, found: str, what: str) -> None:
    """Digests of SHA-256 in hex are compared; those of other methods can't be."""
    if declared and declared.lower().startswith("sha256:") and declared[7:].lower() != found:
        raise Damaged(f"{what} is {found}, not {declared[7:]}")


def _read(members: Members, want: bool) -> dict:
    row: dict = {}
    try:
        version, head = fields(members.until(b"\r\n\r\n", LONGEST_HEADER))
        bare = lambda name: head[name].strip("<>") if name in head else None
        row |= {"type": head.get("warc-type"), "record_id": bare("warc-record-id"), "target_uri": head.get("warc-target-uri"), "refers_to": bare("warc-refers-to")}
        if not version.startswith("WARC/"):
            raise Damaged(f"not a WARC record: {version[:40]!r}")
        size = _whole(head.get("content-length"), "Content-Length")
        block, payload = hashlib.sha256(), hashlib.sha256()
        http, seen, length, kept = head.get("content-type", "").startswith("application/http"), b"", 0, []
        inside = not http
        for piece in members.pieces(size):
            block.update(piece)
            if not inside:
                seen += piece
                if (at := seen.find(b"\r\n\r\n")) < 0:
                    if len(seen) > LONGEST_HEADER:
                        raise Damaged("no end of the HTTP header")
                    continue
                inside, piece, seen = True, seen[at + 4 :], seen[:at]
            payload.update(piece)
            length += len(piece)
            if want:
                kept.append(piece)
        if members.rest() != b"\r\n\r\n":
            raise Damaged("the record doesn't end where its length says")
        _same(head.get("warc-block-digest"), block.hexdigest(), "the block's digest")
        declared = head.get("warc-payload-digest")
        if row["type"] == "revisit":
            if length:
                raise Damaged("a revisit with a payload")
            row |= {"payload_bytes": _whole(fields(seen)[1].get("content-length"), "the payload's length") if http else None, "payload_digest": declared.split(":")[-1].lower() if declared else None}
        else:
            _same(declared, payload.hexdigest(), "the payload's digest")
            row |= {"payload_bytes": length, "payload_digest": payload.hexdigest(), "payload": b"".join(kept) if want else None}
    except Damaged as e:
        row["error"] = str(e)
        members.rest()
    return row


def records_of(stream, want: bool = False) -> Iterator[dict]:
    """The records of one archive in their order, with the place of their member."""
    members = Members(stream)
    while members.begin():
        place = members.start
        try:
            yield {"place": place} | _read(members, want)
        except EOFError as e:
            yield {"place": place, "error": str(e)}
            return


def read_archives(files: DataFrame, with_payload: bool = False) -> DataFrame:
    """RECORDS of the archives that ``path`` names, a task for each file (up to 100000 tasks)."""
    schema = pa.schema([("path", pa.string()), ("place", pa.int64()), ("type", pa.string()), ("record_id", pa.string()), ("target_uri", pa.string()), ("refers_to", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary()), ("error", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held = [], 0
                with opened(path) as stream:
                    for row in records_of(stream, with_payload):
                        rows.append({"path": path} | row)
                        held += 500 + len(row.get("payload") or b"")
                        if held >= 1 << 22:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    count = files.count()
    return mapped(files.select("path").repartition(max(1, min(count, 100_000)), "path"), run, RECORDS)


def archived(pages: DataFrame, least: int = LEAST, heavy: int = HEAVY, file_bytes: int = FILE_BYTES) -> DataFrame:
    """FILES: the archives of pages, in a folder of their own in the shared one that goes when the driver ends."""
    spark = pages.sparkSession
    folder = f"{shared_folder(spark)}/lacuna/{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return write_archives(assigned(pages, least, heavy), folder, file_bytes)


def page_number(urn):
    return F.regexp_extract(urn, f"^{IDENTITY}(-?[0-9]+)$", 1).try_cast("long")


def round_trip(pages: DataFrame, least: int = LEAST, heavy: int = HEAVY, file_bytes: int = FILE_BYTES) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type, refers_to as read back from the archives; a damaged record fails the job."""
    records = read_archives(archived(pages, least, heavy, file_bytes)).where(F.col("error").isNotNull() | F.col("type").isin("response", "revisit"))
    sound = F.when(F.col("error").isNotNull(), F.raise_error(F.concat_ws(": ", "path", "error"))).otherwise(F.col("type"))
    return records.select(page_number(F.col("record_id")).alias("page_id"), "payload_bytes", "payload_digest", sound.alias("record_type"), page_number(F.col("refers_to")).alias("refers_to"))
