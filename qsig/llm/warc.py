"""WARC archives in Zstandard: writer, and a reader that validates.

An archive is a leading skippable frame that holds a compression dictionary,
then one Zstandard frame per record, so that a record can be read without its
neighbours.  Tasks write archives of bounded size straight to the shared
folder and return their names; only names of tasks that succeeded reach the
manifest, so a retried task cannot add records twice.

Records of equal payload are stored once: the one with the smallest page_id
is a ``response``, the others are ``revisit`` records that name it and carry
digest and length of the payload, not the payload.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
import uuid
from collections.abc import Iterator
from io import BytesIO

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from qsig.llm.support import join_counted, partitions
from qsig.sources import io

SKIPPABLE = 0x184D2A5D          # magic of the dictionary frame
SKIPPED = range(0x184D2A50, 0x184D2A60)     # magics of skippable frames
READ_BYTES = 1 << 20            # of an archive read at once
FRAME = 0xFD2FB528              # magic of a Zstandard frame
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
RECORD = "urn:page:"


def digest(payload: bytes) -> str:
    """Bare upper-case base32 SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(value: str) -> str:
    """A header value on one line: control and non-ASCII characters as %XX."""
    return re.sub(r"[^\x21-\x7e]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode("utf-8", "surrogatepass")), value)


def record(page: str, url: str | None, payload: bytes | None, payload_digest: str, length: int,
           refers_to: str | None) -> bytes:
    """One WARC/1.1 record; ``payload`` None makes a revisit of ``refers_to``."""
    block = b"" if payload is None else HTTP + payload
    head = [f"WARC-Type: {'revisit' if payload is None else 'response'}", f"WARC-Record-ID: <{RECORD}{page}>",
            f"WARC-Date: {DATE}", f"WARC-Payload-Digest: sha1:{payload_digest}", f"X-Payload-Length: {length}"]
    if url is not None:
        head.append(f"WARC-Target-URI: {_line(url)}")
    if payload is None:
        head += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{RECORD}{refers_to}>"]
    else:
        head += [f"WARC-Block-Digest: sha1:{digest(block)}", "Content-Type: application/http;msgtype=response"]
    head.append(f"Content-Length: {len(block)}")
    return "\r\n".join(["WARC/1.1", *head, "", ""]).encode() + block + b"\r\n\r\n"


def _headers(head: bytes) -> tuple[str, list[tuple[str, str]]]:
    """Version and (name, value) of every header, folded lines joined."""
    version, *lines = head.decode().split("\r\n")
    if version not in ("WARC/1.0", "WARC/1.1"):
        raise ValueError(f"not a WARC record: {version[:20]!r}")
    out: list[tuple[str, str]] = []
    for line in lines:
        if line[:1] in (" ", "\t") and out:
            out[-1] = (out[-1][0], f"{out[-1][1]} {line.strip()}")
            continue
        name, colon, value = line.partition(":")
        if not colon or not name or name != name.strip():
            raise ValueError(f"bad header line {line!r}")
        out.append((name, value.strip()))
    return version, out


def _hold(what: str, value: str | None, data: bytes) -> None:
    """Raises where a digest header of a known algorithm does not fit."""
    algorithm, _, want = (value or "").partition(":")
    if algorithm.lower() not in ("sha1", "sha256", "sha512", "md5"):
        return
    got = hashlib.new(algorithm.lower(), data)
    if want.rstrip("=").upper() not in (base64.b32encode(got.digest()).decode().rstrip("="), got.hexdigest().upper()):
        raise ValueError(f"{what} digest differs")


def read_record(raw: bytes) -> dict:
    """Fields of one record of any type; ValueError where headers, lengths or
    digests do not hold.

    ``payload`` is what follows the headers of an HTTP message, otherwise the
    block; a revisit has none.  ``headers`` are all (name, value) as they
    stand; a header that is repeated counts by its first value, but those that
    every record has may not be."""
    head, sep, rest = raw.partition(b"\r\n\r\n")
    if not sep:
        raise ValueError("record without an end of headers")
    version, headers = _headers(head)
    field: dict[str, str] = {}
    for name, value in headers:
        if field.setdefault(name.lower(), value) != value and name.lower() in _NEEDED:
            raise ValueError(f"two values of {name}")
    for need in _NEEDED:
        if need not in field:
            raise ValueError(f"record without {need}")
    size = int(field["content-length"])
    if size < 0 or len(rest) != size + 4 or rest[size:] != b"\r\n\r\n":
        raise ValueError(f"Content-Length {size} does not fit the record")
    kind, block = field["warc-type"].lower(), rest[:size]
    http = kind in ("response", "request") and field.get("content-type", "").lower().startswith("application/http")
    payload = None if kind == "revisit" else block.partition(b"\r\n\r\n")[2] if http else block
    _hold("block", field.get("warc-block-digest"), block)
    if payload is not None and "warc-truncated" not in field:
        _hold("payload", field.get("warc-payload-digest"), payload)
    if kind == "revisit" and "warc-profile" not in field:
        raise ValueError("revisit without its profile")
    told = field.get("x-payload-length")
    if payload is not None and told is not None and int(told) != len(payload):
        raise ValueError("payload length differs")
    return {"version": version, "record_type": kind, "record_id": _bare(field["warc-record-id"]), "date": field["warc-date"],
            "uri": field.get("warc-target-uri"), "refers_to": _bare(field.get("warc-refers-to")),
            "payload_bytes": len(payload) if payload is not None else int(told) if told is not None else None,
            "payload_digest": digest(payload) if payload is not None else (field.get("warc-payload-digest") or "").partition(":")[2] or None,
            "block": block, "payload": payload, "headers": headers, "field": field}


_NEEDED = ("warc-type", "warc-record-id", "warc-date", "content-length")


def _bare(value: str | None) -> str | None:
    """A record id without its angle brackets."""
    return value[1:-1] if value and value[0] == "<" and value[-1] == ">" else value


def parse(raw: bytes) -> dict:
    """The page of a record that ``record`` made; ValueError for any other and
    where something does not hold."""
    r = read_record(raw)
    field = r["field"]
    for need in ("warc-payload-digest", "x-payload-length"):
        if need not in field:
            raise ValueError(f"record without {need}")
    if r["version"] != "WARC/1.1" or r["record_type"] not in ("response", "revisit"):
        raise ValueError(f"not a record of a page: {r['version']} {r['record_type']}")

    def page(value: str | None) -> int | None:
        if not value or not value.startswith(RECORD):
            raise ValueError(f"bad record id {value!r}")
        value = value[len(RECORD):]
        return None if value == "null" else int(value)

    out = {"page_id": page(r["record_id"]), "payload_bytes": r["payload_bytes"], "payload_digest": r["payload_digest"],
           "record_type": r["record_type"], "refers_to": None, "payload": r["payload"]}
    if r["record_type"] == "revisit":
        if r["block"] or field["warc-profile"] != PROFILE:
            raise ValueError("revisit with a block or of another profile")
        out["refers_to"] = page(r["refers_to"])
    elif "warc-block-digest" not in field:
        raise ValueError("record without warc-block-digest")
    return out


def dictionary_frame(dictionary: bytes) -> bytes:
    return struct.pack("<II", SKIPPABLE, len(dictionary)) + dictionary


class _Stream:
    """Bytes of an archive, read as they are needed."""

    def __init__(self, source):
        self.source = source if hasattr(source, "read") else BytesIO(source)
        self.held, self.at = memoryview(b""), 0

    def have(self, n: int) -> bool:
        while len(self.held) - self.at < n:
            more = self.source.read(READ_BYTES)
            if not more:
                return False
            self.held, self.at = memoryview(bytes(self.held[self.at:]) + more), 0
        return True

    def take(self, n: int, what: str) -> bytes:
        if not self.have(n):
            raise ValueError(f"{what} is cut short")
        self.at += n
        return bytes(self.held[self.at - n:self.at])

    def magic(self) -> int:
        return struct.unpack_from("<I", self.held, self.at)[0] if self.have(4) else 0

    def frame(self, reader) -> bytes:
        """The next Zstandard frame, decoded."""
        one, parts = reader.decompressobj(), []
        while not one.eof:
            if not self.have(1):
                raise ValueError("frame is cut short")
            chunk = self.held[self.at:self.at + 32768]
            parts.append(one.decompress(chunk))
            self.at += len(chunk) - len(one.unused_data)
        return b"".join(parts)


def records(source) -> Iterator[bytes]:
    """Raw records of one archive (bytes, or a file to read), one per frame.  A
    dictionary in the leading skippable frame, itself compressed or not, is
    loaded; archives without one are read as they are; other skippable frames
    are passed over."""
    import zstandard

    stream, reader, leading = _Stream(source), zstandard.ZstdDecompressor(), True
    while stream.have(1):
        magic = stream.magic()
        if magic in SKIPPED:
            stream.take(4, "skippable frame")
            words = stream.take(struct.unpack("<I", stream.take(4, "skippable frame"))[0], "skippable frame")
            if leading and magic == SKIPPABLE and words:
                if words[:4] == struct.pack("<I", FRAME):
                    words = _Stream(words).frame(zstandard.ZstdDecompressor())
                reader = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(words))
        elif magic == FRAME:
            yield stream.frame(reader)
        else:
            raise ValueError("no frame where one must start")
        leading = False


def train_dictionary(pages: DataFrame, rows: int = 200, chars: int = 20_000, size: int = 32_768) -> bytes:
    """Dictionary from at most ``rows`` distinct pages of at most ``chars``
    characters, in hash order; empty where they are too few to train on.  The
    hashes are picked first, so tasks send pages only for those."""
    import zstandard

    fit = pages.where(F.length("html").between(1, chars)).select(F.xxhash64("html").alias("h"), "html")
    picked = fit.select(F.col("h").alias("p")).distinct().orderBy("p").limit(rows)
    some = (fit.join(F.broadcast(picked), F.col("h") == F.col("p")).groupBy("h").agg(F.min("html").alias("html"))
            .orderBy("h").select("html").toPandas()["html"])
    samples = [record("0", "http://example.com/", h.encode("utf-8", "surrogatepass"), "0" * 32, len(h), None) for h in some]
    if len(samples) < 16 or sum(map(len, samples)) < 8 * size:
        return b""
    return zstandard.train_dictionary(size, samples).as_bytes()


def write_archives(pages: DataFrame, folder: str, archive_bytes: int = 16 << 20, level: int = 3) -> DataFrame:
    """Write a record per row of ``pages`` (page_id, url, html) under
    ``folder``; returns the manifest (path, records), a written table.

    ``folder`` is on storage that all executors share.  An archive is closed
    once it has ``archive_bytes``, so it holds at most that and one record.
    """
    words = pages.sparkSession.sparkContext.broadcast(train_dictionary(pages))
    src = pages.select("page_id", "url", "html", F.sha1(F.coalesce("html", F.lit(""))).alias("sha"))
    first = io.stage(src.groupBy("sha").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")), "warc-first")
    typed = join_counted(src, first, ["sha"], "n").select(
        "page_id", "url", F.when(F.col("page_id").eqNullSafe(F.col("first")), F.lit(None)).otherwise(
            F.col("first")).alias("refers"), (~F.col("page_id").eqNullSafe(F.col("first"))).alias("again"), "html")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import zstandard
        from pyarrow import fs
        from pyspark import TaskContext

        task = TaskContext.get()
        given = {"dict_data": zstandard.ZstdCompressionDict(words.value)} if words.value else {}
        press = zstandard.ZstdCompressor(level=level, write_checksum=True, **given)
        store, base = fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")
        store.create_dir(base, recursive=True)
        done, size, frames = 0, 0, []

        def close() -> pd.DataFrame:
            name = f"part-{task.partitionId():05d}-{task.taskAttemptId()}-{done:05d}.warc.zst"
            with store.open_output_stream(f"{base}/{name}", compression=None) as out:
                out.write(dictionary_frame(words.value))
                for f in frames:
                    out.write(f)
            return pd.DataFrame({"path": [f"{folder}/{name}"], "records": [len(frames)]})

        for pdf in batches:
            for page, url, refers, again, html in zip(pdf["page"], pdf["url"], pdf["refers"], pdf["again"], pdf["html"]):
                payload = (html or "").encode("utf-8", "surrogatepass")
                raw = record(page, url, None if again else payload, digest(payload), len(payload), refers)
                frames.append(press.compress(raw))
                size += len(frames[-1])
                if size >= archive_bytes:
                    yield close()
                    done, size, frames = done + 1, 0, []
        if frames:
            yield close()

    text = typed.select(F.coalesce(F.col("page_id").cast("string"), F.lit("null")).alias("page"), "url",
                        F.coalesce(F.col("refers").cast("string"), F.lit("null")).alias("refers"), "again", "html")
    return io.stage(text.mapInPandas(run, "path string, records bigint"), "warc-manifest")


def read_archives(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """Records of the archives of a manifest: page_id, payload_bytes,
    payload_digest, record_type, refers_to (and payload, null for revisits).

    An archive that is damaged, or has another number of records than the
    manifest says, fails the job."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"] + ["payload"] * payloads
        for pdf in batches:
            for path, n in zip(pdf["path"], pdf["records"]):
                store, base = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
                rows, seen = [], 0
                with store.open_input_stream(base, compression=None) as f:
                    for one in records(f):
                        rows.append(parse(one))
                        seen += 1
                        if len(rows) >= 2000 or payloads and len(rows) >= 100:
                            yield _frame(rows, names)
                            rows = []
                if rows:
                    yield _frame(rows, names)
                if seen != n:
                    raise ValueError(f"{path}: {seen} records, manifest says {n}")

    schema = ("page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint"
              + ", payload binary" * payloads)
    return manifest.repartition(partitions(manifest), "path").mapInPandas(run, schema)


def read_warc(archives: DataFrame, payloads: bool = False) -> DataFrame:
    """Records of Zstandard WARC archives from anywhere (``archives``: path):
    path, record (its number from 0), version, record_type, record_id, date,
    uri, refers_to, payload_bytes, payload_digest (bare upper-case base32
    SHA-1; of a revisit as its header has it), headers, and payload.

    An archive that is damaged fails the job.  Paths are on storage that all
    executors share; a null path has no records."""
    names = ["version", "record_type", "record_id", "date", "uri", "refers_to", "payload_bytes", "payload_digest"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyarrow import fs

        def frame(path: str, first: int, rows: list[dict]) -> pd.DataFrame:
            out = pd.DataFrame([[r[n] for n in names] for r in rows], columns=names)
            out["payload_bytes"] = out["payload_bytes"].astype("Int64")
            out.insert(0, "record", range(first, first + len(rows)))
            out.insert(0, "path", path)
            out["headers"] = [[{"name": n, "value": v} for n, v in r["headers"]] for r in rows]
            if payloads:
                out["payload"] = [r["payload"] for r in rows]
            return out

        for pdf in batches:
            for path in pdf["path"]:
                store, base = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
                with store.open_input_stream(base, compression=None) as f:
                    rows, first, size = [], 0, 0
                    for raw in records(f):
                        rows.append(read_record(raw))
                        size += len(raw)
                        if size > 16 << 20 or len(rows) == 2000:
                            yield frame(path, first, rows)
                            rows, first, size = [], first + len(rows), 0
                    if rows:
                        yield frame(path, first, rows)

    schema = ("path string, record bigint, version string, record_type string, record_id string, date string, uri string, "
              "refers_to string, payload_bytes bigint, payload_digest string, headers array<struct<name: string, value: string>>"
              + ", payload binary" * payloads)
    named = archives.select("path").where("path is not null")
    return named.repartition(partitions(named), "path").mapInPandas(run, schema)


def _frame(rows: list[dict], names: list[str]) -> pd.DataFrame:
    out = pd.DataFrame(rows, columns=names)
    for c in ("page_id", "payload_bytes", "refers_to"):
        out[c] = out[c].astype("Int64")
    return out


def archive_round_trip(pages: DataFrame) -> DataFrame:
    """Write all pages to archives in the shared folder and read them back.

    Null html is an empty payload; empty payloads count as equal payloads like
    any other.  Rows that share both page_id and payload are one page and get
    the same type.  Null page_ids are revisits unless all of their payload are
    null.  An empty table writes no archive and gives an empty result; other
    columns are not read."""
    folder = f"{io.staging_dir(pages.sparkSession)}/qsig-warc/{uuid.uuid4().hex}"
    return read_archives(write_archives(pages, folder))
