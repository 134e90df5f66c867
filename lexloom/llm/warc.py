"""WARC archives: writing, reading, and revisit resolution.

Resolution never moves payloads between machines.  The headers of all records
are shuffled by payload digest to find the first response of each payload, the
decisions go back to the archive they belong to, and each archive is rewritten
where it lies, in its own order: later copies become revisit records that name the
response they repeat.  Type, length, block digest and references of a record are written
afresh; its id, date, HTTP head and all other fields stay.  Archives of others are
read as well: versions 1.0 and 1.1, compressed record by record; records that are
neither response nor revisit pass through as they are.

Defined results: a null payload is empty; records with equal payloads of at least
``min_payload`` bytes have one response, that with the smallest row id (null ids
come last, ties go by date and place); shorter ones all stay responses; a revisit record
whose payload no response holds keeps what it referred to; an empty table gives
no archive; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexloom.llm.storage import new_folder, open_file, write_file
from lexloom.session import shuffle_width
from lexloom.sources.scratch import materialize

ARCHIVE_BYTES = 16 << 20  # of compressed records, after which a new archive is begun
LEVEL = 4
READ_BYTES = 1 << 20
DATE = "1970-01-01T00:00:00Z"  # of records without one

# Fixed values of the format.
VERSION, VERSIONS = b"WARC/1.1", (b"WARC/1.0", b"WARC/1.1")
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record_id(row_id: int | None, digest: str, url: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{row_id}|{digest}|{url}')}>"


def _head(fields: dict[str, str | int | None]) -> bytes:
    lines = [f"{k}: {v}" for k, v in fields.items() if v is not None]
    return VERSION + b"\r\n" + "\r\n".join(lines).encode("utf-8") + b"\r\n\r\n"


def _packed(fields: dict[str, str | int | None], block: bytes) -> bytes:
    """A compressed record; its block's digest and length come last."""
    fields = {k: v for k, v in fields.items() if k not in ("WARC-Block-Digest", "Content-Length")}
    fields |= {"WARC-Block-Digest": f"sha1:{payload_digest(block)}", "Content-Length": len(block)}
    pack = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return pack.compress(_head(fields) + block + b"\r\n\r\n") + pack.flush()


def record(row_id: int | None, url: str | None, digest: str, payload: bytes, date: str | None = None) -> bytes:
    """One compressed response record."""
    target = quote(url, safe="%/:?#[]@!$&'()*+,;=~-._") if url else f"urn:row:{row_id}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = {
        "WARC-Type": "response",
        "WARC-Record-ID": record_id(row_id, digest, target),
        "WARC-Date": date or DATE,
        "WARC-Target-URI": target,
        "WARC-Payload-Digest": f"sha1:{digest}",
        "X-Row-Id": row_id,
        "Content-Type": "application/http; msgtype=response",
    }
    return _packed(fields, http + payload)


_REFERENCES = ("WARC-Profile", "WARC-Refers-To", "WARC-Refers-To-Target-URI", "WARC-Refers-To-Date", "X-Refers-To-Row-Id", "WARC-Truncated")


def revisit(fields: dict[str, str], http: bytes, first: dict[str, str | int | None], digest: str) -> bytes:
    """A stored record as a revisit of the response that ``first`` describes: its HTTP head without the payload."""
    kept = {k: v for k, v in fields.items() if k not in _REFERENCES}
    kept |= {"WARC-Type": "revisit", "WARC-Payload-Digest": f"sha1:{digest}", "WARC-Profile": SAME_PAYLOAD, **first}
    return _packed(kept, http)


def members(path: str) -> Iterator[tuple[int, bytes]]:
    """(place in the archive, content) of each compressed record, read a stretch at a time."""
    with open_file(path) as file:
        start = at = 0
        unpack, parts = zlib.decompressobj(31), []
        while stretch := file.read(READ_BYTES):
            while stretch:
                parts.append(unpack.decompress(stretch))
                at += len(stretch) - len(unpack.unused_data)
                stretch = unpack.unused_data
                if not unpack.eof:
                    break
                yield start, b"".join(parts)
                start, unpack, parts = at, zlib.decompressobj(31), []
        if parts or start != at:
            raise ValueError(f"{path} ends within a record")


#: Names of fields as they are written here, whatever their case elsewhere.
_NAMES = {n.lower(): n for n in ("WARC-Type", "WARC-Record-ID", "WARC-Date", "WARC-Target-URI", "WARC-Payload-Digest", "WARC-Block-Digest", "X-Row-Id", "Content-Type", "Content-Length", *_REFERENCES)}


def _fields(lines: list[str]) -> dict[str, str]:
    found, last = {}, None
    for line in lines:
        if line[:1] in (" ", "\t") and last:  # a field goes on in the next line
            found[last] += " " + line.strip()
        elif ":" in line:
            name, value = line.split(":", 1)
            last = _NAMES.get(name.strip().lower(), name.strip())
            found[last] = value.strip()
    return found


def parse(content: bytes) -> tuple[dict[str, str], bytes, int | None, bytes]:
    """Header fields, the HTTP head, the length of the full payload (None: not known), and the payload that the record holds.

    A record that is no HTTP response has no head, and its block is its payload.
    """
    head, _, rest = content.partition(b"\r\n\r\n")
    lines = head.decode("utf-8", "replace").split("\r\n")
    if lines[0].strip().encode() not in VERSIONS:
        raise ValueError(f"not a record of a known version: {lines[0]!r}")
    fields = _fields(lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if fields.get("WARC-Type") not in ("response", "revisit") or not block.startswith(b"HTTP/"):
        return fields, b"", len(block), block
    http, gap, payload = block.partition(b"\r\n\r\n")
    size: int | None = len(payload)
    if fields["WARC-Type"] == "revisit":
        said = {k.lower(): v for k, v in _fields(http.decode("utf-8", "replace").split("\r\n")[1:]).items()}
        size = int(said["content-length"]) if said.get("content-length", "").isdigit() else None
    return fields, http + gap, size, payload


def _digest(fields: dict[str, str], payload: bytes) -> str | None:
    """The payload's digest: of what a response holds, else as the record says it."""
    said = fields.get("WARC-Payload-Digest", "")
    if fields["WARC-Type"] == "response":
        own = payload_digest(payload)
        if said.lower().startswith("sha1:") and said[5:].upper() != own:
            raise ValueError(f"the payload of {fields.get('WARC-Record-ID')} does not match its digest")
        return own
    return said[5:].upper() if said.lower().startswith("sha1:") else None


def _number(text: str | None) -> int | None:
    return None if text is None else int(text)


class _Archives:
    """Archives of one task, a new one begun whenever one is full."""

    def __init__(self, folder: str, stem: str):
        self.folder, self.stem, self.parts, self.size, self.records = folder, stem, [], 0, 0

    def add(self, packed: bytes) -> Iterator[tuple[str, int, int]]:
        self.parts.append(packed)
        self.size += len(packed)
        self.records += 1
        if self.size >= ARCHIVE_BYTES:
            yield from self.flush()

    def flush(self) -> Iterator[tuple[str, int, int]]:
        if self.parts:
            yield write_file(self.folder, self.stem, ".warc.gz", b"".join(self.parts)), self.records, self.size
            self.parts, self.size, self.records = [], 0, 0


_MANIFEST = "file string, records long, bytes long"


def write_archives(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", payload_column: str = "html", folder: str | None = None,
    date_column: str | None = None,
) -> DataFrame:
    """Write every row as a response record; returns the stored manifest of archives.  Dates are timestamps of the session's zone."""
    folder = folder or new_folder(pages.sparkSession, "warc")
    date = F.lit(None).cast("string") if date_column is None else F.date_format(F.to_utc_timestamp(date_column, F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    rows = pages.select(F.col(id_column).cast("long"), F.col(url_column), F.coalesce(F.col(payload_column).cast("binary"), F.lit(b"")), date)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        archives = _Archives(folder, f"raw-{TaskContext.get().partitionId():06d}")
        done = []
        for batch in batches:
            for key, url, payload, day in zip(*(c.to_pylist() for c in batch.columns)):
                done += archives.add(record(key, url, payload_digest(payload), payload, day))
        done += archives.flush()
        yield pa.RecordBatch.from_arrays([pa.array([d[k] for d in done], t) for k, t in ((0, pa.string()), (1, pa.int64()), (2, pa.int64()))], ["file", "records", "bytes"])

    return materialize(rows.mapInArrow(write, _MANIFEST), "warc-manifest")


def _spread(manifest: DataFrame) -> DataFrame:
    return manifest.select("file").repartition(shuffle_width(manifest.sparkSession))


_RECORD = "file string, place long, row_id long, url string, record_type string, record_id string, date string, digest string, payload_bytes long, refers_to long, refers_to_record string"


def read_archives(manifest: DataFrame, payloads: bool = False) -> DataFrame:
    """A row for each record; its payload (null for a revisit) only on request.  Digests of held payloads are verified."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows = []
                for place, content in members(path):
                    fields, _, size, payload = parse(content)
                    kind = fields["WARC-Type"]
                    row = [path, place, _number(fields.get("X-Row-Id")), fields.get("WARC-Target-URI"), kind, fields.get("WARC-Record-ID"), fields.get("WARC-Date"), _digest(fields, payload), size, _number(fields.get("X-Refers-To-Row-Id")), fields.get("WARC-Refers-To")]
                    rows.append(row + [None if kind == "revisit" else payload] if payloads else row)
                    if len(rows) >= 2000:
                        yield _table(rows, payloads)
                        rows = []
                if rows:
                    yield _table(rows, payloads)

    return _spread(manifest).mapInArrow(read, _RECORD + (", payload binary" if payloads else ""))


def _table(rows: list[list], payloads: bool) -> pa.RecordBatch:
    names = [f.split()[0] for f in _RECORD.split(", ")] + ["payload"] * payloads
    kinds = {"long": pa.int64(), "string": pa.string()}
    types = [kinds[f.split()[1]] for f in _RECORD.split(", ")] + [pa.binary()] * payloads
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)


def resolve_revisits(manifest: DataFrame, min_payload: int = 0, folder: str | None = None) -> DataFrame:
    """Rewrite archives so that each payload is held once; returns the stored manifest of the new archives."""
    folder = folder or new_folder(manifest.sparkSession, "warc")
    heads = materialize(read_archives(manifest), "warc-headers")
    order = F.struct(F.col("row_id").isNull().alias("none"), "row_id", "date", "file", "place")
    held = heads.filter((F.col("record_type") == "response") & (F.col("payload_bytes") >= min_payload))
    # The first response of each payload; minima are taken before the shuffle, so a digest of very many pages is one row per task.
    first = held.groupBy("digest").agg(F.min(F.struct(order.alias("order"), "record_id", "url")).alias("first"))
    decided = heads.join(first, "digest", "left").select(
        "file", "place", "record_type", "digest", "payload_bytes", F.col("first.order.row_id").alias("first_row"),
        F.col("first.record_id").alias("first_record"), F.col("first.url").alias("first_url"), F.col("first.order.date").alias("first_date"),
        (F.col("first.order.file").eqNullSafe(F.col("file")) & F.col("first.order.place").eqNullSafe(F.col("place"))).alias("is_first"),
    )

    def rewrite(rows: pd.DataFrame) -> pd.DataFrame:
        """All records of one archive, a record at a time."""
        path = rows["file"].iloc[0]
        known = {r.place: r for r in rows.itertuples()}
        archives, done = _Archives(folder, "deduplicated"), []
        for place, content in members(path):
            r, (fields, http, _, payload) = known[place], parse(content)
            if r.record_type in ("response", "revisit") and r.first_record is not None and not r.is_first:
                names = ("WARC-Refers-To", "WARC-Refers-To-Target-URI", "WARC-Refers-To-Date")
                of = dict(zip(names, (r.first_record, r.first_url, r.first_date)))
                of["X-Refers-To-Row-Id"] = None if pd.isna(r.first_row) else int(r.first_row)
                done += archives.add(revisit(fields, http, of, r.digest))
            else:  # a response that stays, a revisit of what is not here, or a record of another type
                done += archives.add(_packed(fields, http + payload))
        done += archives.flush()
        return pd.DataFrame(done, columns=["file", "records", "bytes"])

    return materialize(decided.groupBy("file").applyInPandas(rewrite, _MANIFEST), "warc-manifest")
