"""WARC archives: written as one gzip stream per file, then normalised to one gzip member per record with an offset index.

``write`` packs pages into archives whose whole content is a single gzip stream, as some crawlers leave them. ``normalise``
inflates each such stream once, front to back, and writes every record as a member of its own, beside a sidecar that lists
offset, length, record type and page id, one record per line. While it rewrites, records whose payload an earlier record has
become ``revisit`` records: they keep the payload's digest and length and name the record they refer to.

A null payload is empty. Payloads below ``least`` bytes are never revisits. Of records with equal payloads the one with the
smallest id is the response (null ids last, then the place in the archives). Line breaks in a url are percent-encoded; a null
url leaves the header out. Archive names are never used twice, and only those in a written index count. No pages: no archives.
"""

from __future__ import annotations

import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from bibweave.llm.shared import new_name, open_fs
from bibweave.session import cut_lineage, run_dir, spread

#: Payload bytes after which an archive is closed; a longer record makes a longer archive.
ARCHIVE_BYTES = 32_000_000
#: Fixed values of the WARC standard.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_RECORDS = "file string, seq int, page_id long, digest binary, payload_bytes long"


def record_id(archive: str, seq: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{archive}#{seq}')}>"


def response(archive: str, seq: int, page_id: int | None, url: str | None, payload: bytes, date: str) -> bytes:
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    head = [
        "WARC/1.1", "WARC-Type: response", f"WARC-Record-ID: {record_id(archive, seq)}", f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{hashlib.sha256(payload).hexdigest()}", "Content-Type: application/http; msgtype=response",
    ]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page_id is not None:
        head.append(f"X-Page-Id: {page_id}")
    head.append(f"Content-Length: {len(http) + len(payload)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + http + payload + b"\r\n\r\n"


def parse_head(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("a record does not begin with its version line")
    return {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def records(chunks: Iterator[bytes]) -> Iterator[tuple[bytes, bytes]]:
    """(head, block) of each record of an inflated archive, holding one record at a time."""
    held = bytearray()

    def fill(n: int) -> bool:
        while len(held) < n:
            more = next(chunks, None)
            if more is None:
                return False
            held.extend(more)
        return True

    while fill(1):
        seen = 0
        while (cut := held.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(held)
            if not fill(seen + 1):
                raise ValueError("an archive ends within a record's head")
        head = bytes(held[:cut])
        end = cut + 4 + int(parse_head(head)["content-length"])
        if not fill(end + 4):
            raise ValueError("an archive ends within a record")
        yield head, bytes(held[cut + 4 : end])
        del held[: end + 4]


def inflated(stream, size: int = 1 << 18) -> Iterator[bytes]:
    """The content of a gzip file of one or more members, in pieces of bounded size."""
    engine, data, within = zlib.decompressobj(31), b"", False
    while data := data or stream.read(size):
        within = True
        if out := engine.decompress(data, 1 << 20):
            yield out
        data = engine.unconsumed_tail
        if engine.eof:
            data, engine, within = engine.unused_data, zlib.decompressobj(31), False
    if rest := engine.flush():
        yield rest
    if within:  # cut off, be it right behind a record
        raise EOFError("the last gzip member has no end")


def _member(record: bytes, level: int) -> bytes:
    engine = zlib.compressobj(level, zlib.DEFLATED, 31)
    return engine.compress(record) + engine.flush()


def write(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", date: str = "2024-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes all pages as response records; a written table with a row per record: file, seq, page_id, digest, payload_bytes."""
    folder = run_dir(pages.sparkSession, "warc")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_fs(folder)
        fs.create_dir(path, recursive=True)
        out, rows, size = None, [], 0

        def closed() -> pa.RecordBatch:
            out.write(engine.flush())
            out.close()
            return pa.RecordBatch.from_pylist(rows, schema=pa.schema([("file", pa.string()), ("seq", pa.int32()), ("page_id", pa.int64()), ("digest", pa.binary()), ("payload_bytes", pa.int64())]))

        for batch in batches:
            for key, target, html in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "html"))):
                if out is None:
                    name = new_name(".warc.gz")
                    out, engine, rows, size = fs.open_output_stream(f"{path}/{name}", compression=None), zlib.compressobj(1, zlib.DEFLATED, 31), [], 0
                data = (html or "").encode()
                out.write(engine.compress(response(name, len(rows), key, target, data, date)))
                rows.append({"file": f"{folder}/{name}", "seq": len(rows), "page_id": key, "digest": hashlib.sha256(data).digest(), "payload_bytes": len(data)})
                size += len(data)
                if size >= archive_bytes:
                    yield closed()
                    out = None
        if out is not None:
            yield closed()

    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), F.col(payload).alias("html"))
    return cut_lineage(rows.mapInArrow(run, _RECORDS), "warc-records")


def revisits(written: DataFrame, least: int = 100) -> DataFrame:
    """Per archive that has any: file, revisits (seq, refers_to, archive and seq of the response)."""
    place = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "file", "seq")
    large = written.where(F.col("payload_bytes") >= least).withColumn("place", place)
    firsts = large.groupBy("digest").agg(F.min("place").alias("first"), F.count("*").alias("n")).where("n > 1").drop("n")
    # an archive's list is bounded by the archive's size
    return (
        large.join(firsts, "digest").where(F.col("place") != F.col("first"))
        .groupBy("file").agg(F.collect_list(F.struct("seq", F.col("first.page_id").alias("refers_to"), F.col("first.file").alias("archive"), F.col("first.seq").alias("at"))).alias("revisits"))
    )


def _as_revisit(head: bytes, block: bytes, refers_to: int | None, archive: str, at: int) -> bytes:
    http = block[: block.index(b"\r\n\r\n") + 4]
    lines = [x for x in head.decode().split("\r\n") if not x.lower().startswith(("warc-type:", "content-length:"))]
    lines += ["WARC-Type: revisit", f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {record_id(archive.rsplit('/', 1)[-1], at)}"]
    if refers_to is not None:
        lines.append(f"X-Refers-To-Page: {refers_to}")
    lines.append(f"Content-Length: {len(http)}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + http + b"\r\n\r\n"


def normalise(files: DataFrame, level: int = 6) -> DataFrame:
    """``files``: file, revisits (may be null). Writes the normalised archives and their sidecars; a table: file, sidecar, n_records."""
    folder = run_dir(files.sparkSession, "warc-members")
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        to, base = open_fs(folder)
        to.create_dir(base, recursive=True)
        for batch in batches:
            for row in batch.to_pylist():
                turned = {r["seq"]: r for r in row["revisits"] or ()}
                fs, path = open_fs(row["file"])
                name, offset, count = new_name(".warc.gz"), 0, 0
                with fs.open_input_stream(path, compression=None) as source, to.open_output_stream(f"{base}/{name}", compression=None) as out, to.open_output_stream(f"{base}/{name}.idx") as index:
                    for seq, (head, block) in enumerate(records(inflated(source))):
                        fields, kind = parse_head(head), "response"
                        record = head + b"\r\n\r\n" + block + b"\r\n\r\n"
                        if r := turned.get(seq):
                            record, kind = _as_revisit(head, block, r["refers_to"], r["archive"], r["at"]), "revisit"
                        member = _member(record, level)
                        out.write(member)
                        index.write(f"{offset} {len(member)} {kind} {fields.get('x-page-id', '-')}\n".encode())
                        offset, count = offset + len(member), count + 1
                yield pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}"], "sidecar": [f"{folder}/{name}.idx"], "n_records": pa.array([count], pa.int64())})

    return cut_lineage(spread(files, "file").mapInArrow(run, "file string, sidecar string, n_records long"), "warc-index")


def read_record(member: bytes) -> dict:
    """The fields of one member; of a response the payload is measured, of a revisit its headers tell."""
    head, block = next(records(iter([zlib.decompress(member, 31)])))
    fields = parse_head(head)
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda x: None if x is None else int(x)
    out = {"page_id": number(fields.get("x-page-id")), "url": fields.get("warc-target-uri"), "record_type": fields["warc-type"], "refers_to": number(fields.get("x-refers-to-page"))}
    digest = fields["warc-payload-digest"].removeprefix("sha256:")
    if out["record_type"] == "revisit":
        size = next(int(x.split(b":")[1]) for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        return out | {"payload": None, "payload_bytes": size, "payload_digest": digest}
    if hashlib.sha256(payload).hexdigest() != digest:
        raise ValueError("a payload does not have the digest its record states")
    return out | {"payload": payload, "payload_bytes": len(payload), "payload_digest": digest}


def read(index: DataFrame) -> DataFrame:
    """Per record: page_id, payload_bytes, payload_digest, record_type, refers_to; members are found through the sidecar."""
    n = int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    types = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for file, sidecar in zip(batch.column("file").to_pylist(), batch.column("sidecar").to_pylist()):
                fs, path = open_fs(file)
                with fs.open_input_stream(open_fs(sidecar)[1]) as stream:
                    places = [line.split() for line in stream.read().decode().splitlines()]
                rows = []
                with fs.open_input_file(path) as archive:
                    for offset, length, _, _ in places:
                        archive.seek(int(offset))
                        got = read_record(archive.read(int(length)))
                        rows.append({k: got[k] for k in names})
                yield pa.RecordBatch.from_pylist(rows, schema=types)

    return index.select("file", "sidecar").repartition(n, "file").mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")


def archived(pages: DataFrame, page_id: str = "page_id", url: str = "url", payload: str = "html", least: int = 100) -> DataFrame:
    """Write, normalise and read back; one row per page."""
    written = write(pages, page_id, url, payload)
    files = written.select("file").distinct().join(revisits(written, least), "file", "left")
    return read(normalise(files))
