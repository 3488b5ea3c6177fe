"""Web archives in ZIP packages: writing WARC records, and reading them by range.

A package holds stored (not compressed) members: archive/pages.warc.gz, whose
records are gzip members of their own, indexes/index.cdxj, one line for each record
(key, timestamp, JSON with offset and length), and datapackage.json. The reader
parses the central directory, in its ZIP64 form where a package has it, finds stored
archives (*.warc, *.warc.gz in any folder) and indexes (*.cdxj, *.cdx.gz; plain,
gzipped or compressed in the ZIP), and reads each record by its range; nothing is
extracted, and what no index names, of an archive or between the ranges that one tells,
is scanned record by record. A record that several indexes tell comes once; entries of
archives that the package doesn't hold are passed over. So packages of other writers
are read too.

Files are opened where the path says (file:, hdfs:, s3: ...) by pyarrow's file
systems, in the shared folder. A task writes under a name of its own attempt, and
only packages of tasks that ended well are in the manifest, so lost executors and
second attempts leave no wrong records.

Edge cases: a null html is an empty payload; a null URL has no target header;
control characters in URLs are percent-encoded, ids wholly; a null page_id has a
name of its own, apart from an empty one; of repeated rows with the smallest page_id
each is a response; empty tables make no package and read back as no rows; other
columns are not read. Of other writers' records, page_id and refers_to are null.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wayfold.llm.common import mapped, materialize, partitions

#: Payloads from this size on are recorded once.
LEAST_SHARED = 100
#: Bytes of records that a package holds, about.
PACKAGE_BYTES = 16_000_000
#: Fixed values of the formats.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"
STAMP = "19700101000000"
ID, NO_ID = "urn:wayfold:page:", "urn:wayfold:no-page"
DATA, INDEX, ABOUT = "archive/pages.warc.gz", "indexes/index.cdxj", "datapackage.json"


def urn(page_id: str | None) -> str:
    from urllib.parse import quote

    return NO_ID if page_id is None else ID + quote(page_id, safe="")


def id_of(text: str | None) -> str | None:
    """The page_id of a record's name; null if it is none of ours."""
    from urllib.parse import unquote

    text = (text or "").strip("<>")
    return unquote(text[len(ID) :]) if text.startswith(ID) else None


def record(page_id: str | None, url: str | None, payload: bytes, size: int, digest: str, refers_to: str | None) -> bytes:
    """A WARC record: a response, or a revisit of another page's record without payload."""
    revisit = refers_to is not None
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % size
    block = http if revisit else http + payload
    lines = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <{urn(page_id)}>", f"WARC-Date: {DATE}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    lines.append(f"WARC-Payload-Digest: sha256:{digest}")
    if revisit:
        lines += [f"WARC-Refers-To: <{urn(refers_to)}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """A record's headers, its HTTP headers (names in lower case), and its payload."""
    head, _, rest = data.partition(b"\r\n\r\n")

    def fields(lines):
        return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}

    warc = fields(head.decode(errors="replace").split("\r\n")[1:])
    block = rest[: int(warc["content-length"])]
    if not warc.get("content-type", "").startswith("application/http"):
        return warc, {}, block
    http, _, payload = block.partition(b"\r\n\r\n")
    return warc, fields(http.decode(errors="replace").split("\r\n")[1:]), payload


def central_directory(read, size: int) -> dict[str, dict]:
    """The members of a ZIP file by name: method, compressed and full size, header offset.

    read(offset, length) gives bytes. Sizes and offsets that don't fit 32 bits are
    taken from the ZIP64 records.
    """
    import struct

    tail_at = max(0, size - 65_557)
    tail = read(tail_at, size - tail_at)
    end = tail.rfind(b"PK\x05\x06")
    if end < 0:
        raise ValueError("no end of central directory: not a ZIP file")
    count, length, offset = struct.unpack_from("<HII", tail, end + 10)
    if end >= 20 and tail[end - 20 : end - 16] == b"PK\x06\x07":
        (at,) = struct.unpack_from("<Q", tail, end - 12)
        far = read(at, 56)
        if far[:4] != b"PK\x06\x06":
            raise ValueError("the ZIP64 locator leads nowhere")
        count, length, offset = struct.unpack_from("<QQQ", far, 32)
    data, at, members = read(offset, length), 0, {}
    for _ in range(count):
        if data[at : at + 4] != b"PK\x01\x02":
            raise ValueError("the central directory is broken")
        flags, method = struct.unpack_from("<HH", data, at + 8)
        packed, full, n, extra, comment = struct.unpack_from("<IIHHH", data, at + 20)
        (header,) = struct.unpack_from("<I", data, at + 42)
        name = data[at + 46 : at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        x, stop = at + 46 + n, at + 46 + n + extra
        while x + 4 <= stop:
            tag, m = struct.unpack_from("<HH", data, x)
            if tag == 1:  # ZIP64: only what is at its limit, in this order
                values, k = struct.unpack_from(f"<{m // 8}Q", data, x + 4), 0
                if full == 0xFFFFFFFF:
                    full, k = values[k], k + 1
                if packed == 0xFFFFFFFF:
                    packed, k = values[k], k + 1
                if header == 0xFFFFFFFF:
                    header = values[k]
            x += 4 + m
        members[name] = {"method": method, "packed": packed, "size": full, "header": header}
        at = stop + comment
    return members


def data_offset(read, member: dict) -> int:
    """Where a stored member's bytes begin."""
    import struct

    if member["method"] != 0:
        raise ValueError("only stored members can be read by range")
    head = read(member["header"], 30)
    name, extra = struct.unpack_from("<HH", head, 26)
    return member["header"] + 30 + name + extra


def index_key(url: str | None) -> str:
    """The sort key of a URL: its host backwards with commas, then path and query; without blanks."""
    host, _, rest = (url or "").partition("://")[2].partition("/")
    key = ",".join(reversed(host.lower().split("."))) + ")/" + rest.lower()
    return "".join(c if c > " " and c != "{" else f"%{ord(c):02X}" for c in key)


def index_entries(text: bytes) -> list[dict]:
    """The JSON of CDXJ lines: `key timestamp {...}`, or bare; header lines (!) and blank ones have none."""
    import json

    lines = (line.partition(b"{") for line in text.splitlines() if not line.startswith(b"!"))
    return [json.loads(brace + rest) for _, brace, rest in lines if brace]


def records_of(read, start: int, size: int):
    """All records of an archive that no index names, one after the other: gzip members, or plain."""
    import re
    import zlib

    at, end, plain, inflate, held = start, start + size, b"", None, b""
    packed = read(start, 2) == b"\x1f\x8b"
    while at < end or held or plain:
        if packed:
            if not held and at < end:
                held = read(at, min(1 << 20, end - at))
                at += len(held)
            inflate = inflate or zlib.decompressobj(31)
            plain += inflate.decompress(held)
            held = inflate.unused_data if inflate.eof else b""
            if inflate.eof:
                inflate = None
        elif at < end:
            plain += read(at, min(1 << 20, end - at))
            at = min(end, at + (1 << 20))
        while (head := plain.find(b"\r\n\r\n")) >= 0 and (told := re.search(rb"(?i)\r\ncontent-length:\s*(\d+)", plain[:head])):
            stop = head + 4 + int(told[1])
            if len(plain) < stop:
                break
            yield plain[:stop]
            plain = plain[stop:].lstrip(b"\r\n")
        if at >= end and not held:
            return


def member_bytes(read, member: dict) -> bytes:
    """A member's content, whole: stored or compressed, gzipped or not. For indexes."""
    import gzip
    import zlib

    if member["method"] not in (0, 8):
        raise ValueError(f"compression method {member['method']} of an index")
    data = read(data_offset(read, member | {"method": 0}), member["packed"])
    data = zlib.decompress(data, -15) if member["method"] == 8 else data
    return gzip.decompress(data) if data[:2] == b"\x1f\x8b" else data


def write_packages(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Writes the packages and returns their manifest: (path string, records long).

    Of records with equal payloads of LEAST_SHARED bytes or more, that with the
    smallest id has the payload; the others refer to it.
    """
    payload = F.coalesce(F.col(html_col), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("size", F.length("payload"))
    # counted first, so that a payload shared by many rows is one row
    firsts = rows.where(F.col("size") >= LEAST_SHARED).groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where("n > 1").select("digest", "first")
    rows = rows.join(firsts, "digest", "left").withColumn("refers_to", F.when(~F.col("id").eqNullSafe(F.col("first")), F.col("first")))
    revisit = F.col("refers_to").isNotNull()
    rows = rows.select(F.col("id").cast("string"), "url", F.when(~revisit, F.col("payload")).alias("payload"), "size", "digest", F.col("refers_to").cast("string"))

    def write(batches):
        import hashlib
        import io
        import json
        import uuid
        import zipfile
        import zlib

        from pyarrow import fs
        from pyspark import TaskContext

        store, root = fs.FileSystem.from_uri(folder)
        store.create_dir(root, recursive=True)
        task = TaskContext.get()
        data, lines = io.BytesIO(), []

        def flush():
            name = f"{root}/{task.partitionId():06d}-{task.attemptNumber()}-{uuid.uuid4().hex}.wacz"
            out = io.BytesIO()
            with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as package:
                package.writestr(DATA, data.getbuffer())
                package.writestr(INDEX, "".join(sorted(lines)))
                told = [{"name": n.rsplit("/", 1)[-1], "path": n, "hash": "sha256:" + hashlib.sha256(d).hexdigest(), "bytes": len(d)} for n, d in ((DATA, data.getbuffer()), (INDEX, "".join(sorted(lines)).encode()))]
                package.writestr(ABOUT, json.dumps({"profile": "data-package", "wacz_version": "1.1.1", "resources": told}))
            with store.open_output_stream(name) as f:
                f.write(out.getbuffer())
            batch = pa.RecordBatch.from_arrays([pa.array([name]), pa.array([len(lines)], pa.int64())], names=["path", "records"])
            data.seek(0)
            data.truncate()
            lines.clear()
            return batch

        for batch in batches:
            for i in range(batch.num_rows):
                page, url, content, size, digest, refers_to = (c[i].as_py() for c in batch.columns)
                gz = zlib.compressobj(6, zlib.DEFLATED, 31)
                packed = gz.compress(record(page, url, content or b"", size, digest, refers_to)) + gz.flush()
                told = {"url": url, "digest": f"sha256:{digest}", "offset": data.tell(), "length": len(packed), "filename": DATA.rsplit("/", 1)[-1]}
                lines.append(f"{index_key(url)} {STAMP} {json.dumps(told)}\n")
                data.write(packed)
                if data.tell() >= PACKAGE_BYTES:
                    yield flush()
        if lines:
            yield flush()

    return materialize(mapped(rows, write, "path string, records long"), "manifest")


def read_packages(manifest: DataFrame, folder: str, id_type: str = "long") -> DataFrame:
    """(page_id, url, record_type, refers_to, payload_bytes, payload_digest, payload) of all records.

    manifest needs a column path, first. payload is null for revisits; their size and
    digest are those of the payload they stand for, where the record tells them. A
    response whose payload doesn't match its SHA-256 digest is an error. Records of
    other types (warcinfo, request, metadata) are passed over.
    """

    def read_all(batches):
        import hashlib
        import zlib

        from pyarrow import fs

        store, _ = fs.FileSystem.from_uri(folder)
        kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
        names = ["page_id", "url", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload"]

        def records(read, size):
            members = central_directory(read, size)
            archives = {n: m for n, m in members.items() if n.endswith((".warc", ".warc.gz")) and m["method"] == 0}
            by_name = {n.rsplit("/", 1)[-1]: n for n in archives} | {n: n for n in archives}
            starts, told = {n: data_offset(read, m) for n, m in archives.items()}, {n: {} for n in archives}
            for name in sorted(n for n in members if n.endswith((".cdxj", ".cdx.gz", ".cdxj.gz"))):
                for entry in index_entries(member_bytes(read, members[name])):
                    archive, offset, length = by_name.get(entry["filename"]), int(entry["offset"]), int(entry["length"])
                    if archive is None or offset in told[archive]:  # of another package, or told by another index
                        continue
                    told[archive][offset] = length
                    data = read(starts[archive] + offset, length)
                    yield zlib.decompress(data, 31) if data[:2] == b"\x1f\x8b" else data
            for name, spans in sorted(told.items()):  # what no index tells lies between
                at = 0
                for offset, length in [*sorted(spans.items()), (archives[name]["size"], 0)]:
                    if offset > at:
                        yield from records_of(read, starts[name] + at, offset - at)
                    at = max(at, offset + length)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                with store.open_input_file(path) as f:

                    def read(offset, length):
                        f.seek(offset)
                        return f.read(length)

                    rows, held = [], 0
                    for data in records(read, f.size()):
                        warc, http, payload = parse_record(data)
                        kind = warc["warc-type"]
                        if kind not in ("response", "revisit", "resource"):
                            continue
                        revisit, told = kind == "revisit", warc.get("warc-payload-digest", "")
                        digest = told.removeprefix("sha256:") if told.startswith("sha256:") else None
                        if not revisit:
                            own = hashlib.sha256(payload).hexdigest()
                            if digest is not None and len(digest) == 64 and own != digest:
                                raise ValueError(f"{path}: the payload of {warc['warc-record-id']} doesn't match its digest")
                            digest = own
                        size = int(http["content-length"]) if "content-length" in http and (revisit or http.get("content-encoding") is None) else len(payload)
                        rows.append((id_of(warc["warc-record-id"]), warc.get("warc-target-uri"), kind, id_of(warc.get("warc-refers-to")) if revisit else None, size, digest, None if revisit else payload))
                        held += len(payload) + 500
                        if held > 4_000_000:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)
                            rows, held = [], 0
                    if rows:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), kinds)], names=names)

    spread = manifest.repartition(partitions(manifest.sparkSession))
    out = mapped(spread, read_all, "page_id string, url string, record_type string, refers_to string, payload_bytes long, payload_digest string, payload binary")
    return out.withColumn("page_id", F.col("page_id").cast(id_type)).withColumn("refers_to", F.col("refers_to").cast(id_type))


RECORDS_SQL = """
WITH told AS (
  SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM told)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM firsts
"""
