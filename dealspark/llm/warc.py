"""WARC archives with a two-level capture index.

Every row becomes one gzip member of a .warc.gz file, ``response`` or, for a
payload of ``MIN_REVISIT`` bytes or more that a smaller id holds too,
``revisit``.  The capture index is sorted by reversed-host URL key and id; its
lines lie in compressed blocks of ``BLOCK_LINES``, and each index file has a
sparse directory with the first key of every block.  A lookup finds the index
file by the files' first keys, binary-searches its directory, reads one block by
range, binary-searches that, and range-reads the record.

Files are written under the shared folder through Arrow's file systems
(``file``, ``hdfs``, ``s3``, ``gs``), under names of their own per attempt; only
files named in the written entry tables count, so a repeated task does no harm.

Edge cases: a null html is an empty payload, a null URL has an empty key; rows
with a null id are written and read back, and are never the smallest id of a
group that has another; repeated rows each have a record, and two rows with the
smallest id are both responses; an empty table gives an empty result.
"""

from __future__ import annotations

import bisect
import hashlib
import re
import uuid
import zlib
from collections import OrderedDict
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dealspark.session import fresh_scratch

from .common import by_bytes, stored

MIN_REVISIT = 100
BLOCK_LINES = 512
DATE = "1970-01-01T00:00:00Z"
ROLL_BYTES = 1 << 30
NO_ID = -(1 << 63)

_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def url_key(url: Column) -> Column:
    """Reversed-host key: ``com,example,www)/path?query``; scheme, port and user are left out."""
    rest = F.regexp_replace(F.coalesce(url, F.lit("")), r"^[^/?#]*://", "")
    authority = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    host = F.lower(F.regexp_replace(F.regexp_replace(authority, r"^.*@", ""), r":[0-9]*$", ""))
    tail = F.regexp_extract(rest, r"(?s)^[^/?#]*(.*)$", 1)
    return F.when(rest == "", "").otherwise(F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"),
                                                     F.regexp_replace(tail, r"[\r\n\t ]", "%20")))


# --- records ----------------------------------------------------------------

def record(kind: str, page_id: int | None, url: str, payload: bytes, digest: str, first: int | None, first_key: str | None) -> bytes:
    """One record, compressed as a gzip member of its own."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload)
    block = http + (payload if kind == "response" else b"")
    head = [("WARC-Type", kind), ("WARC-Record-ID", f"<urn:x-page:{_name(page_id)}>"), ("WARC-Date", DATE),
            ("WARC-Target-URI", re.sub(r"[\r\n]", "%0A", url)), ("WARC-Payload-Digest", f"sha256:{digest}"),
            ("Content-Type", "application/http;msgtype=response"), ("Content-Length", str(len(block)))]
    if kind == "revisit":
        head += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", f"<urn:x-page:{_name(first)}>"), ("X-Refers-To-Key", first_key or "")]
    data = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data.encode("utf-8", "replace") + block + b"\r\n\r\n") + packer.flush()


def _name(page_id: int | None) -> str:
    return "none" if page_id is None else str(page_id)


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of a compressed record."""
    data = zlib.decompress(member, 31)
    head, _, rest = data.partition(b"\r\n\r\n")
    headers = dict(line.split(": ", 1) for line in head.decode("utf-8").split("\r\n")[1:])
    block = rest[:int(headers["Content-Length"])]
    return headers, block.partition(b"\r\n\r\n")[2]


def _page(uri: str) -> int | None:
    name = uri.removeprefix("<urn:x-page:").removesuffix(">")
    return None if name == "none" else int(name)


def _filesystem(root: str):
    from pyarrow import fs
    return fs.FileSystem.from_uri(root)


# --- writing ----------------------------------------------------------------

def roles(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(page_id, url, key, payload, digest, first, first_key); ``first`` is set for revisits."""
    payload = F.encode(F.coalesce(F.col(html), F.lit("")), "UTF-8")
    rows = pages.select(F.col(key).cast("long").alias("page_id"), F.coalesce(url, F.lit("")).alias("url"),
                        url_key(F.col(url)).alias("key"), payload.alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256))
    copies = stored(rows.where(F.octet_length("payload") >= MIN_REVISIT).groupBy("digest")
                    .agg(F.min("page_id").alias("first"), F.min_by("key", "page_id").alias("first_key"), F.count("*").alias("n"))
                    .where("n > 1 and first is not null").drop("n"), "warc-copies")
    other = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    return (rows.join(copies, "digest", "left")
            .withColumns({"first": F.when(other, F.col("first")), "first_key": F.when(other, F.col("first_key"))})
            .select("page_id", "url", "key", "payload", "digest", "first", "first_key"))


def write(rows: DataFrame, root: str) -> DataFrame:
    """Write the archive files of ``rows`` (of ``roles``); entries (key, page_id, file, offset, length)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(root)
        out, path, offset = None, "", 0
        try:
            for batch in by_bytes(batches, "payload"):
                names, files, offsets, lengths = [], [], [], []
                for r in batch.drop_columns(["key"]).to_pylist():
                    if out is None or offset > ROLL_BYTES:
                        if out is not None:
                            out.close()
                        path = f"{base}/warc/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
                        fs.create_dir(f"{base}/warc", recursive=True)
                        out, offset = fs.open_output_stream(path, compression=None), 0
                    kind = "response" if r["first"] is None else "revisit"
                    data = record(kind, r["page_id"], r["url"], r["payload"], r["digest"], r["first"], r["first_key"])
                    out.write(data)
                    files.append(path), offsets.append(offset), lengths.append(len(data))
                    offset += len(data)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("key"), batch.column("page_id"), pa.array(files, pa.string()),
                     pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())],
                    names=["key", "page_id", "file", "offset", "length"])
        finally:
            if out is not None:
                out.close()

    return stored(rows.mapInArrow(run, "key string, page_id long, file string, offset long, length long"), "warc-entries")


def _place(key: str, page_id: int | None) -> tuple[bytes, int]:
    return key.encode("utf-8", "replace"), NO_ID if page_id is None else page_id


def _line(place: tuple[bytes, int], file: str, offset: int, length: int) -> bytes:
    return b"%s\t%d\t%s\t%d\t%d\n" % (place[0], place[1], file.encode(), offset, length)


def _read_line(line: bytes) -> tuple[tuple[bytes, int], bytes, int, int]:
    key, page, file, offset, length = line.split(b"\t")
    return (key, int(page)), file, int(offset), int(length)


def write_index(entries: DataFrame, root: str) -> DataFrame:
    """Write the index files; one row (key, page, path) per file, by its first line."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _filesystem(root)
        out, path, first, offset = None, "", None, 0
        directory: list[bytes] = []
        block: list[bytes] = []
        start = None

        def flush() -> None:
            nonlocal offset
            data = zlib.compress(b"".join(block))
            out.write(data)
            directory.append(b"%s\t%d\t%d\t%d\n" % (start[0], start[1], offset, len(data)))
            offset += len(data)
            block.clear()

        for batch in batches:
            for r in batch.to_pylist():
                place = _place(r["key"], r["page_id"])
                if out is None:
                    path = f"{base}/index/part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}"
                    fs.create_dir(f"{base}/index", recursive=True)
                    out, first = fs.open_output_stream(f"{path}.cdx", compression=None), place
                if not block:
                    start = place
                block.append(_line(place, r["file"], r["offset"], r["length"]))
                if len(block) == BLOCK_LINES:
                    flush()
        if out is not None:
            if block:
                flush()
            out.close()
            with fs.open_output_stream(f"{path}.dir", compression=None) as f:
                f.write(b"".join(directory))
            yield pa.RecordBatch.from_arrays([pa.array([first[0]], pa.binary()), pa.array([first[1]], pa.int64()),
                                              pa.array([path], pa.string())], names=["key", "page", "path"])

    ordered = entries.repartitionByRange("key", "page_id").sortWithinPartitions("key", "page_id", "file", "offset")
    return stored(ordered.mapInArrow(run, "key binary, page long, path string"), "warc-index")


# --- reading ----------------------------------------------------------------

class Index:
    """Lookups by (key, id).  ``parts`` holds one row per index file, in key order."""

    def __init__(self, root: str, parts: list[tuple[tuple[bytes, int], str]]) -> None:
        self.fs, _ = _filesystem(root)
        self.firsts, self.paths = [p[0] for p in parts], [p[1] for p in parts]
        self.directories: OrderedDict = OrderedDict()
        self.blocks: OrderedDict = OrderedDict()
        self.files: OrderedDict = OrderedDict()

    def _kept(self, store: OrderedDict, key, make, most: int):
        if key in store:
            store.move_to_end(key)
        else:
            store[key] = make()
            if len(store) > most:
                store.popitem(last=False)
        return store[key]

    def _range(self, path: str, offset: int, length: int) -> bytes:
        return self._kept(self.files, path, lambda: self.fs.open_input_file(path), 16).read_at(length, offset)

    def _directory(self, path: str) -> tuple[list, list]:
        def load() -> tuple[list, list]:
            with self.fs.open_input_file(f"{path}.dir") as f:
                rows = [x.split(b"\t") for x in f.read().splitlines()]
            return [(k, int(p)) for k, p, _, _ in rows], [(int(a), int(b)) for _, _, a, b in rows]
        return self._kept(self.directories, path, load, 4)

    def _block(self, path: str, at: tuple[int, int]) -> tuple[list, list]:
        def load() -> tuple[list, list]:
            rows = [_read_line(x) for x in zlib.decompress(self._range(f"{path}.cdx", *at)).split(b"\n")[:-1]]
            return [r[0] for r in rows], rows
        return self._kept(self.blocks, (path, at), load, 8)

    def find(self, place: tuple[bytes, int]) -> Iterator[tuple[str, int, int]]:
        """(file, offset, length) of every capture of a key and id."""
        part = bisect.bisect_right(self.firsts, place) - 1
        if part < 0:
            return
        firsts, ranges = self._directory(self.paths[part])
        block = max(0, bisect.bisect_left(firsts, place) - 1)
        while block < len(firsts) and firsts[block] <= place:
            places, rows = self._block(self.paths[part], ranges[block])
            for i in range(bisect.bisect_left(places, place), bisect.bisect_right(places, place)):
                yield rows[i][1].decode(), rows[i][2], rows[i][3]
            block += 1

    def read(self, file: str, offset: int, length: int) -> tuple[dict[str, str], bytes]:
        return parse(self._range(file, offset, length))

    def captures(self, place: tuple[bytes, int]) -> Iterator[tuple[dict[str, str], bytes]]:
        """Headers and full payload of every capture; a revisit's payload is its response's."""
        for at in self.find(place):
            headers, payload = self.read(*at)
            if headers["WARC-Type"] == "revisit":
                first = _place(headers["X-Refers-To-Key"], _page(headers["WARC-Refers-To"]))
                payload = next(p for h, p in map(lambda x: self.read(*x), self.find(first))
                               if h["WARC-Type"] == "response" and h["WARC-Payload-Digest"] == headers["WARC-Payload-Digest"])
            yield headers, payload


def lookup(requests: DataFrame, root: str, parts: DataFrame, with_payload: bool = False) -> DataFrame:
    """Captures of the requested (key, page_id) pairs, each asked once.

    One row per index file reaches the driver and the tasks: as many as the index
    was written in partitions."""
    known = sorted(((bytes(r["key"]), r["page"]), r["path"]) for r in parts.collect())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(root, known)
        for batch in batches:
            out, held = [], 0
            for r in batch.to_pylist():
                for headers, payload in index.captures(_place(r["key"], r["page_id"])):
                    kind = headers["WARC-Type"]
                    out.append((r["page_id"], len(payload), hashlib.sha256(payload).hexdigest(), kind,
                                _page(headers["WARC-Refers-To"]) if kind == "revisit" else None,
                                payload if with_payload else None))
                    held += len(payload) if with_payload else 0
                    if held > 8 << 20:
                        yield _rows(out)
                        out, held = [], 0
            if out:
                yield _rows(out)

    # A stated number: the requests are small, but each stands for a read.
    n = int(requests.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    asked = (requests.select("key", "page_id").distinct().repartitionByRange(n, "key", "page_id")
             .sortWithinPartitions("key", "page_id"))
    found = asked.mapInArrow(run, "page_id long, payload_bytes long, payload_digest string, record_type string, "
                                  "refers_to long, payload binary")
    return found if with_payload else found.drop("payload")


def _rows(out: list[tuple]) -> pa.RecordBatch:
    page, size, digest, kind, first, payload = zip(*out)
    return pa.RecordBatch.from_arrays(
        [pa.array(page, pa.int64()), pa.array(size, pa.int64()), pa.array(digest, pa.string()),
         pa.array(kind, pa.string()), pa.array(first, pa.int64()), pa.array(payload, pa.binary())],
        names=["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"])


def archive(pages: DataFrame, root: str | None = None) -> tuple[str, DataFrame]:
    """Write archives and index of ``pages`` (page_id, url, html); their folder and the index files."""
    root = root or fresh_scratch(pages.sparkSession, "warc")
    return root, write_index(write(roles(pages), root), root)


def round_trip(pages: DataFrame) -> DataFrame:
    """Archive ``pages`` and read every record back through the index."""
    root, parts = archive(pages)
    return lookup(pages.select(url_key(F.col("url")).alias("key"), F.col("page_id").cast("long").alias("page_id")), root, parts)


ORACLE = """
with p as (
    select page_id, sha256(encode(coalesce(html, ''))) as payload_digest, octet_length(encode(coalesce(html, ''))) as payload_bytes
    from pages),
f as (select *, min(page_id) over (partition by payload_digest) as first from p)
select page_id, payload_bytes, payload_digest,
       case when payload_bytes >= 100 and first is not null and page_id is distinct from first then 'revisit' else 'response' end as record_type,
       case when payload_bytes >= 100 and page_id is distinct from first then first end as refers_to
from f
"""
