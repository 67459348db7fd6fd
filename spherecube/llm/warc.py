"""WARC archives with a two-level capture index.

Archives are gzip members, one record each, written by tasks into the shared folder under names of their own; only files
that a finished task reports count. The index has two levels: capture lines sorted by reversed-host URL key in
compressed blocks, and a sparse directory with the first key of each block. A look-up bisects the directory, then the lines of the
blocks it names, and reads the byte range of each capture from its archive.
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spherecube.llm.common import small_side, stored
from spherecube.session import scratch_path

MIN_REVISIT_BYTES = 100
FILE_BYTES = 256 << 20
TASK_BYTES, STRIDE_BYTES = 64 << 20, 1 << 20
BLOCK_LINES = 512
#: the directory never has many more entries than this: blocks grow with the index
DIRECTORY_ENTRIES = 100_000
GZIP_LEVEL = 1


def open_folder(path: str) -> tuple[pa.fs.FileSystem, str]:
    """File system and path for a path as Spark writes it."""
    path = re.sub(r"^s3[an]://", "s3://", path)
    if path.startswith("file:"):
        return pa.fs.LocalFileSystem(), re.sub(r"^file:/+", "/", path)
    if "://" not in path:
        return pa.fs.LocalFileSystem(), path
    return pa.fs.FileSystem.from_uri(path)


def url_key(url: Column) -> Column:
    """Sort key: host labels in reverse, then path and query, lower-cased, without scheme, port, user and fragment."""
    text = F.lower(F.trim(F.coalesce(url.cast("string"), F.lit(""))))
    rest = F.regexp_replace(F.regexp_replace(text, "^[a-z][a-z0-9+.-]*:", ""), "^//", "")
    rest = F.regexp_replace(rest, "#.*$", "")
    host = F.regexp_replace(F.regexp_replace(F.regexp_extract(rest, "^[^/?]*", 0), "^.*@", ""), ":[0-9]*$", "")
    path = F.regexp_replace(rest, "^[^/?]*", "")
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), ","), F.lit(")"), F.when(path == "", "/").otherwise(path))


def record(url: str, payload: bytes, digest: str, page: str, refers_to: str | None) -> bytes:
    """One record: a response with its payload, or a revisit that names the page it repeats."""
    head = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, page + chr(10) + url + chr(10) + digest)}>",
        f"WARC-Target-URI: {' '.join(url.split())}", "WARC-Date: 1970-01-01T00:00:00Z", f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Page: {page}",
    ]
    if refers_to is None:
        head.append("Content-Type: text/html; charset=utf-8")
    else:
        head += ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"X-Refers-To-Page: {refers_to}"]
        payload = b""
    head.append(f"Content-Length: {len(payload)}")
    return "\r\n".join(head).encode() + b"\r\n\r\n" + payload + b"\r\n\r\n"


def parse(data: bytes) -> tuple[dict[str, str], bytes]:
    """Headers and payload of one record; its length decides, so payloads may hold anything."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    size = int(fields["Content-Length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError("a record of another length than it says")
    return fields, rest[:size]


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Write a record for each row below ``folder`` and return the captures, stored: key, page, file, start, size, digest.

    A null page is an empty payload. Of rows with equal payloads of 100 bytes or more that with the smallest id (of
    repeated rows any one id, the record type being the same for all of it) is a response, the others are revisits.
    """
    text = F.coalesce(F.col(html_col).cast("string"), F.lit(""))
    rows = pages.select(F.col(id_col).alias("page_id"), F.coalesce(F.col(url_col).cast("string"), F.lit("")).alias("url"), text.alias("html"))
    rows = rows.withColumn("digest", F.sha2(F.encode("html", "utf-8"), 256)).withColumn("key", url_key(F.col("url")))
    large = F.octet_length("html") >= MIN_REVISIT_BYTES
    first = rows.filter(large).groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).filter("n > 1").select("digest", "first")
    first = stored(first, "first-captures")
    refers = F.when(F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first")), F.col("first").cast("string"))
    rows = rows.join(small_side(first, 200_000), "digest", "left").withColumn("refers_to", refers)
    rows = rows.withColumn("page", F.col("page_id").cast("string")).select("page_id", "page", "url", "html", "digest", "key", "refers_to")
    root = folder.rstrip("/")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(root)
        fs.create_dir(path, recursive=True)
        sink, name, at = None, "", 0
        for batch in batches:
            names, starts, sizes = [], [], []
            for page, url, html, digest, refers_to in zip(*(batch.column(c).to_pylist() for c in ("page", "url", "html", "digest", "refers_to")), strict=True):
                packer = zlib.compressobj(GZIP_LEVEL, zlib.DEFLATED, 31)
                data = record(url, html.encode(), digest, page or "", refers_to)
                member = packer.compress(data) + packer.flush()
                if sink is None or at >= FILE_BYTES:
                    if sink is not None:
                        sink.close()
                    name, at = f"captures-{uuid.uuid4().hex}.warc.gz", 0
                    sink = fs.open_output_stream(f"{path}/{name}", compression=None)
                sink.write(member)
                names.append(name)
                starts.append(at)
                sizes.append(len(member))
                at += len(member)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("page"), batch.column("digest"), pa.array(names, pa.string()), pa.array(starts, pa.int64()), pa.array(sizes, pa.int64())],
                names=["key", "page", "digest", "file", "start", "size"],
            )
        if sink is not None:
            sink.close()

    return stored(rows.mapInArrow(write, "key string, page string, digest string, file string, start bigint, size bigint"), "captures")


def build_index(captures: DataFrame, block_lines: int = BLOCK_LINES, directory_entries: int = DIRECTORY_ENTRIES) -> DataFrame:
    """Blocks of the index, stored: block, first_key, last_key, lines, data (compressed lines in key order).

    Lines are sorted over all partitions, so the blocks in order of their numbers hold all keys in order. Blocks have
    ``block_lines`` lines, or more where the directory would outgrow ``directory_entries``.
    """
    lines = max(block_lines, -(-captures.count() // directory_entries))
    ordered = captures.repartitionByRange("key", "page", "file", "start").sortWithinPartitions("key", "page", "file", "start")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number, waiting = TaskContext.get().partitionId() << 32, []

        def block(rows):
            data = zlib.compress("\n".join(json.dumps(r, ensure_ascii=False) for r in rows).encode(), 6)
            return pa.RecordBatch.from_pydict({"block": [number], "first_key": [rows[0][0]], "last_key": [rows[-1][0]], "lines": [len(rows)], "data": [data]})

        for batch in batches:
            waiting += zip(*(batch.column(c).to_pylist() for c in ("key", "page", "digest", "file", "start", "size")), strict=True)
            while len(waiting) >= lines:
                yield block(waiting[:lines])
                number, waiting = number + 1, waiting[lines:]
        if waiting:
            yield block(waiting)

    return stored(ordered.mapInArrow(pack, "block bigint, first_key string, last_key string, lines bigint, data binary"), "index-blocks")


def look_up(keys: DataFrame, blocks: DataFrame) -> DataFrame:
    """Captures of the distinct ``key`` values: key, page, digest, file, start, size. Absent keys give no rows.

    The directory is bounded by how the index is built, and goes to every task.
    """
    entries = sorted((r["first_key"], r["block"], r["last_key"]) for r in blocks.select("first_key", "last_key", "block").collect())
    directory = keys.sparkSession.sparkContext.broadcast(([e[0] for e in entries], [e[1] for e in entries], [e[2] for e in entries]))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, numbers, lasts = directory.value
        for batch in batches:
            found, block = [], []
            for key in batch.column("key").to_pylist():
                # the blocks that may hold the key: from the one before its first equal to its last equal
                low, high = max(bisect_left(firsts, key) - 1, 0), bisect_right(firsts, key)
                for k in range(low, high):
                    if lasts[k] >= key:
                        found.append(key)
                        block.append(numbers[k])
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(block, pa.int64())], names=["key", "block"])

    def search(number, wanted: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(held) and len(wanted):
            lines = [json.loads(x) for x in zlib.decompress(held["data"].iloc[0]).decode().split("\n")]
            line_keys = [x[0] for x in lines]
            for key in wanted["key"]:
                out += lines[bisect_left(line_keys, key) : bisect_right(line_keys, key)]
        return pd.DataFrame(out, columns=["key", "page", "digest", "file", "start", "size"])

    routed = keys.select("key").distinct().mapInArrow(route, "key string, block bigint")
    return routed.groupBy("block").cogroup(blocks.select("block", "data").groupBy("block")).applyInPandas(
        search, "key string, page string, digest string, file string, start bigint, size bigint")


def read_records(spots: DataFrame, folder: str) -> DataFrame:
    """Records at (file, start, size), read by byte ranges: page, record_type, refers_to, url, payload, digest (as stored).

    Reads go file by file in order of their places; a record whose payload does not have the digest it names is an error.
    """
    root = folder.rstrip("/")
    spots = stored(spots.select("file", "start", "size"), "spots")
    # the rows are small and what they point at is not: so many tasks that each reads about TASK_BYTES
    size = spots.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    tasks = max(int(spots.sparkSession.conf.get("spark.sql.shuffle.partitions")), size // TASK_BYTES)
    ordered = spots.repartition(tasks, "file", F.floor(F.col("start") / STRIDE_BYTES)).sortWithinPartitions("file", "start")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, path = open_folder(root)
        source, opened = None, None
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part, rows = batch.slice(at, 256), []
                for file, start, size in zip(*(part.column(c).to_pylist() for c in ("file", "start", "size")), strict=True):
                    if file != opened:
                        if source is not None:
                            source.close()
                        source, opened = fs.open_input_file(f"{path}/{file}"), file
                    fields, payload = parse(zlib.decompress(source.read_at(size, start), 31))
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    if fields["WARC-Type"] == "response" and hashlib.sha256(payload).hexdigest() != digest:
                        raise ValueError(f"damaged record in {file} at {start}")
                    rows.append((fields["X-Page"] or None, fields["WARC-Type"], fields.get("X-Refers-To-Page"), fields["WARC-Target-URI"], payload, digest))
                columns = list(zip(*rows, strict=True)) if rows else [()] * 6
                kinds = [pa.string(), pa.string(), pa.string(), pa.string(), pa.binary(), pa.string()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["page", "record_type", "refers_to", "url", "payload", "digest"])
        if source is not None:
            source.close()

    return ordered.mapInArrow(read, "page string, record_type string, refers_to string, url string, payload binary, digest string")


def round_trip(spark: SparkSession, pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", folder: str | None = None) -> DataFrame:
    """Write all pages, index them, look every page's URL up and read its record back.

    Rows, one for each page: page_id, payload_bytes, payload_digest, record_type, refers_to. A revisit's payload is that of the
    record it refers to. Null pages are empty payloads; null ids and URLs are kept as such.
    """
    folder = folder or scratch_path(spark, "warc")
    captures = write_archives(pages, folder, id_col, url_col, html_col)
    blocks = build_index(captures)
    found = look_up(pages.select(url_key(F.col(url_col)).alias("key")), blocks)
    records = read_records(found, folder).select("page", "record_type", "refers_to", F.octet_length("payload").cast("bigint").alias("size"), "digest")
    records = stored(records, "records")
    kind = dict(pages.dtypes)[id_col]
    originals = records.filter("record_type = 'response' and page is not null").select(F.col("page").alias("refers_to"), F.col("size").alias("full"), F.col("digest").alias("full_digest"))
    originals = originals.dropDuplicates(["refers_to", "full_digest"])
    out = records.join(originals.join(records.select("refers_to").filter("refers_to is not null").distinct(), "refers_to"), "refers_to", "left")
    out = out.filter("refers_to is null or full_digest = digest")
    return out.select(
        F.col("page").cast(kind).alias("page_id"), F.when(F.col("refers_to").isNull(), F.col("size")).otherwise(F.col("full")).alias("payload_bytes"),
        F.col("digest").alias("payload_digest"), "record_type", F.col("refers_to").cast(kind).alias("refers_to"),
    )
