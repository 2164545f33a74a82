"""WARC archives with a two-level capture index.

Archives hold a gzip member per record. The index sorts captures by reversed-host URL key and writes them in
compressed blocks of lines, one block file per range of keys; beside it lies a sparse directory with the first
and last key of each block. A lookup finds the block file by the ranges, the blocks by binary search in the
directory, the lines by binary search in the block, and then reads the records' byte ranges, those that lie
together in one go.

Files are written by tasks through ``pyarrow.fs`` into a folder that all executors share, each under a name of
its own; only names that a finished task has returned are used, so a task that ran twice does no harm.

Payloads of at least ``revisit_bytes`` bytes that are equal are stored once: the record of the smallest page id
is the response, the others are revisits of it. Defined cases: a null payload is empty; a null URL has the key
``)``; rows that repeat a page id with the same payload are written each, with the same role; a null id is a
revisit if any id has its payload; very long payloads are written whole, a record each; of equal payloads the least
id is the response, and ids that tie share that role; captures that tie on a key all stand in the index; an empty
table gives archives without records. Other columns are not read, whatever their names.
"""

from __future__ import annotations

import gzip
import hashlib
import re
import uuid
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import urlsplit

import pandas as pd
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyloom.llm.common import col
from tallyloom.sources.staging import stage, staging_folder

CAPTURE = "key string, page_id long, file string, offset long, length long"
RECORD = "page_id long, url string, record_type string, payload_digest string, payload_bytes long, refers_to long, payload binary"
READ_AHEAD = 4 << 20


def url_key(url: str | None) -> str:
    """``http://a.example.com:80/p?q`` as ``com,example,a:80)/p?q``."""
    if not url:
        return ")"
    try:
        parts = urlsplit(url)
        host, port = parts.hostname or "", parts.port
    except ValueError:  # no host can be made out
        return ")" + _clean(url)
    rest = url.split("://", 1)[-1]
    rest = rest[min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest)) :]
    return _clean(",".join(reversed(host.split("."))) + (f":{port}" if port else "") + ")" + rest)


def _clean(s: str) -> str:
    """Without characters that would end a line or a field."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", s)


def record(page_id, url: str | None, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC record; a revisit has no payload."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:x-page:{page_id}>",
        f"WARC-Date: {date}",
        *([f"WARC-Target-URI: {_clean(url)}"] if url else []),
        f"WARC-Payload-Digest: sha256:{digest}",
        *(
            ["WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
            if revisit
            else []
        ),
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode("utf-8", "surrogatepass") + b"\r\n\r\n" + block + b"\r\n\r\n"


def parsed(member: bytes) -> tuple:
    """A record's fields in the order of ``RECORD``; the payload's digest and length are taken from the payload itself."""
    head, _, rest = gzip.decompress(member).partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode("utf-8", "surrogatepass").split("\r\n")[1:])
    http, _, payload = rest[: int(fields["Content-Length"])].partition(b"\r\n\r\n")
    page = lambda s: None if (p := s.removeprefix("<urn:x-page:").removesuffix(">")) == "None" else int(p)
    digest, size, refers = fields["WARC-Payload-Digest"].removeprefix("sha256:"), None, None
    if fields["WARC-Type"] == "revisit":
        size = int(re.search(rb"Content-Length: (\d+)", http)[1])
        refers, payload = page(fields["WARC-Refers-To"]), b""
    else:
        size, read = len(payload), hashlib.sha256(payload).hexdigest()
        if read != digest:
            raise ValueError(f"record {fields['WARC-Record-ID']} has a payload with digest {read}, not {digest}")
    return page(fields["WARC-Record-ID"]), fields.get("WARC-Target-URI"), fields["WARC-Type"], digest, size, refers, payload


def _open(root: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(root)


def _int(x):
    return None if pd.isna(x) else int(x)


def roles(pages: DataFrame, page_id: str, url: str, payload: str, revisit_bytes: int) -> DataFrame:
    """``page_id, url, payload, digest, refers_to``: payload as binary, ``refers_to`` null for responses."""
    body = F.coalesce(F.encode(col(payload), "UTF-8"), F.lit(b""))
    # Ids as text, since a null among numbers would make them floats in pandas.
    rows = pages.select(col(page_id).cast("long").alias("page_id"), col(url).alias("url"), body.alias("payload")).withColumn(
        "digest", F.sha2("payload", 256)
    )
    narrow = rows.filter(F.octet_length("payload") >= revisit_bytes).select("page_id", "digest")
    first = narrow.groupBy("digest").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1 AND first IS NOT NULL")
    again = narrow.join(first, "digest").filter(~F.col("page_id").eqNullSafe(F.col("first")))
    again = again.select(F.col("page_id").alias("p"), F.col("digest").alias("d"), "first").distinct()
    joined = rows.join(again, F.col("page_id").eqNullSafe(F.col("p")) & (F.col("digest") == F.col("d")), "left")
    return joined.select(F.col("page_id").cast("string").alias("page_id"), "url", "payload", "digest", F.col("first").cast("string").alias("refers_to"))


def write_archives(
    pages: DataFrame, root: str, page_id: str = "page_id", url: str = "url", payload: str = "html",
    revisit_bytes: int = 100, date: str = "1970-01-01T00:00:00Z",
) -> DataFrame:
    """Write an archive per task under ``root``; staged captures with their places (``CAPTURE``)."""

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, folder = _open(root)
        name, at, out = f"{uuid.uuid4().hex}.warc.gz", 0, None
        for b in batches:
            if out is None:
                system.create_dir(folder, recursive=True)
                out = system.open_output_stream(f"{folder}/{name}", compression=None)
            rows = []
            for r in b.itertuples():
                refers = r.refers_to if isinstance(r.refers_to, str) else None
                member = gzip.compress(record(r.page_id, r.url, r.payload, r.digest, refers, date), 6, mtime=0)
                out.write(member)
                rows.append((url_key(r.url), _int(r.page_id), name, at, len(member)))
                at += len(member)
            frame = pd.DataFrame(rows, columns=["key", "page_id", "file", "offset", "length"])
            yield frame.astype({"page_id": "Int64"})
        if out is not None:
            out.close()

    return stage(roles(pages, page_id, url, payload, revisit_bytes).mapInPandas(write, CAPTURE))


@dataclass(frozen=True)
class Index:
    """Folder of block files and directories, and per block file its name, first and last key (in order)."""

    root: str
    parts: tuple[tuple[str, str, str], ...]


def build_index(captures: DataFrame, root: str, block_lines: int = 1000, parts: int | None = None) -> Index:
    """Sort captures into block files with sparse directories; the driver keeps one entry per block file."""
    spark = captures.sparkSession
    n = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Places take part in the order, so that the captures of one key can lie in several files.
    ordered = captures.repartitionByRange(n, "key", "file", "offset").sortWithinPartitions("key", "file", "offset")

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, folder = _open(root)
        name, at, out, lines, directory = uuid.uuid4().hex, 0, None, [], []

        def flush():
            nonlocal at, out
            if out is None:
                system.create_dir(folder, recursive=True)
                out = system.open_output_stream(f"{folder}/{name}.blocks", compression=None)
            block = gzip.compress("\n".join(lines).encode("utf-8", "surrogatepass"), 6, mtime=0)
            out.write(block)
            directory.append(f"{lines[0].split(' ', 1)[0]} {lines[-1].split(' ', 1)[0]} {at} {len(block)}")
            at += len(block)
            lines.clear()

        for b in batches:
            for r in b.itertuples():
                lines.append(f"{r.key} {r.file} {r.offset} {r.length}")
                if len(lines) == block_lines:
                    flush()
        if lines:
            flush()
        if out is not None:
            out.close()
            with system.open_output_stream(f"{folder}/{name}.directory", compression=None) as d:
                d.write("\n".join(directory).encode("utf-8", "surrogatepass"))
            yield pd.DataFrame([(name, directory[0].split(" ")[0], directory[-1].split(" ")[1])], columns=["name", "first", "last"])

    written = stage(ordered.mapInPandas(write, "name string, first string, last string")).collect()  # a row per block file
    return Index(root, tuple(sorted(((r.name, r.first, r.last) for r in written), key=lambda p: (_utf8(p[1]), _utf8(p[2])))))


def _utf8(key: str) -> bytes:
    """Keys are ordered as Spark orders strings: by their bytes."""
    return key.encode("utf-8", "surrogatepass")


def lookup(keys: DataFrame, index: Index, key: str = "key") -> DataFrame:
    """``key, file, offset, length`` of all captures of the keys."""
    firsts, lasts, root = [_utf8(p[1]) for p in index.parts], [_utf8(p[2]) for p in index.parts], index.root
    names = [p[0] for p in index.parts]

    @F.pandas_udf(T.ArrayType(T.StringType()))
    def files(batch: pd.Series) -> pd.Series:
        return pd.Series([names[bisect_left(lasts, _utf8(k)) : bisect_right(firsts, _utf8(k))] for k in batch], dtype=object)

    routed = keys.select(col(key).alias("key")).filter("key IS NOT NULL").distinct().select("key", F.explode(files("key")).alias("part"))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, folder = _open(root)
        part, source, at_block = None, None, None
        for b in batches:
            found = []
            for r in b.itertuples():
                if r.part != part:
                    part, at_block = r.part, None
                    with system.open_input_stream(f"{folder}/{part}.directory", compression=None) as d:
                        rows = [x.split(" ") for x in d.read().decode("utf-8", "surrogatepass").split("\n")]
                    begin, end = [_utf8(x[0]) for x in rows], [_utf8(x[1]) for x in rows]
                    source = system.open_input_file(f"{folder}/{part}.blocks")
                wanted = _utf8(r.key)
                for i in range(bisect_left(end, wanted), bisect_right(begin, wanted)):
                    if i != at_block:
                        raw = source.read_at(int(rows[i][3]), int(rows[i][2]))
                        lines = gzip.decompress(raw).decode("utf-8", "surrogatepass").split("\n")
                        heads, at_block = [_utf8(x.split(" ", 1)[0]) for x in lines], i
                    for x in lines[bisect_left(heads, wanted) : bisect_right(heads, wanted)]:
                        k, file, offset, length = x.split(" ")
                        found.append((k, file, int(offset), int(length)))
            yield pd.DataFrame(found, columns=["key", "file", "offset", "length"])

    return routed.repartition("part").sortWithinPartitions("part", "key").mapInPandas(search, "key string, file string, offset long, length long")


def fetch(places: DataFrame, root: str) -> DataFrame:
    """The records (``RECORD``) at ``file, offset, length``, read in the order of the files."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        system, folder = _open(root)
        name, source, start, held = None, None, 0, b""
        for b in batches:
            out = []
            for r in b.itertuples():
                if r.file != name:
                    name, source, held = r.file, system.open_input_file(f"{folder}/{r.file}"), b""
                if not start <= r.offset <= r.offset + r.length <= start + len(held):
                    start, held = r.offset, source.read_at(max(r.length, READ_AHEAD), r.offset)
                out.append(parsed(held[r.offset - start : r.offset - start + r.length]))
            names = [x.split()[0] for x in RECORD.split(", ")]
            yield pd.DataFrame(out, columns=names).astype({"page_id": "Int64", "refers_to": "Int64", "payload_bytes": "int64"})

    stretch = F.floor(F.col("offset") / (8 * READ_AHEAD))
    ordered = places.select("file", "offset", "length").repartition("file", stretch).sortWithinPartitions("file", "offset")
    return ordered.mapInPandas(read, RECORD)


def archive_report(pages: DataFrame, **how) -> DataFrame:
    """Write all pages, index them, look all of them up and read them back: what the archives say of each page."""
    spark: SparkSession = pages.sparkSession
    root = f"{staging_folder(spark)}/warc-{uuid.uuid4().hex}"
    captures = write_archives(pages, f"{root}/archives", **how)
    index = build_index(captures, f"{root}/index")
    places = lookup(captures.select("key"), index)
    return fetch(places, f"{root}/archives").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
