"""WARC archives with a two-level capture index.

Archives: one gzip member per record; of records with equal payloads of ``least`` bytes or more the one
with the largest id is a response and the others revisit it.

Index: one line per capture, sorted by the URL key (host reversed), in compressed blocks of
``BLOCK_LINES`` lines. A block's first key and place stand in its file's directory, a sparse second level;
the first keys of the files are all that lookups carry with them, one short row per index file. A lookup
bisects the files, then a directory, then the lines of a block, and reads only that block and the
captures' own ranges of the archives.

Files are written by tasks under names of their own and count only through the rows that the tasks
return, so a task that is run again, or twice, changes nothing. Every folder is a URI that pyarrow's file
systems open on every executor.

Defined results: a null payload is empty; a null URL has the empty key; rows with equal id and equal
payload have the same role; if all ids of equal payloads are null, all are responses; an empty table makes
empty archives and an empty index; other columns are ignored.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote, unquote

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopgrain.llm.common import text_or_empty
from shopgrain.operators.checkpoints import materialise

BLOCK_LINES, LEAST_BYTES = 3000, 1000
DATE = "1970-01-01T00:00:00Z"  # pages carry no date; a fixed one makes equal input give equal records
CAPTURE = "surt string, id string, digest string, file string, offset long, length long"
RECORD = "id string, uri string, payload_bytes long, payload_digest string, record_type string, refers_to string"
_SCHEME, _PORT = re.compile(r"^[a-z][a-z0-9+.-]*://", re.I), re.compile(r":(80|443)?$")


def surt(url: str | None) -> str:
    """Key of a URL: host reversed and in lower case, without scheme, user, ``www.``, default port and fragment."""
    rest = _SCHEME.sub("", (url or "").strip()).split("#", 1)[0]
    host, slash, path = rest.partition("/")
    if not slash and "?" in host:
        host, _, path = host.partition("?")
        path = "?" + path
    host = _PORT.sub("", host.rpartition("@")[2].lower()).removeprefix("www.")
    host, _, port = host.partition(":")
    key = ",".join(reversed(host.split("."))) + (":" + port if port else "")
    return quote(f"{key})/{path}" if rest else "", safe="!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")


def _open(folder: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri("/" + folder[5:].lstrip("/") if folder.startswith("file:") else folder)


def _record(kind: str, uri: str, name: str, block: bytes, fields: dict[str, str]) -> bytes:
    head = {
        "WARC-Type": kind, "WARC-Record-ID": f"<{name}>", "WARC-Date": DATE, "WARC-Target-URI": uri, **fields,
        "Content-Type": "application/http; msgtype=response", "Content-Length": str(len(block)),
    }
    raw = b"WARC/1.1\r\n" + b"".join(f"{k}: {v}\r\n".encode() for k, v in head.items()) + b"\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(raw) + packer.flush()


def _name(key: str | None, digest: str) -> str:
    return f"urn:page:{'' if key is None else quote(key, safe='') + '/'}{digest}"


def _key(name: str) -> str | None:
    key, slash, _ = name.removeprefix("<urn:page:").rpartition("/")
    return unquote(key) if slash else None


def _http(size: int) -> bytes:
    return f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()


def write_archives(
    pages: DataFrame, folder: str, *, key: str = "page_id", url: str = "url", payload: str = "html",
    least: int = LEAST_BYTES,
) -> DataFrame:
    """Write a record per row; the captures, as a stored table."""
    body = text_or_empty(payload)
    rows = pages.select(
        F.col(key).alias("key"), F.col(url).cast("string").alias("url"), body.alias("payload"),
        F.sha1(body).alias("digest"), F.octet_length(body).alias("size"),
    )
    # Only payloads that occur twice are looked up, so rows of a common one are joined, never gathered.
    twice = materialise(
        rows.where(F.col("size") >= least).groupBy("digest").agg(F.max("key").alias("first"), F.count("*").alias("n"))
        .where("n > 1 and first is not null").drop("n"),
        "twice",
    )
    revisit = F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    dealt = rows.join(twice, "digest", "left").select(
        F.col("key").cast("string").alias("id"), "url", "digest", "size",
        F.when(revisit, F.col("first").cast("string")).alias("refers"),
        F.when(~revisit, F.col("payload")).alias("payload"), revisit.alias("revisit"),
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, at = _open(folder)
        files.create_dir(at, recursive=True)
        file, offset = f"{uuid.uuid4().hex}.warc.gz", 0
        with files.open_output_stream(f"{at}/{file}", compression=None) as out:
            for batch in batches:
                captures = []
                for r in _rows(batch):
                    digest = "sha1:" + base64.b32encode(bytes.fromhex(r["digest"])).decode()
                    fields = {"WARC-Payload-Digest": digest}
                    if r["revisit"]:
                        fields["WARC-Profile"] = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
                        fields["WARC-Refers-To"] = f"<{_name(r['refers'], r['digest'])}>"
                    block = _http(r["size"]) + (r["payload"] or "").encode()
                    uri = quote(r["url"] or "about:blank", safe="!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")
                    raw = _record("revisit" if r["revisit"] else "response", uri, _name(r["id"], r["digest"]), block, fields)
                    out.write(raw)
                    captures.append((surt(r["url"]), r["id"], r["digest"], file, offset, len(raw)))
                    offset += len(raw)
                yield _batch(captures, CAPTURE)

    return materialise(dealt.mapInArrow(write, CAPTURE), "captures")


def _rows(batch: pa.RecordBatch) -> Iterator[dict]:
    """Row by row, so that the texts of a batch are not all copied at once."""
    for i in range(batch.num_rows):
        yield {n: c[i].as_py() for n, c in zip(batch.schema.names, batch.columns, strict=True)}


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"string": pa.string(), "long": pa.int64()}
    fields = [f.split() for f in schema.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(fields)], [n for n, _ in fields]
    )


@dataclass(frozen=True)
class Index:
    """Folder of the index files, and the first key and name of each, in order."""

    folder: str
    archives: str
    first: tuple[bytes, ...]
    files: tuple[str, ...]


def build_index(captures: DataFrame, folder: str, archives: str, block_lines: int = BLOCK_LINES) -> Index:
    """Sort captures by URL key into index files of compressed blocks, each with its directory beside it."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, at = _open(folder)
        files.create_dir(at, recursive=True)
        file, offset, block, directory = uuid.uuid4().hex, 0, [], []
        with files.open_output_stream(f"{at}/{file}.cdx.gz", compression=None) as out:
            def flush() -> int:
                raw = gzip.compress("\n".join(block).encode(), mtime=0)
                out.write(raw)
                directory.append([block[0].split("\t", 1)[0], offset, len(raw)])
                block.clear()
                return len(raw)

            for batch in batches:
                for r in _rows(batch):
                    key = r.pop("surt")
                    block.append(key + "\t" + json.dumps(r))
                    if len(block) >= block_lines:
                        offset += flush()
            if block:
                flush()
        with files.open_output_stream(f"{at}/{file}.dir.gz", compression=None) as out:
            out.write(gzip.compress("\n".join(f"{k}\t{o}\t{n}" for k, o, n in directory).encode(), mtime=0))
        if directory:
            yield _batch([(directory[0][0], file)], "first string, file string")

    order = "surt", "id", "digest", "file", "offset"
    made = materialise(
        captures.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(write, "first string, file string"),
        "index",
    )
    rows = sorted((r["first"].encode(), r["file"]) for r in made.collect())  # one short row per index file
    return Index(folder, archives, tuple(r[0] for r in rows), tuple(r[1] for r in rows))


def _spanning(firsts: list[bytes] | tuple[bytes, ...], key: bytes) -> range:
    """Places that can hold a key: the last that starts before it, and all that start with it."""
    return range(max(0, bisect_left(firsts, key) - 1), bisect_right(firsts, key))


def lookup(index: Index, urls: DataFrame, url: str = "url") -> DataFrame:
    """The captures of all given URLs, each once however often the URL is asked for."""
    shared = urls.sparkSession.sparkContext.broadcast(index)

    @F.arrow_udf("string")
    def keys(urls: pa.Array) -> pa.Array:
        return pa.array([surt(u.as_py()) for u in urls], pa.string())

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index: Index = shared.value
        files, at = _open(index.folder)
        last, directory, firsts = None, [], []
        for batch in batches:
            for key in batch["surt"].to_pylist():
                found = []
                for f in _spanning(index.first, key.encode()):
                    if index.files[f] != last:
                        last = index.files[f]
                        with files.open_input_file(f"{at}/{last}.dir.gz") as source:
                            directory = [x.split("\t") for x in gzip.decompress(source.read()).decode().split("\n")]
                        firsts = [d[0].encode() for d in directory]
                    found += [
                        (key, last, int(directory[b][1]), int(directory[b][2]))
                        for b in _spanning(firsts, key.encode())
                    ]
                yield _batch(found, "surt string, file string, offset long, length long")

    def captures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, at = _open(shared.value.folder)
        last, lines, starts = None, [], []
        for batch in batches:
            for r in _rows(batch):
                if (r["file"], r["offset"]) != last:
                    last = r["file"], r["offset"]
                    with files.open_input_file(f"{at}/{r['file']}.cdx.gz") as source:
                        raw = source.read_at(r["length"], r["offset"])
                    lines = [x.split(b"\t", 1) for x in gzip.decompress(raw).split(b"\n")]
                    starts = [x[0] for x in lines]
                key = r["surt"].encode()
                found = [json.loads(x[1]) for x in lines[bisect_left(starts, key) : bisect_right(starts, key)]]
                yield _batch(
                    [(r["surt"], x["id"], x["digest"], x["file"], x["offset"], x["length"]) for x in found], CAPTURE
                )

    asked = urls.select(keys(F.col(url).cast("string")).alias("surt")).distinct()
    held = asked.repartitionByRange("surt").sortWithinPartitions("surt").mapInArrow(
        blocks, "surt string, file string, offset long, length long"
    )
    return held.repartition("file", "offset").sortWithinPartitions("file", "offset", "surt").mapInArrow(captures, CAPTURE)


def read_records(index: Index, captures: DataFrame, payload: bool = False) -> DataFrame:
    """The records of captures, by range reads; a response's payload must have the digest it claims."""
    folder = index.archives

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, at = _open(folder)
        last, source = None, None
        for batch in batches:
            out = []
            for r in _rows(batch):
                if r["file"] != last:
                    if source:
                        source.close()
                    last, source = r["file"], files.open_input_file(f"{at}/{r['file']}")
                out.append(parse(source.read_at(r["length"], r["offset"]), payload))
                if payload:
                    yield _batch(out, RECORD + ", payload string")
                    out = []
            if out:
                yield _batch(out, RECORD)
        if source:
            source.close()

    placed = captures.select("file", "offset", "length").repartitionByRange("file", "offset")
    return placed.sortWithinPartitions("file", "offset").mapInArrow(read, RECORD + ", payload string" * payload)


def parse(member: bytes, payload: bool = False) -> tuple:
    """The fields of RECORD of one compressed record, and its payload (null for a revisit) if asked for."""
    head, _, rest = zlib.decompress(member, 31).partition(b"\r\n\r\n")
    field = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(field["Content-Length"])]
    http, _, body = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b": ")[2])
    digest = base64.b32decode(field["WARC-Payload-Digest"].removeprefix("sha1:")).hex()
    kind, refers = field["WARC-Type"], None
    if kind == "revisit":
        refers = _key(field["WARC-Refers-To"])
    elif len(body) != size or hashlib.sha1(body).hexdigest() != digest:
        raise ValueError(f"record {field['WARC-Record-ID']} does not hold the payload it claims")
    out = (_key(field["WARC-Record-ID"]), field["WARC-Target-URI"], size, digest, kind, refers)
    return (*out, None if kind == "revisit" else body.decode()) if payload else out
