"""WARC archives: a deterministic sharded writer, and its reader.

1. A small table of (id, payload digest, size) is written once. From it come
   the groups of equal payloads (the largest id of a group is its response,
   the others revisit it), one note for each revisit, and the borders of the
   parts: quantiles by bytes over keys chosen by hash, so they depend on the
   rows alone and not on how Spark dealt them.
2. Rows and notes are range-shuffled by part and sorted by (id, digest), each
   note before its row. A payload crosses the network once.
3. A task writes each of its parts in order and rolls to the next file when
   the compressed bytes reach ``roll_bytes``. Every record is a gzip member of
   its own with headers and digests made anew from the row. The same rows give
   the same files, byte for byte, for the same ``parts``.
4. A file is written under a temporary name and renamed when whole; a repeated
   or speculative task renames equal bytes to the same name. The job commits by
   renaming the manifest, and readers open only what the manifest lists.

Results for odd input: a null or empty body is a payload of no bytes. A null
id sorts first, is never a group's largest, and revisits the group's response
if that has one. Rows that repeat the largest id with the same payload are all
responses; every row is one record. A null url is written as ``urn:key:<id>``;
bytes that a header can't hold are percent-encoded. An empty table writes no
file, and the manifest of no rows is committed all the same. Extra columns are
ignored. Rows alike in id and payload are written by one task, as a stream.
"""

from __future__ import annotations

import base64
import hashlib
import json
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlog.llm import common as C
from playlog.llm.token_files import _file_system
from playlog.session import _file_system as hadoop_file_system

PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# keys that choose the borders of the parts: so many a part, and in all
KEYS_A_PART, MOST_KEYS = 32, 1 << 18
_UNSAFE = re.compile(rb"[^\x21-\x7e]")
MANIFEST = [C.field(n, k) for n, k in (("file", "string"), ("part", "int"), ("seq", "int"), ("n_records", "long"),
                                       ("n_bytes", "long"), ("crc32", "long"))]
RECORD = [C.field(n, k) for n, k in (
    ("file", "string"), ("offset", "long"), ("id", "long"), ("target_uri", "string"), ("record_type", "string"),
    ("record_id", "string"), ("refers_to", "long"), ("payload_bytes", "long"), ("payload_digest", "string"),
    ("payload", "binary"))]


# --- records ----------------------------------------------------------------------------

def base32(sha1_hex: str) -> str:
    return base64.b32encode(bytes.fromhex(sha1_hex)).decode()


def record_urn(key: int | None, sha1_hex: str, ordinal: int = 0) -> str:
    """Record id, made from what the record holds."""
    seed = hashlib.sha256(f"{key}|{sha1_hex}|{ordinal}".encode()).digest()
    return f"<urn:uuid:{uuid.UUID(bytes=seed[:16], version=5)}>"


def _uri(url: str | None, key: int | None) -> str:
    raw = f"urn:key:{key}".encode() if url is None else url.encode("utf-8", "replace")
    return _UNSAFE.sub(lambda m: b"%%%02X" % m[0][0], raw).decode("ascii")


def _member(headers: list[tuple[str, str]], block: bytes, level: int) -> bytes:
    digest = base64.b32encode(hashlib.sha1(block).digest()).decode()
    headers = [*headers, ("WARC-Block-Digest", f"sha1:{digest}"), ("Content-Length", str(len(block)))]
    head = "WARC/1.1\r\n" + "".join(f"{n}: {v}\r\n" for n, v in headers) + "\r\n"
    packed = zlib.compressobj(level, zlib.DEFLATED, 31)
    return packed.compress(head.encode() + block + b"\r\n\r\n") + packed.flush()


def info_member(name: str, date: str, level: int) -> bytes:
    urn = record_urn(None, hashlib.sha1(name.encode()).hexdigest())
    return _member([("WARC-Type", "warcinfo"), ("WARC-Record-ID", urn), ("WARC-Date", date), ("WARC-Filename", name),
                    ("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n", level)


def page_member(key: int | None, url: str | None, payload: bytes, sha1_hex: str, ordinal: int, refers: int | None,
                date: str, level: int) -> bytes:
    """A response, or a revisit of the response of id ``refers`` (which keeps
    the HTTP headers, the payload's length and digest, but no payload)."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: %d\r\n\r\n" % len(payload))
    kind = "response" if refers is None else "revisit"
    headers = [("WARC-Type", kind), ("WARC-Record-ID", record_urn(key, sha1_hex, ordinal)), ("WARC-Date", date),
               ("WARC-Target-URI", _uri(url, key)), ("WARC-Payload-Digest", f"sha1:{base32(sha1_hex)}"),
               ("Content-Type", "application/http;msgtype=response")]
    if key is not None:
        headers.append(("X-Record-Key", str(key)))
    if refers is None:
        return _member(headers, http + payload, level)
    return _member([*headers, ("WARC-Profile", PROFILE), ("WARC-Refers-To", record_urn(refers, sha1_hex)),
                    ("X-Refers-To-Key", str(refers))], http, level)


def members(stream, chunk: int = 1 << 16) -> Iterator[tuple[int, bytes]]:
    """(offset, content) of each gzip member of a file, one at a time."""
    at, rest = 0, stream.read(chunk)
    while rest:
        gz, parts, start = zlib.decompressobj(31), [], at
        while not gz.eof:
            if not rest:
                raise ValueError(f"archive ends inside the record at byte {start}")
            parts.append(gz.decompress(rest))
            at += len(rest) - len(gz.unused_data)
            rest = gz.unused_data or stream.read(chunk)
        yield start, b"".join(parts)


def parse(content: bytes) -> tuple[dict[str, str], bytes]:
    """(headers, block) of a record; raises where length or block digest is wrong."""
    head, _, rest = content.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0][:40]!r}")
    headers = dict(x.split(": ", 1) for x in lines[1:])
    block = rest[:int(headers["Content-Length"])]
    if rest[len(block):] != b"\r\n\r\n":
        raise ValueError("record length differs from its header")
    if headers["WARC-Block-Digest"] != "sha1:" + base64.b32encode(hashlib.sha1(block).digest()).decode():
        raise ValueError("block digest differs from its header")
    return headers, block


# --- writer -----------------------------------------------------------------------------

def _keyed(pages: DataFrame, id_col: str, url: str, body: str) -> DataFrame:
    """id, url, payload, sha (hex SHA-1), n (bytes), tie (orders payloads of one id)."""
    src = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url).cast("string").alias("url"),
                       C.utf8(body).alias("payload"))
    return src.select("*", F.sha1("payload").alias("sha"), F.octet_length("payload").cast("long").alias("n")
                      ).withColumn("tie", F.xxhash64("sha"))


def _borders(small: DataFrame, parts: int) -> list[tuple]:
    """(id, tie) where a part ends: quantiles, by bytes, of keys chosen by hash.
    At most about ``MOST_KEYS`` distinct keys come to the driver."""
    rows = small.agg(F.approx_count_distinct(F.struct("id", "tie"), 0.02)).first()[0]
    share = min(1.0, min(KEYS_A_PART * parts, MOST_KEYS) / max(rows, 1))
    chosen = small if share == 1 else small.filter(
        F.xxhash64(F.lit("border"), "id", "tie") < int(-(1 << 63) + share * (1 << 64)))
    found = chosen.groupBy("id", "tie").agg(F.sum(F.col("n") + 600).alias("w")).collect()
    found = sorted((r["id"] is not None, r["id"] or 0, r["tie"], r["w"]) for r in found)
    total, so_far, borders = sum(x[-1] for x in found), 0, []
    for known, key, tie, w in found:
        so_far += w
        if known and so_far * parts >= total * (len(borders) + 1) and len(borders) < parts - 1:
            borders += [(key, tie)] * (so_far * parts // total - len(borders))
    return borders[:parts - 1]


def _part(borders: list[tuple]) -> Column:
    """Number of borders at or below (id, tie): a binary search in a literal array."""
    if not borders:
        return F.lit(0)
    table = F.from_json(F.lit(json.dumps([{"id": i, "tie": t} for i, t in borders])),
                        "array<struct<id:bigint,tie:bigint>>")
    steps = [1 << b for b in reversed(range(len(borders).bit_length()))]
    here = F.struct(F.col("id"), F.col("tie"))
    found = F.aggregate(F.array(*map(F.lit, steps)), F.lit(0), lambda low, step: F.when(
        F.coalesce(F.get(table, low + step - 1) <= here, F.lit(False)), low + step).otherwise(low))
    return F.when(F.col("id").isNull(), 0).otherwise(found)


def write(pages: DataFrame, folder: str, id_col: str = "page_id", url: str = "url", body: str = "html",
          min_bytes: int = 0, roll_bytes: int = 16 << 20, part_bytes: int = 256 << 20, parts: int | None = None,
          date: str = "2024-01-01T00:00:00Z", level: int = 6) -> DataFrame:
    """Write one record for each row into ``folder``; returns the committed manifest.

    Payloads of at least ``min_bytes`` that occur more than once are written
    once. ``parts`` (default: one for each ``part_bytes``, at least the
    session's shuffle partitions, at most ``MOST_KEYS / KEYS_A_PART``) and
    ``date`` are all that the files depend on besides rows and sizes.
    """
    spark, folder = pages.sparkSession, folder.rstrip("/")
    if _exists(spark, f"{folder}/manifest"):
        raise FileExistsError(f"{folder} holds a committed archive")
    rows = _keyed(pages, id_col, url, body)
    small = C.cut(rows.select("id", "sha", "n", "tie"))
    if parts is None:
        least = int(spark.conf.get("spark.sql.shuffle.partitions"))
        parts = max(least, -(-(small.agg(F.sum("n")).first()[0] or 0) // part_bytes))
    parts = min(parts, MOST_KEYS // KEYS_A_PART)
    part = _part(_borders(small, parts))

    kept = (small.filter(F.col("n") >= min_bytes).groupBy("sha", "n")
            .agg(F.max("id").alias("keep"), F.count(F.lit(1)).alias("rows")).filter("rows > 1 and keep is not null"))
    notes = (small.join(kept.drop("rows"), ["sha", "n"]).filter("id is null or id < keep")
             .select("id", "tie", "sha", "keep").distinct())
    both = rows.select(part.alias("part"), "id", "tie", "sha", F.lit(1).alias("kind"), "url", "payload",
                       F.lit(None).cast("long").alias("keep")).unionByName(
        notes.select(part.alias("part"), "id", "tie", "sha", F.lit(0).alias("kind"),
                     F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("payload"), "keep"))
    dealt = both.repartitionByRange(parts, "part").sortWithinPartitions("part", "id", "tie", "sha", "kind", "url")
    written = C.cut(dealt.mapInArrow(C.trimmed(_writer(folder, date, level, roll_bytes)), T.StructType(MANIFEST)))
    commit(written.coalesce(-(-parts // 256)), folder)
    return spark.read.parquet(f"{folder}/manifest")


def _writer(folder: str, date: str, level: int, roll_bytes: int):
    def run(batches):
        schema = C.arrow_schema(*MANIFEST)
        place, path = _file_system(folder)
        name, held, size, n, part, seq = "", [], 0, 0, None, 0
        note, last, ordinal = None, None, 0

        def close():
            data = b"".join(held)
            place.create_dir(f"{path}/warc", recursive=True)
            publish(place, f"{path}/warc/{name}", data)
            row = [[name], [part], [seq], [n], [len(data)], [zlib.crc32(data)]]
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(row, schema)], schema=schema)

        for batch in batches:
            for few in C.slices(batch, "payload"):
                for p, key, _, sha, kind, url, payload, keep in zip(*(c.to_pylist() for c in few.columns)):
                    if kind == 0:
                        note = (key, sha, keep)
                        continue
                    if p != part or size >= roll_bytes:
                        if held:
                            yield close()
                        part, seq = p, (seq + 1 if p == part else 0)
                        name, n = f"part-{part:06d}-{seq:05d}.warc.gz", 0
                        held, size = [info_member(name, date, level)], 0
                    ordinal = ordinal + 1 if last == (key, sha) else 0
                    last = (key, sha)
                    refers = note[2] if note and note[:2] == last else None
                    held.append(page_member(key, url, payload, sha, ordinal, refers, date, level))
                    size += len(held[-1])
                    n += 1
        if held:
            yield close()

    return run


def publish(place, target: str, data: bytes) -> None:
    """A whole file under its name, or nothing: written aside, then renamed."""
    aside = f"{target}.{uuid.uuid4().hex}.tmp"
    with place.open_output_stream(aside, compression=None) as f:
        f.write(data)
    try:
        place.move(aside, target)
    except OSError:  # some stores don't rename over a file: another attempt's, of the same bytes
        if place.get_file_info(target).size != len(data):
            raise
        place.delete_file(aside)


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop_file_system(spark, path)
    return fs.exists(p)


def commit(written: DataFrame, folder: str) -> None:
    """Publish the manifest: written aside and renamed, the commit point."""
    spark = written.sparkSession
    aside = f"{folder}/manifest-{uuid.uuid4().hex}.tmp"
    written.write.parquet(aside)
    fs, source = hadoop_file_system(spark, aside)
    target = hadoop_file_system(spark, f"{folder}/manifest")[1]
    if fs.exists(target) or not fs.rename(source, target):
        raise FileExistsError(f"{folder} was committed meanwhile")


# --- reader -----------------------------------------------------------------------------

def read(spark: SparkSession, folder: str, with_payload: bool = True) -> DataFrame:
    """Page records of a committed archive (columns of ``RECORD``), each checked
    against its digests. A revisit has its payload's length and digest only."""
    folder = folder.rstrip("/")
    listed = spark.read.parquet(f"{folder}/manifest").select("file", "n_bytes", "n_records")
    out = RECORD if with_payload else RECORD[:-1]
    tasks = max(1, min(listed.count(), 10_000))

    def run(batches):
        place, path = _file_system(folder)
        schema = C.arrow_schema(*out)
        for batch in batches:
            for name, n_bytes, n_records in zip(*(c.to_pylist() for c in batch.columns)):
                where, n = f"{path}/warc/{name}", 0
                if place.get_file_info(where).size != n_bytes:
                    raise ValueError(f"{name}: size differs from the manifest")
                with place.open_input_stream(where, compression=None) as f:
                    rows, held = [], 0
                    for offset, content in members(f):
                        row = _row(name, offset, *parse(content))
                        if row is None:
                            continue
                        n += 1
                        rows.append(row[:len(out)])
                        held += len(content) if with_payload else 200
                        if held > 4 << 20:
                            yield _batch(rows, schema)
                            rows, held = [], 0
                if rows:
                    yield _batch(rows, schema)
                if n != n_records:
                    raise ValueError(f"{name}: {n} records, the manifest says {n_records}")

    return listed.repartition(tasks).mapInArrow(C.trimmed(run), T.StructType(out))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def _row(file: str, offset: int, headers: dict[str, str], block: bytes) -> tuple | None:
    kind = headers["WARC-Type"]
    if kind not in ("response", "revisit"):
        return None
    http, _, payload = block.partition(b"\r\n\r\n")
    length = int(re.search(rb"\r\nContent-Length: (\d+)", http)[1])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha1:")
    if kind == "response" and (len(payload) != length or
                               base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest):
        raise ValueError(f"{file} at {offset}: payload differs from its digest")
    key, refers = headers.get("X-Record-Key"), headers.get("X-Refers-To-Key")
    return (file, offset, int(key) if key is not None else None, headers["WARC-Target-URI"], kind,
            headers["WARC-Record-ID"], int(refers) if refers is not None else None, length, digest,
            payload if kind == "response" else None)
