import base64
import gzip
import hashlib
import io
import os

import pytest
from pyspark.sql import functions as F

from playlog.llm import warc
from playlog.llm.queries import ORACLE, QUERIES
from playlog.session import scratch_path
from tools.compare import digest, duck

PAGE = "<html><body>same page, several urls</body></html>"
PAGES = [(1, "http://a/1", PAGE), (2, "http://a/2", PAGE), (3, None, None), (4, "http://a/é 4\r\nX: y", ""),
         (5, "http://a/5", "été 日本 🙂"), (None, "http://a/n", PAGE), (7, "http://a/7", PAGE), (7, "http://a/7", PAGE),
         (7, "http://a/7b", "other body of a repeated id"), (8, "http://a/8", "x" * 3_000_000), (None, None, None),
         (2, "http://a/2", PAGE), (9, "http://a/9", "\r\n\r\nWARC/1.1\r\n\r\n")]


def _pages(spark, rows=PAGES):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr(
        "*", "'c' AS id", "'c' AS sha", "'c' AS part", "'c' AS kind")


def _plain(rows, min_bytes=0):
    """(id, bytes, digest, type, refers to) of each row, by comparing all of them."""
    out = []
    for key, _, body in rows:
        body = (body or "").encode()
        same = [k for k, _, b in rows if (b or "").encode() == body and k is not None]
        keep = max(same) if same and len(body) >= min_bytes else None
        revisit = keep is not None and (key is None or key < keep)
        out.append((key, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(),
                    "revisit" if revisit else "response", keep if revisit else None))
    return sorted(out, key=repr)


def _read(spark, folder):
    found = warc.read(spark, folder).collect()
    for r in found:
        assert (r["payload"] is None) == (r["record_type"] == "revisit")
    return sorted(((r["id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in found),
                  key=repr), found


def _files(folder):
    folder = folder.removeprefix("file:") + "/warc"
    return {n: open(f"{folder}/{n}", "rb").read() for n in sorted(os.listdir(folder)) if not n.endswith(".crc")}


@pytest.mark.parametrize("min_bytes", [0, 10, 1000])
def test_matches_plain_version(spark, min_bytes):
    folder = scratch_path(spark, "warc")
    warc.write(_pages(spark), folder, min_bytes=min_bytes, parts=3)
    got, found = _read(spark, folder)
    assert got == _plain(PAGES, min_bytes)
    bodies = {(r["id"], r["payload"]) for r in found if r["record_type"] == "response"}
    assert bodies <= {(k, (b or "").encode()) for k, _, b in PAGES}
    ids = [r["record_id"] for r in found]
    assert len(set(ids)) == len(ids)
    uris = {r["target_uri"] for r in found}
    assert "http://a/%C3%A9%204%0D%0AX:%20y" in uris and "urn:key:3" in uris


def test_files_depend_on_rows_only(spark):
    rows = [(i * 7 % 2000, f"http://h/{i}", f"<p>{hashlib.sha256(bytes([i % 250])).hexdigest() * (1 + i % 40)}</p>")
            for i in range(2000)]
    seen = []
    for n, order in ((1, rows), (13, rows[::-1])):
        folder = scratch_path(spark, "warc")
        manifest = warc.write(_pages(spark, order).repartition(n), folder, parts=5, roll_bytes=20_000).collect()
        files = _files(folder)
        assert {r["file"]: r["n_bytes"] for r in manifest} == {n: len(b) for n, b in files.items()}
        seen.append(files)
        assert _read(spark, folder)[0] == _plain(rows)
    assert seen[0] == seen[1] and len(seen[0]) > 10
    assert max(map(len, seen[0].values())) < 20_000 + 10_000
    parts = {n.split("-")[1] for n in seen[0]}
    assert len(parts) == 5


def test_files_are_plain_gzip(spark):
    folder = scratch_path(spark, "warc")
    warc.write(_pages(spark), folder, parts=1)
    data = b"".join(gzip.decompress(b) for b in _files(folder).values())
    assert data.count(b"WARC-Type: ") == len(PAGES) + 1
    kinds = [warc.parse(m)[0]["WARC-Type"] for b in _files(folder).values() for _, m in warc.members(io.BytesIO(b), 7)]
    assert kinds[0] == "warcinfo" and len(kinds) == len(PAGES) + 1


def test_order_of_records(spark):
    folder = scratch_path(spark, "warc")
    warc.write(_pages(spark), folder, parts=4)
    ids = [r["id"] for r in warc.read(spark, folder).orderBy("file", "offset").collect()]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))


def test_hot_id_is_spread_over_parts(spark):
    rows = [(5, f"u{i}", f"body {i} " * 30) for i in range(600)] + [(i, "u", f"one {i}") for i in range(300)]
    folder = scratch_path(spark, "warc")
    manifest = warc.write(_pages(spark, rows), folder, parts=6).collect()
    assert len(manifest) == 6 and max(r["n_records"] for r in manifest) < 450
    assert _read(spark, folder)[0] == _plain(rows)


def test_readers_see_committed_files_only(spark, tmp_path):
    folder = scratch_path(spark, "warc")
    warc.write(_pages(spark), folder, parts=2)
    place, path = warc._file_system(folder)
    name = next(iter(_files(folder)))
    data = _files(folder)[name]
    warc.publish(place, f"{path}/warc/{name}", data)  # a repeated attempt
    warc.publish(place, f"{path}/warc/part-000099-00000.warc.gz", b"not listed")
    with place.open_output_stream(f"{path}/warc/{name}.0.tmp") as f:
        f.write(data[:50])  # an attempt that died
    assert _read(spark, folder)[0] == _plain(PAGES)
    with pytest.raises(FileExistsError):
        warc.write(_pages(spark), folder)
    with pytest.raises(FileExistsError):
        warc.commit(spark.createDataFrame([], "file string"), folder)


def test_damage_is_seen(spark):
    folder = scratch_path(spark, "warc")
    warc.write(_pages(spark), folder, parts=1)
    place, path = warc._file_system(folder)
    name, data = next(iter(_files(folder).items()))
    with place.open_output_stream(f"{path}/warc/{name}", compression=None) as f:
        f.write(data[:-9])
    with pytest.raises(Exception, match="size differs"):
        warc.read(spark, folder).count()
    with pytest.raises(ValueError, match="ends inside"):
        list(warc.members(io.BytesIO(data[:-9])))
    _, whole = next(warc.members(io.BytesIO(data)))
    with pytest.raises(ValueError, match="block digest"):
        warc.parse(whole.replace(b"format", b"Format"))


def test_empty_table(spark):
    folder = scratch_path(spark, "warc")
    assert warc.write(_pages(spark, []), folder).count() == 0
    assert warc.read(spark, folder).count() == 0


def test_query_matches_sql(spark, sf_small):
    df = QUERIES["op11_warc"](spark, sf_small)
    assert df.count() == spark.read.parquet(f"{sf_small}/pages.parquet").count()
    cur = duck(sf_small).execute(ORACLE["op11_warc"])
    assert digest([tuple(r) for r in df.collect()], df.columns) == digest(cur.fetchall(), [d[0] for d in cur.description])


def test_binary_search_of_parts(spark):
    borders = [(1, -5), (1, 7), (4, 0), (4, 0), (9, 3)]
    rows = spark.createDataFrame([(i, t) for i in (-3, 0, 1, 2, 4, 9, 10) for t in (-9, -5, 0, 3, 7, 8)],
                                 "id long, tie long").withColumn("part", warc._part(borders))
    for r in rows.collect():
        assert r["part"] == sum(b <= (r["id"], r["tie"]) for b in borders)
    assert spark.range(3).withColumn("tie", F.lit(0)).select(warc._part([]).alias("p")).distinct().count() == 1
