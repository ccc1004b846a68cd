"""Tables that grow by loads, each published once.

A load writes its files into a folder of its own, which nobody reads yet, and is
then published by one small file: the next version of the table's list of loads.
That file is made by a rename that fails where the name is taken, so of two
writers one gets the version and the other looks again. Hence

* a job that dies before it publishes changes nothing; its folder is never read
  (``remove_unlisted`` deletes such folders);
* a load that is repeated under its name is recognised, by the fingerprint of
  what was loaded, and changes nothing; other contents under the same name are
  an error, or replace the load where the caller says so;
* ids are given out with the version: rows hold ids from 1 within their load, the
  list holds how many ids come before, and readers add the two. Nothing is
  rewritten where another load was published meanwhile.

    <table>/loads/<version>.json           the loads of a version, one a line
    <table>/<part>/load=<name>~<attempt>/  what a load wrote (events, metrics ...)

The store must have a rename that fails on an existing target (HDFS, local and
most shared file systems; an object store needs a committer that has one).
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable
from dataclasses import asdict, dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlog.operators.joins import lookup_join
from playlog.session import _file_system

_VERSION = re.compile(r"^(\d{12})\.json$")


class LoadConflict(ValueError):
    """The name of a load is taken by other contents."""


@dataclass(frozen=True)
class Load:
    """A published load: its ids are ``first_id + 1`` to ``first_id + ids``."""

    name: str
    fingerprint: str
    key: str
    first_id: int
    ids: int
    reserved: int


def content_fingerprint(lines: DataFrame) -> str:
    """Of the rows of a DataFrame, whatever their order and files: count and two sums of hashes."""
    values = [F.to_json(F.struct(*[F.col(f"`{c}`") for c in lines.columns]))]
    r = lines.select(F.xxhash64(*values).alias("a"), F.xxhash64(F.lit("#"), *values).alias("b")).agg(
        F.count(F.lit(1)), F.sum(F.col("a").cast("decimal(38,0)")), F.sum(F.col("b").cast("decimal(38,0)"))).first()
    return ":".join(str(x) for x in r)


def _names(spark: SparkSession, folder: str) -> list[str]:
    fs, p = _file_system(spark, folder)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _read(spark: SparkSession, path: str) -> str:
    fs, p = _file_system(spark, path)
    stream = fs.open(p)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def current(spark: SparkSession, table: str) -> tuple[int, list[Load]]:
    """Latest version of a table (0: none yet) and its loads."""
    versions = [int(m[1]) for n in _names(spark, f"{table}/loads") if (m := _VERSION.match(n))]
    if not versions:
        return 0, []
    text = _read(spark, f"{table}/loads/{max(versions):012d}.json")
    return max(versions), [Load(**json.loads(x)) for x in text.splitlines()]


def _publish(spark: SparkSession, table: str, version: int, loads: list[Load]) -> bool:
    """Make ``version`` the table's; false where another writer has taken it."""
    target = f"{table}/loads/{version:012d}.json"
    fs, aside = _file_system(spark, f"{table}/loads/.{version:012d}-{uuid.uuid4().hex}")
    stream = fs.create(aside, False)
    stream.write("".join(json.dumps(asdict(x)) + "\n" for x in loads).encode())
    stream.close()
    sc = spark.sparkContext
    fc = sc._jvm.org.apache.hadoop.fs
    context = fc.FileContext.getFileContext(fs.getUri(), sc._jsc.hadoopConfiguration())
    how = sc._gateway.new_array(getattr(fc, "Options$Rename"), 0)  # no overwriting
    try:
        context.rename(fs.makeQualified(aside), fs.makeQualified(_file_system(spark, target)[1]), how)
    except Exception:
        if fs.exists(_file_system(spark, target)[1]):
            fs.delete(aside, False)
            return False
        raise
    return True


def append_load(spark: SparkSession, table: str, name: str, fingerprint: str, build: Callable[[str], int],
                replacing: bool = False) -> Load:
    """Write a load and publish it; a load that is published already is returned as it is.

    ``build(key)`` writes the load's parts with :func:`write_part` and returns
    how many ids it used. With ``replacing`` other contents take the place of the
    load of that name: its ids are kept if they suffice, else it gets new ones.
    """
    table = table.rstrip("/")

    def known(loads: list[Load]) -> Load | None:
        same = next((x for x in loads if x.name == name), None)
        if same and same.fingerprint != fingerprint and not replacing:
            raise LoadConflict(f"load {name!r} was published with other contents")
        return same if same and same.fingerprint == fingerprint else None

    if done := known(current(spark, table)[1]):
        return done
    key = f"{re.sub('[^A-Za-z0-9_.-]', '_', name)}~{uuid.uuid4().hex}"
    ids = int(build(key))
    while True:
        version, loads = current(spark, table)
        if done := known(loads):  # the same load was published meanwhile
            return done
        old = next((x for x in loads if x.name == name), None)
        new = Load(name, fingerprint, key, max((x.first_id + x.reserved for x in loads), default=0), ids, ids)
        if old and old.reserved >= ids:
            new = replace(new, first_id=old.first_id, reserved=old.reserved)
        if _publish(spark, table, version + 1, [x for x in loads if x.name != name] + [new]):
            return new


def write_part(df: DataFrame, table: str, part: str, key: str, partition_by: tuple[str, ...] = ()) -> str:
    """One part of a load that is being built; gives its folder."""
    path = f"{table.rstrip('/')}/{part}/load={key}"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
    return path


def read_part(spark: SparkSession, table: str, part: str, schema: T.StructType, version: int | None = None,
              id_col: str | None = None, names: list[str] | None = None) -> DataFrame:
    """A part of all published loads (of an earlier ``version``, or of the loads
    ``names`` only), with column ``load``. ``id_col``: the column to which the ids
    before its load are added."""
    table = table.rstrip("/")
    if version is None:
        version, loads = current(spark, table)
    else:
        text = _read(spark, f"{table}/loads/{version:012d}.json") if version else ""
        loads = [Load(**json.loads(x)) for x in text.splitlines()]
    loads = [x for x in loads if names is None or x.name in names]
    full = T.StructType([*schema.fields, T.StructField("load", T.StringType())])
    if not loads:
        return spark.createDataFrame([], full)
    rows = (spark.read.schema(full).option("basePath", f"{table}/{part}")
            .parquet(*[f"{table}/{part}/load={x.key}" for x in loads]))
    if id_col is None:
        return rows
    before = spark.createDataFrame([(x.key, x.first_id) for x in loads], "load string, _pl_before long")
    return lookup_join(rows, before, ["load"]).withColumn(
        id_col, F.col(id_col) + F.col("_pl_before")).select(*full.names)


def remove_unlisted(spark: SparkSession, table: str, part: str) -> list[str]:
    """Delete what dead or replaced loads left of a part. Call it when no load is
    being written and nobody reads an earlier version."""
    kept = {f"load={x.key}" for x in current(spark, table)[1]}
    gone = [n for n in _names(spark, f"{table}/{part}") if n.startswith("load=") and n not in kept]
    for n in gone:
        fs, p = _file_system(spark, f"{table}/{part}/{n}")
        fs.delete(p, True)
    return gone
