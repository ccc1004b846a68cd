"""One top-level JSON array of documents, read and written in parallel.

The array may be one file or several that follow each other by name (each but the
last ends with the comma after a document). A file that
is one long line can't be cut at line ends, so it is read in pieces that end at
each ``}`` (a record separator, so input splits work as with lines), and the
structure is found by running sums over the pieces:

1. a piece's quotes (escapes aside) tell whether it changes between inside and
   outside of a string; the running count of quotes gives the state in which each
   piece begins, also across splits and files;
2. with that state known, the brackets outside of strings give the running depth;
3. a ``}`` outside of strings that returns to the depth of the array ends a
   document. Pieces are numbered by the ends before them and put together.

Only small numbers take part in the sums; the text moves once to meet its
document number and once to be put together. ``}`` or ``],`` inside a text is
part of it. Input that is no array of objects, or is cut off, raises an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlog.operators.sequence import prefix_within

_END = "}"
# what may stand after the last document of a file, without white space
_BETWEEN = ("", ",", "]", "[", "[]")


def _count(c: Column, symbol: str) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit(symbol), F.lit("")))


def _opened(text: Column) -> Column:
    """Brackets opened less those closed outside of strings, of text that begins outside."""
    outside = F.regexp_replace(F.regexp_replace(text, '"[^"]*"', ""), '"[^"]*$', "")
    return _count(outside, "{") + _count(outside, "[") - _count(outside, "]")


def _pieces(spark: SparkSession, path: str | list[str]) -> DataFrame:
    place = F.concat(F.col("_metadata.file_path"), F.lit("\u0000"),
                     F.lpad(F.col("_metadata.file_block_start").cast("string"), 19, "0"))
    return spark.read.option("lineSep", _END).text(path).select(
        "value", place.alias("split"), F.monotonically_increasing_id().alias("row"))


def read_texts(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The array's documents as JSON texts: ``no`` (place in the array, from 0), ``value``."""
    pieces = _pieces(spark, path)
    bare = F.regexp_replace("value", r"\\.", "")  # without escaped characters
    shape = pieces.select(
        "split", "row", F.split_part("split", F.lit("\u0000"), F.lit(1)).alias("file"), _count(bare, '"').alias("quotes"),
        _opened(bare).alias("from_outside"), _opened(F.concat(F.lit('"'), bare)).alias("from_inside"),
        F.regexp_replace("value", r"\s+", "").isin(*_BETWEEN).alias("between"))
    # no separator comes after the last piece of a file
    last = shape.groupBy("file").agg(F.max(F.struct("split", "row")).alias("e")).select("e.split", "e.row", F.lit(True)
                                                                                       .alias("last"))
    shape = shape.join(last, ["split", "row"], "left").withColumn(
        "tail", F.col("between") & F.coalesce("last", F.lit(False))).drop("file", "between", "last")
    order = ["row"]
    quoted = prefix_within(shape, [], order, F.col("split"), sums={"seen": F.col("quotes")})
    begins_inside = (F.col("seen") - F.col("quotes")) % 2 == 1
    ends_outside = F.col("seen") % 2 == 0
    step = F.when(begins_inside, F.col("from_inside")).otherwise(F.col("from_outside"))
    closes = (ends_outside & ~F.col("tail")).cast("int")
    stepped = quoted.select("split", "row", "tail", closes.alias("closes"), (step - closes).alias("step"))
    deep = prefix_within(stepped, [], order, F.col("split"), sums={"depth": F.col("step")})
    ends = ((F.col("closes") == 1) & (F.col("depth") == 1)).cast("int")
    numbered = prefix_within(deep.withColumn("ends", ends), [], order, F.col("split"), sums={"done": F.col("ends")})
    no = (F.col("done") - F.col("ends")).cast("long")
    inside = numbered.filter(~F.col("tail")).select("split", "row", no.alias("no"), "ends")

    texts = pieces.join(inside, ["split", "row"]).groupBy("no").agg(
        F.sort_array(F.collect_list(F.struct("split", "row", "value"))).alias("p"), F.max("ends").alias("whole"))
    joined = F.concat(F.array_join(F.transform("p", lambda x: x["value"]), _END), F.lit(_END))
    # what stands before a document: the array's bracket, or the comma after the one before
    body = F.regexp_replace(joined, r"^\s*[\[,]?\s*", "")
    ok = (F.col("whole") == 1) & F.startswith(body, F.lit("{"))
    error = F.raise_error(F.concat(F.lit("no array of JSON objects, or cut off: "), F.substring(body, 1, 40)))
    found = texts.select("no", F.when(ok, body).otherwise(error).alias("value"))
    # the last piece must be the array's closing bracket, back at depth 0; adds no row
    end = numbered.agg(F.max_by(F.struct("tail", "depth"), F.struct("split", "row")).alias("e"))
    bad = ~(F.col("e.tail") & (F.col("e.depth") == 0))
    check = F.when(bad, F.raise_error(F.lit("no array of JSON objects, or cut off: its closing bracket is missing")
                                      ).cast("string"))
    return found.unionByName(end.select(F.lit(0).cast("long").alias("no"), check.alias("value")).filter("value is not null"))


def read_array(spark: SparkSession, path: str | list[str], schema: T.StructType) -> DataFrame:
    """The array's documents as rows of ``schema``."""
    return read_texts(spark, path).select(F.from_json("value", schema, {"mode": "FAILFAST"}).alias("d")).select("d.*")


def write_array(docs: DataFrame, path: str, order: list[str], files: int | None = None, mode: str = "overwrite") -> None:
    """Write documents as one JSON array: files whose texts, one after the other by
    name, are the array, in the order of the columns ``order`` (together unique).

    Every task writes its range of the order; the first document gets the bracket
    before it, the last the one after it. No documents: ``[]``."""
    spark = docs.sparkSession
    key = F.struct(*order)
    first, last = docs.agg(F.min(key), F.max(key)).first()
    if first is None:
        spark.createDataFrame([("[]",)], "value string").coalesce(1).write.mode(mode).text(path)
        return

    def at(row) -> Column:
        return F.lit(True) if not order else _all([F.col(c).eqNullSafe(F.lit(row[c])) for c in order])

    text = F.concat(F.when(at(first), F.lit("[")).otherwise(F.lit("")), F.to_json(F.struct(*docs.columns)),
                    F.when(at(last), F.lit("]")).otherwise(F.lit(",")))
    n = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    (docs.repartitionByRange(n, *order).sortWithinPartitions(*order).select(text.alias("value"))
     .write.mode(mode).text(path))


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out
