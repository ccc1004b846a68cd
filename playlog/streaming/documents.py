"""Match documents while the log still arrives.

A feed is a log that is written line by line, in one folder of files that follow
each other by name. Its open match is the state of the stream: the next start
mark, or a pause of the feed, ends it, and its document goes out. The documents
are those that :mod:`playlog.operators.segments` makes of the whole log.

* :func:`read_feeds` gives the lines with their feed and physical place;
* :func:`live_documents` keeps one open match a feed (``applyInPandasWithState``).
  What is held is at most ``max_events`` lines: a longer match goes out in parts.
  A feed's state is one task's, so lines are not worked off there: before it,
  tasks cut blocks of lines at the marks and pack them; the state numbers the
  matches and hands the packed lines on; behind it, tasks make the documents;
* :func:`write_documents` publishes each micro-batch as a load of a table
  (:mod:`playlog.sources.loads`), so a batch that runs again changes nothing.

A line that arrives after a later one of its feed was read, or after a pause has
ended its match, is late. It is counted (rows of kind ``late``) and not stored.
"""

from __future__ import annotations

import base64
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming.state import GroupStateTimeout

from playlog import schemas
from playlog.operators.parse import parse_log
from playlog.operators.roster import resolve_players
from playlog.operators.segments import FIRST_LINE
from playlog.sources import loads as L
from playlog.streaming.live import static_roster

PLACE = ("feed", "log_split", "log_row")
DOCUMENT = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("feed", T.StringType()),
    *schemas.MATCH.fields, T.StructField("late", T.LongType())])
_REPORT = [f.name for f in schemas.REPORT_EVENT.fields]
_STATE = T.StructType([
    T.StructField("split", T.StringType()), T.StructField("row", T.LongType()),     # last line that was read
    T.StructField("seq", T.LongType()), T.StructField("part", T.IntegerType()),     # matches begun, parts sent
    T.StructField("home", T.IntegerType()), T.StructField("away", T.IntegerType()),
    T.StructField("mark", T.StringType()), T.StructField("held", T.StringType())])  # open match (null: none), its lines

# Lines of one split that are packed together.
BLOCK_LINES = 8192
# A packed line.
_LINE = pa.schema([
    ("log_row", pa.int64()), ("line_no", pa.int32()),
    *[(c, pa.string()) for c in ("game_id", "date", "home", "away", "time_remaining", "entry", "type", "player")],
    ("score_home_token", pa.int32()), ("score_away_token", pa.int32())])
_MARK = ("game_id", "date", "home", "away")
_CODEC = "zstd"
# A block: lines before its first mark (head), whole matches (middle), lines from its last mark on (tail). The last
# score tokens of head and tail, and what the last mark says, are all of the lines that the state looks at.
_BLOCK = T.StructType([
    T.StructField("feed", T.StringType()), T.StructField("log_split", T.StringType()),
    T.StructField("first", T.LongType()), T.StructField("last", T.LongType()),
    T.StructField("head", T.BinaryType()), T.StructField("head_lines", T.IntegerType()),
    T.StructField("head_home", T.IntegerType()), T.StructField("head_away", T.IntegerType()),
    T.StructField("middle", T.BinaryType()), T.StructField("middle_lines", T.IntegerType()),
    T.StructField("middle_matches", T.IntegerType()),
    T.StructField("tail", T.BinaryType()), T.StructField("tail_lines", T.IntegerType()),
    T.StructField("tail_home", T.IntegerType()), T.StructField("tail_away", T.IntegerType()),
    *[T.StructField(c, T.StringType()) for c in _MARK]])
# A run of packed lines that become documents: ``lines`` of them after ``skip``; number, mark, part and scores are
# those before the run's first line, and each mark in it begins the next match.
_RUN = T.StructType([
    T.StructField("kind", T.StringType()), T.StructField("feed", T.StringType()), T.StructField("seq", T.LongType()),
    *[T.StructField(c, T.StringType()) for c in _MARK], T.StructField("part", T.IntegerType()),
    T.StructField("score_home", T.IntegerType()), T.StructField("score_away", T.IntegerType()),
    T.StructField("packed", T.ArrayType(T.BinaryType())), T.StructField("skip", T.LongType()),
    T.StructField("lines", T.LongType()), T.StructField("late", T.LongType())])


def folder_of(path: str | Column) -> Column:
    """The folder of a file: the feed that it belongs to."""
    return F.regexp_replace(path, "/[^/]*$", "")


def read_feeds(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Lines of new files as a stream: ``value``, ``feed``, ``log_split``, ``log_row``.

    The line's number in its split is counted where the split is read, before
    anything moves. ``max_files_per_trigger`` bounds what a micro-batch holds.
    """
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    file = F.col("_metadata.file_path")
    split = F.concat(file, F.lit("\u0000"), F.lpad(F.col("_metadata.file_block_start").cast("string"), 19, "0"))
    lines = reader.load(path).select("value", folder_of(file).alias("feed"), split.alias("log_split"))
    out = T.StructType([*lines.schema.fields, T.StructField("log_row", T.LongType())])

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, n = None, 0
        for batch in batches:
            if not batch.num_rows:
                continue
            splits = batch.column(2).dictionary_encode(null_encoding="encode")
            code = splits.indices.to_numpy(zero_copy_only=False)
            starts = np.append(0, np.flatnonzero(code[1:] != code[:-1]) + 1)
            rows = np.arange(len(code)) - np.repeat(starts, np.diff(np.append(starts, len(code))))
            names = splits.dictionary.to_pylist()
            if names[code[0]] == last:
                rows[:starts[1] if len(starts) > 1 else None] += n
            last, n = names[code[-1]], int(rows[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(rows, pa.int64())], names=out.names)

    return lines.mapInArrow(number, out)


def pack(lines: pa.RecordBatch) -> bytes:
    """Lines (``_LINE``) as bytes, about a twentieth of their size: texts by their
    lengths and numbers by their steps, which repeat, then compressed."""
    parts = []
    for column in lines.columns:
        parts.append(np.packbits(column.is_null().to_numpy(zero_copy_only=False)).tobytes())
        if pa.types.is_string(column.type):
            text = column.fill_null("")
            ends = np.frombuffer(text.buffers()[1], np.int32)[text.offset:text.offset + len(text) + 1]
            parts += [np.diff(ends).tobytes(), memoryview(text.buffers()[2] or b"")[ends[0]:ends[-1]]]
        else:
            numbers = pc.fill_null_forward(column).fill_null(0).to_numpy().astype(np.int64)
            parts.append(np.diff(numbers, prepend=0).tobytes())
    raw = b"".join(parts)
    head = np.array([lines.num_rows, len(raw), *map(len, parts)], np.int64)
    return head.tobytes() + pa.Codec(_CODEC).compress(raw, asbytes=True)


def unpack(packed: bytes) -> pa.RecordBatch:
    head = np.frombuffer(packed, np.int64, 2 + sum(3 if pa.types.is_string(f.type) else 2 for f in _LINE))
    n, sizes = int(head[0]), head[2:].tolist()
    raw, at = pa.Codec(_CODEC).decompress(memoryview(packed)[head.nbytes:], int(head[1])), 0

    def part(kind: type) -> np.ndarray:
        nonlocal at
        size = sizes.pop(0)
        at += size
        return np.frombuffer(raw.slice(at - size, size), kind) if size else np.array([], kind)

    columns = []
    for f in _LINE:
        null = np.unpackbits(part(np.uint8), count=n).astype(bool)
        if pa.types.is_string(f.type):
            ends = np.append(0, np.cumsum(part(np.int32))).astype(np.int32)
            columns.append(pa.StringArray.from_buffers(n, pa.py_buffer(ends), pa.py_buffer(part(np.uint8)),
                                                       pa.py_buffer(np.packbits(~null, bitorder="little"))))
        else:
            columns.append(pa.array(np.cumsum(part(np.int64)), f.type, mask=null))
    return pa.RecordBatch.from_arrays(columns, schema=_LINE)


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(batches) == 1:
        return batches[0]
    whole = pa.Table.from_batches(batches, _LINE).combine_chunks().to_batches()
    return whole[0] if whole else pa.RecordBatch.from_pylist([], _LINE)


def _marks(lines: pa.RecordBatch) -> np.ndarray:
    """True where a line begins a match."""
    return lines.column("line_no").fill_null(0).to_numpy(zero_copy_only=False) == FIRST_LINE


def _last(tokens: pa.Array) -> int | None:
    """The last token that is there."""
    found = tokens.drop_null()
    return found[-1].as_py() if len(found) else None


def _scores(tokens: pa.Array, begins: np.ndarray, before: int) -> np.ndarray:
    """At each line the last token since its match began, in place of none 0, or
    ``before`` in the match that was open before the lines. ``begins``: where the
    line's match begins, -1 if before the lines."""
    at = np.maximum.accumulate(np.where(tokens.is_valid().to_numpy(zero_copy_only=False), np.arange(len(tokens)), -1))
    own = at >= np.maximum(begins, 0)
    value = tokens.fill_null(0).to_numpy(zero_copy_only=False)[np.maximum(at, 0)]
    return np.where(own, value, np.where(begins < 0, before, 0)).astype(np.int32)


def _begins(marks: np.ndarray) -> np.ndarray:
    """For each line the place of its match's mark, -1 if that came before."""
    return np.maximum.accumulate(np.where(marks, np.arange(len(marks)), -1))


def _block(lines: pa.RecordBatch) -> dict:
    """A block of lines of one split, in order, cut at its marks."""
    rows, at = lines.column("log_row"), np.flatnonzero(_marks(lines))
    first, last = (int(at[0]), int(at[-1])) if len(at) else (lines.num_rows, lines.num_rows)
    out = {"first": rows[0].as_py(), "last": rows[-1].as_py()}
    for name, some in (("head", lines.slice(0, first)), ("middle", lines.slice(first, last - first)),
                       ("tail", lines.slice(last))):
        out |= {name: pack(some) if some.num_rows else None, f"{name}_lines": some.num_rows}
        if name == "middle":
            out["middle_matches"] = max(0, len(at) - 1)
        else:
            out |= {f"{name}_{side}": _last(some.column(f"score_{side}_token")) for side in ("home", "away")}
    return out | {c: lines.column(c)[last].as_py() if len(at) else None for c in _MARK}


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of the lines of a partition (feed, split, then ``_LINE``), which come in any order."""
    known, codes, kept = {}, [], []
    for batch in batches:
        if not batch.num_rows:
            continue
        feed, split = (batch.column(i).dictionary_encode(null_encoding="encode") for i in range(2))
        feeds, splits = feed.dictionary.to_pylist(), split.dictionary.to_pylist()
        pair = feed.indices.to_numpy(zero_copy_only=False) * np.int64(len(splits)) + split.indices.to_numpy(zero_copy_only=False)
        each, place = np.unique(pair, return_inverse=True)
        code = [known.setdefault((feeds[x // len(splits)], splits[x % len(splits)]), len(known)) for x in each.tolist()]
        codes.append(np.array(code)[place])
        kept.append(pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns[2:], _LINE)], schema=_LINE))
    if not kept:
        return
    code, lines = np.concatenate(codes), pa.Table.from_batches(kept)
    row = lines.column("log_row").to_numpy()
    order = np.lexsort((row, code))
    code, row, kept = code[order], row[order], None
    lines, names = lines.take(pa.array(order)), list(known)
    cuts = np.flatnonzero((code[1:] != code[:-1]) | (row[1:] // BLOCK_LINES != row[:-1] // BLOCK_LINES)) + 1
    schema, found, size = to_arrow_schema(_BLOCK), [], 0
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(code)]):
        feed, split = names[code[a]]
        found.append({"feed": feed, "log_split": split} | _block(_joined(lines.slice(a, b - a).to_batches())))
        size += sum(len(found[-1][c] or b"") for c in ("head", "middle", "tail"))
        if size > 1 << 22 or len(found) >= 1000:
            yield pa.RecordBatch.from_pylist(found, schema)
            found, size = [], 0
    if found:
        yield pa.RecordBatch.from_pylist(found, schema)


def _int(v) -> int | None:
    return None if v is None or pd.isna(v) else int(v)


class _Feed:
    """One feed's state while the blocks of a micro-batch are taken in."""

    def __init__(self, feed: str, state: tuple | None, max_events: int):
        self.feed, self.max_events, self.out, self.late = feed, max_events, [], 0
        split, row, self.seq, self.part, self.home, self.away, mark, held = state or ("", -1, 0, 0, 0, 0, None, "[]")
        self.place, self.mark = (split, row), None if mark is None else json.loads(mark)
        # packed lines of the open match: bytes, lines, scores before them, whether they begin with the mark;
        # the first ``skip`` lines of them have gone out
        held, self.skip = json.loads(held), 0
        if held and isinstance(held[0], dict):
            lines = self.kept_events(held)
            self.held = [(pack(lines), len(held), 0, 0, bool(_marks(lines)[0]))]
        else:
            self.held = [(base64.b64decode(x), *rest) for x, *rest in held]

    def kept_events(self, held: list[dict]) -> pa.RecordBatch:
        """Lines of the events that a state holds which was written before lines were packed."""
        return pa.RecordBatch.from_pylist([{
            "line_no": None if e["idLineEvent"] is None else int(e["idLineEvent"]), "game_id": self.mark[0], "date": self.mark[1],
            "time_remaining": e["timeRemaining"], "player": e["playerName"], "score_home_token": e["scoreHome"],
            "score_away_token": e["scoreAway"]} | {c: e[c] for c in ("home", "away", "entry", "type")} for e in held], _LINE)

    def state(self) -> tuple:
        if self.skip:  # lines that have gone out don't stay
            packed, n, home, away, _ = self.held[0]
            lines, k = unpack(packed), self.skip
            home, away = (int(_scores(lines.column(f"score_{side}_token"), _begins(_marks(lines)), before)[k - 1])
                          for side, before in (("home", home), ("away", away)))
            self.held[0], self.skip = (pack(lines.slice(k)), n - k, home, away, False), 0
        held = [(base64.b64encode(x).decode(), *rest) for x, *rest in self.held]
        return (*self.place, self.seq, self.part, self.home, self.away,
                None if self.mark is None else json.dumps(self.mark), json.dumps(held))

    def run(self, seq: int, mark, part: int, home: int, away: int, packed: list[bytes], skip: int, lines: int) -> None:
        self.out.append(("match", self.feed, seq, *mark, part, home, away, packed, skip, lines, None))

    def send(self, lines: int) -> None:
        """The next lines of the open match go out, in parts of ``max_events``."""
        packed, total = [], self.skip + lines
        _, _, home, away, marked = self.held[0]
        skip, n = self.skip, 0
        while n < total:
            packed.append(self.held[0][0])
            n += self.held[0][1]
            self.skip = self.held[0][1] - max(0, n - total)
            if n <= total:
                self.held.pop(0)
                self.skip = 0
        self.run(self.seq - marked, self.mark, self.part, home, away, packed, skip, lines)
        self.part += -(-lines // self.max_events)

    def waiting(self) -> int:
        return sum(x[1] for x in self.held) - self.skip

    def end(self) -> None:
        if self.mark is not None and self.held:
            self.send(self.waiting())
        self.mark, self.part = None, 0

    def add(self, packed: bytes, lines: int, home: int | None, away: int | None, marked: bool) -> None:
        """Lines of the open match; ``home``, ``away``: their last score tokens."""
        self.held.append((packed, lines, self.home, self.away, marked))
        self.home, self.away = self.home if home is None else home, self.away if away is None else away
        if whole := self.waiting() // self.max_events * self.max_events:
            self.send(whole)

    def block(self, r: dict) -> None:
        split, first, last = r["log_split"], int(r["first"]), int(r["last"])
        if (split, first) <= self.place:
            lines = _joined([unpack(r[x]) for x in ("head", "middle", "tail") if r[x] is not None])
            read = int((lines.column("log_row").to_numpy() <= self.place[1]).sum()) if (split, last) > self.place else len(lines)
            self.late += read
            if read == len(lines):
                return
            r = _block(lines.slice(read))
        n, head = int(r["head_lines"]), r["head"]
        if n and self.mark is None and self.seq:
            self.late += n  # a pause has ended their match
        elif n:
            self.place = (split, last)
            if self.mark is not None:  # else a heading before the feed's first match
                self.add(head, n, _int(r["head_home"]), _int(r["head_away"]), False)
        if r["tail"] is None:
            return
        self.place = (split, last)
        self.end()
        if n := int(r["middle_lines"]):
            self.run(self.seq, [None] * len(_MARK), 0, 0, 0, [r["middle"]], 0, n)
            self.seq += int(r["middle_matches"])
        self.seq, self.home, self.away = self.seq + 1, 0, 0
        self.mark = [r[c] for c in _MARK]
        self.add(r["tail"], int(r["tail_lines"]), _int(r["tail_home"]), _int(r["tail_away"]), True)

    def frames(self, most: int = 64) -> Iterator[pd.DataFrame]:
        if self.late:
            self.out.append(("late", self.feed, *[None] * (len(_RUN) - 3), self.late))
        for at in range(0, len(self.out), most):
            frame = pd.DataFrame(self.out[at:at + most], columns=_RUN.names, dtype=object)
            yield frame.astype({f.name: "Int64" if isinstance(f.dataType, T.LongType) else "Int32" for f in _RUN
                                if isinstance(f.dataType, T.LongType | T.IntegerType)})


def _documents_of(run: dict, max_events: int, schema: pa.Schema) -> pa.RecordBatch:
    """The documents of a run (``_RUN``), columns of ``DOCUMENT``."""
    lines = _joined([unpack(x) for x in run["packed"]])
    marks = _marks(lines)
    begins, nth = _begins(marks), np.cumsum(marks)
    scores = [_scores(lines.column(f"score_{side}_token"), begins, run[f"score_{side}"]) for side in ("home", "away")]
    mine = slice(run["skip"], run["skip"] + run["lines"])
    at = np.arange(lines.num_rows)[mine]
    start = np.maximum(begins[mine], run["skip"])
    # lines that have gone out are of the first match alone
    part = (at - start) // max_events + np.where(start == run["skip"], run["part"], 0)
    new = np.ones(len(at), bool)
    new[1:] = (part[1:] != part[:-1]) | (start[1:] != start[:-1])
    first = np.flatnonzero(new)

    def of_match(c):
        mark = begins[mine][first]
        own = lines.column(c).take(pa.array(np.maximum(mark, 0)))
        return pc.if_else(pa.array(mark >= 0), own, pa.scalar(run[c], pa.string()))

    out, count = lines.slice(run["skip"], run["lines"]), len(first)
    event = {"idLineEvent": out.column("line_no").cast(pa.string()), "timeRemaining": out.column("time_remaining"),
             "playerName": out.column("player"), "scoreHome": pa.array(scores[0][mine]), "scoreAway": pa.array(scores[1][mine]),
             **{c: out.column(c) for c in ("type", "home", "away", "entry")}}
    kind = schema.field("report").type
    report = pa.ListArray.from_arrays(pa.array(np.append(first, len(at)), pa.int32()), pa.StructArray.from_arrays(
        [event[f] for f in _REPORT], fields=list(kind.value_type)))
    columns = {"kind": pa.array(["match"] * count), "feed": pa.array([run["feed"]] * count, pa.string()),
               "id_match": pa.array(run["seq"] + nth[mine][first], pa.int64()), "part": pa.array(part[first], pa.int32()),
               "report": report, "late": pa.nulls(count, pa.int64()), **{c: of_match(c) for c in _MARK}}
    return pa.RecordBatch.from_arrays([columns[f.name] for f in schema], schema=schema)


def live_documents(lines: DataFrame, roster: DataFrame, max_events: int, pause: str | None = None) -> DataFrame:
    """Documents of the matches that have ended (columns of ``DOCUMENT``).

    ``lines`` as :func:`read_feeds` gives them. ``id_match`` counts a feed's
    matches from 1. ``pause`` (milliseconds as text, or an interval such as
    ``"10 minutes"``): a feed that brings no line for so long has ended its match;
    without it the last match of a feed stays open until the next mark.
    """
    wait = None if pause is None else int(pd.Timedelta(pause).total_seconds() * 1000)
    events = resolve_players(parse_log(lines, keep=PLACE), static_roster(roster)).select(
        *PLACE, "line_no", "game_id", "date", "home", "away", "time_remaining", "entry", "type", "score_home_token",
        "score_away_token", "player")

    lines = events.select("feed", "log_split", *[F.col(f.name).cast("int") if f.type == pa.int32() else f.name for f in _LINE])
    block = F.floor(F.col("log_row") / BLOCK_LINES)
    # the state's key stays as it is in checkpoints, null or not
    kind = T.StructType([lines.schema["feed"], *_BLOCK.fields[1:]])
    blocks = lines.repartition("feed", "log_split", block).mapInArrow(_blocks, kind)

    def step(key, frames: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        feed = _Feed(key[0], state.get if state.exists else None, max_events)
        if state.hasTimedOut:
            feed.end()
        else:
            batch = [r for frame in frames for r in frame.astype(object).where(frame.notna(), None).to_dict("records")]
            for r in sorted(batch, key=lambda r: (r["log_split"], r["first"])):
                feed.block(r)
        state.update(feed.state())
        if wait is not None and feed.mark is not None:
            state.setTimeoutDuration(wait)
        yield from feed.frames()

    def documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = to_arrow_schema(DOCUMENT)
        for batch in batches:
            for i in range(batch.num_rows):
                run, = batch.slice(i, 1).to_pylist()
                if run["kind"] == "match":
                    yield _documents_of(run, max_events, schema)
                else:
                    yield pa.RecordBatch.from_pylist([{c: run[c] for c in ("kind", "feed", "late")}], schema)

    timeout = GroupStateTimeout.NoTimeout if wait is None else GroupStateTimeout.ProcessingTimeTimeout
    runs = blocks.groupBy("feed").applyInPandasWithState(step, _RUN, _STATE, "append", timeout)
    # a computed column: rows straight from the state can't be shuffled
    dealt = runs.withColumn("_pl_to", F.hash("feed", "seq", "part")).repartition("_pl_to")
    return dealt.mapInArrow(documents, DOCUMENT)


def write_documents(documents: DataFrame, table: str, checkpoint: str, available_now: bool = False):
    """Start a stream that publishes the documents of each micro-batch as a load of ``table``."""
    def publish(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession

        def build(key: str) -> int:
            L.write_part(batch, table, "documents", key)
            return 0

        L.append_load(spark, table, f"batch-{number:012d}", str(number), build)

    writer = documents.writeStream.foreachBatch(publish).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def read_documents(spark: SparkSession, table: str) -> DataFrame:
    """Documents and late counts published so far."""
    return L.read_part(spark, table, "documents", DOCUMENT).drop("load")
