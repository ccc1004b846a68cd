"""Exact removal of repeated passages with a logarithmic family of suffix arrays.

A byte goes if it lies in any ``length``-byte string that starts at two or
more places of the corpus. Suffixes are sampled by content: of the GRAM-byte
strings of a window the one with the smallest fingerprint is its anchor, so
equal windows have equal anchors and only suffixes at anchors need an entry
(about one in 85 bytes). Consecutive windows with one anchor make an entry; its
class is a fingerprint of all its bytes, first window to last.

A level of the family is a sparse suffix array: the entries sorted by anchor
fingerprint, then class, one representative a class. A new batch of documents
is sorted the same way and merge-scanned against all levels in one pass.
Entries of one class are long matches at once. Where one anchor has several
classes the texts around it may still share windows; those classes become
candidates. The same pass writes the batch's own level; as with the digits of
a binary counter, levels of equal size merge geometrically as they go by.

After the last batch the candidates fetch their bytes from the documents, and
within an anchor all windows are compared by a 64-bit fingerprint besides the
64 bits of the anchor. Anchors with very many candidates are compared window
by window, dealt by window fingerprint, so no group must fit one task.

Results for odd input: null and empty texts have no bytes and keep none; a
text shorter than ``length`` keeps all. Repeated rows are occurrences of their
own, so both lose what they share. Runs of one byte or a short period count
every start as a place. An empty table gives an empty result.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlog.llm import common as C
from playlog.session import scratch_path

LENGTH = 200
GRAM = 32
PIECE = 1 << 20  # bytes whose fingerprints are computed at once
MANY = 4096  # candidates of one anchor that one task compares together
ONE_ANCHOR = 500_000  # entries of one anchor that one task holds at once
_U = np.uint64
_ODD = 0x9E3779B97F4A7C15
_INVERSE = pow(_ODD, -1, 1 << 64)
ENTRY, NEED, MARK = 0, 1, 2


@lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse, modulo 2**64."""
    up, down = np.full(n, _ODD, _U), np.full(n, _INVERSE, _U)
    up[0] = down[0] = 1
    return np.cumprod(up), np.cumprod(down)


def _mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> _U(32))
    h = h * _U(0xD6E8FEB86659FD93)
    h ^= h >> _U(29)
    h *= _U(0xBF58476D1CE4E5B9)
    return h ^ (h >> _U(32))


def fingerprints(x: np.ndarray, *sizes: int) -> list[np.ndarray]:
    """For each size the 64-bit fingerprints of all strings of that many bytes
    (none where ``x`` is shorter), by one running sum."""
    up, down = _powers(1 << max(PIECE + LENGTH, len(x)).bit_length())
    run = np.zeros(len(x) + 1, _U)
    np.cumsum((x.astype(_U) + _U(1)) * up[:len(x)], out=run[1:])
    return [_mix((run[n:] - run[:-n]) * down[:len(x) - n + 1]) if len(x) >= n else np.zeros(0, _U) for n in sizes]


def _lowest(g: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values."""
    n = len(g) - width + 1
    if n <= 0:
        return np.zeros(0, _U)
    rows = np.concatenate([g, np.full(-len(g) % width, np.iinfo(_U).max, _U)]).reshape(-1, width)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def _runs(flags: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[start, stop) of the runs of True."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[::2], edge[1::2]


def _joined(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of each text with those that touch made one."""
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    reach = np.maximum.accumulate(stop + (doc << 44))  # texts are shorter than 2**44
    new = np.ones(len(doc), bool)
    new[1:] = start[1:] + (doc[1:] << 44) > reach[:-1]
    first = np.flatnonzero(new)
    return doc[first], start[first], np.maximum.reduceat(stop, first) if len(first) else stop


def _pieces(bodies: list[bytes]):
    """Lists of (text number, offset, bytes) of about PIECE bytes; a longer
    text is cut with an overlap, so each window lies in one piece."""
    held, size = [], 0
    for i, b in enumerate(bodies):
        for at in range(0, max(1, len(b) - LENGTH + 1), PIECE):
            if len(b) < LENGTH:
                break
            part = b[at:at + PIECE + LENGTH - 1]
            if held and size + len(part) > PIECE:
                yield held
                held, size = [], 0
            held.append((i, at, part))
            size += len(part)
    if held:
        yield held


class _Found:
    """Entries (anchor, class, text, window start, windows) and marks (text, start, stop) of some texts."""

    def __init__(self, bodies: list[bytes]):
        entries, marks = [], []
        for piece in _pieces(bodies):
            e, m = self._piece(piece)
            entries.append(e)
            marks.append(m)
        if not entries:
            entries, marks = [[np.zeros(0, _U)] * 2 + [np.zeros(0, np.int64)] * 3], [[np.zeros(0, np.int64)] * 3]
        key, cls, doc, at, n = (np.concatenate(x) for x in zip(*entries))
        # one representative a class; the others are long matches here already
        order = np.lexsort((cls, key))
        new = np.ones(len(order), bool)
        new[1:] = (key[order][1:] != key[order][:-1]) | (cls[order][1:] != cls[order][:-1])
        first = np.flatnonzero(new)
        count = np.diff(np.append(first, len(order)))
        again = np.repeat(count > 1, count)
        rep, more = order[first], order[again]
        self.key, self.cls, self.doc, self.at, self.n = key[rep], cls[rep], doc[rep], at[rep], n[rep]
        self.done = count > 1
        marks.append([doc[more], at[more], at[more] + n[more] - 1 + LENGTH])
        self.mark_doc, self.mark_at, self.mark_to = _joined(*(np.concatenate(x) for x in zip(*marks)))

    @staticmethod
    def _piece(piece):
        x = np.frombuffer(b"".join(b for _, _, b in piece), np.uint8)
        sizes = np.array([len(b) for _, _, b in piece])
        begin = np.cumsum(sizes) - sizes
        h, g = fingerprints(x, LENGTH, GRAM)
        low = _lowest(g, LENGTH - GRAM + 1)
        whole = np.ones(len(h), bool)
        for e in (begin + sizes)[:-1]:
            whole[max(0, e - LENGTH + 1):e] = False
        # windows that repeat inside the piece
        s = np.sort(h[whole])
        twice = np.unique(s[1:][s[1:] == s[:-1]])
        marks = [np.zeros(0, np.int64)] * 3
        if len(twice):
            place = np.minimum(np.searchsorted(twice, h), len(twice) - 1)
            a, b = _runs(whole & (twice[place] == h))
            owner = np.searchsorted(begin, a, side="right") - 1
            marks = [np.array([piece[i][0] for i in owner], np.int64),
                     a - begin[owner] + np.array([piece[i][1] for i in owner], np.int64),
                     b - 1 + LENGTH - begin[owner] + np.array([piece[i][1] for i in owner], np.int64)]
        # maximal runs of windows with one anchor, cut to the anchor's reach
        edge = np.ones(len(low), bool)
        edge[1:] = (low[1:] != low[:-1]) | (whole[1:] != whole[:-1])
        a = np.flatnonzero(edge)
        b = np.append(a[1:], len(low))
        a, b = a[whole[a]], b[whole[a]]
        reach = LENGTH - GRAM + 1
        parts = -(-(b - a) // reach)
        start = np.repeat(a, parts) + reach * (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts))
        stop = np.minimum(np.repeat(b, parts), start + reach)
        # a window starts anywhere, so the owner is the piece it starts in
        owner = np.searchsorted(begin, start, side="right") - 1
        cls = _mix(h[start] * _U(3) + h[stop - 1] * _U(0x2545F4914F6CDD1D) + (stop - start).astype(_U))
        doc = np.array([p[0] for p in piece], np.int64)[owner]
        offset = np.array([p[1] for p in piece], np.int64)[owner]
        return [low[start], cls, doc, start - begin[owner] + offset, stop - start], marks


def _identity(id_col: str, text: str) -> list[Column]:
    """r1, r2: a row by its id and text; rows alike in both share them."""
    i, t = F.col(id_col), F.col(text).cast("string")
    return [F.xxhash64(i.cast("string"), i.isNull()).alias("r1"), F.xxhash64(t, t.isNull()).alias("r2")]


_SCAN = [("tag", "int"), ("key", "long"), ("cls", "long"), ("r1", "long"), ("r2", "long"), ("at", "long"),
         ("n", "int"), ("done", "boolean"), ("origin", "int")]
NEW = 1 << 20  # origin of the batch's own entries


def _entries(docs: DataFrame) -> DataFrame:
    """Entries and local marks of documents (r1, r2, copies, body)."""
    out = [C.field(*f) for f in _SCAN]

    def rows(batch):
        for part in C.slices(batch, "body", 8 << 20):
            r1, r2 = (part.column(i).to_numpy() for i in range(2))
            f = _Found([b.as_py() for b in part.column(2)])
            e, m = len(f.key), len(f.mark_doc)
            # marks have no key of their own: any that spreads
            spread = _mix((r1[f.mark_doc] + f.mark_at).view(_U)).view(np.int64)
            yield {"tag": np.repeat([ENTRY, MARK], [e, m]), "key": np.concatenate([f.key.view(np.int64), spread]),
                   "cls": np.concatenate([f.cls.view(np.int64), f.mark_to]),
                   "r1": r1[np.concatenate([f.doc, f.mark_doc])], "r2": r2[np.concatenate([f.doc, f.mark_doc])],
                   "at": np.concatenate([f.at, f.mark_at]), "n": np.concatenate([f.n, np.zeros(m, np.int64)]),
                   "done": np.concatenate([f.done, np.zeros(m, bool)]), "origin": np.full(e + m, NEW)}

    return C.map_arrow(docs, rows, out)


def _scan(rows: DataFrame, merging: list[int]) -> DataFrame:
    """One pass over the entries of a batch and all levels, sorted by anchor
    and class. Gives the level that the batch and the levels in ``merging``
    become (ENTRY), the candidates (NEED; ``origin`` is 1 where an anchor has
    very many) and the long matches (MARK)."""
    dealt = rows.repartition("key").sortWithinPartitions("key", "tag", "cls", "origin")
    kept = np.array([*merging, NEW])

    def closed(c, forced):
        """What whole anchors give. c: columns by name."""
        key, cls, origin = c["key"], c["cls"], c["origin"]
        entry = c["tag"] == ENTRY
        marks = {k: v[~entry] for k, v in c.items()}
        c = {k: v[entry] for k, v in c.items()}
        key, cls, origin, n = c["key"], c["cls"], c["origin"], int(entry.sum())
        if not n:
            return [marks]
        new_key = np.append(True, key[1:] != key[:-1])
        new_cls = new_key | np.append(True, cls[1:] != cls[:-1])
        first = np.flatnonzero(new_cls)
        of_cls, of_key = np.cumsum(new_cls) - 1, np.cumsum(new_key) - 1
        done = np.maximum.reduceat(c["done"], first) | (np.diff(np.append(first, n)) > 1)
        fresh = np.maximum.reduceat(origin == NEW, np.flatnonzero(new_key))
        classes = np.bincount(of_key[first])
        out = [marks]
        # entries of a class that met another: long matches
        hit = done[of_cls] & ~c["done"]
        out.append({k: v[hit] for k, v in c.items()} | {
            "tag": np.full(hit.sum(), MARK), "cls": (c["at"] + c["n"] - 1 + LENGTH)[hit], "key": c["key"][hit]})
        # anchors with several classes, at least one of them new
        part = key[first] == forced if forced is not None else np.zeros(len(first), bool)
        need = ((classes > 1) & fresh)[of_key[first]] | part
        many = (classes[of_key[first]] > MANY) | part
        rep = {k: v[first] for k, v in c.items()}
        out.append({k: v[need] for k, v in rep.items()} | {
            "tag": np.full(need.sum(), NEED), "done": done[need], "origin": many[need] * 1})
        # the merged level: the first entry of a class that belongs to it
        mine = np.flatnonzero(np.isin(origin, kept))
        lead = mine[np.append(True, of_cls[mine][1:] != of_cls[mine][:-1])] if len(mine) else mine
        out.append({k: v[lead] for k, v in c.items()} | {
            "tag": np.full(len(lead), ENTRY), "done": done[of_cls[lead]], "origin": np.zeros(len(lead), np.int64)})
        return out

    def run(batches):
        names = [f[0] for f in _SCAN]
        # forced: an anchor of which a part has been passed on as one with very many candidates
        schema, held, forced = C.arrow_schema(*[C.field(*f) for f in _SCAN]), None, None

        def emit(parts):
            c = {k: np.concatenate([p[k] for p in parts]) for k in names}
            if len(c["tag"]):
                yield pa.RecordBatch.from_arrays([pa.array(c[k], schema.field(k).type) for k in names], schema=schema)

        for batch in batches:
            if not batch.num_rows:
                continue
            c = {k: batch.column(i).to_numpy(zero_copy_only=False) for i, k in enumerate(names)}
            if held is not None:
                c = {k: np.concatenate([held[k], c[k]]) for k in names}
            if forced is not None and c["key"][0] != forced:
                forced = None
            # the last anchor may go on in the next batch
            last = int(np.searchsorted(c["key"], c["key"][-1]))
            if last == 0 and len(c["key"]) > ONE_ANCHOR:
                # very many entries of one anchor: pass on all but the last class
                other = np.flatnonzero((c["cls"] != c["cls"][-1]) | (c["tag"] != c["tag"][-1]))
                if len(other):
                    last, forced = int(other[-1]) + 1, c["key"][-1]
                else:  # of one class: the long matches, but for one entry of each origin and two at least
                    stay = np.zeros(len(c["key"]), bool)
                    stay[np.unique(c["origin"], return_index=True)[1]] = True
                    stay[:2] = True
                    go = ~stay & ~c["done"] & (c["tag"] == ENTRY)
                    yield from emit([{k: v[go] for k, v in c.items()} | {
                        "tag": np.full(go.sum(), MARK), "cls": (c["at"] + c["n"] - 1 + LENGTH)[go]},
                        {k: v[c["tag"] != ENTRY] for k, v in c.items()}])
                    c = {k: v[stay & (c["tag"] == ENTRY)] for k, v in c.items()}
            if last:
                yield from emit(closed({k: v[:last] for k, v in c.items()}, forced))
            held = {k: v[last:] for k, v in c.items()}
        if held is not None:
            yield from emit(closed(held, forced))

    return dealt.mapInArrow(C.trimmed(run), T.StructType([C.field(*f) for f in _SCAN]))


class SuffixFamily:
    """Levels of sparse suffix arrays. ``add`` takes batches; ``notes`` are
    the long matches and candidates of all batches so far."""

    def __init__(self, spark: SparkSession):
        self.spark, self.levels, self.notes = spark, {}, None  # level number -> its written table

    def add(self, docs: DataFrame) -> None:
        """Documents as (r1, r2, body): merge-scan them against every level,
        then take their place in the family."""
        rows = _entries(docs)
        for number, level in self.levels.items():
            rows = rows.unionByName(level.withColumn("origin", F.lit(number)))
        merging, place = [], 0
        while place in self.levels:  # as adding one to a binary counter
            merging.append(place)
            place += 1
        path = scratch_path(self.spark, "suffix-level")
        # one file a task: a level, its candidates and marks are told apart by tag
        _scan(rows, merging).write.option("compression", "zstd").parquet(path)
        table = self.spark.read.schema(T.StructType([C.field(*f) for f in _SCAN])).parquet(path)
        for number in merging:
            del self.levels[number]
        self.levels[place] = table.filter(F.col("tag") == ENTRY)
        found = table.filter(F.col("tag") != ENTRY)
        self.notes = found if self.notes is None else self.notes.unionByName(found)


def _fetched(texts: DataFrame, needs: DataFrame, deals: int) -> DataFrame:
    """Candidates with their bytes: route (the anchor), r1, r2, at, n, done,
    body. Of anchors with very many, the windows' fingerprints instead: route
    (their part of the fingerprints) and body (fingerprint, r1, r2, start,
    done of each)."""
    asked = needs.groupBy("r1", "r2").agg(F.collect_list(F.struct(
        "key", "at", "n", "done", F.col("origin").alias("many"))).alias("asked"))
    both = texts.join(asked, ["r1", "r2"], "left")
    out = [C.field(*f) for f in (("route", "long"), ("many", "boolean"), ("r1", "long"), ("r2", "long"),
                                 ("at", "long"), ("done", "boolean"), ("body", "binary"))]

    def close(plain, spread):
        if spread:
            w = np.concatenate(spread)
            part = (w["h"] % _U(deals)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            for group in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
                plain.append((int(part[group[0]]), True, 0, 0, 0, False, w[group].tobytes()))
        if plain:
            yield dict(zip([f.name for f in out], zip(*plain)))

    def rows(batch):
        plain, spread, size = [], [], 0
        for r1, r2, body, asked in zip(*(batch.column(i) for i in (0, 1, 3, 4))):
            if not asked.is_valid:
                continue
            r1, r2, body = r1.as_py(), r2.as_py(), body.as_py()
            for a in asked.as_py():
                text = body[a["at"]:a["at"] + a["n"] - 1 + LENGTH]
                if a["many"]:
                    h = fingerprints(np.frombuffer(text, np.uint8), LENGTH)[0]
                    spread.append(np.rec.fromarrays([
                        h, np.full(len(h), r1), np.full(len(h), r2), a["at"] + np.arange(len(h)),
                        np.full(len(h), a["done"])], dtype=_WINDOW))
                    size += spread[-1].nbytes
                else:
                    plain.append((a["key"], False, r1, r2, a["at"], a["done"], text))
                    size += len(text)
            if size > 8 << 20:
                yield from close(plain, spread)
                plain, spread, size = [], [], 0
        yield from close(plain, spread)

    # all columns of texts: the shuffle of the texts then serves the final join as well
    return C.map_arrow(both.select("r1", "r2", "id", "body", "asked"), rows, out)


_WINDOW = np.dtype([("h", "<u8"), ("r1", "<i8"), ("r2", "<i8"), ("at", "<i8"), ("done", "?")])


def _compared(fetched: DataFrame) -> DataFrame:
    """Marks (r1, r2, start, stop) of windows that two candidates of an anchor share."""
    dealt = fetched.repartition("many", "route").sortWithinPartitions("many", "route")
    out = [C.field(n, "long") for n in ("r1", "r2", "start", "stop")]

    def plain(group):
        """Rows of whole anchors: (route, r1, r2, at, done, body)."""
        x = np.frombuffer(b"".join(g[5] for g in group), np.uint8)
        size = np.array([len(g[5]) for g in group])
        begin = np.cumsum(size) - size
        h = fingerprints(x, LENGTH)[0]
        n = size - LENGTH + 1
        of = np.repeat(np.arange(len(group)), n)
        at = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        h = h[begin[of] + at]
        key = np.array([g[0] for g in group], np.int64).view(_U)[of]
        same = _mix(h ^ _mix(key))
        s = np.sort(same)
        twice = np.unique(s[1:][s[1:] == s[:-1]])
        if not len(twice):
            return
        place = np.minimum(np.searchsorted(twice, same), len(twice) - 1)
        hit = (twice[place] == same) & ~np.array([g[4] for g in group])[of]
        # runs of window starts inside one candidate
        cut = np.append(True, of[1:] != of[:-1])
        edge = np.flatnonzero(hit & (cut | np.append(True, ~hit[:-1])))
        stop = np.flatnonzero(hit & np.append(cut[1:] | ~hit[1:], True))
        r1, r2, base = (np.array([g[i] for g in group], np.int64) for i in (1, 2, 3))
        o = of[edge]
        if len(o):
            yield {"r1": r1[o], "r2": r2[o], "start": base[o] + at[edge], "stop": base[o] + at[stop] + LENGTH}

    def many(bodies):
        w = np.concatenate([np.frombuffer(b, _WINDOW) for b in bodies])
        h, count = np.unique(w["h"], return_counts=True)
        w = w[(count > 1)[np.searchsorted(h, w["h"])] & ~w["done"]]
        if len(w):
            yield {"r1": w["r1"], "r2": w["r2"], "start": w["at"], "stop": w["at"] + LENGTH}

    def run(batches):
        schema, open_group, held = C.arrow_schema(*out), None, []
        done, size = [], 0

        def batch(cols):
            return pa.RecordBatch.from_arrays([pa.array(cols[f.name], f.type) for f in schema], schema=schema)

        for b in batches:
            for route, is_many, r1, r2, at, over, body in zip(*(c.to_pylist() for c in b.columns)):
                if (is_many, route) != open_group:
                    if open_group and open_group[0]:
                        yield from map(batch, many(held))
                    else:
                        if len(held) > 1:  # an anchor by itself shares nothing
                            done += held
                            size += sum(len(g[5]) for g in held)
                        if size > PIECE:
                            yield from map(batch, plain(done))
                            done, size = [], 0
                    open_group, held = (is_many, route), []
                held.append(body if is_many else (route, r1, r2, at, over, body))
        if open_group and open_group[0]:
            yield from map(batch, many(held))
        elif len(held) > 1:
            done += held
        if done:
            yield from map(batch, plain(done))

    return dealt.mapInArrow(C.trimmed(run), T.StructType(out))


def repeated(docs: DataFrame, id_col: str = "doc_id", text: str = "text", batches: int = 4) -> DataFrame:
    """One row for each document row: id, n_bytes, spans (maximal removed byte
    ranges [start, stop)) and kept (the bytes that stay)."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).alias("id"), *_identity(id_col, text), C.utf8(text).alias("body"))
    family = SuffixFamily(spark)
    turn = F.pmod(F.xxhash64("r1", "r2"), F.lit(batches))
    for i in range(batches):
        family.add(texts.filter(turn == i).select("r1", "r2", "body"))
    out = [texts.schema["id"], C.field("n_bytes", "long"), C.field("spans", "array<struct<start:bigint,stop:bigint>>"),
           C.field("kept", "binary")]
    if family.notes is None:
        marks = spark.createDataFrame([], "r1 long, r2 long, start long, stop long")
    else:
        marks = family.notes.filter(F.col("tag") == MARK).select(
            "r1", "r2", F.col("at").alias("start"), F.col("cls").alias("stop"))
        needs = family.notes.filter(F.col("tag") == NEED).groupBy("key", "cls", "r1", "r2", "at", "n").agg(
            F.max("done").alias("done"), F.max("origin").alias("origin"))
        deals = 64 * int(spark.conf.get("spark.sql.shuffle.partitions"))
        marks = marks.unionByName(_compared(_fetched(texts.select("r1", "r2", "id", "body"), needs, deals)))
    listed = marks.groupBy("r1", "r2").agg(F.collect_set(F.struct("start", "stop")).alias("marks"))
    both = texts.select("r1", "r2", "id", "body").join(listed, ["r1", "r2"], "left")

    def rows(batch):
        for part in C.slices(batch, "body"):
            spans, kept, sizes = [], [], []
            for body, marks in zip(part.column(1), part.column(2)):
                body = body.as_py()
                merged = _merged(marks.as_py() or [])
                at, stay = 0, []
                for a, b in merged:
                    stay.append(body[at:a])
                    at = b
                stay.append(body[at:])
                spans.append([{"start": a, "stop": b} for a, b in merged])
                kept.append(b"".join(stay))
                sizes.append(len(body))
            yield {"id": part.column(0), "n_bytes": sizes, "spans": spans, "kept": kept}

    return C.map_arrow(both.select("id", "body", "marks"), rows, out)


def _merged(marks: list[dict]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted((m["start"], m["stop"]) for m in marks):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]
