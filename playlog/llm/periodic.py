"""Periodic runs of words, by tiles scaled to the period.

A run is a stretch of consecutive words with smallest period q (words q apart
are identical) of at least max(``least``, ``times`` * q) words that neither
neighbouring word extends. A word is dropped if a run holds it after that run's
first q words; the kept words are joined by one blank.

1. Periods are taken by octave: q from l to 2l - 1, l = 1, 2, 4, ... Words equal
   to the word q further on form stretches of at least 3l places in a run, so
   one of the borders 2l apart lies in each with l places of it to the right.
   A tile of an octave is a border with 3l words before and 5l after it.
2. A border whose next words occur again l to 2l - 1 further on has its tile
   solved alone: two Z-functions give, for every period of the octave at once,
   how far the stretch goes to the right and to the left of the border, as far
   as the tile shows. What is short and ends inside the tile is no run.
3. Texts of up to ``tile_words`` words are cut and solved where they are read.
   Longer ones are exploded into pieces of many tiles, one octave each for the
   long periods, that are shuffled to all tasks as word numbers.
4. The intervals found are shuffled by (document, period) and stitched where
   they meet. Of the stretches over the same words the smallest period is the
   run's. Runs come back to their document, whose text has waited in a table.

Results for odd input: null, empty and wordless texts have no words and no
runs. Every row gets its own answer, rows alike in id and text the same one.
An empty table gives no rows. A word is a run of bytes other than blank and
\\x09-\\x0D. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlog.llm import common as C
from playlog.session import scratch_path

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"
_FOUND = "array<struct<period:bigint,start:bigint,stop:bigint>>"
_PIECES = "array<struct<octaves:int,lowest:int,base:bigint,n:bigint,head:int,tail:int,codes:binary>>"
ANCHOR = 4  # words at a border that must occur again before its tile is solved


# --- one tile ---------------------------------------------------------------------------

def z_function(s: list[int]) -> list[int]:
    """For each place the length of the longest common prefix of ``s`` and its rest."""
    n = len(s)
    z, left, right = [0] * n, 0, 0
    if n:
        z[0] = n
    for i in range(1, n):
        k = min(z[i - left], right - i) if i < right else 0
        if i + k >= right:
            while i + k < n and s[k] == s[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    return z


def solve_tile(codes: np.ndarray, lo: int, hi: int, border: int, octave: int, shortest: int
               ) -> list[tuple[int, int, int]]:
    """(period, start, stop) of the stretches [start, stop) of places equal to the
    place a period further on that hold or touch ``border``: those of at least
    ``shortest`` periods, and those that the tile's edge cuts. ``lo``, ``hi``: the
    document's place in ``codes`` (which may show a part of it, but the tile whole)."""
    a, b = max(lo, border - 3 * octave), min(hi, border + 3 * octave)
    reach = min(hi, border + 5 * octave)
    right = z_function(codes[border:reach].tolist())
    # suffixes before the border against those before border + q: reversed, with a mark between
    window = codes[a:min(hi, border + 2 * octave)].tolist()
    before = window[:border - a][::-1]
    left = z_function([*before, -1, *window[::-1]])
    found = []
    for q in range(octave, min(2 * octave, hi - border)):
        start = border - left[len(before) + 1 + len(window) - (border - a) - q]
        stop = border + min(right[q], b - border, hi - border - q)
        cut = (start == a and a > lo) or (stop == b and b < hi)
        if stop - start >= shortest * q or (cut and stop > start):
            found.append((q, start, stop))
    return found


def octaves_of(n: int, times: int) -> int:
    """Octaves that have a period q with ``times`` * q <= n."""
    return max(n // times, 0).bit_length()


def _grams(codes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit key of the ``width`` codes from each place on (mixed past the end)."""
    key = codes.astype(np.uint64)
    for i in range(1, width):
        key = (key ^ (key >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15)
        key[:-i] += codes[i:].astype(np.uint64)
    return key


def candidates(keys: np.ndarray, first: int, stop: int, octave: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """(border, q): of the borders from ``first`` on, those whose first and last of the
    next ``octave`` words occur again q further on, by the keys of ``width`` words."""
    stride = 2 * octave
    rows = -(-(stop - first) // stride)
    grid = np.zeros(rows * stride, np.uint64)
    part = keys[first:first + len(grid)]
    grid[:len(part)] = part
    grid = grid.reshape(rows, stride)
    row, ahead = np.nonzero(grid[:, octave:] == grid[:, :1])
    border, q = first + row * stride, ahead + octave
    seen = border + q + octave <= len(keys)
    border, q = border[seen], q[seen]
    last = border + octave - width
    again = keys[last] == keys[last + q]
    return border[again], q[again]


def solve(codes: np.ndarray, begin: np.ndarray, times: int) -> dict[int, list]:
    """Stretches of the documents ``codes[begin[d]:begin[d + 1]]`` by document:
    d -> [(period, start, stop)] with places in the document, merged where they meet."""
    found: dict[int, list] = {}
    size = np.diff(begin)
    keys = {}
    for o in range(octaves_of(int(size.max(initial=0)), times)):
        octave = 1 << o
        width = min(octave, ANCHOR)
        if width not in keys:
            keys[width] = _grams(codes, width)
        border, q = candidates(keys[width], 0, len(codes), octave, width)
        doc = np.searchsorted(begin, border, side="right") - 1
        same = (border + q + octave <= begin[doc + 1]) & (times * q <= size[doc])
        for at, d in dict.fromkeys(zip(border[same].tolist(), doc[same].tolist())):
            lo, hi = int(begin[d]), int(begin[d + 1])
            found.setdefault(d, []).extend(
                (p, s - lo, e - lo) for p, s, e in solve_tile(codes, lo, hi, at, octave, times - 1))
    return {d: merged(x) for d, x in found.items()}


def merged(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    out = []
    for p, s, e in sorted(found):
        if out and out[-1][0] == p and out[-1][2] >= s:
            out[-1] = (p, out[-1][1], max(e, out[-1][2]))
        else:
            out.append((p, s, e))
    return out


# --- documents --------------------------------------------------------------------------

def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of the words, equal for equal words; where each text's words begin)."""
    split = [t.as_py().split() for t in texts]  # of bytes: blanks and \x09-\x0D
    begin = np.cumsum([0, *map(len, split)])
    flat = pa.array([w for x in split for w in x], pa.binary())
    return flat.dictionary_encode().indices.to_numpy().astype(np.int32), begin


def _pieces(codes: np.ndarray, times: int, tile_words: int):
    """Cuts a long document: pieces of ``tile_words`` words for all octaves whose
    tiles are small beside it, then for each further octave pieces of a few tiles.
    Each has the words that its borders' tiles show before and after it."""
    n, o = len(codes), 0
    most = octaves_of(n, times)
    small = max(1, (tile_words // 32).bit_length())
    while o < most:
        octaves = min(small, most) if o == 0 else 1
        octave = 1 << (o + octaves - 1)
        # whole strides of the largest octave, so that borders are the same in every piece
        core = max(tile_words // (2 * octave), 4) * 2 * octave
        for base in range(0, n, core):
            head, tail = max(0, base - 3 * octave), min(n, base + core + 5 * octave)
            yield {"octaves": octaves, "lowest": o, "base": head, "n": n, "head": base - head,
                   "tail": min(n, base + core) - head, "codes": codes[head:tail].astype("<i4").tobytes()}
        o += octaves


def _solve_piece(octaves: int, lowest: int, base: int, n: int, head: int, tail: int, codes: np.ndarray, times: int):
    """Stretches found at the borders from ``head`` to ``tail`` of a piece that begins
    at word ``base`` of a document of ``n``."""
    found = []
    for o in range(lowest, lowest + octaves):
        octave = 1 << o
        width = min(octave, ANCHOR)
        border, _ = candidates(_grams(codes, width), head, tail, octave, width)
        for at in dict.fromkeys(border[border < tail].tolist()):
            found += [(q, s + base, e + base) for q, s, e in solve_tile(codes, -base, n - base, at, octave, times - 1)]
    return merged(found)


def _first_pass(docs: DataFrame, id_col: str, text: str, times: int, tile_words: int) -> DataFrame:
    """One row for each document row: id, k1, k2, n_words, the stretches found
    (of texts up to ``tile_words``), the pieces to solve (of longer ones), the text."""
    src = docs.select(F.col(id_col).alias("id"), *C.row_keys(id_col, text), C.utf8(text).alias("body"))
    out = [T.StructField("id", src.schema["id"].dataType), C.field("k1", "long"), C.field("k2", "long"),
           C.field("n_words", "long"), C.field("found", _FOUND), C.field("pieces", _PIECES), C.field("body", "binary")]

    def rows(batch):
        for few in C.slices(batch, "body"):
            codes, begin = words(few.column(3))
            size = np.diff(begin)
            long = size > tile_words
            found, pieces = [[] for _ in size], [[] for _ in size]
            for group in _between(np.flatnonzero(long), len(size)):
                a, b = begin[group[0]], begin[group[-1] + 1]
                for d, x in solve(codes[a:b], begin[group[0]:group[-1] + 2] - a, times).items():
                    found[group[0] + d] = [{"period": p, "start": s, "stop": e} for p, s, e in x]
            for d in np.flatnonzero(long).tolist():
                pieces[d] = list(_pieces(codes[begin[d]:begin[d + 1]], times, tile_words))
            yield {"id": few.column(0), "k1": few.column(1), "k2": few.column(2), "n_words": size, "found": found,
                   "pieces": pieces, "body": few.column(3)}

    return C.map_arrow(src, rows, out)


def _between(cuts: np.ndarray, n: int) -> list[range]:
    """Ranges of the documents between the long ones."""
    edges = [-1, *cuts.tolist(), n]
    return [range(a + 1, b) for a, b in zip(edges, edges[1:]) if b - a > 1]


def _stretches(first: DataFrame, times: int) -> DataFrame:
    """(k1, k2, period, start, stop) of all documents, not yet stitched."""
    plain = first.select("k1", "k2", F.explode("found").alias("f")).select("k1", "k2", "f.*")
    pieces = first.select("k1", "k2", F.explode("pieces").alias("p")).select("k1", "k2", "p.*").hint("rebalance")
    out = [C.field(n, "long") for n in ("k1", "k2", "period", "start", "stop")]

    def rows(batch):
        for k1, k2, *piece, codes in zip(*batch.columns):
            found = _solve_piece(*(x.as_py() for x in piece), np.frombuffer(codes.as_buffer(), "<i4"), times)
            if found:
                p, s, e = zip(*found)
                yield {"k1": [k1.as_py()] * len(p), "k2": [k2.as_py()] * len(p), "period": p, "start": s, "stop": e}

    return plain.unionByName(C.map_arrow(pieces, rows, out)).distinct()


def _runs(stretches: DataFrame, least: int, times: int) -> DataFrame:
    """(k1, k2, runs): stretches of a period stitched, then the smallest period of each place."""
    order = Window.partitionBy("k1", "k2", "period").orderBy("start", "stop")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    apart = F.coalesce(F.max("stop").over(before) < F.col("start"), F.lit(True)).cast("long")
    marked = stretches.withColumn("apart", apart).withColumn("island", F.sum("apart").over(order))
    stitched = (marked.groupBy("k1", "k2", "period", "island").agg(F.min("start").alias("start"),
                                                                   F.max("stop").alias("stop"))
                .select("k1", "k2", "period", "start", (F.col("stop") + F.col("period")).alias("stop")))
    size = F.col("stop") - F.col("start")
    whole = (stitched.filter((size >= least) & (size >= times * F.col("period")))
             .groupBy("k1", "k2", "start", "stop").agg(F.min("period").alias("period")))
    return whole.groupBy("k1", "k2").agg(F.sort_array(F.collect_list(
        F.struct("start", (F.col("stop") - F.col("start")).alias("length"), "period"))).alias("runs"))


def _collapsed(rows: DataFrame) -> DataFrame:
    """id, n_words, runs, collapsed (the kept words, joined by one blank)."""
    out = [rows.schema["id"], C.field("n_words", "long"), C.field("runs", RUNS), C.field("collapsed", "string")]

    def cut(batch):
        for few in C.slices(batch, "body"):
            texts = []
            for body, runs in zip(few.column(3), few.column(2).to_pylist()):
                ws = body.as_py().split()
                if runs:
                    keep = np.ones(len(ws), bool)
                    for r in runs:
                        keep[r["start"] + r["period"]:r["start"] + r["length"]] = False
                    ws = [ws[i] for i in np.flatnonzero(keep).tolist()]
                texts.append(b" ".join(ws).decode("utf-8", "replace"))
            yield {"id": few.column(0), "n_words": few.column(1), "runs": few.column(2), "collapsed": texts}

    return C.map_arrow(rows.select("id", "n_words", "runs", "body"), cut, out)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text: str = "text", least: int = 6, times: int = 4,
              tile_words: int = 1 << 16) -> DataFrame:
    """One row for each document row: id, n_words, runs (by start, then period) and
    collapsed (the text without the repeats). ``times`` is at least 4."""
    if times < 4:
        raise ValueError("tiles are laid out for runs of four periods or more")
    path = scratch_path(docs.sparkSession, "periodic")
    _first_pass(docs, id_col, text, times, tile_words).write.parquet(path)
    first = docs.sparkSession.read.parquet(path)
    runs = _runs(_stretches(first, times), least, times)
    some = (F.size("found") > 0) | (F.size("pieces") > 0)
    none = F.expr(f"cast(array() as {RUNS})")
    met = first.filter(some).select("id", "k1", "k2", "n_words", "body").join(runs, ["k1", "k2"], "left").select(
        "id", "n_words", F.coalesce("runs", none).alias("runs"), "body")
    rest = first.filter(~some).select("id", "n_words", none.alias("runs"), "body")
    return _collapsed(met.unionByName(rest))
