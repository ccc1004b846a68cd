"""Ranked lexical search of items in documents by a dual-tree descent.

A document's score for an item is the sum over the item's terms of
``w * ((1000000000 * tf) div (1000 * tf + 8 * m))`` in whole numbers, with
``w = floor(1000 * ln((2N + 2) / (2df + 1)))`` and ``m = 25 + (75 * n * N) div L``
(N documents with a term, L terms in all, n terms in the document).

1. Items are reduced to distinct term bags. A block of them, bounded by its
   number of terms, is what tasks get by broadcast; more items make more blocks.
2. One pass over the texts writes each document's length and its counts of the
   block's terms; N, L and df are sums over all of it.
3. Tasks search their documents a slice at a time. Items and documents each form
   a hierarchy whose nodes hold, for each term, the largest factor below them
   (``w`` times repeats; the fraction of tf and m). The product of two nodes
   bounds every score between them. A pair of nodes is given up only where the
   bound is below the weakest kth score of the item node, so all of the pruned
   pairs' scores are too low: the result is exact.
4. The kth scores start from an exact search of the documents that a hash
   chooses, a lower bound of the final ones, and rise as a task goes on. A task
   returns at most k rows an item; a window keeps the k best of them.

Results for odd input: a null or empty text, or one without terms, is no
document to rank and counts in none of N, L, df. Every row is a document of its
own; equal scores go by ascending id, null ids last (rows alike in score and id
take any order). Item rows alike in id and text are one item; an id with several
texts ranks each of them; items without terms give no rows, as do empty tables.
Ids of documents are integers. Extra columns are ignored.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from playlog.llm import common as C
from playlog.llm.decontaminate import words
from playlog.session import scratch_path

FAN = 8
SLICE = 2048
SEED_SHARE = 64


class Tree:
    """Sparse rows and a hierarchy over them: node ``j`` of a level covers nodes
    ``FAN * j`` to ``FAN * j + FAN - 1`` of the level below and holds the largest
    value of each coordinate. Rows are in the order given (alike ones adjacent);
    none is without coordinates."""

    def __init__(self, row: np.ndarray, col: np.ndarray, val: np.ndarray, width: int):
        self.levels = []
        while True:
            n = int(row[-1]) + 1
            self.levels.append((np.searchsorted(row, np.arange(n + 1)), col, val))
            if n == 1:
                break
            key = row // FAN * width + col
            order = np.argsort(key, kind="stable")
            key = key[order]
            first = np.flatnonzero(np.diff(key, prepend=-1))
            row, col = np.divmod(key[first], width)
            val = np.maximum.reduceat(val[order], first)

    @property
    def top(self) -> int:
        return len(self.levels) - 1

    def size(self, level: int) -> int:
        return len(self.levels[level][0]) - 1

    def node(self, level: int, j: int) -> tuple[np.ndarray, np.ndarray]:
        begin, col, val = self.levels[level]
        return col[begin[j]:begin[j + 1]], val[begin[j]:begin[j + 1]]

    def below(self, level: int, nodes: np.ndarray) -> np.ndarray:
        """Children of nodes of a level."""
        found = (nodes[:, None] * FAN + np.arange(FAN)).ravel()
        return found[found < self.size(level - 1)]

    def dots(self, level: int, nodes: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Products of the nodes with a dense vector, in whole numbers."""
        begin, col, val = self.levels[level]
        size = begin[nodes + 1] - begin[nodes]
        ends = np.cumsum(size)
        at = np.arange(ends[-1]) + np.repeat(begin[nodes] - (ends - size), size)
        return np.add.reduceat(val[at] * v[col[at]], ends - size)


class Items:
    """The bags of a block as a tree, with each item's best documents so far."""

    def __init__(self, bags: list[tuple[list[int], list[int]]], weight: np.ndarray, floor: np.ndarray, k: int):
        width, self.k = len(weight), k
        lead = [max((int(weight[c]), c) for c in codes) for codes, _ in bags]
        self.order = sorted(range(len(bags)), key=lambda i: (lead[i], sorted(bags[i][0])))
        row = np.repeat(np.arange(len(bags)), [len(bags[i][0]) for i in self.order])
        col = np.concatenate([np.asarray(bags[i][0], np.int64) for i in self.order])
        times = np.concatenate([np.asarray(bags[i][1], np.int64) for i in self.order])
        self.tree = Tree(row, col, weight[col] * times, width)
        self.v = np.zeros(width, np.int64)
        self.kth = np.maximum(floor[self.order], 1)
        self.best = [[] for _ in bags]
        self.limits()

    def limits(self) -> None:
        """Weakest kth score of the items below each node."""
        self.limit = [self.kth]
        for level in range(1, self.tree.top + 1):
            low = self.limit[-1]
            self.limit.append(np.minimum.reduceat(low, np.arange(0, len(low), FAN)))

    def offer(self, items: np.ndarray, scores: np.ndarray, order_key: int) -> None:
        for i, s in zip(items.tolist(), scores.tolist()):
            best = self.best[i]
            if len(best) < self.k:
                heapq.heappush(best, (s, order_key))
            elif (s, order_key) > best[0]:
                heapq.heapreplace(best, (s, order_key))
            if len(best) == self.k and best[0][0] > self.kth[i]:
                self.kth[i] = best[0][0]

    def search(self, ids: list[int | None], row: np.ndarray, col: np.ndarray, impact: np.ndarray,
               lead: np.ndarray) -> None:
        """Meet a slice of documents: ``row`` numbers those with a term of the block."""
        order = np.argsort(lead, kind="stable")  # documents with the same heaviest term side by side
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        row = place[row]
        by = np.argsort(row, kind="stable")
        docs = Tree(row[by], col[by], impact[by], len(self.v))
        keys = [_order_key(ids[i]) for i in order.tolist()]
        self._meet(docs, docs.top, 0, keys, self.tree.top, np.arange(self.tree.size(self.tree.top)))

    def _meet(self, docs: Tree, level: int, j: int, keys: list[int], depth: int, nodes: np.ndarray) -> None:
        cols, vals = docs.node(level, j)
        self.v[cols] = vals
        while True:
            found = self.tree.dots(depth, nodes, self.v)
            keep = found >= self.limit[depth][nodes]
            nodes, found = nodes[keep], found[keep]
            if level or not depth or not len(nodes):
                break
            nodes, depth = self.tree.below(depth, nodes), depth - 1  # one document: on to the items
        self.v[cols] = 0
        if not len(nodes):
            return
        if level == 0:
            self.offer(nodes, found, keys[j])
            return
        if depth:
            nodes, depth = self.tree.below(depth, nodes), depth - 1
        for child in docs.below(level, np.asarray([j])).tolist():
            self._meet(docs, level - 1, child, keys, depth, nodes)
        if level == 2:
            self.limits()

    def rows(self):
        """(number of the bag, document's order key, score) of all that may be among the k best."""
        for place, best in enumerate(self.best):
            for s, key in best:
                if s >= self.kth[place]:
                    yield self.order[place], key, s


_NO_ID = -(1 << 63)


def _order_key(i: int | None) -> int:
    """Greater for smaller ids, least for null; its complement is the id again."""
    return _NO_ID if i is None else ~i if i != (1 << 63) - 1 else _NO_ID


def _bags(items: DataFrame, item_id: str, text: str) -> DataFrame:
    """(item, body, class, n): distinct items with their terms in order, blank-joined."""
    src = items.select(F.col(item_id).alias("item"), C.utf8(text).alias("text"))

    def rows(batch):
        found = [words(t.as_py()) for t in batch.column(1)]
        yield {"item": batch.column(0), "body": [b" ".join(w).decode("utf-8", "replace") for w in found],
               "n": list(map(len, found))}

    kind = T.StructField("item", src.schema["item"].dataType)
    return C.cut(C.map_arrow(src, rows, [kind, C.field("body", "string"), C.field("n", "long")])
                 .filter("n > 0").withColumn("class", F.sha2("body", 256)).distinct())


def _counts(docs: DataFrame, id_col: str, text: str, vocabulary: C.Shared) -> DataFrame:
    """id, n (terms of the text), codes and tfs of the block's terms in it; documents with terms only."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), C.utf8(text).alias("body"))

    def rows(batch):
        code = vocabulary.get()
        for few in C.slices(batch, "body"):
            found = [words(t.as_py()) for t in few.column(1)]
            n = np.asarray([len(w) for w in found], np.int64)
            every = np.fromiter((c for w in found for c in map(code.get, w, repeat(-1))), np.int64, int(n.sum()))
            doc = np.repeat(np.arange(len(n)), n)[every >= 0]
            key, tf = np.unique(doc * len(code) + every[every >= 0], return_counts=True)
            doc, col = np.divmod(key, max(len(code), 1))
            begin = np.searchsorted(doc, np.arange(len(n) + 1)).astype(np.int32)
            has = np.flatnonzero(n > 0)
            lists = [pa.ListArray.from_arrays(pa.array(begin), pa.array(x.astype(np.int32))) for x in (col, tf)]
            yield {"id": few.column(0).take(pa.array(has)), "n": n[has],
                   "codes": lists[0].take(pa.array(has)), "tfs": lists[1].take(pa.array(has))}

    return C.map_arrow(src, rows, [C.field("id", "long"), C.field("n", "long"), C.field("codes", "array<int>"),
                                   C.field("tfs", "array<int>")])


def _frequencies(counts: DataFrame, width: int) -> np.ndarray:
    """Documents that hold each of the block's terms."""
    def rows(batch):
        found = np.bincount(batch.column(0).flatten().to_numpy(), minlength=width)
        at = np.flatnonzero(found)
        yield {"code": at, "n": found[at]}

    df = np.zeros(width, np.int64)
    for r in C.map_arrow(counts.select("codes"), rows, [C.field("code", "long"), C.field("n", "long")]
                         ).groupBy("code").agg(F.sum("n").alias("n")).collect():
        df[r["code"]] = r["n"]
    return df


def _found(counts: DataFrame, block: C.Shared, floor: C.Shared, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """(bag, id, score): at most k rows a bag and task, all of the best among them."""
    schema = T.StructType([C.field("bag", "int"), C.field("id", "long"), C.field("score", "long")])

    def run(batches):
        bags, weight = block.get()
        items = Items(bags, weight, floor.get(), k)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                few = batch.slice(at, SLICE)
                ids = few.column(0).to_pylist()
                n = few.column(1).to_numpy()
                size = np.asarray(few.column(2).value_lengths())
                row = np.repeat(np.arange(len(n)), size)
                if not len(row):
                    continue
                col = few.column(2).flatten().to_numpy().astype(np.int64)
                tf = few.column(3).flatten().to_numpy().astype(np.int64)
                # Python integers: 75 * n * N may pass 64 bits
                m = np.asarray([25 + 75 * x * n_docs // n_terms for x in n.tolist()], np.int64)
                impact = 1_000_000_000 * tf // (1000 * tf + 8 * m[row])
                some = np.flatnonzero(size)
                number = np.cumsum(size > 0) - 1
                first = np.searchsorted(row, some)
                lead = np.maximum.reduceat(weight[col] * len(weight) + col, first)
                items.limits()
                items.search([ids[i] for i in some.tolist()], number[row], col, impact, lead)
        found = list(items.rows())
        for at in range(0, len(found), 10_000):
            bag, key, score = zip(*found[at:at + 10_000])
            yield pa.RecordBatch.from_arrays(
                [pa.array(bag, pa.int32()), pa.array([None if x == _NO_ID else ~x for x in key], pa.int64()),
                 pa.array(score, pa.int64())], schema=C.arrow_schema(*schema.fields))

    return counts.select("id", "n", "codes", "tfs").mapInArrow(C.trimmed(run), schema)


def _best(found: DataFrame, key: str, k: int) -> DataFrame:
    order = Window.partitionBy(key).orderBy(F.col("score").desc(), F.col("id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text: str = "text", item_id: str = "item_id",
           item_text: str = "text", k: int = 10, block_terms: int = 1 << 20) -> DataFrame:
    """The k best documents of each item: item, rank (from 1), id, score (above 0).

    ``block_terms``: terms of the items, with repeats, that are searched in one
    pass over the documents (about; an item is never divided)."""
    spark = docs.sparkSession
    members = _bags(items, item_id, item_text)
    total = members.select("class", "n").distinct().agg(F.sum("n")).first()[0] or 0
    blocks = max(1, -(-total // block_terms))
    hashed = F.pmod(F.xxhash64("class"), F.lit(blocks))
    parts = []
    for b in range(blocks):
        classes = [(r["class"], r["body"]) for r in
                   members.filter(hashed == b).select("class", "body").distinct().orderBy("class").collect()]
        if classes:
            parts.append(_block(docs, id_col, text, classes, k))
    kind = members.schema["item"].dataType
    if not parts:
        return spark.createDataFrame([], T.StructType([T.StructField("item", kind), C.field("rank", "int"),
                                                       C.field("id", "long"), C.field("score", "long")]))
    best = parts[0]
    for p in parts[1:]:
        best = best.unionByName(p)
    return members.select("item", "class").join(best, "class").select("item", "rank", "id", "score")


def _block(docs: DataFrame, id_col: str, text: str, classes: list[tuple[str, str]], k: int) -> DataFrame:
    """(class, rank, id, score) of one block's bags."""
    spark = docs.sparkSession
    counted = [Counter(body.encode().split(b" ")) for _, body in classes]
    code = {t: i for i, t in enumerate(sorted(set().union(*counted)))}
    path = scratch_path(spark, "lexical")
    _counts(docs, id_col, text, C.Shared(spark, code)).write.parquet(path)
    counts = spark.read.parquet(path)
    n_docs, n_terms = counts.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    df = _frequencies(counts, len(code))
    weight = np.asarray([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
    bags = [([code[t] for t in c], list(c.values())) for c in counted]
    block = C.Shared(spark, (bags, weight))

    none = np.zeros(len(bags), np.int64)
    seeds = _best(_found(counts.filter(F.pmod(F.xxhash64("id", "n"), F.lit(SEED_SHARE)) == 0), block,
                         C.Shared(spark, none), n_docs, max(n_terms, 1), k), "bag", k)
    floor = none.copy()
    for r in seeds.filter(F.col("rank") == k).select("bag", "score").collect():
        floor[r["bag"]] = r["score"]
    best = _best(_found(counts, block, C.Shared(spark, floor), n_docs, max(n_terms, 1), k), "bag", k)
    names = spark.createDataFrame([(i, c) for i, (c, _) in enumerate(classes)], "bag int, class string")
    return C.cut(best.join(names, "bag").select("class", "rank", "id", "score"))
