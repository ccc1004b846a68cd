"""Language identification by compression.

A text belongs to the language whose dictionary compresses it best. For each
language a raw-content zstandard dictionary is cut from a bounded sample of
labelled texts; a text is lower-cased, reduced to letters and single blanks,
cut into blocks, and every block of the whole text is compressed once per
language. The language with the smallest sum of sizes wins. Where the two
smallest sums are close, the text is compressed again at a stronger level. Sizes
are whole bytes, so few of a short text's letters decide; its views (the text
from each of up to ``views`` word starts on) are then compressed too, and the
mean of their sizes is what is compared.

A text is rejected where the second size exceeds the smallest by less than
``reject_margin`` of it and ``reject_bytes`` together: at every length by the
same rule, an exact tie always.

Results for odd input: a null text, or one without any letter (category L), is
``und`` with score 0 and is rejected. An exact tie is predicted as the language
with more labelled documents, and rejected. A table without usable labels makes every text ``und``.
Repeated rows are scored one by one. Existing columns that carry a result
column's name are replaced by the result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import regex
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from playlog.llm import common as C

LETTER = r"\p{L}"
_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")  # marks belong to the letters that they follow
_ANY_LETTER = regex.compile(LETTER)
UND = "und"


@dataclass(frozen=True)
class LanguageModel:
    """Dictionaries by language (ordered by labelled documents, most first)."""

    dictionaries: dict[str, bytes]
    block: int = 1024
    level: int = 6
    close: float = 0.03
    strong_level: int = 19
    reject_margin: float = 0.002
    reject_bytes: float = 0.2
    views: int = 32


def normalise(text: str) -> bytes:
    """Small letters of the text with single blanks between; empty if it has no letter."""
    if not _ANY_LETTER.search(text):
        return b""
    return _NOT_LETTERS.sub(" ", text.lower()).strip().encode("utf-8", "replace")


def fit(docs: DataFrame, id_col: str = "doc_id", text: str = "text", lang: str = "lang",
        dict_bytes: int = 64 << 10, sample_docs: int = 400, max_languages: int = 256, **settings) -> LanguageModel:
    """Learn one dictionary for each language.

    The sample is bounded: for each language at most ``sample_docs`` labelled
    documents (smallest id hash first). Each gives a passage at a place that its
    hash chooses, and the passages share ``dict_bytes`` evenly, so all of the
    sampled documents teach. Documents whose id is held out never teach. More
    than ``max_languages`` labels is an error, so the model that is sent to the
    executors has a fixed bound.
    """
    usable = docs.filter(~C.held_out(id_col) & F.col(id_col).isNotNull() & F.col(lang).isNotNull()
                         & F.col(text).rlike(LETTER))
    shares = usable.groupBy(F.col(lang).cast("string").alias("l")).count().orderBy(
        F.desc("count"), "l").limit(max_languages + 1).collect()
    if len(shares) > max_languages:
        raise ValueError(f"more than {max_languages} languages in column {lang}")
    part = {r["l"]: dict_bytes // min(r["count"], sample_docs) for r in shares}
    size = F.lit(0)
    for l, n in part.items():
        size = F.when(F.col("l") == F.lit(l), n).otherwise(size)
    room = F.greatest(F.length("t") - size, F.lit(0)) + 1
    place = F.pmod(F.xxhash64(F.lit("passage"), "h", "t"), room.cast("long")).cast("int")
    sample = usable.select(F.col(lang).cast("string").alias("l"), F.col(text).alias("t"),
                           F.xxhash64(F.col(id_col)).alias("h"))
    first = Window.partitionBy("l").orderBy("h", "t")
    few = sample.filter(C.lowest_share(F.col("l"), F.col("h"), {r["l"]: r["count"] for r in shares}, sample_docs)
                        ).select("l", "h", F.col("t").substr(place + 1, size).alias("t"))
    rows = few.withColumn("n", F.row_number().over(first)).filter(F.col("n") <= sample_docs).collect()
    parts: dict[str, dict[bytes, None]] = {}
    for r in sorted(rows, key=lambda r: (r["l"], r["n"])):
        parts.setdefault(r["l"], {})[normalise(r["t"])[:max(part[r["l"]] - 1, 1)]] = None  # copies teach once
    dictionaries = {r["l"]: b" ".join(parts.get(r["l"], {}))[:dict_bytes] or b" " for r in shares}
    return LanguageModel(dictionaries, **settings)


class _Coder:
    """Compressors of one worker."""

    def __init__(self, model: LanguageModel):
        self.model, self.langs = model, list(model.dictionaries)
        self.sets = {level: [self._one(model.dictionaries[k], level) for k in self.langs]
                     for level in (model.level, model.strong_level)}

    @staticmethod
    def _one(content: bytes, level: int):
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(level=level)
        return zstandard.ZstdCompressor(level=level, dict_data=d, write_content_size=False, write_checksum=False,
                                        write_dict_id=False)

    def sizes(self, body: bytes, level: int) -> list[float]:
        step = self.model.block
        blocks = [body[i:i + step] for i in range(0, len(body), step)]
        return [sum(len(c.compress(b)) for b in blocks) for c in self.sets[level]]

    def mean_sizes(self, body: bytes) -> list[float]:
        """Means over the views of a text, at the stronger level: of the text from
        each of its first word starts on, all within its first block."""
        starts, at = [0], body.find(b" ")
        while 0 <= at < self.model.block and len(starts) < self.model.views:
            starts.append(at + 1)
            at = body.find(b" ", at + 1)
        every = [self.sizes(body[i:], self.model.strong_level) for i in starts]
        return [sum(x) / len(every) for x in zip(*every)]

    def predict(self, text: str | None) -> tuple[str, float, float, bool]:
        """(language, score, margin, rejected)."""
        m, body = self.model, normalise(text or "")
        if not body or not self.langs:
            return UND, 0.0, 0.0, True
        best, second, k = _two(self.sizes(body, m.level))
        if second is not None and second - best <= m.close * second:
            best, second, k = _two(self.sizes(body, m.strong_level))
            if second - best <= m.close * second and second - best <= 2:
                best, second, k = _two(self.mean_sizes(body))
        if second is None:
            return self.langs[0], 1.0, 1.0, False
        margin = (second - best) / second
        score = 1.0 / (1.0 + math.exp(-min(50.0, (second - best) / 2.0)))
        return self.langs[k], score, margin, second - best < m.reject_margin * second + m.reject_bytes


def _two(sizes: list[float]) -> tuple[float, float | None, int]:
    """Smallest, second smallest, index of the smallest (first of a tie)."""
    order = sorted(range(len(sizes)), key=sizes.__getitem__)
    return sizes[order[0]], sizes[order[1]] if len(order) > 1 else None, order[0]


def predict(docs: DataFrame, model: LanguageModel, text: str = "text") -> DataFrame:
    """``docs`` with lang_pred, lang_score (0.5 to 1; 0 for und), lang_margin
    (share of the second size) and lang_rejected (und, or a margin too narrow)."""
    results = ("lang_pred", "lang_score", "lang_margin", "lang_rejected")
    kept = C.without(docs, *results)
    shared = C.Shared(docs.sparkSession, model, _Coder)
    names = kept.columns
    out = [kept.schema[c] for c in names] + [C.field(n, k) for n, k in zip(
        results, ("string", "double", "double", "boolean"))]

    def rows(batch):
        coder = shared.get()
        for part in C.slices(batch, text):
            found = [coder.predict(t) for t in part.column(names.index(text)).to_pylist()]
            cols = {n: part.column(i) for i, n in enumerate(names)}
            yield cols | {n: [f[i] for f in found] for i, n in enumerate(results)}

    return C.map_arrow(kept, rows, out)
