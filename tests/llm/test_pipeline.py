import hashlib

import numpy as np
import public_tokenizers

import __spark_entry__ as E
import corpus_pipeline as P
from playlog.llm import langid
from tests.llm import helpers as H
from tests.llm.test_bpe import plain  # noqa: F401

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def _fixture(tmp_path, spark):
    item = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda"
    body = [(i, H.PROSE + f"number {i} tells of another story with its own words {i * 31} " + w)
            for i, w in enumerate(["mountains and rivers", "castles by the sea", "trains at night", "bread and butter"])]
    rows = H.odd_texts() + [(200 + i, t) for i, t in body] + [
        (300, f"a page that quotes {item} in full"), (301, "write to jo.doe7@mail.example.com or 42.144.35.254 soon"),
        (302, "write to jo.doe7@mail.example.com or 42.144.35.254 soon")]
    H.docs(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    return rows, [(1, item)], str(tmp_path)


def test_stages_against_plain_versions(spark, tmp_path, plain):  # noqa: F811
    rows, items, sf = _fixture(tmp_path, spark)
    docs, seen = spark.read.parquet(f"{sf}/documents.parquet"), {}
    coder = langid._Coder(langid.fit(docs))
    for name, stage in P.STAGES:
        out = stage(spark, docs, sf)
        path = str(tmp_path / name)
        out.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs.collect()
        if name != "bpe":
            assert docs.columns == COLUMNS

    def ids(name):
        return sorted(((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in seen[name]))

    left = [(i, t) for i, t in rows if not coder.predict(t)[3]]
    assert ids("language_id") == sorted((i is None, i or 0, t) for i, t in left)

    fps = [H.simhash(t) for _, t in left]
    best = {}
    for g, (i, t) in zip(H.groups(fps), left):
        best.setdefault(g, []).append((i is None, i or 0, t))
    assert len(seen["near_duplicates"]) == len(best)
    for members in best.values():
        low = min(m[:2] for m in members)
        assert sum(x in members and x[:2] == low for x in ids("near_duplicates")) == 1

    stay = [x for x in ids("near_duplicates") if not H.contamination(x[2], items)[1]]
    assert ids("decontamination") == stay and len(stay) < len(ids("near_duplicates"))

    changed = {r["doc_id"]: r["text"] for r in seen["pii"]}
    assert "jo.doe7@" not in changed[301] and "42.144.35.254" not in changed[301]
    before = {r["doc_id"]: r["text"] for r in seen["decontamination"]}
    assert {i for i in before if before[i] != changed[i]} == {301}
    assert len(seen["pii"]) == len(stay)

    have = sorted((r["doc_id"] is None, r["doc_id"] or 0, bytes(r["ids"]), r["decoded_sha256"]) for r in seen["bpe"])
    want = sorted((r["doc_id"] is None, r["doc_id"] or 0, np.asarray(plain.encode_ordinary(r["text"]), "<u4").tobytes(),
                   hashlib.sha256(r["text"].encode()).hexdigest()) for r in seen["pii"])
    assert have == want


def test_run_is_registered_and_covers_all(spark, sf_small):
    got = E.queries()["pipeline"](spark, sf_small)
    n, total = got.count(), spark.read.parquet(f"{sf_small}/documents.parquet").count()
    assert 0.7 * total < n <= total and public_tokenizers.PATTERN


def test_empty_documents(spark, tmp_path):
    H.empty(spark).write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    assert P.run(spark, str(tmp_path)).count() == 0
