import numpy as np

from playlog.llm import masked_lm as M
from playlog.llm.queries import QUERIES
from tests.llm import helpers as H


def _plain_score(net, text: bytes) -> float:
    total, padded = 0.0, b"\0\0" + text + b"\0\0"
    for i, byte in enumerate(text):
        ctx = np.array([[padded[i + 1], padded[i], padded[i + 3], padded[i + 4]]])
        total += net.log_probs(ctx)[0, byte]
    return total


def test_scores_are_summed_conditionals(spark):
    net = M.Network.fresh(8, 3)
    rows = [(i, t) for i, t in H.odd_texts() if len(t or "") < 2000]
    got = M.score(H.docs(spark, rows, clash=True), net).collect()
    assert len(got) == len(rows)
    for r in got:
        body = (r["text"] or "").encode()
        assert r["lm_tokens"] == len(body)
        assert abs(r["lm_log_prob"] - _plain_score(net, body)) < 1e-6 * max(1, len(body))
        assert (r["lm_mean"] is None) == (not body)


def test_windows_are_counted_over_the_whole_corpus(spark):
    rows = H.odd_texts()
    got = {r["code"]: r["n"] for r in M.count_windows(H.docs(spark, rows, clash=True).repartition(5), most=50).collect()}
    want = {}
    for _, t in rows:
        p = b"\0\0" + (t or "").encode() + b"\0\0"
        for i in range(2, len(p) - 2):
            code = p[i] | p[i - 1] << 8 | p[i - 2] << 16 | p[i + 1] << 24 | p[i + 2] << 32
            want[code] = want.get(code, 0) + 1
    assert got == want


def test_gradient_against_differences():
    rng = np.random.default_rng(0)
    net, code = M.Network.fresh(4, 1), M.windows([b"abcabcabd"])[0]
    n = np.ones(len(code))
    before = -net.log_probs(M._split(code)[0])[np.arange(len(code)), code & 255].mean()
    for i in range(30):
        net = M._descend(net, code, n, 0.05, 64, i)
    after = -net.log_probs(M._split(code)[0])[np.arange(len(code)), code & 255].mean()
    assert after < 0.5 * before and rng is not None


def test_training_tells_prose_from_noise(spark):
    rng = np.random.default_rng(4)
    noise = "".join(chr(97 + int(i)) for i in rng.integers(0, 26, 300))
    df = H.docs(spark, [(i, H.PROSE) for i in range(30)] + [(99, noise)])
    net = M.fit(df, hidden=8, rounds=12, rate=0.1, share=300)
    got = {r["doc_id"]: r["lm_mean"] for r in M.score(df, net).collect()}
    assert got[0] > got[99] + 0.5
    assert M.score(H.empty(spark), M.fit(H.empty(spark))).count() == 0


def test_query(spark, sf_small):
    got = QUERIES["op1_masked_lm"](spark, sf_small)
    assert got.filter("n_tokens > 0 and (log_prob >= 0 or perplexity > 30)").count() < 0.05 * got.count()
    assert got.count() == spark.read.parquet(f"{sf_small}/documents.parquet").count()
