import zlib

from pyspark.sql import functions as F

from playlog.llm import langid
from playlog.llm.queries import QUERIES
from tests.llm.helpers import docs, empty


def _learned():
    return langid.LanguageModel({"en": langid.normalise("the and with this that from there which " * 30),
                                 "fr": langid.normalise("les des avec cette pour dans vous est une " * 30)})


def test_predicts_and_rejects(spark):
    rows = [(1, "this is from there and that"), (2, "vous avec cette pour une"), (3, None), (4, ""), (5, "12 34 !!")]
    got = {r["doc_id"]: r for r in langid.predict(docs(spark, rows, clash=True), _learned()).collect()}
    assert got[1]["lang_pred"] == "en" and got[2]["lang_pred"] == "fr"
    assert all(got[i]["lang_pred"] == "und" and got[i]["lang_score"] == 0 and got[i]["lang_rejected"] for i in (3, 4, 5))
    assert all(0.5 <= got[i]["lang_score"] <= 1 and not got[i]["lang_rejected"] for i in (1, 2))
    assert got[1]["k1"] == "clash"  # other columns pass


def test_ties_are_rejected_at_every_length(spark):
    same = langid.normalise("the and with this that " * 40)
    tie = langid._Coder(langid.LanguageModel({"a": same, "b": same}))
    for n in (1, 2, 20, 200, 2000, 20_000):
        lang, _, margin, rejected = tie.predict(("some words " * n)[:n])
        assert (lang, margin, rejected) == ("a", 0.0, True)  # the language with more labelled documents
    got = langid.predict(docs(spark, [(1, "q"), (2, "some words " * 60)]), tie.model).collect()
    assert all(r["lang_rejected"] for r in got)


def test_unknown_languages_are_rejected_or_apart():
    coder = langid._Coder(_learned())
    for text in ("kissa nukkuu sohvalla kun sade putoaa hiljaa kaupungin ylle", "今天天气很好我们一起去公园散步看花吃饭",
                 "zyx wvu " * 20):
        _, _, margin, rejected = coder.predict(text)
        assert margin >= 0.002 or rejected


def test_views_tell_short_texts_apart():
    """Where whole sizes tie, the means over the text's word starts may not."""
    coder = langid._Coder(_learned())
    sizes = coder.mean_sizes(b"one two three")
    every = [coder.sizes(b, coder.model.strong_level) for b in (b"one two three", b"two three", b"three")]
    assert sizes == [sum(x) / 3 for x in zip(*every)]
    few = langid._Coder(langid.LanguageModel(coder.model.dictionaries, views=2))
    assert few.mean_sizes(b"one two three") == [sum(x) / 2 for x in zip(*every[:2])]


def test_texts_without_a_letter_are_und(spark):
    rows = list(enumerate(["½", "² ①", "Ⅷ", "१२३", "\u0301\u0301", "12 ½ _ --", "🙂", " \t"]))
    got = langid.predict(docs(spark, rows), _learned()).collect()
    assert [(r["lang_pred"], r["lang_score"], r["lang_rejected"]) for r in got] == [("und", 0.0, True)] * len(rows)
    # numbers of any kind are no letters, marks stay with theirs
    assert langid.normalise("Abc² हिन्दी Ⅷ é_e\u0301 x1y") == "abc हिन्दी é e\u0301 x y".encode()


def test_every_sampled_document_teaches(spark):
    """Passages lie at hashed places and share the dictionary evenly."""
    rows = [(i, "zzqq opening " + " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{'abcdefghij'[j % 10]}x{'klmnop'[j % 6]}"
                         for j in range(900))) for i in range(600)]
    rows = [(i, t) for i, t in rows if zlib.crc32(str(i).encode()) % 3 != 1]
    content = langid.fit(docs(spark, rows), dict_bytes=20_000, sample_docs=100).dictionaries["en"]
    assert 15_000 < len(content) <= 20_000
    stems = {w[:2] for w in content.split() if len(w) == 5}
    assert len(stems) > 80
    assert content.count(b"zzqq") < 15  # texts don't teach by their beginnings
    few = langid.fit(docs(spark, rows[:3]), dict_bytes=9000).dictionaries["en"]
    assert 6000 < len(few) <= 9000  # fewer documents, longer passages


def test_matches_plain_compression(spark):
    import zstandard

    model = _learned()
    text = "That dog, which came from there with this one."
    body, sizes = langid.normalise(text), []
    for content in model.dictionaries.values():
        d = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        c = zstandard.ZstdCompressor(level=model.level, dict_data=d, write_content_size=False, write_checksum=False,
                                     write_dict_id=False)
        sizes.append(len(c.compress(body)))
    best = list(model.dictionaries)[sizes.index(min(sizes))]
    assert langid.predict(docs(spark, [(1, text)]), model).first()["lang_pred"] == best


def test_held_out_documents_never_teach(spark):
    out = [i for i in range(200) if zlib.crc32(str(i).encode()) % 3 == 1]
    df = docs(spark, [(i, "only held out words") for i in out])
    assert langid.fit(df).dictionaries == {}
    assert langid.fit(empty(spark)).dictionaries == {}
    assert langid.predict(empty(spark), langid.LanguageModel({})).count() == 0


def test_too_many_languages_is_an_error(spark):
    import pytest

    df = docs(spark, [(i, f"text {i}") for i in range(30)]).withColumn("lang", F.concat(F.lit("l"), "doc_id"))
    with pytest.raises(ValueError):
        langid.fit(df, max_languages=5)


def test_query_accuracy_on_held_out(spark, sf_small):
    got = QUERIES["op9_language_id"](spark, sf_small)
    assert got.columns[:4] == ["doc_id", "held_out", "lang_pred", "score"]
    j = got.join(spark.read.parquet(f"{sf_small}/documents.parquet"), "doc_id").filter("held_out")
    assert j.filter("lang = lang_pred").count() / j.count() > 0.95
    assert got.filter("lang_rejected" if "lang_rejected" in got.columns else "rejected").count() <= 0.02 * got.count()
