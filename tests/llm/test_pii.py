import datetime
import re

import pytest

from playlog.llm import pii
from playlog.llm.queries import QUERIES
from tests.llm import helpers as H

KEY = "test key"


def _one(spark, *texts):
    df = H.docs(spark, list(enumerate(texts)), clash=True)
    return [(r["text"], [tuple(p) for p in r["pii"]]) for r in pii.pseudonymise(df, KEY).orderBy("doc_id").collect()]


def test_digits_match_plain_feistel(spark):
    card, phone = "4539578763621486", "+1 (415) 555-2671"
    got = _one(spark, card, phone, "42.144.35.254", "123-45-6789")
    body = H.permute_digits(card[:-1], KEY, "card")
    assert got[0][0] == body + str(-H.luhn(body + "0") % 10) and H.luhn(got[0][0]) % 10 == 0
    d = H.permute_digits("4155552671", KEY, "phone")
    assert got[1][0] == f"+1 ({d[:3]}) {d[3:6]}-{d[6:]}"
    a, b = H.feistel(42 * 256 + 144, 35 * 256 + 254, 1 << 16, 1 << 16, KEY, "ip")
    assert got[2][0] == f"{a >> 8}.{a & 255}.{b >> 8}.{b & 255}"
    a, b = H.feistel(122 * 99 + 44, 6788, 898 * 99, 9999, KEY, "ssn")
    area = a // 99 + 1
    assert got[3][0] == f"{area + (area >= 666):03d}-{a % 99 + 1:02d}-{b + 1:04d}"


def test_dates_keep_their_form_and_stay_dates(spark):
    got = _one(spark, "1984-02-29", "31/12/1999", "12/31/1999", "5/6/2020", "7.8.2021", "31.04.2001", "1799-01-01")
    day = (datetime.date(1984, 2, 29) - datetime.date(1800, 1, 1)).days
    a, b = H.feistel(day // 773, day % 773, 189, 773, KEY, "date")
    assert got[0][0] == str(datetime.date(1800, 1, 1) + datetime.timedelta(a * 773 + b))
    assert re.fullmatch(r"\d\d/\d\d/\d{4}", got[1][0]) and re.fullmatch(r"\d\d?/\d\d?/\d{4}", got[3][0])
    x, y = (datetime.datetime.strptime(got[i][0], f).date() for i, f in ((1, "%d/%m/%Y"), (2, "%m/%d/%Y")))
    assert x == y  # the same day stays linked across forms
    assert [g[1] for g in got[5:]] == [[], []] and got[5][0] == "31.04.2001"


def test_permutation_of_a_whole_domain(spark):
    got = _one(spark, *[f"10.0.{i}.{j}" for i in range(3) for j in range(0, 250, 5)])
    assert len({g[0] for g in got}) == 150
    domain = {H.feistel(a, b, 7, 11, "k", "t") for a in range(7) for b in range(11)}
    assert domain == {(a, b) for a in range(7) for b in range(11)}


def test_iban_before_a_capital_word(spark):
    numbers = ["ES91 2100 0418 4502 0005 1332", "BE68 5390 0754 7034", "AT61 1904 3002 3457 3201",
               "SE45 5000 0000 0583 9825 7466", "PL61 1090 1014 0000 0712 1981 2874", "DE89 3704 0044 0532 0130 00",
               "NO93 8601 1117 947", "MT84 MALT 0110 0001 2345 MTLC AST0 01S"]
    texts = [f"pay {n}{end}" for n in numbers for end in (" BY Friday", " 2024", " ASAP OK", ".", "")]
    texts += [t.replace(n, n.replace(" ", "")) for n in numbers for t in texts if n in t]
    for text, (after, found) in zip(texts, _one(spark, *texts), strict=True):
        assert [k for k, _ in found] == ["iban"], text
        code = found[0][1].replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in code[4:] + code[:4])) % 97 == 1
        assert found[0][1] not in text and found[0][1] in after and len(after) == len(text)
    assert _one(spark, "pay ES91 2100 0418 4502 0005 1333 BY Friday")[0][1] == []


def test_links_and_forms(spark):
    got = _one(spark, "GB82 WEST 1234 5698 7654 32 and GB82WEST12345698765432", "Bos.T42@x.example.com bos.t42@x.example.com",
               "(415) 555-2671 415-555-2671 +49 30 12345678")
    iban = got[0][1]
    assert iban[0][1].replace(" ", "") == iban[1][1] and iban[0][1][:2] == "GB"
    moved = iban[1][1][4:] + iban[1][1][:4]
    assert int("".join(str(int(c, 36)) for c in moved)) % 97 == 1
    mail = got[1][1]
    assert mail[0][1] == mail[1][1] and re.fullmatch(r"[a-z]{3}\.[a-z]\d\d@x\.example\.com", mail[0][1])
    assert mail[0][1] != "bos.t42@x.example.com"
    assert [k for k, _ in got[2][1]] == ["phone"] * 3


@pytest.mark.parametrize("text", [
    "", "no numbers at all", "4539578763621487", "300.1.1.1", "1.2.3.4.5", "version 4.0.", "000-12-3456 666-12-3456",
    "GB00WEST12345698765432", "token = \"0641917ea4e9feb9cda83477b57ac2654884f485\"", "2021 100 2000", "a@b"])
def test_clean_texts_stay(spark, text):
    assert _one(spark, text) == [(text, [])]


def test_neighbours_do_not_hide_a_value(spark):
    got = _one(spark, "ring +1 (389) 555-5010 4539578763621486 42.144.35.254 then x.y@mail.example.com.")
    assert [k for k, _ in got[0][1]] == ["phone", "card", "ip", "email"]
    assert got[0][0].startswith("ring +1 (") and got[0][0].endswith("@mail.example.com.")


@pytest.mark.parametrize("labels", [2_000, 20_000, 1_000_000])
def test_long_chains_of_labels(spark, labels):
    """No text is too long for the matcher, whatever groups repeat in it."""
    texts = ["x@" + "a." * labels + "com", "bos@" + "ab." * labels + "com", "x@a" + "-a" * labels + ".com",
             "x@" + "a" * labels + ".com", "a." * labels + "b@mail.example.com", "GB82" + " WEST" * labels,
             "+1 " + "415 " * labels, "1.2." * labels, "12-" * labels, "x@a" * labels, "(415) " * labels]
    got = _one(spark, *texts)
    assert got[0] == (texts[0], [])  # no label of two letters within the length of a name
    name, domain = got[1][0].split("@", 1)
    assert domain == texts[1].split("@", 1)[1] and len(name) == 3 and [k for k, _ in got[1][1]] == ["email"]
    assert got[1][1][0][1] == name + "@" + "ab." * 126 + "ab"
    assert [len(g[0]) for g in got] == list(map(len, texts))
    assert got[5] == (texts[5], [])


def test_domains_of_usual_length(spark):
    hosts = ("x.example.com", "a.de", "x" * 63 + ".org", "a-b.c--d.example.museum", ".".join(["label"] * 40) + ".com",
             "1.2.3.io")
    got = _one(spark, *[f"to bos.t42@{host}, or not" for host in hosts])
    for host, (after, found) in zip(hosts, got):
        assert found == [("email", after[3:-8])] and after.endswith(f"@{host}, or not")
    assert len({found[0][1].split("@")[0] for _, found in got}) == 1


def test_odd_rows(spark):
    rows = H.odd_texts()
    got = pii.pseudonymise(H.docs(spark, rows, clash=True), KEY).collect()
    assert len(got) == len(rows)
    assert sum(r["text"] is None for r in got) == 2 and all(r["pii"] == [] for r in got if not r["text"])
    assert {r["pii_found"] for r in got} == {"clash"}
    assert pii.pseudonymise(H.empty(spark), KEY).count() == 0


def test_main_path_is_native(spark, sf_small):
    plan = QUERIES["op4_pii"](spark, sf_small)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Arrow|Pandas|Exchange", plan)
