"""Format-preserving pseudonyms for personal numbers, dates and addresses.

Candidates are found by one pattern, validated (Luhn digit, mod-97 digits,
octet ranges, calendar, issuable number ranges, dial lengths), and each valid value is replaced by
a keyed permutation of its own format: an eight-round Feistel network whose
round function is a SHA-256 of key, kind and half. The permutation depends on
the value alone, so equal values stay linked across documents and no table of
values is kept or joined. Separators, lengths, country codes and mail domains
stay; check digits are made anew, so a pseudonym is again valid.

kind     validated by                         permuted domain
email    shape                                letters and digits of the name (case folded)
iban     mod-97 check digits                  digits of the account part; check digits renewed
card     13 to 19 digits, Luhn                all digits but the last; Luhn digit renewed
ssn      issuable area, group and serial      area x group, serial
ip       four octets below 256                two 16-bit halves
phone    8 to 15 digits                       digits after the country code
date     calendar, 1800 to 2199               days of the 400-year cycle, 189 x 773

Only DataFrame functions are used and no row moves: one pass, no shuffle.

Results for odd input: a null or empty text stays as it is, with no findings.
Values that fail validation stay as they are. A mail domain is read up to 127
labels of at most 63 characters; of a longer chain of labels the first ones
that can be a domain count. Repeated rows get the same answer. Existing columns named as the results are replaced.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playlog.llm import common as C

ROUNDS = 8
_WORD = r"\p{L}\p{N}_"
_OCTET = r"(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])"
# characters of a country's numbers
_IBAN_SIZES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 33: "RU",
}
_END = f"(?![{_WORD}])"


def _sized(size: int, countries: str) -> str:
    groups, rest = divmod(size - 4, 4)
    tail = f"(?: ?[A-Z0-9]{{{rest}}})" if rest else ""
    return f"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[A-Z0-9]{{4}}){{{groups}}}{tail}{_END}"


# A name of the domain system: labels of at most 63 characters, at most 253 in all. The matcher calls itself once
# for each repeat of a group that may be undone, so repeats of groups are bounded and a label is taken whole.
_LABEL = r"(?>[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?)"
_DOMAIN = _LABEL + r"(?:\." + _LABEL + r"){0,125}\.[A-Za-z]{2,63}"
# in the order in which they are tried at a place
PATTERNS = {
    "email": r"[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9_%+-])?@" + _DOMAIN,
    # of the country's length where that ends at a word's end, else of any length
    "iban": "(?:" + "|".join(_sized(n, c) for n, c in _IBAN_SIZES.items())
            + r"|[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?)",
    "date": r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}|[0-9]{1,2}\.[0-9]{1,2}\.[0-9]{4})",
    "ip": _OCTET + r"(?:\." + _OCTET + r"){3}(?!\.[0-9])",
    "ssn": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "card": r"(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){3}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5})",
    "phone": r"(?:\+[0-9]{1,3} [0-9](?: [0-9]{2}){4}|\+[0-9]{1,3} [0-9]{2,4} [0-9]{5,8}"
             r"|\+[0-9]{1,3}[ .-]?(?:\([0-9]{2,4}\)|[0-9]{2,4})[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}|\+[0-9]{8,15}"
             r"|(?:1[ .-])?(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4})",
}
# what may not stand right before a candidate
_BEFORE = {"email": r"\p{L}\p{N}_.%+-", "date": r"\p{L}\p{N}_.+-", "ip": r"\p{L}\p{N}_.+-",
           "phone": r"\p{L}\p{N}_+(.-"}
CANDIDATE = "|".join(f"(?<![{_BEFORE.get(k, _WORD)}]){p}{_END}" for k, p in PATTERNS.items())
_WORTH = "[0-9@]"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def _feistel(left: Column, right: Column, a: Column, b: Column, key: str, tag: str) -> Column:
    """Permutation of the pairs below (a, b) as a struct (l, r)."""
    def prf(i, x):
        h = F.sha2(F.concat_ws("|", F.lit(key), F.lit(tag), i.cast("string"), a.cast("string"), b.cast("string"),
                               x.cast("string")), 256)
        return F.conv(F.substring(h, 1, 15), 16, 10).cast("long")

    def step(s, i):
        even = i % 2 == 0
        return F.struct(F.when(even, F.pmod(s["l"] + prf(i, s["r"]), a)).otherwise(s["l"]).alias("l"),
                        F.when(even, s["r"]).otherwise(F.pmod(s["r"] + prf(i, s["l"]), b)).alias("r"))

    start = F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))
    return F.aggregate(F.array(*[F.lit(i) for i in range(ROUNDS)]), start, step)


_LETTERS, _NUMERALS = "abcdefghijklmnopqrstuvwxyz", "0123456789abcdefghijklmnop"


def _permute(text: Column, base: int, key: str, tag: str, chunk: int = 18) -> Column:
    """Permutation of strings over digits (base 10) or small letters (base 26)
    of the same length, in chunks of ``chunk`` symbols."""
    power = F.array(*[F.lit(base ** i).cast("long") for i in range(chunk // 2 + 1)])

    def number(x):
        x = F.translate(x, _LETTERS, _NUMERALS) if base == 26 else x
        return F.conv(F.concat(F.lit("0"), x), base, 10).cast("long")

    def text_of(x, n):
        s = F.lower(F.conv(x.cast("string"), 10, base))
        s = F.when(n == 0, F.lit("")).otherwise(F.lpad(s, n, "0"))
        return F.translate(s, _NUMERALS, _LETTERS) if base == 26 else s

    def one(s):
        n = F.length(s)
        half = F.floor(n / 2).cast("int")

        def mixed(h):
            lr = _feistel(number(s.substr(F.lit(1), h)), number(s.substr(h + 1, n - h)), F.get(power, h),
                          F.get(power, n - h), key, tag)
            return _let(lr, lambda x: F.concat(text_of(x["l"], h), text_of(x["r"], n - h)))

        return _let(half, mixed)

    last = F.floor((F.length(text) - 1) / chunk).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                        lambda k: _let(text.substr(k * chunk + 1, F.lit(chunk)), one))
    return F.array_join(parts, "")


def _refill(form: Column, slot: str, symbols: Column) -> Column:
    """``form`` with the places that match ``slot`` taken by ``symbols`` in order."""
    gaps = F.split(form, slot, -1)
    filled = F.zip_with(gaps, F.concat(F.split(symbols, ""), F.array(F.lit(""))),
                        lambda g, s: F.concat(g, F.coalesce(s, F.lit(""))))
    return F.when(F.length(symbols) == 0, form).otherwise(F.array_join(filled, ""))


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Luhn sum, the last digit counted once."""
    def add(s, i):
        d = F.reverse(digits).substr(i, F.lit(1)).cast("int")
        return s + F.when(i % 2 == 1, d).when(d > 4, 2 * d - 9).otherwise(2 * d)

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add)


def _mod97(code: Column) -> Column:
    """Remainder of a string of digits and capitals, letters as 10 to 35."""
    def add(s, i):
        n = F.instr(F.lit("0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ"), code.substr(i, F.lit(1))) - 1
        return F.pmod(s * F.when(n > 9, 100).otherwise(10) + n, F.lit(97)).cast("int")

    return F.aggregate(F.sequence(F.lit(1), F.length(code)), F.lit(0), add)


def _email(v: Column, key: str) -> Column:
    def local(x):
        letters = _permute(F.regexp_replace(x, "[^a-z]", ""), 26, key, "email-letters")
        return _let(_refill(x, "[a-z]", letters), lambda y: _refill(
            y, "[0-9]", _permute(_digits(y), 10, key, "email-digits")))

    at = F.instr(v, "@")
    return F.concat(_let(F.lower(v.substr(F.lit(1), at - 1)), local), v.substr(at, F.length(v)))


def _iban(v: Column, key: str) -> Column:
    def fresh(code):
        account = code.substr(F.lit(5), F.length(code))

        def renew(new):
            country = code.substr(F.lit(1), F.lit(2))
            check = F.lpad((98 - _mod97(F.concat(new, country, F.lit("00")))).cast("string"), 2, "0")
            return _refill(v, "[A-Z0-9]", F.concat(country, check, new))

        return F.when(_mod97(F.concat(account, code.substr(F.lit(1), F.lit(4)))) == 1, _let(
            _refill(account, "[0-9]", _permute(_digits(account), 10, key, "iban")), renew)).otherwise(F.lit(None))

    return _let(F.regexp_replace(v, " ", ""), fresh)


def _card(v: Column, key: str) -> Column:
    def fresh(d):
        def renew(body):
            check = F.pmod(10 - F.pmod(_luhn(F.concat(body, F.lit("0"))), F.lit(10)), F.lit(10))
            return _refill(v, "[0-9]", F.concat(body, check.cast("string")))

        body = d.substr(F.lit(1), F.length(d) - 1)
        return F.when(_luhn(d) % 10 == 0, _let(_permute(body, 10, key, "card"), renew)).otherwise(F.lit(None))

    return _let(_digits(v), fresh)


def _ssn(v: Column, key: str) -> Column:
    def fresh(p):
        area, group, serial = (p[i].cast("int") for i in range(3))
        place = area - 1 - F.when(area > 666, 1).otherwise(0)

        def text(x):
            at = F.floor(x["l"] / 99).cast("int") + 1
            return F.concat_ws("-", F.lpad((at + F.when(at >= 666, 1).otherwise(0)).cast("string"), 3, "0"),
                               F.lpad((x["l"] % 99 + 1).cast("string"), 2, "0"),
                               F.lpad((x["r"] + 1).cast("string"), 4, "0"))

        valid = (area > 0) & (area < 900) & (area != 666) & (group > 0) & (serial > 0)
        return F.when(valid, _let(_feistel(place * 99 + group - 1, serial - 1, F.lit(898 * 99).cast("long"),
                                           F.lit(9999).cast("long"), key, "ssn"), text)).otherwise(F.lit(None))

    return _let(F.split(v, "-"), fresh)


def _ip(v: Column, key: str) -> Column:
    def fresh(p):
        o = [p[i].cast("long") for i in range(4)]
        whole = F.lit(1 << 16).cast("long")
        return _let(_feistel(o[0] * 256 + o[1], o[2] * 256 + o[3], whole, whole, key, "ip"), lambda x: F.concat_ws(
            ".", *[F.pmod(F.floor(x[h] / d), F.lit(256)).cast("string") for h in "lr" for d in (256, 1)]))

    return _let(F.split(v, r"\."), fresh)


def _phone(v: Column, key: str) -> Column:
    # a country code is what a plus sign begins and a separator ends
    head = F.regexp_extract(v, r"^\+[0-9]{1,3}(?=[ .(-])", 0)
    rest = v.substr(F.length(head) + 1, F.length(v))
    return F.when(F.length(_digits(v)).between(8, 15), F.concat(head, _let(rest, lambda r: _refill(
        r, "[0-9]", _permute(_digits(r), 10, key, "phone"))))).otherwise(F.lit(None))


def _date(v: Column, key: str) -> Column:
    iso = F.substring(v, 5, 1) == "-"
    sep = F.regexp_extract(v, "[-/.]", 0)

    def fresh(p):
        n = [p[i].cast("int") for i in range(3)]
        # with slashes the month comes first unless that cannot be
        month_first = (sep == "/") & (n[0] <= 12)
        y = F.when(iso, n[0]).otherwise(n[2])
        m = F.when(iso | ~month_first, n[1]).otherwise(n[0])
        d = F.when(iso, n[2]).when(month_first, n[1]).otherwise(n[0])
        leap = (y % 4 == 0) & ((y % 100 != 0) | (y % 400 == 0))
        days = F.when(m == 2, F.when(leap, 29).otherwise(28)).when(m.isin(4, 6, 9, 11), 30).otherwise(31)
        valid = y.between(1800, 2199) & m.between(1, 12) & (d >= 1) & (d <= days)
        first = F.make_date(F.lit(1800), F.lit(1), F.lit(1))

        def text(x):
            day = F.date_add(first, (x["l"] * 773 + x["r"]).cast("int"))

            def part(value, like):
                return F.when(F.length(like) == 2, F.lpad(value.cast("string"), 2, "0")).otherwise(
                    value.cast("string"))

            yy, mm, dd = F.year(day), F.month(day), F.dayofmonth(day)
            return F.when(iso, F.concat_ws("-", yy.cast("string"), part(mm, p[1]), part(dd, p[2]))).when(
                month_first, F.concat_ws("/", part(mm, p[0]), part(dd, p[1]), yy.cast("string"))).otherwise(
                F.concat(part(dd, p[0]), sep, part(mm, p[1]), sep, yy.cast("string")))

        index = F.datediff(F.make_date(y, m, d), first)
        return F.when(valid, _let(_feistel(F.floor(index / 773), index % 773, F.lit(189).cast("long"),
                                           F.lit(773).cast("long"), key, "date"), text)).otherwise(F.lit(None))

    return _let(F.split(v, "[-/.]"), fresh)


_REPLACE = {"email": _email, "iban": _iban, "date": _date, "ip": _ip, "ssn": _ssn, "card": _card, "phone": _phone}


def pseudonym(value: Column, key: str) -> Column:
    """Struct (kind, after) of one candidate; kind null where it failed validation."""
    kind = F.lit(None).cast("string")
    for k in reversed(PATTERNS):
        kind = F.when(value.rlike(f"^(?:{PATTERNS[k]})$"), F.lit(k)).otherwise(kind)

    def replaced(k):
        after = F.lit(None).cast("string")
        for name, fn in _REPLACE.items():  # each gives null for a value that fails its check
            after = F.when(k == name, fn(value, key)).otherwise(after)
        return _let(after, lambda a: F.struct(
            F.when(a.isNotNull(), k).alias("kind"), F.coalesce(a, value).alias("after")))

    return _let(kind, replaced)


def pseudonymise(docs: DataFrame, key: str, text: str = "text") -> DataFrame:
    """``docs`` with the text's valid values replaced, and pii: an array of
    (kind, after) of each replacement in order. The key decides every
    pseudonym; keep it secret (it is a literal of the plan)."""
    kept = C.without(docs, "pii")
    spare = "pii_found"
    while spare in {c.lower() for c in kept.columns}:
        spare += "_"
    none = F.expr("cast(array() as array<struct<kind:string,after:string>>)")
    body = F.col(f"`{text}`")
    found = kept.withColumn(spare, F.when(body.rlike(_WORTH), F.transform(
        F.regexp_extract_all(body, F.lit(CANDIDATE), F.lit(0)), lambda v: pseudonym(v, key))).otherwise(none))
    after = F.concat(F.transform(spare, lambda x: x["after"]), F.array(F.lit("")))
    rebuilt = F.array_join(F.zip_with(F.split(body, CANDIDATE, -1), after, lambda g, a: F.concat(g, a)), "")
    valid = F.filter(spare, lambda x: x["kind"].isNotNull())
    return found.withColumns({text: F.when(F.size(valid) > 0, rebuilt).otherwise(body), "pii": valid}).drop(spare)
