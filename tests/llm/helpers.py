"""Small tables with odd rows, and plain-Python versions of the operators."""

from __future__ import annotations

import hashlib
import re

PROSE = ("the quick brown fox jumps over the lazy dog and then rests under a tall tree near the river "
         "while birds sing above the hills and the evening light fades slowly over quiet fields of grain ")


def odd_texts() -> list[tuple[int | None, str | None]]:
    """Nulls, empty and blank texts, repeated rows, repeated and null ids, a
    very long text, a run of one character, multi-byte characters."""
    long = " ".join(f"word{i % 977}x{i * 7919 % 100003}" for i in range(60_000))
    return [
        (1, PROSE), (2, PROSE), (2, PROSE), (3, PROSE.upper()), (4, None), (5, ""), (6, " \n\t "), (7, long),
        (8, "a" * 1000), (9, "éà " * 200 + "ß日本語 🙂"), (None, PROSE + "tail"), (None, None), (10, "x"),
        (2, "another text under a repeated id"), (11, "12345 67890 !!"), (12, "one two"),
        (13, PROSE + PROSE[:120]), (14, "  double  spaces \n \n here   "),
    ]


def docs(spark, rows=None, clash: bool = False):
    """``documents`` with the given (doc_id, text) rows; ``clash`` adds columns
    named like the operators' own."""
    rows = odd_texts() if rows is None else rows
    df = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    if clash:
        for c in ("id", "k1", "k2", "r1", "r2", "body", "fp", "n", "row", "tag", "h", "lang_pred", "toxic_score",
                  "pii", "pii_found", "lm_tokens", "lm_body", "component", "root", "key", "part"):
            df = df.selectExpr("*", f"'clash' AS {c}")
    return df


def empty(spark):
    return docs(spark, [])


def ascii_lower(t: str) -> str:
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t)


# --- plain Python versions -------------------------------------------------------

def simhash(text: str | None, shingle: int = 3) -> int:
    import xxhash

    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    if not words:
        return 0
    parts = [" ".join(words[i:i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    votes = [0] * 64
    for p in parts:
        h = xxhash.xxh64_intdigest(p.encode(), 42)
        for b in range(64):
            votes[b] += h >> b & 1
    return sum(1 << b for b in range(64) if votes[b] * 2 > len(parts))


def groups(fps: list[int], distance: int = 3) -> list[int]:
    """For each fingerprint the index of its group's first member, all pairs compared."""
    parent = list(range(len(fps)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= distance:
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(fps))]


def bench_words(text: str | None) -> list[str]:
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def contamination(text: str | None, items: list[tuple], size: int = 10):
    """(n_words, hit positions, sorted item ids) of one text."""
    ws, hit, found = bench_words(text), set(), set()
    for item, t in items:
        iw = bench_words(t)
        n = min(size, len(iw))
        for i in range(len(iw) - n + 1 if n else 0):
            for p in range(len(ws) - n + 1):
                if ws[p:p + n] == iw[i:i + n]:
                    hit.update(range(p, p + n))
                    if item is not None:
                        found.add(str(item))
    return len(ws), hit, sorted(found)


def repeated(bodies: list[bytes], length: int = 200) -> list[list[bool]]:
    """Which bytes of each text lie in a string of ``length`` bytes that starts elsewhere too."""
    seen: dict[bytes, int] = {}
    for b in bodies:
        for i in range(len(b) - length + 1):
            seen[b[i:i + length]] = seen.get(b[i:i + length], 0) + 1
    out = []
    for b in bodies:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = [True] * length
        out.append(gone)
    return out


def feistel(left: int, right: int, a: int, b: int, key: str, tag: str) -> tuple[int, int]:
    def f(i, x):
        text = "|".join([key, tag, str(i), str(a), str(b), str(x)])
        return int(hashlib.sha256(text.encode()).hexdigest()[:15], 16)

    for i in range(8):
        if i % 2 == 0:
            left = (left + f(i, right)) % a
        else:
            right = (right + f(i, left)) % b
    return left, right


def permute_digits(s: str, key: str, tag: str, chunk: int = 18) -> str:
    out = ""
    for i in range(0, len(s), chunk):
        p = s[i:i + chunk]
        h = len(p) // 2
        x, y = feistel(int(p[:h] or 0), int(p[h:]), 10 ** h, 10 ** (len(p) - h), key, tag)
        out += (f"{x:0{h}d}" if h else "") + f"{y:0{len(p) - h}d}"
    return out


def luhn(digits: str) -> int:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c)
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total
