"""Small frames with the awkward rows, and brute-force versions of the operators."""

from __future__ import annotations

import re
import zlib
from itertools import combinations

import xxhash

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = "the quick brown fox jumps over a lazy dog while rain falls on old roofs and cats sleep by warm stoves".split()


def prose(seed: int, n: int = 60) -> str:
    out = []
    for i in range(n):
        out.append(WORDS[(seed * 7919 + i * i * 31 + i * seed) % len(WORDS)] + ("." if i % 9 == 8 else ""))
    return " ".join(out)


def awkward():
    base = prose(1)
    rows = [
        (1, base, "en", "a", 1),
        (2, base, "en", "a", 1),  # copy
        (3, base.upper(), "en", None, 1),  # copy but for case
        (4, "", None, "b", 0),
        (5, None, None, "b", None),
        (6, " \n\t \n", "en", "b", 5),
        (7, "one", "en", "b", 3),
        (8, "two words", "en", "b", 9),
        (9, prose(2) + "\n" + prose(3) + "\n" + prose(2), "en", "c", 1),
        (10, prose(3)[:-1] + "\n" + prose(4), "en", "c", 1),
        (11, "x" * 5000 + " " + "y" * 200, "en", "c", 1),
        (12, "\n".join(prose(s, 400) for s in range(20, 40)), "en", "c", 1),  # long
        (13, "Émile ÉÀÜ ß œuvre İstanbul ΣΑΣ 日本語 😀👍🏽 don’t <|endoftext|> a<|startoftext|>b", "fr", "d", 1),
        (None, prose(5), "en", "d", 1),  # no id
        (14, prose(6), "en", "d", 1),
        (14, prose(7), "en", "d", 1),  # id twice
        (15, prose(8), "en", "d", 1),
        (15, prose(8), "en", "d", 1),  # row twice
    ]
    return rows


def clashing(df):
    """Extra columns whose names the operators use inside."""
    from pyspark.sql import functions as F

    names = "fp _row line key h sha row range first block ids bucket c0 c1 s x label d place _drop tie score start".split()
    return df.select("*", *[F.lit(1).alias(n) for n in names])


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        parent[find(a)] = find(b)
    groups = {}
    for n in nodes:
        groups.setdefault(find(n), []).append(n)
    return groups


def close_pairs(values, most):
    return [(a, b) for a, b in combinations(values, 2) if (a ^ b).bit_count() <= most]


def crc_le32(ids):
    import numpy as np

    return zlib.crc32(np.asarray(ids, "<u4").tobytes())


def edit_distance(a, b):
    above = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row = [i]
        for j, y in enumerate(b, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + (x != y)))
        above = row
    return above[-1]
