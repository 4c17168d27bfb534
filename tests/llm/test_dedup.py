"""SimHash, line dedup, exact dedup and their helpers against brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import exact_dedup, graph, line_dedup, queries, simhash
from quarry.llm.sketch import bloom, may_contain
from llm_helpers import SCHEMA, awkward, clashing, close_pairs, components, edit_distance, fingerprint, prose

SF = "/root/testdata/sf0.001"


def test_fingerprints_equal_brute_force(monkeypatch):
    for step in (simhash.STEP, 7):
        monkeypatch.setattr(simhash, "STEP", step)
        for _, text, *_ in awkward():
            assert simhash.fingerprint(text) == fingerprint(text)


def test_anchors_cover():
    rng = np.random.default_rng(5)
    half = rng.integers(0, 1 << 31, 500, dtype=np.uint64)
    home, near = simhash.anchors_of(half)
    assert (np.bitwise_count(half ^ home) <= 1).all()
    assert (np.bitwise_count(near ^ half[:, None]) <= 2).all()
    assert (simhash._syndrome(near.ravel()) == 0).all()
    for _ in range(20):  # a neighbour at one bit finds the home anchor among its own
        other = half ^ (np.uint64(1) << rng.integers(0, 31, 500, dtype=np.uint64))
        assert (simhash.anchors_of(other)[1] == home[:, None]).any(axis=1).all()


@pytest.mark.parametrize("salts", [1, 3])
def test_links_join_whatever_is_close(spark, salts):
    rng = random.Random(8)
    values = {rng.getrandbits(64) for _ in range(150)}
    for v in list(values)[:60]:  # clusters, some chains
        for _ in range(rng.randint(1, 6)):
            for _ in range(rng.randint(1, 4)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    values |= {0, 1, 7, 15, (1 << 64) - 1, (1 << 63), (1 << 31) | (1 << 63)}
    signed = [(v - (1 << 64) if v >> 63 else v,) for v in values]
    got = simhash.links(spark.createDataFrame(signed, "fp long"), salts=salts).collect()
    mask = (1 << 64) - 1
    pairs = {(r.a & mask, r.b & mask) for r in got}
    want = close_pairs(sorted(values), 3)
    assert all((a ^ b).bit_count() <= 3 and a != b for a, b in pairs)
    assert sorted(map(sorted, components(pairs, values).values())) == sorted(map(sorted, components(want, values).values()))


def brute_simhash(rows):
    of = [(key, fingerprint(text)) for key, text in rows]
    groups = components(close_pairs(sorted({f for _, f in of}), 3), {f for _, f in of})
    root = {f: r for r, fs in groups.items() for f in fs}
    least = {}
    for key, f in of:
        if key is not None:
            least[root[f]] = min(key, least.get(root[f], key))
    return Counter((key, f"{f:016x}", least.get(root[f])) for key, f in of)


def test_op9_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    got = Counter(tuple(r) for r in queries.op9_simhash(spark, "/root/testdata/sf0.01").collect())
    assert got == brute_simhash(rows)


def test_simhash_awkward_rows(spark):
    docs = clashing(spark.createDataFrame(awkward(), SCHEMA))
    want = brute_simhash([(r[0], r[1]) for r in awkward()])
    assert Counter(tuple(r) for r in simhash.components(docs).collect()) == want
    kept = simhash.near_dedup(docs)
    assert kept.columns == docs.columns
    got = kept.collect()
    values = {fingerprint(r[1]) for r in awkward()}
    assert len(got) == len(components(close_pairs(sorted(values), 3), values))
    assert {r.doc_id for r in got} == {c for _, _, c in want}
    assert simhash.near_dedup(docs.limit(0)).count() == 0 and simhash.components(docs.limit(0)).count() == 0


def test_near_dedup_splits_a_hot_group(spark):
    """A group of near copies of one text: one stays, whatever the salting."""
    words = prose(3, 400).split()
    rows = []
    for i in range(200):
        own = words[:]
        own[(i * 13) % 400] = f"w{i}"
        rows.append((i, " ".join(own), "en", "a", 1))
    docs = spark.createDataFrame(rows, SCHEMA)
    want = brute_simhash([(r[0], r[1]) for r in rows])
    assert Counter(tuple(r) for r in simhash.components(docs).collect()) == want


def test_connected_components(spark):
    rng = random.Random(2)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(180)] + [(1000 + i, 1001 + i) for i in range(60)] + [(5, 5), (7, 9), (9, 7)]
    nodes = {n for a, b in edges if a != b for n in (a, b)}
    got = {r.node: r.root for r in graph.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {n: min(ns) for ns in components([e for e in edges if e[0] != e[1]], nodes).values() for n in ns}
    assert got == want
    assert graph.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bloom_filter_never_loses(spark):
    keys = spark.range(0, 3000, 3).withColumnRenamed("id", "k")
    words = bloom(keys, "k", 16)
    seen = {r.id for r in spark.range(9000).where(may_contain(words, F.col("id"), 16)).collect()}
    assert set(range(0, 3000, 3)) <= seen and len(seen) < 1500
    assert spark.range(10).where(may_contain(bloom(keys.limit(0), "k", 12), F.col("id"), 12)).count() == 0


# ---- lines -----------------------------------------------------------------------------


@pytest.mark.parametrize("k", [1, 2, 3])
def test_banded_distance(spark, k):
    rng, rows = random.Random(k), [("", ""), ("a", ""), ("", "abc"), ("ab" * 40, "ba" * 40)]
    for _ in range(600):
        a = "".join(rng.choice("abé😀") for _ in range(rng.choice([0, 1, 2, 3, 5, 8, 20, 70])))
        b = list(a)
        for _ in range(rng.randint(0, 4)):
            i = rng.randint(0, len(b))
            kind = rng.random()
            if kind < 0.34 or not b:
                b.insert(i, rng.choice("abé"))
            elif kind < 0.67:
                del b[min(i, len(b) - 1)]
            else:
                b[min(i, len(b) - 1)] = rng.choice("abz")
        rows.append((a, "".join(b)))
    df = spark.createDataFrame(rows, "a string, b string")
    for r in df.select("a", "b", line_dedup.edit_distance_within(F.col("a"), F.col("b"), k).alias("d")).collect():
        d = edit_distance(r.a, r.b)
        assert r.d == (d if d <= k else None), (r.a, r.b)


def mutated_lines():
    rng, lines = random.Random(4), []
    for s in range(25):
        line = prose(s, 10 + s % 5)
        lines.append(line)
        for _ in range(5):
            own = list(line)
            for _ in range(rng.randint(1, 4)):
                i = rng.randrange(len(own))
                own[i : i + 1] = rng.choice([[], ["q"], ["q", own[i]]])
            lines.append("".join(own))
    return sorted(set(lines))


def test_near_links_lose_nothing(spark):
    lines = mutated_lines()
    got = line_dedup.near_links(spark.createDataFrame([(x,) for x in lines], "line string")).collect()
    digest = {hashlib.md5(x.encode()).digest(): x for x in lines}
    pairs = {frozenset((digest[bytes(r.a)], digest[bytes(r.b)])): r.distance for r in got}
    want = {}
    for i, a in enumerate(lines):
        for b in lines[i + 1 :]:
            if abs(len(a) - len(b)) <= 2 and min(len(a), len(b)) >= line_dedup.NEAR_CHARS and (d := edit_distance(a, b)) <= 2:
                want[frozenset((a, b))] = d
    assert pairs == want and len(want) > 50


def test_lines_of_20_to_39_characters_are_linked(spark):
    """Every line of 20 characters or more takes part in the edit join, the shortest too."""
    rng, lines = random.Random(6), ["Thwhesnd. Esator whshing and hewh.", "Thwhesnd, esator whshing and hewh."]
    for n in range(20, 40):
        line = "".join(rng.choice("etaonrihsd ,.") for _ in range(n - 1)) + "."
        lines.append(line)
        for _ in range(4):
            own = list(line)
            for _ in range(rng.randint(1, 3)):
                i = rng.randrange(len(own))
                own[i : i + 1] = rng.choice([["q"], ["q", own[i]], []] if len(own) > 20 else [["q"], ["q", own[i]]])
            lines.append("".join(own))
    lines = sorted(set(lines))
    docs = spark.createDataFrame([(i, x, "en", "a", 1) for i, x in enumerate(lines)], SCHEMA)
    close = [(i, j) for j in range(len(lines)) for i in range(j) if edit_distance(lines[i], lines[j]) <= 2]
    degree, first = Counter(i for pair in close for i in pair), {}
    for ids in components(close, range(len(lines))).values():
        first |= dict.fromkeys(ids, min(ids))
    got = {r.doc_id: (r["first"].doc_id, r.links, r.kept) for r in line_dedup.line_classes(docs).collect()}
    assert got == {i: (first[i], degree[i], first[i] == i) for i in range(len(lines))} and len(close) > 60


def brute_dedup(rows):
    """Texts after dropping every line whose class has an earlier place."""
    def order(key, text):
        return (key is None, key or 0, text)

    lines = {}
    for key, text in sorted({(r[0], r[1]) for r in rows if r[1] is not None}, key=lambda r: order(*r)):
        for i, line in enumerate(text.split("\n")):
            if len(line) >= line_dedup.MIN_CHARS and line.strip(" "):
                lines.setdefault(line, (order(key, text), i))
    names = list(lines)
    links = [
        (a, b)
        for i, a in enumerate(names)
        for b in names[i + 1 :]
        if abs(len(a) - len(b)) <= 2 and min(len(a), len(b)) >= line_dedup.NEAR_CHARS and edit_distance(a, b) <= 2
    ]
    first = {n: min(lines[m] for m in ns) for ns in components(links, names).values() for n in ns}
    out = Counter()
    for r in rows:
        if r[1] is None:
            out[(r[0], None)] += 1
            continue
        kept = [x for i, x in enumerate(r[1].split("\n")) if x not in first or first[x] == (order(r[0], r[1]), i)]
        out[(r[0], "\n".join(kept))] += 1
    return out


def test_line_dedup_awkward_rows(spark):
    rows = [r for r in awkward() if r[0] != 14]  # rows of one id are ordered by a hash
    rows += [(20 + i, "\n".join(mutated_lines()[i::6]) + "\n\nshort\nshort", "en", "a", 1) for i in range(6)]
    docs = clashing(spark.createDataFrame(rows, SCHEMA))
    got = line_dedup.dedup(docs)
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == brute_dedup(rows)
    assert line_dedup.dedup(docs.limit(0)).count() == 0
    assert line_dedup.line_classes(docs.limit(0)).count() == 0


def test_line_dedup_plan_has_no_python(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for df in (line_dedup.dedup(docs), exact_dedup.exact_groups(docs)):
        assert "Python" not in df._jdf.queryExecution().executedPlan().toString()


# ---- exact copies ----------------------------------------------------------------------


def brute_exact(rows):
    groups = {}
    for r in rows:
        t = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1] or "")
        groups.setdefault(t, []).append(r[0])
    out = Counter()
    for t, keys in groups.items():
        keep = max((k for k in keys if k is not None), default=None)
        sha = hashlib.sha256(t.encode()).hexdigest()
        for i, k in enumerate(keys):
            first = k == keep and keys.index(keep) == i
            out[(k, keep, len(keys), first, sha)] += 1
    return out


def test_exact_dedup_awkward_rows(spark):
    rows = awkward() + [(30 + i, f"Copy {i % 3}", "en", "hot", 1) for i in range(40)]
    docs = clashing(spark.createDataFrame(rows, SCHEMA))
    for sizes in ({}, {"capacity": 1, "min_depth": 1, "max_depth": 5}):
        got = exact_dedup.exact_groups(docs, **sizes).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")
        assert Counter(tuple(r) for r in got.collect()) == brute_exact(rows)
    assert exact_dedup.exact_groups(docs.limit(0)).count() == 0
    known = docs.where("doc_id is not null")
    assert exact_dedup.drop_copies(known).count() == len({k for k in brute_exact([r for r in rows if r[0] is not None]) if k[3]})


def test_directory_splits_overfull_buckets(spark):
    hashes = spark.range(4000).select(F.xxhash64("id").alias("h"))
    cells = exact_dedup.directory(hashes, capacity=50, min_depth=2, max_depth=12)
    sized = (
        hashes.withColumn("cell", F.shiftrightunsigned("h", 52)).join(cells, "cell").groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    ).collect()
    assert sum(r.n for r in sized) == 4000 and max(r.n for r in sized) <= 50
    depths = {int(r.bucket.split(":")[0]) for r in sized}
    assert min(depths) >= 6
    # prefixes of leaves do not contain each other
    paths = sorted(r.bucket.split(":")[1] for r in sized)
    assert not any(b.startswith(a) for a, b in zip(paths[:-1], paths[1:], strict=True))


def test_colliding_hashes_are_chained(spark, monkeypatch):
    """With a hash of two values only, byte comparison tells the texts of a chain apart."""
    monkeypatch.setattr(exact_dedup, "hashed", lambda c: F.char_length(c).cast("long") % 2)
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(["aa", "bb", "AA", "c", "d", "bb", "e", "D"])]
    got = exact_dedup.exact_groups(spark.createDataFrame(rows, SCHEMA)).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got) == brute_exact(rows)
    assert {(r.text_sha256, r.chain) for r in got} and len({r.chain for r in got}) == 3


def test_texts_of_equal_hash_and_digest_are_told_apart(spark, monkeypatch):
    """Hash and SHA-256 both collide: byte-compared chains decide the groups, a row a document."""
    monkeypatch.setattr(exact_dedup, "hashed", lambda c: F.lit(3).cast("long"))
    monkeypatch.setattr(exact_dedup, "digested", lambda c: F.unhex(F.lit("00" * 32)))
    rows = [(i, t, "en", "a", 1) for i, t in enumerate(["aa", "bb", "AA", "c", "bb", "é", "É", None, ""] * 3)]
    for common in (exact_dedup.COMMON, 2):  # 2: every text is dealt over parts
        monkeypatch.setattr(exact_dedup, "COMMON", common)
        got = exact_dedup.exact_groups(spark.createDataFrame(rows, SCHEMA)).collect()
        want = {key[:4] for key in brute_exact(rows)}
        assert len(got) == len(rows) and {(r.doc_id, r.keep_id, r.group_size, r.kept) for r in got} == want
        assert len({r.chain for r in got}) == len({r.keep_id for r in got}) == 6


def test_directory_depth_follows_the_rows():
    depths = [exact_dedup.depth_for(n, exact_dedup.CAPACITY) for n in (0, 10**6, 10**9, 10**11, 10**15)]
    assert depths == sorted(depths) and depths[-1] <= exact_dedup.MAX_DEPTH
    assert all(2 ** exact_dedup.depth_for(n, 100, 1) * 100 >= n for n in (10, 10**5, 10**8))


# ---- hot keys of the line join ---------------------------------------------------------


def brute_classes(rows, near=None):
    """Per line: (class's first place, links, kept), of documents with one row each."""
    near = near or line_dedup.NEAR_CHARS
    first, places = {}, []
    for key, text, *_ in sorted(rows):
        for i, line in enumerate(text.split("\n")):
            if line.strip(" "):
                first.setdefault(line, (key, i))
                places.append((key, i, line))
    names = list(first)
    links = [
        (a, b)
        for i, a in enumerate(names)
        for b in names[i + 1 :]
        if abs(len(a) - len(b)) <= 2 and min(len(a), len(b)) >= near and edit_distance(a, b) <= 2
    ]
    degree = Counter(x for pair in links for x in pair)
    least = {n: min(first[m] for m in ns) for ns in components(links, names).values() for n in ns}
    return {(k, i): (*least[x], degree[x], least[x] == (k, i) or len(x) < line_dedup.MIN_CHARS) for k, i, x in places}


def family(seed, n, edits):
    """Lines around one: some within two edits of each other, others only by way of a third."""
    rng, base = random.Random(seed), "the quick brown fox jumps over a lazy dog at noon"
    out = [base]
    while len(out) < n:
        own = list(rng.choice(out) if rng.random() < 0.5 else base)
        for _ in range(rng.randint(1, edits)):
            i = rng.randrange(len(own))
            own[i : i + 1] = rng.choice([[], [rng.choice("qzxj")], [own[i], rng.choice("qzxj")]])
        line = "".join(own)
        if line not in out:
            out.append(line)
    return out


@pytest.mark.parametrize("hot,edits", [(2, 2), (5, 4), (20, 6), (1000, 4)])
def test_hot_keys_lose_no_link(spark, hot, edits, monkeypatch):
    monkeypatch.setattr(line_dedup, "BLOCK", 7)
    rng = random.Random(hot)
    lines = family(hot, 60, edits) + mutated_lines()[:40] + ["short", "short", " ", "", "tiny"]
    rng.shuffle(lines)
    rows = [(i, "\n".join(lines[i::5]), "en", "a", 1) for i in range(5)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = line_dedup.line_classes(docs, hot=hot).collect()
    want = brute_classes(rows)
    assert {(r.doc_id, r.line_no): (r["first"].doc_id, r["first"].line_no, r.links, r.kept) for r in got} == want and len(got) == len(want)
    quick = line_dedup.line_classes(docs, hot=hot, count_links=False).collect()
    assert {(r.doc_id, r.line_no): (r["first"].doc_id, r["first"].line_no, r.kept) for r in quick} == {k: (*v[:2], v[3]) for k, v in want.items()}


def test_rows_of_a_hot_family_stay_in_proportion(spark):
    """2,000 near copies of one line: candidates are a multiple of the lines."""
    line = "the quick brown fox jumps over a lazy dog while rain falls on old roofs and cats sleep by warm stoves"
    lines = [line[:i] + c + line[i + 1 :] for i in range(100) for c in "0123456789QWERTYUIOP"]
    met = line_dedup._candidates(spark.createDataFrame([(x,) for x in lines], "line string"), 2, 20, line_dedup.HOT)
    assert met.count() < 20 * len(set(lines))
    docs = spark.createDataFrame([(i, x, "en", "a", 1) for i, x in enumerate(lines)], SCHEMA)
    kept = line_dedup.dedup(docs).where("text <> ''").collect()
    assert [r.doc_id for r in kept] == [0]


def test_texts_of_one_id_keep_their_own_lines(spark):
    """Documents are told apart by id and text, also where the hash of the row collides."""
    rows = [(14, prose(6) + "\n" + prose(9), "en", "a", 1), (14, prose(9), "en", "a", 1), (15, prose(9) + "\n" + prose(6), "en", "a", 1)]
    got = Counter((r.doc_id, r.text) for r in line_dedup.dedup(spark.createDataFrame(rows, SCHEMA)).collect())
    lines = [x for _, t in got.elements() for x in t.split("\n") if x]
    assert sorted(lines) == sorted([prose(6), prose(9)]) and sum(got.values()) == 3


def test_rows_of_one_hash_but_two_ids(spark, monkeypatch):
    real, rows_of = line_dedup.F.xxhash64, (["doc_id", "text"], ["c0", "c1"])
    collide = lambda *c: F.lit(5).cast("long") if all(isinstance(x, str) for x in c) and list(c) in rows_of else real(*c)
    monkeypatch.setattr(line_dedup.F, "xxhash64", collide)
    rows = [(1, prose(1) + "\n" + prose(2), "en", "a", 1), (2, prose(3) + "\n" + prose(1), "en", "a", 1)]
    got = {r.doc_id: r.text for r in line_dedup.dedup(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == {1: prose(1) + "\n" + prose(2), 2: prose(3)}
