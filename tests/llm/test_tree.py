"""Running places, the prefix trie and the Merkle manifest against brute force."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.llm import merkle, queries, segments, trie
from llm_helpers import SCHEMA, awkward, clashing, prose

SF = "/root/testdata/sf0.01"


# ---- running places --------------------------------------------------------------------


@pytest.mark.parametrize("slice_rows", [7, 1000])
def test_running_places_and_digests(spark, slice_rows):
    rng = random.Random(3)
    rows = [(rng.choice([None, 1, 2, 2, 2, 2, 2, 9]), i, rng.getrandbits(63)) for i in range(300)]
    rows += [(100 + i, i, i) for i in range(40)]
    df = spark.createDataFrame(rows, "k long, o long, v long")
    cut = segments.slices(df, [F.col("k").asc_nulls_first(), F.col("o")], len(rows), slice_rows)
    got = {(r.k, r.o): (r.n, r.v) for r in segments.running(cut, "k", "n", ["v"]).collect()}
    want, seen = {}, defaultdict(lambda: (0, 0))
    for k, o, v in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1])):
        seen[k] = (seen[k][0] + 1, seen[k][1] ^ v)
        want[k, o] = seen[k]
    assert got == want
    empty = segments.slices(df.limit(0), [F.col("k")], 0, slice_rows)
    assert segments.running(empty, "k", "n").count() == 0


def test_lookup_splits_hot_keys(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"), "id")
    table = rows.groupBy("k").agg(F.count("*").alias("times")).withColumn("v", F.col("k") * 2)
    got = segments.lookup(rows, table, ["k"], "times", 5000)
    assert got.count() == 5000 and got.where("v <> k * 2").count() == 0


# ---- trie ------------------------------------------------------------------------------


def brute_trie(rows):
    by = defaultdict(list)
    for c, k, r, t in rows:
        if c is not None:
            r, t = r or "", t or ""
            by[c].append((k is not None, k or 0, hashlib.md5(f"{len(r.encode())}:{r}{t}".encode()).hexdigest(), (r, t)))
    turns = {c: [x[3] for x in sorted(v)] for c, v in by.items()}
    whole = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (c % 100 if c >= 0 else -(-c % 100))
        whole[c] = turns.get(base, [])[:h] + own[h:]
    members = defaultdict(list)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[tuple(s[:d])].append(c)
    children = Counter(n[:-1] for n in members if n)
    leaves, saved = Counter(), Counter()
    for n, m in members.items():
        for d in range(len(n) + 1):
            saved[n[:d]] += (len(m) - 1) * len(n[-1][1]) if n else 0
            leaves[n[:d]] += not children[n]
    out = Counter()
    for n, m in members.items():
        ends = ",".join(map(str, sorted(c for c in m if len(whole[c]) == len(n))))
        up = min(members[n[:-1]]) if n else None
        out[min(m), len(n), up, len(m), children[n], leaves[n], saved[n], hashlib.sha256(ends.encode()).hexdigest()] += 1
    return out


def conversations():
    """Copies, shared starts, long ones, gaps, nulls, ties, repeated rows, negative ids."""
    rng = random.Random(11)
    rows = []
    for c in [*range(0, 60), 100, 101, 102, 150, 205, 299, -1, -100, -150, 1234567]:
        kind = rng.choice(["copy", "start", "own", "long"])
        for t in range({"copy": 4, "start": rng.randint(1, 8), "own": rng.randint(1, 5), "long": 70}[kind]):
            own = f"{c}" if kind == "own" or (kind == "start" and t > 1) or (kind == "long" and t > 60) else "shared"
            rows.append((c, t, "user" if t % 2 == 0 else "assistant", f"{kind if kind == 'long' else ''} {own} turn {t} é😀"))
    rows += [(300, None, "user", "no number"), (300, 0, None, None), (300, 0, "", ""), (300, 1, "user", None)]
    rows += [(301, 2, "user", "twice"), (301, 2, "user", "twice"), (301, 2, "assistant", "tie")]
    rows += [(None, 0, "user", "nobody"), (302, 0, "user", "x" * 20000)]
    return rows


@pytest.mark.parametrize("height,slice_rows", [(2, 9), (4, 1000), (16, 100)])
def test_trie_equals_brute_force(spark, height, slice_rows):
    rows = conversations()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    extra = "conv at part depth x y up_x chars digest base h n _pid parent".split()
    df = df.select("*", *[F.lit(1).alias(c) for c in extra])
    got = Counter(tuple(r) for r in trie.trie(df, height=height, slice_rows=slice_rows).collect())
    assert got == brute_trie(rows)


def test_trie_of_one_hot_conversation(spark):
    """Most conversations are one and the same, and one holds a third of all turns."""
    rows = [(c, t, "user", f"t{t}") for c in range(400) for t in range(3)] + [(999, t, "user", f"own {t}") for t in range(600)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = trie.trie(df, slice_rows=50)
    assert Counter(tuple(r) for r in got.collect()) == brute_trie(rows)


def test_trie_edges(spark):
    schema = "conv_id long, turn long, role string, text string"
    assert trie.trie(spark.createDataFrame([], schema)).count() == 0
    assert trie.trie(spark.createDataFrame([(None, 1, "user", "a")], schema)).count() == 0
    one = [(c, 0, "user", "a") for c in range(3)]  # some are left without turns
    assert Counter(tuple(r) for r in trie.trie(spark.createDataFrame(one, schema)).collect()) == brute_trie(one)
    with pytest.raises(ValueError):
        trie.trie(spark.createDataFrame(one, schema), height=1)


def test_id_lists_are_hashed_in_pieces(spark):
    ends = spark.range(1000).select(F.lit(2).cast("long").alias("depth"), (F.col("id") % 2).alias("x"), F.lit(0).cast("long").alias("y"), F.col("id").alias("conv"))
    got = {r.x: r.ends_sha256 for r in trie.end_lists(ends, 1000, 100, piece=64).collect()}
    assert got == {x: hashlib.sha256(",".join(str(i) for i in range(x, 1000, 2)).encode()).hexdigest() for x in (0, 1)}


def test_op11_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert Counter(tuple(r) for r in queries.op11_trie(spark, SF).collect()) == brute_trie(rows)


# ---- manifest --------------------------------------------------------------------------


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_tree(leaves, fanout):
    paths, at, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        for i, k in enumerate(at):
            run = nodes[k // fanout * fanout : k // fanout * fanout + fanout]
            paths[i].append((run[: k % fanout], run[k % fanout + 1 :]))
        at = [k // fanout for k in at]
        nodes = [H(*nodes[j : j + fanout]) for j in range(0, len(nodes), fanout)]
    return paths, nodes[0]


def brute_manifest(rows, fanout=16):
    encoded = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    by = defaultdict(list)
    for key, text, lang, source, n_chars in rows:
        lowered = None if text is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
        leaf, other = (H(*map(encoded, (key, source, lang, n_chars, t))) for t in (text, lowered))
        tampered = key is not None and zlib.crc32(str(key).encode()) % 5 == 0
        by[source].append((key is not None, key or 0, leaf, other if tampered else leaf, key))
    sources = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: brute_tree([x[2] for x in sorted(by[s], key=lambda x: x[:4])], fanout) for s in sources}
    if not sources:
        return Counter()
    up, root = brute_tree([trees[s][1] for s in sources], fanout)
    out = Counter()
    for s, above in zip(sources, up, strict=True):
        for (*_, leaf, other, key), path in zip(sorted(by[s], key=lambda x: x[:4]), trees[s][0], strict=True):
            folded = other
            for left, right in path + above:
                folded = H(*left, folded, *right)
            siblings = [h for left, right in path + above for h in left + right]
            out[key, leaf, trees[s][1], root, H(*siblings), folded, folded == root] += 1
    return out


@pytest.mark.parametrize("fanout,slice_rows", [(2, 5), (3, 1000), (16, 4)])
def test_manifest_equals_brute_force(spark, fanout, slice_rows):
    rows = awkward() + [(100 + i, prose(i, 5).title(), "en", "hot", i) for i in range(40)]
    rows += [(200 + i, "One", None, f"s{i}", None) for i in range(20)] + [(300, "É", "fr", "é", 1), (301, "Z", "fr", "z", 1)]
    docs = clashing(spark.createDataFrame(rows, SCHEMA)).select("*", *[F.lit(1).alias(c) for c in "g idx h other parent path slot".split() if c != "h"])
    got = Counter(tuple(r) for r in merkle.manifest(docs, fanout=fanout, slice_rows=slice_rows).collect())
    assert got == brute_manifest(rows, fanout)


def test_manifest_edges(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert merkle.manifest(none).count() == 0
    one = [(4, "Text", "en", None, 4)]
    got = merkle.manifest(spark.createDataFrame(one, SCHEMA)).collect()
    assert Counter(tuple(r) for r in got) == brute_manifest(one)
    assert got[0].leaf == got[0].subroot == got[0].root and got[0].proof_sha256 == H("")
    same = [(i, "a", "en", "s", 1) for i in range(17)]  # a run of one
    assert Counter(tuple(r) for r in merkle.manifest(spark.createDataFrame(same, SCHEMA)).collect()) == brute_manifest(same)
    with pytest.raises(ValueError):
        merkle.manifest(none, fanout=1)


def test_op13_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    want = brute_manifest([tuple(r) for r in docs.collect()])
    assert Counter(tuple(r) for r in queries.op13_merkle(spark, SF).collect()) == want
    assert any(not k[-1] for k in want)
