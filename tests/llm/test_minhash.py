"""Fast similarity sketches and MinHash near-dedup against brute force."""

import random
from collections import Counter
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quarry.llm import minhash, queries
from quarry.session import stored
from llm_helpers import SCHEMA, awkward, clashing, components, prose

SF = "/root/testdata/sf0.01"


def brute_sets(rows, size):
    import re

    out = []
    for key, text in rows:
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        some = {tuple(words[i : i + size]) for i in range(len(words) - size + 1)} or ({tuple(words)} if words else set())
        out.append((key, some))
    return out


def brute(rows, size=2, percent=80):
    sets = brute_sets(rows, size)
    links = [
        (i, j)
        for (i, (_, a)), (j, (_, b)) in combinations(enumerate(sets), 2)
        if a and b and 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) and 100 * len(a & b) >= percent * len(a | b)
    ]
    groups = components(links, range(len(sets)))
    out = Counter()
    for g in groups.values():
        name = min((sets[i][0] for i in g if sets[i][0] is not None), default=None)
        for i in g:
            out[sets[i][0], len(sets[i][1]), name, sets[i][0] == name] += 1
    return out


def got(df):
    return Counter(tuple(r) for r in df.select("doc_id", "n_shingles", "component_id", "kept").collect())


# ---- the sketch ------------------------------------------------------------------------


def test_every_coordinate_is_filled_by_its_first_round():
    rng = np.random.default_rng(1)
    sets = [rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (1, 2, 3, 10, 100, 3000)]
    out = minhash.sketches(sets)
    assert out.shape == (6, minhash.BINS) and (out != minhash._EMPTY).all()
    rounds = (out >> np.uint64(48)).astype(int)
    assert rounds.max() < 2 * minhash.BINS and rounds[5].max() <= 1  # a large set fills at once
    for s, row in zip(sets, out, strict=True):  # one by one, by the definition
        want = {}
        for i in range(minhash.BINS):
            h = minhash._mix(s ^ minhash._seed(i))
            for b, v in zip((h % np.uint64(minhash.BINS)).tolist(), (minhash._mix(h) >> np.uint64(16)).tolist(), strict=True):
                want[b] = min(want.get(b, (i, v)), (i, v))
        for b in set(range(minhash.BINS)) - set(want):
            i = minhash.BINS + b
            want[b] = (i, int((minhash._mix(minhash._mix(s ^ minhash._seed(i))) >> np.uint64(16)).min()))
        assert [(int(v) >> 48, int(v) & (1 << 48) - 1) for v in row] == [want[b] for b in range(minhash.BINS)]
    assert minhash.sketches([]).shape == (0, minhash.BINS)


@pytest.mark.parametrize("n", [4, 40, 1000])
def test_agreement_is_concentrated_around_the_similarity(n):
    rng = np.random.default_rng(n)
    shares = []
    for _ in range(60):
        both = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        a, b = np.append(both, rng.integers(0, 1 << 63, n // 4 // 2, dtype=np.uint64)), np.append(both, rng.integers(0, 1 << 63, n // 4 - n // 4 // 2, dtype=np.uint64))
        x, y = minhash.sketches([a, b])
        shares.append((x == y).mean())
    want = n / (n + n // 4)
    assert abs(np.mean(shares) - want) < 0.03 and np.std(shares) < 1.5 * (want * (1 - want) / minhash.BINS) ** 0.5 + 0.02


@pytest.mark.parametrize("size", [1, 2, 3, 5])
def test_elements_are_the_distinct_shingles(size):
    for _, text, *_ in awkward():
        words = minhash.words_of(text)
        h = minhash.elements(words, size)
        assert len(h) == len(minhash.shingles(text, size)) == len(np.unique(h, axis=0))
    a, b = "a b a b c".split(), "a b c a b".split()
    digest = lambda w: minhash.set_digest(minhash.elements([x.encode() for x in w], 2))
    assert digest(a) != digest(b) and digest("a b a b a".split()) == digest("b a b".split())


# ---- groups ----------------------------------------------------------------------------


def test_op12_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    want = brute(rows)
    assert got(queries.op12_minhash(spark, SF)) == want
    assert len({k[2] for k in want}) < 900  # there are groups


@pytest.mark.parametrize("size", [2, 5])
def test_awkward_rows(spark, size):
    docs = clashing(spark.createDataFrame(awkward(), SCHEMA)).withColumns({c: F.lit(1) for c in "rid n sid b0 b1 bands root part".split()})
    want = brute([(r[0], r[1]) for r in awkward()], size)
    assert got(minhash.components(docs, shingle=size)) == want
    kept = minhash.near_dedup(docs, shingle=size)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {k[0] for k in want if k[3]}
    assert minhash.components(docs.limit(0)).count() == 0 and minhash.near_dedup(docs.limit(0)).count() == 0


def test_threshold_is_exact(spark):
    words = [f"w{i}" for i in range(60)]
    rows = [(0, " ".join(words[:9]))]  # 8 shingles
    rows += [(1, " ".join(words[:11]))]  # 10: 8 of 10, linked
    rows += [(2, " ".join(words[:12]))]  # 11: 10 of 11 with 1, 8 of 11 with 0
    rows += [(10, " ".join(words[30:38])), (11, " ".join(words[30:40]))]  # 7 of 9: not linked
    docs = spark.createDataFrame([(*r, "en", "a", 1) for r in rows], SCHEMA)
    result = {r.doc_id: r.component_id for r in minhash.components(docs, shingle=2).collect()}
    assert result == {0: 0, 1: 0, 2: 0, 10: 10, 11: 11}


def test_bound_on_common_shingles_is_never_too_small():
    rng = np.random.default_rng(3)
    first = set(range(60))
    rows = []
    for _ in range(60):
        own = set(rng.choice(60, rng.integers(0, 60), replace=False).tolist()) | set((100 + rng.choice(30, rng.integers(0, 30), replace=False)).tolist())
        rows.append((own or {0}, rng.random() < 0.8))
    x = np.zeros((10, len(rows)), np.int64)
    x[8] = [len(s) for s, _ in rows]
    x[9] = [len(s & first) if known else -1 for s, known in rows]
    most, sizes = minhash._bound(x, x)
    for i, (a, ka) in enumerate(rows):
        for j, (b, kb) in enumerate(rows):
            assert len(a & b) <= most[i, j] <= min(len(a), len(b)) and sizes[i, j] == len(a) + len(b)
    x[5, :30] = 1  # of another first row nothing is known
    assert (minhash._bound(x, x)[0][:30, 30:] == np.minimum(x[8][:30, None], x[8][None, 30:])).all()


def families(seed, members, chains):
    """Near copies of one text, and chains whose ends are no longer similar."""
    rng, rows, key = random.Random(seed), [], 0
    base = prose(3, 80).split()
    for _ in range(members):
        own = base[:]
        own[rng.randrange(80)] = f"w{rng.randrange(10**6)}"
        rows.append((key, " ".join(own)))
        key += 1
    for c in range(chains):
        own = [f"c{c}x{i}" for i in range(40)]
        for _ in range(12):
            rows.append((key, " ".join(own)))
            key += 1
            for _ in range(rng.choice([1, 2, 2, 3])):
                own[rng.randrange(40)] = f"n{rng.randrange(10**6)}"
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("block", [3, minhash.BLOCK])
def test_stars_and_rest_lose_no_link(spark, block, monkeypatch):
    monkeypatch.setattr(minhash, "WAVES", (1, 3, 1 << 62))
    monkeypatch.setattr(minhash, "HELD", 4)
    rows = families(5, 120, 25)
    docs = spark.createDataFrame([(*r, "en", "a", 1) for r in rows], SCHEMA)
    assert got(minhash.components(docs, shingle=2, block=block)) == brute(rows)


def test_rows_stay_in_proportion_in_a_hot_family(spark, monkeypatch):
    """2,000 near copies: candidates are a multiple of the rows, not of their pairs."""
    seen = []
    inner = minhash._compared
    monkeypatch.setattr(minhash, "_compared", lambda pairs, *a, **k: seen.append(pairs.count()) or inner(pairs, *a, **k))
    rows = families(7, 2000, 0)
    docs = spark.createDataFrame([(*r, "en", "a", 1) for r in rows], SCHEMA)
    result = minhash.components(docs, shingle=2).collect()
    assert len({r.component_id for r in result}) == 1 and len(result) == 2000
    assert sum(seen) < 25 * 2000


def test_hot_buckets_are_split(spark):
    """Buckets over a thousandth of the rows go through two stars."""
    rows = families(9, 1500, 3)
    docs = spark.createDataFrame([(*r, "en", "a", 1) for r in rows], SCHEMA)
    sets = minhash._sets(docs, "doc_id", "text", 2, minhash.ROWS, minhash.BANDS)
    buckets = minhash._buckets(sets.select("rid", "b0", "b1", "bands"), 1000)
    assert buckets.where("salt >= 0").count() > 0
    pairs = minhash._star_pairs(buckets, minhash.APART)
    links = minhash._compared(pairs, sets, 2, 80).where("linked").select("a", "b")
    hot = sets.where("doc_id < 1500").join(minhash._roots(links), "rid")
    assert hot.count() == 1500 and hot.select("root").distinct().count() == 1


def test_rows_of_lone_buckets_do_not_travel(spark, monkeypatch):
    names = minhash._CELL

    def travelling(batches):
        for b in batches:
            own = [b.column(c) for c in names]
            yield pa.RecordBatch.from_arrays([*own, *own[2:]], [*names, "center", "c0", "c1"])

    monkeypatch.setattr(minhash, "_stars", travelling)
    rows = [(i, 0, 0, [7 if i < 3 else -i, *(1000 * i + j for j in range(1, 10))]) for i in range(1, 200)]
    firsts = spark.createDataFrame(rows, "rid long, b0 long, b1 long, bands array<bigint>")
    sent = minhash._buckets(firsts, 1990)
    assert {r.rid for r in sent.where("key = 7").collect()} == {1, 2}
    assert sent.count() < 200  # of 1,990


def test_equal_sets_have_one_row_and_others_stay(spark):
    texts = ["a b c", "a b c", "A b c", "d e", None, "", *(f"x{i} y z" for i in range(50))]
    docs = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], SCHEMA)
    sets = stored(minhash._sets(docs, "doc_id", "text", 2, minhash.ROWS, minhash.BANDS), "sets")
    same = stored(sets.where("n > 0").groupBy("sid").agg(F.min("rid").alias("rep"), F.count("rid").alias("times")), "same")
    firsts = minhash._firsts(sets, same)
    assert sorted(r.rid for r in firsts.collect()) == sorted(r.rep for r in same.collect())
    assert firsts.count() == 52


def test_texts_are_copied_to_the_parts_that_rows_visit(spark, monkeypatch):
    """A text that few rows are compared with is sent once, not to 64 parts."""
    sent, inner = [], minhash.texts_to_python
    texts = [prose(1, 30), prose(1, 30), prose(2, 30)]
    sets = spark.createDataFrame([(i, t, 29) for i, t in enumerate(texts)], "rid long, text string, n long")
    lists = spark.createDataFrame([(0, [1, 2]), (0, [2])], "rid long, others array<bigint>")
    monkeypatch.setattr(minhash, "texts_to_python", lambda df: sent.append(df.count()) or inner(df))
    links = minhash._linked_lists(lists, sets, 2, 80)
    assert [tuple(r) for r in links.collect()] == [(0, 1)]
    assert sent[0] <= 4  # two texts, and one row in two blocks at most


@pytest.mark.parametrize("visits", [1, 5])
def test_parts_of_stars_and_blocks_lose_no_link(spark, visits, monkeypatch):
    monkeypatch.setattr(minhash, "VISITS", visits)
    monkeypatch.setattr(minhash, "HELD", 4)
    rows = families(11, 60, 15)
    docs = spark.createDataFrame([(*r, "en", "a", 1) for r in rows], SCHEMA)
    assert got(minhash.components(docs, shingle=2)) == brute(rows)


def test_refuses_bands_that_miss(spark):
    docs = spark.createDataFrame(awkward(), SCHEMA)
    with pytest.raises(ValueError):
        minhash.components(docs, percent=50)
    with pytest.raises(ValueError):
        minhash.components(docs, rows=64, bands=42)
