"""Quality scores, preference formatting, syncmers and the pipeline."""

import hashlib
import zlib
from collections import Counter

import numpy as np
import pytest

import __spark_entry__ as ent
import corpus_pipeline
from quarry.llm import chat, quality, queries, syncmers
from llm_helpers import SCHEMA, awkward, clashing, prose

SF, SF2 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_all_operators_and_the_pipeline_are_registered():
    names = [q for q in ent.queries() if q.startswith("op") and q[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in ent.queries()


# ---- quality ---------------------------------------------------------------------------


def test_model_equals_direct_computation(spark):
    docs, labels = spark.read.parquet(f"{SF2}/documents.parquet"), spark.read.parquet(f"{SF2}/labels.parquet")
    marks = {r.doc_id: r.quality for r in labels.collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    train = [(quality.statistics(t), marks[k]) for k, t in rows if k in marks and zlib.crc32(str(k).encode()) % 4 != 2]
    x, y = np.array([t[0] for t in train]), np.array([t[1] for t in train])
    cov = {c: np.cov(x[y == c].T, bias=True) for c in (0, 1)}
    n = {c: (y == c).sum() for c in (0, 1)}
    pooled = sum(n[c] * cov[c] for c in (0, 1)) / len(y)
    scale = np.sqrt(np.diag(pooled))
    density = {}
    every = np.array([quality.statistics(t) for _, t in rows])
    for c in (0, 1):
        own = ((1 - quality.SHRINK) * cov[c] + quality.SHRINK * pooled) / np.outer(scale, scale)
        own = (1 - quality.RIDGE) * own + quality.RIDGE * np.trace(own) / quality.WIDTH * np.eye(quality.WIDTH)
        z = (every - x[y == c].mean(0)) / scale
        far = np.einsum("ij,jk,ik->i", z, np.linalg.inv(own), z)
        density[c] = np.log(n[c]) - 0.5 * np.linalg.slogdet(own)[1] - 0.5 * far
    want = 1 / (1 + np.exp(-np.clip(density[1] - density[0], -500, 500)))
    got = {r.doc_id: r for r in queries.op1_quality(spark, SF2).collect()}
    assert len(got) == len(rows)
    for (k, _), w in zip(rows, want, strict=True):
        assert got[k].score == pytest.approx(w, abs=1e-6) and 0 <= got[k].score <= 1
        assert got[k].predicted == int(got[k].score >= 0.7)
        assert got[k].held_out == (zlib.crc32(str(k).encode()) % 4 == 2)


def test_held_out_accuracy(spark):
    marks = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF2}/labels.parquet").collect()}
    held = [(r.score, r.predicted, marks[r.doc_id]) for r in queries.op1_quality(spark, SF2).collect() if r.held_out and r.doc_id in marks]
    assert np.mean([p == y for _, p, y in held]) >= 0.95
    good, bad = [s for s, _, y in held if y], [s for s, _, y in held if not y]
    assert np.mean([g > b for g in good for b in bad]) >= 0.98


def test_quality_awkward_rows(spark):
    docs = clashing(spark.createDataFrame(awkward(), SCHEMA))
    labels = spark.createDataFrame([(1, 1), (9, 0), (9, 1), (None, 1), (7, None)], "doc_id long, quality int")
    model = quality.fit(docs, labels)
    got = quality.score(docs, model, out="s2")
    assert got.columns == [*docs.columns, "s2"] and got.count() == len(awkward())
    assert all(0 <= r.s2 <= 1 for r in got.collect())
    none = quality.fit(docs.limit(0), labels)
    assert [r.s2 for r in quality.score(docs, none, out="s2").collect()] == [0.5] * len(awkward())
    assert quality.accepted(docs, none, 0.4).columns == docs.columns and quality.accepted(docs, none).count() == 0
    assert quality.score(docs.limit(0), none).count() == 0


# ---- preferences -----------------------------------------------------------------------

TURNS = "pair_id long, side string, turn long, role string, text string"


def render(turns):
    return "".join(f"<|{r or ''}|>\n{t or ''}<|end|>\n" for r, t in turns)


def brute_preferences(rows):
    out, keys = {}, {r[0] for r in rows if r[0] is not None and r[1] in ("chosen", "rejected")}
    for key in keys:
        side = {
            s: [(r[3], r[4]) for r in sorted((r for r in rows if r[0] == key and r[1] == s), key=lambda r: (r[2] is not None, r[2] or 0, r[3] is not None, r[3] or "", r[4] is not None, r[4] or ""))]
            for s in ("chosen", "rejected")
        }
        n = 0
        while n < min(map(len, side.values())) and side["chosen"][n] == side["rejected"][n]:
            n += 1
        masks = {}
        for s, turns in side.items():
            at, masks[s] = 0, []
            for role, text in turns[n:]:
                head = len(f"<|{role or ''}|>\n")
                size = len(text or "") + len("<|end|>\n")
                if role == "assistant":
                    masks[s].append((at + head, size))
                at += head + size
        out[key] = (n, render(side["chosen"][:n]), render(side["chosen"][n:]), render(side["rejected"][n:]), masks["chosen"], masks["rejected"])
    return out


def test_preferences_equal_brute_force(spark):
    same = [("user", "hi"), ("assistant", "hello"), ("user", "more")]
    rows = []
    for key, chosen, rejected in [
        (1, [*same, ("assistant", "yes é😀")], [*same, ("assistant", "no"), ("user", "?"), ("assistant", None)]),
        (2, same, same),  # equal
        (3, [("user", "a")], []),  # no rejected side
        (4, [], [("assistant", "b")]),
        (5, same, same[:2]),  # one is a prefix of the other
        (6, [(None, None), ("user", "")], [(None, None), ("user", None)]),  # nulls are equal to nulls
        (7, [("user", "z" * 20_000), ("assistant", "y")], [("user", "z" * 20_000), ("assistant", "x")]),
        (None, same, same),
    ]:
        for side, turns in (("chosen", chosen), ("rejected", rejected)):
            rows += [(key, side, i, r, t) for i, (r, t) in enumerate(turns)]
    rows += [(8, "chosen", 0, "user", "b"), (8, "chosen", 0, "user", "a"), (8, "rejected", 0, "user", "a"), (8, "rejected", None, "user", "q"), (9, "other", 0, "user", "x")]
    df = clashing(spark.createDataFrame(rows, TURNS))
    got = {
        r.pair_id: (r.prompt_turns, r.prompt, r.chosen, r.rejected, [tuple(m) for m in r.chosen_mask], [tuple(m) for m in r.rejected_mask])
        for r in chat.preferences(df).collect()
    }
    assert got == brute_preferences(rows)
    for r in chat.preferences(df).collect():
        for text, mask in ((r.chosen, r.chosen_mask), (r.rejected, r.rejected_mask)):
            assert all(text[m.start : m.start + m.length].endswith("<|end|>\n") for m in mask)
        assert r.usable == (r.chosen != r.rejected)
    assert chat.preferences(df.limit(0)).count() == 0


def test_neighbour_pairs_awkward_rows(spark):
    rows = [(0, 0, "user", "q"), (0, 1, "assistant", "a0"), (1, 0, "system", "s"), (1, 1, "user", "q"), (1, 2, "assistant", "a1"), (1, 3, "user", "more"), (2, 0, "user", "alone"), (None, 0, "user", "x"), (4, 0, "assistant", None)]
    pairs = {r.pair_id: r for r in chat.preferences(chat.neighbour_pairs(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))).collect()}
    assert set(pairs) == {0, 1, 2, 4}
    assert pairs[0].prompt == render([("user", "q")]) and pairs[0].rejected == render([("assistant", "a1")])
    assert pairs[1].rejected == render([("assistant", "a0")]) and pairs[1].chosen == render([("assistant", "a1"), ("user", "more")])
    assert not pairs[2].usable and pairs[4].rejected == ""


def test_preference_plan_has_no_python(spark):
    assert "Python" not in queries.op5_chat(spark, SF)._jdf.queryExecution().executedPlan().toString()


# ---- syncmers --------------------------------------------------------------------------


def test_syncmers_are_closed_and_context_free():
    text = prose(3, 200) + "é😀" + prose(5, 100)
    at, h = syncmers.syncmers(text)
    inside = dict(zip(at.tolist(), h.tolist(), strict=True))
    assert max(np.diff(at)) <= syncmers.K - syncmers.S  # no gap without an anchor
    for i in range(0, len(text) - syncmers.K, 3):  # a k-mer alone is chosen as it is in the text
        alone = syncmers.syncmers(text[i : i + syncmers.K])
        assert (len(alone[0]) == 1) == (i in inside)
        if i in inside:
            assert alone[1][0] == inside[i]


def test_long_texts_are_cut_with_an_overlap(monkeypatch):
    text = prose(9, 900)
    whole = syncmers.syncmers(text)
    monkeypatch.setattr(syncmers, "STEP", 100)
    parts = syncmers.syncmers(text)
    assert (whole[0] == parts[0]).all() and (whole[1] == parts[1]).all()


def test_likeness_is_the_share_in_common():
    a, b = prose(1, 60), prose(2, 60)
    x, y = syncmers.sketch(a, size=10**6), syncmers.sketch(b, size=10**6)
    both = len(np.intersect1d(x, y))
    assert syncmers.likeness(x, y, 10**6) == pytest.approx(2 * both / (len(x) + len(y)))
    assert syncmers.likeness(x, x) == 1 and syncmers.likeness(x, syncmers.sketch("")) == 0
    assert syncmers.likeness(syncmers.sketch(""), syncmers.sketch("")) == 1


def hashes(text):
    """The anchors of a text: where no k-mer is chosen, the whole text."""
    return syncmers.syncmers(text)[1].tolist() or ([int(h) for h in syncmers.syncmers(text, len(text) + 1)[1]] if text else [])


def whole_share(a, b):
    x, y = (Counter(hashes(t)) for t in (a, b))
    return 2 * (x & y).total() / (x.total() + y.total())


def test_long_texts_are_compared_whole():
    """Texts of far over 128 anchors: no anchor, repeat or place is left out."""
    rng = np.random.default_rng(7)
    passage, *texts = ("".join(rng.choice(list("abcdefghij klmnop"), n)) for n in (300, 60_000, 60_000))
    a, b = texts[0][:20_000] + passage + texts[0][20_000:], texts[1] + passage
    shared = syncmers.likeness(syncmers.sketch(a), syncmers.sketch(b))
    assert shared == whole_share(a, b) > 0  # a short passage in long texts
    changed = a[:30_000] + "Q" + a[30_001:]  # one letter
    assert syncmers.likeness(syncmers.sketch(a), syncmers.sketch(changed)) == whole_share(a, changed) < 1
    assert syncmers.as_text(syncmers.sketch(a)) != syncmers.as_text(syncmers.sketch(changed))
    half = len(a) // 2
    moved = a[half:] + a[:half]  # the order of anchors is part of the fingerprint
    assert syncmers.as_text(syncmers.sketch(a)) != syncmers.as_text(syncmers.sketch(moved))
    once, often = prose(1, 200), prose(1, 200) * 3  # repeats count
    assert syncmers.likeness(syncmers.sketch(once), syncmers.sketch(often)) == whole_share(once, often) < 0.7


def brute_in_order(a, b):
    """The longest chain of anchors (hash, how many before) that stand in one order in both."""
    places = []
    for text in (a, b):
        seen, at = Counter(), {}
        for i, h in enumerate(hashes(text)):
            at[h, seen[h]] = i
            seen[h] += 1
        places.append(at)
    x, y = places
    if not x or not y:
        return float(len(x) == len(y))
    row = np.array([y[k] for k in x if k in y])
    best = np.ones(len(row), int)
    for i in range(1, len(row)):
        best[i] = 1 + best[:i][row[:i] < row[i]].max(initial=0)
    return 2 * int(best.max(initial=0)) / (len(x) + len(y))


def test_moved_blocks_score_below_kept_order():
    rng = np.random.default_rng(4)
    blocks = ["".join(rng.choice(list("abcdefghij klmnop"), 300)) for _ in range(10)]
    a, b = "".join(blocks), "".join(blocks[i] for i in rng.permutation(10))
    x, y = syncmers.sketch(a), syncmers.sketch(b)
    assert syncmers.in_order(x, y) == brute_in_order(a, b) < 0.6 < 0.9 < syncmers.likeness(x, y)
    assert syncmers.in_order(x, x) == 1 and syncmers.in_order(x, syncmers.sketch("")) == 0 and syncmers.in_order(syncmers.sketch(""), syncmers.sketch("")) == 1
    for s, t in ((prose(1, 200), prose(1, 200) * 3), (prose(2, 90), prose(3, 90)), ("ab" * 500, "ba" * 300), (a, a[1000:] + a[:1000])):
        assert syncmers.in_order(syncmers.sketch(s), syncmers.sketch(t)) == pytest.approx(brute_in_order(s, t))


def own_digest(text):
    """The fingerprint, from the anchors one by one."""
    seen, digest = Counter(), hashlib.sha256()
    for h in hashes(text):
        digest.update(h.to_bytes(4, "big") + seen[h].to_bytes(4, "big"))
        seen[h] += 1
    return digest.hexdigest() if seen else ""


def test_op10_counts_whole_anchors(spark):
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    order = sorted(texts)
    following = dict(zip(order, order[1:] + order[:1], strict=True))
    for r in queries.op10_syncmers(spark, SF).collect():
        own, after = texts[r.doc_id], texts[following[r.doc_id]]
        if own and after:
            other = syncmers.edited(own, after)
            assert r.shared_next == whole_share(own, after) and r.shared_edited == whole_share(own, other)
            assert r.near_next == brute_in_order(own, after) and r.near_edited == brute_in_order(own, other)
            assert r.fingerprint == own_digest(own) and r.edited_fingerprint == own_digest(other)


def brute_edits(rows):
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    out = Counter()
    for i, (key, text) in enumerate(order):
        own, following = text or "", order[(i + 1) % len(order)][1] or ""
        other = own[: len(own) - len(own) // 2] + following[: len(own) // 2]
        near = [f(own, t) for f in (brute_in_order, lambda x, y: whole_share(x, y) if x and y else float(x == y)) for t in (other, following)]
        out[(key, len(own), hashlib.sha256(other.encode()).hexdigest(), own_digest(own), own_digest(other), *near)] += 1
    return out


def test_op10_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF2}/documents.parquet").collect()]
    got = queries.op10_syncmers(spark, SF2).collect()
    assert Counter(tuple(r) for r in got) == brute_edits(rows)
    assert np.mean([r.near_edited for r in got]) > 0.3 > np.mean([r.near_next for r in got])


@pytest.mark.parametrize("ranges", [None, 1, 2, 7, 40])
def test_syncmers_awkward_rows(spark, ranges):
    rows = [r for r in awkward() if r[0] != 14]  # rows of one id are ordered by a hash
    docs = clashing(spark.createDataFrame(rows, SCHEMA))
    got = Counter(tuple(r) for r in syncmers.compare_edits(docs, ranges=ranges).collect())
    assert got == brute_edits([(r[0], r[1]) for r in rows])
    assert syncmers.compare_edits(docs.limit(0), ranges=ranges).count() == 0
    one = syncmers.compare_edits(docs.where("doc_id = 9"), ranges=ranges).collect()
    assert len(one) == 1 and one[0].near_next == 1


def test_anchor_rows(spark):
    docs = clashing(spark.createDataFrame(awkward(), SCHEMA))
    got = Counter((r.doc_id, r.position, r.hash) for r in syncmers.anchors(docs).collect())
    want = Counter((k, int(p), int(h)) for k, t, *_ in awkward() for p, h in zip(*syncmers.syncmers(t or ""), strict=True))
    assert got == want


# ---- pipeline --------------------------------------------------------------------------


def test_pipeline_stages(spark):
    """Each stage against a brute-force version on what the stage before kept."""
    from test_dedup import brute_dedup, brute_simhash
    from test_tokens import library_ids

    import public_tokenizers

    from quarry.llm import bpe

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["quality", "line_dedup", "simhash", "packing"]

    kept = stages["quality"](spark, docs, SF)
    scores = {r.doc_id: r.predicted for r in queries.op1_quality(spark, SF).collect()}
    assert kept.columns == columns and {r.doc_id for r in kept.collect()} == {k for k, p in scores.items() if p}

    kept = kept.checkpoint()
    shorter = stages["line_dedup"](spark, kept, SF).checkpoint()
    rows = kept.collect()
    assert shorter.columns == columns and shorter.schema == docs.schema
    assert Counter((r.doc_id, r.text) for r in shorter.collect()) == brute_dedup([(r.doc_id, r.text) for r in rows])
    assert all(r.n_chars == len(r.text) for r in shorter.collect())

    single = stages["simhash"](spark, shorter, SF).checkpoint()
    want = {c for _, _, c in brute_simhash([(r.doc_id, r.text) for r in shorter.collect()])}
    assert single.columns == columns and Counter(r.doc_id for r in single.collect()) == Counter(want)

    packed = stages["packing"](spark, single, SF).collect()
    spec = bpe.read_tokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    tokens = {r.doc_id: len(library_ids(spec, r.text)) + 1 for r in single.collect()}
    total = Counter()
    for r in packed:
        total[r.doc_id] += r.length
    assert total == tokens


def test_pipeline_awkward_rows(spark, tmp_path):
    docs = clashing(spark.createDataFrame(awkward(), SCHEMA))
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != "packing":
            assert out.columns == docs.columns
        out.collect()
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_run_writes_every_stage(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
