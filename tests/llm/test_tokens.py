"""BPE, token files, packing and token counts against the tokenizers library itself."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from quarry.llm import bpe, packing, queries, token_counts, token_files
from quarry.session import scratch_path
from llm_helpers import SCHEMA, awkward, clashing, crc_le32

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def specs():
    return {n: bpe.read_tokenizer(public_tokenizers.path(n)) for n in (queries.WORD_BPE, queries.BYTE_BPE)}


def library_ids(spec, text):
    return Tokenizer.from_str(spec).encode(text or "", add_special_tokens=False).ids


def text_rows(spark, sf=SF):
    return [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]


ODD = [
    "", " ", "It's we'LL <|endoftext|> x<|startoftext|>y  é é İstanbul ΣΑΣ", "a\x0bb\x0cc\x1cd\x85e​f", "  \n\n  x \t y\n",
    "''s ''' 's'S 12345 1.5e3 <| |> ﬁ ǅ ẞß ŉ \x00\x7f", "́a ́", "١٢٣ Ⅷ ª º µ ²³½", "日本語テスト 😀👍🏽 don’t", "nbsp here　there",
]


@pytest.mark.parametrize("name", [queries.WORD_BPE, queries.BYTE_BPE])
def test_encoder_equals_library(specs, name):
    encoder, tokenizer = bpe.TextEncoder(specs[name]), Tokenizer.from_str(specs[name])
    texts = ODD + ["Mixed CASE, don't stop! 3.14 naïve façade straße œuvre" * 50, "a" * 3000]
    for text, got in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_memo_is_emptied_and_still_right(specs):
    encoder = bpe.TextEncoder(specs[queries.BYTE_BPE])
    encoder.memo.most = 5
    texts = ["one two three four five six seven", "eight nine ten one two"] * 3
    want = [library_ids(specs[queries.BYTE_BPE], t) for t in texts]
    assert [np.frombuffer(x, "<u4").tolist() for x in encoder.encode(texts)] == want
    assert len(encoder.memo) <= 12


def test_op2_equals_library(spark, specs):
    tokenizer = Tokenizer.from_str(specs[queries.WORD_BPE])
    want = {}
    for key, text in text_rows(spark):
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids
        shown = tokenizer.decode(ids, skip_special_tokens=False)
        want[key] = (len(ids), hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(shown.encode()).hexdigest())
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in queries.op2_bpe(spark, SF).collect()}
    assert got == want


def test_bpe_awkward_rows(spark, specs):
    docs = clashing(spark.createDataFrame(awkward(), SCHEMA))
    spec = specs[queries.WORD_BPE]
    got = bpe.decode(bpe.encode(docs, spec, block_bytes=2000, word_buckets=3), spec).collect()
    tokenizer = Tokenizer.from_str(spec)
    want = [(r[0], library_ids(spec, r[1])) for r in awkward()]
    assert Counter((r.doc_id, tuple(np.frombuffer(r.ids, "<u4").tolist())) for r in got) == Counter((k, tuple(i)) for k, i in want)
    for r in got:
        assert r.decoded == tokenizer.decode(np.frombuffer(r.ids, "<u4").tolist(), skip_special_tokens=False)
    assert bpe.encode(docs.limit(0), spec).count() == 0


def test_op3_files(spark, specs):
    rows = sorted(text_rows(spark))
    start, want = 0, {}
    for key, text in rows:
        ids = [*library_ids(specs[queries.WORD_BPE], text), 2]
        want[key] = (start, len(ids), crc_le32(ids))
        start += len(ids)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in queries.op3_token_files(spark, SF).collect()}
    assert got == want


def test_token_files_awkward_rows_and_lookup(spark, specs):
    spec, path = specs[queries.WORD_BPE], scratch_path(spark, "t")
    docs = clashing(spark.createDataFrame(awkward(), SCHEMA))
    token_files.write_tokens(docs, path, spec, end_id=2, ranges=3)
    rows = token_files.read_tokens(spark, path).collect()
    assert len(rows) == len(awkward())
    rows.sort(key=lambda r: r.start)
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids) and r.ids[-1] == 2
        at += r.n_tokens
    ids = [r.doc_id for r in rows]
    assert ids == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert Counter((r.doc_id, tuple(r.ids)) for r in rows) == Counter((k, (*library_ids(spec, t), 2)) for k, t, *_ in awkward())
    found = token_files.lookup(spark, path, [12, 14])
    assert sorted(r.doc_id for r in found.collect()) == [12, 14, 14]
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString().replace("PushedFilters: [IsNotNull(doc_id), In", "PushedFilters: [In")
    empty = scratch_path(spark, "t")
    token_files.write_tokens(docs.limit(0), empty, spec, end_id=2)
    assert token_files.with_crc(token_files.read_tokens(spark, empty)).count() == 0


def test_token_files_hold_rle_index_and_bloom_filter(spark, specs):
    from pyarrow import orc

    path = scratch_path(spark, "t")
    token_files.write_tokens(spark.read.parquet(f"{SF}/documents.parquet"), path, specs[queries.WORD_BPE], end_id=2, ranges=1)
    import glob

    files = glob.glob(path.removeprefix("file:") + "/*.orc")
    reader = orc.ORCFile(files[0])
    assert reader.row_index_stride == 1000 and str(reader.schema.field("ids").type).startswith("list<") and "int32" in str(reader.schema)
    raw = open(files[0], "rb").read()
    assert reader.compression.upper() == "ZSTD" and len(raw) > 0


def test_piece_lengths():
    for n in [*range(1, 5000, 7), 2048, 4096, 4097]:
        got = packing.piece_lengths(n)
        assert sum(got) == n and all(x & (x - 1) == 0 and x <= 2048 for x in got)
        assert got == sorted(got, reverse=True) and len([x for x in got if x < 2048]) == len({x for x in got if x < 2048})


def check_packed(rows, want):
    pieces, sequences = {}, Counter()
    for r in rows:
        sequences[r.sequence_id] += 1
        assert r.offset == 0 and r.length & (r.length - 1) == 0 and r.length <= 2048
        pieces.setdefault((r.doc_id, r.doc_tokens), []).append(r)
    assert set(sequences.values()) <= {1}
    assert sum(r.length for r in rows) == sum(len(i) for _, i in want)


def test_op7_pieces(spark, specs):
    want = {k: [*library_ids(specs[queries.BYTE_BPE], t), 1] for k, t in text_rows(spark)}
    rows = queries.op7_packing(spark, SF).collect()
    check_packed(rows, list(want.items()))
    seen = Counter()
    for r in rows:
        assert r.doc_tokens == len(want[r.doc_id])
        assert r.ids_crc32 == crc_le32(want[r.doc_id][r.start : r.start + r.length])
        seen[r.doc_id] += r.length
    assert seen == {k: len(v) for k, v in want.items()}


def test_packing_awkward_rows(spark, specs, monkeypatch):
    spec = specs[queries.BYTE_BPE]
    docs = clashing(spark.createDataFrame(awkward(), SCHEMA))
    rows = packing.pack(docs, spec, end_id=1, max_tokens=64).collect()
    want = [(k, [*library_ids(spec, t), 1]) for k, t, *_ in awkward()]
    check_packed(rows, want)
    ids = {}
    for r in sorted(rows, key=lambda r: (r.sequence_id & ((1 << 58) - 1))):
        ids.setdefault((r.doc_id, r.doc_tokens), []).extend(np.frombuffer(r.ids, "<u4").tolist())
    for k, i in want:
        assert ids[(k, len(i))][: len(i)] == i
    assert packing.pack(docs.limit(0), spec, end_id=1).count() == 0
    path = scratch_path(spark, "b")
    packing.write_buckets(packing.pack(docs, spec, end_id=1), path)
    assert all(r.length == 1 << r.bucket for r in spark.read.parquet(path).collect())


def test_token_rollups(spark, specs):
    spec, store = {"v": specs[queries.WORD_BPE]}, scratch_path(spark, "s")
    docs = clashing(spark.createDataFrame(awkward(), SCHEMA))
    token_counts.create(spark, store)
    assert token_counts.totals(spark, store).count() == 0
    size = [len(library_ids(spec["v"], r[1])) for r in awkward()]

    def totals():
        return {(r.source, r.lang): (r.n_docs, r.n_tokens) for r in token_counts.totals(spark, store).collect()}

    def brute(keep):
        out = {}
        for r, n in zip(awkward(), size, strict=True):
            if keep(r[0]):
                d, t = out.get((r[3], r[2]), (0, 0))
                out[(r[3], r[2])] = (d + 1, t + n)
        return out

    insert = token_counts.inserts(token_counts.count(docs, spec))
    token_counts.commit(spark, store, 1, insert)
    assert totals() == brute(lambda i: True)
    token_counts.commit(spark, store, 1, insert)  # sent again
    assert totals() == brute(lambda i: True)
    gone = spark.createDataFrame([(15,), (4,), (99,), (None,)], "doc_id long")
    for _ in range(2):
        token_counts.commit(spark, store, 2, token_counts.deletes(spark, store, gone, before=2))
    assert totals() == brute(lambda i: i not in (15, 4))
    new = spark.createDataFrame([(7, "one two three four", "en", "b", 1), (4, "not live", None, "b", 1)], SCHEMA)
    for _ in range(2):
        token_counts.commit(spark, store, 3, token_counts.revisions(spark, store, token_counts.count(new, spec), before=3))
    want = brute(lambda i: i not in (15, 4))
    d, t = want[("b", "en")]
    want[("b", "en")] = (d, t - len(library_ids(spec["v"], "one")) + 4)
    assert totals() == want


def test_token_rollups_of_empty_tables(spark, specs):
    spec, store = {"v": specs[queries.WORD_BPE]}, scratch_path(spark, "s")
    none = spark.createDataFrame([], SCHEMA)
    token_counts.create(spark, store)
    counted = token_counts.count(none, spec)
    token_counts.commit(spark, store, 1, token_counts.inserts(counted))
    token_counts.commit(spark, store, 2, token_counts.deletes(spark, store, none.select("doc_id"), before=2))
    token_counts.commit(spark, store, 3, token_counts.revisions(spark, store, counted, before=3))
    assert token_counts.totals(spark, store).count() == 0
    one = spark.createDataFrame([(1, "one two", "en", None, 1)], SCHEMA)
    token_counts.commit(spark, store, 4, token_counts.inserts(token_counts.count(one, spec)))
    token_counts.commit(spark, store, 5, token_counts.deletes(spark, store, none.select("doc_id"), before=5))
    assert [tuple(r) for r in token_counts.totals(spark, store).collect()] == [(None, "en", "v", 1, 2)]


def test_op8_equals_recount(spark, specs):
    import re

    labels = spark.read.parquet(f"{SF}/labels.parquet").collect()
    toxic, low = {r.doc_id for r in labels if r.toxic == 1}, {r.doc_id for r in labels if r.quality == 0}
    want = Counter(), Counter()
    for r in spark.read.parquet(f"{SF}/documents.parquet").collect():
        if r.doc_id in toxic:
            continue
        text = re.sub(r"[#$%&*|!]+", "", r.text) if r.doc_id in low else r.text
        for name, spec in specs.items():
            key = (r.source, r.lang, name.partition(".")[0])
            want[0][key] += 1
            want[1][key] += len(library_ids(spec, text))
    got = {(r.source, r.lang, r.tokenizer): (r.n_docs, r.n_tokens) for r in queries.op8_token_counts(spark, SF).collect()}
    assert got == {k: (n, want[1][k]) for k, n in want[0].items()}
