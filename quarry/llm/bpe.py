"""BPE encoding and decoding (operator 2) and the word memo other token operators use.

``encode`` builds a distinct-word table instead of running the tokenizer over texts:

1. documents are dealt into blocks (one exchange of zstd-compressed texts);
2. each block lists its distinct words, grouped by word bucket
   (``bucket = crc32(word) % word_buckets``), as one space-joined string per bucket;
3. the owner task of a word bucket encodes every distinct word once and sends the ids back
   to the blocks that asked for them;
4. each block joins the ids back to the word positions of its documents.

What travels is one copy of the texts and, per block, its distinct words and their ids; a
word that fills a third of the corpus is one entry per block.  ``decode`` is a join of ids
with the id-to-piece table, which is bounded by the tokenizer's vocabulary.

Words never contain white space: the tokenizer's pattern cannot cross it, so a text is the
concatenation of its words.  Texts of plain Latin letters are cut by the pattern itself;
any other run of non-blank characters is one "word" and the library cuts it.

Edge cases: a null text is an empty text (no ids); null or repeated ids and repeated rows
stay rows of their own; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import json
import re
import sys
import zlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LETTERS = "a-zß-öø-ÿœ"
#: texts for which the Python patterns below cut exactly as the tokenizers' own do
PLAIN = re.compile(r"[\t\n\r\x20-\x7eÀ-ÖØ-öø-ÿŒœ]*")
WORD_CUT = re.compile(rf"'(?:[stmd]|re|ve|ll)|[{LETTERS}]+|[0-9]|[^\s{LETTERS}0-9]+")
BYTE_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿŒœ"
BYTE_CUT = re.compile(
    rf"'(?:[stmd]|re|ve|ll)| ?[{BYTE_LETTERS}]+| ?[0-9]+| ?[^\s{BYTE_LETTERS}0-9]+|\s+(?!\S)|\s+"
)
#: pre-tokenizer patterns (fixed values of the public tokenizer files) the cutters stand for
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BLANK = re.compile(r"[ \t\n\r]+")

BLOCK_BYTES = 48 << 20  # texts of one block, before compression
MEMO_WORDS = 400_000  # words a task remembers: about 90 MB
WORD_BUCKETS = 256


def read_tokenizer(path: str) -> str:
    """The tokenizer file's JSON; tasks get the text, so executors need no such file."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def _kind(spec: str) -> str:
    """``word`` (cut at white space, lower case), ``byte`` (byte level) or ``other``."""
    j = json.loads(spec)
    pre, norm = j.get("pre_tokenizer") or {}, j.get("normalizer")
    steps = [n["type"] for n in (norm or {}).get("normalizers", [])]
    first = (pre.get("pretokenizers") or [{}])[0]
    if steps == ["NFC", "Replace", "Lowercase"] and first.get("pattern", {}).get("Regex") == WORD_PATTERN:
        return "word"
    if norm is None and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space"):
        return "byte"
    return "other"


def _le32(ids) -> bytes:
    return np.asarray(ids, dtype="<u4").tobytes()


def cut_words(text: str) -> list[str]:
    """Words of ``text`` under the ``word`` tokenizer: their ids, in order, are the text's."""
    if "<|" not in text and PLAIN.fullmatch(text):
        return WORD_CUT.findall(text.lower())
    out: list[str] = []
    for run in BLANK.split(text):
        if "<|" not in run and PLAIN.fullmatch(run):
            out += WORD_CUT.findall(run.lower())
        else:
            out.append(run)
    return out


class WordMemo(dict):
    """word -> its ids as little-endian uint32 bytes, for about ``most`` words; when it is full
    the half that was learnt last, which are the rare words, is forgotten.

    New words are encoded many at a time: joined into one text whose cuts are known, with the
    pieces that end (or start) a word telling them apart.  Words without that property, and
    texts that do not come apart into as many words, are encoded one by one.
    """

    JOINED = 2_000

    def __init__(self, tokenizer, kind: str = "other", most: int = MEMO_WORDS):
        super().__init__()
        self.tokenizer, self.kind, self.most = tokenizer, kind, most
        vocabulary = tokenizer.get_vocab(with_added_tokens=True)
        marks = (p.endswith("</w>") if kind == "word" else p.startswith("Ġ") for p in vocabulary)
        self.mark = np.zeros(max(vocabulary.values()) + 1, bool)
        self.mark[np.fromiter(vocabulary.values(), np.int64)] = np.fromiter(marks, bool)
        self.joins = {"word": re.compile(f"[{LETTERS}]+"), "byte": re.compile(f" [{BYTE_LETTERS}]+")}.get(kind)

    def learn(self, words: set[str]) -> None:
        new = words.difference(self)
        if len(self) + len(new) > self.most:
            while len(self) > self.most // 2:
                self.popitem()  # the last learnt: common words were learnt first
            new = words.difference(self)
        alone = [w for w in new if not self.joins or not self.joins.fullmatch(w)]
        if self.joins and len(alone) < len(new):
            left = set(alone)
            together = [w for w in new if w not in left]
            for at in range(0, len(together), self.JOINED):
                part = together[at : at + self.JOINED]
                if not self._learn_joined(part):
                    alone += part
        for at in range(0, len(alone), 20_000):
            part = alone[at : at + 20_000]
            for w, e in zip(part, self.tokenizer.encode_batch_fast(part, add_special_tokens=False), strict=True):
                self[w] = _le32(e.ids)

    def _learn_joined(self, words: list[str]) -> bool:
        text = (" " if self.kind == "word" else "").join(words)
        ids = np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")
        at = np.nonzero(self.mark[ids])[0] * 4
        if len(at) != len(words):
            return False
        raw = ids.tobytes()
        cuts = [0, *(at + 4).tolist()] if self.kind == "word" else [*at.tolist(), len(raw)]
        self.update(zip(words, (raw[i:j] for i, j in zip(cuts[:-1], cuts[1:], strict=True)), strict=True))
        return True


_ENCODERS: dict[int, TextEncoder] = {}


class TextEncoder:
    """Ids of whole texts, as the tokenizers library gives them, by way of a word memo."""

    def __init__(self, spec: str):
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.kind = _kind(spec)
        self.memo = WordMemo(self.tokenizer, self.kind)

    @classmethod
    def of(cls, spec: str, most: int = MEMO_WORDS) -> TextEncoder:
        """One encoder per Python worker, kept between tasks."""
        key = zlib.crc32(spec.encode())
        if key not in _ENCODERS:
            _ENCODERS[key] = cls(spec)
        _ENCODERS[key].memo.most = most
        return _ENCODERS[key]

    def words(self, text: str) -> list[str] | None:
        """None: the text is encoded as a whole."""
        if self.kind == "word":
            return cut_words(text)
        if self.kind == "byte" and "<|" not in text and PLAIN.fullmatch(text):
            return BYTE_CUT.findall(text)
        return None

    def encode(self, texts: list[str | None]) -> Iterator[bytes]:
        """Ids of each text as little-endian uint32 bytes (null: none)."""
        step = 1 << 21  # characters whose words are learnt together
        at = 0
        while at < len(texts):
            end, size = at, 0
            while end < len(texts) and (end == at or size + len(texts[end] or "") <= step):
                size += len(texts[end] or "")
                end += 1
            cut = [self.words(t) if t else [] for t in texts[at:end]]
            self.memo.learn(set().union(*(c for c in cut if c)))
            get = self.memo.__getitem__
            for text, c in zip(texts[at:end], cut, strict=True):
                if c is None:
                    yield _le32(self.tokenizer.encode(text, add_special_tokens=False).ids)
                else:
                    yield b"".join(map(get, c))
            at = end


PART_ROWS = 500
BATCH_ROWS = "1000"


def texts_to_python(df: DataFrame) -> DataFrame:
    """``df`` as it is; its session sends whole texts to Python ``BATCH_ROWS`` rows at a time.

    The setting is the session's: texts are wide rows, and the default of 10,000 rows a batch
    is held several times over by the JVM and by each Python worker.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    return df


def parts(batches: Iterator[pa.RecordBatch], rows: int = PART_ROWS) -> Iterator[pa.RecordBatch]:
    """Arrow batches in slices, so that a task turns few texts at a time into Python strings;
    at the end what Arrow has kept aside goes back."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)
    pa.default_memory_pool().release_unused()


def batch_texts(batch: pa.RecordBatch, name: str = "text") -> list[str | None]:
    return batch.column(name).to_pylist()


# ---- the distinct-word table ----------------------------------------------------------


def _by_bucket(words: set[str], buckets: int) -> dict[int, list[str]]:
    out: dict[int, list[str]] = {}
    for w in sorted(words):
        out.setdefault(zlib.crc32(w.encode()) % buckets, []).append(w)
    return out


def _blocks(docs: DataFrame, doc_id: str, text: str, block_bytes: int) -> DataFrame:
    """(block, doc_id, z): compressed texts, dealt by a hash of the row into blocks."""
    own = texts_to_python(docs).select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    total = own.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // block_bytes))
    block = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int")
    kept_type = own.schema["doc_id"].dataType.simpleString()

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for b in parts(batches):
            z = [squeeze(t.encode()) for t in batch_texts(b)]
            yield pa.RecordBatch.from_arrays([b.column("block"), b.column("doc_id"), pa.array(z, pa.binary())], ["block", "doc_id", "z"])

    return own.withColumn("block", block).mapInArrow(pack, f"block int, doc_id {kept_type}, z binary").repartition(n, "block")


def _unpack(table: pa.Table) -> Iterator[str]:
    open_ = zstandard.ZstdDecompressor().decompress
    for z in table.column("z"):
        yield open_(z.as_py()).decode()


def encode(
    docs: DataFrame,
    spec: str,
    doc_id: str = "doc_id",
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
    word_buckets: int = WORD_BUCKETS,
) -> DataFrame:
    """``(doc_id, ids)`` for each row; ``ids`` are little-endian uint32 bytes.

    ``spec`` is the JSON of a tokenizer whose pre-tokenizer cuts at white space (see
    ``read_tokenizer``).
    """
    if _kind(spec) != "word":
        raise ValueError("the distinct-word table needs a tokenizer that cuts at white space")
    blocks = _blocks(docs, doc_id, text, block_bytes)

    def wanted(table: pa.Table) -> pa.Table:
        words: set[str] = set()
        for t in _unpack(table):
            words.update(cut_words(t))
        words.discard("")
        by = _by_bucket(words, word_buckets)
        block = table.column("block")[0].as_py()
        return pa.table(
            [
                pa.array(list(by), pa.int32()),
                pa.array([block] * len(by), pa.int32()),
                pa.array([" ".join(ws) for ws in by.values()], pa.string()),
            ],
            ["bucket", "block", "words"],
        )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Encode a bucket's words: rows come bucket by bucket, and its part of the word table
        is held while its rows last, so every distinct word is encoded once."""
        memo, last = TextEncoder(spec).memo, None
        memo.most = sys.maxsize
        for b in batches:
            ids, sizes = [], []
            asked = [(k, line.split(" ")) for k, line in zip(*(b.column(c).to_pylist() for c in ("bucket", "words")), strict=True)]
            for bucket, rows in groupby(asked, key=lambda r: r[0]):
                if bucket != last:
                    memo.clear()
                    last = bucket
                lists = [words for _, words in rows]
                memo.learn(set().union(*lists))
                for words in lists:
                    got = [memo[w] for w in words]
                    ids.append(b"".join(got))
                    sizes.append(np.fromiter((len(g) // 4 for g in got), "<u4", len(got)).tobytes())
            yield pa.RecordBatch.from_arrays(
                [b.column("block"), b.column("bucket"), pa.array(ids, pa.binary()), pa.array(sizes, pa.binary())],
                ["block", "bucket", "ids", "sizes"],
            )

    def place(left: pa.Table, right: pa.Table) -> pa.Table:
        """Join the ids of the block's words back to the positions of its documents.

        A document is held as the numbers of its words, four bytes each.
        """
        number: dict[str, int] = {}
        documents = []
        for t in _unpack(left):
            words = cut_words(t)
            for w in set(words).difference(number):
                number[w] = len(number)
            documents.append(np.fromiter(map(number.__getitem__, words), np.uint32, len(words)))
        by, of = _by_bucket(number.keys() - {""}, word_buckets), {"": b""}
        for bucket, ids, sizes in zip(*(right.column(c).to_pylist() for c in ("bucket", "ids", "sizes")), strict=True):
            ends = (np.frombuffer(sizes, "<u4").astype(np.int64).cumsum() * 4).tolist()
            at = 0
            for w, end in zip(by[bucket], ends, strict=True):
                of[w] = ids[at:end]
                at = end
        found = [of[w] for w in number]  # by number
        out = pa.array([b"".join(map(found.__getitem__, d.tolist())) for d in documents], pa.binary())
        return pa.table([left.column("doc_id"), out], ["doc_id", "ids"])

    table = (
        blocks.groupBy("block")
        .applyInArrow(wanted, "bucket int, block int, words string")
        .repartition("bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(learn, "block int, bucket int, ids binary, sizes binary")
    )
    kept_type = docs.schema[doc_id].dataType.simpleString()
    return blocks.groupBy("block").cogroup(table.groupBy("block")).applyInArrow(place, f"doc_id {kept_type}, ids binary")


def pieces(spec: str) -> list[str]:
    """The id-to-piece table: as long as the vocabulary, whatever the corpus."""
    j = json.loads(spec)
    of = {i: p for p, i in j["model"]["vocab"].items()} | {t["id"]: t["content"] for t in j["added_tokens"]}
    return [of.get(i, "") for i in range(max(of) + 1)]


def decode(encoded: DataFrame, spec: str, ids: str = "ids", out: str = "decoded") -> DataFrame:
    """Add the text of ``ids`` (little-endian uint32 bytes), special tokens included.

    Ids are joined with the id-to-piece table inside each task.  Without a decoder in the
    tokenizer file pieces are joined by blanks, as the library does.
    """
    if json.loads(spec)["decoder"] is not None:
        raise ValueError("this join knows tokenizers without a decoder step")
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)

    def join_pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.array(pieces(spec), dtype=object)
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = [" ".join(table[np.frombuffer(x or b"", "<u4")]) for x in part.column(ids).to_pylist()]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(texts, pa.string())], [*part.schema.names, out])

    return encoded.mapInArrow(join_pieces, f"{fields}, `{out}` string")
