"""The ``opN_<name>`` queries: each operator with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import bpe, chat, exact_dedup, line_dedup, merkle, minhash, oracles, packing, quality, simhash, syncmers, token_counts, token_files, trie
from quarry.llm.sketch import bloom, may_contain
from quarry.session import scratch_path
from quarry.tables import read_table

WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.json"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer(name: str) -> str:
    return bpe.read_tokenizer(public_tokenizers.path(name))


@query
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = quality.fit(docs, read_table(spark, sf_dir, "labels"))
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id",
        quality.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


@query
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = tokenizer(WORD_BPE)
    encoded = bpe.encode(read_table(spark, sf_dir, "documents"), spec)
    return bpe.decode(encoded, spec).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


@query
def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_tokens(read_table(spark, sf_dir, "documents"), path, tokenizer(WORD_BPE), end_id=2)
    return token_files.with_crc(token_files.read_tokens(spark, path))


@query
def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = line_dedup.line_classes(read_table(spark, sf_dir, "documents"))
    return classes.select(
        "doc_id",
        F.col("line_no").cast("long").alias("line_no"),
        F.col("first.doc_id").alias("class_doc_id"),
        F.col("first.line_no").cast("long").alias("class_line_no"),
        F.col("links").cast("long").alias("links"),
        "kept",
    )


ORACLE["op4_line_dedup"] = f"""
with recursive lines as (
  select doc_id, unnest(string_split(text, chr(10))) as line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 as line_no
  from documents where text is not null
), whole_lines as (
  select * from lines where trim(line) <> ''
), different as (
  select line, min((doc_id, line_no)) as first from whole_lines group by line
), near as (
  select line, length(line) as n from different where length(line) >= {line_dedup.NEAR_CHARS}
), links as (
  select x.line as a, y.line as b
  from near x join near y on y.n between x.n - {line_dedup.THRESHOLD} and x.n + {line_dedup.THRESHOLD} and x.line <> y.line
  where levenshtein(x.line, y.line) <= {line_dedup.THRESHOLD}
), reach as (
  select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a
), classes as (
  select d.line, least(d.first, min(o.first)) as first
  from different d left join reach r on r.a = d.line left join different o on o.line = r.b
  group by d.line, d.first
), degree as (select a as line, count(*) as links from links group by a)
select l.doc_id, l.line_no::bigint as line_no, c.first[1] as class_doc_id, c.first[2]::bigint as class_line_no,
       coalesce(g.links, 0)::bigint as links, c.first = (l.doc_id, l.line_no) or length(l.line) < {line_dedup.MIN_CHARS} as kept
from whole_lines l join classes c on c.line = l.line left join degree g on g.line = l.line
"""


def _spans(mask: str):
    return F.array_join(F.transform(mask, lambda m: F.concat_ws(":", m.start.cast("string"), m.length.cast("string"))), ",")


@query
def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = chat.neighbour_pairs(read_table(spark, sf_dir, "conversations"))
    return chat.preferences(turns).select(
        F.col("pair_id").alias("conv_id"),
        F.col("prompt_turns").cast("long").alias("prompt_turns"),
        "prompt",
        "chosen",
        "rejected",
        _spans("chosen_mask").alias("chosen_mask"),
        _spans("rejected_mask").alias("rejected_mask"),
        "usable",
    )


ORACLE["op5_chat"] = """
with answers as (select conv_id, max(turn) as last from conversations where role = 'assistant' group by conv_id),
marked as (select c.*, a.last from conversations c left join answers a using (conv_id)),
sides as (
  select conv_id, 'chosen' as side, turn, role, text from marked
  union all
  select conv_id, 'rejected', turn, role, text from marked where last is null or turn < last
  union all
  select a.conv_id, 'rejected', a.last, m.role, m.text
  from marked m join answers a on a.conv_id = xor(m.conv_id, 1) where m.turn = m.last and m.role = 'assistant'
), placed as (
  select *, row_number() over (partition by conv_id, side order by turn, role, text) as pos,
         '<|' || role || '|>' || chr(10) as head, text || '<|end|>' || chr(10) as body
  from sides
), spots as (
  select *, sum(length(head) + length(body)) over (partition by conv_id, side order by pos) - length(head) - length(body) as spot
  from placed
), differ as (
  select coalesce(c.conv_id, r.conv_id) as conv_id,
         coalesce(min(case when c.role is distinct from r.role or c.text is distinct from r.text then coalesce(c.pos, r.pos) end) - 1,
                  max(c.pos)) as prompt_turns
  from (select * from placed where side = 'chosen') c
  full join (select * from placed where side = 'rejected') r on r.conv_id = c.conv_id and r.pos = c.pos
  group by 1
), prompts as (
  select s.conv_id, d.prompt_turns,
         coalesce(string_agg(head || body, '' order by pos) filter (where side = 'chosen' and pos <= prompt_turns), '') as prompt,
         coalesce(string_agg(head || body, '' order by pos) filter (where side = 'chosen' and pos > prompt_turns), '') as chosen,
         coalesce(string_agg(head || body, '' order by pos) filter (where side = 'rejected' and pos > prompt_turns), '') as rejected
  from spots s join differ d using (conv_id) group by 1, 2
), masks as (
  select s.conv_id, s.side, string_agg((spot + length(head) - length(prompt))::bigint || ':' || length(body), ',' order by pos) as mask
  from spots s join prompts p using (conv_id) where pos > prompt_turns and role = 'assistant' group by 1, 2
)
select p.conv_id, p.prompt_turns, p.prompt, p.chosen, p.rejected, coalesce(c.mask, '') as chosen_mask,
       coalesce(r.mask, '') as rejected_mask, p.chosen <> p.rejected as usable
from prompts p left join masks c on c.conv_id = p.conv_id and c.side = 'chosen'
left join masks r on r.conv_id = p.conv_id and r.side = 'rejected'
"""


@query
def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = exact_dedup.exact_groups(read_table(spark, sf_dir, "documents"))
    return groups.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE["op6_exact_dedup"] = """
with texts as (
  select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents
), groups as (select t, max(doc_id) as keep_id, count(*) as group_size from texts group by t)
select d.doc_id, g.keep_id, g.group_size, d.doc_id = g.keep_id as kept, sha256(d.t) as text_sha256
from texts d join groups g on g.t = d.t
"""


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(read_table(spark, sf_dir, "documents"), tokenizer(BYTE_BPE), end_id=1)
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "bucket"
    )


@query
def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after three batches: all documents come in, toxic ones are taken back, and
    documents of low quality are counted anew without their symbol runs.  The second batch
    is sent twice, as after a lost job."""
    specs = {name.partition(".")[0]: tokenizer(name) for name in (BYTE_BPE, WORD_BPE)}
    docs, labels = read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels")
    store = scratch_path(spark, "token-counts")
    token_counts.create(spark, store)
    token_counts.commit(spark, store, 1, token_counts.inserts(token_counts.count(docs, specs)))
    for _ in range(2):
        toxic = labels.where("toxic = 1").select("doc_id")
        token_counts.commit(spark, store, 2, token_counts.deletes(spark, store, toxic, before=2))
    # texts stay where they are: what the cleaning changes is counted, then the counts are joined
    clean = F.regexp_replace("text", r"[#$%&*|!]+", "")
    low = labels.where("quality = 0").select("doc_id").distinct()
    changed = docs.where(may_contain(bloom(low, "doc_id"), F.col("doc_id")) & (clean != F.col("text"))).withColumn("text", clean)
    recounted = token_counts.count(changed, specs).join(low, "doc_id", "left_semi")
    token_counts.commit(spark, store, 3, token_counts.revisions(spark, store, recounted, before=3))
    return token_counts.totals(spark, store)


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.components(read_table(spark, sf_dir, "documents"))


@query
def op10_syncmers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syncmers.compare_edits(read_table(spark, sf_dir, "documents"))


@query
def op11_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(read_table(spark, sf_dir, "conversations"))


ORACLE["op11_trie"] = oracles.trie()


@query
def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.components(read_table(spark, sf_dir, "documents"), shingle=2, percent=80)


ORACLE["op12_minhash"] = oracles.minhash()


@query
def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.manifest(read_table(spark, sf_dir, "documents"))


ORACLE["op13_merkle"] = oracles.merkle()
