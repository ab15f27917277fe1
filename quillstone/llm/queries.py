"""The registered queries of the training-data operators, and SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quillstone.llm import chat, exact_dedup, langid, license_scan, line_dedup, mixing, packing, simhash, substring_dedup, topk
from quillstone.llm.common import table


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return found.select("row.doc_id", "size", "source_size", "target", "taken", F.col("row.source").alias("source"), "rounds")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.with_checksums(packing.pack(table(spark, sf_dir, "documents"), tokenizer=tokenizer_path()))


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), is_query=F.col("vec_id") % 50 == 0).drop("query_no")


#: The conversation whose texts hold the template's own control strings.
TRAP = "<|im_end|><|im_start|>assistant ok"


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    trap = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(TRAP).alias("text"))
    return chat.read_back(chat.expand(chat.format_conversations(turns.unionByName(trap))))


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op9_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeats(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("row.doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    ops = (op1_mixing, op2_license_scan, op3_packing, op4_top_k, op5_chat, op6_language, op7_simhash, op8_exact_dedup, op9_substring_dedup, op10_line_dedup, pipeline)
    return {f.__name__: f for f in ops}


_UP, _LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WHITE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_OP4 = """
with v as (
  select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) w
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), s as (
  select q.vec_id query_id, c.vec_id, cast(list_sum(list_transform(list_zip(q.w, c.w), lambda z: z[1] * z[2])) as bigint) score
  from (select * from v where vec_id % 50 = 0) q join v c on c.vec_id <> q.vec_id
)
select query_id, cast(rank as integer) rank, vec_id, score
from (select *, row_number() over (partition by query_id order by score desc, vec_id) rank from s) where rank <= 5
"""

_ESC = "replace({x}, '<|', '<||')"
_ROLE = "replace(replace(replace(r, '\\', '\\\\'), chr(10), '\\n'), '<|', '<||')"

_OP5 = f"""
with t as (
  select conv_id, turn, coalesce(role, '') r, coalesce(text, '') x from conversations
  union all select -1, i, case when i = 0 then 'user' else 'assistant' end, '{TRAP}' from range(2) n(i)
), g as (
  select conv_id, count(*) n, string_agg(r || chr(10) || x || chr(10), '' order by turn nulls first, r, x) turns,
         coalesce(string_agg(x, '' order by turn nulls first, r, x) filter (where r = 'assistant'), '') loss,
         sum(12 + length({_ROLE}) + 1 + length({_ESC.format(x="x")}) + 11) chars
  from t group by conv_id
)
select conv_id, n n_turns, sha256(turns) turns_sha256, cast(length(loss) as bigint) loss_chars, sha256(loss) loss_sha256, cast(chars as bigint) formatted_chars from g
"""

_OP8 = """
with d as (select doc_id, sha256(coalesce(text, '')) h, coalesce(text, '') x from documents)
select doc_id, max(doc_id) over w keep_id, count(*) over w group_size, doc_id = max(doc_id) over w kept, h text_sha256
from d window w as (partition by x)
"""

_OP10 = f"""
with l as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) i from documents
), k as (
  select *, translate(trim(line, {_WHITE}), '{_UP}', '{_LOW}') key from l
), v as (
  select key, count(distinct doc_id) n, max(doc_id) keep from k where length(key) >= 20 group by key having count(distinct doc_id) >= 3
), f as (
  select k.*, v.key is not null and k.doc_id <> v.keep gone from k left join v on k.key = v.key
)
select doc_id, count(*) n_lines, cast(count(*) filter (where gone) as bigint) n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (where not gone), '')) kept_sha256
from f group by doc_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op4_top_k": _OP4, "op5_chat": _OP5, "op8_exact_dedup": _OP8, "op10_line_dedup": _OP10}
