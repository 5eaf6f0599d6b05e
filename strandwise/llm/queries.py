"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op3_url_filters",
    """
with parts as (
  select page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
  from (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
        from pages)),
rules(rhost, rpath, action) as (values ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
  ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
best as (
  select p.*, (select max({'n': length(rhost) + length(rpath), 'rule': rhost || rpath, 'action': action})
    from rules where (p.host = rhost or ends_with(p.host, '.' || rhost)) and starts_with(p.path, rpath)) as b
  from parts p)
select page_id, host, path, b.rule as rule, coalesce(b.action, case when regexp_matches(host || path,
  '^([^/]*[.-])?(casino|cheap-pills|free-bets)[.-]') then 'block' else 'allow' end) as verdict
from best
""",
)
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandwise.llm.url_rules import HostRule, judge_urls

    rules = [
        HostRule("allow", "com", "/"), HostRule("block", "example.com", "/en/"),
        HostRule("allow", "www.example.com", "/en/"), HostRule("block", "net", "/es/"), HostRule("block", "net", "/fr/"),
    ]
    return judge_urls(table(spark, sf_dir, "pages").select("page_id", "url"), rules).drop("url")


@query("op5_mixing")
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandwise.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("blocks")


@query("op8_simhash_near_dedup")
def op8_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandwise.llm.simhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query(
    "op6_warc",
    """
with p as (select page_id, coalesce(encode(html), ''::blob) as payload from pages),
f as (select *, min(page_id) over (partition by payload) as least from p),
h as (select *, sha1(payload) as hex from f),
bits as (select *, [instr('0123456789abcdef', x) - 1 for x in string_split(hex, '')] as n from h)
select page_id, cast(octet_length(payload) as bigint) as payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', cast(1 + ((n[(5 * k) // 4 + 1] * 16
    + coalesce(n[(5 * k) // 4 + 2], 0)) // (1 << (3 - (5 * k) % 4))) % 32 as bigint), 1) for k in range(32)], '') as payload_digest,
  case when least = page_id then 'response' else 'revisit' end as record_type,
  case when least = page_id then null else least end as refers_to
from bits
""",
)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandwise.llm.warc import round_trip

    return round_trip(spark, table(spark, sf_dir, "pages"))


@query("op7_benchmark_decontamination")
def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandwise.llm.contamination import contained

    return contained(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


@query("op1_toxicity")
def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandwise.llm.common import fold
    from strandwise.llm.toxicity import fit, score

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"), fold("doc_id") != 0)
    held = F.coalesce(fold("doc_id") == 0, F.lit(False))
    return score(docs, model).drop("passages").select("doc_id", held.alias("held_out"), "score", "predicted", "n_passages", "evidence")


def tokenizer_file(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op10_token_store")
def op10_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandwise.llm.token_store import round_trip

    return round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_file())


@query("op9_embedding_near_dedup")
def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandwise.llm.lattice import near_duplicates

    return near_duplicates(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


@query("op2_suffix_array_dedup")
def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandwise.llm.suffix_dedup import deduplicate

    return deduplicate(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept")


@query("op4_lm_scoring")
def op4_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandwise.llm.common import fold
    from strandwise.llm.lm_scoring import fit_encoded, numbered, score_encoded

    rows = numbered(table(spark, sf_dir, "documents").select("doc_id", "text"), tokenizer_file(), fold("doc_id") == 1)
    return score_encoded(rows, fit_encoded(rows.where("not held_out"), tokenizer_file()))


@query("op13_sentencepiece")
def op13_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandwise.llm.pieces import decode, encode

    model = tokenizer_file("piece_bpe_32k.model")
    ids = encode(table(spark, sf_dir, "documents").select("doc_id", "text"), model).drop("text")
    return decode(ids, model).select(
        "doc_id", F.floor(F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.encode("decoded", "UTF-8"), 256).alias("decoded_sha256"))


@query(
    "op11_lexical_search",
    r"""
with d as (select row_number() over () as r, doc_id, text from documents),
t as (select r, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
i as (select row_number() over () as q, item_id, text from benchmark),
asked as (select q, term, count(*) as c from (select q, unnest(regexp_extract_all(
  translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from i) group by q, term),
lengths as (select r, count(*) as n from t group by r),
total as (select count(*) as docs, cast(sum(n) as bigint) as terms from lengths),
tf as (select r, term, count(*) as tf from t where term in (select term from asked) group by r, term),
df as (select term, count(*) as df from tf group by term),
weights as (select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * df + 1))) as bigint) as w from df, total),
scores as (select q, r, cast(sum(c * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // terms)))) as bigint) as score
  from asked join tf using (term) join weights using (term) join lengths using (r), total group by q, r),
ranked as (select *, row_number() over (partition by q order by score desc, doc_id nulls last) as rank
  from scores join d using (r) where score > 0)
select item_id, cast(rank as integer) as rank, doc_id, score from ranked join i using (q) where rank <= 20
""",
)
def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandwise.llm.lexical import search

    return search(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))


@query("op12_whitening")
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from strandwise.llm.whitening import whiten

    return whiten(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
