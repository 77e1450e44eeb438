"""One query per operator, over whole tables, and its SQL where SQL can express it."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from innkeep.llm.common import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def tokenizer_path() -> str:
    """The tokenizer file, by default that of the installed collection."""
    if "INNKEEP_TOKENIZER" in os.environ:
        return os.environ["INNKEEP_TOKENIZER"]
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


@query
def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all sources, weighing 3, 1, 2 in turn, takes of each document."""
    from innkeep.llm.mixing import mix

    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLES["op1_mixing"] = r"""
with sizes as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from documents
), sources as (
  select source, sum(size)::bigint as source_size,
         case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 3.0::double when 1 then 1.0::double else 2.0::double end as weight
  from sizes group by source
), ordered as (
  select *, 2.0::double * source_size / weight as ratio,
         (1.5::double * sum(source_size) over () - coalesce(sum(2.0::double * source_size) over (
            order by 2.0::double * source_size / weight, source nulls last rows between unbounded preceding and 1 preceding), 0))
         / sum(weight) over (order by 2.0::double * source_size / weight, source nulls last rows between current row and unbounded following) as level
  from sources
), levels as (
  select *, (select arg_min(level, ratio) from ordered where ratio > level) as even from ordered
), targets as (
  select source, source_size, coalesce(least(2.0::double * source_size, weight * even), 2.0::double * source_size) as target from levels
), parts as (
  select doc_id, size, source, source_size, target,
         case when source_size > 0 then target / source_size else 0.0::double end as copies,
         (('0x' || substr(md5('1:' || doc_id), 1, 13))::bigint + 0.5::double) / 4503599627370496::double as u
  from sizes join targets using (source)
), ranked as (
  select *, floor(copies) as whole, copies - floor(copies) as p, floor(target - floor(copies) * source_size)::bigint as open from parts
), reached as (
  select *, coalesce(sum(size) over (partition by source order by (u / (1 - u)) / (p / (1 - p)), doc_id, size
                                     rows between unbounded preceding and 1 preceding), 0)::bigint as before
  from ranked where p > 0
)
select doc_id, size, source_size, target,
       (whole * size + greatest(0, least(size, open - before)))::bigint as taken from reached
union all
select doc_id, size, source_size, target, (whole * size)::bigint from ranked where p = 0
"""


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document, its lines, those that repeat an earlier document's, and the rest's hash."""
    from innkeep.llm.lines import dedup_lines

    kept = dedup_lines(table(spark, sf_dir, "documents"))
    return kept.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op2_line_dedup"] = r"""
with lines as (
  select doc_id, unnest(string_split(coalesce(text, ''), chr(10))) as line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) as i
  from documents
), keyed as (
  select *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as key from lines
), shared as (
  select key, min(doc_id) as owner from keyed where length(key) >= 10 group by key having count(distinct doc_id) > 1
), marked as (
  select k.*, s.owner is not null and s.owner <> k.doc_id as gone from keyed k left join shared s using (key)
)
select doc_id, count(*) as n_lines, count(*) filter (gone) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (not gone), '')) as kept_sha256
from marked group by doc_id
"""


@query
def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every text."""
    from innkeep.llm.secret_scan import scan_secrets

    return scan_secrets(table(spark, sf_dir, "documents"))


@query
def op4_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces, packed into sequences of 4096 tokens."""
    from innkeep.llm.packing import pack_documents

    packed = pack_documents(table(spark, sf_dir, "documents"), tokenizer_path(), 4096, 1)
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


#: Bytes of text in a shard: what a reader fetches in one request.
SHARD_BYTES = 1 << 20


@query
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's shard of at most a megabyte of text."""
    from innkeep.llm.sharding import assign_shards

    return assign_shards(table(spark, sf_dir, "documents"), SHARD_BYTES).select("doc_id", "n_bytes", "shard", "depth", "shard_bytes")


ORACLES["op7_sharding"] = f"""
with items as (
  select doc_id, strlen(coalesce(text, ''))::bigint as n_bytes,
         ('0x' || substr(md5(doc_id || ':' || strlen(coalesce(text, ''))), 1, 15))::bigint as hash
  from documents
), levels as (
  select *, hash >> (60 - depth) as prefix from items, (select unnest(range(0, 41)) as depth)
), sums as (
  select depth, prefix, sum(n_bytes)::bigint as shard_bytes, count(*) as n from levels group by depth, prefix
), leaves as (
  select doc_id, n_bytes, hash, min(depth) as depth, arg_min(shard_bytes, depth) as shard_bytes
  from levels join sums using (depth, prefix) where shard_bytes <= {SHARD_BYTES} or n <= 1 group by doc_id, n_bytes, hash
)
select doc_id, n_bytes, substr(lpad(bin(hash), 60, '0'), 1, depth::int) as shard, depth::int as depth, shard_bytes from leaves
"""


@query
def op10_merkle_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and of its edited text."""
    from innkeep.llm.merkle import edited_fingerprints

    return edited_fingerprints(table(spark, sf_dir, "documents"))


@query
def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's set size and near-duplicate component."""
    from innkeep.llm.jaccard import near_components

    return near_components(table(spark, sf_dir, "documents"))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score."""
    from innkeep.llm.toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op6_multi_index_hashing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest vectors of every twentieth one."""
    from innkeep.llm.ann import nearest

    return nearest(table(spark, sf_dir, "embeddings"), k=20, every=20)


@query
def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on every page's url.  A page's outcome is the quality label of its id."""
    from innkeep.llm.url_filter import filter_urls

    outcomes = table(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), F.col("quality").alias("good"))
    return filter_urls(table(spark, sf_dir, "pages"), outcomes).select("page_id", "host", "path", "rule", "verdict")


def _level(name: str, group: str, prior: str, source: str) -> str:
    """One level of the hierarchy in SQL: moments, strength, posterior."""
    return f"""{name}_groups as (
  select {group}, {prior}::double as prior, sum(good)::double as good, sum(n)::double as n from {source} group by all
), {name}_fit as (
  select sum(n * (good / n - prior) * (good / n - prior)) as spread, sum(prior * (1 - prior)) as chance,
         sum((n - 1) * prior * (1 - prior)) as room
  from {name}_groups where n > 1
), {name}_strength as (
  select case when coalesce(room, 0) = 0 or spread <= chance then 200.0::double
              else least(200.0::double, greatest(2.0::double, room / (spread - chance) - 1)) end as strength from {name}_fit
), {name} as (
  select *, prior * strength + good as a, (1 - prior) * strength + n - good as b,
         (prior * strength + good) / (strength + n) as mean
  from {name}_groups, {name}_strength
)"""


ORACLES["op9_url_filter"] = rf"""
with judged as (
  select page_id, regexp_extract(coalesce(url, ''), '(?s)^.*?://(.*)$', 1) as rest from pages
), split as (
  select page_id, translate(regexp_extract(rest, '(?s)^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
         regexp_extract(rest, '(?s)^[^/?#]*([^?#]*)', 1) as path
  from judged
), known as (
  select doc_id as page_id, min(quality) as good from labels where doc_id is not null and quality is not null group by doc_id
), hosts as (
  select host, coalesce(sum(good), 0) as good, count(good) as n, string_split(host, '.') as labels
  from split left join known using (page_id) group by host
), named as (
  select host, good, n, labels[-1] as suffix, array_to_string(list_slice(labels, greatest(1, len(labels) - 1), len(labels)), '.') as domain,
         (sum(good) over () + 1.0::double) / (sum(n) over () + 2.0::double) as overall
  from hosts
), {_level("by_suffix", "suffix", "overall", "named")}, {_level("by_domain", "domain, suffix", "mean", "(select domain, suffix, h.good, h.n, s.mean from named h join by_suffix s using (suffix))")},
{_level("by_host", "host, domain", "mean", "(select host, domain, h.good, h.n, d.mean from named h join by_domain d using (domain))")}, bounds as (
  select host, mean + 2.0::double * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) as bound from by_host
), ruled as (
  select *, case when (host = 'www.example.com' or host like '%.www.example.com') and starts_with(path, '/en/') then 'www.example.com/en/'
                 when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/en/') then 'example.com/en/'
                 when (host = 'net' or host like '%.net') and starts_with(path, '/es/') then 'net/es/'
                 when (host = 'net' or host like '%.net') and starts_with(path, '/fr/') then 'net/fr/'
                 when (host = 'com' or host like '%.com') and starts_with(path, '/') then 'com/' end as rule
  from split join bounds using (host)
)
select page_id, host, path, rule,
       case when rule in ('www.example.com/en/', 'com/') then 'allow' when rule is not null then 'block'
            when bound < 0.5 then 'block' else 'allow' end as verdict
from ruled
"""


@query
def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each language's two thousand most cohesive phrases."""
    from innkeep.llm.collocations import collocations

    return collocations(table(spark, sf_dir, "documents"), support=30, top=2000, covered=80)


ORACLES["op13_phrase_collocations"] = r"""
with texts as (
  select coalesce(lang, 'und') as lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents
), pieces as (
  select lang, regexp_extract_all(unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') as words from texts
), spans as (
  select lang, words, unnest(range(1, 5)) as size from pieces
), grams as (
  select lang, size, list_slice(words, i, i + size - 1) as words
  from (select lang, words, size, unnest(range(1, (len(words) - size + 2)::bigint)) as i from spans)
), counts as (
  select lang, words, size, array_to_string(words, ' ') as phrase, count(*) as f from grams group by all
), totals as (
  select lang, sum(f)::bigint as n from counts where size = 1 group by lang
), candidates as (
  select * from counts where size >= 2 and f >= 30
), cuts as (
  select lang, phrase, words, size, f as a, unnest(range(1, size)) as k from candidates
), scored as (
  select c.lang, c.phrase, c.a, k, l.f as l, r.f as r, (2000000::hugeint * c.a) // (l.f::hugeint + r.f) as score
  from cuts c join counts l on l.lang = c.lang and l.words = list_slice(c.words, 1, k)
              join counts r on r.lang = c.lang and r.words = list_slice(c.words, k + 1, c.size)
), best as (
  select lang, phrase, a, arg_min({'l': l, 'r': r, 'score': score}, score * 8 + k) as b from scored group by all
), starts as (
  select lang, words, f, size, length, unnest(range(1, size - length + 2)) as i
  from (select lang, words, f, size, unnest(range(2, size)) as length from candidates where size > 2)
), inside as (
  select lang, array_to_string(list_slice(words, i, i + length - 1), ' ') as phrase, max(f) as longer from starts group by all
), kept as (
  select b.* from best b left join inside i on i.lang = b.lang and i.phrase = b.phrase
  where longer is null or 100::hugeint * longer < 80::hugeint * a
), ranked as (
  select *, row_number() over (partition by lang order by b.score desc, a desc, phrase) as rank from kept
)
select lang, rank::bigint as rank, phrase, a::bigint as a, b.l::bigint as l, b.r::bigint as r, n, b.score::bigint as score
from ranked join totals using (lang) where rank <= 2000
"""


@query
def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector."""
    from innkeep.llm.negatives import hard_negatives

    rows = table(spark, sf_dir, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(rows.select("vec_id", "embedding", moved.alias("label")), F.col("vec_id") % 100 == 0)


ORACLES["op11_hard_negatives"] = r"""
with rows as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         list_transform(embedding, lambda x: floor(256 * x::double)) as x
  from embeddings
  where vec_id is not null and label is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), scored as (
  select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same, list_inner_product(a.x, r.x)::bigint as score
  from rows a, rows r where a.vec_id % 100 = 0
), positives as (
  select anchor_id, vec_id as positive_id, score as positive_score from scored where same and vec_id <> anchor_id
  qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
)
select anchor_id, positive_id,
       row_number() over (partition by anchor_id, positive_id order by score desc, vec_id)::bigint as rank,
       vec_id as negative_id, positive_score, score as negative_score
from positives join scored using (anchor_id)
where not same and 80 * positive_score <= 100 * score and 100 * score <= 100 * positive_score
qualify rank <= 5
"""


@query
def op12_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's examples, read back; and one whose texts hold control strings."""
    from innkeep.llm.chat import chat_digest

    columns = "conv_id", "turn", "role", "text"
    odd = r"\### Assistant: </turn> ok"
    more = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    return chat_digest(table(spark, sf_dir, "conversations").select(*columns).unionByName(more))


ORACLES["op12_chat_formatting"] = r"""
with said as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'
), written as (
  select *, regexp_replace(replace(replace(role, '\', '\b'), chr(10), '\l'), '(### |</turn)', '\\\1', 'g') as head,
         regexp_replace(text, '(### |</turn)', '\\\1', 'g') as body
  from said
), sized as (
  select *, sum(4 + length(head) + 2 + length(body) + 9) over all_before as upto,
         row_number() over all_before = count(*) over (partition by conv_id) as last
  from written window all_before as (partition by conv_id order by turn nulls last, role, md5(text)
                                     rows between unbounded preceding and current row)
)
select conv_id, count(*) as n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls last, role, md5(text))) as turns_sha256,
       coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
       sha256(coalesce(string_agg(text, '' order by turn nulls last, role, md5(text)) filter (role = 'assistant'), '')) as loss_sha256,
       (sum(upto) filter (role = 'assistant' or last))::bigint as formatted_chars
from sized group by conv_id
"""
