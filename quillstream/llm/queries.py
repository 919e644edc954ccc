"""Registered queries of the operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from quillstream.llm import bwtdedup, collocations, convtrie, decontam, htmltext, iblt, langid, linededup, minhash, packing, quality, sharding, toxicity
from quillstream.session import ensure_checkpoint_dir, ship_package
from quillstream.sources.tables import read_table

Query = Callable[[SparkSession, str], DataFrame]


def ready(spark: SparkSession) -> None:
    """Before an operator runs: a shared folder for intermediate tables, and the package in the Python workers."""
    ensure_checkpoint_dir(spark)
    ship_package(spark)


def _documents(spark: SparkSession, d: str) -> DataFrame:
    ready(spark)
    return read_table(spark, d, "documents", ["doc_id", "text"])


def _labels(spark: SparkSession, d: str) -> DataFrame:
    return read_table(spark, d, "labels", ["doc_id", "quality", "toxic"])


def op1_main_text(spark: SparkSession, d: str) -> DataFrame:
    ready(spark)
    return htmltext.extract(read_table(spark, d, "pages", ["page_id", "url", "html"]))


def op2_sketch_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    return iblt.fingerprints(_documents(spark, d))


def op3_toxicity(spark: SparkSession, d: str) -> DataFrame:
    return toxicity.score_documents(_documents(spark, d), _labels(spark, d))


def op4_template_decontamination(spark: SparkSession, d: str) -> DataFrame:
    return decontam.flag_documents(_documents(spark, d), read_table(spark, d, "benchmark", ["item_id", "text"]))


def op5_rendezvous(spark: SparkSession, d: str) -> DataFrame:
    return sharding.shard_records(_documents(spark, d))


def op6_bwt_dedup(spark: SparkSession, d: str) -> DataFrame:
    return bwtdedup.dedup_bytes(_documents(spark, d))


def op7_near_duplicates(spark: SparkSession, d: str) -> DataFrame:
    return minhash.near_classes(_documents(spark, d)).select("doc_id", "class_id")


def op8_unit_dedup(spark: SparkSession, d: str) -> DataFrame:
    return linededup.dedup_units(_documents(spark, d))


def op9_quality(spark: SparkSession, d: str) -> DataFrame:
    return quality.score_documents(_documents(spark, d), _labels(spark, d))


def op10_pack(spark: SparkSession, d: str) -> DataFrame:
    return packing.pack_documents(_documents(spark, d))


def op11_collocations(spark: SparkSession, d: str) -> DataFrame:
    ready(spark)
    return collocations.collocations(read_table(spark, d, "documents", ["text", "lang"]))


def op12_hyperdimensional_language(spark: SparkSession, d: str) -> DataFrame:
    ready(spark)
    return langid.identify(read_table(spark, d, "documents", ["doc_id", "text", "lang"]))


def op13_conversation_trie(spark: SparkSession, d: str) -> DataFrame:
    ready(spark)
    return convtrie.trie(read_table(spark, d, "conversations", ["conv_id", "turn", "role", "text"]))


QUERIES: dict[str, Query] = {
    "op1_main_text": op1_main_text,
    "op2_sketch_fingerprints": op2_sketch_fingerprints,
    "op3_toxicity": op3_toxicity,
    "op4_template_decontamination": op4_template_decontamination,
    "op5_rendezvous": op5_rendezvous,
    "op6_bwt_dedup": op6_bwt_dedup,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_unit_dedup": op8_unit_dedup,
    "op9_quality": op9_quality,
    "op10_pack": op10_pack,
    "op11_collocations": op11_collocations,
    "op12_hyperdimensional_language": op12_hyperdimensional_language,
    "op13_conversation_trie": op13_conversation_trie,
}

UNIT_DEDUP_SQL = r"""
with cut as (
  select doc_id, regexp_extract_all(text, '[^.!?\n]*[.!?\n][.!? \t\r\n]*|[^.!?\n]+') as us from documents
), units as (
  select doc_id, unnest(us) as u, generate_subscripts(us, 1) as i from cut
), normal as (
  select *, trim(regexp_replace(lower(u), '[^\p{L}\p{N}]+', ' ', 'g')) as n,
    sum(length(u)) over (partition by doc_id order by i) as e
  from units
), counted as (
  select *, case when n = '' then 0 else length(n) - length(replace(n, ' ', '')) + 1 end as w from normal
), worded as (
  select doc_id, i, case
    when w >= 5 then n
    when w + lag(w) over p >= 5 then lag(n) over p || '|' || n
    when w + lag(w) over p + lag(w, 2) over p >= 5 then lag(n, 2) over p || '|' || lag(n) over p || '|' || n
    when w + lag(w) over p + lag(w, 2) over p + lag(w, 3) over p >= 5 then lag(n, 3) over p || '|' || lag(n, 2) over p || '|' || lag(n) over p || '|' || n
    else lag(n, 4) over p || '|' || lag(n, 3) over p || '|' || lag(n, 2) over p || '|' || lag(n) over p || '|' || n
  end as k
  from counted where w > 0 window p as (partition by doc_id order by i)
), keyed as (
  select c.*, d.k from counted c left join worded d using (doc_id, i)
), ranked as (
  select *, k is not null and row_number() over (partition by k order by doc_id, i) > 1 as gone from keyed
), summed as (
  select doc_id, count(*) as n_units, count(*) filter (where gone) as n_removed_units,
    coalesce(string_agg(u, '' order by i) filter (where not gone), '') as kept,
    coalesce(string_agg((e - length(u))::bigint || '-' || e::bigint, ',' order by i) filter (where gone), '') as removed_spans
  from ranked group by doc_id
)
select d.doc_id, case when d.text is null then null else coalesce(s.kept, '') end as text,
  coalesce(s.n_units, 0)::bigint as n_units, coalesce(s.n_removed_units, 0)::bigint as n_removed_units,
  coalesce(s.removed_spans, '') as removed_spans
from documents d left join summed s using (doc_id)
"""

COLLOCATIONS_SQL = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, doc_id, generate_subscripts(p, 1) as i, unnest(p) as piece
  from (select lang, doc_id, regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') as p from documents)
), split as (
  select lang, doc_id, i, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces
), w as (
  select lang, doc_id, i, generate_subscripts(ws, 1) as j, unnest(ws) as x from split
), follow as (
  select lang, x, lead(x) over p as y, lead(x, 2) over p as z from w window p as (partition by lang, doc_id, i order by j)
), f1 as (
  select lang, x, count(*) as n from follow group by all
), f2 as (
  select lang, x, y, count(*) as n from follow where y is not null group by all
), f3 as (
  select lang, x, y, z, count(*) as n from follow where z is not null group by all having count(*) >= 10
), totals as (
  select lang, sum(n)::bigint as n from f1 group by lang
), cuts as (
  select p.lang, p.x || ' ' || p.y as phrase, p.n as a, 1 as k, l.n as l, r.n as r
  from f2 p join f1 l on l.lang = p.lang and l.x = p.x join f1 r on r.lang = p.lang and r.x = p.y
  where p.n >= 10 and not exists (
    select 1 from f3 t where t.lang = p.lang and 100 * t.n >= 50 * p.n and ((t.x = p.x and t.y = p.y) or (t.y = p.x and t.z = p.y)))
  union all
  select p.lang, p.x || ' ' || p.y || ' ' || p.z, p.n, 1, l.n, r.n
  from f3 p join f1 l on l.lang = p.lang and l.x = p.x join f2 r on r.lang = p.lang and r.x = p.y and r.y = p.z
  union all
  select p.lang, p.x || ' ' || p.y || ' ' || p.z, p.n, 2, l.n, r.n
  from f3 p join f2 l on l.lang = p.lang and l.x = p.x and l.y = p.y join f1 r on r.lang = p.lang and r.x = p.z
), scored as (
  select *, ((1000000::hugeint * a * a) // (l::hugeint * r))::bigint as score from cuts
), lowest as (
  select * from scored qualify row_number() over (partition by lang, phrase order by score, k) = 1
), ranked as (
  select *, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank from lowest
)
select k.lang, k.rank, k.phrase, k.a, k.l, k.r, t.n, k.score from ranked k join totals t on t.lang = k.lang where k.rank <= 2000
"""

CONVERSATION_TRIE_SQL = r"""
with t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null
), o as (
  select conv_id, turn, md5(length(role) || ':' || role || text) as g, len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as w from t
), placed as (
  select conv_id, g, w, row_number() over (partition by conv_id order by turn nulls first, g) - 1 as pos from o
), c as (
  select conv_id, conv_id - conv_id % 20 as source,
    xor(list_reduce(
      [4294967295::ubigint] || flatten([[(ascii(x) >> b)::ubigint & 1 for b in range(8)] for x in string_split(conv_id::varchar, '')]),
      lambda crc, bit: xor(crc >> 1, 3988292384::ubigint * (xor(crc, bit) & 1))
    ), 4294967295::ubigint) % 4 as h
  from (select distinct conv_id from t)
), r as (
  select c.conv_id, 0 as part, pos, g, w from c join placed p on p.conv_id = c.source where pos < h
  union all
  select c.conv_id, 1, pos, g, w from c join placed p on p.conv_id = c.conv_id where pos >= h
), d as (
  select conv_id, g, w, row_number() over (partition by conv_id order by part, pos) as depth from r
), path as (
  select conv_id, depth, w, md5(string_agg(g, '') over (partition by conv_id order by depth)) as node from d
), whole as (
  select conv_id, 0 as depth, 0 as w, 'root' as node, null as parent from c
  union all
  select conv_id, depth, w, node, coalesce(lag(node) over (partition by conv_id order by depth), 'root') from path
), nodes as (
  select node, depth, any_value(parent) as parent, min(conv_id) as conv_id, count(*) as n_convs, any_value(w) as w from whole group by node, depth
), children as (
  select parent, count(*) as n from nodes where parent is not null group by parent
), counted as (
  select n.*, coalesce(k.n, 0) as n_children from nodes n left join children k on k.parent = n.node
), subtree as (
  select a.node, sum((n.n_children = 0)::bigint) as n_leaves, sum((n.n_convs - 1) * n.w) as saved_tokens
  from counted n join whole a on a.conv_id = n.conv_id and a.depth <= n.depth group by a.node
), ended as (
  select node, string_agg(conv_id::varchar, ',' order by conv_id) as ids
  from (select conv_id, arg_max(node, depth) as node from whole group by conv_id) group by node
)
select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, n.n_children::bigint as n_children,
  s.n_leaves::bigint as n_leaves, s.saved_tokens::bigint as saved_tokens, sha256(coalesce(e.ids, '')) as ends_sha256
from counted n join subtree s on s.node = n.node left join nodes p on p.node = n.parent left join ended e on e.node = n.node
"""

ORACLES: dict[str, str] = {
    "op8_unit_dedup": UNIT_DEDUP_SQL,
    "op11_collocations": COLLOCATIONS_SQL,
    "op13_conversation_trie": CONVERSATION_TRIE_SQL,
}
