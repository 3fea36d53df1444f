"""Registered queries of this subpackage: name to query, and to SQL where SQL expresses it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starloom.llm import alignment, jaccard, langid, mixing, packing, preferences, pseudolm, quality, records, substrings, toxicity, variants, vectors
from starloom.llm.tables import table
from starloom.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(build):
        QUERIES[name] = build
        if sql:
            SQL[name] = sql
        return build

    return register


SUBSTRINGS_SQL = r"""
with w as (
  select doc_id, unnest(words) as word, generate_subscripts(words, 1) as pos
  from (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents)
), win as (
  select doc_id, pos, md5(string_agg(word, ' ') over (partition by doc_id order by pos rows between current row and 49 following)) as h,
    count(*) over (partition by doc_id order by pos rows between current row and 49 following) as n
  from w
), hit as (
  select doc_id, pos from (select doc_id, pos, min(doc_id) over (partition by h) as m from win where n = 50) where m < doc_id
), mark as (
  select w.doc_id, w.word, w.pos,
    max(h.pos) over (partition by w.doc_id order by w.pos rows between 49 preceding and current row) is not null as gone
  from w left join hit h on h.doc_id = w.doc_id and h.pos = w.pos
), agg as (
  select doc_id, count(*) as n_words, count(*) filter (where gone) as n_removed,
    coalesce(string_agg(word, ' ' order by pos) filter (where not gone), '') as kept
  from mark group by doc_id
)
select d.doc_id, cast(coalesce(n_words, 0) as bigint) as n_words, cast(coalesce(n_removed, 0) as bigint) as n_removed,
  sha256(coalesce(kept, '')) as kept_sha256
from documents d left join agg a on a.doc_id = d.doc_id
"""


@_query("op9_substring_dedup", SUBSTRINGS_SQL)
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return substrings.removal_report(table(spark, folder, "documents"))


JACCARD_SQL = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as words from documents
), s as (
  select distinct doc_id, case when len(words) < 5 then array_to_string(words, ' ') else array_to_string(words[i:i + 4], ' ') end as shingle
  from (select doc_id, words, unnest(range(1, greatest(len(words) - 4, least(len(words), 1)) + 1)) as i from w)
), n as (select doc_id, count(*) as n from s group by doc_id),
links as (
  select p.a, p.b from (select x.doc_id as a, y.doc_id as b, count(*) as c from s x join s y on x.shingle = y.shingle and x.doc_id <> y.doc_id group by all) p
  join n na on na.doc_id = p.a join n nb on nb.doc_id = p.b where 100 * c >= 80 * (na.n + nb.n - c)
), reach as (
  select a as doc_id, a as other from links union select r.doc_id, l.b from reach r join links l on l.a = r.other
), top as (select doc_id, min(other) as component_id from reach group by doc_id)
select d.doc_id, cast(coalesce(n.n, 0) as bigint) as n_shingles, coalesce(top.component_id, d.doc_id) as component_id
from documents d left join n on n.doc_id = d.doc_id left join top on top.doc_id = d.doc_id
"""


@_query("op7_ngram_jaccard_join", JACCARD_SQL)
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.near_duplicates(table(spark, folder, "documents"))


@_query("op3_packing")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents"))


MIXING_SQL = r"""
with d as (
  select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size from documents
), s as (select source, sum(size)::bigint as source_size from d group by source),
t as (select *, row_number() over (order by source is null, source) - 1 as turn from s),
w as (select *, [5, 2, 1][turn % 3 + 1] as weight, [-0.5, 0.0, 0.5][turn % 3 + 1]::double as drift, 3 * source_size as lim from t),
f as (
  select *, sum(source_size) over () as total,
    (sum(source_size) over () - coalesce(sum(lim) over (order by lim / weight, turn rows between unbounded preceding and 1 preceding), 0)) * weight
      >= lim * sum(weight) over (order by lim / weight, turn rows between current row and unbounded following) as is_full
  from w
), g as (
  select *, coalesce(sum(lim) filter (where is_full) over (), 0) as spent, coalesce(sum(weight) filter (where not is_full) over (), 0) as open_weight from f
), goal as (
  select source, source_size, drift,
    case when is_full then lim::double else ((total - spent) * weight)::double / open_weight::double end as target from g
), line as (
  select d.*, goal.source_size, goal.target, goal.drift,
    sum(size) over (partition by d.source order by md5(doc_id::varchar), doc_id rows between unbounded preceding and current row) - size as start
  from d join goal on d.source is not distinct from goal.source
), c as (
  select *, case when size > 0 then (2 * start + size <= 2 * target)::int + (2 * (start + source_size) + size <= 2 * target)::int
    + (2 * (start + 2 * source_size) + size <= 2 * target)::int else 0 end as copies,
    least((start::double + size::double / 2) / target, 1.0) as u from line
)
select doc_id, size, source_size, target, cast(copies * size as bigint) as taken,
  case when copies > 0 then 2 * u / ((1 - drift) + sqrt((1 - drift) * (1 - drift) + 4 * drift * u)) end as first_position
from c
"""


@_query("op8_mixing", MIXING_SQL)
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_plan(table(spark, folder, "documents"))


@_query("op4_language_id")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = langid.predict(docs, langid.train(docs))
    return found.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


QUALITY_SQL = r"""
with d as (
  select row_number() over () as rid, doc_id, lang, source, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) as lines
  from documents
), t as (
  select rid, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] as w from (select rid, words, unnest(range(1, len(words) - 1)) as i from d)
), r as (select rid, i from (select rid, i, count(*) over (partition by rid, w) as c from t) where c > 1),
rep as (select rid, count(distinct i + k) as n_repeat_words from r, unnest([0, 1, 2]) as u(k) group by rid),
m as (
  select d.rid, doc_id, lang, source, len(words)::bigint as n_words, length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g'))::bigint as n_symbols, length(regexp_replace(text, '[^A-Z]+', '', 'g'))::bigint as n_capitals,
    len(lines)::bigint as n_lines, (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n_repeat_words, 0)::bigint as n_repeat_words
  from d left join rep on rep.rid = d.rid
), x as (
  select *, word_chars * 100 // greatest(n_words, 1) as word_length, n_symbols * 1000 // greatest(n_words, 1) as symbols,
    n_dup_lines * 1000 // greatest(n_lines, 1) as dup_lines, n_repeat_words * 1000 // greatest(n_words, 1) as repeats,
    n_capitals * 1000 // greatest(word_chars, 1) as capitals, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed
  from m
), long as (
  select lang, source, rate, (v >> e) << e as cell from (
    select lang, source, rate, v, greatest(length(bin(v)) - 6, 0)::bigint as e from (
      unpivot (select lang, source, base_failed, word_length, symbols, dup_lines, repeats, capitals from x) on word_length, symbols, dup_lines, repeats, capitals into name rate value v)
    where not base_failed)
), own as (
  select lang, source, rate, count(*) as n, quantile_disc(cell, 0.1) as q10, quantile_disc(cell, 0.5) as q50, quantile_disc(cell, 0.9) as q90 from long group by all
), tongue as (
  select lang, rate, count(*) as n, quantile_disc(cell, 0.1) as q10, quantile_disc(cell, 0.5) as q50, quantile_disc(cell, 0.9) as q90 from long group by all
), every as (
  select rate, count(*) as n, quantile_disc(cell, 0.1) as q10, quantile_disc(cell, 0.5) as q50, quantile_disc(cell, 0.9) as q90 from long group by all
), pick as (
  select o.lang, o.source, o.rate, case o.rate when 'word_length' then 100 when 'capitals' then 100 else 150 end as slack,
    case when o.n >= 100 then o.q10 when t.n >= 100 then t.q10 else e.q10 end as q10,
    case when o.n >= 100 then o.q50 when t.n >= 100 then t.q50 else e.q50 end as q50,
    case when o.n >= 100 then o.q90 when t.n >= 100 then t.q90 else e.q90 end as q90
  from own o join tongue t on o.lang is not distinct from t.lang and o.rate = t.rate join every e on e.rate = o.rate
), fence as (
  select lang, source, rate, q50 + greatest(4 * (q90 - q50), slack) as high, case when rate = 'word_length' then q50 - greatest(4 * (q50 - q10), slack) else -1 end as low from pick
), verdict as (
  select u.rid, bool_and(u.v between f.low and f.high) as inside
  from (unpivot (select rid, lang, source, word_length, symbols, dup_lines, repeats, capitals from x) on word_length, symbols, dup_lines, repeats, capitals into name rate value v) u
  join fence f on f.lang is not distinct from u.lang and f.source is not distinct from u.source and f.rate = u.rate group by u.rid
)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and coalesce(inside, false) as kept
from x left join verdict v on v.rid = x.rid
"""


@_query("op2_quality_rules", QUALITY_SQL)
def op2(spark: SparkSession, folder: str) -> DataFrame:
    rows = quality.judged(table(spark, folder, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@_query("op10_toxicity")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    found = toxicity.score(docs, toxicity.train(docs, table(spark, folder, "labels")))
    return found.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


VECTORS_SQL = r"""
with recursive v as (
  select vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) as norm from (select vec_id, cast(embedding as double[]) as e from embeddings)
  where vec_id is not null and len(e) > 0 and len(list_filter(e, lambda x: x is null or not isfinite(x))) = 0
), u as (select * from v where norm > 0),
links as (
  select x.vec_id as a, y.vec_id as b from u x join u y on x.vec_id <> y.vec_id and len(x.e) = len(y.e) where list_dot_product(x.e, y.e) / (x.norm * y.norm) >= 0.95
), reach as (select a as vec_id, a as other from links union select r.vec_id, l.b from reach r join links l on l.a = r.other),
top as (select vec_id, min(other) as component_id from reach group by vec_id),
n as (select a as vec_id, count(*) as n_links from links group by a)
select e.vec_id, coalesce(n.n_links, 0)::bigint as n_links, coalesce(top.component_id, e.vec_id) as component_id, e.vec_id = coalesce(top.component_id, e.vec_id) as kept
from embeddings e left join n on n.vec_id = e.vec_id left join top on top.vec_id = e.vec_id
"""


@_query("op5_embedding_near_dedup", VECTORS_SQL)
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return vectors.near_vectors(table(spark, folder, "embeddings"))


@_query("op6_lm_scoring")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    return pseudolm.score(docs, pseudolm.train(docs))


def _crc_table() -> list[int]:
    table = list(range(256))
    for _ in range(8):
        table = [v >> 1 ^ (0xEDB88320 if v & 1 else 0) for v in table]
    return table


#: The checksum that Spark's crc32 gives, over the bytes of a text column.
_CRC = """xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(hex(encode({0}))), 2),
    lambda i: (instr('0123456789ABCDEF', hex(encode({0}))[i]) - 1) * 16 + instr('0123456789ABCDEF', hex(encode({0}))[i + 1]) - 1)),
    lambda v, x: xor(v >> 8, ({1}::bigint[])[xor(v & 255, x) + 1])), 4294967295)"""

PREFERENCES_SQL = rf"""
with t as (
  select conv_id, row_number() over (partition by conv_id order by turn nulls last, coalesce(role, ''), coalesce(text, '')) as i,
    coalesce(role, '') as role, coalesce(text, '') as text
  from conversations
), c as (
  select *, count(*) filter (where role = 'assistant') over (partition by conv_id order by i) - (role = 'assistant')::int as seen from t
), n as (select conv_id, count(*) as turns, count(*) filter (where role = 'assistant') as replies from c group by conv_id),
place as (
  select *, coalesce(lead(place) over (order by place), 1) as next from (select *, row_number() over (order by conv_id nulls last) as place from n)
), met as (
  select a.*, b.conv_id as other_id, b.replies as other_replies,
    case when a.replies > 0 and b.replies > 0 then {_CRC.format("coalesce(a.conv_id::varchar, '')", _crc_table())} % nullif(a.replies, 0) end as since
  from place a join place b on b.place = a.next
), rows as (
  select c.*, m.turns, case when c.role = 'assistant' and c.seen >= m.since then o.text else c.text end as other_text
  from c join met m on m.conv_id is not distinct from c.conv_id
  left join c o on o.conv_id is not distinct from m.other_id and o.role = 'assistant' and c.role = 'assistant' and o.seen = c.seen % nullif(m.other_replies, 0)
), prefix as (select conv_id, coalesce(min(case when text <> other_text then i end), max(turns) + 1) - 1 as p from rows group by conv_id),
r as (
  select rows.conv_id, i, p, role, '<|' || role || '|>' || chr(10) as head, text || chr(10) || '<|end|>' || chr(10) as body, other_text || chr(10) || '<|end|>' || chr(10) as other_body
  from rows join prefix on prefix.conv_id is not distinct from rows.conv_id
), s as (
  select *, sum(case when i > p then length(head) + length(body) else 0 end) over w - length(body) as begin_at, sum(case when i > p then length(head) + length(other_body) else 0 end) over w - length(other_body) as other_at
  from r window w as (partition by conv_id order by i)
)
select conv_id as pair_id, max(p)::bigint as prefix_turns, md5(coalesce(string_agg(head || body, '' order by i) filter (where i <= p), '')) as prompt_md5,
  md5(coalesce(string_agg(head || body, '' order by i) filter (where i > p), '')) as chosen_md5,
  md5(coalesce(string_agg(head || other_body, '' order by i) filter (where i > p), '')) as rejected_md5,
  coalesce(string_agg(begin_at || '+' || length(body), ',' order by i) filter (where i > p and role = 'assistant'), '') as chosen_loss,
  coalesce(string_agg(other_at || '+' || length(other_body), ',' order by i) filter (where i > p and role = 'assistant'), '') as rejected_loss
from s group by conv_id
"""


@_query("op1_preference_formatting", PREFERENCES_SQL)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    rows = preferences.format_preferences(preferences.swapped_pairs(table(spark, folder, "conversations")))
    spans = lambda side: F.concat_ws(",", F.transform(f"{side}_loss", lambda s: F.concat_ws("+", s["start"], s["length"]))).alias(f"{side}_loss")
    return rows.select("pair_id", "prefix_turns", *[F.md5(c).alias(f"{c}_md5") for c in ("prompt", "chosen", "rejected")], spans("chosen"), spans("rejected"))


@_query("op13_token_records")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    path = scratch_path(spark, "llm-records")
    records.write_records(table(spark, folder, "documents"), path)
    return records.record_report(spark, path)


@_query("op11_token_alignment")
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return alignment.align(table(spark, folder, "documents"))


VARIANTS_SQL = rf"""
with recursive runs as (
  select coalesce(doc_id::varchar, '') as id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) as run
  from documents
), each as (select id, run, count(*) as times from runs where length(run) >= 7 group by all),
hexed as (select *, hex(encode(id || ':' || run)) as h from each),
bytes as (select *, list_transform(range(1, length(h), 2), lambda i: (instr('0123456789ABCDEF', h[i]) - 1) * 16 + instr('0123456789ABCDEF', h[i + 1]) - 1) as b from hexed),
summed as (
  select run, times, xor(list_reduce(list_prepend(4294967295, b), lambda v, x: xor(v >> 8, ({_crc_table()}::bigint[])[xor(v & 255, x) + 1])), 4294967295) as crc from bytes
), words as (
  select word, sum(times)::bigint as n from (
    select times, case when crc % 31 = 0 then substr(run, 1, crc % length(run)) || substr(run, crc % length(run) + 2) else run end as word from summed)
  where length(word) >= 7 group by word having sum(times) >= 2
), short as (
  select word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) as cut from (select word, n, unnest(range(1, length(word) + 1)) as i from words)
), near as (
  select x.word, y.word as other, y.n from short x join short y on x.i = y.i and x.cut = y.cut and x.word <> y.word
  union select x.word, y.word, y.n from short x join words y on x.cut = y.word
  union select y.word, x.word, x.n from short x join words y on x.cut = y.word
), best as (select word, count(*) as n_near, arg_min(other, (-n, other)) as other, max(n) as top from near group by word),
found as (
  select words.word, words.n, coalesce(n_near, 0) as n_near, case when top >= 10 * words.n then other end as form, case when top >= 10 * words.n then top end as form_n
  from words left join best on best.word = words.word
), way as (
  select word, word as root from found union all select way.word, found.form from way join found on found.word = way.root where found.form is not null
), ends as (select way.word, way.root from way join found on found.word = way.root where found.form is null)
select found.word, form, root, n, n_near::bigint as n_near, form_n from found join ends on ends.word = found.word
"""


@_query("op12_spelling_variants", VARIANTS_SQL)
def op12(spark: SparkSession, folder: str) -> DataFrame:
    return variants.spelling_variants(table(spark, folder, "documents")).select("word", "form", "root", "n", "n_near", "form_n")
