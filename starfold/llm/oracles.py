"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from functools import reduce

# Checksums of the numbers below 16, by which a CRC-32 takes half a byte at a time.
_HALF_BYTES = [reduce(lambda c, _: c >> 1 ^ 0xEDB88320 * (c & 1), range(4), i) for i in range(16)]

# Every pair of vectors of one label; links are followed from each vector until no new one is reached.
_NEAR_VECTORS = """
with recursive rows as materialized (
  select vec_id, label, [x::double for x in embedding] v from embeddings
), able as materialized (
  select * from rows where label is not null and v is not null and len(v) > 0
    and len([x for x in v if x is null or not isfinite(x)]) = 0 and len([x for x in v if x <> 0]) > 0
), links as materialized (
  select a.vec_id, b.vec_id other from able a join able b
    on a.label = b.label and len(a.v) = len(b.v) and a.vec_id <> b.vec_id
  where list_dot_product(a.v, b.v) / (sqrt(list_dot_product(a.v, a.v)) * sqrt(list_dot_product(b.v, b.v))) >= 0.98
), reach as (
  select vec_id, vec_id reached from rows
  union select reach.vec_id, links.other from reach join links on links.vec_id = reach.reached
), least as (select vec_id, min(reached) component_id from reach group by vec_id
), counted as (select vec_id, count(*) n from links group by vec_id)
select vec_id, coalesce(n, 0) n_links, component_id, vec_id = component_id kept
from rows join least using (vec_id) left join counted using (vec_id)"""

# The checksum of each distinct word run, half byte by half byte, the lower half first.
_RESAMPLED = f"""
with texts as materialized (
  select 's' side, doc_id, row_number() over () place, text from documents
  union all select 't', null, row_number() over (), text from benchmark
), worded as materialized (
  select side, doc_id, place, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') words
  from texts
), placed as (select side, place, unnest(words) word, unnest(range(1, len(words) + 1)) pos from worded
), nexts as (
  select side, place, word, lead(word) over later word2, lead(word, 2) over later word3
  from placed window later as (partition by side, place order by pos)
), runs as (
  select side, place, word run from nexts
  union all select side, place, word || ' ' || word2 from nexts where word2 is not null
  union all select side, place, word || ' ' || word2 || ' ' || word3 from nexts where word3 is not null
), features as (select run, hex(run) digits from (select distinct run from runs)
), sums as (
  select run, xor(list_reduce(
    list_prepend(4294967295, list_transform(
      range(1, len(digits) + 1), lambda i: instr('123456789ABCDEF', digits[i - 1 + 2 * (i % 2)]))),
    lambda c, b: xor(c >> 4, {_HALF_BYTES}[1 + (xor(c, b) & 15)])), 4294967295) % 10000 bucket
  from features
), hits as (select side, place, bucket from runs join sums using (run)
), totals as (
  select bucket, count(*) filter (side = 's') s, count(*) filter (side = 't') t from hits group by bucket
), whole as (select sum(s)::double s_all, sum(t)::double t_all from totals
), gains as (
  select bucket, floor(1000 * ln((t + 1)::double * (s_all + 10000) / ((s + 1)::double * (t_all + 10000))))::bigint gain
  from totals, whole
), weights as (
  select place, count(*) n_features, sum(gain)::bigint weight from hits join gains using (bucket)
  where side = 's' group by place
), scored as (
  select doc_id, place, len(words) n_words, coalesce(n_features, 0) n_features, coalesce(weight, 0) weight,
    coalesce(weight, 0) + floor(-1000 * ln(-ln(
      (('0x' || sha256('42:' || coalesce(doc_id::varchar, ''))[1:8])::bigint + 0.5::double) / 4294967296)))::bigint score
  from worded left join weights using (place) where side = 's'
), ranked as (
  select place, row_number() over (order by score desc, doc_id nulls last, place) nth from scored where n_words >= 20
)
select doc_id, n_features, weight, score,
  case when nth <= (select 5 * count(*) // 100 from ranked) then nth end rank
from scored left join ranked using (place)"""

ORACLES: dict[str, str] = {
    "op11_cap_filters": _NEAR_VECTORS,
    "op12_importance_resample": _RESAMPLED,
}
