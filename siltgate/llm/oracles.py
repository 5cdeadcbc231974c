"""The SQL of queries that need more than a few lines of it."""

from __future__ import annotations


def _vector_codes(parts: int = 8, entries: int = 16, rounds: int = 6, scale: int = 4096) -> str:
    steps = [
        f"""
kept as materialized (
  select vec_id, label, list_transform(embedding, lambda x: cast(floor(cast(x as double) * {scale}) as bigint)) as v,
    row_number() over (order by vec_id nulls last) as rn, len(embedding) // {parts} as w
  from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), cut as materialized (
  select rn, vec_id, label, w, p, list_slice(v, p * w + 1, p * w + w) as part from kept, range({parts}) as t(p)
), book0 as materialized (
  select p, rn - 1 as k, part from cut where rn <= {entries}
)"""
    ]
    distance = "list_sum(list_transform(range(1, c.w + 1), lambda i: (c.part[i] - b.part[i]) * (c.part[i] - b.part[i])))"
    for r in range(rounds + 1):
        steps.append(
            f"""near{r} as materialized (
  select c.rn, c.p, min({{'d': coalesce({distance}, 0), 'k': b.k}}) as best from cut c join book{r} b on b.p = c.p group by c.rn, c.p
)"""
        )
        if r < rounds:
            steps.append(
                f"""sums{r} as materialized (
  select p, k, i, sum(x) as s, count(*) as n
  from (select c.p, m.best.k as k, unnest(range(1, c.w + 1)) as i, unnest(c.part) as x from cut c join near{r} m on m.rn = c.rn and m.p = c.p)
  group by p, k, i
), book{r + 1} as materialized (
  select b.p, b.k, coalesce(m.part, b.part) as part
  from book{r} b left join (
    select p, k, list(cast((s - ((s % n) + n) % n) // n as bigint) order by i) as part from sums{r} group by p, k
  ) m on m.p = b.p and m.k = b.k
)"""
            )
    return f"""
with {", ".join(steps)},
codes as materialized (
  select rn, string_agg(lpad(printf('%x', best.k), 2, '0'), '' order by p) as code, cast(sum(best.d) as bigint) as error
  from near{rounds} group by rn
), digest as (
  select sha256(string_agg(array_to_string(part, ','), ',' order by p, k)) as codebooks_sha256 from book{rounds}
)
select v.vec_id, c.code, c.error, cast(sum(c.error) over (partition by v.label) as bigint) as label_error, d.codebooks_sha256
from kept v join codes c on c.rn = v.rn cross join digest d
"""


VECTOR_CODES = _vector_codes()

# Fixed value: the polynomial of the common 32-bit cyclic redundancy check.
CRC_POLYNOMIAL = 3988292384

_CRC32 = f"""xor(4294967295, list_reduce(
  list_concat([4294967295::bigint], list_transform(string_split(cast(doc_id as varchar), ''), lambda c: cast(ascii(c) as bigint))),
  lambda done, byte: list_reduce([xor(done, byte), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, bit: xor(x >> 1, (x & 1) * {CRC_POLYNOMIAL}))))"""

# Two places where six words are alike, and how far such places follow one another.
PERIODIC_RUNS = f"""
with texts as (
  select row_number() over () as d, doc_id, case when doc_id is null then 1 else {_CRC32} end as h,
    coalesce(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+'), []) as words
  from documents
), shapes as (
  select *, len(words) as n, h // 10 as g, case when h % 10 = 0 and len(words) > 0 then (h // 10) % len(words) end as a from texts
), changed as materialized (
  select d, doc_id, n, case when a is null then words else
      list_transform(range(0, n), lambda i: words[1 + case when i < a then i else a + (i - a) % (1 + (n - a) // (3 + g % 8)) end]) end as words
  from shapes
), flat as materialized (
  select d, unnest(range(0, n)) as i, unnest(words) as w from changed
), grams as materialized (
  select d, i, w, lag(w) over o as before,
    case when lead(w, 5) over o is not null then
      concat_ws(' ', w, lead(w, 1) over o, lead(w, 2) over o, lead(w, 3) over o, lead(w, 4) over o, lead(w, 5) over o) end as gram
  from flat window o as (partition by d order by i)
), pairs as (
  select x.d, x.i, y.i - x.i as q from grams x join grams y on x.d = y.d and x.gram = y.gram and y.i > x.i
), islands as (
  select d, q, i - row_number() over (partition by d, q order by i) as island, i from pairs
), stretches as (
  select d, q, min(i) as s, count(*) + 5 + q as len from islands group by d, q, island
), runs as materialized (
  select d, s, len, min(q) as q from stretches where len >= 12 and len >= 2 * q group by d, s, len
), dropped as (
  select distinct d, unnest(range(s + q, s + len)) as i from runs
), rests as (
  select f.d, string_agg(f.w, ' ' order by f.i) as rest from flat f anti join dropped x on x.d = f.d and x.i = f.i group by f.d
), best as (
  select d, max({{'l': len, 's': -s, 'q': -q}}) as top, count(*) as n_runs,
    string_agg(s || ',' || len || ',' || q || chr(10), '' order by s, q) as lines
  from runs group by d
)
select t.doc_id, coalesce(b.n_runs, 0) as n_runs, -b.top.s as start, b.top.l as length, -b.top.q as period,
  1000 * b.top.l // -b.top.q as exponent_milli, sha256(coalesce(b.lines, '')) as runs_sha256, sha256(coalesce(r.rest, '')) as collapsed_sha256
from changed t left join best b on b.d = t.d left join rests r on r.d = t.d
"""
