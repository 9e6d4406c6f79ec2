"""DuckDB SQL for the queries of this subpackage that SQL can express."""

from __future__ import annotations

from . import licenses

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_ASCII_LOWER = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"

OP1 = r"""with d as (select doc_id, case when source is null then '1' else '0' || source end as src, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
    md5(coalesce(cast(doc_id as varchar), '')) as h from documents),
  s as (select src, cast(sum(size) as bigint) as source_size, row_number() over (order by src) - 1 as place from d group by src),
  w as (select *, [5, 2, 1][place % 3 + 1] as weight, source_size * [2, 5, 10][place % 3 + 1] as fill, source_size * 3 as cap from s),
  f as (select *, (select sum(source_size) from w) - coalesce(sum(cap) over o, 0) as rest, (select sum(weight) from w) - coalesce(sum(weight) over o, 0) as over_weight
    from w window o as (order by fill, src rows between unbounded preceding and 1 preceding)),
  l as (select *, rest * weight > cap * over_weight as capped from f),
  c as (select src, source_size, case when capped then cast(cap as double) else (select max(cast(rest as double) / over_weight) from l where not capped) * weight end as target from l),
  t as (select *, cast(floor(target + 0.5) as bigint) as take, cast(coalesce(sum(cast(floor(target + 0.5) as bigint)) over (order by src rows between unbounded preceding and 1 preceding), 0) as bigint) as share_at from c),
  n as (select cast(sum(take) as bigint) as total, (cast(sum(take) as bigint) + 127) // 128 as slots from t),
  i as (select unnest(range(slots)) as slot, total from n),
  x as (select slot, cast(floor((slot % 2147483648 * 1327217885 % 2147483648 + (slot // 2147483648 * 1327217885 % 2147483648 + 0.5::double) / 2147483648::double) / 2147483648::double * total) as bigint) as pos from i),
  y as (select slot, src from x join t on pos >= share_at and pos < share_at + take),
  z as (select slot, src, row_number() over (partition by src order by slot) - 1 as rank from (select * from y union all select (select slots from n) + share_at, src from t where take > 0 and src not in (select src from y)) u),
  a as (select d.*, t.source_size, t.target, t.take, cast(sum(size) over (partition by src order by h, doc_id nulls first, size rows unbounded preceding) - size as bigint) as starts from d join t using (src)),
  k as (select src, starts, starts + p * source_size as lo, least(starts + p * source_size + size, take) as hi from a, range(3) r(p) where size > 0 and starts + p * source_size < take),
  g as (select src, starts, lo, hi, unnest(range(lo // 128, (hi - 1) // 128 + 1)) as rank from k),
  q as (select src, starts, sum(least(hi, (rank + 1) * 128) - greatest(lo, rank * 128)) as taken, count(*) as slots, min(slot) as first_slot from g join z using (src, rank) group by 1, 2)
select doc_id, size, a.source_size, round(target, 6) as target, cast(coalesce(q.taken, 0) as bigint) as taken, coalesce(q.slots, 0) as slots, q.first_slot from a left join q on q.src = a.src and q.starts = a.starts and a.size > 0"""

OP3 = r"""with o as (select doc_id, coalesce(text, '') as t, coalesce(lead(coalesce(text, '')) over w, first_value(coalesce(text, '')) over w) as n from documents window w as (order by doc_id desc rows between unbounded preceding and unbounded following)),
  e as (select *, left(t, length(t) - length(t) // 2) || left(n, length(t) // 2) as u from o),
  v as (select *, list_transform(string_split(t, chr(10)), lambda x: list_transform(regexp_extract_all(x, '[^\n.]{0,48}\.|[^\n.]{1,48}'), lambda y: sha256(y))) as la, list_transform(string_split(u, chr(10)), lambda x: list_transform(regexp_extract_all(x, '[^\n.]{0,48}\.|[^\n.]{1,48}'), lambda y: sha256(y))) as lb,
    list_transform(string_split(n, chr(10)), lambda x: list_transform(regexp_extract_all(x, '[^\n.]{0,48}\.|[^\n.]{1,48}'), lambda y: sha256(y))) as lc from e),
  p as (select *, list_transform(la, lambda x: sha256('P' || array_to_string(x, ''))) as pa, list_transform(lb, lambda x: sha256('P' || array_to_string(x, ''))) as pb, list_transform(lc, lambda x: sha256('P' || array_to_string(x, ''))) as pc,
    list_distinct(flatten(la)) as a, list_distinct(flatten(lb)) as b, list_distinct(flatten(lc)) as c from v),
  s as (select *, list_transform(range((len(pa) + 7) // 8), lambda i: sha256('S' || array_to_string(pa[i * 8 + 1 : i * 8 + 8], ''))) as sa, list_transform(range((len(pb) + 7) // 8), lambda i: sha256('S' || array_to_string(pb[i * 8 + 1 : i * 8 + 8], ''))) as sb,
    list_transform(range((len(pc) + 7) // 8), lambda i: sha256('S' || array_to_string(pc[i * 8 + 1 : i * 8 + 8], ''))) as sc, len(list_intersect(a, b)) as ab, len(list_intersect(a, c)) as ac from p),
  r as (select *, sha256('R' || array_to_string(sa, '')) as ra, sha256('R' || array_to_string(sb, '')) as rb, sha256('R' || array_to_string(sc, '')) as rc from s)
select doc_id, cast(length(t) as bigint) as n_chars, sha256(u) as edited_sha256, ra as fingerprint, rb as edited_fingerprint,
  case when len(a) + len(b) - ab > 0 then round(ab / cast(len(a) + len(b) - ab as double), 9) else cast(ra = rb as int) end as near_edited,
  case when len(a) + len(c) - ac > 0 then round(ac / cast(len(a) + len(c) - ac as double), 9) else cast(ra = rc as int) end as near_next,
  cast(len(sa) as bigint) as n_sections, cast(len(pa) as bigint) as n_paragraphs,
  list_filter(range(greatest(len(sa), len(sb))), lambda i: sa[i + 1] is distinct from sb[i + 1])[1] as changed_section,
  list_filter(range(greatest(len(pa), len(pb))), lambda i: pa[i + 1] is distinct from pb[i + 1])[1] as changed_paragraph from r"""

OP4 = (
    r"""with recursive w as (select doc_id, regexp_extract_all("""
    + _ASCII_LOWER
    + r""", '[^\x20\x09-\x0D]+') as ws from documents),
  s as (select doc_id, case when len(ws) = 0 then []::varchar[] when len(ws) < 3 then [array_to_string(ws, ' ')] else list_distinct(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) end as found from w),
  g as (select doc_id, len(found) as n, unnest(found) as shingle from s),
  links as (select a.doc_id as x, b.doc_id as y from g a join g b on a.shingle = b.shingle and a.doc_id <> b.doc_id group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 85 * (a.n + b.n - count(*))),
  reach as (select x, y from links union select r.x, l.y from reach r join links l on l.x = r.y),
  low as (select x, min(y) as least from reach group by x)
select s.doc_id, cast(len(found) as bigint) as n_shingles, least(s.doc_id, coalesce(low.least, s.doc_id)) as component_id, s.doc_id <= coalesce(low.least, s.doc_id) as kept from s left join low on low.x = s.doc_id"""
)


def op7() -> str:
    """The templates' grams as literal rows, and the same votes, spans and labels."""
    grams = []
    for k, (words, label, is_base) in enumerate([(*t, True) for t in licenses.BASE] + [(*t, False) for t in licenses.TEMPLATES]):
        words = words.split()
        n = len(words) - licenses.GRAM + 1
        grams += [f"({k}, '{label}', {is_base}, {n}, {i}, '{' '.join(words[i : i + licenses.GRAM])}')" for i in range(n)]
    return (
        r"with w as (select doc_id, regexp_extract_all("
        + _ASCII_LOWER
        + r""", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as ws from documents),
  g as (select doc_id, unnest(range(1, len(ws) - 1)) as i, ws from w where len(ws) > 2),
  h as (select doc_id, i - 1 as pos, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] as gram from g),
  k(template, label, is_base, grams, place, gram) as (values """
        + ", ".join(grams)
        + f"""),
  v as (select doc_id, template, label, is_base, grams, pos - place as diagonal, list(distinct place) as places from h join k using (gram) group by 1, 2, 3, 4, 5, 6),
  b as (select doc_id, count(*) as n_base, min(diagonal) as first_word, max(diagonal) as last_word, list(distinct label) as labels from v where is_base and len(places) = grams group by 1),
  x as (select *, sum(fresh) over (partition by doc_id, template order by diagonal) as span from (select *, case when diagonal - lag(diagonal) over (partition by doc_id, template order by diagonal) <= {licenses.NEAR} then 0 else 1 end as fresh from v) y),
  m as (select doc_id, template, label, len(list_distinct(flatten(list(places)))) / cast(grams as double) as share from x group by doc_id, template, label, grams, span),
  c as (select doc_id, max(share) as score, list(distinct label) filter (share >= {licenses.SHARE}) as labels from m group by 1)
select w.doc_id, cast(len(ws) as bigint) as n_words, coalesce(n_base, 0) as n_base, first_word, last_word, array_to_string(list_sort(coalesce(b.labels, []::varchar[])), ',') as base_labels,
  array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []::varchar[]), coalesce(c.labels, []::varchar[])))), ',') as labels, coalesce(round(score, 9), 0.0) as score
  from w left join b on b.doc_id = w.doc_id left join c on c.doc_id = w.doc_id"""
    )


def crc32(number: str) -> str:
    """Unsigned crc32 of a number's decimal text."""
    digits = f"list_transform(string_split(cast({number} as varchar), ''), lambda x: ord(x)::bigint)"
    bits = "list_reduce(list_prepend(xor(c, b), range(8)), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {digits}), lambda c, b: {bits}), 4294967295)"


def _leaf(columns: list[str]) -> str:
    return "sha256(concat(" + ", ".join(f"case when {c} is null then '-' else concat(octet_length(encode(cast({c} as varchar))), ':', cast({c} as varchar)) end" for c in columns) + "))"


OP11 = f"""with t as (select conv_id, coalesce(role, '') as role, coalesce(text, '') as text, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) - 1 as place from conversations where conv_id is not null),
  c as (select distinct conv_id, conv_id - conv_id % 5 as head, {crc32('conv_id')} % 9 as shared from t),
  r as (select c.conv_id, place - 8 as pos, role, text from c join t on t.conv_id = c.head where place < shared union all select conv_id, place, role, text from t join c using (conv_id) where place >= shared),
  o as (select conv_id, row_number() over w as depth, string_agg(sha256(role) || sha256(text), '') over w as key, octet_length(encode(text)) as bytes from r window w as (partition by conv_id order by pos)),
  p as (select * from o union all select conv_id, 0, '', 0 from c),
  m as (select key, depth, min(conv_id) as conv_id, count(*) as n_convs, any_value(bytes) as bytes from p group by key, depth),
  k as (select left(key, 128 * (depth - 1)) as key, count(*) as n_children from m where depth > 0 group by 1),
  n as (select m.*, coalesce(n_children, 0) as n_children from m left join k using (key)),
  u as (select left(key, 128 * i) as key, sum(cast(n_children = 0 as int)) as n_leaves, sum((n_convs - 1) * bytes) as saved_tokens from (select *, unnest(range(depth + 1)) as i from n) x group by 1),
  e as (select key, sha256(string_agg(cast(conv_id as varchar), ',' order by conv_id)) as ends_sha256 from (select conv_id, arg_max(key, depth) as key from p group by conv_id) x group by key)
select n.conv_id, n.depth, a.conv_id as parent_conv_id, n.n_convs, n.n_children, cast(n_leaves as bigint) as n_leaves, cast(saved_tokens as bigint) as saved_tokens, coalesce(ends_sha256, sha256('')) as ends_sha256
  from n join u on u.key = n.key left join e on e.key = n.key left join n a on n.depth > 0 and a.key = left(n.key, 128 * (n.depth - 1))"""

_COLUMNS = ["doc_id", "source", "lang", "n_chars", "text"]

OP13 = f"""with recursive l as (select *, coalesce('1' || source, '0') as tree, {_leaf(_COLUMNS)} as leaf, case when {crc32('doc_id')} % 2 = 0 then {_leaf([*_COLUMNS[:-1], "replace(text, chr(10), '')"])} end as changed from documents),
  d as (select row_number() over () as rid, tree, doc_id, leaf, coalesce(changed, leaf) as held, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by tree) as n from l),
  b(tree, step, pos, n, digest) as (select tree, 0, pos, n, leaf from d
    union all select tree, step + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(digest, '' order by pos)) from b where n > 1 group by tree, step, pos // 3),
  s as (select tree, digest as subroot, row_number() over (order by tree) - 1 as pos, count(*) over () as n from b where n = 1),
  u(step, pos, n, digest) as (select 0, pos, n, subroot from s
    union all select step + 1, pos // 3, (any_value(n) + 2) // 3, sha256(string_agg(digest, '' order by pos)) from u where n > 1 group by step, pos // 3),
  p(rid, tree, step, pos, n, held, proof) as (select rid, tree, 0, pos, n, held, '' from d
    union all select p.rid, any_value(p.tree), any_value(p.step) + 1, any_value(p.pos) // 3, (any_value(p.n) + 2) // 3, sha256(string_agg(case when b.pos = p.pos then p.held else b.digest end, '' order by b.pos)),
      any_value(p.proof) || coalesce(string_agg(b.digest, '' order by b.pos) filter (b.pos <> p.pos), '') from p join b on b.tree = p.tree and b.step = p.step and b.pos // 3 = p.pos // 3 where p.n > 1 group by p.rid),
  q(rid, step, pos, n, held, proof) as (select rid, 0, s.pos, s.n, held, proof from p join s using (tree) where p.n = 1
    union all select q.rid, any_value(q.step) + 1, any_value(q.pos) // 3, (any_value(q.n) + 2) // 3, sha256(string_agg(case when u.pos = q.pos then q.held else u.digest end, '' order by u.pos)),
      any_value(q.proof) || coalesce(string_agg(u.digest, '' order by u.pos) filter (u.pos <> q.pos), '') from q join u on u.step = q.step and u.pos // 3 = q.pos // 3 where q.n > 1 group by q.rid)
select doc_id, leaf, subroot, root, sha256(proof) as proof_sha256, q.held as folded_root, q.held = root as verified
  from q join d using (rid) join s on s.tree = d.tree cross join (select digest as root from u where n = 1) r where q.n = 1"""


def oracles() -> dict[str, str]:
    return {"op1_mixing": OP1, "op3_merkle": OP3, "op4_neardup": OP4, "op7_licenses": op7(), "op11_prefix_trie": OP11, "op13_manifest": OP13}
