"""DuckDB SQL of the operators that SQL can express, on the registered tables."""

from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"

_MIXTURE = rf"""
with sized as (
    select doc_id, source,
           coalesce(len(regexp_extract_all(text, '{_WORD}')), 0)::bigint as size
    from documents
),
sizes as (select source, sum(size)::bigint as source_size from sized group by source),
weighed as (
    select source, source_size,
           1 + (row_number() over (order by source nulls last) - 1) % 3 as weight,
           row_number() over (order by source nulls last) as place
    from sizes
),
shares as (
    select *, sum(source_size) over () - 3 * coalesce(sum(source_size) over before, 0) as room,
           sum(weight) over () - coalesce(sum(weight) over before, 0) as weight_left,
           row_number() over (order by source_size / weight, place) as nth
    from weighed
    window before as (order by source_size / weight, place
                      rows between unbounded preceding and 1 preceding)
),
marked as (select *, 3 * source_size * weight_left <= weight * room as is_full from shares),
first_open as (
    select arg_min(room, nth) as room, arg_min(weight_left, nth) as weight_left
    from marked where not is_full
),
targets as (
    select m.source, m.source_size,
           case when m.is_full then (3 * m.source_size)::double
                else (m.weight * o.room)::double / o.weight_left::double end as target
    from marked m left join first_open o on true
),
rates as (
    select d.doc_id, d.size, t.source_size, t.target,
           case when t.source_size > 0 then t.target / t.source_size else 1.0 end as rate
    from sized d join targets t on d.source is not distinct from t.source
),
drawn as (
    select *, floor(rate)::bigint as whole, rate - floor(rate) as rest,
           ('0x' || substr(md5('mix:' || coalesce(doc_id::varchar, 'null')), 1, 8))::bigint as draw
    from rates
)
select doc_id, size, source_size, target,
       size * (whole + case when draw < rest * 4294967296.0 then 1 else 0 end) as taken
from drawn
"""

_TOP_K = """
with vectors as (
    select vec_id, [floor(64 * x::double) for x in embedding] as v
    from embeddings
    where vec_id is not null and embedding is not null and len(embedding) > 0
      and len([x for x in embedding if x is null or isnan(x) or isinf(x)]) = 0
),
scored as (
    select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
    from vectors q join vectors c on q.vec_id <> c.vec_id
    where q.vec_id % 20 = 0
),
ranked as (
    select *, row_number() over (partition by query_id order by score desc, vec_id) as place
    from scored
)
select query_id, place::int as rank, vec_id, score from ranked where place <= 20
"""

# A crc32 of texts: {bytes} are a list of byte values.
_CRC = """
crc_table as (
    select list_transform(range(256), lambda i: list_reduce(
        list_prepend(i, range(8)),
        lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)) as crc
)"""
_CRC_OF = """xor(4294967295, list_reduce(
    list_prepend(4294967295, list_transform(range(octet_length(encode({text}))),
        lambda i: ('0x' || substr(hex(encode({text})), 2 * i + 1, 2))::bigint)),
    lambda c, b: xor(c >> 8, crc[1 + (xor(c, b) & 255)])))"""

_A_Z = "translate({text}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN_WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

_IMPORTANCE = rf"""
with {_CRC},
doc_words as (
    select d.number, unnest(regexp_extract_all({_A_Z.format(text="text")}, '{_PLAIN_WORD}')) as word
    from (select row_number() over () as number, doc_id, text from documents) d
),
target_words as (
    select unnest(regexp_extract_all({_A_Z.format(text="text")}, '{_PLAIN_WORD}')) as word
    from benchmark
),
buckets as (
    select word, {_CRC_OF.format(text="word")} % 10000 as bucket
    from (select word from doc_words union select word from target_words), crc_table
),
in_corpus as (select bucket, count(*) as n from doc_words join buckets using (word) group by 1),
in_target as (select bucket, count(*) as n from target_words join buckets using (word) group by 1),
sums as (
    select (select count(*) from doc_words) as s, (select count(*) from target_words) as t
),
gains as (
    select bucket, floor(1000 * ln(
        ((coalesce(t.n, 0) + 1) * (sums.s + 10000))::double
        / ((coalesce(c.n, 0) + 1) * (sums.t + 10000))::double))::bigint as gain
    from (select range as bucket from range(10000)) left join in_corpus c using (bucket)
         left join in_target t using (bucket), sums
),
weights as (
    select number, count(*) as n_features, floor(sum(gain) / count(*)::double)::bigint as weight
    from doc_words join buckets using (word) join gains using (bucket) group by number
),
scored as (
    select d.doc_id, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight,
           coalesce(weight, 0) + floor(-1000 * ln(-ln(
               (('0x' || substr(sha256('2024:' || coalesce(d.doc_id::varchar, 'null')), 1, 8))::bigint
                + 0.5::double) / 4294967296::double)))::bigint as score
    from (select row_number() over () as number, doc_id from documents) d
         left join weights using (number)
),
ranked as (
    select *, row_number() over (order by score desc, doc_id nulls last, weight desc) as place,
           count(*) over () as eligible
    from scored where n_features >= 20
)
select doc_id, n_features, weight, score,
       case when place <= floor(10 * eligible / 100) then place end as rank
from ranked
union all
select doc_id, n_features, weight, score, null from scored where n_features < 20
"""

_FIELD = "coalesce(octet_length(encode({f}::varchar))::varchar || ':' || {f}::varchar, '-')"
_LEAF = "sha256(" + " || ".join(_FIELD.format(f=f) for f in ("doc_id", "source", "lang", "{n}", "text")) + ")"

# Levels of a tree of pairs over (tree, pos, digest, nodes), and the paths through them.
_LEVELS = """
    select tree, 0 as level, pos, digest, nodes from {leaves}
    union all
    select tree, level + 1, pos // 2, sha256(string_agg(digest, '' order by pos)), (nodes + 1) // 2
    from {levels} where nodes > 1 group by tree, level, pos // 2, nodes
"""

_MANIFEST = rf"""
with recursive {_CRC},
leaf_rows as (
    select doc_id, case when lang is null then '-' else '=' || lang end as tree,
           {_LEAF.format(n="n_chars")} as leaf,
           case when {_CRC_OF.format(text="doc_id::varchar")} % 7 = 0
                then {_LEAF.format(n="(n_chars + 1)")} end as changed
    from documents, crc_table
),
placed as (
    select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos,
           count(*) over (partition by tree) as nodes, leaf as digest
    from leaf_rows
),
levels as ({_LEVELS.format(leaves="placed", levels="levels")}),
subroots as (
    select tree as name, '' as tree, digest, row_number() over (order by tree) - 1 as pos,
           count(*) over () as nodes
    from levels where nodes = 1
),
crown as ({_LEVELS.format(leaves="subroots", levels="crown")}),
whole as (select digest as root from crown where nodes = 1),
walk as (
    select doc_id, leaf, tree, pos, 0 as level, nodes, '' as siblings, false as crowned,
           case when leaf = coalesce(changed, leaf) then leaf else changed end as folded,
           null::varchar as subroot
    from placed
    union all
    select w.doc_id, w.leaf,
           case when w.crowned or w.nodes > 1 then w.tree else '' end,
           case when w.crowned or w.nodes > 1 then w.pos // 2 else s.pos end,
           case when w.crowned or w.nodes > 1 then w.level + 1 else 0 end,
           case when w.crowned or w.nodes > 1 then (w.nodes + 1) // 2 else s.nodes end,
           case when w.crowned or w.nodes > 1 then w.siblings || coalesce(o.digest, '')
                else w.siblings end,
           w.crowned or w.nodes = 1,
           case when not w.crowned and w.nodes = 1 then w.folded
                when o.digest is null then sha256(w.folded)
                when w.pos % 2 = 0 then sha256(w.folded || o.digest)
                else sha256(o.digest || w.folded) end,
           case when not w.crowned and w.nodes = 1 then s.digest else w.subroot end
    from walk w
    left join (select tree, level, pos, digest from levels
               union all select tree, level, pos, digest from crown) o
      on w.nodes > 1 and o.tree = w.tree and o.level = w.level and o.pos = xor(w.pos, 1)
    left join subroots s on s.name = w.tree
    where not (w.crowned and w.nodes = 1)
)
select doc_id, leaf, subroot, root, sha256(siblings) as proof_sha256, folded as folded_root,
       folded = root as verified
from walk, whole where crowned and nodes = 1
"""


def oracle_queries() -> dict[str, str]:
    return {
        "op7_mixture": _MIXTURE,
        "op9_top_k": _TOP_K,
        "op12_importance": _IMPORTANCE,
        "op13_manifest": _MANIFEST,
    }
