"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

from stacklore.llm import sharding

# One round key after another as key * 2, plus 1 where it moves the left half.
_KEYS = [2 * k + (i % 2 == 0) for i, k in enumerate(sharding.round_keys(0))]
_MIXED = f"""list_reduce([0], lambda t, nil: xor(t, t >> 13), list_reduce({list(sharding.MULTIPLIERS)}::bigint[],
    lambda v, m: (xor(v, v >> 15) * m) & {sharding.MASK}, ({{half}} + (k >> 1)) & {sharding.MASK}))"""
# Both halves of a place in one number, 2**32 times the left one and the right one.
_ROUND = f"""case when k & 1 = 1
    then (((s >> 32) + {_MIXED.format(half="(s & 4294967295)")}) % a) * 4294967296 + (s & 4294967295)
    else (s >> 32) * 4294967296 + ((s & 4294967295) + {_MIXED.format(half="(s >> 32)")}) % b end"""


def _feistel(x: str) -> str:
    halves = f"list_reduce({_KEYS}::bigint[], lambda s, k: {_ROUND}, ({x} % a) * 4294967296 + {x} // a)"
    return f"list_reduce([0], lambda s, nil: (s & 4294967295) * a + (s >> 32), {halves})"


SQL: dict[str, str] = {
    "op3_pivot_search": """
        with parts as (
            select vec_id, unnest(embedding) as x, generate_subscripts(embedding, 1) as i from embeddings
        ), bad as (
            select distinct vec_id from parts where x is null or not isfinite(x)
        ), numbers as (
            select vec_id, i, cast(floor(1024 * cast(x as double)) as bigint) as x from parts
            where vec_id not in (select vec_id from bad)
        ), scored as (
            select q.vec_id as query_id, c.vec_id, cast(sum(q.x * c.x) as bigint) as score
            from numbers q join numbers c on q.i = c.i and q.vec_id <> c.vec_id
            where q.vec_id % 100 = 0 group by all
        )
        select query_id, cast(row_number() over w as integer) as rank, vec_id, score from scored
        window w as (partition by query_id order by score desc, vec_id)
        qualify row_number() over w <= 10""",
    "op5_exact_dedup": """
        select doc_id, max(doc_id) over g as keep_id, count(*) over g as group_size,
               doc_id = max(doc_id) over g as kept, sha256(coalesce(text, '')) as text_sha256
        from documents window g as (partition by coalesce(text, ''))""",
    "op10_warc": """
        with p as (
            select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as payload_bytes from pages
        ), g as (
            select *, sha1(html) as payload_digest, max(page_id) over (partition by html) as newest from p
        )
        select page_id, payload_bytes, payload_digest,
               case when payload_bytes >= 1000 and page_id < newest then 'revisit' else 'response' end as record_type,
               case when payload_bytes >= 1000 and page_id < newest then newest end as refers_to
        from g""",
    "op11_prefix_trie": """
        with turns as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text
            from conversations where conv_id is not null
        ), own as (
            select conv_id, list({'role': role, 'text': text}
                order by turn nulls first, sha256(strlen(role) || ':' || role || text)) as path
            from turns group by conv_id
        ), hashed as (
            select conv_id, path, xor(list_reduce(
                list_transform(string_split(cast(conv_id as varchar), ''), lambda c: cast(ord(c) as bigint)),
                lambda crc, byte: list_reduce(range(8),
                    lambda v, i: case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, xor(crc, byte)),
                cast(4294967295 as bigint)), 4294967295) % 9 as h
            from own
        ), rebuilt as (
            select c.conv_id, list_concat(coalesce(b.path[1:c.h], []), c.path[c.h + 1:]) as path
            from hashed c left join own b on b.conv_id = c.conv_id - c.conv_id % 5
        ), starts as (
            select conv_id, len(path) as turns, unnest(range(len(path) + 1)) as depth, path from rebuilt
        ), nodes as (
            select path[1:depth] as node, depth, min(conv_id) as conv_id, count(*) as n_convs,
                   sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id)
                       filter (where turns = depth), '')) as ends_sha256
            from starts group by all
        ), below as (
            select node[1:depth - 1] as node, count(*) as n_children from nodes where depth > 0 group by all
        ), weighed as (
            select n.*, coalesce(n_children, 0) as n_children,
                   case when depth = 0 then 0 else (n_convs - 1) * strlen(n.node[depth].text) end as saved
            from nodes n left join below b using (node)
        ), spread as (
            select node, depth, n_children = 0 as leaf, saved, unnest(range(depth + 1)) as above from weighed
        ), sums as (
            select node[1:above] as node, count(*) filter (where leaf) as n_leaves, sum(saved) as saved_tokens
            from spread group by all
        )
        select w.conv_id, w.depth, p.conv_id as parent_conv_id, w.n_convs, w.n_children, s.n_leaves,
               cast(s.saved_tokens as bigint) as saved_tokens, w.ends_sha256
        from weighed w join sums s using (node) left join nodes p on w.depth > 0 and p.node = w.node[1:w.depth - 1]""",
    "op13_term_pipeline": r"""
        with said as (
            select doc_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from documents
        ), asked as (
            select item_id, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text from benchmark
        ), words as (
            select doc_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from said
        ), item_terms as (
            select distinct item_id,
                   unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term from asked
        ), counts as (
            select doc_id, term, count(*) as tf from words group by all
        ), lengths as (
            select doc_id, count(*) as n from words group by all
        ), totals as (
            select count(*) as docs, cast(sum(n) as bigint) as words from lengths
        ), weights as (
            select term, cast(floor(1000 * ln(cast(2 * docs + 2 as double) / (2 * count(*) + 1))) as bigint) as w
            from counts, totals group by term, docs
        ), scored as (
            select item_id, doc_id, cast(sum(w * ((1000000000 * tf)
                       // (1000 * tf + 8 * (100 - 90 + ((90 * n * docs) // words))))) as bigint) as score
            from item_terms join weights using (term) join counts using (term) join lengths using (doc_id), totals
            group by all
        )
        select item_id, cast(row_number() over best as integer) as rank, doc_id, score from scored where score > 0
        window best as (partition by item_id order by score desc, doc_id)
        qualify row_number() over best <= 10""",
    "op6_jaccard_join": r"""
        with recursive worded as (
            select doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') as words
            from documents
        ), sets as (
            select doc_id, list_distinct(case when len(words) = 0 then [] when len(words) < 5 then [array_to_string(words, ' ')]
                else list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' ')) end) as shingles
            from worded
        ), held as (
            select doc_id, len(shingles) as n, unnest(shingles) as shingle from sets
        ), links as (
            select a.doc_id as a, b.doc_id as b from held a join held b on a.shingle = b.shingle and a.doc_id < b.doc_id
            group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))
        ), reached as (
            select doc_id, doc_id as other from sets
            union
            select r.doc_id, l.other from reached r
            join (select a as doc_id, b as other from links union all select b, a from links) l on l.doc_id = r.other
        )
        select s.doc_id, cast(len(s.shingles) as bigint) as n_shingles, min(other) as component_id
        from sets s join reached r using (doc_id) group by s.doc_id, len(s.shingles)""",
    "op8_mixing": r"""
        with sized as (
            select doc_id, source, cast(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as bigint) as size
            from documents
        ), sources as (
            select source, cast(sum(size) as bigint) as source_size from sized group by source
        ), weighed as (
            select *, [1, 2, 3][1 + (row_number() over (order by source nulls last) - 1) % 3] as w, 3 * source_size as cap
            from sources
        ), ranked as (
            select *, row_number() over o as i,
                   sum(source_size) over () - coalesce(sum(cap) over before, 0) as rest,
                   sum(w) over () - coalesce(sum(w) over before, 0) as wsum
            from weighed
            window o as (order by cap / w, source nulls last),
                   before as (order by cap / w, source nulls last rows between unbounded preceding and 1 preceding)
        ), level as (
            select min(i) as first, arg_min(rest, i) as rest, arg_min(wsum, i) as wsum from ranked
            where cast(rest as double) * w <= cast(cap as double) * wsum
        ), targets as (
            select source, source_size,
                   case when i < first then cast(cap as double) else cast(l.rest as double) * w / l.wsum end as target
            from ranked, level l
        ), rates as (
            select *, case when source_size > 0 then target / source_size else 0 end as rate from targets
        ), drawn as (
            select d.*, source_size, target, seed, floor(rate) + cast(
                cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || ':' || (seed // 4)), 1 + 8 * (seed % 4), 8) as bigint)
                / 4294967296.0::double < rate - floor(rate) as integer) as copies
            from sized d join rates r on d.source is not distinct from r.source, range(16) s(seed)
        ), misses as (
            select source, seed, abs(cast(sum(size * copies) as double) - any_value(target)) as miss from drawn group by all
        ), chosen as (
            select source, arg_min(seed, (miss, seed)) as seed from misses group by source
        )
        select doc_id, size, source_size, target, cast(size * copies as bigint) as taken, cast(copies as bigint) as copies
        from drawn d join chosen c on d.source is not distinct from c.source and d.seed = c.seed""",
    "op9_sharding": f"""
        with recursive steps as (
            select list_transform(range(256), lambda n: list_reduce(range(8),
                lambda v, i: case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, n)) as moves
        ), sized as (
            select doc_id, cast(strlen(coalesce(text, '')) + 8 as bigint) as size,
                   xor(list_reduce(list_transform(regexp_extract_all(hex(coalesce(text, '')), '..'), lambda h: cast('0x' || h as bigint)),
                       lambda crc, byte: xor(moves[1 + (xor(crc, byte) & 255)], crc >> 8), cast(4294967295 as bigint)),
                       4294967295) as text_crc32
            from documents, steps
        ), numbered as (
            select *, row_number() over (order by doc_id nulls first, text_crc32, size) - 1 as x, count(*) over () as n from sized
        ), gridded as (
            select *, a, (n + a - 1) // a as b
            from numbered, (select cast(ceil(sqrt(count(*))) as bigint) as a from documents)
        ), walked as (
            select doc_id, size, text_crc32, n, a, b, {_feistel("x")} as y from gridded
            union all
            select doc_id, size, text_crc32, n, a, b, {_feistel("y")} from walked where y >= n
        )
        select doc_id, size, text_crc32, 'rows' as law, cast(y % 24 as integer) as shard, y // 24 as slot,
               cast(null as integer) as grown_shard
        from walked where y < n""",
}
