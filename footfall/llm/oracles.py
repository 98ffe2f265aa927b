"""DuckDB SQL of the operators that SQL can express."""

ORACLE: dict[str, str] = {}

# The CRC-32 of an id's digits, one bit at a time.
CRC32 = """xor(4294967295::ubigint, list_reduce(list_concat([4294967295::ubigint], list_transform(
    string_split(doc_id::varchar, ''), lambda c: ord(c)::ubigint)),
    lambda s, b: list_reduce(list_concat([xor(s, b)], range(8)::ubigint[]),
        lambda x, i: xor(x >> 1, 3988292384::ubigint * (x & 1)))))"""

ORACLE["op11_language_id"] = rf"""
    with d as (
        select row_number() over () as row, doc_id, lang,
               coalesce({CRC32} % 5 = 0, true) as held_out,
               list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\p{{L}}]+'),
                           lambda x: x <> '') as w
        from documents),
    w as (select row, ' ' || unnest(w) || ' ' as w from d),
    c as (select row, w, count(*) as n from w group by all),
    g as (
        select row, n, unnest(list_transform(
            range(1, length(w) - m + 2), lambda i: w[i:i + m - 1])) as gram
        from c, (select unnest([1, 2, 3]) as m)),
    t as (select row, gram, sum(n) as n from g where gram <> ' ' group by all),
    p as (
        select row, gram, row_number() over (
            partition by row order by n desc, length(gram), gram) - 1 as place
        from t qualify place < 400),
    k as (
        select lang, gram, row_number() over (
            partition by lang order by sum(n) desc, length(gram), gram) - 1 as place
        from t join d using (row) where not held_out and lang is not null
        group by lang, gram qualify place < 400),
    l as (select distinct lang from k),
    s as (
        select p.row, l.lang, sum(coalesce(abs(p.place - k.place), 400)) as far, count(*) as n
        from p cross join l left join k on k.lang = l.lang and k.gram = p.gram group by all),
    b as (select * from s qualify row_number() over (partition by row order by far, lang) = 1)
    select doc_id, held_out, coalesce(b.lang, 'und') as lang_pred,
           coalesce(1.0 - far::double / (400 * n), 0.0)::double as score
    from d left join b using (row)"""

ORACLE["op12_phrase_collocations"] = r"""
    with t as (
        select coalesce(lang, 'und') as lang, translate(
            text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
        from documents),
    p as (select lang, unnest(regexp_split_to_array(text, '[.,;:!?\n\x0B\f\r]')) as piece from t),
    w as (
        select lang, list_filter(regexp_split_to_array(piece, '[ \t]+'), lambda x: x <> '') as w
        from p),
    g as (
        select lang, m, unnest(list_transform(
            range(1, len(w) - m + 2), lambda i: array_to_string(w[i:i + m - 1], ' '))) as phrase
        from w, (select unnest(range(1, 6)) as m)),
    f as (select lang, phrase, m, count(*)::hugeint as a from g group by all having a >= 100
          or m = 1),
    n as (select lang, sum(a)::hugeint as n from f where m = 1 group by lang),
    c as (select *, string_split(phrase, ' ') as w from f where m > 1),
    k as (
        select c.lang, c.phrase, c.a, k, x.a as l, y.a as r, n.n,
               (1000 * c.a * n.n) // (x.a * y.a) as score
        from c, lateral (select unnest(range(1, c.m)) as k)
        join f x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:k], ' ')
        join f y on y.lang = c.lang and y.phrase = array_to_string(c.w[k + 1:], ' ')
        join n on n.lang = c.lang),
    b as (select * from k qualify row_number() over (
        partition by lang, phrase order by score, k) = 1),
    d as (
        select lang, array_to_string(w[i:i + s - 1], ' ') as phrase, max(a) as longer
        from c, (select unnest(range(2, 5)) as s), (select unnest(range(1, 5)) as i)
        where s < m and i + s - 1 <= m group by all),
    o as (
        select b.*, row_number() over (partition by b.lang order by score desc, a desc,
                                       encode(b.phrase)) as rank
        from b left join d using (lang, phrase) where longer is null or 100 * longer < 100 * a)
    select lang, rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n,
           score::bigint as score
    from o where rank <= 2000"""

# A node's place p among c nodes of a level: its sibling is at p - 1 or p + 1, if there is one.
ORACLE["op13_merkle_manifest"] = rf"""
    with recursive v as (
        select doc_id, n_chars, lang, coalesce('=' || lang, '') as tree,
               list_transform([doc_id::varchar, source, lang], lambda x: coalesce(
                   octet_length(encode(x))::varchar || ':' || x, '-')) as h,
               coalesce(octet_length(encode(text))::varchar || ':' || text, '-') as t,
               {CRC32} % 7 = 0 as bad
        from documents),
    e as (
        select *, array_to_string(h, '') as head,
               coalesce(length(n_chars::varchar)::varchar || ':' || n_chars::varchar, '-') as c,
               coalesce(length((n_chars + 1)::varchar)::varchar || ':' || (n_chars + 1)::varchar,
                        '-') as c1
        from v),
    leaf as (
        select doc_id, tree, sha256(head || c || t) as leaf,
               case when bad then sha256(head || c1 || t) else sha256(head || c || t) end as told,
               row_number() over (partition by tree order by doc_id nulls last,
                                  sha256(head || c || t)) - 1 as p,
               count(*) over (partition by tree) as total
        from e),
    nodes as (
        select tree, 0 as level, p, leaf as digest, total from leaf
        union all
        select tree, level + 1, p // 2, sha256(string_agg(digest, '' order by p)),
               (total + 1) // 2
        from nodes where total > 1 group by tree, level, p // 2, total),
    tops as (
        select tree, digest as subroot, row_number() over (order by tree) - 1 as p,
               count(*) over () as total
        from nodes where total = 1),
    upper as (
        select 0 as level, p, subroot as digest, total from tops
        union all
        select level + 1, p // 2, sha256(string_agg(digest, '' order by p)), (total + 1) // 2
        from upper where total > 1 group by level, p // 2, total),
    step as (
        select l.tree, l.p as p0, n.level, xor(n.p, 1) as other, n.digest as sibling,
               n.p % 2 as odd
        from leaf l join nodes n on n.tree = l.tree and n.total > 1
                                 and n.p = xor(l.p >> n.level, 1)),
    high as (
        select t.tree, u.level, u.digest as sibling, u.p % 2 as odd
        from tops t join upper u on u.total > 1 and u.p = xor(t.p >> u.level, 1)),
    depth as (select tree, max(level) as levels from nodes group by tree),
    height as (select max(level) as levels from upper),
    path as (
        select l.tree, l.p, list_transform(range(d.levels + h.levels), lambda i: '-') as blank,
               d.levels as low, h.levels as high
        from leaf l join depth d using (tree), height h),
    lows as (
        select tree, p0, list(level order by level) as at,
               list(case when odd = 1 then 'R' else 'L' end || sibling order by level) as hash
        from step group by tree, p0),
    highs as (
        select tree, list(level order by level) as at,
               list(case when odd = 1 then 'R' else 'L' end || sibling order by level) as hash
        from high group by tree),
    witness as (
        select q.tree, q.p, list_concat(
            list_transform(range(q.low), lambda i: coalesce(
                w.hash[list_position(w.at, i)], '-')),
            list_transform(range(q.high), lambda i: coalesce(
                x.hash[list_position(x.at, i)], '-'))) as path
        from path q left join lows w on w.tree = q.tree and w.p0 = q.p
        left join highs x on x.tree = q.tree),
    folded as (
        select l.doc_id, l.leaf, t.subroot, u.digest as root,
               sha256(array_to_string(list_transform(path, lambda x: x[2:]), '')) as proof_sha256,
               list_reduce(list_concat([l.told], path), lambda a, x: sha256(case x[1]
                   when 'L' then x[2:] || a when 'R' then a || x[2:] else a end)) as folded_root
        from leaf l join witness using (tree, p) join tops t using (tree)
        join upper u on u.total = 1)
    select *, folded_root = root as verified from folded"""
