"""DuckDB SQL of the dealt operators, where SQL can express them."""

from corpusq.registry.oracle import CRC_TABLE, _crc32

ORACLE = {
    "op9_warc_splits": """
        with payloads as (
            select page_id, strlen(coalesce(html, '')) as payload_bytes, sha1(coalesce(html, '')) as payload_digest from pages
        ), newest as (
            select payload_digest, max(page_id) as page_id from payloads where payload_bytes >= 1000 group by payload_digest
        )
        select p.page_id, p.payload_bytes, p.payload_digest,
            case when n.page_id > p.page_id then 'revisit' else 'response' end as record_type,
            case when n.page_id > p.page_id then n.page_id end as refers_to
        from payloads p left join newest n on n.payload_digest = p.payload_digest and p.payload_bytes >= 1000""",
    "op11_parentheses_trie": f"""
        with {CRC_TABLE}, raw as (
            select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null
        ), numbered as (
            select *, row_number() over (partition by conv_id order by turn nulls first, role, text) - 1 as pos from raw
        ), conv as (
            select c, c - c % 100 as base, {_crc32('c::varchar')} % 6 as h from (select distinct conv_id as c from raw), crc_table
        ), built as (
            select c, pos, role, text from conv join numbered on conv_id = base where pos < h
            union all
            select c, pos, role, text from conv join numbered on conv_id = c where pos >= h
        ), turns as (
            select c, row_number() over (partition by c order by pos) as d, md5(length(role) || ':' || role || text) as m, length(text) as chars
            from built
        ), member as (
            select c, '' as k, 0 as depth, 0 as chars from conv
            union all
            select c, string_agg(m, '') over (partition by c order by d rows unbounded preceding), d, chars from turns
        ), node as (
            select k, min(depth) as depth, min(chars) as chars, min(c) as conv_id, count(*) as n_convs from member group by k
        ), ends as (
            select k, string_agg(c::varchar, ',' order by c) as ids from member join
            (select c, max(depth) as n from member group by c) using (c) where depth = n group by k
        ), kids as (
            select substr(k, 1, 32 * (depth - 1)) as k, count(*) as n_children from node where depth > 0 group by 1
        ), below as (
            select substr(k, 1, 32 * i) as k, count(*) filter (n_children is null) as n_leaves, sum((n_convs - 1) * chars)::bigint as saved_tokens
            from (select *, unnest(range(depth + 1)) as i from node left join kids using (k)) group by 1
        )
        select n.conv_id, n.depth::bigint as depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(n_children, 0) as n_children, n_leaves,
            saved_tokens, sha256(coalesce(ids, '')) as ends_sha256
        from node n left join node p on n.depth > 0 and p.k = substr(n.k, 1, 32 * (n.depth - 1))
        left join kids on kids.k = n.k left join below on below.k = n.k left join ends on ends.k = n.k""",
    "op12_blocked_bloom": r"""
        with parts as (
            select page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) as path, regexp_extract(coalesce(url, ''), '://[^?#]*\?([^#]*)', 1) as query
            from pages
        ), canonical as (
            select page_id, host, path, regexp_replace(host, '^www\.|:(80|443)?$', '', 'g') || regexp_replace(path, '(/index\.html?)?/*$', '') || '?' || array_to_string(
                list_sort(list_filter(string_split(query, '&'), lambda p: p <> '' and not regexp_matches(p, '^(utm_[^=]*|ref|fbclid|gclid|msclkid|mc_cid|mc_eid|sessionid|phpsessid)(=|$)'))), '&') as whole
            from parts
        ), listed as (
            select distinct whole from canonical
            where regexp_matches(host, '(^|\.)(adult-x|ads-track|casino-win|cheap-pills|free-bets|spam-farm)\.[^.]*\.[^.]*$')
        ), rules(rule_host, rule_path, rule_verdict) as (
            values ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
        ), fits as (
            select page_id, url, rule_host || rule_path as rule, rule_verdict from (select page_id, host, path, whole as url from canonical) join rules
            on ('.' || host) like ('%.' || rule_host) and starts_with(path, rule_path)
        ), longest as (
            select page_id, url, arg_max(rule, length(rule)) as rule, arg_max(rule_verdict, length(rule)) as rule_verdict from fits group by all
        )
        select c.page_id, c.host, c.path, rule,
            coalesce(rule_verdict, case when host <> '' and c.whole in (select whole from listed) then 'block' else 'allow' end) as verdict
        from canonical c left join longest l on l.page_id = c.page_id and l.url = c.whole""",
}
