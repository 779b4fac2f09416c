"""DuckDB SQL for the registered queries, written from shared CTEs."""

from __future__ import annotations

from corpusq.functions.text import STOP_WORDS
from corpusq.operators.evaluate import METRICS
from corpusq.registry.fixtures import LINK, NOT_TEXT, NUM_BUCKETS, PAGERANK_STEPS, TAG, TITLE
from corpusq.registry.typed_sql import DATE, TIME, TOKEN_CLASS_COUNTS, TYPED_TOKENS


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


TOKEN = _text(r"[#@\p{L}\p{N}_](?:['\-]?[\p{L}\p{N}_]){2,24}")
STOP = "(" + ", ".join(_text(w) for w in sorted(set(STOP_WORDS))) + ")"


def _tokens(column: str) -> str:
    return f"unnest(regexp_extract_all(lower({column}), {TOKEN}))"


def _half_even(value: str, places: int) -> str:
    scale = f"{10**places}::double"
    return f"round_even(({value}) * {scale}, 0) / {scale}"


def _exact(value: str, places: int) -> str:
    """A double rounded as the decimal number it stands for; ``value`` is a column."""
    scale = f"{10**places}::double"
    scaled = f"({value} * {scale})"
    wide = f"({value} * 134217729::double)"
    high = f"({wide} - ({wide} - {value}))"
    lost = f"(({high} * {scale} - {scaled}) + ({value} - {high}) * {scale})"
    tie = f"{scaled} - floor({scaled}) = 0.5::double"
    return (
        f"CASE WHEN {tie} AND {lost} > 0 THEN ceil({scaled}) WHEN {tie} AND {lost} < 0 THEN floor({scaled}) "
        f"ELSE round_even({scaled}, 0) END / {scale}"
    )


def _counts(source: str, key: str, column: str) -> str:
    return (
        f"SELECT term, {key}, count(*) AS tf FROM (SELECT {key}, {_tokens(column)} AS term FROM {source}) "
        f"WHERE term NOT IN {STOP} GROUP BY ALL"
    )


def _statistics(postings: str) -> str:
    return f"SELECT term, count(*) AS df, sum(tf)::bigint AS cf FROM {postings} GROUP BY term"


def _lengths(docs: str, postings: str) -> str:
    return (
        f"SELECT doc_id, coalesce(sum(tf), 0)::bigint AS dl FROM (SELECT doc_id FROM {docs}) "
        f"LEFT JOIN {postings} USING (doc_id) GROUP BY doc_id"
    )


def _totals(lengths: str) -> str:
    return (
        "SELECT count(*) AS n, sum(dl)::bigint AS total_len, sum(dl)::double / count(*) AS avg_dl "
        f"FROM {lengths}"
    )


def _bm25(postings: str, stats: str, lengths: str, totals: str, k1: float, b: float) -> str:
    idf = "ln(1 + (n - df + 0.5::double) / (df + 0.5::double))"
    length = f"({1 - b!r}::double + {b!r}::double * coalesce(dl, 0) / avg_dl)"
    part = f"qtf * {idf} * tf * {k1 + 1!r}::double / (tf + {k1!r}::double * {length})"
    return (
        f"SELECT query_id, doc_id, {_half_even(f'sum({part})', 4)} AS score "
        f"FROM q JOIN {stats} USING (term) JOIN {postings} USING (term) "
        f"LEFT JOIN {lengths} USING (doc_id) CROSS JOIN {totals} GROUP BY query_id, doc_id"
    )


def _tfidf_parts(postings: str, stats: str, lengths: str, totals: str) -> str:
    idf = "ln(n::double / df + 1e-9::double)"
    return (
        f"SELECT query_id, doc_id, term, qtf::double / qlen * {idf} AS qw, tf::double / dl * {idf} AS w "
        f"FROM q JOIN {stats} USING (term) JOIN {postings} USING (term) JOIN {lengths} USING (doc_id) "
        f"CROSS JOIN {totals}"
    )


def _dots(parts: str) -> str:
    return f"SELECT query_id, doc_id, {_half_even('sum(qw * w)', 5)} AS score FROM {parts} GROUP BY ALL"


def _top(scored: str, k: int) -> str:
    rank = "(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id))::int"
    return f"SELECT query_id, doc_id, score, rank FROM (SELECT *, {rank} AS rank FROM {scored}) WHERE rank <= {k}"


def _every(scored: str) -> str:
    """All results, ranked as by ``_top``."""
    return _top(scored, 2**31 - 1)


def _match(postings: str, score: str) -> str:
    return f"SELECT query_id, doc_id, {score}::bigint AS score FROM q JOIN {postings} USING (term) GROUP BY ALL"


def _rank_step(before: str) -> str:
    return (
        "SELECT doc_id, 0.15::double / (SELECT count(*) FROM node) + 0.85::double * (coalesce(r, 0) + "
        f"coalesce((SELECT sum(pr) FROM {before} WHERE doc_id NOT IN (SELECT src FROM edge)), 0) "
        "/ (SELECT count(*) FROM node)) AS pr FROM node LEFT JOIN "
        f"(SELECT dst AS doc_id, sum(pr / links) AS r FROM edge JOIN {before} ON src = doc_id "
        "JOIN degree USING (src) GROUP BY dst) USING (doc_id)"
    )


CTES = {
    "docs": "SELECT doc_id, text AS body, lang FROM documents",
    "q_raw": "SELECT item_id AS query_id, text FROM benchmark",
    "q_tf": _counts("q_raw", "query_id", "text"),
    "q": "SELECT query_id, term, tf AS qtf, (sum(tf) OVER (PARTITION BY query_id))::bigint AS qlen FROM q_tf",
    # documents
    "post": _counts("docs", "doc_id", "body"),
    "stats": _statistics("post"),
    "len": _lengths("docs", "post"),
    "total": _totals("len"),
    "parts": _tfidf_parts("post", "stats", "len", "total"),
    "dot": _dots("parts"),
    "body25": _bm25("post", "stats", "len", "total", 5.0, 0.2),
    "result": _top("body25", 100),
    "norm": (
        "SELECT doc_id, sqrt(sum(power(tf * ln(n::double / df), 2))) AS norm, "
        "sqrt(sum(power(tf::double / dl * ln(n::double / df + 1e-9::double), 2))) AS weight_norm "
        "FROM post JOIN stats USING (term) JOIN len USING (doc_id) CROSS JOIN total GROUP BY doc_id"
    ),
    "column_no": "SELECT term, dense_rank() OVER (ORDER BY term) AS term_idx FROM stats",
    "lemma_post": (
        "SELECT coalesce(nullif(regexp_replace(term, '(ing|ed|s)$', ''), ''), term) AS lemma, doc_id, "
        "sum(tf)::bigint AS tf FROM post GROUP BY ALL"
    ),
    "qrel": (
        "SELECT query_id, doc_id FROM q JOIN post USING (term) GROUP BY query_id, doc_id "
        "HAVING count(*) = (SELECT count(*) FROM q AS own WHERE own.query_id = q.query_id)"
    ),
    "hit": "SELECT query_id, doc_id, rank FROM result JOIN qrel USING (query_id, doc_id)",
    "size": "SELECT query_id, count(*) AS relevant FROM qrel GROUP BY query_id",
    "found": (
        "SELECT query_id, count(*) FILTER (rank <= 40) AS hits_k, count(*) FILTER (rank <= 100) AS hits_f, "
        "count(*) FILTER (rank <= relevant) AS hits_r, "
        "avg(so_far::double / rank) FILTER (rank <= 40) AS mean_precision FROM (SELECT *, row_number() OVER "
        "(PARTITION BY query_id ORDER BY rank) AS so_far FROM hit) JOIN size USING (query_id) GROUP BY query_id"
    ),
    "share": (
        "SELECT query_id, coalesce(hits_k, 0)::double / relevant AS rk, coalesce(hits_k, 0)::double / 40 AS pk, "
        "coalesce(hits_f, 0)::double / relevant AS rf, coalesce(hits_f, 0)::double / 100 AS pf, "
        "coalesce(hits_r, 0)::double / relevant AS rr, coalesce(mean_precision, 0) AS ap "
        "FROM size LEFT JOIN found USING (query_id)"
    ),
    "scored": (
        f"SELECT query_id, {_exact('rk', 3)} AS recall_at_k, {_exact('pk', 3)} AS precision_at_k, "
        f"{_exact('rf', 3)} AS r100, {_exact('pf', 3)} AS p100, {_exact('rr', 3)} AS r_precision, "
        f"{_exact('ap', 3)} AS avg_precision FROM share"
    ),
    "metric": (
        "SELECT query_id, recall_at_k, precision_at_k, "
        "CASE WHEN r100 + p100 = 0 THEN 0 ELSE 2 * r100 * p100 / (r100 + p100) END AS f_score, "
        "r_precision, avg_precision, precision_at_k AS avg_precision_flat FROM scored"
    ),
    # pages
    "page": (
        f"SELECT page_id AS doc_id, regexp_extract(html, {_text(TITLE)}, 1) AS title, "
        f"regexp_replace(regexp_replace(html, {_text(NOT_TEXT)}, ' ', 'g'), {_text(TAG)}, ' ', 'g') AS body, "
        "html FROM pages"
    ),
    "link": (
        f"SELECT doc_id, unnest(regexp_extract_all(html, {_text(LINK)}, 1)) AS href, "
        f"unnest(regexp_extract_all(html, {_text(LINK)}, 2)) AS text FROM page"
    ),
    "anchor": "SELECT doc_id, dense_rank() OVER (ORDER BY href) AS target_id, text FROM link",
    "t_post": _counts("page", "doc_id", "title"),
    "b_post": _counts("page", "doc_id", "body"),
    "a_post": _counts("(SELECT target_id AS doc_id, text FROM anchor)", "doc_id", "text"),
    "t_stats": _statistics("t_post"),
    "b_stats": _statistics("b_post"),
    "b_len": _lengths("page", "b_post"),
    "b_total": _totals("b_len"),
    "a_stats": _statistics("a_post"),
    "t25": _bm25("t_post", "t_stats", "b_len", "b_total", 2.0, 0.05),
    "b25": _bm25("b_post", "b_stats", "b_len", "b_total", 5.0, 0.2),
    "t_top": _top("t25", 100),
    "b_top": _top("b25", 100),
    "b_parts": _tfidf_parts("b_post", "b_stats", "b_len", "b_total"),
    "b_dot": _dots("b_parts"),
    "t_parts": (
        "SELECT query_id, doc_id, term, qtf::double / qlen * ln(n::double / df + 1e-9::double) AS qw, "
        "CASE WHEN dl > 0 THEN tf::double / dl ELSE 0 END * ln(n::double / df + 1e-9::double) AS w "
        "FROM q JOIN t_stats USING (term) JOIN t_post USING (term) JOIN b_len USING (doc_id) CROSS JOIN b_total"
    ),
    "t_dot": _dots("t_parts"),
    "a_parts": (
        "SELECT query_id, doc_id, term, qtf::double / qlen * ln(n::double / df + 1e-9::double) AS qw, "
        "CASE WHEN dl > 0 THEN tf::double / dl ELSE 0 END * ln(n::double / df + 1e-9::double) AS w "
        "FROM q JOIN a_stats USING (term) JOIN a_post USING (term) LEFT JOIN b_len USING (doc_id) CROSS JOIN b_total"
    ),
    "a_dot": _dots("a_parts"),
    "edge": "SELECT DISTINCT doc_id AS src, target_id AS dst FROM anchor",
    "degree": "SELECT src, count(*) AS links FROM edge GROUP BY src",
    "node": "SELECT src AS doc_id FROM edge UNION SELECT dst FROM edge",
    "pr0": "SELECT doc_id, 1::double / (SELECT count(*) FROM node) AS pr FROM node",
    **{f"pr{i}": _rank_step(f"pr{i - 1}") for i in range(1, PAGERANK_STEPS + 1)},
    "visit": (
        "SELECT user_id AS request_id, event_id AS pos, json_extract_string(props, '$.k')::bigint AS doc_id, ts "
        "FROM events WHERE event_type = 'view'"
    ),
    "view": "SELECT doc_id, count(*) AS views FROM visit GROUP BY doc_id",
}

RANKS = f"pr{PAGERANK_STEPS}"


def _merged(title: float, body: float, rank: float, view: float) -> str:
    text = f"coalesce(t_top.score, 0) * {title!r}::double + coalesce(b_top.score, 0) * {body!r}::double"
    boost = f"{rank!r}::double * coalesce(pr, 0) + {view!r}::double * coalesce(views, 0)"
    return (
        f"(SELECT query_id, doc_id, {_half_even(f'{text} + {boost}', 4)} AS score "
        f"FROM t_top FULL JOIN b_top USING (query_id, doc_id) LEFT JOIN {RANKS} USING (doc_id) "
        "LEFT JOIN view USING (doc_id))"
    )


def _with(select: str) -> str:
    """The select after all CTEs it needs; a CTE only refers to earlier ones."""
    words = set(_words(select))
    needed = []
    for name in reversed(CTES):
        if name in words:
            needed.append(name)
            words |= set(_words(CTES[name]))
    # Each CTE is kept once, so that one used twice is computed once.
    ctes = ",\n".join(f"{n} AS MATERIALIZED ({CTES[n]})" for n in reversed(needed))
    return f"WITH {ctes}\n{select}" if needed else select


def _words(sql: str) -> list[str]:
    bare = "".join(c if c.isalnum() or c == "_" else " " for c in sql.replace(STOP, " "))
    return bare.split()


def _crc32(text: str) -> str:
    """CRC-32 of a string, byte by byte over the table of the polynomial EDB88320."""
    octets = (
        f"list_transform(range(1, length(hex(encode({text}))) + 1, 2), "
        f"lambda i: ('0x' || substr(hex(encode({text})), i, 2))::bigint)"
    )
    step = "xor(crc_table.codes[(xor(c, b) & 255) + 1], c >> 8)"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {octets}), lambda c, b: {step}), 4294967295)"


_BIT = "CASE WHEN {0} & 1 = 1 THEN xor({0} >> 1, 3988292384) ELSE {0} >> 1 END"
CRC_TABLE = (
    "crc_table AS MATERIALIZED (SELECT list(code ORDER BY byte) AS codes FROM (SELECT byte, list_reduce("
    "list_prepend(byte::bigint, list_transform(range(8), lambda x: 0::bigint)), "
    f"lambda c, z: {_BIT.format('c')}) AS code FROM range(256) AS t(byte)))"
)


def _evaluate_k10() -> str:
    """Metrics at 10; the flat average precision stays the precision at 40, if there is a hit up to 10."""
    at_40 = _with("SELECT query_id, precision_at_k AS flat FROM metric")
    at_10 = _with("SELECT * FROM metric").replace("rank <= 40", "rank <= 10").replace("::double / 40 AS pk", "::double / 10 AS pk")
    flat = "CASE WHEN precision_at_k > 0 THEN flat ELSE 0 END AS avg_precision_flat"
    metrics = f"SELECT query_id, * REPLACE ({flat}) FROM ({at_10}) JOIN ({at_40}) USING (query_id)"
    rounded = ", ".join(f"{_half_even(m, 6)} AS {m}" for m in METRICS)
    return f"SELECT query_id, {rounded} FROM ({metrics.replace('SELECT query_id, * REPLACE', 'SELECT * EXCLUDE (flat) REPLACE')})"


def _search_eval() -> str:
    """The metrics with the combined search as results and pages as documents."""
    found = _top(_merged(0.3, 0.7, 0.15, 0.15), 40)
    judged = CTES["qrel"].replace("JOIN post", "JOIN b_post")
    metrics = "SELECT query_id, " + ", ".join(f"{_half_even(m, 6)} AS {m}" for m in METRICS) + " FROM metric"
    inputs = _with(f"{found} /* b_post */").removesuffix(f"{found} /* b_post */").strip().removesuffix(",")
    parts = {"result": found, "qrel": judged} | {name: CTES[name] for name in ("hit", "size", "found", "share", "scored", "metric")}
    return inputs + ",\n" + ",\n".join(f"{n} AS MATERIALIZED ({sql})" for n, sql in parts.items()) + "\n" + metrics


def _with_buckets(num_buckets: int, select: str) -> str:
    bucket = f"SELECT term, df, ({_crc32('term')} % {num_buckets})::int AS bucket FROM stats, crc_table"
    whole = _with(f"{select} /* stats */")
    return whole.replace("\n" + select, f",\n{CRC_TABLE},\nbucketed AS MATERIALIZED ({bucket})\n{select}")


def _converged(steps: int) -> str:
    """Ranks after so many full steps."""
    base = _with("SELECT doc_id, pr FROM pr0 /* edge degree node */").removesuffix("SELECT doc_id, pr FROM pr0 /* edge degree node */").strip()
    chain = [f"pr{i} AS MATERIALIZED ({_rank_step(f'pr{i - 1}')})" for i in range(1, steps + 1)]
    return base + ",\n" + ",\n".join(chain) + f"\nSELECT doc_id, {_half_even('pr', 6)} AS pr FROM pr{steps}"


def _metric(name: str) -> str:
    return _with(f"SELECT query_id, {_half_even(name, 6)} AS {name} FROM metric")


BLOCK = 65536

ORACLE: dict[str, str] = {
    "corpus_scan": "SELECT * FROM documents",
    "project_body": _with("SELECT doc_id, body FROM page"),
    "project_title": _with("SELECT doc_id, title FROM page"),
    "project_anchor": _with("SELECT doc_id, href, text FROM link"),
    "fields_unpivot": _with(
        "SELECT doc_id, 'title' AS field, title AS text FROM page UNION ALL SELECT doc_id, 'body', body FROM page"
    ),
    "select_docs": _with("SELECT doc_id, body, lang FROM docs WHERE doc_id IN (SELECT doc_id FROM labels)"),
    "qrels_load": _with("SELECT text AS query_text, doc_id FROM qrel JOIN q_raw USING (query_id)"),
    "pagerank_csv": _with(f"SELECT doc_id, {_half_even('pr', 8)} AS pr FROM {RANKS}"),
    "anchor_roundtrip": _with("SELECT doc_id, target_id, text FROM anchor"),
    "index_rebuild": _with("SELECT term, df, cf FROM stats"),
    "posting_lists": _with(
        f"SELECT term, doc_id // {BLOCK} AS block, string_agg(doc_id || ':' || tf, ' ' ORDER BY doc_id) AS postings "
        "FROM post GROUP BY ALL"
    ),
    "posting_lists_equal": _with(
        "SELECT term, (place * blocks // df)::bigint AS block, string_agg(id || ':' || tf, ' ' ORDER BY id) AS postings "
        "FROM (SELECT *, doc_id * 65536000003 AS id, (df + 49) // 50 AS blocks, "
        "row_number() OVER (PARTITION BY term ORDER BY doc_id) - 1 AS place FROM post JOIN stats USING (term)) GROUP BY ALL"
    ),
    "term_lookup": _with("SELECT query_id, term, doc_id, tf FROM q JOIN post USING (term)"),
    "tokenize": _with(
        "SELECT doc_id, (unnest(range(len(t))))::int AS pos, unnest(t) AS term FROM "
        f"(SELECT doc_id, regexp_extract_all(lower(body), {TOKEN}) AS t FROM docs)"
    ),
    "stop_filter": _with(
        f"SELECT doc_id, term FROM (SELECT doc_id, {_tokens('body')} AS term FROM docs) WHERE term NOT IN {STOP}"
    ),
    "lemma_tf": _with(f"SELECT lemma AS term, doc_id, tf FROM lemma_post WHERE lemma NOT IN {STOP}"),
    "lemma_binary_tf": _with(
        f"SELECT lemma AS term, doc_id, 1::bigint AS tf FROM lemma_post WHERE lemma NOT IN {STOP}"
    ),
    "extract_dates": (
        f"SELECT o_orderkey, unnest(regexp_extract_all(strftime(o_orderdate, '%-d %B %Y or %B %-d, %Y at noon'), "
        f"{_text(f'(?i)(?:{DATE})')})) AS date FROM orders"
    ),
    "extract_times": (
        f"SELECT event_id, unnest(regexp_extract_all(strftime(ts, 'seen %-H:%M:%S or %-I.%MPM today'), "
        f"{_text(f'(?i)(?:{TIME})')})) AS time FROM events"
    ),
    "typed_tokens": TYPED_TOKENS,
    "token_class_counts": TOKEN_CLASS_COUNTS,
    "term_freq": _with("SELECT term, doc_id, tf FROM post"),
    "doc_freq": _with("SELECT term, df FROM stats"),
    "coll_freq": _with("SELECT term, cf FROM stats"),
    "min_df_postings": _with("SELECT term, doc_id, tf FROM post JOIN stats USING (term) WHERE df > 50"),
    "corpus_stats": _with(f"SELECT n, total_len, {_half_even('avg_dl', 6)} AS avg_dl FROM total"),
    "doc_lengths": _with("SELECT doc_id, dl FROM len"),
    "doc_norms": _with(
        f"SELECT doc_id, {_half_even('norm', 6)} AS norm, {_half_even('weight_norm', 6)} AS weight_norm FROM norm"
    ),
    "norms_after_append": _with(
        f"SELECT doc_id, {_half_even('norm', 6)} AS norm, {_half_even('weight_norm', 6)} AS weight_norm FROM norm"
    ),
    "index_append": _with("SELECT term, df, cf, n, total_len FROM stats CROSS JOIN total"),
    "index_append_tokens": _with("SELECT term, doc_id, tf, dl FROM post JOIN len USING (doc_id)"),
    "index_append_three_fields": _with(
        "SELECT 'title' AS field, term, doc_id, tf, dl, df, cf FROM t_post JOIN t_stats USING (term) JOIN b_len USING (doc_id) "
        "UNION ALL SELECT 'body', term, doc_id, tf, dl, df, cf FROM b_post JOIN b_stats USING (term) JOIN b_len USING (doc_id) "
        "UNION ALL SELECT 'anchor', term, doc_id, tf, NULL::bigint, df, cf FROM a_post JOIN a_stats USING (term)"
    ),
    "index_compact": _with(
        "SELECT 'body' AS field, term, doc_id, tf, dl, df, cf, 1::bigint AS batches "
        "FROM post JOIN stats USING (term) JOIN len USING (doc_id)"
    ),
    "index_append_min_df": _with(
        "SELECT term, doc_id, tf, dl FROM post JOIN len USING (doc_id) JOIN stats USING (term) WHERE df > 50"
    ),
    "query_tf": _with("SELECT query_id, term, qtf, qlen FROM q"),
    "sparse_rows": _with(
        f"SELECT doc_id, term_idx // {BLOCK} AS block, "
        "string_agg(term_idx || ':' || tf, ' ' ORDER BY term_idx) AS entries "
        "FROM post JOIN column_no USING (term) GROUP BY ALL"
    ),
    "sparse_query": _with("SELECT query_id, term_idx, qtf AS value FROM q JOIN column_no USING (term)"),
    "anchor_postings": _with("SELECT term, doc_id, tf FROM a_post"),
    "title_postings": _with("SELECT term, doc_id, tf FROM t_post"),
    "titles": _with("SELECT doc_id, title FROM page"),
    "tfidf_raw": _with(
        f"SELECT term, doc_id, {_half_even('tf * ln(n::double / df)', 6)} AS weight "
        "FROM post JOIN stats USING (term) CROSS JOIN total"
    ),
    "tfidf_candidates": _with(f"SELECT query_id, doc_id, term, {_half_even('w', 8)} AS weight FROM parts"),
    "query_vec": _with(
        f"SELECT query_id, term, {_half_even('qtf::double / qlen * ln(n::double / df + 1e-9::double)', 8)} AS weight "
        "FROM q JOIN stats USING (term) CROSS JOIN total"
    ),
    "tfidf_dot": _with("SELECT query_id, doc_id, score FROM dot"),
    "tfidf_topk": _with(_top("dot", 3)),
    "title_tfidf_topk": _with(_top("t_dot", 20)),
    "anchor_tfidf_topk": _with(_top("a_dot", 20)),
    "tfidf_cosine": _with(
        _top(
            "(SELECT query_id, doc_id, "
            + _half_even("CASE WHEN size > 0 THEN d / size ELSE 0 END", 5)
            + " AS score FROM (SELECT query_id, doc_id, d, query_norm * weight_norm AS size "
            "FROM (SELECT query_id, doc_id, sum(qw * w) AS d FROM parts GROUP BY ALL) JOIN "
            "(SELECT query_id, sqrt(sum(power(qtf::double / qlen * ln(n::double / df + 1e-9::double), 2))) "
            "AS query_norm FROM q JOIN stats USING (term) CROSS JOIN total GROUP BY query_id) USING (query_id) "
            "JOIN norm USING (doc_id)))",
            100,
        )
    ),
    "bm25_idf": _with(
        f"SELECT term, {_half_even('ln(1 + (n - df + 0.5::double) / (df + 0.5::double))', 6)} AS idf "
        "FROM stats CROSS JOIN total"
    ),
    "candidates": _with("SELECT DISTINCT query_id, doc_id FROM q JOIN post USING (term)"),
    "bm25_scores": _with(_bm25("post", "stats", "len", "total", 1.5, 0.75)),
    "bm25_topk": _with("SELECT query_id, doc_id, score, rank FROM result"),
    "bm25_topk_by_document": _with("SELECT query_id, doc_id, score, rank FROM result"),
    "bm25_topk_pruned": _with(_top("body25", 10)),
    "title_tf_sum": _with(_top(f"({_match('t_post', 'sum(qtf * tf)')})", 100)),
    "title_distinct": _with(_every(f"({_match('t_post', 'count(*)')})")),
    "anchor_postings_stop_table": _with(
        f"SELECT term, doc_id, count(*) AS tf FROM (SELECT target_id AS doc_id, {_tokens('text')} AS term FROM anchor) "
        f"WHERE term NOT IN (SELECT {_tokens('text')} FROM benchmark) GROUP BY ALL"
    ),
    "anchor_tf_sum": _with(_top(f"({_match('a_post', 'sum(qtf * tf)')})", 100)),
    "anchor_distinct": _with(_every(f"({_match('a_post', 'count(*)')})")),
    **{
        f"search_{field}": _with(
            "SELECT query_id, doc_id, score, rank, title FROM "
            f"({_every('(' + _match(postings, 'count(*)') + ')')}) LEFT JOIN page USING (doc_id)"
        )
        for field, postings in (("title", "t_post"), ("anchor", "a_post"))
    },
    "search_body": _with(
        f"SELECT query_id, doc_id, score, rank, title FROM ({_top('b_dot', 100)}) LEFT JOIN page USING (doc_id)"
    ),
    "attach_titles": _with(
        "SELECT query_id, doc_id, score, rank, title FROM "
        f"({_top('(' + _match('a_post', 'sum(qtf * tf)') + ')', 100)}) LEFT JOIN page USING (doc_id)"
    ),
    "merge_ranked": _with(_top(_merged(0.5, 0.5, 0.5, 0.5), 3)),
    "search": _with(
        f"SELECT query_id, doc_id, score, rank, title FROM ({_top(_merged(0.3, 0.7, 0.15, 0.15), 40)}) "
        "LEFT JOIN page USING (doc_id)"
    ),
    "lookup_pagerank": _with(
        f"SELECT request_id, pos, doc_id, {_half_even('pr', 8)} AS pr FROM visit JOIN {RANKS} USING (doc_id) "
        "WHERE pr <> 0"
    ),
    "lookup_pagerank_aligned": _with(
        f"SELECT request_id, pos, doc_id, {_half_even('pr', 8)} AS pr FROM visit LEFT JOIN {RANKS} USING (doc_id)"
    ),
    "lookup_pageviews": _with(
        "SELECT request_id, pos, doc_id, coalesce(views, 0) AS views FROM "
        "(SELECT doc_id AS request_id, target_id AS pos, target_id AS doc_id FROM anchor) "
        "LEFT JOIN view USING (doc_id)"
    ),
    "page_views_of_month": _with(
        "SELECT doc_id, count(*) AS views FROM visit WHERE strftime(ts, '%Y-%m') = '2024-01' GROUP BY doc_id"
    ),
    "page_views_monthly": _with(
        "SELECT doc_id, strftime(ts, '%Y-%m') AS month, count(*) AS views FROM visit GROUP BY ALL"
    ),
    "pagerank": _with(f"SELECT doc_id, {_half_even('pr', 8)} AS pr FROM {RANKS}"),
    "pagerank_converged": _converged(100),
    "rel_intersection": _with("SELECT query_id, doc_id, rank FROM hit"),
    "evaluate": _with(
        "SELECT query_id, " + ", ".join(f"{_half_even(m, 6)} AS {m}" for m in METRICS) + " FROM metric"
    ),
    "evaluate_k10": _evaluate_k10(),
    "search_eval": _search_eval(),
    "evaluate_mean": _with(
        "SELECT " + ", ".join(f"{_half_even(f'avg({m})', 6)} AS {m}" for m in METRICS) + " FROM metric"
    ),
    "batch_eval": _with("SELECT query_id, text, avg_precision FROM metric JOIN q_raw USING (query_id)"),
    **{m: _metric(m) for m in METRICS},
    "term_bucket": _with_buckets(124, "SELECT term, bucket FROM bucketed"),
    "bucket_sizes": _with_buckets(
        NUM_BUCKETS,
        "SELECT bucket, count(*) AS terms, sum(df)::bigint AS postings FROM bucketed GROUP BY bucket",
    ),
    "index_roundtrip": _with_buckets(
        NUM_BUCKETS,
        "SELECT 'body' AS field, bucket, term, doc_id, tf, dl "
        "FROM bucketed JOIN post USING (term) JOIN len USING (doc_id)",
    ),
}
