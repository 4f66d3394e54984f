"""SQL for the catalog's queries, for a DuckDB that has the test tables as views."""

from __future__ import annotations

from ..functions.text import STOPWORDS
from ..operators.robots import DEFAULT_AGENT

_T0 = "TIMESTAMP '2024-01-01 00:00:00'"
_AS_OF = "TIMESTAMP '2024-01-09 00:00:00'"
_SNIPPET = r"'\[.*?\]|[^\x00-\x7F]+| {4}|[\t\n\r]'"
_INDEX = r"'\[.*?\]|[^\x00-\x7F]+| {4}|[\t\n\r]|<[^>]*>'"
_HOST = r"'^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:\s]+)(?::[0-9]*)?(?:[/?#]|$)'"
_STOP = "(" + ", ".join("'" + w.replace("'", "''") + "'" for w in STOPWORDS) + ")"


def _clean(c: str) -> str:
    return f"regexp_replace({c}, {_INDEX}, '', 'g')"


def _snip(c: str) -> str:
    return f"lower(regexp_replace({c}, {_SNIPPET}, '', 'g'))"


def _host(c: str) -> str:
    return f"lower(nullif(regexp_extract({c}, {_HOST}, 1), ''))"


def _path(c: str) -> str:
    return rf"coalesce(nullif(regexp_extract({c}, '^[^:/?#]+://[^/?#]*([^?#]*)', 1), ''), '/')"


def _first_words(c: str, n: int) -> str:
    return f"array_to_string(string_split({c}, ' ')[1:{n}], ' ')"


def _entities(c: str) -> str:
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("lt", "<"), ("gt", ">")):
        c = f"replace({c}, '&{name};', '{char}')"
    return f"regexp_replace({c}, '&amp;?', '&', 'g')"


# --- derived inputs, as in plans.fixtures ------------------------------------------------------------------------------

_CTE = {
    "chunk": """SELECT vec_id AS chunk_id, vec_id // 5 AS doc_id,
        CASE vec_id % 50 WHEN 9 THEN NULL WHEN 7 THEN (vec_id % 5) * 200 + 400 ELSE (vec_id % 5) * 200 END AS chunk_start,
        CASE vec_id % 50 WHEN 9 THEN NULL WHEN 7 THEN (vec_id % 5) * 200 WHEN 11 THEN 10000000
             ELSE (vec_id % 5) * 200 + 400 END AS chunk_end,
        embedding::DOUBLE[] AS embedding FROM embeddings""",
    "chunk_null": "SELECT * REPLACE (CASE WHEN chunk_id % 100 <> 0 THEN doc_id END AS doc_id) FROM chunk",
    "docs": f"""SELECT doc_id, 'http://d/' || doc_id || '/' AS url, text AS content,
        CASE WHEN doc_id % 4 = 0 THEN '' ELSE {_first_words('text', 3)} END AS title FROM documents""",
    "qv": f"""SELECT e.vec_id AS query_id, {_first_words('d.text', 5)} AS query, e.embedding::DOUBLE[] AS vector
        FROM embeddings e JOIN documents d ON d.doc_id = e.vec_id WHERE e.vec_id < 5""",
    "scored": """SELECT query_id, chunk_id, doc_id, chunk_start, chunk_end,
        list_cosine_similarity(embedding, vector) AS s FROM chunk, qv WHERE doc_id IS NOT NULL""",
    "best": """SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY query_id, doc_id ORDER BY s DESC, chunk_id) = 1""",
    "ranked": """SELECT b.*, row_number() OVER (PARTITION BY query_id ORDER BY s DESC, chunk_id) AS rank
        FROM best b WHERE doc_id IN (SELECT doc_id FROM docs)""",
    "hits": """SELECT r.query_id, r.rank, r.s, d.url, d.title, q.query, d.content,
        coalesce(chunk_start, 0) AS a, coalesce(chunk_end, strlen(d.content) // 4) AS b0
        FROM ranked r JOIN docs d USING (doc_id) JOIN qv q USING (query_id) WHERE rank <= 10""",
    "sliced": """SELECT *, CASE WHEN a > b OR b > length(content) OR a > length(content) THEN ''
            ELSE substring(content, a + 1, b - a) END AS txt, query || ' ' || title AS asked
        FROM (SELECT *, CASE WHEN a > b0 THEN strlen(content) - a ELSE b0 END AS b FROM hits)""",
    "hosts": f"SELECT DISTINCT {_host('url')} AS host FROM pages",
    "sites": """SELECT host, CASE WHEN length(host) % 5 <> 0 THEN 2 + length(host) % 2 END AS depth,
        1.0::DOUBLE / (1 + length(host) % 2) AS interval_s FROM hosts WHERE host LIKE '%.com'""",
    "frontier": f"""SELECT page_id AS url_id, url, {_host('url')} AS host, page_id % 4 AS depth,
        {_T0} + to_minutes((page_id % 60)::INT) AS created_at FROM pages""",
    "visited": f"SELECT url, {_T0} + to_days((page_id % 12)::INT) AS visited_at FROM pages WHERE page_id % 5 = 0",
    "robots": f"""SELECT host, CASE WHEN length(host) % 6 = 5 THEN '' ELSE CASE length(host) % 6
        WHEN 0 THEN 'User-agent: {DEFAULT_AGENT}' || chr(10) || 'Allow: /en/' || chr(10) || 'Disallow: /' || chr(10)
        WHEN 1 THEN '# all' || chr(10) || 'User-agent: *' || chr(10) || 'Disallow: /' || chr(10)
        WHEN 2 THEN 'Disallow: /x' || chr(10) || 'User-agent: {DEFAULT_AGENT}' || chr(13) || chr(10) || 'Disallow:' || chr(13) || chr(10)
        WHEN 3 THEN 'User-agent: a' || chr(10) || 'User-agent: {DEFAULT_AGENT}' || chr(10) || 'Disallow: /fr:8/x' || chr(10) || ' Allow: /' || chr(10)
        WHEN 4 THEN 'user-agent: {DEFAULT_AGENT}' || chr(10) || 'Disallow: /' || chr(10) END END AS body FROM hosts""",
    "robot_lines": """SELECT host, unnest(string_split(body, chr(10))) AS line,
        generate_subscripts(string_split(body, chr(10)), 1) AS pos FROM robots""",
    "rules": """SELECT host, pos, kind, CASE WHEN kind <> 'agent' THEN v END AS prefix,
        coalesce(last_value(CASE WHEN kind = 'agent' THEN v END IGNORE NULLS) OVER (PARTITION BY host ORDER BY pos
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), '*') AS agent
        FROM (SELECT *, CASE WHEN line LIKE 'User-agent:%' THEN 'agent' WHEN line LIKE 'Allow:%' THEN 'allow'
                WHEN line LIKE 'Disallow:%' THEN 'disallow' END AS kind,
                trim(split_part(line, ':', 2), ' ' || chr(13)) AS v FROM robot_lines) WHERE kind IS NOT NULL""",
    "permitted": f"""SELECT f.url_id, coalesce(bool_or(kind = 'allow' AND starts_with(path, prefix)), false)
            OR NOT coalesce(bool_or(kind = 'disallow' AND starts_with(path, prefix)), false) AS allowed
        FROM (SELECT *, {_path('url')} AS path FROM frontier) f
        LEFT JOIN rules r ON r.host = f.host AND r.agent = '{DEFAULT_AGENT}' GROUP BY f.url_id""",
    "judged0": f"""SELECT f.*, s.interval_s, CASE WHEN f.host IS NULL THEN 'No host found'
            WHEN s.host IS NULL THEN 'host not found in configured sites'
            WHEN f.depth >= s.depth THEN 'site depth reached' WHEN NOT p.allowed THEN 'not allowed by robots.txt'
            WHEN f.url IN (SELECT url FROM visited WHERE visited_at + INTERVAL 7 DAYS > {_AS_OF}) THEN 'url exists in redis'
            ELSE 'all checks passed' END AS reason
        FROM frontier f LEFT JOIN sites s USING (host) JOIN permitted p USING (url_id)""",
    "judged_fresh": """SELECT f.*, f.depth < coalesce(s.depth, 99) AND p.allowed AS ok,
            CASE WHEN f.depth >= s.depth THEN 'site depth reached' WHEN NOT p.allowed THEN 'not allowed by robots.txt' END AS reason
        FROM frontier f LEFT JOIN sites s USING (host) JOIN permitted p USING (url_id)""",
    "judged": """SELECT url_id, url, CASE WHEN reason = 'all checks passed' AND interval_s * row_number() OVER
            (PARTITION BY host, reason ORDER BY created_at, url_id) > 1.0 THEN 'rate limit exceeded' ELSE reason END AS reason
        FROM judged0""",
    "taken": """SELECT f.* FROM frontier f WHERE host IN (SELECT host FROM sites)
        QUALIFY row_number() OVER (PARTITION BY host ORDER BY created_at, url_id) <= 3""",
    "hrefs": """SELECT page_id, url, unnest(h) AS href, generate_subscripts(h, 1) - 1 AS pos
        FROM (SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS h FROM pages)""",
    "links": """SELECT page_id, pos, regexp_extract(url, '^[a-z]+://[^/?#]*') || array_to_string(list_transform(
            string_split(href, ''), lambda c: CASE WHEN c > chr(127) THEN url_encode(c) ELSE c END), '') AS url,
        page_id % 3 + 1 AS depth FROM hrefs""",
    "linked": f"SELECT *, {_host('url')} AS host FROM links",
    "bare": r"""SELECT page_id, url, regexp_replace(regexp_replace(html, '<script\b[^>]*>.*?</script\s*>', '<x>', 'gs'),
        '<style\b[^>]*>.*?</style\s*>', '<x>', 'gs') AS h FROM pages""",
    "page_nodes": r"""SELECT page_id, url, regexp_extract(h, '<title>(.*?)</title>', 1, 's') AS t,
        array_to_string(list_filter(regexp_split_to_array(regexp_replace(regexp_replace(
            regexp_extract(h, '<body[^>]*>(.*)$', 1, 's'), '<[^<>]*$', ''), '</(?:body|html)>', '', 'g'),
            '(?s)<!--.*?-->|<[^>]*>'), lambda s: s <> ''), ' ') AS body FROM bare""",
    "page_docs": f"""SELECT page_id, url, {_entities('t')} AS title,
        {_clean(_entities("t || ' ' || body"))} AS content FROM page_nodes""",
    "clean_docs": f"SELECT doc_id, {_clean('text')} AS content FROM documents",
    "pieces": r"""SELECT doc_id, unnest(p) AS piece, generate_subscripts(p, 1) AS pos FROM (SELECT doc_id,
        regexp_extract_all(content, '[ \t\n\v\f\r]*(?:[A-Za-z0-9_]+|[^A-Za-z0-9_ \t\n\v\f\r])') AS p FROM clean_docs)""",
    "spans0": r"""SELECT doc_id, pos, ltrim(piece, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS token,
        sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY pos)::BIGINT AS end_at FROM pieces""",
    "n_tok": """SELECT d.doc_id, count(p.doc_id) + 2 AS n FROM clean_docs d LEFT JOIN pieces p USING (doc_id)
        WHERE content <> '' GROUP BY d.doc_id""",
    "tokens": """SELECT doc_id, pos, token, end_at - length(token) AS start_at, end_at FROM spans0
        UNION ALL SELECT doc_id, 0, '[CLS]', 0, 0 FROM clean_docs
        UNION ALL SELECT doc_id, coalesce(n, 0) + 1, '[SEP]', 0, 0 FROM clean_docs
            LEFT JOIN (SELECT doc_id, count(*) AS n FROM pieces GROUP BY doc_id) USING (doc_id)""",
    "windows": """SELECT doc_id, n, k AS chunk_no, 460 * k AS tok_start, least(460 * (k + 1), n) AS tok_end
        FROM (SELECT doc_id, n, unnest(range(0, (n + 459) // 460)) AS k FROM n_tok)""",
    "doc_toks": """SELECT doc_id, list(token ORDER BY pos) AS toks, list(end_at - length(token) ORDER BY pos) AS starts,
        list(end_at ORDER BY pos) AS ends FROM spans0 GROUP BY doc_id""",
    "spans": """SELECT w.*, coalesce(list_concat([0], starts, [0]), [0, 0])[tok_start + 1] AS chunk_start,
        coalesce(list_concat([0], ends, [0]), [0, 0])[tok_end - 1] AS chunk_end,
        list_concat(['[CLS]'], coalesce(toks, []), ['[SEP]'])[tok_start + 1:input_end] AS input
        FROM (SELECT *, CASE WHEN tok_end + 52 < n THEN tok_end + 52 ELSE tok_end END AS input_end FROM windows) w
        LEFT JOIN doc_toks USING (doc_id)""",
    "asked": f"""SELECT doc_id, content, {_first_words('content', 5)} || ' ' || title AS asked FROM docs""",
    "word": rf"""SELECT doc_id, asked, unnest(ws) AS w, generate_subscripts(ws, 1) - 1 AS i FROM (SELECT doc_id, lower(asked) AS asked,
        regexp_extract_all({_snip('content')}, '[^ \t\n\v\f\r]+') AS ws FROM asked)""",
    "keys": f"""SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS before FROM word
        WHERE w NOT IN {_STOP} AND contains(asked, w)""",
    "gaps": "SELECT doc_id, i, CASE WHEN before IS NULL OR before = 0 THEN 0 ELSE i - before END AS gap FROM keys",
    "ranges": f"""SELECT a.doc_id, a.content, len(ws) AS n_words, ws,
            CASE WHEN len(ws) > 100 AND e IS NOT NULL THEN s END AS a0, CASE WHEN len(ws) > 100 THEN e END AS e0
        FROM (SELECT doc_id, content, regexp_extract_all({_snip('content')}, '[^ \\t\\n\\v\\f\\r]+') AS ws FROM asked) a
        LEFT JOIN (SELECT doc_id, min(i) AS s FROM gaps GROUP BY doc_id) f USING (doc_id)
        LEFT JOIN (SELECT g.doc_id, arg_max(g.i, (g.gap, g.i)) AS e FROM gaps g
            JOIN (SELECT doc_id, min(i) AS s FROM gaps GROUP BY doc_id) f ON f.doc_id = g.doc_id AND g.i > f.s + 100
            GROUP BY g.doc_id) l USING (doc_id)""",
    "kv": f"""SELECT user_id AS key, CASE WHEN event_type = 'error' THEN 'del' ELSE 'set' END AS op, event_id AS seq,
        ts + to_milliseconds(event_id % 10 * 100) AS ts, CASE WHEN event_type = 'view' THEN 604800 END AS ttl_s, value FROM events WHERE ts + to_milliseconds(event_id % 10 * 100) <= {_AS_OF}""",
    "kv_live": f"""SELECT * FROM (SELECT * FROM kv QUALIFY row_number() OVER (PARTITION BY key ORDER BY ts DESC, seq DESC) = 1)
        WHERE op <> 'del' AND (ttl_s IS NULL OR ts + to_seconds(ttl_s) > {_AS_OF})""",
    "old_docs": f"""SELECT doc_id, 'http://d/' || doc_id AS url, {_first_words('text', 3)} AS title, text AS content
        FROM documents WHERE doc_id % 3 <> 0""",
    "new_docs": f"""SELECT doc_id + 1000000000 AS doc_id, 'http://d/' || doc_id AS url, 'new ' || {_first_words('text', 3)} AS title,
        'v2 ' || text AS content FROM documents WHERE doc_id % 2 = 0""",
    "configs": f"""SELECT page_id, 0 AS pos, url, CASE WHEN page_id % 3 <> 0 THEN page_id % 4 END AS depth,
            CASE WHEN page_id % 5 <> 0 THEN 1 + page_id % 4 END AS rps FROM pages
        UNION ALL SELECT page_id, 1, 'https://' || {_host('url')} || '/', 2, 1 + page_id % 2 FROM pages WHERE page_id % 2 = 0""",
    "taken6": """SELECT f.* FROM judged_fresh f WHERE host IN (SELECT host FROM sites)
        QUALIFY row_number() OVER (PARTITION BY host ORDER BY created_at, url) <= 6""",
    "round0": """SELECT j.*, row_number() OVER (PARTITION BY j.host, j.reason ORDER BY j.created_at, j.url_id) AS slot
        FROM judged0 j JOIN taken t USING (url_id)""",
    "round": """SELECT *, CASE WHEN reason = 'all checks passed' AND slot * interval_s > 1.0 THEN 'late' ELSE reason END AS r FROM round0""",
    "buckets": """SELECT doc_id, ('0x' || substr(md5(lower(token)), 1, 8))::BIGINT % 64 AS bucket, count(*) AS n
        FROM spans0 GROUP BY 1, 2""",
    "inputs": """SELECT doc_id, chunk_no, unnest(list_filter(input, lambda t: t NOT IN ('[CLS]', '[SEP]'))) AS token FROM spans""",
    "slots": """SELECT doc_id, chunk_no, count(*) AS n_slots, sum(b)::BIGINT AS slot_sum,
        sum((b + 1) * (c::DOUBLE / total)::FLOAT::DOUBLE) AS weight FROM (SELECT *, sum(c) OVER (PARTITION BY doc_id, chunk_no) AS total
            FROM (SELECT doc_id, chunk_no, ('0x' || substr(md5(lower(token)), 1, 8))::BIGINT % 64 AS b, count(*) AS c
            FROM inputs GROUP BY ALL)) GROUP BY ALL""",
}

_NEEDS = {
    "chunk_null": ["chunk"], "scored": ["chunk", "qv"], "best": ["scored"], "ranked": ["best", "docs"],
    "hits": ["ranked", "docs", "qv"], "sliced": ["hits"], "sites": ["hosts"], "robots": ["hosts"],
    "robot_lines": ["robots"], "rules": ["robot_lines"], "permitted": ["frontier", "rules"],
    "judged0": ["frontier", "sites", "permitted", "visited"], "judged": ["judged0"], "taken": ["frontier", "sites"],
    "links": ["hrefs"], "linked": ["links"], "page_nodes": ["bare"], "page_docs": ["page_nodes"], "pieces": ["clean_docs"],
    "spans0": ["pieces"], "n_tok": ["clean_docs", "pieces"], "tokens": ["spans0", "pieces", "clean_docs"],
    "windows": ["n_tok"], "doc_toks": ["spans0"], "spans": ["windows", "doc_toks"], "asked": ["docs"], "word": ["asked"], "keys": ["word"],
    "gaps": ["keys"], "ranges": ["asked", "gaps"], "kv_live": ["kv"], "round0": ["judged0", "taken"], "taken6": ["judged_fresh"], "judged_fresh": ["frontier", "sites", "permitted"], "round": ["round0"],
    "buckets": ["spans0"], "inputs": ["spans"], "slots": ["inputs"],
}


def _sql(body: str, *names: str) -> str:
    """``body`` with the named derived inputs, and what these need, put before it."""
    seen: list[str] = []

    def add(name: str) -> None:
        for other in _NEEDS.get(name, []):
            add(other)
        if name not in seen:
            seen.append(name)

    for n in names:
        add(n)
    head = ",\n".join(f"{n} AS ({_CTE[n]})" for n in seen)
    return f"WITH {head}\n{body}" if seen else body


def _snippet_of(hits: str, keep: str) -> str:
    """Summaries of ``sliced`` rows with list functions only."""
    return rf"""SELECT {keep}, CASE WHEN e0 IS NOT NULL THEN array_to_string(ws[s0 + 1:e0], ' ') ELSE txt END AS summary
    FROM (SELECT *, CASE WHEN len(ws) > 100 THEN list_sort(list_filter(gs, lambda g: g.i > s0 + 100))[-1].i END AS e0
    FROM (SELECT *, ks[1] AS s0, list_transform(ks, lambda k, j: {{'gap': CASE WHEN j = 1 OR ks[j - 1] = 0 THEN 0
            ELSE k - ks[j - 1] END, 'i': k}}) AS gs
    FROM (SELECT *, list_filter(list_transform(ws, lambda w, j: CASE WHEN w NOT IN {_STOP} AND contains(lower(asked), w)
            THEN j - 1 END), lambda k: k IS NOT NULL) AS ks
    FROM (SELECT *, regexp_extract_all({_snip('txt')}, '[^ \t\n\v\f\r]+') AS ws FROM {hits}))))"""


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    top = "SELECT chunk_id, doc_id, url, round(s, 6) AS similarity FROM ranked JOIN docs USING (doc_id) WHERE query_id = 0"
    q["search_topk"] = _sql(f"{top} AND rank <= 10", "ranked")
    q["search_page2"] = _sql(f"{top} AND rank > 10 AND rank <= 20", "ranked")
    q["best_chunk_per_doc"] = _sql(
        "SELECT doc_id, chunk_id, round(s, 6) AS similarity FROM best WHERE query_id = 0", "best")
    q["search_batch"] = _sql(
        "SELECT query_id, rank, chunk_id, round(s, 6) AS similarity FROM ranked WHERE rank <= 10", "ranked")
    q["search_many"] = _sql("""SELECT query_id, rank, doc_id, round(s, 6) AS similarity FROM (SELECT *,
            row_number() OVER (PARTITION BY query_id ORDER BY s DESC, chunk_id) AS rank FROM (SELECT query_id, chunk_id, doc_id, s
            FROM (SELECT q.vec_id AS query_id, c.chunk_id, c.doc_id, list_cosine_similarity(c.embedding, q.embedding::DOUBLE[]) AS s
                FROM chunk c, embeddings q WHERE c.doc_id IN (SELECT doc_id FROM docs))
            QUALIFY row_number() OVER (PARTITION BY query_id, doc_id ORDER BY s DESC, chunk_id) = 1)) WHERE rank <= 3""", "chunk", "docs")
    q["cosine_similarity"] = """SELECT vec_id, round(list_cosine_similarity(embedding::DOUBLE[],
        (SELECT embedding::DOUBLE[] FROM embeddings WHERE vec_id = 0)), 6) AS similarity FROM embeddings"""
    results = _snippet_of("sliced", "query_id, rank, url, round(s, 6) AS score, title")
    q["search_results"] = _sql(results, "sliced")
    q["search_own_pages"] = _sql("""SELECT query_id, rank, url, round(s, 6) AS score FROM ranked JOIN docs USING (doc_id)
        WHERE rank > query_id * 2 AND rank <= query_id * 3 + 3""", "ranked")
    q["result_cards"] = _sql(f"""SELECT query_id, rank, regexp_replace(url, '/$', '') AS url,
        array_to_string(string_split(summary, ' ')[1:150], ' ') AS summary,
        CASE WHEN title = '' THEN regexp_replace(url, '/$', '') ELSE title END AS title FROM ({results})""", "sliced")
    q["result_json"] = _sql(f"SELECT url, score, summary, title FROM ({results}) WHERE query_id = 0", "sliced")
    q["snippet_range"] = _sql(
        "SELECT doc_id, a0 AS snippet_start, e0 AS snippet_end, n_words FROM ranges", "ranges")
    q["snippet_text"] = _sql("""SELECT doc_id, CASE WHEN e0 IS NOT NULL THEN array_to_string(ws[a0 + 1:e0], ' ')
        ELSE content END AS summary FROM ranges""", "ranges")
    q["keyword_gaps"] = _sql("SELECT doc_id, i AS pos, gap FROM gaps", "gaps")
    q["chunk_text_slice"] = _sql("""SELECT chunk_id, a AS chunk_start, b0 AS chunk_end,
        CASE WHEN a > b OR b > length(content) OR a > length(content) THEN '' ELSE substring(content, a + 1, b - a) END AS text
        FROM (SELECT *, CASE WHEN a > b0 THEN strlen(content) - a ELSE b0 END AS b FROM (SELECT chunk_id, content,
            coalesce(chunk_start, 0) AS a, coalesce(chunk_end, strlen(content) // 4) AS b0 FROM chunk JOIN docs USING (doc_id)))""",
        "chunk", "docs")
    q["search_requests"] = rf"""SELECT doc_id, regexp_replace({_first_words('text', 5)}, '\s', '+', 'g') AS param,
        10::BIGINT AS "limit", (doc_id % 4) * 10 AS "offset" FROM documents WHERE doc_id % 9 <> 4 AND {_first_words('text', 5)} <> ''"""

    q["clean_text"] = f"SELECT doc_id, {_clean('text')} AS content FROM documents"
    q["clean_snippet_text"] = f"SELECT doc_id, {_snip('text')} AS content FROM documents"
    word_list = r"regexp_extract_all({}, '[^ \t\n\v\f\r]+')"
    q["word_count"] = f"SELECT doc_id, len({word_list.format(_snip('text'))}) AS n_words FROM documents"
    q["stopword_filter"] = _sql(f"""SELECT doc_id, len(k) AS n_kept, array_to_string(k, ' ') AS kept FROM (SELECT doc_id,
        list_filter({word_list.format('content')}, lambda w: lower(w) NOT IN {_STOP}) AS k FROM clean_docs)""", "clean_docs")

    q["url_parts"] = f"SELECT page_id, {_host('url')} AS host, {_path('url')} AS path FROM pages"
    q["valid_urls"] = f"""SELECT page_id, CASE WHEN page_id % 7 = 3 THEN 'mailto:' || {_host('url')} ELSE url END AS url,
        CASE WHEN page_id % 7 <> 3 THEN {_host('url')} END AS host FROM pages WHERE page_id % 7 NOT IN (1, 2)"""
    q["page_titles"] = _sql("SELECT page_id, title FROM page_docs", "page_docs")
    q["page_text"] = _sql("SELECT page_id, content FROM page_docs", "page_docs")
    q["page_text_malformed"] = q["page_text"]
    q["normal_urls"] = f"""SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'https://' || h || '/%C3%A4' WHEN 1 THEN 'http://' || h || '/'
        WHEN 2 THEN 'https://' || h || '/b#x' END AS url, CASE WHEN page_id % 4 <> 3 THEN h END AS host
        FROM (SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'xn--mller-kva.' ELSE '' END || {_host('url')} AS h FROM pages)"""
    q["page_links"] = _sql("SELECT page_id, pos, href FROM hrefs", "hrefs")
    q["resolved_links"] = _sql("SELECT page_id, pos, url FROM links", "links")
    q["empty_body_rejects"] = _sql(
        "SELECT page_id, title, 'page without body text' AS reason FROM page_docs WHERE page_id % 10 = 0", "page_docs")
    q["invalid_inputs"] = """SELECT doc_id, CASE WHEN doc_id % 11 = 0 THEN 'empty id' WHEN doc_id % 7 = 0 THEN 'empty text'
        WHEN doc_id % 13 = 0 THEN 'document not found' ELSE 'empty text' END AS reason FROM documents
        WHERE doc_id % 11 = 0 OR doc_id % 7 = 0 OR doc_id % 13 = 0 OR text = ''"""
    q["links_in_scope"] = _sql(
        "SELECT page_id, pos, url, host, depth FROM linked WHERE host IN (SELECT host FROM sites)", "linked", "sites")
    q["links_out_of_scope"] = _sql(
        "SELECT page_id, pos, url, host, depth FROM linked WHERE host NOT IN (SELECT host FROM sites)", "linked", "sites")
    new_id = (
        "to_base(epoch_ms({ts}), 32, 10) || to_base(('0x' || substr(sha256({key}), 1, 10))::BIGINT, 32, 8)"
        " || to_base(('0x' || substr(sha256({key}), 11, 10))::BIGINT, 32, 8)"
    )
    q["message_roundtrip"] = f"""SELECT {new_id.format(ts=_T0, key='url')} AS id, url, page_id % 4 AS depth,
        md5(html) AS content_md5 FROM pages"""
    q["row_ids"] = _sql(f"SELECT url_id, {new_id.format(ts='created_at', key='url')} AS id FROM frontier", "frontier")

    q["load_sites"] = _sql(f"""SELECT {_host('url')} AS host, url, depth, rps, round(CASE WHEN rps IS NULL THEN 0.5
        ELSE 1.0::DOUBLE / rps END, 6) AS interval_s FROM configs
        QUALIFY row_number() OVER (PARTITION BY {_host('url')} ORDER BY page_id DESC, pos DESC) = 1""", "configs")
    q["seed_frontier"] = _sql(f"SELECT url, {_host('url')} AS host, 0::BIGINT AS depth FROM configs", "configs")
    q["robots_targets"] = _sql(f"""SELECT {_host('url')} AS host,
        regexp_extract(url, '^[a-z]+') || '://' || {_host('url')} || '/robots.txt' AS robots_url FROM configs""", "configs")
    q["robots_rules"] = _sql("SELECT host, agent, kind, prefix FROM rules", "rules")
    q["robots_rule_map"] = _sql("""SELECT host, agent,
        coalesce(string_agg(prefix, '|' ORDER BY pos) FILTER (WHERE kind = 'allow'), '') AS allow,
        coalesce(string_agg(prefix, '|' ORDER BY pos) FILTER (WHERE kind = 'disallow'), '') AS disallow
        FROM rules GROUP BY host, agent""", "rules")
    q["robots_allowed_prefix"] = q["robots_allowed"] = _sql("SELECT url_id, allowed FROM permitted", "permitted")
    q["robots_allowed_options"] = _sql(f"""SELECT f.url_id, coalesce(bool_or(kind = 'allow' AND starts_with(path, prefix)), false)
            OR NOT coalesce(bool_or(kind = 'disallow' AND prefix <> '' AND starts_with(path, prefix)), false) AS allowed
        FROM (SELECT *, {_path('url')} AS path FROM frontier) f
        LEFT JOIN (SELECT *, bool_or(agent = '{DEFAULT_AGENT}') OVER (PARTITION BY host) AS own FROM rules) r
            ON r.host = f.host AND r.agent = CASE WHEN own THEN '{DEFAULT_AGENT}' ELSE '*' END
        GROUP BY f.url_id""", "frontier", "rules")
    absent = "SELECT url, any_value(host) AS host, min(depth) AS depth FROM linked WHERE url NOT IN (SELECT url FROM frontier) GROUP BY url"
    q["enqueue_if_absent"] = _sql(absent, "linked", "frontier")
    q["write_counts"] = _sql(f"""SELECT 'save_links' AS stage, (SELECT count(*) FROM linked) AS rows_offered,
        (SELECT count(*) FROM ({absent})) AS rows_written""", "linked", "frontier")
    q["dequeue_batch"] = _sql("SELECT url_id, url, host, depth FROM taken", "taken")
    q["frontier_remaining"] = _sql(
        "SELECT url_id, host FROM frontier WHERE url_id NOT IN (SELECT url_id FROM taken)", "taken")
    q["requeue"] = _sql("""SELECT url_id, host FROM frontier WHERE url_id NOT IN (SELECT url_id FROM taken)
        UNION ALL SELECT url_id, host FROM taken WHERE url_id % 2 = 0""", "taken")
    q["refill_queue"] = _sql("""SELECT 'short' AS held, url_id FROM taken
        UNION ALL SELECT 'full', url_id FROM frontier WHERE url_id NOT IN (SELECT url_id FROM taken)""", "taken")
    q["visited_filter"] = _sql(f"""SELECT url_id, url FROM frontier WHERE url NOT IN (SELECT url FROM visited
        WHERE visited_at + INTERVAL 7 DAYS > {_AS_OF})""", "frontier", "visited")
    q["admission"] = _sql("SELECT url_id, reason = 'all checks passed' AS ok, reason FROM judged", "judged")
    q["admission_no_rate"] = _sql("SELECT url_id, reason = 'all checks passed' AS ok, reason FROM judged0", "judged0")
    q["content_type_gate"] = """SELECT url, 'page' AS output FROM pages WHERE page_id % 5 IN (0, 1)
        UNION ALL SELECT url, 'visited' FROM pages WHERE page_id % 5 IN (0, 1, 2, 3)
        UNION ALL SELECT url, 'error' FROM pages WHERE page_id % 5 = 4"""
    q["pace_schedule"] = _sql(f"""SELECT url_id, host, (epoch_ms({_T0}) + 1000 * interval_s * row_number() OVER
        (PARTITION BY host ORDER BY created_at, url_id))::BIGINT AS fetch_ms FROM frontier JOIN sites USING (host)""",
        "frontier", "sites")
    answered = "r = 'all checks passed' AND length(url) % 4 <> 0"
    q["crawl_round"] = _sql(f"""SELECT 'judged' AS output, url FROM round
        UNION ALL SELECT 'message', url FROM round WHERE {answered} AND url_id % 5 IN (0, 1)
        UNION ALL SELECT 'visit', url FROM round WHERE {answered} AND url_id % 5 <> 4
        UNION ALL SELECT 'error', url FROM round WHERE {answered} AND url_id % 5 = 4
        UNION ALL SELECT 'failed', url FROM round WHERE r = 'all checks passed' AND length(url) % 4 = 0
        UNION ALL SELECT 'frontier', url FROM frontier WHERE url_id NOT IN (SELECT url_id FROM round WHERE r <> 'late')""", "round")

    q["kv_latest"] = _sql("SELECT key, seq, round(value, 6) AS value FROM kv_live", "kv_live")
    keys = "(SELECT DISTINCT user_id * 2 AS key FROM events)"
    q["kv_get"] = _sql(f"SELECT key, seq, round(value, 6) AS value FROM {keys} LEFT JOIN kv_live USING (key)", "kv_live")
    q["kv_exists"] = _sql(f"SELECT key FROM {keys} WHERE key IN (SELECT key FROM kv_live)", "kv_live")
    q["payload_lookup"] = "SELECT event_id AS id, event_id % 20 BETWEEN 3 AND 12 AS found FROM events"
    q["document_lookup"] = """SELECT a.doc_id * 2 AS doc_id, CASE WHEN d.doc_id IS NULL THEN 'no document found'
        WHEN d.doc_id % 10 = 7 THEN 'document without content' ELSE 'found' END AS outcome
        FROM documents a LEFT JOIN documents d ON d.doc_id = a.doc_id * 2"""
    upsert = """SELECT coalesce(o.doc_id, n.doc_id) AS doc_id, url, coalesce(o.title, n.title) AS title,
        md5(CASE WHEN o.doc_id IS NULL THEN n.content WHEN n.doc_id IS NULL THEN o.content ELSE {} END) AS content_md5
        FROM old_docs o FULL JOIN new_docs n USING (url)"""
    q["upsert_documents"] = _sql(upsert.format("n.content"), "old_docs", "new_docs")
    q["upsert_documents_literal"] = _sql(upsert.format("url"), "old_docs", "new_docs")
    q["upsert_returned_ids"] = _sql(
        "SELECT url, coalesce(o.doc_id, n.doc_id) AS doc_id FROM new_docs n LEFT JOIN old_docs o USING (url)", "old_docs", "new_docs")
    q["missing_documents"] = _sql(
        "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM chunk) GROUP BY doc_id", "chunk")
    q["missing_documents_null"] = _sql(
        "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM chunk_null) GROUP BY doc_id", "chunk_null")
    q["missing_documents_null_safe"] = _sql("""SELECT doc_id FROM documents
        WHERE doc_id NOT IN (SELECT doc_id FROM chunk_null WHERE doc_id IS NOT NULL) GROUP BY doc_id""", "chunk_null")
    q["orphan_chunks"] = _sql("SELECT chunk_id, doc_id FROM chunk_null WHERE doc_id % 10 = 3", "chunk_null")
    q["cascade_delete"] = _sql("""SELECT 'document' AS kind, doc_id AS id FROM documents WHERE doc_id % 10 <> 3
        UNION ALL SELECT 'chunk', chunk_id FROM chunk WHERE doc_id % 10 <> 3""", "chunk")
    q["table_lifecycle"] = _sql("""SELECT DISTINCT 'frontier' AS name, host AS id, url AS detail FROM linked
        UNION ALL SELECT 'documents', doc_id::VARCHAR, md5(text) FROM documents WHERE doc_id <> 3
        UNION ALL SELECT 'chunks', chunk_id::VARCHAR, doc_id::VARCHAR FROM chunk WHERE doc_id <> 3""", "linked", "chunk")
    q["parse_pages"] = _sql(f"""SELECT 'document' AS kind, url, md5(content) AS detail FROM page_docs
        UNION ALL SELECT 'link', url, min(depth)::VARCHAR FROM linked WHERE host IN (SELECT host FROM sites)
            AND url NOT IN (SELECT url FROM frontier) GROUP BY url""", "page_docs", "linked", "sites", "frontier")

    q["token_counts"] = _sql("""SELECT d.doc_id, count(p.doc_id) + 2 AS n_tokens FROM clean_docs d LEFT JOIN pieces p
        USING (doc_id) GROUP BY d.doc_id""", "clean_docs", "pieces")
    q["length_check"] = _sql(
        "SELECT doc_id, n || ' tokens, the model takes 512' AS reason FROM n_tok WHERE n > 512", "n_tok")
    q["truncate_tokens"] = _sql("""SELECT d.doc_id, count(s.token) AS n_kept,
        md5(coalesce(string_agg(s.token, ' ' ORDER BY s.pos), '')) AS kept_md5
        FROM clean_docs d LEFT JOIN spans0 s ON s.doc_id = d.doc_id AND s.pos <= 510 GROUP BY d.doc_id""", "clean_docs", "spans0")
    q["token_offsets"] = _sql("SELECT doc_id, pos, token, start_at, end_at FROM tokens", "tokens")
    q["chunk_windows"] = _sql("""SELECT doc_id, chunk_no, tok_start, tok_end, input_end, chunk_start, chunk_end,
        md5(array_to_string(input, ' ')) AS input_md5 FROM spans""", "spans")
    q["chunk_spans"] = _sql("SELECT doc_id, chunk_no, chunk_start, chunk_end FROM spans", "spans")
    norm = "sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[]))"
    q["l2_norm"] = f"SELECT vec_id, round({norm}, 6) AS norm FROM embeddings"
    flat = "SELECT {key}, unnest({v}) AS x, generate_subscripts({v}, 1) - 1 AS pos FROM {src}"
    q["l2_normalize"] = f"""SELECT vec_id, pos, round(x / n, 6) AS x FROM (SELECT vec_id, {norm} AS n, unnest(embedding)::DOUBLE AS x,
        generate_subscripts(embedding, 1) - 1 AS pos FROM embeddings)"""
    q["mean_pool"] = f"""SELECT label, pos, round(avg(x::DOUBLE), 6) AS x FROM
        ({flat.format(key='label', v='embedding', src='embeddings')}) GROUP BY label, pos"""
    q["cls_pool"] = f"""SELECT label, pos, round(x::DOUBLE, 6) AS x FROM ({flat.format(key='label', v='v',
        src='(SELECT label, arg_min(embedding, vec_id) AS v FROM embeddings GROUP BY label)')})"""
    q["hash_embed_docs"] = _sql("SELECT doc_id, bucket AS pos, n AS n_tokens FROM buckets", "buckets")
    q["hash_embed_first"] = _sql("""SELECT doc_id, ('0x' || substr(md5(lower(coalesce(token, '[sep]'))), 1, 8))::BIGINT % 32 AS pos,
        1.0::DOUBLE AS x FROM clean_docs LEFT JOIN (SELECT doc_id, token FROM spans0 WHERE pos = 1) USING (doc_id)
        WHERE content <> ''""", "clean_docs", "spans0")
    q["embed_queries"] = f"""SELECT doc_id, CASE WHEN ok THEN 1.0::DOUBLE END AS norm, CASE WHEN ok THEN 'ok' ELSE 'empty text' END
        AS reason FROM (SELECT doc_id, doc_id % 9 <> 4 AND {_first_words(_clean('text'), 5)} <> '' AS ok FROM documents)"""
    q["index_documents"] = _sql("""SELECT s.doc_id, chunk_start, chunk_end, coalesce(n_slots, 1) AS n_slots,
        coalesce(slot_sum, ('0x' || substr(md5('[sep]'), 1, 8))::BIGINT % 64) AS slot_sum,
        round(coalesce(weight, ('0x' || substr(md5('[sep]'), 1, 8))::BIGINT % 64 + 1), 6) AS weight
        FROM spans s LEFT JOIN slots USING (doc_id, chunk_no)""", "spans", "slots")
    q["collect_arrays"] = _sql("""SELECT doc_id, string_agg(chunk_id::VARCHAR, ',' ORDER BY chunk_id) AS chunk_ids,
        coalesce(string_agg(chunk_start::VARCHAR, ',' ORDER BY chunk_id), '') AS starts FROM chunk GROUP BY doc_id""", "chunk")
    q["unnest_zip"] = _sql("SELECT doc_id, chunk_id, chunk_start, chunk_end FROM chunk", "chunk")

    q["queue_roundtrip"] = "SELECT event_id::VARCHAR AS id, epoch_us(ts) AS event_us FROM events"
    q["stream_visited_dedup"] = "SELECT DISTINCT user_id AS url FROM events"
    chain = """WITH RECURSIVE e AS (SELECT user_id, ts, event_id, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n
            FROM events),
        kept AS (SELECT user_id, ts, event_id, n FROM e WHERE n = 1
            UNION ALL SELECT k.user_id, x.ts, x.event_id, x.n FROM kept k, LATERAL (SELECT ts, event_id, n FROM e
                WHERE e.user_id = k.user_id AND e.ts {op} k.ts + INTERVAL {span} ORDER BY n LIMIT 1) x)
        """
    q["stream_first_visit"] = chain.format(op=">=", span="7 DAYS") + "SELECT event_id AS seq FROM kept"
    q["stream_rate_limit"] = chain.format(op=">", span="1 DAY") + """SELECT event_id AS seq,
        event_id IN (SELECT event_id FROM kept) AS accepted FROM events"""
    q["stream_visits_expire"] = chain.format(op=">=", span="7 DAYS") + """SELECT event_id AS seq,
        event_id IN (SELECT event_id FROM kept) AS fresh FROM events"""
    # Row n of a user goes at the latest of all ts + one day for each row from there to n.
    q["stream_paced"] = """SELECT event_id AS seq, n * 86400000000 + max(epoch_us(ts) - n * 86400000000)
            OVER (PARTITION BY user_id ORDER BY n) AS released_us
        FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS n FROM events)"""
    q["stream_payload_join"] = """SELECT event_id AS id, CASE WHEN event_id % 20 BETWEEN 3 AND 12 THEN round(value, 6) END AS value,
        CASE WHEN event_id % 20 NOT BETWEEN 3 AND 12 THEN 'no cached page for the id' END AS reason FROM events"""
    q["stream_payload_hits"] = "SELECT event_id AS id, round(value, 6) AS value FROM events WHERE event_id % 20 BETWEEN 3 AND 12"
    # Every link was asked for, is rejected with the reason, or queues; each answer is a page, a visit, a reject, or held.
    q["stream_crawl"] = _sql("""SELECT 'message' AS output, url FROM taken6 WHERE ok AND url_id % 5 IN (0, 1)
        UNION ALL SELECT 'visit', url FROM taken6 WHERE ok AND url_id % 5 <> 4
        UNION ALL SELECT 'unreadable content type', url FROM taken6 WHERE ok AND url_id % 5 = 4
        UNION ALL SELECT 'not asked for', url FROM taken6 WHERE NOT ok
        UNION ALL SELECT CASE WHEN ok THEN 'asked' ELSE reason END, url FROM taken6
        UNION ALL SELECT o, url FROM frontier, (VALUES ('held'), ('frontier')) x(o) WHERE url_id NOT IN (SELECT url_id FROM taken6)""", "taken6")
    q["stream_parse"] = _sql("""SELECT url, title, content FROM page_docs WHERE page_id % 10 NOT IN (3, 6)
        UNION ALL SELECT CASE WHEN page_id % 10 = 6 THEN 'u' END, NULL, CASE page_id % 10 WHEN 6 THEN 'page without body text' ELSE 'bad message' END
        FROM pages WHERE page_id % 10 IN (3, 6)""", "page_docs")
    q["stream_embed"] = _sql("SELECT doc_id, chunk_start, chunk_end FROM spans", "spans")
    return q
