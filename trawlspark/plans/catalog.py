"""Every operator as a query over the test tables. plans.oracles has the SQL for the same names."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as tx
from ..functions import urls, vectors
from ..functions.ids import new_id
from ..functions.tokens import token_array, token_count, truncate_tokens
from ..operators import arrays, chunks, documents, embed, frontier, kv, pages, robots, search, sites, snippets
from ..session import configure, fresh_dir
from ..sources import messages
from ..sources.queues import read_ids, write_ids
from ..sources.tables import create_tables, drop_tables
from ..streaming import ordered, rules
from ..streaming.stages import StageTables, start_crawl, start_embed, start_parse
from .crawl import crawl_round
from .fixtures import Inputs, as_of, dealt, t0
from .index import index_documents
from .parse import parse_pages
from .search import search_vectors

_QUERIES: dict[str, Callable[[Inputs], DataFrame]] = {}
_NOW = {"availableNow": True}


def _query(f: Callable[[Inputs], DataFrame], name: str | None = None) -> Callable[[Inputs], DataFrame]:
    _QUERIES[name or f.__name__] = f
    return f


def _named(name: str):
    """For queries called like the operator they import."""
    return lambda f: _query(f, name)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(f):
        return lambda spark, sf_dir: f(Inputs(configure(spark), sf_dir))

    return {name: bind(f) for name, f in _QUERIES.items()}


def _long(name: str, alias: str | None = None):
    return F.col(name).cast("bigint").alias(alias or name)


def _r6(c, alias: str):
    return F.round(c, 6).alias(alias)


# --- search -------------------------------------------------------------------------------------------------------


def _top(i: Inputs, limit: int, offset: int) -> DataFrame:
    page = search.top_documents(i.chunks(), i.documents(), i.query_vectors(1), limit, offset)
    hits = search.attach_documents(page, i.documents(), lookup=True)
    return hits.select("chunk_id", "doc_id", "url", _r6("similarity", "similarity"))


@_query
def search_topk(i):
    return _top(i, 10, 0)


@_query
def search_page2(i):
    return _top(i, 10, 10)


@_query
def best_chunk_per_doc(i):
    best = search.best_chunk_per_doc(search.best_candidates(i.chunks(), i.query_vectors(1)))
    return best.select("doc_id", "chunk_id", _r6("similarity", "similarity"))


@_query
def search_batch(i):
    page = search.top_documents(i.chunks(), i.documents(), i.query_vectors(), 10, 0, assume_fk=True)
    return page.select("query_id", _long("rank"), "chunk_id", _r6("similarity", "similarity"))


@_query
def cosine_similarity(i):
    first = F.lit(i.query_vectors(1).first()["vector"])
    return i.table("embeddings").select("vec_id", _r6(vectors.cosine_similarity(F.col("embedding"), first), "similarity"))


@_query
def search_results(i):
    found = search_vectors(i.chunks(), i.documents(), i.query_vectors(), 10, 0, lookup=True)
    return found.select("query_id", _long("rank"), "url", _r6("score", "score"), "summary", "title")


@_query
def search_many(i):
    """Every vector of the table as a query."""
    asked = i.table("embeddings").select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("vector"))
    page = search.top_documents(i.chunks(), i.documents(), asked, 3)
    return page.select("query_id", _long("rank"), "doc_id", _r6("similarity", "similarity"))


@_query
def search_own_pages(i):
    """Requests with their own limit and offset."""
    asked = i.query_vectors().withColumns({"limit": F.col("query_id") + 3, "offset": F.col("query_id") * 2})
    found = search_vectors(i.chunks(), i.documents(), asked, assume_fk=True)
    return found.select("query_id", _long("rank"), "url", _r6("score", "score"))


@_query
def result_cards(i):
    found = search_vectors(i.chunks(), i.documents(), i.query_vectors(), 10, 0)
    return snippets.result_cards(found).select("query_id", _long("rank"), "url", "summary", "title")


def _asked(i: Inputs) -> DataFrame:
    docs = dealt(i.documents(), "doc_id").withColumn("query", F.substring_index("content", " ", 5))
    return docs.withColumn("asked", tx.query_text(F.col("query"), F.col("title")))


@_query
def snippet_range(i):
    ranged = snippets.snippet_ranges(_asked(i), "content", "asked")
    return ranged.select("doc_id", _long("snippet_start"), _long("snippet_end"), F.size("_words").cast("bigint").alias("n_words"))


@_query
def snippet_text(i):
    return snippets.snippet(_asked(i), "content", "asked").select("doc_id", "summary")


@_query
def keyword_gaps(i):
    found = (
        _asked(i)
        .withColumn("w", tx.words(tx.clean_snippet_text("content")))
        .withColumn("p", snippets.keyword_positions(F.col("w"), F.lower("asked")))
        .select("doc_id", F.inline(snippets.keyword_gaps(F.col("p"))))
    )
    return found.select("doc_id", _long("pos"), _long("gap"))


@_query
def chunk_text_slice(i):
    joined = snippets.hit_defaults(i.chunks().drop("embedding").join(i.documents(), "doc_id"))
    text = snippets.chunk_text(F.col("content"), F.col("chunk_start"), F.col("chunk_end"))
    return joined.select("chunk_id", "chunk_start", "chunk_end", text.alias("text"))


@_query
def search_requests(i):
    base = i.table("documents").select(
        "doc_id",
        F.when(F.col("doc_id") % 9 == 4, "").otherwise(F.substring_index("text", " ", 5)).alias("query"),
        F.when(F.col("doc_id") % 4 != 0, F.col("doc_id") % 4).alias("page"),
    )
    sent = messages.page_to_offset(base).select("doc_id", F.to_json(F.struct("query", "limit", "offset")).alias("request"))
    good, _ = messages.read_requests(sent)
    return good.select("doc_id", urls.query_to_param("query").alias("param"), "limit", "offset")


@_query
def result_json(i):
    found = search_vectors(i.chunks(), i.documents(), i.query_vectors(1), 10, 0)
    record = F.from_json("result", "url string, score double, summary string, title string")
    return messages.to_results(found).select(record.alias("r")).select("r.url", _r6("r.score", "score"), "r.summary", "r.title")


# --- text -----------------------------------------------------------------------------------------------------------


@_query
def clean_text(i):
    return i.clean_documents()


@_query
def clean_snippet_text(i):
    return i.spread("documents", "doc_id").select("doc_id", tx.clean_snippet_text("text").alias("content"))


@_query
def word_count(i):
    counted = F.size(tx.words(tx.clean_snippet_text("text"))).cast("bigint")
    return i.spread("documents", "doc_id").select("doc_id", counted.alias("n_words"))


@_query
def stopword_filter(i):
    kept = tx.remove_stopwords(tx.words("content"))
    rows = i.clean_documents().withColumn("kept", kept)
    return rows.select("doc_id", F.size("kept").cast("bigint").alias("n_kept"), tx.join_text(F.col("kept")).alias("kept"))


# --- URLs and pages ---------------------------------------------------------------------------------------------------


@_query
def url_parts(i):
    return i.table("pages").select("page_id", urls.url_host("url").alias("host"), urls.url_path("url").alias("path"))


@_query
def valid_urls(i):
    """Page URLs, some of them damaged: without scheme, without host, or of a host-less scheme."""
    k = F.col("page_id") % 7
    bad = (
        F.when(k == 1, urls.url_path("url"))
        .when(k == 2, F.concat(F.lit("http://"), urls.url_path("url")))
        .when(k == 3, F.concat(F.lit("mailto:"), urls.url_host("url")))
        .otherwise(F.col("url"))
    )
    rows = i.table("pages").select("page_id", bad.alias("url"))
    return urls.valid_urls(rows).select("page_id", "url", urls.url_host("url").alias("host"))


@_query
def normal_urls(i):
    """URLs in other spellings: a host of other letters, upper case, the default port, no path."""
    k = F.col("page_id") % 4
    host = urls.url_host("url")
    sent = (
        F.when(k == 0, F.concat(F.lit("https://Müller."), host, F.lit("/ä")))
        .when(k == 1, F.concat(F.lit("HTTP://"), F.upper(host), F.lit(":80")))
        .when(k == 2, F.concat(F.lit(" https://"), host, F.lit(":0443/a/../b#x ")))
        .otherwise(host)
    )
    rows = i.table("pages").select("page_id", urls.normal_url(sent).alias("url"))
    return rows.select("page_id", "url", urls.url_host("url").alias("host"))


@_query
def page_titles(i):
    return i.parsed_pages().select("page_id", "title")


@_query
def page_text(i):
    ok, _ = pages.split_empty(i.parsed_pages())
    return pages.page_content(ok).select("page_id", "content")


@_query
def page_text_malformed(i):
    """Pages in which paragraphs have attributes that no HTML writer should produce."""
    k = F.col("page_id") % 3
    tag = F.when(k == 0, '<p a="1"=2>').when(k == 1, "<p x='1'y=\"2\" =>").otherwise("<p =a b=\"c>\"d='e'/f>")
    rows = i.spread("pages", "page_id").withColumn("html", F.replace("html", F.lit("<p>"), tag))
    return pages.page_content(pages.extract_pages(rows)).select("page_id", "content")


@_query
def page_links(i):
    return i.parsed_pages().select("page_id", F.posexplode("hrefs").alias("pos", "href")).select("page_id", _long("pos"), "href")


@_query
def resolved_links(i):
    got = pages.resolve_links(i.parsed_pages().drop("links"), "url", "hrefs")
    return got.select("page_id", F.posexplode("links").alias("pos", "url")).select("page_id", _long("pos"), "url")


@_query
def empty_body_rejects(i):
    emptied = F.regexp_replace("html", r"(?s)<body.*$", "<body></body></html>")
    html = F.when(F.col("page_id") % 10 == 0, emptied).otherwise(F.col("html"))
    _, rejected = pages.split_empty(pages.extract_pages(i.table("pages").withColumn("html", html)))
    return rejected.select("page_id", "title", "reason")


@_query
def invalid_inputs(i):
    d = F.col("doc_id")
    sent = i.table("documents").select(
        "doc_id",
        F.when(d % 11 == 0, "").otherwise(d.cast("string")).alias("id"),
        F.when(d % 7 == 0, "").when(d % 13 != 0, F.col("text")).alias("content"),
    )
    return pages.split_invalid(sent)[1].select("doc_id", "reason")


def _link_columns(df: DataFrame) -> DataFrame:
    return df.select("page_id", _long("pos"), "url", "host", _long("depth"))


@_query
def links_in_scope(i):
    return _link_columns(frontier.in_scope(i.links(), i.sites()))


@_query
def links_out_of_scope(i):
    return _link_columns(frontier.out_of_scope(i.links(), i.sites()))


@_query
def message_roundtrip(i):
    rows = i.table("pages").select("url", (F.col("page_id") % 4).alias("depth"), F.col("html").alias("content"))
    good, _ = messages.read_messages(messages.to_messages(rows, t0()).drop("id"))
    return good.select("id", "url", _long("depth"), F.md5("content").alias("content_md5"))


@_query
def row_ids(i):
    rows = i.frontier()
    return rows.select("url_id", new_id(F.col("created_at"), F.col("url")).alias("id"))


# --- sites, robots, frontier --------------------------------------------------------------------------------------------


@_query
def load_sites(i):
    got = sites.parse_sites(i.site_configs(), order="page_id")
    return got.select("host", "url", _long("depth"), _long("rps"), _r6("interval_s", "interval_s"))


@_query
def seed_frontier(i):
    return sites.seed_frontier(sites.site_entries(i.site_configs())).select("url", "host", _long("depth"))


@_query
def robots_targets(i):
    return sites.robots_targets(sites.site_entries(i.site_configs()))


@_query
def robots_rules(i):
    return robots.parse_robots(i.robots()).select("host", "agent", "kind", "prefix")


@_query
def robots_rule_map(i):
    mapped = robots.rules_map(robots.parse_robots(i.robots()))
    rows = mapped.select("host", "allow_rules", "disallow_rules", F.explode(F.map_keys("allow_rules")).alias("agent"))
    joined = lambda c: F.array_join(F.element_at(c, F.col("agent")), "|")
    return rows.select("host", "agent", joined("allow_rules").alias("allow"), joined("disallow_rules").alias("disallow"))


@_query
def robots_allowed(i):
    got = robots.robots_allowed(i.frontier(), robots.parse_robots(i.robots()))
    return got.select("url_id", "allowed")


@_query
def robots_allowed_prefix(i):
    """The same by equality of path prefixes, for hosts with very many rules."""
    got = robots.robots_allowed_by_prefix(i.frontier(), robots.parse_robots(i.robots()))
    return got.select("url_id", "allowed")


@_query
def robots_allowed_options(i):
    """With "*" as fallback and empty prefixes ignored."""
    got = robots.robots_allowed(i.frontier(), robots.parse_robots(i.robots()), fallback_star=True, ignore_empty=True)
    return got.select("url_id", "allowed")


@_query
def enqueue_if_absent(i):
    fresh = frontier.enqueue_links(i.frontier(), i.links().select("url", "host", "depth"), as_of())
    return fresh.select("url", "host", _long("depth"))


@_query
def write_counts(i):
    links = i.links().select("url", "host", "depth")
    counts = arrays.write_counts(links, frontier.enqueue_links(i.frontier(), links, as_of()), "save_links")
    return counts.select("stage", _long("rows_offered"), _long("rows_written"))


@_query
def dequeue_batch(i):
    taken, _ = frontier.dequeue(i.frontier(), i.sites(), 3)
    return taken.select("url_id", "url", "host", _long("depth"))


@_query
def frontier_remaining(i):
    return frontier.dequeue(i.frontier(), i.sites(), 3)[1].select("url_id", "host")


@_query
def requeue(i):
    taken, rest = frontier.dequeue(i.frontier(), i.sites(), 3)
    return frontier.requeue(rest, taken.filter(F.col("url_id") % 2 == 0)).select("url_id", "host")


@_query
def refill_queue(i):
    """A short work list is filled up from the frontier, a full one is not."""
    taken, rest = frontier.dequeue(i.frontier(), i.sites(), 3)
    filled = frontier.refill(rest.limit(0), taken, 1).select(F.lit("short").alias("held"), "url_id")
    kept = frontier.refill(rest, taken, 1).select(F.lit("full").alias("held"), "url_id")
    return filled.unionByName(kept)


@_query
def visited_filter(i):
    return frontier.not_visited(i.frontier(), i.visited(), as_of()).select("url_id", "url")


@_query
def admission(i):
    """With a rate: a round of one second."""
    rules_table = robots.parse_robots(i.robots())
    got = frontier.admit(i.frontier(), i.sites(), rules_table, i.visited(), as_of(), round_s=1.0)
    return got.select("url_id", "ok", "reason")


@_query
def admission_no_rate(i):
    got = frontier.admit(i.frontier(), i.sites(), robots.parse_robots(i.robots()), i.visited(), as_of())
    return got.select("url_id", "ok", "reason")


@_query
def content_type_gate(i):
    page, seen, error = frontier.gate_content_type(i.responses())
    label = lambda df, name: df.select("url", F.lit(name).alias("output"))
    return label(page, "page").unionByName(label(seen, "visited")).unionByName(label(error, "error"))


@_query
def pace_schedule(i):
    paced = frontier.pace_schedule(i.frontier(), i.sites(), t0())
    return paced.select("url_id", "host", F.unix_millis("fetch_at").alias("fetch_ms"))


@_named("crawl_round")
def crawl_round_tables(i):
    sites_table = i.sites()
    rules_table = robots.parse_robots(i.robots())
    answers = i.responses().filter(F.length("url") % 4 != 0)
    out = crawl_round(i.frontier(), sites_table, rules_table, i.visited(), answers, as_of(), batch=3, round_s=1.0)
    sent, _ = messages.read_messages(out.messages.drop("id"))
    label = lambda df, name: df.select(F.lit(name).alias("output"), "url")
    parts = [
        label(out.judged, "judged"), label(sent, "message"), label(out.visits, "visit"),
        label(out.errors, "error"), label(out.failed, "failed"), label(out.frontier, "frontier"),
    ]
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


# --- cache and tables ------------------------------------------------------------------------------------------------------


@_query
def kv_latest(i):
    got = kv.kv_latest(i.kv_log(), as_of())
    return got.select("key", "seq", _r6("value", "value"))


def _kv_keys(i: Inputs) -> DataFrame:
    return i.table("events").select((F.col("user_id") * 2).alias("key")).distinct()


@_query
def kv_get(i):
    got = kv.kv_get(_kv_keys(i), i.kv_log(), as_of())
    return got.select("key", "seq", _r6("value", "value"))


@_query
def kv_exists(i):
    return kv.kv_exists(_kv_keys(i), i.kv_log(), as_of())


@_query
def payload_lookup(i):
    found, missing = frontier.lookup_payloads(*i.payloads())
    return found.select("id", F.lit(True).alias("found")).unionByName(missing.select("id", F.lit(False).alias("found")))


@_query
def document_lookup(i):
    d = F.col("doc_id")
    table = i.documents().withColumn("content", F.when(d % 10 != 7, F.col("content")))
    found, missing = documents.lookup_documents(i.documents().select((d * 2).alias("doc_id")), table)
    rows = found.select("doc_id", F.lit("found").alias("outcome"))
    return rows.unionByName(missing.select("doc_id", F.col("reason").alias("outcome")))


def _upserted(i: Inputs, mode: str) -> DataFrame:
    old, new = i.docs_old_new()
    table, _ = documents.upsert_documents(old, new, as_of(), mode)
    return table.select("doc_id", "url", "title", F.md5("content").alias("content_md5"))


@_query
def upsert_documents(i):
    return _upserted(i, "new")


@_query
def upsert_documents_literal(i):
    return _upserted(i, "url")


@_query
def upsert_returned_ids(i):
    return documents.upsert_documents(*i.docs_old_new(), as_of())[1]


@_query
def missing_documents(i):
    return documents.missing_documents(i.documents(), i.chunks())


@_query
def missing_documents_null(i):
    return documents.missing_documents(i.documents(), i.chunks(null_docs=True))


@_query
def missing_documents_null_safe(i):
    return documents.missing_documents(i.documents(), i.chunks(null_docs=True), null_safe=True)


@_query
def orphan_chunks(i):
    kept = i.documents().filter(F.col("doc_id") % 10 != 3)
    return documents.orphan_chunks(i.chunks(null_docs=True), kept).select("chunk_id", "doc_id")


@_query
def cascade_delete(i):
    gone = i.documents().filter(F.col("doc_id") % 10 == 3)
    docs, left = documents.delete_documents(i.documents(), i.chunks(), gone)
    rows = docs.select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"))
    return rows.unionByName(left.select(F.lit("chunk").alias("kind"), F.col("chunk_id").alias("id")))


@_query
def table_lifecycle(i):
    """Create, fill, upsert, delete with cascade, read, drop."""
    spark = i.spark
    home = fresh_dir(spark, "tables")
    db = "trawl_" + home[-12:]
    tables = create_tables(spark, db, home, parts=8)
    new = i.documents().withColumn("doc_id", F.col("doc_id").cast("string"))
    tables.upsert_documents(new, t0())
    vectors_table = i.chunks().withColumn("doc_id", F.col("doc_id").cast("string")).withColumn("chunk_id", F.col("chunk_id").cast("string"))
    tables.append_chunks(vectors_table.withColumns({"created_at": t0(), "updated_at": t0()}), 64)
    tables.append_links(i.links().select("url", "host", "depth"), t0())
    tables.append_links(i.links().select("url", "host", "depth"), t0())
    tables.delete_documents(new.filter(F.col("doc_id") == "3"))
    shown = {"frontier": F.col("url"), "documents": F.md5("content"), "chunks": F.col("doc_id")}
    ids = {"frontier": F.col("host"), "documents": F.col("doc_id"), "chunks": F.col("chunk_id")}
    parts = [tables.read(n).select(F.lit(n).alias("name"), ids[n].alias("id"), shown[n].alias("detail")) for n in shown]
    report = parts[0].unionByName(parts[1]).unionByName(parts[2])
    path = fresh_dir(spark, "report")
    report.write.parquet(path)
    drop_tables(spark, db)
    spark.sql(f"DROP DATABASE {db}")
    return spark.read.parquet(path)


@_named("parse_pages")
def parse_pages_tables(i):
    rows = i.table("pages").select(
        F.col("page_id").cast("string").alias("id"), F.col("html").alias("content"), (F.col("page_id") % 3).cast("int").alias("depth"), "url"
    )
    old = i.documents().limit(0).withColumn("doc_id", F.lit("")).withColumns({"created_at": t0(), "updated_at": t0()})
    out = parse_pages(rows, old, i.frontier(), i.sites(), as_of())
    docs = out.documents.select(F.lit("document").alias("kind"), "url", F.md5("content").alias("detail"))
    return docs.unionByName(out.links.select(F.lit("link").alias("kind"), "url", F.col("depth").cast("string").alias("detail")))


# --- tokens, chunks, vectors ---------------------------------------------------------------------------------------------------


@_query
def token_counts(i):
    return i.clean_documents().select("doc_id", token_count(F.col("content")).cast("bigint").alias("n_tokens"))


@_query
def length_check(i):
    return chunks.check_length(i.clean_documents(), "content")[1].select("doc_id", "reason")


@_named("truncate_tokens")
def truncated_tokens(i):
    kept = truncate_tokens(token_array(F.col("content")))
    rows = i.clean_documents().withColumn("kept", kept)
    return rows.select("doc_id", F.size("kept").cast("bigint").alias("n_kept"), F.md5(F.array_join("kept", " ")).alias("kept_md5"))


@_query
def token_offsets(i):
    rows = chunks.tokenize(i.clean_documents(), "content").select("doc_id", F.inline("tokens"))
    return rows.select("doc_id", _long("pos"), "token", _long("start", "start_at"), _long("end", "end_at"))


@_query
def chunk_windows(i):
    rows = chunks.chunk_windows(chunks.tokenize(i.clean_documents(), "content").drop("content"))
    return rows.select(
        "doc_id", _long("chunk_no"), _long("tok_start"), _long("tok_end"), _long("input_end"), "chunk_start", "chunk_end",
        F.md5(F.array_join("input_tokens", " ")).alias("input_md5"),
    )


@_query
def chunk_spans(i):
    rows = chunks.chunk_spans(i.clean_documents(), "content")
    return rows.select("doc_id", _long("chunk_no"), "chunk_start", "chunk_end")


@_query
def l2_norm(i):
    return i.table("embeddings").select("vec_id", _r6(vectors.l2_norm(F.col("embedding")), "norm"))


def _positions(df: DataFrame, key: str, vector: str) -> DataFrame:
    return df.select(key, F.posexplode(vector).alias("pos", "x")).select(key, _long("pos"), _r6(F.col("x").cast("double"), "x"))


@_query
def l2_normalize(i):
    rows = i.table("embeddings").withColumn("unit", vectors.l2_normalize(F.col("embedding")))
    return _positions(rows, "vec_id", "unit")


@_query
def mean_pool(i):
    return _positions(arrays.mean_pool(i.table("embeddings"), "label"), "label", "embedding")


@_query
def cls_pool(i):
    return _positions(arrays.cls_pool(i.table("embeddings"), "label", "vec_id"), "label", "embedding")


@_query
def hash_embed_docs(i):
    """Vector positions as token counts: weight times number of tokens."""
    rows = embed.embed_column(i.clean_documents().filter("content != ''"), "content")
    total = rows.withColumn("n", token_count(F.col("content"), add_special=False)).drop("content")
    spread = total.select("doc_id", "n", F.posexplode("embedding").alias("pos", "x")).filter(F.col("x") != 0)
    return spread.select("doc_id", _long("pos"), F.round(F.col("x") * F.col("n")).cast("bigint").alias("n_tokens"))


@_query
def hash_embed_first(i):
    """Another configuration of the model: 32 dimensions, vector of the first token."""
    cfg = embed.EmbedConfig(dims=32, mean_pooling=False, normalize=True)
    rows = embed.embed_column(i.clean_documents().filter("content != ''"), "content", cfg)
    return rows.select("doc_id", F.posexplode("embedding").alias("pos", "x")).filter("x != 0").select(
        "doc_id", _long("pos"), F.col("x").cast("double").alias("x")
    )


@_query
def embed_queries(i):
    """Short texts; empty ones are turned away."""
    asked = i.table("documents").select(
        "doc_id", F.when(F.col("doc_id") % 9 != 4, F.substring_index(tx.clean_text("text"), " ", 5)).alias("text")
    )
    good, rejected = embed.embed_texts(asked, "text", embed.EmbedConfig(normalize=True))
    rows = good.select("doc_id", F.round(vectors.l2_norm(F.col("embedding")), 4).alias("norm"), F.lit("ok").alias("reason"))
    return rows.unionByName(rejected.select("doc_id", F.lit(None).cast("double").alias("norm"), "reason"))


@_named("index_documents")
def indexed_chunks(i):
    """Spans of all chunks, which vector positions each one fills, and the weights there."""
    rows = index_documents(i.clean_documents(), t0())
    slots = F.filter(F.transform("embedding", lambda x, k: F.when(x != 0, k)), lambda k: k.isNotNull())
    weighed = F.aggregate(
        F.transform("embedding", lambda x, k: x.cast("double") * (k + 1)), F.lit(0.0), lambda a, x: a + x
    )
    filled = rows.select(_long("doc_id"), "chunk_start", "chunk_end", F.explode(F.array(slots)).alias("s"), _r6(weighed, "weight"))
    total = F.aggregate("s", F.lit(0), lambda a, k: a + k).cast("bigint")
    return filled.select("doc_id", "chunk_start", "chunk_end", F.size("s").cast("bigint").alias("n_slots"), total.alias("slot_sum"), "weight")


@_named("collect_arrays")
def collected_arrays(i):
    got = arrays.collect_arrays(i.chunks(), "doc_id", "chunk_id", "chunk_id", "chunk_start")
    return got.select("doc_id", F.array_join("chunk_id", ",").alias("chunk_ids"), F.array_join("chunk_start", ",").alias("starts"))


@_query
def unnest_zip(i):
    packed = arrays.collect_arrays(i.chunks(), "doc_id", "chunk_id", "chunk_id", "chunk_start", "chunk_end")
    return arrays.unnest(packed, "chunk_id", "chunk_start", "chunk_end", keep=["doc_id"])


# --- streams ----------------------------------------------------------------------------------------------------------------------


def _drained(i: Inputs, stream: DataFrame, label: str) -> DataFrame:
    """Run a stream to its present end into a fresh folder and read that."""
    home = fresh_dir(i.spark, label)
    run = (
        stream.writeStream.format("parquet")
        .option("checkpointLocation", f"{home}/checkpoint")
        .trigger(**_NOW)
        .start(f"{home}/out")
    )
    run.awaitTermination()
    return i.spark.read.schema(stream.schema).parquet(f"{home}/out")


def _event_stream(i: Inputs) -> DataFrame:
    return i.stream("events").withColumn("ts", F.col("ts").cast("timestamp"))


@_query
def queue_roundtrip(i):
    """Ids through the folder queue."""
    queue = fresh_dir(i.spark, "queue")
    write_ids(i.events().select(F.col("event_id").cast("string").alias("id"), F.col("ts").alias("event_time")), queue)
    got = _drained(i, read_ids(i.spark, queue), "queue")
    return got.select("id", F.unix_micros("event_time").alias("event_us"))


@_query
def stream_visited_dedup(i):
    seen = _event_stream(i).select(F.col("user_id").alias("url"), "ts")
    return _drained(i, rules.visited_stream(seen), "visited").select("url")


@_query
def stream_first_visit(i):
    seen = _event_stream(i).select(F.col("user_id").alias("url"), "ts", F.col("event_id").alias("seq"))
    got = _drained(i, rules.first_visit_stream(seen), "first_visit")
    return got.filter("fresh").select("seq")


def _timed_events(i: Inputs) -> DataFrame:
    """Stream of the events in three triggers by time; a last row, many years on, moves the watermark past all of them."""
    home = fresh_dir(i.spark, "events")
    rows = i.events().select("event_id", "user_id", "ts", "value")
    day = F.dayofmonth("ts")
    last = i.spark.range(1).select(
        F.lit(-1).cast("bigint").alias("event_id"), F.lit(-1).cast("bigint").alias("user_id"),
        F.expr("timestamp'2100-01-01 00:00:00'").alias("ts"), F.lit(0.0).alias("value"),
    )
    parts = [rows.filter(day <= 10), rows.filter((day > 10) & (day <= 20)), rows.filter(day > 20), last]
    for n, part in enumerate(parts):
        part.coalesce(1).write.parquet(f"{home}/{n}")
    reader = i.spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1)
    return reader.option("recursiveFileLookup", "true").parquet(home)


@_query
def stream_payload_join(i):
    """Every id message: with its page, or with the reason why there is none."""
    e = _timed_events(i)
    ids = e.select(F.col("event_id").alias("id"), F.expr("ts + make_dt_interval(0, 0, int(event_id % 20 - 3))").alias("get_ts"))
    put = e.select(F.col("event_id").alias("id"), F.col("ts").alias("put_ts"), "value")
    found = _drained(i, rules.payload_or_error_stream(ids, put, delay="30 minutes"), "payload")
    return found.filter("id >= 0").select("id", _r6("value", "value"), "reason")


@_query
def stream_payload_hits(i):
    """Only the ids whose page is alive, by the inner join."""
    e = _event_stream(i)
    ids = e.select(F.col("event_id").alias("id"), F.expr("ts + make_dt_interval(0, 0, int(event_id % 20 - 3))").alias("get_ts"))
    put = e.select(F.col("event_id").alias("id"), F.col("ts").alias("put_ts"), "value")
    return _drained(i, rules.payload_stream(ids, put), "payload").select("id", _r6("value", "value"))


@_query
def stream_paced(i):
    """When each event may go if an event of its user goes a day after the one before: deferred ones come out by themselves."""
    rows = _timed_events(i).select(F.col("user_id").alias("host"), "ts", F.col("event_id").alias("seq"))
    with ordered.timer_state(i.spark):
        got = _drained(i, ordered.paced_stream(rows, 86400.0), "paced")
    return got.filter("seq >= 0").select("seq", F.unix_micros("released_at").alias("released_us"))


@_query
def stream_visits_expire(i):
    """Visits of seven days' life over several triggers, in time order."""
    rows = _timed_events(i).select(F.col("user_id").alias("url"), "ts", F.col("event_id").alias("seq"))
    with ordered.timer_state(i.spark):
        got = _drained(i, ordered.expiring_visits(rows), "visits")
    return got.filter("seq >= 0").select("seq", "fresh")


@_query
def stream_rate_limit(i):
    rows = _event_stream(i).select(F.col("user_id").alias("host"), "ts", F.col("event_id").alias("seq"))
    got = _drained(i, rules.rate_limit_stream(rows, 86400.0), "rate")
    return got.select("seq", "accepted")


@_query
def stream_crawl(i):
    """Three rounds of two links per host; a third of all answers comes with each, before or after its link's round."""
    home = fresh_dir(i.spark, "crawl")
    tables = StageTables(i.spark, home)
    tables.seed(i.frontier().withColumn("updated_at", t0()))
    kind = F.col("page_id") % 5
    types = F.when(kind == 0, "text/html; charset=utf-8").when(kind == 1, "text/plain").when(kind == 2, "image/png").when(kind == 4, "bad")
    answers = i.table("pages").select("url", F.lit(200).alias("status"), types.alias("content_type"), F.col("html").alias("body"), "page_id")
    for part in range(3):
        answers.filter(F.col("page_id") % 3 == part).drop("page_id").coalesce(1).write.parquet(f"{home}/answers/{part}")
    sent = (
        i.spark.readStream.schema(answers.drop("page_id").schema).option("maxFilesPerTrigger", 1)
        .option("recursiveFileLookup", "true").parquet(f"{home}/answers")
    )
    rules_table = robots.parse_robots(i.robots())
    start_crawl(sent, tables, i.sites(), rules_table, f"{home}/checkpoint", as_of(), _NOW, per_host=2).awaitTermination()
    found, _ = messages.read_messages(tables.read("messages").select("message"))
    rows = found.select(F.lit("message").alias("output"), "url")
    for output, table in (("asked", tables.read("asked")), ("visit", tables.read("visits")), ("held", tables.held(3)), ("frontier", tables.frontier())):
        rows = rows.unionByName(table.select(F.lit(output).alias("output"), "url"))
    return rows.unionByName(tables.read("crawl_rejects").select(F.col("reason").alias("output"), "url"))


@_query
def stream_parse(i):
    home = fresh_dir(i.spark, "parse")
    tables = StageTables(i.spark, home)
    rows = i.stream("pages").select(
        F.col("page_id").cast("string").alias("id"), F.col("html").alias("content"), (F.col("page_id") % 3).cast("int").alias("depth"), "url"
    )
    lines = rows.select(F.to_json(F.struct("id", "content", "depth", "url"), {"ignoreNullFields": "false"}).alias("m"), "id")
    k = F.col("id").cast("bigint") % 10
    cut = F.when(k == 3, F.substring("m", 1, 20)).when(k == 6, F.to_json(F.struct("id", F.lit("<body></body>").alias("content"), F.lit(0).alias("depth"), F.lit("u").alias("url")))).otherwise(F.col("m"))
    start_parse(lines.select(cut.alias("message")), tables, i.sites(), f"{home}/checkpoint", as_of(), _NOW).awaitTermination()
    docs = tables.documents().select("url", "title", "content")
    return docs.unionByName(tables.read("rejects").select("url", F.lit(None).cast("string").alias("title"), F.col("reason").alias("content")))


@_query
def stream_embed(i):
    home = fresh_dir(i.spark, "embed")
    tables = StageTables(i.spark, home)
    docs = i.clean_documents().select(
        F.col("doc_id").cast("string").alias("doc_id"), F.col("doc_id").cast("string").alias("url"), "content",
        F.lit("").alias("title"), t0().alias("created_at"), t0().alias("updated_at"),
    )
    tables.write("documents", 0, docs)
    ids = i.stream("documents").select(F.col("doc_id").cast("string").alias("id"), t0().alias("event_time"))
    start_embed(ids, tables, f"{home}/checkpoint", t0(), trigger=_NOW).awaitTermination()
    return tables.read("chunks").select(_long("doc_id"), "chunk_start", "chunk_end")
