"""Crawl, parse and embed stages as streaming queries over append-only stage tables.

Every trigger writes its rows below ``batch_id=<n>`` and overwrites only that folder. Earlier batches are read, never
rewritten, and the time of a trigger is stored with it, so a replayed trigger leaves the same tables.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.documents import lookup_documents
from ..functions.urls import is_valid_url, normal_url
from ..operators.embed import EmbedConfig, bad_vector
from ..operators.frontier import BATCH_PER_HOST, TOO_FAST, VISIT_TTL, admit, dequeue, enqueue_links, gate_content_type, in_scope
from ..operators.pages import link_rows
from ..operators.ranking import first_per_group
from ..operators.robots import DEFAULT_AGENT
from ..plans.index import index_documents
from ..plans.parse import document_rows, read_pages
from ..schemas import CHUNKS, DOCUMENTS, FRONTIER, QUEUE_MESSAGE
from ..session import durable, stored
from ..sources.messages import read_messages, to_messages
from ..sources.queues import write_ids

_VISITS = T.StructType([T.StructField("url", T.StringType()), T.StructField("visited_at", T.TimestampType())])
_TAKEN = T.StructType([T.StructField("url", T.StringType()), T.StructField("added", T.LongType())])
_ASKED = T.StructType([
    T.StructField("url", T.StringType()), T.StructField("added", T.LongType()), T.StructField("depth", T.IntegerType()),
    T.StructField("asked_at", T.TimestampType()),
])
_ANSWER = T.StructType([
    T.StructField("url", T.StringType()), T.StructField("status", T.IntegerType()), T.StructField("content_type", T.StringType()),
    T.StructField("body", T.StringType()),
])
_SPENT = T.StructType([T.StructField("url", T.StringType()), T.StructField("arrived", T.LongType())])
_TIME = T.StructType([T.StructField("at", T.TimestampType())])
_BASES = T.StructType([T.StructField("name", T.StringType()), T.StructField("upto", T.LongType()), T.StructField("generation", T.LongType())])
_MESSAGES = T.StructType([T.StructField("id", T.StringType()), T.StructField("message", T.StringType())])
REJECTS = T.StructType([T.StructField(c, T.StringType()) for c in ("id", "url", "reason")])
_LINKS = T.StructType([f for f in FRONTIER.fields if f.name != "url_id"])
NO_URL = "not a URL"
# Fixed value: pause between two rounds of the crawl loop.
ROUND_PAUSE = "3 seconds"


@dataclass(frozen=True)
class StageTables:
    """Append-only tables of the stages below one shared folder."""

    spark: SparkSession
    root: str
    _bases: dict[str, tuple[int, int]] = field(default_factory=dict, compare=False, repr=False)  # (generation, last batch)

    _SCHEMAS = {
        "documents": DOCUMENTS, "frontier": _LINKS, "chunks": CHUNKS, "doc_ids": QUEUE_MESSAGE, "rejects": REJECTS,
        "taken": _TAKEN, "visits": _VISITS, "messages": _MESSAGES, "asked": _ASKED, "closed": _TAKEN, "early": _ANSWER,
        "spent": _SPENT, "crawl_rejects": REJECTS, "embed_rejects": REJECTS,
        "crawl_times": _TIME, "parse_times": _TIME, "embed_times": _TIME,
    }

    def __post_init__(self):
        self.refresh()

    def path(self, name: str, batch: int | None = None) -> str:
        return f"{self.root}/{name}" + ("" if batch is None else f"/batch_id={batch}")

    def refresh(self) -> None:
        """Learn which snapshots are complete; every trigger does so once."""
        last = self._folder(f"{self.root}/snapshots/bases", _BASES).groupBy("name").agg(F.max(F.struct("generation", "upto")).alias("b"))
        self._bases.update({r["name"]: tuple(r["b"]) for r in last.collect()})

    def _folder(self, path: str, schema: T.StructType) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(path)
        except AnalysisException as e:
            if e.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def read(self, name: str, before: int | None = None) -> DataFrame:
        """All rows, or those of the batches before the given one, with their batch_id: the last snapshot and what came since."""
        schema = T.StructType([*self._SCHEMAS[name].fields, T.StructField("batch_id", T.LongType())])
        rows = self._folder(self.path(name), schema)
        if name in self._bases:
            # Folders that the snapshot covers are pruned; its rows carry the batch they came with.
            generation, upto = self._bases[name]
            rows = rows.filter(F.col("batch_id") > upto).unionAll(self._folder(self._snapshot(name, generation), schema))
        return rows if before is None else rows.filter(F.col("batch_id") < before)

    def _snapshot(self, name: str, generation: int) -> str:
        return f"{self.root}/snapshots/{name}/{generation}"

    def seed(self, links: DataFrame) -> None:
        """First links of the queue (see ``seed_frontier``), ahead of the batches of the parse stage."""
        self.write("frontier", -1, links)

    def write(self, name: str, batch: int, df: DataFrame) -> None:
        fields = self._SCHEMAS[name].fields
        rows = df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in fields])
        rows.write.mode("overwrite").parquet(self.path(name, batch))

    def time(self, stage: str, batch: int, given: Column | None = None) -> Column:
        """The given time, or one time per stage and batch that is stored when first asked for."""
        if given is not None:
            return given
        known = self.read(f"{stage}_times").filter(F.col("batch_id") == batch).first()
        if known is None:
            self.write(f"{stage}_times", batch, self.spark.range(1).select(F.current_timestamp().alias("at")))
            known = self.read(f"{stage}_times").filter(F.col("batch_id") == batch).first()
        return F.lit(known["at"])

    def frontier(self, before: int | None = None, taken_before: int | None = None) -> DataFrame:
        """Queued links: all that were added (in batch ``added``) and not taken since."""
        taken = self.read("taken", taken_before).select("url", "added")
        return self.read("frontier", before).withColumnRenamed("batch_id", "added").join(taken, ["url", "added"], "left_anti")

    def waiting(self, batch: int) -> DataFrame:
        """Links that were asked for up to a batch and not closed before it."""
        closed = self.read("closed", batch).select("url", "added")
        return self.read("asked", batch + 1).drop("batch_id").join(closed, ["url", "added"], "left_anti")

    def held(self, batch: int) -> DataFrame:
        """Answers (and the batch they ``arrived`` in) that came before their link was asked for."""
        early = self.read("early", batch).withColumnRenamed("batch_id", "arrived")
        return early.join(self.read("spent", batch).select("url", "arrived"), ["url", "arrived"], "left_anti")

    def counts(self) -> DataFrame:
        """(table, batch_id, rows): what each trigger wrote, rejects included; read from the files' footers."""
        each = [
            self.read(n).groupBy("batch_id").agg(F.count(F.lit(1)).alias("rows")).select(F.lit(n).alias("table"), "batch_id", "rows")
            for n in self._SCHEMAS if not n.endswith("_times")
        ]
        return reduce(DataFrame.unionAll, each)

    def messages(self) -> DataFrame:
        """Stream of the page messages as JSON (message); the parse stage decodes them and rejects bad ones."""
        lines = self.spark.readStream.schema(_MESSAGES).option("recursiveFileLookup", "true").parquet(self.path("messages"))
        return lines.select("message")

    def documents(self, before: int | None = None, ids: DataFrame | None = None) -> DataFrame:
        """Current documents: identity from the first write of a URL, content from the last.

        ``ids`` (doc_id) narrows the log before versions are merged; all versions of a URL have one doc_id.
        """
        log = self.read("documents", before)
        if ids is not None:
            log = log.join(ids, "doc_id", "left_semi")
        first = F.min_by(F.struct("doc_id", "title", "created_at"), "batch_id")
        last = F.max_by(F.struct("content", "updated_at"), "batch_id")
        current = log.groupBy("url").agg(first.alias("f"), last.alias("l"))
        return current.select("f.doc_id", "url", "l.content", "f.title", "f.created_at", "l.updated_at")

    def compact(self, parsed: int | None = None, crawled: int | None = None) -> None:
        """Snapshots of the logs up to a batch of the parse stage and one of the crawl stage; call it between triggers.

        ``documents`` and ``visits`` get one row per URL, ``frontier`` the links that still queue, ``asked`` those that wait
        for an answer, ``early`` the answers that are held; what ``taken``, ``closed`` and ``spent`` have taken out of these
        is not kept. So what a trigger reads grows with the links at hand and the triggers since, not with the history.
        Snapshots are written whole before one row in ``bases`` names them, all at once: a crash before that changes
        nothing, and the call can be repeated. Both batches must be complete, since a snapshot is not rewritten by a replay.
        """
        self.refresh()
        generation = 1 + max((g for g, _ in self._bases.values()), default=0)
        made: dict[str, tuple[int, DataFrame]] = {}
        if parsed is not None:
            documents = self.documents(parsed + 1).withColumn("batch_id", F.lit(parsed).cast("bigint"))
            made["documents"] = parsed, documents
        if crawled is not None:
            visits = self.read("visits", crawled + 1).groupBy("url").agg(F.max("visited_at").alias("visited_at"))
            made["visits"] = crawled, visits.withColumn("batch_id", F.lit(crawled).cast("bigint"))
            key = ["url", "added"]
            closed = self.read("closed", crawled + 1)
            made["asked"] = crawled, self.read("asked", crawled + 1).join(closed, key, "left_anti")
            made["closed"] = crawled, closed.limit(0)
            spent = self.read("spent", crawled + 1)
            early = self.read("early", crawled + 1).withColumn("arrived", F.col("batch_id"))
            made["early"] = crawled, early.join(spent, ["url", "arrived"], "left_anti").drop("arrived")
            made["spent"] = crawled, spent.limit(0)
            if parsed is not None:
                links = self.read("frontier", parsed + 1).withColumn("added", F.col("batch_id"))
                taken = self.read("taken", crawled + 1)
                made["frontier"] = parsed, links.join(taken, key, "left_anti").drop("added")
                # What was taken of later batches of links is still needed.
                made["taken"] = crawled, taken.filter(F.col("added") > parsed)
        for name, (upto, rows) in made.items():
            if upto < self._bases.get(name, (0, upto))[1]:
                raise ValueError(f"there is a later snapshot of {name}")
        for name, (_, rows) in made.items():
            names = [*self._SCHEMAS[name].names, "batch_id"]
            rows.select(names).write.mode("overwrite").parquet(self._snapshot(name, generation))
        if made:
            bases = self.spark.createDataFrame([(name, upto, generation) for name, (upto, _) in made.items()], _BASES)
            bases.coalesce(1).write.mode("append").parquet(f"{self.root}/snapshots/bases")
            self.refresh()


def parse_batch(tables: StageTables, sites: DataFrame, as_of: Column | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: messages → documents, links, document ids, rejects.

    Messages are records (id, content, depth, url) or JSON lines (message); a line that is no record is a reject.
    """
    given = as_of

    def run(messages: DataFrame, batch: int) -> None:
        tables.refresh()
        as_of = tables.time("parse", batch, given)
        bad = None
        if "message" in messages.columns:
            messages, undecoded = read_messages(messages.select("message"))
            bad = undecoded.select(*[F.lit(None).cast("string").alias(c) for c in ("id", "url")], "reason")
        pages, rejects = read_pages(messages)
        rejects = rejects if bad is None else rejects.select("id", "url", "reason").unionByName(bad)
        pages = pages.persist()
        try:
            rows = document_rows(pages, as_of)
            # One row per URL and batch: the first names the document, the last gives its text.
            offered = rows.groupBy("url").agg(
                F.min_by(F.struct("doc_id", "title"), "msg_id").alias("n"), F.max_by("content", "msg_id").alias("content")
            )
            known = tables.read("documents", batch).join(offered.select("url"), "url", "left_semi")
            known = known.groupBy("url").agg(F.min_by(F.struct("doc_id", "title", "created_at"), "batch_id").alias("k"))
            merged = offered.join(known, "url", "left").select(
                F.coalesce("k.doc_id", "n.doc_id").alias("doc_id"),
                "url",
                "content",
                F.when(F.col("k").isNotNull(), F.col("k.title")).otherwise(F.col("n.title")).alias("title"),
                F.coalesce(F.col("k.created_at"), as_of).alias("created_at"),
                as_of.alias("updated_at"),
            )
            tables.write("documents", batch, merged)
            links = in_scope(link_rows(pages, "id"), sites).select("url", "host", "depth")
            tables.write("frontier", batch, enqueue_links(tables.frontier(batch), links, as_of))
            tables.write("rejects", batch, rejects)
            # Ids go out last, once all a later stage may look up is there.
            written = tables.spark.read.schema(DOCUMENTS).parquet(tables.path("documents", batch))
            out = written.select(F.col("doc_id").alias("id"), F.col("updated_at").alias("event_time"))
            write_ids(out, tables.path("doc_ids", batch), "overwrite")
        finally:
            pages.unpersist()

    return run


def crawl_batch(
    tables: StageTables, sites: DataFrame, rules: DataFrame, as_of: Column | None = None, agent: str = DEFAULT_AGENT,
    per_host: int = BATCH_PER_HOST, round_s: float | None = None, answer_ttl: str = VISIT_TTL, max_waiting: int | None = None,
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function of one crawl round.

    A round takes the oldest links of each host from the queue and adds the admitted ones to the list of links asked
    for. Answers (url, status, content_type, body) of this or any later trigger are joined to that list and become
    messages and visits; the first answer of a URL counts. An answer whose link still queues is held until its round.
    Rejected, with a reason: links that are no URL or fail admission, answers nobody asked for, further answers,
    unreadable types, and links without an answer for ``answer_ttl``. So every link queues, waits, was answered or is a
    reject, and every answer is a page, a visit, held, or a reject. With ``max_waiting`` a round asks for
    nothing while so many links wait for an answer.
    """
    given = as_of

    def run(responses: DataFrame, batch: int) -> None:
        tables.refresh()
        as_of = tables.time("crawl", batch, given)
        queue = tables.frontier(taken_before=batch).withColumn("url_id", F.col("url"))
        if max_waiting is not None and tables.waiting(batch - 1).limit(max_waiting).count() >= max_waiting:
            queue = queue.limit(0)
        taken, _ = dequeue(queue, sites, per_host)
        judged = durable(admit(taken, sites, rules, tables.read("visits", batch), as_of, agent, round_s, max_per_host=per_host))
        oldest = first_per_group(in_scope(queue, sites), ["host"], [F.col("created_at"), F.col("url_id")], per_host)
        # A link that a rate limit sends back stays; the others leave the queue: asked for, or rejected with the reason.
        back = judged.filter(F.col("reason") == TOO_FAST).select("url", "added")
        tables.write("taken", batch, oldest.join(back, ["url", "added"], "left_anti"))
        refused = judged.filter(~F.col("ok") & (F.col("reason") != TOO_FAST)).select("url", "reason")
        no_url = oldest.filter(~is_valid_url("url")).select("url", F.lit(NO_URL).alias("reason"))
        tables.write("asked", batch, judged.filter("ok").withColumn("asked_at", as_of))

        waiting = durable(tables.waiting(batch))
        fresh = responses.select(F.coalesce(normal_url("url"), "url").alias("url"), "status", "content_type", "body")
        answers = fresh.withColumn("arrived", F.lit(batch).cast("bigint")).unionByName(tables.held(batch))
        # Bodies move once, to where the first answer of their URL is found; what follows reads the stored rows.
        turn = F.row_number().over(Window.partitionBy("url").orderBy("arrived", F.xxhash64("status", "content_type", "body")))
        asked = waiting.groupBy("url").agg(F.min_by("depth", "added").alias("depth"))
        queued = tables.frontier(taken_before=batch + 1).select("url").distinct().withColumn("queued", F.lit(True))
        state = (
            F.when(F.col("turn") > 1, "answered before")
            .when(F.col("depth").isNotNull(), "asked")
            .when(F.col("queued"), "held")
            .otherwise("not asked for")
        )
        known = answers.withColumn("turn", turn).join(asked, "url", "left").join(queued, "url", "left")
        known = known.withColumn("state", state).persist()
        try:
            fetched = known.filter("state = 'asked'")
            pages, seen, errors = gate_content_type(fetched)
            tables.write("messages", batch, to_messages(pages.withColumnRenamed("body", "content"), as_of))
            tables.write("visits", batch, seen.select("url", as_of.alias("visited_at")))
            tables.write("early", batch, known.filter((F.col("state") == "held") & (F.col("arrived") == batch)))
            tables.write("spent", batch, known.filter((F.col("state") != "held") & (F.col("arrived") < batch)))
            answered = waiting.join(fetched.select("url"), "url", "left_semi")
            late = waiting.filter(F.col("asked_at") + F.expr(f"INTERVAL {answer_ttl}") <= as_of)
            late = late.join(fetched.select("url"), "url", "left_anti")
            tables.write("closed", batch, answered.unionByName(late))
            reasons = [
                known.filter(F.col("state").isin("not asked for", "answered before")).select("url", F.col("state").alias("reason")),
                errors.select("url", F.lit("unreadable content type").alias("reason")),
                late.select("url", F.lit("no answer").alias("reason")),
            ]
            rejects = reduce(DataFrame.unionByName, [*reasons, refused, no_url])
            tables.write("crawl_rejects", batch, rejects.withColumn("id", F.lit(None).cast("string")))
        finally:
            known.unpersist()

    return run


def embed_batch(
    tables: StageTables, as_of: Column | None = None, cfg: EmbedConfig = EmbedConfig()
) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: document ids → chunks.

    Unknown ids, documents without text and chunks with a bad vector go to the rejects of the stage.
    """
    given = as_of

    def run(ids: DataFrame, batch: int) -> None:
        tables.refresh()
        as_of = tables.time("embed", batch, given)
        wanted = ids.select(F.col("id").alias("doc_id")).distinct()
        found, missing = lookup_documents(wanted, tables.documents(ids=wanted))
        found = found.persist()
        try:
            made = index_documents(found, as_of, cfg).withColumn("bad", bad_vector(F.col("embedding"), cfg.dims)).persist()
            tables.write("chunks", batch, made.filter("not bad"))
            rejects = missing.select("doc_id", "reason").unionByName(
                found.filter("content = ''").select("doc_id", F.lit("empty text").alias("reason"))
            ).unionByName(made.filter("bad").select("doc_id", F.concat(F.lit("bad vector for chunk "), "chunk_id").alias("reason")))
            lost = rejects.select(F.col("doc_id").alias("id"), F.lit(None).cast("string").alias("url"), "reason")
            tables.write("embed_rejects", batch, lost)
            made.unpersist()
        finally:
            found.unpersist()

    return run


def _start(stream: DataFrame, run: Callable[[DataFrame, int], None], checkpoint: str, trigger: dict | None) -> StreamingQuery:
    return (
        stream.writeStream.foreachBatch(run)
        .option("checkpointLocation", checkpoint)
        .trigger(**(trigger or {"processingTime": ROUND_PAUSE}))
        .start()
    )


def start_crawl(
    responses: DataFrame, tables: StageTables, sites: DataFrame, rules: DataFrame, checkpoint: str,
    as_of: Column | None = None, trigger: dict | None = None, **options,
) -> StreamingQuery:
    """Crawl rounds, one per trigger; by default the next one comes a pause later."""
    run = crawl_batch(tables, sites, rules, as_of, **options)
    return _start(responses, run, checkpoint, trigger)


def start_parse(
    messages: DataFrame, tables: StageTables, sites: DataFrame, checkpoint: str,
    as_of: Column | None = None, trigger: dict | None = None,
) -> StreamingQuery:
    """Parse stage over a stream of messages. ``trigger={"availableNow": True}`` ends after what is there."""
    return _start(messages, parse_batch(tables, sites, as_of), checkpoint, trigger)


def start_embed(
    ids: DataFrame, tables: StageTables, checkpoint: str,
    as_of: Column | None = None, cfg: EmbedConfig = EmbedConfig(), trigger: dict | None = None,
) -> StreamingQuery:
    """Embed stage over a stream of document ids."""
    return _start(ids, embed_batch(tables, as_of, cfg), checkpoint, trigger)
