"""Toxicity by the nearest labelled examples under exact TF-IDF cosine (operator 6)."""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructType

from .common import slices, stored

TERM = re.compile(r"[^\W\d_]+")
STEMS = (4, 5, 6, 7)  # beginnings of longer words that are terms too, written with a final star
FOLDS = 5


def fold(doc_id: Column) -> Column:
    """Documents of fold 0 are held out."""
    return F.crc32(doc_id.cast("string")) % FOLDS


def forms(word: str) -> list[str]:
    return [word, *(word[:n] + "*" for n in STEMS if n < len(word))]


class Space:
    """The terms that count: words of letters, in lower case, and their beginnings."""

    def __init__(self, names: list[str]):
        self.names = frozenset(names)
        # Every form of a word begins with the word's first letters, so most words are passed over by one look.
        self.heads = frozenset(t.rstrip("*")[: STEMS[0]] for t in names)

    def count(self, text: str | None) -> Counter:
        """How often each term stands in the text."""
        found: Counter = Counter()
        near = [w for w in TERM.findall((text or "").lower()) if w[: STEMS[0]] in self.heads]
        for word, n in Counter(near).items():
            for form in forms(word):
                if form in self.names:
                    found[form] += n
        return found


def document_frequencies(docs: DataFrame, space: Space, text: str = "text") -> DataFrame:
    """(term, n): the rows of ``docs`` with each term of the space; the term '' has the number of all rows.

    A task adds up the rows of a batch, so few rows are shuffled.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for part in slices(whole, "text"):
                found = Counter({"": part.num_rows})
                for t in part.column(0).to_pylist():
                    found.update(space.count(t).keys())
                yield pa.RecordBatch.from_arrays([pa.array(found.keys(), pa.string()), pa.array(found.values(), pa.int64())], ["term", "n"])

    texts = docs.select(F.col(text).cast("string").alias("text"))
    return texts.mapInArrow(count, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n"))


class BlockMaxIndex:
    """Postings of weighted terms over labelled examples, cut into blocks of examples with each term's maximum.

    ``nearest`` is exact: blocks are read in the order of their upper bound, and reading stops once the bound of the
    next block cannot beat the k-th best cosine found. Ties in cosine go to the smaller example id.
    """

    def __init__(self, vectors: list[dict[str, float]], ids: list[int], labels: list[int], block: int = 64):
        order = sorted(range(len(ids)), key=lambda i: ids[i])
        self.ids = np.array([ids[i] for i in order], np.int64)
        self.labels = np.array([labels[i] for i in order], np.float64)
        self.block, self.n_blocks = block, -(-len(order) // block)
        lists: dict[str, list[tuple[int, float]]] = {}
        for row, i in enumerate(order):
            for term, weight in vectors[i].items():
                lists.setdefault(term, []).append((row, weight))
        self.rows = {t: np.array([r for r, _ in p], np.int64) for t, p in lists.items()}
        self.weights = {t: np.array([w for _, w in p]) for t, p in lists.items()}
        self.starts = {t: np.searchsorted(r, np.arange(self.n_blocks + 1) * block) for t, r in self.rows.items()}
        self.peaks = {}
        for t, rows in self.rows.items():
            peak = np.zeros(self.n_blocks)
            np.maximum.at(peak, rows // block, self.weights[t])
            self.peaks[t] = peak

    def nearest(self, query: dict[str, float], k: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, cosines) of the k examples with the greatest positive cosine to a unit ``query``."""
        known = [(t, q) for t, q in query.items() if t in self.rows]
        if not known:
            return np.zeros(0, np.int64), np.zeros(0)
        bounds = sum(q * self.peaks[t] for t, q in known)
        best_rows, best = np.zeros(0, np.int64), np.zeros(0)
        for b in np.argsort(-bounds, kind="stable"):
            if bounds[b] <= 0 or len(best) == k and bounds[b] < best[-1] - 1e-12:
                break
            scores = np.zeros(self.block)
            for t, q in known:
                a, z = self.starts[t][b], self.starts[t][b + 1]
                scores[self.rows[t][a:z] - b * self.block] += q * self.weights[t][a:z]
            hit = np.flatnonzero(scores > 0)
            best_rows, best = np.r_[best_rows, hit + b * self.block], np.r_[best, scores[hit]]
            top = np.lexsort((best_rows, -best))[:k]
            best_rows, best = best_rows[top], best[top]
        return best_rows, best


class Model:
    """Term weights, the index of examples, and the vote."""

    def __init__(self, idf: dict[str, float], index: BlockMaxIndex, prior: float, k: int, prior_weight: float):
        self.idf, self.index, self.prior, self.k, self.prior_weight = idf, index, prior, k, prior_weight
        self.space = Space(list(idf))

    def score(self, text: str | None) -> tuple[float, list[int]]:
        """(probability, ids of the voting examples, nearest first).

        Votes weigh 1 / (1 - cosine + 0.1), the prior counts as ``prior_weight`` such votes at cosine 0.
        """
        query = unit_vector(self.space.count(text), self.idf)
        if not query:
            return self.prior, []
        rows, cosines = self.index.nearest(query, self.k)
        votes = 1.0 / (1.1 - np.minimum(cosines, 1.0))
        base = self.prior_weight / 1.1
        total = float(votes @ self.index.labels[rows]) + base * self.prior
        return total / (float(votes.sum()) + base), self.index.ids[rows].tolist()


def unit_vector(counts: dict[str, int], idf: dict[str, float]) -> dict[str, float]:
    weights = {t: (1.0 + math.log(n)) * idf[t] for t, n in sorted(counts.items())}
    norm = math.sqrt(sum(w * w for w in weights.values()))
    return {t: w / norm for t, w in weights.items()} if norm else {}


def hash_text(text: str) -> int:
    from xxhash import xxh64_intdigest

    return xxh64_intdigest(text) - 2**63


def fit(
    docs: DataFrame,
    labels: DataFrame,
    max_examples: int = 2000,
    min_contexts: int = 5,
    k: int = 15,
    prior_weight: float = 1.0,
    label: str = "toxic",
    text: str = "text",
) -> Model:
    """Learn from at most ``max_examples`` rows of each label outside fold 0, taken in the order of a hash of the id.

    Terms of the vector space are all that mark label 1 (G statistic above chance among so many terms, and at least four
    times the share of label 0), counted in distinct contexts (a word with both neighbours), so copies of one text count
    once. Words that do not mark a label have no dimension: with them, cosines say which texts share a subject or a
    language. Document frequencies are those of all rows of ``docs``. Without an example of either label the space is
    empty and every score is the prior. Only the bounded examples, reduced to these terms, and one number per term reach
    the driver.
    """
    known = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("bigint").alias("label_id"), (F.col(label) > 0).cast("int").alias("y")
    )
    train = known.filter(fold(F.col("label_id")) != 0).distinct()
    share = train.agg(F.avg("y"), F.count(F.lit(1))).first()
    mark = F.xxhash64(F.lit("example"), "label_id")
    picked = None
    for y in (0, 1):
        part = train.filter(F.col("y") == y).orderBy(mark, "label_id").limit(max_examples)
        picked = part if picked is None else picked.union(part)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    # A few thousand ids at most, by the limits above.
    examples = rows.join(F.broadcast(picked), F.col("doc_id") == F.col("label_id")).select("doc_id", "y", "text")

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1_000_000):
                out: dict[str, list] = {"term": [], "context": [], "y": []}
                for t, y in zip(part.column(1).to_pylist(), part.column(0).to_pylist(), strict=True):
                    words = ["", *TERM.findall((t or "").lower()), ""]
                    around = [(w, hash_text(f"{a} {w} {b}")) for a, w, b in zip(words, words[1:], words[2:], strict=False)]
                    pairs = {(form, c) for w, c in around for form in forms(w)}
                    out["term"] += [w for w, _ in pairs]
                    out["context"] += [c for _, c in pairs]
                    out["y"] += [y] * len(pairs)
                yield pa.RecordBatch.from_pydict(out, schema=pa.schema([("term", pa.string()), ("context", pa.int64()), ("y", pa.int32())]))

    found = examples.select("y", "text").mapInArrow(contexts, "term string, context bigint, y int")
    both = found.distinct().groupBy("term").agg(F.sum("y").alias("p"), F.sum(F.lit(1) - F.col("y")).alias("q"))
    counts = stored(both, "terms")
    totals = counts.agg(F.sum("p").alias("all_p"), F.sum("q").alias("all_q"), F.count(F.lit(1)).alias("n")).first()
    all_p, all_q = float(totals["all_p"] or 0), float(totals["all_q"] or 0)
    prior = float(share[0]) if share[1] else 0.5
    if not all_p or not all_q:
        return Model({}, BlockMaxIndex([], [], []), prior, k, prior_weight)
    p, q = F.col("p"), F.col("q")
    expected = (p + q) * (all_p / (all_p + all_q))
    gain = p * F.log(p / expected) + F.when(q > 0, q * F.log(q / (p + q - expected))).otherwise(0.0)
    marks = counts.withColumn("gain", gain).filter(
        (p >= min_contexts) & ((p / all_p) >= 4 * (q + 1) / all_q) & (F.col("gain") > math.log(totals["n"]) + 5)
    )
    space = Space([r["term"] for r in marks.select("term").collect()])

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", 1_000_000):
                texts = part.column(2).to_pylist()
                kept = [sorted(space.count(x).items()) for x in texts]
                kinds = pa.list_(pa.struct([("t", pa.string()), ("n", pa.int64())]))
                packed = pa.array([[{"t": t, "n": n} for t, n in row] for row in kept], kinds)
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), packed], ["doc_id", "y", "terms"])

    vectors = examples.mapInArrow(reduce, "doc_id bigint, y int, terms array<struct<t:string,n:bigint>>").collect()
    df = {r["term"]: r["n"] for r in document_frequencies(docs, space, text).collect()}
    idf = {t: math.log((1 + df[""]) / (1 + df[t])) + 1.0 for t in sorted(space.names)}
    rows_used = sorted({(r["doc_id"], r["y"], tuple((t["t"], t["n"]) for t in r["terms"])) for r in vectors if r["terms"]})
    units = [unit_vector(dict(ts), idf) for _, _, ts in rows_used]
    index = BlockMaxIndex(units, [r[0] for r in rows_used], [r[1] for r in rows_used])
    return Model(idf, index, prior, k, prior_weight)


def _scored(docs: DataFrame, model: Model, name: str, text: str, evidence: str) -> DataFrame:
    """All columns of ``docs``, the score, and the ids of the voting examples."""
    at = docs.columns.index(text)
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by max_examples

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for whole in batches:
            for part in slices(whole, whole.schema.names[at]):
                found = [m.score(t) for t in part.column(at).to_pylist()]
                votes = pa.array([e for _, e in found], pa.list_(pa.int64()))
                columns = [*part.columns, pa.array([s for s, _ in found], pa.float64()), votes]
                yield pa.RecordBatch.from_arrays(columns, [*part.schema.names, name, evidence])

    return docs.mapInArrow(add, StructType([*docs.schema.fields]).add(name, DoubleType()).add(evidence, ArrayType(LongType())))


def score_documents(docs: DataFrame, labels: DataFrame, text: str = "text", **options) -> DataFrame:
    """(doc_id, held_out, score, predicted, evidence) of every row; ``options`` go to ``fit``.

    Null and empty texts, and texts with no term of the space, score the share of label 1. ``evidence`` has the ids of
    the examples that voted, nearest first. Repeated rows come out once each; a null id is not held out; columns other
    than id and text are not read. Ids labelled twice with different labels teach both. Empty tables are fine.
    """
    model = fit(docs, labels, text=text, **options)
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text"))
    scored = _scored(rows, model, "score", "text", "evidence")
    return scored.select(
        "doc_id",
        F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "evidence",
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, text: str = "text", **options) -> DataFrame:
    """The rows of ``docs``, all columns, that score below ``threshold`` or have no evidence against them.

    See ``score_documents`` for odd rows; a text that no example votes on stays, however many labels are 1.
    """
    model = fit(docs, labels, text=text, **options)
    name = "_score_" + "_".join(docs.columns)
    typed = docs.withColumn(text, F.col(text).cast("string"))
    scored = _scored(typed, model, name, text, name + "_by")
    return scored.filter((F.col(name) < threshold) | (F.size(name + "_by") == 0)).drop(name, name + "_by")
