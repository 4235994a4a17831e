"""Ranked lexical search over an inverted index, by accumulators and by document at once.

``build`` writes the index: each task turns about ``SEGMENT_BYTES`` of text at a time into a segment, which has
its documents' ids and lengths and, for each term, the documents that hold it and how often. ``search`` scores
a set of queries against all segments. Within a segment, a query's short lists are added up term at a time
in accumulators. From there on these are one more list, with the greatest sum in each window of documents as
its bound. It goes document at a time together with the long lists: windows are passed over whose
bounds do not add up to the query's kth score so far, and a window is left as soon as what is still to come
cannot lift any of its documents there. A task keeps the best ``k`` of each query from segment to segment, so
that score rises early and ``k`` rows per query and task are all that is shuffled.

Queries go in blocks of about ``BLOCK_TERMS`` terms; the terms of a block are all that the driver and each task
hold besides a segment. A query of more terms than that makes a larger block.

Scores are whole numbers. N documents have terms, L is the number of their terms; a document has n, holds the
term tf times, and df documents hold it: ``floor(1000 ln((2N + 2) / (2df + 1))) * (10^9 tf div (1000 tf + 20m))``
with ``m = 50 + (50 n N) div L``, summed over a query's distinct terms.

Cases: null and empty texts have no terms, are found by no query and do not count in N; a query without
terms finds nothing; rows are documents and queries of their own also where ids repeat or are null; equal
scores go by id, null last; an empty table of documents or queries gives no rows; further columns are ignored.
Terms are told by 64 bits of hash.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.llm import words
from fleetscope.llm.tables import stored

SEGMENT_BYTES = 8 << 20
SEGMENTS_PER_FILE = 4
BLOCK_TERMS = 1 << 16
#: A list is long if it has more than one in so many documents of its segment.
LONG = 16
WINDOW = 128

_PACKED = {"lengths": "<i8", "terms": "<u8", "begins": "<i8", "holders": "<i4", "counts": "<i4"}


def _distinct(groups: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Where runs of equal (group, value) begin."""
    new = np.ones(len(groups), dtype=bool)
    new[1:] = (groups[1:] != groups[:-1]) | (values[1:] != values[:-1])
    return np.flatnonzero(new)


def _segment(batch: pa.RecordBatch) -> dict[str, np.ndarray]:
    found = words.words(batch.column("text"), words.ALNUM)
    order = np.argsort(found.hashes, kind="stable")
    terms, docs = found.hashes[order], found.documents()[order]
    first = _distinct(terms, docs)
    counts = np.diff(np.append(first, len(terms)))
    terms, docs = terms[first], docs[first]
    begins = np.flatnonzero(np.append(True, terms[1:] != terms[:-1])) if len(terms) else np.zeros(0, np.int64)
    return {
        "lengths": found.counts,
        "terms": terms[begins],
        "begins": np.append(begins, len(terms)),
        "holders": docs,
        "counts": counts,
    }


def build(docs: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> None:
    """Write the index of all rows of ``docs`` to ``path``, one row per segment."""
    kind = docs.schema[key].dataType
    fields = [T.StructField("n_docs", T.LongType()), T.StructField("n_terms", T.LongType())]
    fields += [T.StructField("ids", T.ArrayType(kind)), *(T.StructField(c, T.BinaryType()) for c in _PACKED)]
    names = [f.name for f in fields]

    def run(batches):
        for whole in batches:
            for batch in words.slices(whole, "text", SEGMENT_BYTES):
                batch = batch.take(pc.sort_indices(batch, [("id", "ascending")], null_placement="at_end"))
                ids = batch.column("id")
                parts = _segment(batch)
                row = [pa.array([int((parts["lengths"] > 0).sum())]), pa.array([int(parts["lengths"].sum())])]
                row.append(pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids))
                row += [pa.array([parts[c].astype(t).tobytes()], pa.binary()) for c, t in _PACKED.items()]
                yield pa.RecordBatch.from_arrays(row, names)

    segments = docs.select(F.col(key).alias("id"), F.col(text).alias("text")).mapInArrow(run, T.StructType(fields))
    segments.write.option("maxRecordsPerFile", SEGMENTS_PER_FILE).parquet(path, compression="zstd")


def _with_terms(queries: DataFrame, key: str, text: str) -> DataFrame:
    """Columns q (a number of the row), key and terms (distinct hashes, as long)."""
    numbered = queries.select(F.monotonically_increasing_id().alias("q"), F.col(key).alias("key"), F.col(text).alias("text"))
    schema = T.StructType([*numbered.schema.fields[:2], T.StructField("terms", T.ArrayType(T.LongType()))])

    def run(batches):
        for batch in batches:
            found = words.words(batch.column("text"), words.ALNUM)
            lists = [np.unique(found.hashes[a:b]).view(np.int64) for a, b in zip(found.first, found.first[1:])]
            bounds = np.concatenate(([0], np.cumsum([len(x) for x in lists]))).astype(np.int64)
            flat = np.concatenate([np.zeros(0, np.int64), *lists])
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], words.list_of(flat, bounds, pa.int64())], schema.names)

    return numbered.mapInArrow(run, schema)


class Segment:
    """A segment with what the terms of a block of queries need of it."""

    def __init__(self, row: dict, terms: np.ndarray, weights: np.ndarray, n: int, total: int):
        lengths, own, begins, holders, counts = (np.frombuffer(row[c], t) for c, t in _PACKED.items())
        self.ids, self.size = row["ids"], len(lengths)
        self.edges = np.arange(0, self.size, WINDOW)
        at = np.minimum(np.searchsorted(own, terms), max(len(own) - 1, 0))
        there = np.flatnonzero(own[at] == terms) if len(own) else np.zeros(0, np.int64)
        m = 50 + (50 * lengths * n) // total
        self.lists: dict[int, tuple] = {}
        self.long: dict[int, tuple] = {}
        for k, a, b in zip(there.tolist(), begins[at[there]].tolist(), begins[at[there] + 1].tolist()):
            docs, tf = holders[a:b], counts[a:b].astype(np.int64)
            gains = weights[k] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[docs]))
            if len(docs) * LONG <= self.size:
                self.lists[k] = docs, gains
            else:
                cuts = np.searchsorted(docs, np.append(self.edges, self.size))
                most = np.zeros(len(self.edges), dtype=np.int64)
                np.maximum.at(most, docs // WINDOW, gains)
                self.long[k] = docs, gains, cuts.tolist(), most

    def best(self, terms: list[int], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of at least the k best documents of those that score ``floor`` or more."""
        sums = np.zeros(self.size, dtype=np.int64)
        for t in terms:
            if t in self.lists:
                docs, gains = self.lists[t]
                sums[docs] += gains  # a list names a document once
        bound = np.maximum.reduceat(sums, self.edges)
        long = [self.long[t] for t in terms if t in self.long]
        for one in long:
            bound = bound + one[3]
        places, scores, held = [], [], 0
        for w in np.flatnonzero(bound >= floor).tolist():
            if bound[w] < floor:
                continue
            low = w * WINDOW
            score = sums[low : low + WINDOW].copy()
            ahead = sorted(((int(one[3][w]), i) for i, one in enumerate(long)), reverse=True)
            rest = sum(b for b, _ in ahead)
            for most, i in ahead:
                if not most or int(score.max()) + rest < floor:
                    break
                docs, gains, cuts, _ = long[i]
                a, b = cuts[w], cuts[w + 1]
                score[docs[a:b] - low] += gains[a:b]
                rest -= most
            if rest:
                continue  # what was still to come could lift no document of the window to the floor
            good = np.flatnonzero(score >= floor)
            places.append(good + low)
            scores.append(score[good])
            held += len(good)
            if held >= 2 * k:
                places, scores = _top(np.concatenate(places), np.concatenate(scores), k)
                floor, held, places, scores = max(floor, int(scores.min())), k, [places], [scores]
        if not held:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return _top(np.concatenate(places), np.concatenate(scores), k)


def _top(places: np.ndarray, scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The k highest scores, equal ones by place."""
    order = np.lexsort((places, -scores))[:k]
    return places[order], scores[order]


def _hits(index: DataFrame) -> T.StructType:
    kind = index.schema["ids"].dataType.elementType
    return T.StructType([T.StructField("q", T.LongType()), T.StructField("id", kind), T.StructField("score", T.LongType())])


def _search_block(index: DataFrame, block: list, k: int, n: int, total: int) -> DataFrame:
    """Columns q, id, score: the best of each task for the queries of ``block`` (rows of q and terms)."""
    spark = index.sparkSession
    terms = np.unique(np.concatenate([np.zeros(0, np.int64), *(np.array(r["terms"], np.int64) for r in block)]).view(np.uint64))
    shared = spark.sparkContext.broadcast(terms)

    def holders(batches):
        for batch in batches:
            for row in batch.to_pylist():
                own, begins = np.frombuffer(row["terms"], "<u8"), np.frombuffer(row["begins"], "<i8")
                _, here, there = np.intersect1d(shared.value, own, assume_unique=True, return_indices=True)
                yield pa.RecordBatch.from_arrays([pa.array(here), pa.array(begins[there + 1] - begins[there])], ["k", "df"])

    counted = index.select("terms", "begins").mapInArrow(holders, "k long, df long").groupBy("k").agg(F.sum("df").alias("df"))
    weights = np.zeros(len(terms), dtype=np.int64)
    for r in counted.collect():  # one row per term of the block at most
        weights[r["k"]] = math.floor(1000 * math.log((2 * n + 2) / (2 * r["df"] + 1)))
    asked = [(r["q"], np.searchsorted(terms, np.array(r["terms"], np.int64).view(np.uint64)).tolist()) for r in block]
    plan = spark.sparkContext.broadcast((asked, weights))
    schema = _hits(index)

    def run(batches):
        asked, weights = plan.value
        held: list[list] = [[] for _ in asked]  # (score, id), best first, at most k
        kind = None
        for batch in batches:
            kind = batch.schema.field("ids").type.value_type
            for row in batch.to_pylist():
                segment = Segment(row, shared.value, weights, n, total)
                for place, (_, wanted) in enumerate(asked):
                    own = held[place]
                    places, scores = segment.best(wanted, k, own[-1][0] if len(own) >= k else 1)
                    if len(places):
                        own += zip(scores.tolist(), [segment.ids[p] for p in places.tolist()])
                        own.sort(key=lambda r: (-r[0], r[1] is None, r[1] if r[1] is not None else 0))
                        del own[k:]
        if kind is not None:
            flat = [(q, i, s) for (q, _), own in zip(asked, held) for s, i in own]
            columns = list(zip(*flat)) or [(), (), ()]
            kinds = (pa.int64(), kind, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds)], schema.names)

    return index.drop("n_docs", "n_terms").mapInArrow(run, schema)


def search(
    spark: SparkSession, path: str, queries: DataFrame, k: int, key: str = "item_id", text: str = "text"
) -> DataFrame:
    """Columns ``key``, rank (from 1), id (of the document) and score: each query's k best documents."""
    index = spark.read.parquet(path)
    sums = index.agg(F.sum("n_docs").alias("n"), F.sum("n_terms").alias("total")).first()
    items = stored(_with_terms(queries, key, text), "queries")
    pairs = items.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0)).alias("n")).first()["n"] if sums["total"] else 0
    n_blocks = math.ceil(pairs / BLOCK_TERMS)
    found = []
    for b in range(n_blocks):
        in_block = (F.pmod(F.xxhash64("q"), F.lit(n_blocks)) == b) & (F.size("terms") > 0)
        found.append(_search_block(index, items.where(in_block).select("q", "terms").collect(), k, sums["n"], sums["total"]))
    best = found[0] if found else spark.createDataFrame([], _hits(index))
    for one in found[1:]:
        best = best.unionByName(one)
    order = Window.partitionBy("q").orderBy(F.desc("score"), F.asc_nulls_last("id"))
    ranked = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(items.select("q", "key"), "q").select(F.col("key").alias(key), "rank", "id", "score")


#: The same for DuckDB over the tables documents and benchmark; {k} is the number of documents per query.
SEARCH_SQL = r"""
with words as (
    select row_number() over () as d, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') as terms
    from documents
),
docs as (select d, doc_id, len(terms)::bigint as n, terms from words where len(terms) > 0),
totals as (select count(*)::bigint as docs, sum(n)::bigint as terms from docs),
postings as (select d, term, count(*)::bigint as tf from (select d, unnest(terms) as term from docs) group by d, term),
asked as (
    select distinct item_id, unnest(regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark
),
weights as (
    select term, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)))::bigint as w
    from postings, totals group by term, docs
),
scores as (
    select item_id, d, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (50 + (50 * n * t.docs) // t.terms))))::bigint as score
    from asked join weights using (term) join postings using (term) join docs using (d), totals t
    group by item_id, d
),
ranked as (
    select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
    from scores join docs using (d) where score > 0
)
select item_id, rank, doc_id, score from ranked where rank <= {k}
"""
