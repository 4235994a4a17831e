"""A mix of sources by target weights: how often each document is taken, from histograms of hashes.

Each document has a hash; a source takes its documents some whole number of times, and once more those
whose hash is below the source's threshold. The threshold comes from sums of sizes by source and the
first ``BITS`` bits of the hash: where their running total passes the source's budget lies the boundary
bucket, and only documents of that bucket are summed again by the next bits, until the boundary holds one
hash. Documents are never sorted and sources never gathered: what is shuffled are sums, at most
2**BITS for each source and task.

Cases: a null or empty text has size 0 and takes no words; a null source is a source of its own, last in
order; rows with one id share a hash and are taken together, as are rows without an id that have equal
texts; an empty table gives no rows; other columns stay as they are, but those with the names of result
columns are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fleetscope.llm.tables import set_aside, stored
from fleetscope.llm.textcols import n_words

WEIGHTS = (1, 2, 3)  # of the sources in order, repeating
MOST = 3  # times its own size that a source may take
HASH_BITS = 60
BITS = 12

_HASH = "__hash"


def hash_of(doc_id: str = "doc_id", text: str = "text") -> Column:
    """The first 60 bits of the md5 of the id, or of the text's md5 where there is no id."""
    key = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text:"), F.md5(F.coalesce(F.col(text), F.lit("")))))
    return F.conv(F.substring(F.md5(key), 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """Per source of (source, source_size): its weight and target.

    The sources share the total by weight. In order of size per weight, those that reach ``MOST`` times
    their size come first, so the common level is what is left over after them. One row per source runs
    through the ordered windows, never a document.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (rank % len(WEIGHTS) + 1).cast("int"))
    weighted = sizes.withColumn("weight", weight.cast("long"))
    order = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").asc_nulls_last())
    before, whole = order.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    sum_of = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))
    left = sum_of("source_size", whole) - MOST * sum_of("source_size", before)
    level = left / (sum_of("weight", whole) - sum_of("weight", before))
    cap = F.col("source_size") * MOST
    laid = weighted.withColumns({"__place": F.row_number().over(order), "__level": level})
    open_level = F.when(F.col("__level") * F.col("weight") <= cap, F.struct("__place", "__level"))
    first = F.min(open_level).over(whole)
    target = F.when(F.col("__place") >= first["__place"], first["__level"] * F.col("weight"))
    return laid.withColumn("target", F.coalesce(target, cap.cast("double"))).drop("__place", "__level")


def thresholds(sized: DataFrame) -> DataFrame:
    """Per source: source_size, target, whole (times that all documents are taken) and the threshold.

    ``sized`` has source, size and hash of each document.
    """
    sizes = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    shares = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = targets(sizes).withColumn("whole", F.least(shares, F.lit(MOST)).cast("long"))
    plan = plan.withColumn("budget", F.col("target") - F.col("whole") * F.col("source_size"))
    plan = stored(plan, "mix-targets")
    at = plan.select("source", "budget", F.lit(0).cast("long").alias("prefix"))
    for shift in range(HASH_BITS - BITS, -1, -BITS):
        bucket = F.shiftright(_HASH, shift)
        rows = sized.select(F.col("source").alias("own"), "size", _HASH, bucket.alias("bucket"))
        inside = F.shiftright(_HASH, shift + BITS) == F.col("prefix")
        rows = rows.join(at, F.col("own").eqNullSafe(F.col("source")) & inside)
        sums = rows.groupBy("source", "budget", "bucket").agg(
            F.sum("size").alias("n"), F.min(_HASH).alias("low"), F.max(_HASH).alias("high")
        )
        upto = F.sum("n").over(Window.partitionBy("source").orderBy("bucket"))
        boundary = sums.withColumn("upto", upto).where("upto > budget")
        boundary = boundary.groupBy("source").agg(
            F.min_by(F.struct("bucket", "budget", "n", "upto", "low", "high"), "bucket").alias("b")
        )
        before = F.col("b.upto") - F.col("b.n")
        at = boundary.select(
            "source",
            (F.col("b.budget") - before).alias("budget"),
            F.col("b.bucket").alias("prefix"),
            F.col("b.n").alias("n"),
            F.col("b.low").alias("low"),
            F.col("b.high").alias("high"),
        )
        at = stored(at, "mix-boundary")
        if at.where("low < high").isEmpty():
            break
    # the boundary is one hash now: it is taken if that comes nearer to the budget
    cut = at.select(
        F.col("source").alias("own"),
        F.when(F.col("budget") >= F.col("n") / 2, F.col("low") + 1).otherwise(F.col("low")).alias("threshold"),
    )
    joined = plan.join(cut, F.col("own").eqNullSafe(F.col("source")), "left").drop("own", "budget", "weight")
    return joined.withColumn("threshold", F.coalesce("threshold", F.lit(0).cast("long")))


_NEW = ["size", "source_size", "target", "copies", "taken"]


def copies(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with size, source_size, target, copies (how often the document is taken) and taken."""
    sized = docs.drop(*_NEW).withColumns({"size": n_words(F.col(text)), _HASH: hash_of(text=text)})
    plan = thresholds(stored(sized.select("source", "size", _HASH), "mix-sizes"))
    plan = stored(plan, "mix-plan")
    plan = plan.withColumnsRenamed({c: f"__{c}" for c in ("source", "whole", "threshold")})
    mixed = sized.join(plan, F.col("source").eqNullSafe(F.col("__source")))
    mixed = mixed.withColumn("copies", F.col("__whole") + (F.col(_HASH) < F.col("__threshold")).cast("long"))
    mixed = mixed.withColumn("taken", F.col("copies") * F.col("size"))
    return mixed.drop("__source", "__whole", "__threshold", _HASH)


def mix(docs: DataFrame, text: str = "text") -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it is taken, with the columns of ``docs``."""
    times = F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))
    plain, back = set_aside(docs, _NEW)
    return back(copies(plain, text).where("copies > 0").withColumn("__copy", times))


#: The same mix for DuckDB: documents in order of hash, taken as long as the budget lasts.
COPIES_SQL = r"""
with sized as (
  select doc_id, source, text,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
         ('0x' || substr(md5(coalesce(doc_id::varchar, 'text:' || md5(coalesce(text, '')))), 1, 15))::bigint as h
  from documents
), sources as (
  select source, sum(size)::bigint as source_size,
         1 + (row_number() over (order by source nulls last) - 1) % 3 as weight
  from sized group by source
), laid as (
  select *, row_number() over o as place,
         (sum(source_size) over () - 3 * coalesce(sum(source_size) over b, 0))::double
           / (sum(weight) over () - coalesce(sum(weight) over b, 0))::double as level
  from sources
  window o as (order by source_size::double / weight::double, source nulls last),
         b as (order by source_size::double / weight::double, source nulls last
               rows between unbounded preceding and 1 preceding)
), opened as (
  select min(place) as place, arg_min(level, place) as level from laid where level * weight <= 3 * source_size
), plan as (
  select source, source_size,
         case when l.place >= o.place then o.level * weight else (3 * source_size)::double end as target
  from laid l, opened o
), planned as (
  select *, case when source_size > 0 then least(floor(target / source_size), 3)::bigint else 0 end as whole from plan
), groups as (
  select s.source, s.h, sum(s.size)::bigint as n from sized s group by s.source, s.h
), running as (
  select *, (sum(n) over (partition by source order by h))::bigint as upto from groups
), picked as (
  select r.source, r.h,
         r.upto <= p.target - p.whole * p.source_size
         or (r.upto - r.n <= p.target - p.whole * p.source_size
             and p.target - p.whole * p.source_size - (r.upto - r.n) >= r.n / 2.0) as more
  from running r join planned p on r.source is not distinct from p.source
)
select s.doc_id, s.size, p.source_size, p.target, (s.size * (p.whole + k.more::bigint))::bigint as taken
from sized s join planned p on s.source is not distinct from p.source
join picked k on s.source is not distinct from k.source and s.h = k.h
"""
