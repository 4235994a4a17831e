"""Near-duplicate documents: similarity sketches filled by rounds of hashed placement, bands, exact checks.

A document's set holds its distinct shingles of words. Its sketch has one coordinate for each of
``COORDINATES`` bins: in each round every element is hashed to one bin and the least value there counts;
a bin keeps what the earliest round put there. After as many rounds as there are bins, further rounds
hash all elements into one bin each, so every coordinate of a set that isn't empty is filled, and equal
coordinates estimate the similarity as closely as independent ones would.

Documents that agree in a whole band of coordinates share a bucket. Links are confirmed on the full sets.
Within a bucket pairs are not listed: members are compared with one member as centre, components are
merged, and only buckets that still hold several components go on with sixteen, then 256, and so on,
until all members have been centres. From the second centre on a pair is compared only if the sketches
agree well enough, by one bit of each coordinate, and if the parities of the sets allow a link: each of
``PARITIES`` classes of shingles has one bit, whether the set holds an odd number of them, and two sets
differ in at least as many shingles as in bits. So documents that have a passage in common, or are alike
but not enough, may share buckets without being compared in full. Every pair that shares a bucket is thus
compared, connected already, or unlike, and large groups cost about one comparison for each member.

Exact copies are one node, told apart from other texts by 64 bits of hash. Components are found by
passing the least label along links and jumping along labels; links and labels stay in tables of the
shared folder.

Cases: texts that are null, empty or without words have no shingles and are linked with nothing; texts
with fewer words than a shingle have one; repeated rows and rows with one id are rows of their own; null
ids are never the least id of a group unless it has no other; an empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.llm import textcols, words
from fleetscope.llm.tables import stored

ROWS, BANDS = 6, 42  # a link of similarity 0.8 shares no band once in 340,000 times
COORDINATES = ROWS * BANDS
UNLIKE = 54  # bits in which sketches may differ; a link of 0.8 differs in 25, in more than 54 once in 4 * 10**7 times
PARITIES = 1024
_SIGNS = [f"s{i}" for i in range(-(-COORDINATES // 64))]
_ODD = [f"p{i}" for i in range(PARITIES // 64)]
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_U = np.uint64


def distinct_shingles(texts: pa.Array, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of each text, sorted, and where each text's begin."""
    flat, bounds = words.shingles(words.words(texts), k)
    sets = [np.unique(flat[a:b]) for a, b in zip(bounds[:-1], bounds[1:])]
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    return np.concatenate([np.zeros(0, _U), *sets]), np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes)))


def sketches(flat: np.ndarray, bounds: np.ndarray, size: int = COORDINATES) -> np.ndarray:
    """One row of ``size`` coordinates for each set; a coordinate is the round and the least value in it."""
    n = len(bounds) - 1
    table = np.full(n * size, _EMPTY)
    owner = np.repeat(np.arange(n), np.diff(bounds))
    for step in range(2 * size):
        if not len(flat):
            break
        h = words.mix(flat ^ words.mix(np.array([step + 1], dtype=_U)))
        if step < size:
            bins = ((h >> _U(32)) * _U(size) >> _U(32)).astype(np.int64)
        else:
            bins = np.full(len(flat), step - size)
        value = (h & _U(0xFFFFFFFF)) | _U(step << 32)
        np.minimum.at(table, owner * size + bins, value)
        open_sets = (table.reshape(n, size) == _EMPTY).any(axis=1)
        still = open_sets[owner]
        if not still.all():
            flat, owner = flat[still], owner[still]
    return table.reshape(n, size)


def bands(table: np.ndarray) -> np.ndarray:
    """One hash for each band of coordinates; the bands of different places never meet."""
    parts = table.reshape(len(table), BANDS, ROWS)
    out = np.broadcast_to(np.arange(1, BANDS + 1, dtype=_U), parts.shape[:2]).copy()
    for row in range(ROWS):
        out = words.mix(out + parts[:, :, row])
    return out.astype(np.int64)


def signs(table: np.ndarray) -> np.ndarray:
    """One bit of each coordinate: the same where coordinates agree, and by chance where they don't."""
    bits = np.packbits((table & _U(1)).astype(bool), axis=1)
    return np.pad(bits, ((0, 0), (0, -bits.shape[1] % 8))).view(np.int64)


def parities(flat: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """``PARITIES`` bits of each set: whether it holds an odd number of the shingles of a class. What two sets
    have in common cancels out, so bits that differ are never more than shingles that only one of them has."""
    n = len(bounds) - 1
    place = (words.mix(flat ^ _U(PARITIES)) >> _U(32)) % _U(PARITIES)
    at = np.repeat(np.arange(n) * PARITIES, np.diff(bounds)) + place.astype(np.int64)
    odd = np.bincount(at, minlength=n * PARITIES).reshape(n, PARITIES) & 1
    return np.packbits(odd.astype(bool), axis=1).view(np.int64)


def _sketched(docs: DataFrame, k: int) -> DataFrame:
    """doc_id, key, n_shingles, bands and bits (signs and parities); of equal texts in a batch only the first
    has the last two."""
    words.use_batches(docs.sparkSession)

    def run(batches):
        for whole in batches:
            for batch in words.slices(whole, "text"):
                flat, bounds = distinct_shingles(batch.column("text"), k)
                keys = batch.column("key").to_numpy()
                first = np.zeros(len(keys), dtype=bool)
                first[np.unique(keys, return_index=True)[1]] = True
                n = np.diff(bounds)
                full = np.flatnonzero(first & (n > 0))
                member = np.repeat(first, n)
                own = np.concatenate((np.zeros(1, np.int64), np.cumsum(n[full])))
                table = sketches(flat[member], own)
                found, bits = bands(table), np.hstack((signs(table), parities(flat[member], own)))
                at = np.zeros(len(keys) + 1, dtype=np.int64)
                at[1:][full] = BANDS
                columns = [batch.column("doc_id"), batch.column("key"), pa.array(n)]
                columns.append(words.list_of(found.ravel(), np.cumsum(at), pa.int64()))
                columns.append(words.list_of(bits.ravel(), np.cumsum(at // BANDS * bits.shape[1]), pa.int64()))
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "key", "n", "bands", "bits"])

    return docs.mapInArrow(run, "doc_id long, key long, n long, bands array<long>, bits array<long>")


def _sets(rows: DataFrame, k: int) -> DataFrame:
    """key and distinct shingles of each row."""

    def run(batches):
        for whole in batches:
            for batch in words.slices(whole, "text"):
                flat, bounds = distinct_shingles(batch.column("text"), k)
                column = words.list_of(flat.astype(np.int64), bounds, pa.int64())
                yield pa.RecordBatch.from_arrays([batch.column("key"), column], ["key", "shingles"])

    return rows.select("key", "text").mapInArrow(run, "key long, shingles array<long>")


def components(links: DataFrame) -> DataFrame:
    """(key, component) of every key in the links (a, b); a component is named by its least key."""
    both = links.select(F.col("a").alias("key"), F.col("b").alias("other"))
    both = stored(both.union(links.select("b", "a")), "links")
    labels = both.groupBy("key").agg(F.min("other").alias("least"))
    labels = stored(labels.select("key", F.least("key", "least").alias("component")), "labels")
    while True:
        other = labels.select(F.col("key").alias("other"), F.col("component").alias("theirs"))
        near = both.join(other, "other").groupBy("key").agg(F.min("theirs").alias("theirs"))
        closer = labels.join(near, "key").withColumn("next", F.least("component", "theirs"))
        jump = labels.select(F.col("key").alias("next"), F.col("component").alias("far"))
        moved = closer.join(jump, "next").select("key", "component", F.least("next", "far").alias("moved"))
        moved = stored(moved, "labels")
        labels = moved.select("key", F.col("moved").alias("component"))
        if moved.where("component <> moved").isEmpty():
            return labels


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    left = sets.select(F.col("key").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("key").alias("b"), F.col("shingles").alias("sb"))
    both = F.size(F.array_intersect("sa", "sb"))
    sized = pairs.join(left, "a").join(right, "b").select("a", "b", both.alias("n"), F.size("sa") + F.size("sb"))
    sized = sized.toDF("a", "b", "n", "total")
    return sized.where(100 * F.col("n") >= percent * (F.col("total") - F.col("n"))).select("a", "b")


def _pairs(members: DataFrame, centres: DataFrame, percent: int) -> DataFrame:
    """Distinct (a, b), a below b, of members and centres of one bucket in different components whose
    sizes, and signs and parities where they are there, allow a link."""
    renamed = {"key": "k2", "n": "n2", "component": "c2"} | {s: f"{s}_2" for s in _SIGNS + _ODD}
    centres = centres.withColumnsRenamed(renamed)
    fits = (F.col("component") != F.col("c2")) & (100 * F.least("n", "n2") >= percent * F.greatest("n", "n2"))
    if _SIGNS[0] in members.columns:
        apart = [sum((F.bit_count(F.col(s).bitwiseXOR(F.col(f"{s}_2"))) for s in b), F.lit(0)) for b in (_SIGNS, _ODD)]
        fits &= (apart[0] <= UNLIKE) & ((100 + percent) * apart[1] <= (100 - percent) * (F.col("n") + F.col("n2")))
    met = members.join(centres, "band").where(fits)
    return met.select(F.least("key", "k2").alias("a"), F.greatest("key", "k2").alias("b")).distinct()


def classes(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, key (hash of the text), n_shingles and component, null
    without shingles."""
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("key"))
    rows = stored(_sketched(keyed, k), "sketches")
    banded = rows.select("key", "n", F.explode("bands").alias("band"))
    buckets = banded.groupBy("band").agg(F.min("key").alias("low"), F.max("key").alias("high"))
    shared = stored(buckets.where("low < high").select("band"), "buckets")
    members = stored(banded.join(shared, "band").distinct(), "members")
    firsts = rows.where("n > 0").groupBy("key").agg(F.min("doc_id").alias("first_id"))
    wanted = firsts.join(members.select("key").distinct(), "key").withColumnRenamed("key", "first_key")
    same = F.col("doc_id").eqNullSafe(F.col("first_id")) & (F.col("key") == F.col("first_key"))
    sets = stored(_sets(keyed.join(wanted, same, "left_semi").dropDuplicates(["doc_id", "key"]), k), "sets")

    spark = docs.sparkSession
    tested = links = spark.createDataFrame([], "a long, b long")
    named = spark.createDataFrame([], "key long, component long")
    # the least key of each bucket is its first centre, and after that come ever larger shares of the
    # members in an order that all buckets have in common, so that those of one group share centres
    before, upto = 0, 0
    while True:
        labelled = members.join(named, "key", "left").withColumn("component", F.coalesce("component", "key"))
        sizes = labelled.groupBy("band").agg(
            F.count("*").alias("members"),
            F.min("key").alias("first"),
            F.min("component").alias("low"),
            F.max("component").alias("high"),
        )
        still_open = sizes.where((F.col("low") < F.col("high")) & (F.col("members") > before))
        labelled = stored(labelled.join(still_open.select("band", "members", "first"), "band"), "open-buckets")
        if labelled.isEmpty():
            break
        place = F.pmod(F.xxhash64("key"), F.lit(1 << 30)) * F.col("members") / (1 << 30)
        chosen = (place >= before) & (place < upto) if upto else F.col("key") == F.col("first")
        centres = labelled.where(chosen).drop("members", "first")
        pairs = _pairs(labelled.drop("members", "first"), centres, percent)
        pairs = stored(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = tested.union(pairs)
        found = stored(_verified(pairs, sets, percent), "links")
        if not found.isEmpty():
            links = links.union(found)
            named = components(links)
        # a bucket that is closed stays closed; what is still open goes on with the bits of its members
        members = labelled.drop("members", "first", "component")
        if not upto:
            bits = [F.col("bits")[i].alias(s) for i, s in enumerate(_SIGNS + _ODD)]
            known = rows.where(F.size("bits") > 0).select("key", *bits).dropDuplicates(["key"])
            members = members.join(known, "key")
        before, upto = upto, max(16, upto * 16)
    component = F.when(F.col("n") > 0, F.coalesce("component", "key")).alias("component")
    return rows.join(named, "key", "left").select("doc_id", "key", F.col("n").alias("n_shingles"), component)


def with_least_id(rows: DataFrame) -> DataFrame:
    """The rows of ``classes`` with component_id, the least doc_id of the component, and kept (it is the row's own)."""
    least = rows.where("component is not null").groupBy("component").agg(F.min("doc_id").alias("least"))
    own = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("least"))
    named = rows.join(least, "component", "left").withColumn("component_id", own)
    return named.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def deduplicate(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with one document of each group of near copies, that of the least id, and all documents
    without words. Of rows that are alike in id and text one stays."""
    rows = stored(classes(docs.select("doc_id", "text"), k, percent), "classes")
    linked = rows.where("component is not null")
    keepers = linked.groupBy("component").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("r"))
    keepers = keepers.select(F.col("r.doc_id").alias("__id"), F.col("r.key").alias("__key"))
    keyed = docs.withColumn("__text_key", F.xxhash64("text"))
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__text_key") == F.col("__key"))
    kept = keyed.join(keepers, same, "left_semi").dropDuplicates(["doc_id", "__text_key"])
    wordless = keyed.where(textcols.n_words(F.col("text")) == 0)
    return kept.union(wordless).drop("__text_key")
