"""Near-duplicate passages: compact windows of token min-hashes, joined by what they share.

The tokens of a document are its shingles of ``K`` words in order. For each of ``FUNCTIONS`` hash
functions the document's Cartesian tree over hash values is walked from the root: the least value of a
range stands for every passage of the range that holds it, and the ranges left and right of it follow.
Such a window (range and place of the least value) is kept while it is long enough for a passage of
``MIN_WORDS`` words, so a document of n words has about 2n / MIN_WORDS windows for each function, and
every long enough passage lies in exactly one window of each.

Windows with one key (function and least token) meet in Spark, but never in all pairs. Each window carries
one bit of every token within ``SIDE`` of its least one. A mask chooses some of these places, and windows of
one key that agree on a mask form a group of which each is paired with the first, in order of document and
place. There is a mask for every way in which a passage of ``MIN_WORDS`` words can lie around the least token,
so an exact passage is always paired with the first document that has it, whatever else shares the key; and
one for every two stretches or more of ``STRETCH`` tokens, which stay alike when words in between differ, for windows
that share no whole passage with their partners. A mask on which a partner of the window agrees
already gives no further one, so copies make one pair; masks of more stretches come first, so that an earlier window
is left out only if a partner agrees in all stretches in which it does. Besides, each window is paired with the first one of
its key. Bits of a few tokens past a passage agree by chance, so a passage in n documents can have about
log2(n) partners; of equal spans of a document the one with the earliest match is reported.

Windows of one key within an Arrow batch that agree in all bits, and so on every mask, are paired there and
only the first goes on, so a passage in a third of all documents sends one row for each batch. Pairs of
windows are intersected, and overlapping intersections of two documents are joined to one interval. An interval
is a candidate if one pair of its windows agrees on a mask or on ``NEAREST`` tokens in a row, or if ``AGREE``
functions made it, so that one function that chose a token of both is enough. A candidate is verified on the tokens of both documents:
spans dense in common tokens, of ``MIN_WORDS`` words at least, whose sets have a similarity of ``SIMILAR``.

A document is told by doc_id and the hash of its text, so repeated rows are one document; passages
repeated within a document are not looked for. Cases: null or empty texts, and texts shorter than a
passage, have no windows; null ids come first in the order; texts of any length are taken whole (of a
window more than 65,535 tokens wide to one side that much is used; the windows nested in it cover the
rest); an empty table gives an empty result; clashing column names do not matter, as only doc_id and text
are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetscope.llm import words
from fleetscope.llm.tables import stored

K = 5
MIN_WORDS = 50
SIMILAR = 0.8
FUNCTIONS = 4
AGREE = 2
WIDEST = 0xFFFF
SIDE = 48  # tokens on each side of the least one whose bits a window carries
STRETCH = 12
NEAREST = 8
MEET_ROWS = 1 << 16  # windows with shared keys that are paired together, if they are not of one key
_U = np.uint64

# place of a window in one long: function, place of the least token, tokens left and right of it
_FUNCTION, _PLACE, _LEFT = 60, 32, 16


def _masks() -> tuple[np.ndarray, np.ndarray]:
    """Bits of the tokens before and after the least one on which windows have to agree: those of all
    passages of ``MIN_WORDS`` words around it, from the middle, and those of any two stretches."""
    around = MIN_WORDS - K
    exact = [((1 << left) - 1, (1 << around - left) - 1) for left in sorted(range(around + 1), key=lambda n: abs(2 * n - around))]
    stretch = [((1 << STRETCH) - 1) << at for at in range(0, SIDE, STRETCH)]
    single = [(m, 0) for m in stretch] + [(0, m) for m in stretch]
    pairs = [(a[0] | b[0], a[1] | b[1]) for i, a in enumerate(single) for b in single[:i]]
    return np.array(exact, dtype=np.int64), np.array(pairs, dtype=np.int64)


EXACT, LOOSE = _masks()
STRETCHES = [(((1 << STRETCH) - 1) << at, 0)[::way] for way in (1, -1) for at in range(0, SIDE, STRETCH)]
_SETS = np.arange(1 << len(STRETCHES), dtype=np.int64)  # of stretches, a bit for each
_BELOW = np.packbits(_SETS[:, None] & _SETS == _SETS, axis=1, bitorder="little")  # the subsets of each set
RUNS = np.array([(1 << NEAREST) - 1 << at for at in range(0, SIDE, NEAREST)], dtype=np.int64)


def compact_windows(values: np.ndarray, bounds: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(begin, place of the least value, end) of the compact windows of at least ``least`` values in each
    document; of equal values the first is the least."""
    bits = max(int(len(values)).bit_length(), 1)
    packed = (values >> _U(bits) << _U(bits)) | np.arange(len(values), dtype=_U)
    packed = np.append(packed, _U(0))
    begin, end = bounds[:-1], bounds[1:]
    found = []
    while True:
        wide = end - begin >= least
        begin, end = begin[wide], end[wide]
        if not len(begin):
            break
        lowest = np.minimum.reduceat(packed, np.stack((begin, end), axis=1).ravel())[::2]
        place = (lowest & _U((1 << bits) - 1)).astype(np.int64)
        found.append((begin, place, end))
        begin, end = np.stack((begin, place + 1), axis=1).ravel(), np.stack((place, end), axis=1).ravel()
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(part) for part in zip(*found))


def _following(bits: np.ndarray) -> np.ndarray:
    """For each place and the one past the last: the bits from there on, the next one lowest."""
    out, width = np.append(bits, _U(0)), 1
    while width < 64:
        out[:-width] |= out[width:] << _U(width)
        width *= 2
    return out


def _within(width: np.ndarray) -> np.ndarray:
    """The bits of as many tokens as a window has on one side."""
    return (np.int64(1) << np.minimum(width, SIDE)) - 1


def _first_alike(*columns: np.ndarray) -> np.ndarray:
    """For each row: the first row with equal values, by 64 bits of hash."""
    code = np.zeros(len(columns[0]), dtype=_U)
    for column in columns:
        code = words.mix(code + words.mix(column.astype(_U)))
    _, first, group = np.unique(code, return_index=True, return_inverse=True)
    return first[group]


def _windows(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Windows of a batch. One that agrees with an earlier document's in key and all bits has that as its
    partner, the others have none."""
    ids, hashes = batch.column("doc_id"), batch.column("h").to_numpy()
    tokens, bounds = words.shingles(words.words(batch.column("text")), K)
    known = np.asarray(ids.is_valid())
    numbers = ids.fill_null(0).to_numpy()
    by_rank = np.lexsort((hashes, numbers, known))
    same = np.ones((3, len(ids)), dtype=bool)
    for row, column in zip(same, (hashes, numbers, known)):
        row[1:] = column[by_rank][1:] == column[by_rank][:-1]
    rank = np.empty(len(ids), dtype=np.int64)
    rank[by_rank] = np.cumsum(~same.all(axis=0))  # repeated rows are one document
    bits = tokens & _U(1)
    after = _following(bits)
    before = _following(bits[::-1])[::-1]  # of the place before
    keys, docs, places, befores, afters = [], [], [], [], []
    for function in range(FUNCTIONS):
        values = words.mix(tokens ^ words.mix(np.array([function + 1], dtype=_U)))
        begin, at, end = compact_windows(values, bounds, MIN_WORDS - K + 1)
        doc = np.searchsorted(bounds, at, side="right") - 1
        left, right = np.minimum(at - begin, WIDEST), np.minimum(end - 1 - at, WIDEST)
        keys.append(values[at])  # a bijection of the token, and its own for each function
        docs.append(doc)
        places.append((function << _FUNCTION) | (at - bounds[doc]) << _PLACE | left << _LEFT | right)
        befores.append(before[at].astype(np.int64) & _within(left))
        afters.append(after[at + 1].astype(np.int64) & _within(right))
    key, doc, place = np.concatenate(keys).astype(np.int64), np.concatenate(docs), np.concatenate(places)
    order = np.lexsort((place, rank[doc], key))
    key, doc, place = key[order], doc[order], place[order]
    before, after = np.concatenate(befores)[order], np.concatenate(afters)[order]
    first = _first_alike(key, before, after, _within(place >> _LEFT & WIDEST), _within(place & WIDEST))
    new = rank[doc[first]] == rank[doc]
    # a pair made here needs no meeting, so its row may go anywhere
    key = np.where(new, key, words.mix(place.astype(_U) ^ words.mix(hashes[doc].astype(_U))).astype(np.int64))
    partner = doc[first]
    columns = [pa.array(key), ids.take(pa.array(doc)), pa.array(hashes[doc]), pa.array(place)]
    columns += [pa.array(c, mask=~new) for c in (before, after)]
    columns.append(pa.array(numbers[partner], mask=new | ~known[partner]))
    columns += [pa.array(c, mask=new) for c in (hashes[partner], place[first])]
    return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in _WINDOW_SCHEMA.split(", ")])


_WINDOW_SCHEMA = "key long, doc long, h long, place long, before long, after long, doc2 long, h2 long, place2 long"
_PAIR_SCHEMA = "doc long, h long, place long, doc2 long, h2 long, place2 long, alike boolean"


def _by_masks(masks: np.ndarray, open_: np.ndarray, group, doc, bits, inside) -> tuple[np.ndarray, np.ndarray]:
    """(row, its partner's row) by masks, for rows and masks in ``open_``, which are closed where a partner agrees."""
    found = [(np.zeros(0, np.int64),) * 2]
    for m, (left, right) in enumerate(masks):
        wanted = np.zeros(len(doc) + 1, dtype=bool)
        wanted[group[open_[:, m]]] = True
        rows = np.flatnonzero(wanted[group] & ((left & ~inside[0] | right & ~inside[1]) == 0))
        if not len(rows):
            continue
        first = rows[_first_alike(group[rows], bits[0][rows] & left, bits[1][rows] & right)]
        take = open_[rows, m] & (doc[first] != doc[rows])
        rows, first = rows[take], first[take]
        unlike = [b[rows] ^ b[first] | ~(w[rows] & w[first]) for b, w in zip(bits, inside)]
        for other, (left2, right2) in enumerate(masks):
            open_[rows, other] &= (left2 & unlike[0] | right2 & unlike[1]) != 0
        found.append((rows, first))
    return tuple(np.concatenate(part) for part in zip(*found))


def _by_stretches(closed: np.ndarray, group, doc, bits, inside) -> tuple[np.ndarray, np.ndarray]:
    """(row, its partner's row) for rows that are not ``closed``: for every set of two stretches or more on which
    an earlier partner agrees, the first one, unless a partner of the row agrees on that set and on others."""
    agree = lambda a, b, s: (s[0] & (bits[0][a] ^ bits[0][b])) | (s[1] & (bits[1][a] ^ bits[1][b])) == 0
    wide = [(left & ~inside[0] | right & ~inside[1]) == 0 for left, right in STRETCHES]

    def firsts(chosen: int, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        groups = np.zeros(len(doc) + 1, dtype=bool)
        groups[group[wanted]] = True
        parts = [i for i in range(len(STRETCHES)) if chosen >> i & 1]
        rows = np.flatnonzero(np.logical_and.reduce([groups[group], *(wide[i] for i in parts)]))
        left, right = (sum(STRETCHES[i][side] for i in parts) for side in (0, 1))
        first = rows[_first_alike(group[rows], bits[0][rows] & left, bits[1][rows] & right)] if len(rows) else rows
        take = wanted[rows] & (doc[first] != doc[rows])
        return rows[take], first[take]

    pairs = [int(x) for x in _SETS if int(x).bit_count() == 2]
    shared = np.zeros(len(doc), dtype=np.int64)  # the pairs of stretches on which an earlier partner agrees
    for n, pair in enumerate(pairs):
        shared[firsts(pair, ~closed)[0]] |= 1 << n
    found = [(np.zeros(0, np.int64),) * 2]
    done = np.zeros((len(doc), _BELOW.shape[1]), dtype=np.uint8)  # the sets of stretches that a row needs no more, as bits
    for chosen in sorted((int(x) for x in _SETS if int(x).bit_count() > 1), key=int.bit_count, reverse=True):
        within = sum(1 << n for n, pair in enumerate(pairs) if pair & chosen == pair)
        wanted = (shared & within == within) & (done[:, chosen >> 3] >> (chosen & 7) & 1 == 0)
        if not wanted.any():
            continue
        rows, first = firsts(chosen, wanted)
        common = sum((agree(rows, first, s) & w[rows] & w[first]).astype(np.int64) << i for i, (s, w) in enumerate(zip(STRETCHES, wide)))
        done[rows] |= _BELOW[common]
        found.append((rows, first))
    return tuple(np.concatenate(part) for part in zip(*found))


def _partners(key, doc, place, before, after) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, its partner's row, whether they agree on a mask or a run) of windows sorted by key and document; ``doc``
    is a number of the document."""
    bits, inside = (before, after), (_within(place >> _LEFT & WIDEST), _within(place & WIDEST))
    n = len(key)
    new = np.ones(n, dtype=bool)
    new[1:] = key[1:] != key[:-1]
    group = np.cumsum(new)
    open_ = np.empty((n, len(EXACT)), dtype=bool)
    for m, (left, right) in enumerate(EXACT):
        open_[:, m] = (left & ~inside[0] | right & ~inside[1]) == 0
    rows, partner = _by_masks(EXACT, open_, group, doc, bits, inside)
    settled = np.zeros(n, dtype=bool)
    settled[rows] = True
    own, other = _by_stretches(settled, group, doc, bits, inside)
    found = [rows * n + partner, own * n + other]
    alike = np.unique(np.concatenate(found))
    first = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    plain = np.flatnonzero(doc[first] != doc)
    code = np.concatenate((alike, np.setdiff1d(plain * n + first[plain], alike)))
    own, other = code // max(n, 1), code % max(n, 1)
    sure = np.arange(len(code)) < len(alike)
    for b, w in zip(bits, inside):
        unlike = b[own] ^ b[other] | ~(w[own] & w[other])
        for run in RUNS:
            sure |= unlike & run == 0
    return own, other, sure


def _columns(rows: pa.Table) -> list[np.ndarray]:
    """key, a number of the document, place, before and after of windows."""
    ids = rows.column("doc")
    known, number, h = np.asarray(ids.is_valid()), ids.fill_null(0).to_numpy(), rows.column("h").to_numpy()
    doc = _first_alike(known, number, h)
    return [rows.column("key").to_numpy(), doc, *(rows.column(c).to_numpy() for c in ("place", "before", "after"))]


def _paired(rows: pa.Table, own: np.ndarray, other: np.ndarray, alike: np.ndarray):
    tables = [rows.take(pa.array(i)) for i in (own, other)]
    columns = [t.column(c) for t in tables for c in ("doc", "h", "place")]
    names = [c.split()[0] for c in _PAIR_SCHEMA.split(", ")]
    return pa.table([*columns, pa.array(alike)], names=names).to_batches()


def _meet(batches):
    """Pairs from windows sorted by key, document and place, and pairs made before.

    Windows alone with their key are left out at once, the others are paired as whole keys. Of a key with
    very many windows only those that differ in a bit are remembered."""
    edge, edge_shared = None, False  # the last window so far, and whether the one before it has its key
    pieces, held, limit = [], 0, MEET_ROWS
    for batch in batches:
        table = pa.Table.from_batches([batch])
        paired = table.column("h2").is_valid().combine_chunks()
        made = table.filter(paired).drop_columns(["key", "before", "after"])
        yield from made.append_column("alike", pa.array(np.ones(made.num_rows, dtype=bool))).to_batches()
        rows = table.filter(pc.invert(paired))
        if not rows.num_rows:
            continue
        rows = (pa.concat_tables([edge, rows]) if edge is not None else rows).combine_chunks()
        key = rows.column("key").to_numpy()
        equal = key[1:] == key[:-1]
        shared = np.append(equal, False) | np.insert(equal, 0, edge_shared)
        edge, edge_shared = rows.slice(rows.num_rows - 1).combine_chunks(), bool(equal[-1]) if len(equal) else edge_shared
        pieces.append(rows.slice(0, rows.num_rows - 1).filter(pa.array(shared[:-1])))
        held += pieces[-1].num_rows
        if held < limit:
            continue
        whole = pa.concat_tables(pieces).combine_chunks()
        key = whole.column("key").to_numpy()
        last = int(np.searchsorted(key, key[-1]))
        done, rest = whole.slice(0, last), whole.slice(last).combine_chunks()
        yield from _paired(done, *_partners(*_columns(done)))
        if rest.num_rows > MEET_ROWS // 2:  # a key with very many windows
            key, doc, place, before, after = _columns(rest)
            first = _first_alike(key, before, after, _within(place >> _LEFT & WIDEST), _within(place & WIDEST))
            again = doc[first] != doc
            own = np.flatnonzero(again)
            yield from _paired(rest, own, first[own], np.ones(len(own), dtype=bool))
            rest = rest.filter(pa.array(~again)).combine_chunks()
        pieces, held, limit = [rest], rest.num_rows, max(MEET_ROWS, 2 * rest.num_rows)
    if edge is not None and edge_shared:
        pieces.append(edge)
    if pieces:
        whole = pa.concat_tables(pieces).combine_chunks()
        yield from _paired(whole, *_partners(*_columns(whole)))


def _bits(place: str, shift: int, width: int) -> Column:
    return F.shiftright(place, shift).bitwiseAND(F.lit((1 << width) - 1).cast("long"))


def candidates(docs: DataFrame) -> DataFrame:
    """Intervals of tokens [start, end] of a document (doc, h), and of an earlier one (doc2, h2), that may
    have a passage in common. ``docs`` has doc_id, text and h."""
    words.use_batches(docs.sparkSession)

    def run(batches):
        for whole in batches:
            for batch in words.slices(whole, "text"):
                yield _windows(batch)

    windows = docs.mapInArrow(run, _WINDOW_SCHEMA)
    met = windows.repartition("key").sortWithinPartitions("key", "doc", "h", "place").mapInArrow(_meet, _PAIR_SCHEMA)
    other = (F.col("h") != F.col("h2")) | ~F.col("doc").eqNullSafe(F.col("doc2"))
    left = F.least(_bits("place", _LEFT, 16), _bits("place2", _LEFT, 16))
    right = F.least(_bits("place", 0, 16), _bits("place2", 0, 16))
    at, at2 = _bits("place", _PLACE, 28), _bits("place2", _PLACE, 28)
    shared = met.where(other & (left + right + 1 >= MIN_WORDS - K + 1)).select(
        "doc",
        "h",
        "doc2",
        "h2",
        F.pow(F.lit(2), F.shiftright("place", _FUNCTION)).cast("int").alias("functions"),
        "alike",
        (at - left).alias("start"),
        (at + right).alias("end"),
        (at2 - left).alias("start2"),
        (at2 + right).alias("end2"),
    )
    pair = ["doc", "h", "doc2", "h2"]
    order = Window.partitionBy(*pair).orderBy("start", "end")
    reach = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(reach.isNull() | (F.col("start") > reach), 1).otherwise(0)
    islands = shared.withColumn("fresh", fresh).withColumn("island", F.sum("fresh").over(order))
    joined = islands.groupBy(*pair, "island").agg(
        F.bit_or("functions").alias("functions"),
        F.bool_or("alike").alias("alike"),
        *(F.min(c).alias(c) for c in ("start", "start2")),
        *(F.max(c).alias(c) for c in ("end", "end2")),
    )
    return joined.where(F.col("alike") | (F.bit_count("functions") >= AGREE)).drop("island", "functions", "alike")


def similar_spans(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int, int, int, float]]:
    """Spans [i, j) of tokens of a and [k, l) of b that are long and similar enough, in order."""
    least = MIN_WORDS - K + 1
    order = np.argsort(b, kind="stable")
    at = np.searchsorted(b[order], a)
    hit = np.zeros(len(a), dtype=bool)
    inside = at < len(b)
    hit[inside] = b[order[at[inside]]] == a[inside]
    places = np.flatnonzero(hit)
    theirs = order[at[places]]
    found, waiting = [], [(0, len(places))]
    while waiting:
        lo, hi = waiting.pop()
        if hi <= lo or places[hi - 1] - places[lo] + 1 < least:
            continue
        i, j = int(places[lo]), int(places[hi - 1]) + 1
        shift = theirs[lo:hi] - places[lo:hi]
        middle = np.partition(shift, len(shift) // 2)[len(shift) // 2]
        near = np.abs(shift - middle) <= max(K, (j - i) // 4)
        k, l = int(theirs[lo:hi][near].min()), int(theirs[lo:hi][near].max()) + 1
        own, other = np.unique(a[i:j]), np.unique(b[k:l])
        both = len(np.intersect1d(own, other, assume_unique=True))
        similarity = both / (len(own) + len(other) - both)
        if similarity >= SIMILAR:
            found.append((i, j, k, l, similarity))
            continue
        gaps = np.diff(places[lo:hi]) + np.abs(np.diff(shift))  # cut where the match is interrupted most
        if len(gaps) and gaps.max() > 1:
            cut = lo + int(gaps.argmax()) + 1
            waiting += [(lo, cut), (cut, hi)]
    return sorted(found)


def passages(docs: DataFrame, text: str = "text") -> DataFrame:
    """Passages that an earlier document has too: doc_id, text_hash, start_word, end_word (words from 0, end
    not included), match_id, match_hash, match_start, match_end, similarity."""
    own = docs.select("doc_id", F.col(text).alias("text"), F.xxhash64(text).alias("h"))
    found = stored(candidates(own), "passage-candidates")
    ends = found.select("doc", "h").union(found.select("doc2", "h2")).distinct()
    ends = ends.select(F.col("doc").alias("__doc"), F.col("h").alias("__h"))
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("h") == F.col("__h"))
    texts = own.join(ends, same, "left_semi").dropDuplicates(["doc_id", "h"])

    def run(batches):
        for whole in batches:
            for batch in words.slices(whole, "text"):
                flat, bounds = words.shingles(words.words(batch.column("text")), K)
                columns = [batch.column("doc_id"), batch.column("h"), words.list_of(flat.astype(np.int64), bounds, pa.int64())]
                yield pa.RecordBatch.from_arrays(columns, ["d", "hash", "tokens"])

    tokens = stored(texts.mapInArrow(run, "d long, hash long, tokens array<long>"), "passage-tokens")
    part = lambda a, b: F.slice("tokens", (F.col(a) + 1).cast("int"), (F.col(b) - F.col(a) + 1).cast("int"))
    first = found.join(tokens, F.col("doc").eqNullSafe(F.col("d")) & (F.col("h") == F.col("hash")))
    first = first.select("doc", "h", "doc2", "h2", "start", "start2", "end2", part("start", "end").alias("mine"))
    both = first.join(tokens, F.col("doc2").eqNullSafe(F.col("d")) & (F.col("h2") == F.col("hash")))
    both = both.select("doc", "h", "doc2", "h2", "start", "start2", "mine", part("start2", "end2").alias("theirs"))
    names = ["doc_id", "text_hash", "start_word", "end_word", "match_id", "match_hash", "match_start", "match_end", "similarity"]
    kinds = [pa.int64()] * 8 + [pa.float64()]

    def verify(batches):
        for batch in batches:
            mine, theirs = batch.column("mine"), batch.column("theirs")
            rows = []
            plain = batch.drop_columns(["mine", "theirs"]).to_pylist()
            for n, row in enumerate(plain):
                spans = similar_spans(mine[n].values.to_numpy(), theirs[n].values.to_numpy())
                s, s2 = row["start"], row["start2"]
                for i, j, k, l, similarity in spans:
                    ends = (s + i, s + j + K - 1, row["doc2"], row["h2"], s2 + k, s2 + l + K - 1, similarity)
                    rows.append((row["doc"], row["h"], *ends))
            columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 9, kinds)]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = T.StructType([T.StructField(n, T.LongType()) for n in names[:-1]] + [T.StructField(names[-1], T.DoubleType())])
    found = both.mapInArrow(verify, schema)
    earliest = F.min_by(F.struct(*names[4:]), F.struct(F.col("match_id"), F.col("match_hash"), F.col("match_start"), F.col("match_end")))
    return found.groupBy(*names[:4]).agg(earliest.alias("m")).select(*names[:4], "m.*")


def cut(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the passages that an earlier document has too; a document that was nothing else goes.

    The words between passages stay as they were, with the white space before them.
    """
    spans = passages(docs, text).groupBy("doc_id", "text_hash")
    spans = spans.agg(F.collect_set(F.struct("start_word", "end_word")).alias("__spans"))
    spans = spans.withColumnsRenamed({"doc_id": "__doc", "text_hash": "__h"})
    spans = stored(spans, "passages")
    keyed = docs.withColumn("__text_hash", F.xxhash64(text))
    same = F.col("doc_id").eqNullSafe(F.col("__doc")) & (F.col("__text_hash") == F.col("__h"))
    rows = keyed.join(spans, same, "left").drop("__doc", "__h", "__text_hash")
    touched = T.StructType([*docs.schema.fields])

    def run(batches):
        for whole in batches:
            for batch in words.slices(whole, text):
                texts = batch.column(text).cast(pa.binary()).to_pylist()
                found = words.words(batch.column(text))
                _, bounds = words.text_bytes(batch.column(text))
                keep = np.ones(len(texts), dtype=bool)
                for n, spans in enumerate(batch.column("__spans").to_pylist()):
                    if not spans:
                        continue
                    starts = found.starts[found.first[n] : found.first[n + 1]] - bounds[n]
                    ends = found.ends[found.first[n] : found.first[n + 1]] - bounds[n]
                    gone = np.zeros(len(starts), dtype=bool)
                    for span in spans:
                        gone[span["start_word"] : span["end_word"]] = True
                    # a word takes the white space before it along; what follows the last word goes with it
                    edge = np.concatenate(([0], ends[:-1]))
                    parts = [texts[n][edge[i] : ends[i]] for i in np.flatnonzero(~gone)]
                    tail = texts[n][ends[-1] :] if not gone[-1] else b""
                    texts[n] = b"".join([*parts, tail]).lstrip()
                    keep[n] = not gone.all()
                columns = [batch.column(f.name) for f in touched]
                columns[touched.names.index(text)] = pa.array(texts, pa.binary()).cast(pa.string())
                yield pa.RecordBatch.from_arrays(columns, touched.names).filter(pa.array(keep))

    out = rows.mapInArrow(run, touched)
    return out.withColumn("n_chars", F.length(text).cast("long")) if "n_chars" in docs.columns else out
