"""Periodic runs: stretches of a text that repeat the same few words over and over.

Suffixes of a text's words are sorted and united in classes by decreasing common prefix, as Kruskal
unites trees. Each class is an ordered set of word positions. Whenever two positions i < j become
neighbours in a set at common prefix L and j - i <= L, the words from i to j + L have period j - i, and no
smaller one, because a smaller period would have put another position between them before. Such a pair
seeds a run; the one at the run's first word stands for it, so each run comes out once.

A run is a stretch with smallest period q and at least ``max(least_words, least_times * q)`` words that
no neighbouring word extends. With ``least_times >= 2`` all runs are found. Their seeds have a common prefix
of some words at least, so classes are not united below that, and a text in which no stretch of
that many words stands twice is left at once.

Texts are worked on one by one within their Arrow batch; memory is about 4 bytes x log2 of the words in
the longest repeated stretch, for each word of one text.

Cases: a null or empty text, or one without words, has no runs and an empty collapsed text; repeated rows
and null ids are rows like any other; words are equal if their bytes are, upper and lower case differ;
input columns named ``runs`` or ``collapsed`` are replaced.
"""

from __future__ import annotations

from bisect import bisect_left

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from fleetscope.llm import words

LEAST_WORDS = 6
LEAST_TIMES = 4

#: Odd factor of the hash that tells texts without repetition.
_FACTOR = np.uint64(0x9E3779B97F4A7C15)

Run = tuple[int, int, int]  # start, length, period

RUNS = T.ArrayType(
    T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")]), False
)


def shortest_seed(least_words: int, least_times: int) -> int:
    """The least common prefix that the seed of a run can have."""
    return min(max(least_words - q, (least_times - 1) * q) for q in range(1, least_words + 1))


def _has_twice(ids: np.ndarray, size: int) -> bool:
    """Whether a stretch of ``size`` words may stand twice; never false if one does."""
    if len(ids) <= size:
        return False
    hashed = np.zeros(len(ids) - size + 1, dtype=np.uint64)
    own = words.mix(ids.astype(np.uint64))
    for k in range(size):
        hashed = hashed * _FACTOR + own[k : k + len(hashed)]
    hashed.sort()
    return bool((hashed[1:] == hashed[:-1]).any())


def sorted_suffixes(ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Positions in the order of the suffixes that begin there, and the common prefix of each with the next.

    Ranks are kept of the stretches of 1, 2, 4, ... words that begin at each position, until all differ.
    """
    n = len(ids)
    levels, width = [np.unique(ids, return_inverse=True)[1].astype(np.int32)], 1
    while levels[-1].max() < n - 1:
        follows = np.zeros(n, dtype=np.int64)
        follows[: n - width] = levels[-1][width:].astype(np.int64) + 1
        pairs = levels[-1].astype(np.int64) * (n + 1) + follows
        levels.append(np.unique(pairs, return_inverse=True)[1].astype(np.int32))
        width *= 2
    order = np.argsort(levels[-1])
    left, right = order[:-1].copy(), order[1:].copy()
    common = np.zeros(n - 1, dtype=np.int64)
    for rank in reversed(levels):
        inside = np.maximum(left, right) < n
        same = inside & (rank[np.minimum(left, n - 1)] == rank[np.minimum(right, n - 1)])
        step = same * width
        common, left, right = common + step, left + step, right + step
        width //= 2
    return order, common


def _merge(large: list[int], small: list[int], common: int, seeds: list[Run]) -> None:
    """Put the ordered ``small`` into the ordered ``large``; pairs of new neighbours, one from each, that are
    not farther apart than their common prefix become seeds (first, second, common prefix)."""
    before = -1
    for k, at in enumerate(small):
        place = bisect_left(large, at)
        if place:
            left = large[place - 1]
            if left != before and at - left <= common:
                seeds.append((left, at, common))
        if place < len(large):
            right = large[place]
            if right - at <= common and not (k + 1 < len(small) and small[k + 1] < right):
                seeds.append((at, right, common))
        large.insert(place, at)
        before = at


def seeds_of(order: np.ndarray, common: np.ndarray, least: int) -> list[Run]:
    """All seeds with a common prefix of ``least`` words or more."""
    edges = np.flatnonzero(common >= least)
    edges = edges[np.argsort(-common[edges], kind="stable")]
    boss: dict[int, int] = {}
    members: dict[int, list[int]] = {}
    seeds: list[Run] = []

    def find(x: int) -> int:
        top = x
        while (up := boss.get(top, top)) != top:
            top = up
        while x != top:
            boss[x], x = top, boss.get(x, top)
        return top

    for one, two, shared in zip(order[edges].tolist(), order[edges + 1].tolist(), common[edges].tolist()):
        one, two = find(one), find(two)
        a, b = members.pop(one, None) or [one], members.pop(two, None) or [two]
        if len(a) < len(b):
            one, two, a, b = two, one, b, a
        _merge(a, b, shared, seeds)
        boss[two] = one
        members[one] = a
    return seeds


def runs_of(ids: np.ndarray, least_words: int = LEAST_WORDS, least_times: int = LEAST_TIMES) -> list[Run]:
    """Runs of a text whose words are ``ids``, by start, then period."""
    least = shortest_seed(least_words, least_times)
    if not _has_twice(ids, least):
        return []
    out = []
    for i, j, common in seeds_of(*sorted_suffixes(ids), least):
        period = j - i
        begins = i == 0 or ids[i - 1] != ids[j - 1]
        if begins and period + common >= max(least_words, least_times * period):
            out.append((i, period + common, period))
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapse(own: list[bytes], found: list[Run]) -> list[bytes]:
    """Words that no run contains after its first period."""
    if not found:
        return own
    depth = np.zeros(len(own) + 1, dtype=np.int64)
    for start, length, period in found:
        depth[start + period] += 1
        depth[start + length] -= 1
    return [w for w, d in zip(own, np.cumsum(depth[:-1]).tolist()) if not d]


def analyse(text: str | None, least_words: int = LEAST_WORDS, least_times: int = LEAST_TIMES) -> tuple[list[Run], str]:
    """Runs of a text's words, and the text with each run cut to its first period, words joined by a space."""
    own = (text or "").encode().split()
    number: dict[bytes, int] = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in own), np.int64, len(own))
    found = runs_of(ids, least_words, least_times)
    return found, b" ".join(collapse(own, found)).decode()


def find(
    docs: DataFrame, text: str = "text", least_words: int = LEAST_WORDS, least_times: int = LEAST_TIMES
) -> DataFrame:
    """``docs`` with ``runs`` (start, length, period in words, sorted) and ``collapsed`` in place of ``text``."""
    if least_times < 2:
        raise ValueError("a run is a repetition: least_times is 2 or more")
    new = ("runs", "collapsed")
    kept = [f for f in docs.schema.fields if f.name not in (text, *new)]
    schema = T.StructType([*kept, T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    one = pa.struct([pa.field(n, pa.int64(), False) for n in ("start", "length", "period")])
    kind = pa.list_(pa.field("element", one, False))

    def run(batches):
        for whole in batches:
            for batch in words.slices(whole, text):
                pairs = [analyse(t, least_words, least_times) for t in batch.column(text).to_pylist()]
                found = [[dict(zip(("start", "length", "period"), r)) for r in runs] for runs, _ in pairs]
                arrays = [batch.column(f.name) for f in kept]
                arrays += [pa.array(found, kind), pa.array([c for _, c in pairs], pa.string())]
                yield pa.RecordBatch.from_arrays(arrays, [f.name for f in schema])

    return docs.select(*[f.name for f in kept], text).mapInArrow(run, schema)
