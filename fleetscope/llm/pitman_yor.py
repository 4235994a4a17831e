"""Language-model scores from a hierarchical Pitman-Yor process over words.

Each context has a restaurant; its customers are the training tokens that follow the context, its dishes
are words. Contexts are the previous word, hashed into ``CONTEXTS`` restaurants. All of them share one
parent, the restaurant of single words, whose customers are their tables and whose base is uniform over
the known words and one unknown word. How customers sit is sampled: in each sweep the number of tables of
every dish in every restaurant is drawn given the parent's probabilities and the restaurant's other
tables as the last sweep left them, then those of the parent given its new customers. Counts up to
``EXACT`` are drawn from the exact conditional, by generalised Stirling numbers; larger ones by seating
the customers one after another. Probabilities are averaged over the sweeps after ``BURN_IN``.

On Spark: one shuffle deals all (word, context) counts of all documents, with the documents they come
from, into parts by word, summed by document and packed by batch. A part is a row of a stored table of
about ``PART_TOKENS`` tokens, read one at a time and worked on by blocks of words. Words too frequent for one part are dealt by word and context; they are a
list of at most ``FREQUENT`` words, found from a sample that affects nothing but the dealing. Sweeps read
the parts again and again; what passes between them are the tables by context and by frequent word, sums
bounded by ``CONTEXTS`` and ``FREQUENT``. In the last pass each part adds up, per document, what its
words contribute, as one row for each batch of documents.

Cases: a null or empty text is the end token alone; a null id is never held out; repeated rows are
documents of their own; without training tokens every word is unknown and has the uniform probability
over one word; an empty table gives an empty result; only doc_id and text are read, so other columns do
not matter.
"""

from __future__ import annotations

import pickle
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetscope.llm import words
from fleetscope.llm.tables import ROW_BY_ROW, stored

CONTEXTS = 1 << 15
PART_TOKENS = 2_000_000
FREQUENT = 1 << 16
SAMPLE_DOCS = 2_000  # to find words for the list above
EXACT = 64
BLOCK_PAIRS = 1 << 18  # pairs of a part that are seated at a time, and those of the word that goes beyond
CELLS = 1 << 18  # weights of numbers of tables that are held at a time
BURN_IN, SAMPLES = 2, 2
# discounts and strengths of the context restaurants and of their parent
DISCOUNT, STRENGTH = 0.75, 1.0
PARENT_DISCOUNT, PARENT_STRENGTH = 0.7, 10.0
_U = np.uint64
_END = words.mix(np.array([0xE0D], dtype=_U))[0]


def token_stream(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Tokens of all texts with an end after each, their contexts, and where each text's begin."""
    found = words.words(texts)
    n = found.counts
    bounds = found.first - found.first[0] + np.arange(len(found.first))
    tokens = np.full(len(found.hashes) + len(n), _END)
    inside = np.ones(len(tokens), dtype=bool)
    inside[bounds[1:] - 1] = False
    tokens[inside] = found.hashes
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[:1] = _END  # what begins a text follows an end
    return tokens, (words.mix(before) % _U(CONTEXTS)).astype(np.uint16), bounds


# ---- seating -------------------------------------------------------------------------------------


def log_stirling(discount: float) -> np.ndarray:
    """Logs of generalised Stirling numbers: ways to seat c customers at t tables, c and t to ``EXACT``."""
    out = np.full((EXACT + 1, EXACT + 1), -np.inf)
    out[0, 0] = 0.0
    t = np.arange(1, EXACT + 1)
    for c in range(1, EXACT + 1):
        stay = c - 1 - discount * t
        with np.errstate(divide="ignore", invalid="ignore"):
            joined = np.where(stay > 0, np.log(np.where(stay > 0, stay, 1)) + out[c - 1, 1:], -np.inf)
        out[c, 1:] = np.logaddexp(out[c - 1, :-1], joined)
    return out


class Seating:
    """Draws numbers of tables for one discount."""

    def __init__(self, discount: float):
        self.discount = discount
        self.ways = log_stirling(discount)

    def draw(self, customers: np.ndarray, opens: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """Tables of each dish, given its customers and the weight of opening a table for it."""
        tables = np.minimum(customers, 1)
        order = np.argsort(np.minimum(customers, EXACT + 1), kind="stable")
        edges = np.searchsorted(customers[order], np.arange(EXACT + 2))
        for c in range(2, EXACT + 1):
            for at in range(edges[c], edges[c + 1], CELLS // c):
                rows = order[at : min(at + CELLS // c, edges[c + 1])]
                t = np.arange(1, c + 1)
                weight = self.ways[c, 1 : c + 1] + t * np.log(opens[rows])[:, None]
                weight = np.cumsum(np.exp(weight - weight.max(axis=1, keepdims=True)), axis=1)
                drawn = rng.random(len(rows)) * weight[:, -1]
                tables[rows] = 1 + (weight < drawn[:, None]).sum(axis=1)
        rows = order[edges[EXACT + 1] :]
        if len(rows):
            tables[rows] = self._one_by_one(customers[rows], opens[rows], rng)
        return tables

    def _one_by_one(self, customers: np.ndarray, opens: np.ndarray, rng: np.random.Generator) -> np.ndarray:
        """Seat customers in turn; of many, those of a step that adds a sixteenth share one probability."""
        tables, seated, most = np.ones(len(customers), dtype=np.int64), 1, int(customers.max())
        while seated < most:
            step = max(1, seated // 16)
            n = np.clip(customers - seated, 0, step)
            tables += rng.binomial(n, opens / (opens + seated - self.discount * tables))
            seated += step
        return tables


# ---- model state ---------------------------------------------------------------------------------


@dataclass
class State:
    """What all parts share after a sweep; each entry is bounded."""

    tables: np.ndarray  # by context
    parent_tables: float  # as the sweep before left them, for drawing
    frequent_customers: np.ndarray  # of the frequent words at the parent
    frequent_tables: np.ndarray
    drawn_tables: float = 0.0  # of the parent in this sweep; known after it, and what probabilities go by


@dataclass
class Model:
    frequent: np.ndarray  # words, sorted
    tokens: int = 0  # in training
    vocabulary: int = 0
    context_customers: np.ndarray = field(default_factory=lambda: np.zeros(CONTEXTS))
    frequent_counts: np.ndarray = field(default_factory=lambda: np.zeros(0))
    states: list[State] = field(default_factory=list)

    def parent(self, state: State, customers: np.ndarray, tables: np.ndarray, all_tables: float) -> np.ndarray:
        """Probability of words at the parent."""
        opens = (PARENT_STRENGTH + PARENT_DISCOUNT * all_tables) / (self.vocabulary + 1)
        return (customers - PARENT_DISCOUNT * tables + opens) / (PARENT_STRENGTH + state.tables.sum())


class Part:
    """The counts of one part, or of a block of its words: words, and for each its contexts with their training
    counts."""

    def __init__(self, model: Model, number: int, pairs: bytes | tuple, block: int = 0):
        self.model, self.number, self.block = model, number, block
        self.words, n_contexts, self.context, self.count = pairs if isinstance(pairs, tuple) else pickle.loads(pairs)
        self.word_of = np.repeat(np.arange(len(self.words), dtype=np.int32), n_contexts)
        self.count = self.count.astype(np.int64)
        self.word_counts = np.bincount(self.word_of, self.count, len(self.words)).astype(np.int64)
        at = np.searchsorted(model.frequent, self.words)
        at[at == len(model.frequent)] = 0
        self.frequent = model.frequent[at] == self.words if len(model.frequent) else np.zeros(len(at), dtype=bool)
        self.at = at[self.frequent]

    def customers_of(self, tables: np.ndarray) -> np.ndarray:
        """Customers at the parent: tables of each word in this part."""
        return np.bincount(self.word_of, tables, len(self.words)).astype(np.int64)

    def run(self):
        """For each sweep so far: tables of each pair, and customers and tables of each word at the parent;
        then the tables of each pair after the last.

        The first state has one table for each pair. Draws follow the part, its block and the sweep, so that
        a task that runs again comes to the same.
        """
        model = self.model
        seats, parent_seats = Seating(DISCOUNT), Seating(PARENT_DISCOUNT)
        tables = np.minimum(self.count, 1)
        customers = self.customers_of(tables)
        for sweep, state in enumerate(model.states):
            rng = np.random.Generator(np.random.Philox(key=[self.number, sweep], counter=[0, 0, 0, self.block]))
            weight = (PARENT_STRENGTH + PARENT_DISCOUNT * state.parent_tables) / (model.vocabulary + 1)
            all_customers = customers.copy()
            all_customers[self.frequent] = state.frequent_customers[self.at]
            own_tables = parent_seats.draw(all_customers, np.full(len(customers), weight), rng)
            own_tables[self.frequent] = state.frequent_tables[self.at]
            yield tables, all_customers, own_tables
            parent = model.parent(state, all_customers, own_tables, state.parent_tables)
            opens = (STRENGTH + DISCOUNT * state.tables[self.context]) * parent[self.word_of]
            tables = seats.draw(self.count, opens, rng)
            customers = self.customers_of(tables)
        yield tables, None, None

    def sums(self) -> tuple[np.ndarray, pd.DataFrame]:
        """What these words add to the next state: tables and customers by context, and rows (kind, key, x, y)."""
        own_tables = None
        for tables, _, drawn in self.run():
            own_tables = own_tables if drawn is None else drawn
        own = ~self.frequent
        by_context = np.array([np.bincount(self.context, v, CONTEXTS) for v in (tables, self.count)])
        theirs = {"x": self.customers_of(tables)[self.frequent], "y": self.word_counts[self.frequent]}
        rows = [pd.DataFrame({"kind": 1, "key": self.at} | theirs)]
        known = int(((self.word_counts > 0) & own).sum())
        rows.append(pd.DataFrame({"kind": [2, 3], "key": 0, "x": [known, 0 if own_tables is None else int(own_tables[own].sum())], "y": 0}))
        return by_context, pd.concat(rows).astype({"x": float, "y": float})

    def log_probabilities(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each pair: log10 of the averaged probability, log10 by the smoothed count, and whether the
        word is known."""
        model, total = self.model, np.zeros(len(self.count))
        for sweep, (tables, customers, own_tables) in enumerate(self.run()):
            if sweep >= BURN_IN and sweep < len(model.states):
                state = model.states[sweep]
                parent = model.parent(state, customers, own_tables, state.drawn_tables)
                own = self.count - DISCOUNT * tables
                own += (STRENGTH + DISCOUNT * state.tables[self.context]) * parent[self.word_of]
                total += own / (STRENGTH + model.context_customers[self.context])
        counts = self.word_counts.copy()
        counts[self.frequent] = model.frequent_counts[self.at]
        counts = counts[self.word_of]
        base = np.log10((counts + 0.5) / (model.tokens + 0.5 * (model.vocabulary + 1)))
        return np.log10(total / SAMPLES), base, counts > 0


def blocks(model: Model, number: int, pairs: bytes):
    """A part as blocks of whole words; words are seated apart, so no more than a block is worked on at a time."""
    own, n_contexts, context, count = pickle.loads(pairs)
    ends = np.cumsum(n_contexts, dtype=np.int64)
    low, begin, block = 0, 0, 0
    while low < len(own):
        high = max(low + 1, int(np.searchsorted(ends, begin + BLOCK_PAIRS, side="right")))
        end = int(ends[high - 1])
        yield Part(model, number, (own[low:high], n_contexts[low:high], context[begin:end], count[begin:end]), block)
        low, begin, block = high, end, block + 1


def part_sums(model: Model, number: int, pairs: bytes):
    """What a part adds to the next state, as rows (kind, key, x, y)."""
    by_context = np.zeros((2, CONTEXTS))
    for block in blocks(model, number, pairs):
        theirs, rows = block.sums()
        by_context += theirs
        yield rows
    used = np.flatnonzero(by_context[1])
    yield pd.DataFrame({"kind": 0, "key": used, "x": by_context[0][used], "y": by_context[1][used]}).astype({"x": float, "y": float})


def document_sums(values: list[np.ndarray], entries: tuple[np.ndarray, ...], places: np.ndarray):
    """(first document, documents from there, tokens and sums of each of ``values`` of pairs) of each load."""
    firsts, n_pairs, n_docs, at, count = entries
    pair = np.cumsum(places, dtype=np.int32)
    low, begin = 0, 0
    for first, n in zip(firsts.tolist(), n_pairs.tolist()):
        sizes = n_docs[low : low + n]
        end = begin + int(sizes.sum(dtype=np.int64))
        some, times, own = np.repeat(pair[low : low + n], sizes), count[begin:end], at[begin:end]
        tokens = np.bincount(own, times)
        held = np.flatnonzero(tokens)
        yield first, held, [tokens[held]] + [np.bincount(own, times * value[some])[held] for value in values]
        low, begin = low + n, end


# ---- dealing counts into parts -------------------------------------------------------------------


def _runs(*keys: np.ndarray) -> np.ndarray:
    """Where a new combination of sorted keys begins."""
    new = np.ones(len(keys[0]), dtype=bool)
    new[1:] = np.logical_or.reduce([k[1:] != k[:-1] for k in keys])
    return np.flatnonzero(new)


def _sizes(begins: np.ndarray, end: int) -> np.ndarray:
    return np.diff(np.append(begins, end)).astype(np.uint32)


def _packed(batch: pa.RecordBatch, first_doc: int, n_parts: int, frequent: np.ndarray):
    """(part, load) of a batch: per part the words, their contexts, and the documents with counts."""
    tokens, context, bounds = token_stream(batch.column("text"))
    doc = np.repeat(np.arange(len(bounds) - 1, dtype=np.uint16), np.diff(bounds))
    part = (words.mix(tokens) % _U(n_parts)).astype(np.int64)
    if len(frequent):
        at = np.searchsorted(frequent, tokens)
        hot = frequent[np.minimum(at, len(frequent) - 1)] == tokens
        part[hot] = (words.mix(tokens[hot] + context[hot].astype(_U)) % _U(n_parts)).astype(np.int64)
    near = (tokens & _U(0xFFFFFFFFF8000000)) | context.astype(_U) << _U(11) | doc.astype(_U)
    order = np.argsort(near, kind="stable")
    order = order[np.argsort(part[order], kind="stable")]
    part, tokens, context, doc = part[order], tokens[order], context[order], doc[order]
    entries = _runs(part, tokens, context, doc)
    counts = _sizes(entries, len(part))
    part, tokens, context, doc = part[entries], tokens[entries], context[entries], doc[entries]
    held = np.asarray(batch.column("held"))
    info = (batch.column("doc_id").to_pylist(), held)
    begins = _runs(part)
    for n, (a, b) in enumerate(zip(begins, [*begins[1:], len(part)])):
        pairs = _runs(tokens[a:b], context[a:b])
        firsts = _runs(tokens[a:b][pairs])
        load = (
            first_doc,
            held,
            tokens[a:b][pairs][firsts],
            _sizes(firsts, len(pairs)),
            context[a:b][pairs],
            _sizes(pairs, b - a),
            doc[a:b],
            counts[a:b],
            info if n == 0 else None,  # the documents' own columns travel once
        )
        yield int(part[a]), pickle.dumps(load)


def _merge(pdf: pd.DataFrame) -> pd.DataFrame:
    """All loads of a part as one row: the pairs with training counts, and the documents of each pair.

    What is long, the documents' counts, stays in the order of the loads; only the pairs are sorted. Of
    the pairs of a load the distances are kept, as these compress.
    """
    token, context, first, n_pairs, size, doc, count, train, infos = [], [], [], [], [], [], [], [], []
    for load in pdf["load"]:
        first_doc, held, own, n_contexts, contexts, n_docs, docs, counts, info = pickle.loads(load)
        token.append(np.repeat(own, n_contexts))
        context.append(contexts)
        first.append(first_doc)
        n_pairs.append(len(n_docs))
        size.append(n_docs)
        doc.append(docs)
        count.append(counts)
        train.append(np.add.reduceat(counts * ~held[docs], np.concatenate(([0], np.cumsum(n_docs[:-1], dtype=np.int64)))))
        if info:
            infos.append((first_doc, *info))
    entries = [pickle.dumps((np.array(first), np.array(n_pairs), *map(np.concatenate, (size, doc, count))))]
    del size, doc, count
    token, context, train = map(np.concatenate, (token, context, train))
    order = np.lexsort((context, token))
    begins = _runs(token[order], context[order])
    pair = np.empty(len(order), dtype=np.int32)
    pair[order] = np.repeat(np.arange(len(begins), dtype=np.int32), _sizes(begins, len(order)))
    trained = np.bincount(pair, train, len(begins)).astype(np.uint32)
    token, context = token[order][begins], context[order][begins]
    firsts = _runs(token)
    pairs = (token[firsts], _sizes(firsts, len(token)), context, trained)
    loads = [pickle.dumps(pairs), entries[0], pickle.dumps(np.diff(pair, prepend=np.int32(0))), pickle.dumps(infos)]
    return pd.DataFrame([[pdf["part"].iloc[0], *loads]], columns=["part", "pairs", "entries", "places", "docs"])


def _frequent_words(docs: DataFrame, n_docs: int, n_parts: int) -> np.ndarray:
    """Words with more than half a part's tokens in a sample; at most ``FREQUENT``."""

    def count(batches):
        for whole in batches:
            for batch in words.slices(whole, "text"):
                values, counts = np.unique(token_stream(batch.column("text"))[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.astype(np.int64)), pa.array(counts)], ["token", "n"])

    some = docs.sample(min(1.0, SAMPLE_DOCS / max(n_docs, 1)), seed=1).select("text")
    counts = some.mapInArrow(count, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    total = counts.agg(F.sum("n")).first()[0] or 0
    often = counts.where(F.col("n") > total / (2 * n_parts)).orderBy(F.desc("n"), "token").limit(FREQUENT)
    return np.sort(np.array([r["token"] for r in often.collect()], dtype=np.int64).astype(_U))


def _next_state(parts: DataFrame, model: Model) -> tuple[State, np.ndarray, np.ndarray, int]:
    shared = parts.sparkSession.sparkContext.broadcast(model)

    def run(pdfs):
        for pdf in pdfs:
            for number, pairs in zip(pdf["part"], pdf["pairs"]):
                yield from part_sums(shared.value, int(number), pairs)

    rows = parts.select("part", "pairs").mapInPandas(run, "kind int, key long, x double, y double")
    sums = rows.groupBy("kind", "key").agg(F.sum("x").alias("x"), F.sum("y").alias("y")).toPandas()
    kinds = {k: sums[sums["kind"] == k] for k in range(4)}
    by_context, by_word = np.zeros((2, CONTEXTS)), np.zeros((2, len(model.frequent)))
    for held, kind in ((by_context, kinds[0]), (by_word, kinds[1])):
        held[:, kind["key"].to_numpy(int)] = kind[["x", "y"]].to_numpy().T
    customers = by_word[0].astype(np.int64)
    known = int(kinds[2]["x"].sum()) + int((by_word[1] > 0).sum())
    vocabulary = model.vocabulary or known
    # the parent's tables of frequent words are drawn here, as their customers come from many parts
    before = model.states[-1].parent_tables if model.states else known
    weight = (PARENT_STRENGTH + PARENT_DISCOUNT * before) / (vocabulary + 1)
    rng = np.random.Generator(np.random.Philox(key=[1 << 40, len(model.states)]))
    own_tables = Seating(PARENT_DISCOUNT).draw(customers, np.full(len(customers), weight), rng)
    others = kinds[3]["x"].sum() if model.states else kinds[2]["x"].sum()
    if model.states:
        model.states[-1].drawn_tables = float(others + model.states[-1].frequent_tables.sum())
    state = State(by_context[0], float(others + own_tables.sum()), customers, own_tables)
    return state, by_context[1], by_word[1], known


def score(docs: DataFrame, held_out: str = "pmod(crc32(cast(doc_id as string)), 5) = 1") -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, held_out, n_tokens, n_known, train_tokens, base_score and
    score, in log10. Documents for which the SQL condition ``held_out`` holds take no part in learning."""
    spark = docs.sparkSession
    words.use_batches(spark)
    rows = docs.select("doc_id", "text", F.coalesce(F.expr(held_out), F.lit(False)).alias("held"))
    n_docs, n_bytes = docs.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    n_parts = max(1, -(-(n_bytes or 0) // (6 * PART_TOKENS)))
    model = Model(_frequent_words(docs, n_docs, n_parts) if n_parts > 1 else np.zeros(0, _U))
    frequent = spark.sparkContext.broadcast(model.frequent)

    def pack(batches):
        done = TaskContext.get().partitionId() << 33
        for whole in batches:
            for batch in words.slices(whole, "text"):
                out = list(_packed(batch, done, n_parts, frequent.value))
                done += batch.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([p for p, _ in out], pa.int32()), pa.array([x for _, x in out], pa.binary())], ["part", "load"]
                )

    loads = rows.mapInArrow(pack, "part int, load binary")
    merged = loads.groupBy("part").applyInPandas(_merge, "part int, pairs binary, entries binary, places binary, docs binary")
    parts = stored(merged, "language-model", "zstd", ROW_BY_ROW)
    for sweep in range(BURN_IN + SAMPLES + 1):
        state, customers, counts, known = _next_state(parts, model)
        if sweep == BURN_IN + SAMPLES:
            break  # only the sums of the last sweep were wanted
        if not model.states:
            model.context_customers, model.frequent_counts = customers, counts
            model.tokens, model.vocabulary = int(customers.sum()), known
        model.states.append(state)
    shared = spark.sparkContext.broadcast(model)

    def judge(batches):
        for batch in batches:
            for n in range(batch.num_rows):
                load = lambda name: pickle.loads(batch.column(name)[n].as_buffer())  # noqa: E731, B023
                number, pairs = batch.column("part")[n].as_py(), batch.column("pairs")[n].as_buffer()
                found = [(first, -1, pickle.dumps((ids, held))) for first, ids, held in load("docs")]
                judged = [block.log_probabilities() for block in blocks(shared.value, number, pairs)]
                log_p, base, known = (np.concatenate(x) for x in zip(*judged))
                del judged, pairs
                for first, own, sums in document_sums([known, base, log_p], load("entries"), load("places")):
                    narrow = [x.astype(np.min_scalar_type(int(x.max()))) for x in (own, *sums[:2])]
                    found.append((first, number, pickle.dumps((*narrow, *sums[2:]))))
                columns = [pa.array(c, kind) for c, kind in zip(zip(*found), (pa.int64(), pa.int32(), pa.binary()))]
                yield pa.RecordBatch.from_arrays(columns, ["first", "part", "sums"])

    def add_up(table: pa.Table) -> pa.Table:
        """The documents of a batch, from what every part found for them, in order of the parts."""
        table = table.sort_by("part")
        loads = map(pickle.loads, (x.as_buffer() for x in table.column("sums")))
        ids, held = next(loads)
        totals = np.zeros((4, len(ids)))
        for own, *sums in loads:
            for total, x in zip(totals, sums):
                total[own] += x
        columns = [pa.array(ids, pa.int64()), pa.array(held), *(pa.array(t.astype(np.int64)) for t in totals[:2])]
        columns += [pa.array(np.full(len(ids), model_tokens)), *map(pa.array, totals[2:])]
        return pa.table(columns, names=[c.split()[0] for c in schema.split(", ")])

    model_tokens = model.tokens
    schema = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return parts.mapInArrow(judge, "first long, part int, sums binary").groupBy("first").applyInArrow(add_up, schema)
