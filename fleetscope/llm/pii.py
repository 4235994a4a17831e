"""Personal data in texts: rules find candidates, labelers vote on them, and a classifier learns from the votes.

Each kind has one or two patterns whose matches are candidates. Five labelers vote for, against or not at
all on a candidate: its format (check digits, ranges), lists of known values, words before it, its shape,
and what it touches. Expectation-maximisation over how often each combination of votes occurs estimates, per
labeler, how its votes go with right and wrong candidates, and so the probability that a candidate is right.
A naive Bayes classifier over hashed features of the candidate and its surroundings is trained with these
probabilities over the candidates of all documents, and decides: a candidate that keeps its format's checks
and that it favours becomes a span. Matches of the rules stated as base always do.

All of it is DataFrame functions. A text is scanned once per pattern, within its row; candidates of all
documents are written narrow, and only counts go through shuffles: combinations of votes (at most
3^labelers x kinds) and feature buckets (``BUCKETS``). Patterns neither back up nor start again inside a run
of the same characters, so that time is linear in the text; places of matches are summed in blocks.

Cases: a null or empty text has no spans; repeated rows and null ids are rows like any other; on an empty
table nothing is learnt and nothing fails; result columns replace input columns of the same names.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetscope.llm.tables import stored
from fleetscope.llm.textcols import let

BUCKETS = 1 << 12
ROUNDS = 20
#: Candidates' worth of doubt added to each feature.
DOUBT = 5.0
BEFORE, AFTER = 40, 20
BLOCK = 256

# ---- fixed values: kinds in the order of results, lists and words of the labelers ------------------
KINDS = ("email", "ip", "card", "phone", "iban", "name", "secret", "ssn")
LABELERS = ("format", "gazetteer", "context", "shape", "edges")
MAIL_HOSTS = "gmail yahoo hotmail outlook icloud aol gmx web proton mail"
CALLING_CODES = "1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 98"
IBAN_COUNTRIES = "AD AE AT BE BG CH CY CZ DE DK EE ES FI FR GB GR HR HU IE IL IS IT LI LT LU LV MC MT NL NO PL PT RO SA SE SI SK SM TR"
GIVEN_NAMES = (
    "James Mary John Patricia Robert Jennifer Michael Linda William Elizabeth David Barbara Richard Susan Joseph Jessica "
    "Thomas Sarah Charles Karen Anna Peter Hans Klaus Ursula Sabine Stefan Andreas Pierre Marie Jean Claire Luc Sophie "
    "Juan Carmen Carlos Lucia Pedro Ana Miguel Pilar Jose Maria Antonio Laura"
)
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Mme Mlle Sr Sra Don"
PLACEHOLDERS = "example changeme placeholder redacted your dummy sample xxxx none null undefined"
CUES = {
    "email": "mail email e-mail contact write send reply schreiben courriel correo",
    "ip": "ip address host server client from login addr adresse",
    "card": "card visa mastercard amex credit debit payment karte carte tarjeta",
    "phone": "phone tel telephone call mobile cell fax contact telefon téléphone teléfono",
    "iban": "iban account bank konto compte cuenta transfer",
    "name": "name signed dear from by regards sincerely named contact",
    "secret": "password passwd secret token key auth login credential",
    "ssn": "ssn social security tax number",
}
DOUBTS = "isbn issn version build order invoice serial part sku page figure section id no commit"

Rule = Callable[[Column], Column]


def _any(words: str) -> str:
    return "|".join(w.replace("-", r"\-") for w in words.split())


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(match: Column) -> Column:
    def total(digits: Column) -> Column:
        n = F.length(digits)

        def step(acc: Column, i: Column) -> Column:
            d = F.substring(digits, -i, F.lit(1)).cast("int") * F.when(i % 2 == 0, 2).otherwise(1)
            return acc + F.when(d > 9, d - 9).otherwise(d)

        return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), step)

    return let(_digits(match), total) % 10 == 0


def _in_range(match: Column) -> Column:
    """Whether each part of a dotted number is at most 255."""
    value = lambda p: F.when(F.length(p) <= 3, F.coalesce(p.try_cast("int"), F.lit(0))).otherwise(256)
    return F.forall(F.split(match, r"\."), lambda p: value(F.ltrim(p, F.lit("0"))) <= 255)


def _n_digits(low: int, high: int) -> Rule:
    return lambda m: F.length(_digits(m)).between(low, high)


def _iban_checks(match: Column) -> Column:
    """Remainder 1 of the number that the country and check digits, moved to the end, and letters as 10 to 35 make."""

    def turned(flat: Column) -> Column:
        moved = F.concat(F.substring(flat, F.lit(5), F.length(flat)), F.substring(flat, 1, 4))
        value = lambda c: F.when(c <= "9", F.ascii(c) - 48).otherwise(F.ascii(c) - 55)
        step = lambda acc, c: (acc * F.when(c <= "9", 10).otherwise(100) + value(c)) % 97
        return F.aggregate(F.split(moved, ""), F.lit(0), step) == 1

    return let(F.regexp_replace(match, " ", ""), turned)


def _always(match: Column) -> Column:
    return match.isNotNull()


@dataclass(frozen=True)
class Pattern:
    """Candidates of a kind: what they look like, which of them keep their format's checks, and which of these
    are spans in any case. ``known`` and ``unknown`` are what the list labeler looks for."""

    kind: str
    looks: str
    valid: Rule = _always
    base: Rule | None = None
    known: str | None = None
    unknown: str | None = None
    needs: str = ""  # a text without any of these characters has no match


_LOCAL = "[A-Za-z0-9._%+-]"
PATTERNS = (
    Pattern(
        "email",
        rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        base=_always,
        known=rf"(?i)@(?:[a-z0-9-]+\.)*(?:{_any(MAIL_HOSTS)})[0-9]*\.",
        needs="@",
    ),
    Pattern("ip", r"[0-9](?<![0-9][0-9])[0-9]*+(?:\.[0-9]++){3}", _in_range, base=_in_range, unknown=r"^(?:0|255)\."),
    Pattern(
        "card",
        r"[0-9](?<![0-9][0-9])(?<![0-9][ -][0-9])(?:[ -]?[0-9]){12,18}+(?![ -]?[0-9])",
        _luhn,
        base=lambda m: _n_digits(16, 19)(m) & _luhn(m),
        known=r"^(?:4|5[1-5]|2[2-7]|3[47]|6)",
        unknown=r"^[01789]",
    ),
    Pattern(
        "phone",
        r"\+[0-9][ ().0-9-]+[0-9]",
        _n_digits(8, 15),
        base=_n_digits(8, 15),
        known=rf"^\+(?:{_any(CALLING_CODES)})\b",
        needs="+",
    ),
    Pattern(
        "phone",
        r"(?=[(0-9])(?<![0-9A-Za-z+])(?<!\+[0-9]{1,3}[ .-]{0,1})(?:\([0-9]{3}\) ?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9A-Za-z])",
        lambda m: m.rlike(r"^\(?[2-9][0-9]{2}\)? ?[.-]?[2-9]"),
        known=r"555[.-]",
    ),
    Pattern(
        "iban",
        r"(?=[A-Z])(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}+(?: ?[A-Z0-9]{1,3}+)?+(?![A-Za-z0-9])",
        _iban_checks,
        known=rf"^(?:{_any(IBAN_COUNTRIES)})",
        unknown=rf"^(?!{_any(IBAN_COUNTRIES)})",
    ),
    Pattern(
        "name",
        rf"(?=[A-Z])(?<![\p{{L}}0-9])(?:(?:{_any(TITLES)})\.? |(?={_any(GIVEN_NAMES)}))\p{{Lu}}\p{{Ll}}{{1,30}}+ \p{{Lu}}\p{{Ll}}{{1,30}}+(?!\p{{L}})",
        known=rf"\b(?:{_any(GIVEN_NAMES)})\b",
    ),
    Pattern(
        "secret",
        r"""(?i)(?<=[=:"' ])(?=[^\s"',;|]{8})(?<=(?:password|passwd|secret|token|api_key|apikey|access_key)["']{0,1}[ ]{0,2}[:=][ ]{0,2}["']{0,1})[^\s"',;|]{8,200}+""",
        valid=lambda m: m.rlike("[0-9]") & ~m.rlike(r"(.)\1{5}") & (F.size(F.array_distinct(F.split(m, ""))) >= 5),
        known=r"^(?:[0-9a-fA-F]{16,}|(?=.*[0-9])(?=.*[A-Za-z])[^ ]{12,})$",
        unknown=rf"(?i){_any(PLACEHOLDERS)}",
        needs="=:",
    ),
    Pattern(
        "ssn",
        r"(?=[0-9])(?<![0-9A-Za-z-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9A-Za-z-])",
        lambda m: ~m.rlike("^(?:000|666|9)|-00-|-0000$"),
        unknown=r"^(?:123-45-6789|078-05-1120)$",
    ),
)


def _scan(sizes: Column, start: Column) -> Column:
    """Sums of ``start`` and the first 1, 2, ... of ``sizes``."""
    begin = F.struct(start.cast("long").alias("at"), F.array().cast("array<bigint>").alias("out"))

    def step(acc: Column, size: Column) -> Column:
        return let(acc["at"] + size, lambda at: F.struct(at.alias("at"), F.concat(acc["out"], F.array(at)).alias("out")))

    return F.aggregate(sizes, begin, step, lambda acc: acc["out"])


def _ends(sizes: Column) -> Column:
    """Running sums of an array, in blocks so that long arrays cost little more than their length."""

    def blocks(own: Column) -> Column:
        cut = F.transform(F.sequence(F.lit(0), F.floor((F.size(own) - 1) / BLOCK).cast("int")), lambda b: F.slice(own, b * BLOCK + 1, BLOCK))
        total = lambda x: F.aggregate(x, F.lit(0).cast("long"), lambda a, v: a + v)
        ends = lambda own: _scan(F.transform(own, total), F.lit(0))
        return let(cut, lambda c: F.flatten(F.zip_with(c, ends(c), lambda x, end: _scan(x, end - total(x)))))

    return let(sizes, lambda own: F.when(F.size(own) <= BLOCK, _scan(own, F.lit(0))).otherwise(blocks(own)))


def _matches(text: Column, looks: str, needs: str) -> Column:
    """All matches from left to right: start and end in code points, the match, and what stands next to it."""
    may = [text.contains(c) for c in needs] or [F.lit(True)]
    start = F.array().cast("array<struct<start:bigint,end:bigint,match:string,before:string,after:string>>")

    def placed(pieces: Column, found: Column) -> Column:
        sizes = F.zip_with(F.slice(pieces, 1, F.size(found)), found, lambda p, m: (F.length(p) + F.length(m)).cast("long"))
        ends = lambda e: F.transform(
            found,
            lambda m, i: F.struct(
                (F.get(e, i) - F.length(m)).alias("start"),
                F.get(e, i).alias("end"),
                m.alias("match"),
                F.substring(F.get(pieces, i), -BEFORE, BEFORE).alias("before"),
                F.substring(F.get(pieces, i + 1), 1, AFTER).alias("after"),
            ),
        )
        return let(_ends(sizes), ends)

    cut = let(F.split(text, looks), lambda p: let(F.regexp_extract_all(text, F.lit(looks), 0), lambda m: placed(p, m)))
    return F.when(reduce(or_, may) & text.rlike(looks), cut).otherwise(start)


def _votes(p: Pattern, x: Column, valid: Column) -> Column:
    """One vote per labeler: 1 for, -1 against, 0 none."""
    before, match = F.lower(x["before"]), x["match"]
    seen = lambda pattern: F.lit(False) if pattern is None else match.rlike(pattern)
    cue = lambda words: before.rlike(rf"(?<!\p{{L}})(?:{_any(words)})(?!\p{{L}})[^\n]{{0,20}}$")
    touches = x["before"].rlike(r"[\p{L}0-9]$") | x["after"].rlike(r"^[\p{L}0-9]")
    alone = (F.length(x["before"]) == 0) | x["before"].rlike(r"[\s(\[{<\"':=|]$")
    return F.array(
        F.when(valid, 1).otherwise(-1),
        F.when(seen(p.unknown), -1).when(seen(p.known), 1).otherwise(0),
        F.when(cue(DOUBTS), -1).when(cue(CUES[p.kind]), 1).otherwise(0),
        F.when(match.rlike(r"([0-9A-Za-z])\1{5}"), -1).when(F.size(F.array_distinct(F.split(match, ""))) >= 5, 1).otherwise(0),
        F.when(touches, -1).when(alone, 1).otherwise(0),
    )


def _features(kind: str, x: Column, votes: Column) -> Column:
    """Buckets of what the classifier sees of a candidate."""
    shape = F.regexp_replace(F.regexp_replace(F.regexp_replace(x["match"], "[0-9]+", "9"), r"\p{Lu}+", "A"), r"\p{Ll}+", "a")
    last, first = F.regexp_extract(F.lower(x["before"]), r"(\p{L}+)[^\p{L}]*$", 1), F.regexp_extract(F.lower(x["after"]), r"^[^\p{L}]*(\p{L}+)", 1)
    said = [F.concat(F.lit(f"vote {name} "), votes[i].cast("string")) for i, name in enumerate(LABELERS)]
    seen = [
        F.lit(f"kind {kind}"),
        F.concat(F.lit(f"shape {kind} "), F.substring(shape, 1, 20)),
        F.concat(F.lit(f"size {kind} "), F.floor(F.length(x["match"]) / 4).cast("string")),
        F.concat(F.lit(f"before {kind} "), last),
        F.concat(F.lit(f"after {kind} "), first),
    ]
    return F.array(*(F.pmod(F.xxhash64(f), F.lit(BUCKETS)).cast("int") for f in [*seen, *said]))


def _candidates(text: Column, p: Pattern) -> Column:
    def judged(x: Column) -> Column:
        def with_votes(valid: Column) -> Column:
            one = lambda votes: F.struct(
                F.lit(KINDS.index(p.kind)).alias("kind"),
                x["start"].alias("start"),
                x["end"].alias("end"),
                valid.alias("valid"),
                (F.lit(False) if p.base is None else p.base(x["match"])).alias("base"),
                votes.alias("votes"),
                _features(p.kind, x, votes).alias("features"),
            )
            return let(_votes(p, x, valid), one)

        return let(p.valid(x["match"]), with_votes)

    return F.transform(_matches(text, p.looks, p.needs), judged)


def candidates(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with all candidates of each text in ``candidates``."""
    whole = F.coalesce(F.col(text), F.lit(""))
    return docs.withColumn("candidates", F.concat(*(_candidates(whole, p) for p in PATTERNS)))


def _sigmoid(x: Column) -> Column:
    return 1 / (1 + F.exp(-x))


def _sum(items: Column, value: Callable[[Column], Column]) -> Column:
    return F.aggregate(items, F.lit(0.0), lambda acc, x: acc + value(x))


def reliabilities(found: DataFrame) -> DataFrame:
    """One row: for each labeler and vote the log of how much likelier it is on right candidates (``ratios``,
    three per labeler), and each kind's log odds (``odds``), by expectation-maximisation over all candidates.

    It starts from the majority of votes. One count is added for a vote that fits, half a count for one that does not.
    """
    votes = found.select(F.explode("candidates").alias("c")).groupBy("c.kind", "c.votes").agg(F.count("*").alias("n"))
    listed = votes.agg(F.sort_array(F.collect_list(F.struct("kind", "votes", "n"))).alias("seen"))
    slots = F.sequence(F.lit(0), F.lit(3 * len(LABELERS) - 1))

    def learn(state: Column) -> Column:
        """Log ratios and log odds from the probability of each combination."""
        rows = F.zip_with("seen", state, lambda s, w: F.struct(s["kind"], s["votes"], s["n"], w.alias("w")))

        def counted(z: Column) -> Column:
            good, bad = _sum(z, lambda x: x["n"] * x["w"]), _sum(z, lambda x: x["n"] * (1 - x["w"]))

            def ratio(s: Column) -> Column:
                vote, labeler = s % 3 - 1, F.floor(s / 3).cast("int")
                here = lambda x, w: F.when(F.get(x["votes"], labeler) == vote, x["n"] * w).otherwise(0.0)
                fits = F.when(vote == 1, 1.0).otherwise(0.5)
                against = F.when(vote == -1, 1.0).otherwise(0.5)
                up = (_sum(z, lambda x: here(x, x["w"])) + fits) / (good + 2)
                down = (_sum(z, lambda x: here(x, 1 - x["w"])) + against) / (bad + 2)
                return F.log(up / down)

            def odds(k: Column) -> Column:
                here = lambda x, w: F.when(x["kind"] == k, x["n"] * w).otherwise(0.0)
                return F.log((_sum(z, lambda x: here(x, x["w"])) + 1) / (_sum(z, lambda x: here(x, 1 - x["w"])) + 1))

            kinds = F.sequence(F.lit(0), F.lit(len(KINDS) - 1))
            return F.struct(F.transform(slots, ratio).alias("ratios"), F.transform(kinds, odds).alias("odds"))

        return let(rows, counted)

    majority = F.transform("seen", lambda s: _sigmoid(F.aggregate(s["votes"], F.lit(0.0), lambda a, v: a + v)))
    again = lambda state, _: let(learn(state), lambda m: F.transform("seen", lambda s: probability(s, m)))
    final = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), majority, again, learn)
    return listed.select(final.alias("m")).select("m.ratios", "m.odds")


def probability(candidate: Column, model: Column) -> Column:
    """How likely a candidate is right, by the votes on it."""
    said = F.transform(candidate["votes"], lambda v, i: F.get(model["ratios"], i * 3 + v + 1))
    return _sigmoid(_sum(said, lambda r: r) + F.get(model["odds"], candidate["kind"]))


def train(found: DataFrame, model: DataFrame) -> DataFrame:
    """One row: the classifier's weight of each bucket (``weights``) and its log odds without any (``bias``)."""
    right = F.transform("candidates", lambda c: F.struct(c["features"].alias("features"), probability(c, F.col("m")).alias("p")))
    rows = found.where(F.size("candidates") > 0).withColumn("m", model.select(F.struct("ratios", "odds")).scalar())
    seen = rows.select(F.explode(right).alias("c")).select("c.p", F.explode(F.array_distinct("c.features")).alias("bucket"))
    counts = seen.groupBy("bucket").agg(F.sum("p").alias("good"), F.sum(1 - F.col("p")).alias("bad"))
    every = found.sparkSession.range(0, BUCKETS, 1, 1).select(F.col("id").cast("int").alias("bucket"))
    filled = every.join(counts, "bucket", "left").na.fill(0.0, ["good", "bad"])
    share = F.greatest(F.lit(0.01), F.least(F.lit(0.99), F.coalesce(F.sum("good") / F.nullif(F.sum("good") + F.sum("bad"), F.lit(0.0)), F.lit(0.5))))
    listed = filled.agg(F.sort_array(F.collect_list(F.struct("bucket", "good", "bad"))).alias("by_bucket"), share.alias("share"))
    odds = F.log(F.col("share") / (1 - F.col("share")))
    weight = lambda b: F.log((b["good"] + DOUBT * F.col("share")) / (b["bad"] + DOUBT * (1 - F.col("share")))) - odds
    return listed.select(F.transform("by_bucket", weight).alias("weights"), odds.alias("bias"))


def find(docs: DataFrame, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Columns ``keep`` of ``docs`` (default: all) and ``spans``: kind, start, end (code points, end exclusive),
    base and score (the classifier's log odds), in the order of ``KINDS``, then start."""
    keep = [c for c in (docs.columns if keep is None else keep) if c != "spans"]
    renamed = {c: f"__own_{c}" for c in keep}
    rows = docs.select(*(F.col(c).alias(renamed[c]) for c in keep), F.col(text).alias("text"))
    found = stored(candidates(rows).drop("text"), "candidates")
    model = stored(reliabilities(found), "reliabilities")
    learnt = stored(train(found, model), "classifier")
    score = lambda c: _sum(F.array_distinct(c["features"]), lambda b: F.get(F.col("__weights"), b)) + F.col("__bias")
    scored = F.transform(
        "candidates",
        lambda c: F.struct(c["kind"], c["start"], c["end"], c["base"], c["valid"], score(c).alias("score")),
    )
    taken = F.filter(scored, lambda s: s["base"] | (s["valid"] & (s["score"] > 0)))
    names = F.array(*map(F.lit, KINDS))
    named = F.transform(
        F.sort_array(taken),
        lambda s: F.struct(F.get(names, s["kind"]).alias("kind"), s["start"], s["end"], s["base"], s["score"]),
    )
    none = F.array().cast("array<struct<kind:string,start:bigint,end:bigint,base:boolean,score:double>>")
    joined = found.withColumns({"__weights": learnt.select("weights").scalar(), "__bias": learnt.select("bias").scalar()})
    spans = F.when(F.size("candidates") > 0, named).otherwise(none)
    return joined.select(*(F.col(renamed[c]).alias(c) for c in keep), spans.alias("spans"))
