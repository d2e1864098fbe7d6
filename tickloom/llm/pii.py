"""Personal data by weak supervision, in Spark SQL expressions only.

Base spans (email, ip, card, phone) come from fixed patterns with their checks and always stay. Further
candidates come from looser patterns: numbers that a base pattern swallowed together with a neighbour,
numbers without a plus sign, addresses written out. Labelers vote on every span, base or not: shape,
check (checksum, range, digit count), gazetteer (issuer prefixes, calling codes, top-level domains),
context words before it, and the characters around it. Each says yes, no or nothing.

Votes are counted by pattern in Spark. Expectation-maximisation over these counts (a table whose size is
bounded by the number of labelers, not by the data) estimates how reliable each labeler is for each kind
and gives every pattern a probability; a logistic span classifier is then trained on span features with
these probabilities as labels, and scores spans as a Spark expression. Candidates that fail their check,
overlap a base span or score below the threshold are dropped.

Documents are read once; their spans are stored, then counted and scored without a shuffle of texts.

Edge cases: NULL is the empty text; texts without spans give empty lists; repeated rows give repeated
results; an empty table trains nothing and gives an empty result. Texts are read whole; positions count
code points.
"""

from __future__ import annotations

import math
from collections import defaultdict
from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from tickloom.session import store

KINDS = ("email", "ip", "card", "phone")
THRESHOLD = 0.9
ROUNDS = 60
STEPS = 400
CONTEXT = 40

# Possessive quantifiers keep the matcher iterative on very long texts; the look-behinds only skip starts
# inside a run whose start has failed. Matches are those of the plain patterns.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:\G|(?<!{_LOCAL})){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:\G|(?<![0-9]))[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"(?:\G|(?<![0-9]))[0-9](?:[ -]?+[0-9]){12,}+",
    "phone": r"\+[0-9][ ().0-9-]+[0-9]",
}
_AT, _DOT = r"\s?[\[(](?:at|AT|@)[\])]\s?", r"(?:\s?[\[(](?:dot|DOT|\.)[\])]\s?|\.)"
LOOSE = {
    "email": rf"(?<!{_LOCAL}){_LOCAL}{{1,64}}{_AT}[A-Za-z0-9-]{{1,63}}(?:{_DOT}[A-Za-z0-9-]{{2,63}}){{1,4}}",
    "ip": r"(?<![0-9A-Za-z.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9A-Za-z])(?!\.[0-9])",
    "card": r"(?<![0-9A-Za-z])(?:[0-9]{13,19}|[0-9]{4}(?:[ -][0-9]{4}){2}[ -][0-9]{1,7})(?![0-9A-Za-z])",
    "phone": r"(?:(?<![0-9A-Za-z+])\+[0-9]{1,3}[ .-]?|(?<![0-9A-Za-z)+.-]))(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9A-Za-z])",
}
SHAPE = {
    "email": r"^[A-Za-z0-9][^@]*@[^@]*\.[A-Za-z]{2,}$",
    "ip": r"^(?:0|[1-9][0-9]{0,2})(?:\.(?:0|[1-9][0-9]{0,2})){3}$",
    "card": r"^(?:[0-9]{15,16}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{4})$",
    "phone": r"^\+[0-9]{1,3}[ .-]?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-]?[0-9]{4}$",
}
GAZETTEER = {
    "email": r"(?i)(?:com|net|org|edu|gov|info|io|co|de|fr|es|uk|eu|it|nl|ru|cn|jp|br|in)$",
    "ip": r"^(?!0|127\.|255\.255)",
    "card": r"^(?:4|5[1-5]|2[2-7]|3[47]|6)",
    "phone": r"^\+(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])",
}
CONTEXT_WORDS = {
    "email": r"(?i)mail|contact|write|correo|kontakt",
    "ip": r"(?i)\bip\b|host|server|address|adresse",
    "card": r"(?i)card|visa|credit|payment|karte|carte|tarjeta",
    "phone": r"(?i)phone|tel|call|mobil|fax|cell",
}
AGAINST = r"(?i)(?:token|hash|sha|key|secret|password|isbn|version|order)\W*\w*\W*$"
LABELERS = ("shape", "check", "gazetteer", "context", "edges")
FEATURES = ("shape", "check", "gazetteer", "context", "edges", "size", "before", "after")


def _spans(parts: Column, matches: Column) -> Column:
    """start, end, text, before, after for each match; ``parts`` is the text split at the matches."""
    nothing = F.array().cast("array<struct<start:int,end:int,text:string,before:string,after:string>>")

    def step(done: Column, i: Column) -> Column:
        match, gap = F.get(matches, i), F.get(parts, i)
        start = done["at"] + F.length(gap)
        end = start + F.length(match)
        span = F.struct(
            start.alias("start"),
            end.alias("end"),
            match.alias("text"),
            F.substring(gap, -CONTEXT, CONTEXT).alias("before"),
            F.substring(F.get(parts, i + 1), 1, 1).alias("after"),
        )
        return F.struct(end.alias("at"), F.concat(done["spans"], F.array(span)).alias("spans"))

    begin = F.struct(F.lit(0).alias("at"), nothing.alias("spans"))
    placed = F.aggregate(F.sequence(F.lit(0), F.size(matches) - 1), begin, step, lambda done: done["spans"])
    return F.when(F.size(matches) > 0, placed).otherwise(nothing)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, n - i, F.lit(1)).cast("int")
        twice = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(i % 2 == 1, twice).otherwise(digit)

    return F.aggregate(F.sequence(F.lit(0), n - 1), F.lit(0), add) % 10 == 0


def passes(kind: str, text: Column) -> Column:
    """The check of a kind on the text of a match."""
    digits = _digits(text)
    if kind == "ip":
        values = F.transform(F.split(text, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
        return F.forall(values, lambda v: F.when(F.length(v) <= 3, v.cast("int") <= 255).otherwise(False))
    if kind == "card":
        return F.when(F.length(digits).between(13, 19), _luhn(digits)).otherwise(False)
    if kind == "phone":
        return F.length(digits).between(9, 15)
    return F.lit(True)


def _vote(yes: Column, no: Column | None = None) -> Column:
    said = F.when(yes, 1)
    return (said.otherwise(0) if no is None else said.when(no, 0).otherwise(-1)).cast("int")


def _class(character: Column) -> Column:
    return (
        F.when(F.coalesce(character, F.lit("")) == "", "none")
        .when(character.rlike(r"^\s$"), "space")
        .when(character.rlike(r"^[0-9]$"), "digit")
        .when(character.rlike(r"^\p{L}$"), "letter")
        .otherwise("mark")
    )


def _judged(kind: str, span: Column, base: Column) -> Column:
    """The span with votes and features; what the classifier and the labelers see of it."""
    before = _class(F.substring(span["before"], -1, 1))
    after = _class(span["after"])
    open_edges = ~before.isin("letter", "digit") & ~after.isin("letter", "digit")
    return F.struct(
        F.lit(kind).alias("kind"),
        span["start"].alias("start"),
        span["end"].alias("end"),
        base.alias("base"),
        _vote(span["text"].rlike(SHAPE[kind])).alias("shape"),
        _vote(passes(kind, span["text"])).alias("check"),
        _vote(span["text"].rlike(GAZETTEER[kind])).alias("gazetteer"),
        _vote(span["before"].rlike(CONTEXT_WORDS[kind]), span["before"].rlike(AGAINST)).alias("context"),
        _vote(open_edges).alias("edges"),
        F.least(F.length(span["text"]), F.lit(24)).alias("size"),
        before.alias("before"),
        after.alias("after"),
    )


def _passing(kind: str):
    return lambda span: passes(kind, span["text"])


def _judge(kind: str, base: bool):
    return lambda span: _judged(kind, span, F.lit(base))


def _of_kind(kind: str):
    return lambda span: span["kind"] == kind


def find_spans(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, spans``: base spans and candidates of each document, with votes and features."""
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text, F.lit("")).alias("_t"))
    has_digit, has_at = F.col("_t").rlike("[0-9]"), F.col("_t").contains("@")
    gates = {"email": has_at, "ip": has_digit, "card": has_digit, "phone": F.col("_t").contains("+")}
    loose_gates = {
        "email": F.col("_t").rlike(r"[\[(](?:at|AT|@)[\])]"), "ip": has_digit, "card": has_digit, "phone": has_digit
    }
    none = F.array().cast("array<string>")
    sets = [("b", BASE, gates), ("c", LOOSE, loose_gates)]
    for name, patterns, gate in sets:
        rows = rows.withColumns(
            {
                f"_{name}{kind}": F.when(gate[kind], F.regexp_extract_all("_t", F.lit(patterns[kind]), F.lit(0))).otherwise(none)
                for kind in KINDS
            }
        )
    for name, patterns, _ in sets:
        rows = rows.withColumns(
            {f"_p{name}{kind}": F.when(F.size(f"_{name}{kind}") > 0, F.split("_t", patterns[kind], -1)) for kind in KINDS}
        )
    rows = rows.select(
        "id", *[_spans(F.col(f"_p{n}{kind}"), F.col(f"_{n}{kind}")).alias(f"{n}_{kind}") for n, _, _ in sets for kind in KINDS]
    )
    kept = {f"b_{kind}": F.filter(f"b_{kind}", _passing(kind)) for kind in KINDS}
    rows = rows.withColumns(kept)
    every = F.concat(*[F.transform(f"b_{kind}", lambda s: F.struct(s["start"], s["end"])) for kind in KINDS])
    rows = rows.withColumn("taken", every)

    def free(span: Column) -> Column:
        return ~F.exists("taken", lambda t: (t["start"] < span["end"]) & (span["start"] < t["end"]))

    judged = [F.transform(f"b_{kind}", _judge(kind, True)) for kind in KINDS]
    judged += [F.transform(F.filter(f"c_{kind}", free), _judge(kind, False)) for kind in KINDS]
    return rows.select("id", F.concat(*judged).alias("spans"))


# --- learning: plain arithmetic on the table of vote patterns -----------------------------------


def estimate(counts: list[tuple[tuple[int, ...], float]], rounds: int = ROUNDS) -> dict[tuple[int, ...], float]:
    """Probability of each vote pattern that its spans are personal data: expectation-maximisation of the
    share of such spans and of each labeler's votes given the truth. Starts from the mean vote."""
    total = sum(n for _, n in counts)
    chance = {}
    for votes, _ in counts:
        said = [v for v in votes if v >= 0]
        chance[votes] = min(max(sum(said) / len(said) if said else 0.5, 0.05), 0.95)
    for _ in range(rounds):
        share = (sum(chance[v] * n for v, n in counts) + 1) / (total + 2)
        tables = []
        for at in range(len(counts[0][0])):
            seen = {(truth, vote): 0.5 for truth in (0, 1) for vote in (-1, 0, 1)}
            for votes, n in counts:
                seen[1, votes[at]] += chance[votes] * n
                seen[0, votes[at]] += (1 - chance[votes]) * n
            sums = {truth: sum(seen[truth, vote] for vote in (-1, 0, 1)) for truth in (0, 1)}
            tables.append({key: value / sums[key[0]] for key, value in seen.items()})
        for votes, _ in counts:
            odds = math.log(share / (1 - share))
            odds += sum(math.log(t[1, v] / t[0, v]) for t, v in zip(tables, votes, strict=True))
            chance[votes] = 1 / (1 + math.exp(-max(min(odds, 30), -30)))
    return chance


def train(rows: list[tuple[dict[str, object], float, float]], steps: int = STEPS) -> dict[tuple[str, str], float]:
    """Weights of a logistic classifier by feature and value; rows are (features, probability, count).
    The key ("", "") is the constant."""
    keys = [[("", ""), *[(name, str(value)) for name, value in features.items()]] for features, _, _ in rows]
    total = sum(n for _, _, n in rows)
    weights: dict[tuple[str, str], float] = defaultdict(float)
    for _ in range(steps):
        slope: dict[tuple[str, str], float] = defaultdict(float)
        for own, (_, chance, n) in zip(keys, rows, strict=True):
            score = 1 / (1 + math.exp(-max(min(sum(weights[k] for k in own), 30), -30)))
            for k in own:
                slope[k] += n * (chance - score)
        for k, s in slope.items():
            weights[k] += 0.8 * (s / total - 1e-3 * weights[k])
    return dict(weights)


def learn(patterns: list[Row]) -> dict[str, dict[tuple[str, str], float]]:
    """Classifier weights by kind, from the counted patterns (kind, features, count)."""
    models = {}
    for kind in KINDS:
        rows = [r for r in patterns if r["kind"] == kind]
        if not rows:
            continue
        votes: dict[tuple[int, ...], float] = defaultdict(float)
        for r in rows:
            votes[tuple(r[name] for name in LABELERS)] += r["n"]
        chance = estimate(sorted(votes.items()))
        models[kind] = train(
            [({f: r[f] for f in FEATURES}, chance[tuple(r[name] for name in LABELERS)], r["n"]) for r in rows]
        )
    return models


def score(span: Column, models: dict[str, dict[tuple[str, str], float]]) -> Column:
    """The classifier's probability for a span."""
    result = F.lit(0.0)
    for kind, weights in models.items():
        total = F.lit(weights.get(("", ""), 0.0))
        for feature in FEATURES:
            values = {v: w for (name, v), w in weights.items() if name == feature}
            text = span[feature].cast("string")
            total = total + reduce(lambda c, vw: c.when(text == vw[0], vw[1]), list(values.items())[1:], F.when(text == next(iter(values)), next(iter(values.values())))).otherwise(0.0)
        result = F.when(span["kind"] == kind, 1 / (1 + F.exp(-total))).otherwise(result)
    return result


def personal_data(docs: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """``id, base, spans``: base spans, and these with the spans that the classifier adds; each is
    (kind, start, end), in the order of kinds and starts."""
    found = store(find_spans(docs, id_col, text), "pii-spans")
    # Bounded: kinds x votes x length classes x kinds of neighbours.
    patterns = (
        found.select(F.inline("spans")).groupBy("kind", *FEATURES).agg(F.count("*").alias("n")).orderBy("kind", *FEATURES).collect()
    )
    models = learn(patterns)

    def place(span: Column) -> Column:
        rank = reduce(lambda c, k: c.when(span["kind"] == k[1], k[0]), list(enumerate(KINDS))[1:], F.when(span["kind"] == KINDS[0], 0))
        return F.struct(rank.alias("rank"), span["start"].alias("start"), span["end"].alias("end"), span["kind"].alias("kind"))

    def accepted(span: Column) -> Column:
        if not models:
            return span["base"]
        return span["base"] | ((span["check"] == 1) & (score(span, models) >= threshold))

    base = F.array_sort(F.transform(F.filter("spans", lambda s: s["base"]), place))
    everything = F.array_sort(F.transform(F.filter("spans", accepted), place))
    return found.select("id", base.alias("base"), everything.alias("spans"))


def span_text(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digests(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    found = personal_data(docs, id_col, text)
    counts = [
        F.size(F.filter("base", _of_kind(kind))).cast("long").alias(f"n_{kind}") for kind in KINDS
    ]
    return found.select(
        F.col("id").alias(id_col), *counts, F.sha2(span_text(F.col("base")), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans")
    )
