"""Toxicity by a weighted finite-state pattern grammar over clauses.

Five weighted transducers read the words of a clause one after the other's output. *Reported speech* marks
what follows a verb of saying as quoted; *negation* and *target* mark the words in their scopes as denied and as
near somebody; *threat* waits for a target after a verb of harm that is neither denied nor quoted; *insult* turns
an accepted word into a direct, aimed or muted match by the marks it finds. They are composed once into one
machine (``machine()``), whose table is walked over each clause; an arc's weight times the weight of the lexicon's
arc for the word is what a match adds. The lexicon accepts whole words, or stems that any ending may follow. A
document is described by the sums and the best of its clauses, and a logistic curve turns that into a
probability. Clauses without an insult or threat score zero, so an Aho-Corasick pass over the text finds the
clauses that the grammar has to read.

What is learned: lexicon arcs (beside a short list that is given) and the curve. Labels come from at most
``LABELLED`` labelled rows that are not held out, those of the smallest hash of the id; copies and
near-copies among them count once (equal least shingle hash). An arc is kept if it is far more frequent in
toxic documents by odds and by likelihood ratio, in both halves of the sample. Counting runs in Spark; the
driver gets at most ``ARCS`` arcs and five figures for each sampled row. Scoring is one pass over all
documents without shuffle.

Edge cases: NULL is the empty text; empty texts get the constant's score; without usable labels of both
kinds the given list and fixed weights are used; repeated rows get equal scores; a NULL id is not held
out; an empty table gives an empty result. Texts are read whole.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections import defaultdict
from collections.abc import Iterator
from functools import cache, reduce

import ahocorasick
import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickloom.llm.transducers import Arc, Table, Transducer, compose, transducer
from tickloom.session import store

LABELLED = 12_000
ARCS = 5_000
STEM = range(3, 8)
ODDS = 2.0
LIKELIHOOD = 20.0
THRESHOLD = 0.7
ONE_WORD, LONGER_STEM = 0.7, 0.95
# Counts of so many arcs are held by a task at once, some 8 MB. Spark adds up what comes after each other.
FLUSH = 50_000
COUNT_BITS = 32

# The given part of the lexicon.
INSULTS = {w: 4.0 for w in "idiot moron stupid scum loser pathetic worthless disgusting trash clown imbecile cretin".split()}
THREATS = frozenset("kill hurt destroy beat stab shoot burn crush murder".split())
TARGETS = frozenset("you your yourself u he she they him her them du dich dir ihr euch tu te toi vous usted ustedes".split())
NEGATIONS = frozenset("not no never nobody neither without isn't aren't wasn't don't doesn't nicht kein keine nie pas jamais nunca".split())
REPORTS = frozenset("said says say told wrote writes claimed called quoted sagte sagt schrieb dit disait dijo".split())

CLAUSE_END = re.compile(r"[.!?;\n]")
WORD = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")
NEGATION_SCOPE, TARGET_SCOPE, THREAT_SCOPE = 3, 6, 3
FIGURES = ("direct", "aimed", "muted", "best", "threats")
#: Used where nothing can be learned: constant, then one weight for each figure.
PRIOR = (-4.0, 1.0, 0.3, 0.2, 0.6, 1.0)

Arcs = dict[str, float]


# Classes of a word, as bits: what the composed machine reads.
REPORT, NEGATION, TARGET, HARM, INSULT = (1 << n for n in range(5))
CLASS_BITS = 5
# Marks that the transducers add to a word.
QUOTED, DENIED, NEAR, THREATENS, DIRECT, AIMED, MUTED = (1 << n for n in range(CLASS_BITS, CLASS_BITS + 7))


def reported_speech() -> Transducer:
    """Everything from a verb of saying to the end of the clause is quoted."""

    def step(quoted: bool, bits: int) -> Arc:
        quoted = quoted or bool(bits & REPORT)
        return Arc(quoted, QUOTED if quoted else 0, 1.0)

    return transducer(False, REPORT, step)


def scope(opens: int, mark: int, words: int) -> Transducer:
    """Marks a word of class ``opens`` and the next ``words`` words. The state is the number of words left."""

    def step(left: int, bits: int) -> Arc:
        if bits & opens:
            return Arc(words, mark, 1.0)
        return Arc(max(left - 1, 0), mark if left else 0, 1.0)

    return transducer(0, opens, step)


def threat(words: int) -> Transducer:
    """A verb of harm, neither denied nor quoted, and a target among the next ``words`` words."""

    def step(left: int, bits: int) -> Arc:
        met = left and bits & TARGET
        left = 0 if met else max(left - 1, 0)
        if bits & HARM and not bits & (DENIED | QUOTED):
            left = words
        return Arc(left, THREATENS if met else 0, 1.0)

    return transducer(0, TARGET | HARM | DENIED | QUOTED, step)


def insult() -> Transducer:
    """What an accepted word counts as. Its weight is that of the lexicon's arc; other words weigh nothing."""

    def step(state: int, bits: int) -> Arc:
        if not bits & INSULT:
            return Arc(state, 0, 0.0)
        if bits & (DENIED | QUOTED):
            return Arc(state, MUTED, 1.0)
        return Arc(state, DIRECT | AIMED if bits & NEAR else DIRECT, 1.0)

    return transducer(0, INSULT | DENIED | QUOTED | NEAR, step)


def parts() -> list[Transducer]:
    """The transducers in the order in which each reads the other's output."""
    return [reported_speech(), scope(NEGATION, DENIED, NEGATION_SCOPE), scope(TARGET, NEAR, TARGET_SCOPE), threat(THREAT_SCOPE), insult()]


@cache
def machine() -> Table:
    """Their composition, the same for every lexicon."""
    return Table(reduce(compose, parts()), CLASS_BITS)


def word_class(word: str) -> int:
    """The classes of a word that do not depend on the lexicon."""
    listed = ((REPORTS, REPORT), (NEGATIONS, NEGATION), (TARGETS, TARGET), (THREATS, HARM))
    return sum(bit for words, bit in listed if word in words)


class Grammar:
    """The composed transducers over a lexicon: ``=word`` and ``^stem`` arcs with weights."""

    def __init__(self, arcs: Arcs) -> None:
        self.arcs = arcs
        self.anchors = ahocorasick.Automaton()
        for text in {a[1:] for a in arcs} | THREATS:
            self.anchors.add_word(text, len(text))
        self.anchors.make_automaton()
        self.listed = {word: word_class(word) for word in REPORTS | NEGATIONS | TARGETS | THREATS}

    def insult(self, word: str) -> float:
        """The best arc that accepts the word."""
        weight = self.arcs.get("=" + word, 0.0)
        for n in STEM:
            if n > len(word):
                break
            weight = max(weight, self.arcs.get("^" + word[:n], 0.0))
        return weight

    def clause(self, words: list[str]) -> tuple[float, float, float, int]:
        """Direct, aimed and muted weight and number of threats of one clause."""
        table = machine()
        following, marks, weights = table.next, table.marks, table.weights
        direct = aimed = muted = 0.0
        threats = row = 0
        for word in words:
            own = self.insult(word)
            at = row + (self.listed.get(word, 0) | (INSULT if own else 0))
            row = following[at]
            found = marks[at]
            if found & THREATENS:
                threats += 1
            if own:
                own *= weights[at]
                if found & MUTED:
                    muted += own
                if found & DIRECT:
                    direct += own
                if found & AIMED:
                    aimed += own
        return direct, aimed, muted, threats

    def figures(self, text: str) -> tuple[float, float, float, float, float]:
        """What the clauses of a text add up to."""
        low = text.lower()
        ends: list[int] | None = None
        seen: set[int] = set()
        direct = aimed = muted = best = 0.0
        threats = 0
        for end, length in self.anchors.iter(low):
            start = end - length + 1
            if start and low[start - 1].isalpha():
                continue
            if ends is None:
                ends = [m.start() for m in CLAUSE_END.finditer(low)]
            at = bisect_left(ends, start)
            if at in seen:
                continue
            seen.add(at)
            clause = low[ends[at - 1] + 1 if at else 0 : ends[at] if at < len(ends) else len(low)]
            d, a, m, t = self.clause(WORD.findall(clause))
            direct, aimed, muted, threats, best = direct + d, aimed + a, muted + m, threats + t, max(best, d)
        return math.log1p(direct), math.log1p(aimed), math.log1p(muted), best, math.log1p(threats)


_loaded: dict[int, Grammar] = {}


def grammar(arcs: Arcs) -> Grammar:
    key = hash(frozenset(arcs.items()))
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = Grammar(arcs)
    return _loaded[key]


def held_out(id_col: Column) -> Column:
    return F.coalesce(F.crc32(id_col.cast("string")) % 3 == 1, F.lit(False))


# --- learning -----------------------------------------------------------------------------------


def _items(text: str) -> set[str]:
    """All arcs that would accept a word of the text."""
    items = set()
    for word in set(WORD.findall(text.lower())):
        if len(word) >= STEM.start:
            items.add("=" + word)
            items.update("^" + word[:n] for n in STEM if n <= len(word))
    return items


def _sketch(text: str, seed: int) -> int:
    """The least hash of all runs of three words; equal for most near-copies."""
    words = text.lower().split()
    runs = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    return min(xxhash.xxh64_intdigest(r, seed) for r in runs) >> 1


def _counter(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Documents of either label in either half that have an item, counted within the task. The four counts of an
    item are one number, ``COUNT_BITS`` each."""
    names = ("clean_a", "clean_b", "toxic_a", "toxic_b")
    counts: dict[str, int] = defaultdict(int)

    def flush() -> pd.DataFrame:
        columns = {"item": list(counts)}
        for n, name in enumerate(names):
            shift, mask = COUNT_BITS * n, (1 << COUNT_BITS) - 1
            columns[name] = np.fromiter((c >> shift & mask for c in counts.values()), np.int64, len(counts))
        counts.clear()
        return pd.DataFrame(columns)

    for batch in batches:
        for text, toxic, half in zip(batch["text"], batch["toxic"], batch["half"], strict=True):
            one = 1 << COUNT_BITS * (2 * int(toxic) + int(half))
            for item in _items(text):
                counts[item] += one
            if len(counts) > FLUSH:
                yield flush()
    yield flush()


def labelled_rows(docs: DataFrame, labels: DataFrame, id_col: str, text: str, most: int) -> DataFrame:
    """``text, toxic, half``: at most ``most`` labelled rows that are not held out, copies once."""
    known = labels.filter(F.col("toxic").isin(0, 1) & ~held_out(F.col(id_col))).groupBy(id_col).agg(F.max("toxic").alias("toxic"))
    taken = known.orderBy(F.xxhash64(id_col), id_col).limit(most)
    rows = docs.select(id_col, F.coalesce(text, F.lit("")).alias("text")).join(
        F.broadcast(taken.withColumnRenamed(id_col, "_id")), F.col(id_col) == F.col("_id")
    )

    @F.pandas_udf("a long, b long")
    def sketches(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame({"a": [_sketch(t, 1) for t in texts], "b": [_sketch(t, 2) for t in texts]})

    half = F.pmod(F.xxhash64("text"), F.lit(2)).cast("int").alias("half")
    marked = rows.select("text", F.col("toxic").cast("int").alias("toxic"), half, sketches("text").alias("s"))
    once = marked.select("text", "toxic", "half", "s.*").dropDuplicates(["toxic", "a"]).dropDuplicates(["toxic", "b"])
    return once.select("text", "toxic", "half")


def learn_arcs(rows: DataFrame, most: int = ARCS) -> Arcs:
    """Arcs that mark toxic documents, with their log odds."""
    sizes = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    arcs = {"=" + w: weight for w, weight in INSULTS.items()}
    if not sizes.get(0) or not sizes.get(1):
        return arcs
    counted = rows.mapInPandas(_counter, "item string, clean_a long, clean_b long, toxic_a long, toxic_b long")
    total = counted.groupBy("item").agg(*[F.sum(n).alias(n) for n in ("clean_a", "clean_b", "toxic_a", "toxic_b")])
    n1, n0 = F.col("toxic_a") + F.col("toxic_b"), F.col("clean_a") + F.col("clean_b")
    share = sizes[1] / (sizes[0] + sizes[1])
    odds = F.log((n1 + 0.5) / (sizes[1] + 1)) - F.log((n0 + 0.5) / (sizes[0] + 1))
    seen = n1 + n0
    part = n1 / seen
    likelihood = 2 * (n1 * F.log(part / share) + F.when(n0 > 0, n0 * F.log((1 - part) / (1 - share))).otherwise(0.0))
    found = (
        total.filter("toxic_a > 0 and toxic_b > 0")
        .select("item", odds.alias("odds"), likelihood.alias("likelihood"), n1.alias("n"))
        .filter((F.col("odds") >= ODDS) & (F.col("likelihood") >= LIKELIHOOD))
        .orderBy(F.desc("likelihood"), "item")
        .limit(most)
        .collect()
    )
    return arcs | _pruned({r["item"]: (float(r["odds"]), r["n"]) for r in found})


def _pruned(found: dict[str, tuple[float, int]]) -> Arcs:
    """Keeps a stem only where many words share it: not if one word has most of its documents, nor if a
    longer stem has nearly all of them."""
    arcs = {}
    for item, (odds, n) in found.items():
        text = item[1:]
        inside = [(other, m) for other, (_, m) in found.items() if other != item and other[1:].startswith(text)]
        by_word = max((m for other, m in inside if other[0] == "="), default=0)
        by_stem = max((m for other, m in inside if other[0] == "^"), default=0)
        if item[0] == "=" or (by_word < ONE_WORD * n and by_stem < LONGER_STEM * n):
            arcs[item] = odds
    return arcs


def fit(figures: np.ndarray, toxic: np.ndarray, rounds: int = 50) -> tuple[float, ...]:
    """Logistic regression by Newton steps with a small ridge."""
    x = np.hstack([np.ones((len(figures), 1)), figures])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        ridge = np.full(len(w), 0.5)
        ridge[0] = 1e-3
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(ridge), x.T @ (toxic - p) - ridge * w)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(w.tolist())


def _figures_udf(arcs: Arcs):
    @F.pandas_udf(", ".join(f"{name} double" for name in FIGURES))
    def of(texts: pd.Series) -> pd.DataFrame:
        rules = grammar(arcs)
        return pd.DataFrame([rules.figures(t or "") for t in texts], columns=list(FIGURES))

    return of


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", most: int = LABELLED) -> tuple[Arcs, tuple[float, ...]]:
    """The lexicon and the curve."""
    rows = store(labelled_rows(docs, labels, id_col, text, most), "labelled")
    arcs = learn_arcs(rows)
    seen = rows.select("toxic", _figures_udf(arcs)("text").alias("f")).select("toxic", "f.*").toPandas()
    if seen["toxic"].nunique() < 2:
        return arcs, PRIOR
    return arcs, fit(seen[list(FIGURES)].to_numpy(), seen["toxic"].to_numpy())


def score(docs: DataFrame, model: tuple[Arcs, tuple[float, ...]], text: str = "text") -> DataFrame:
    """Add ``score``, the probability that the text is toxic."""
    arcs, (constant, *weights) = model
    total = F.lit(constant)
    for name, weight in zip(FIGURES, weights, strict=True):
        total = total + F.col(f"_f.{name}") * weight
    scored = docs.withColumn("_f", _figures_udf(arcs)(F.col(text)))
    return scored.withColumn("score", 1 / (1 + F.exp(-total))).drop("_f")


def classify(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """Per document: id, held_out, score, predicted."""
    scored = score(docs.select(id_col, text), learn(docs, labels, id_col, text), text)
    return scored.select(
        id_col, held_out(F.col(id_col)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )


def drop_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The documents that score below the threshold, as they are."""
    names = docs.columns
    kept = score(docs.select(F.struct(*names).alias("_row"), F.col(text).alias("_text")), learn(docs, labels, id_col, text), "_text")
    return kept.filter(F.col("score") < threshold).select("_row.*")
