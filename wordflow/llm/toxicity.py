"""Toxicity by a weighted finite-state grammar, scored by clause.

Words are sorted into classes: insults, threats, targets, negations, verbs of
saying. Transducers for negation, reported speech and target, composed into one
table, turn the classes of a clause into marked findings. Insults are words and
stems learned from labelled rows, each with the evidence that it carries; the weights of the findings start from the
grammar's own and are fitted to labels.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wordflow.llm.common import packed, unpacked, words_of, written
from wordflow.llm.grammar import (
    AIMED_LATER,
    END,
    INSULT,
    NEGATION,
    QUOTE,
    REPORT,
    SCOPE,
    TARGET,
    THREAT,
    WORD,
    clause_table,
    findings,
)

#: Labelled rows that the fit looks at, those with the least hash of their id.
MAX_LABELLED = 20_000
# A stem is the beginning of a word, a word is written with its end mark.
STEM_CHARS = range(4, 9)
WORD_END = "$"
# A form must be so much surer than chance, on a log scale beyond the number of forms looked at.
MIN_TOXIC = 4
SURENESS = 2.0
# Findings beyond this sum say nothing more.
ENOUGH = 20.0
# Insults of less evidence go through the same table, but their findings have own weights.
SURE = 4.0
WEAK = "weak"
WEAK_PART = 0.5
# Words of the stretches whose least hash tells copies of a sample from other texts.
COPY_WORDS = 5
PRIOR_STRENGTH = 0.02
# The fit ends when no direction that is left open has a steeper slope than this.
FLAT = 1e-5
STEPS = 500
THRESHOLD = 0.3
CACHE = 300_000
# No finding counts for less than this, per unit of evidence.
LEAST_WEIGHT = 0.0
RESULTS = ["score", "predicted", "n_clauses"]

# Words of the closed classes in English, German, French and Spanish.
CLOSED = {
    TARGET: "you your yours yourself u he she they them him her du dich dir dein deine ihr euch sie "
    "tu te toi ton ta vous votre ti usted ustedes vosotros él ella ellos ellas",
    NEGATION: "not no never neither nor without nicht kein keine keinen nie niemals "
    "ne pas jamais aucun sin nunca jamás ni tampoco",
    REPORT: "said says say wrote writes called calls quoted reported told claims claimed "
    "sagte sagt schrieb schreibt nannte dit disait écrit écrivait dijo dice escribió llamó",
    THREAT: "kill hurt destroy murder shoot stab strangle töten umbringen verletzen erschiessen "
    "tuer frapper détruire matar golpear destruir",
}
ENDS, QUOTES = ".!?;:\n", "\"“”„«»"
TOKENS = re.compile(rf"\w+|[{re.escape(ENDS + QUOTES)}]")


def _closed_words() -> dict[str, object]:
    words = {w: kind for kind, text in CLOSED.items() for w in text.split()}
    return words | dict.fromkeys(ENDS, END) | dict.fromkeys(QUOTES, QUOTE)


def outcomes(table: dict) -> dict[object, float]:
    """The grammar's findings, and those of weak insults, with weights before any label was seen."""
    found = findings(table)
    weak = {(WEAK, out): WEAK_PART * w for out, w in found.items() if out[:1] == INSULT or out == AIMED_LATER}
    return found | weak


@dataclass
class Toxicity:
    """What was learned: insults with their weights, and a weight per finding."""

    insults: dict[str, float]
    weights: np.ndarray = field(default_factory=lambda: np.array([*outcomes(clause_table()).values()]))
    offset: float = -3.0

    def prepare(self) -> Toxicity:
        """Builds the table of the grammar, for use in a task."""
        self.table = clause_table()
        self.places = {out: i for i, out in enumerate(outcomes(self.table))}
        self.lengths = sorted({len(s) for s in self.insults if not s.endswith(WORD_END)}, reverse=True)
        self.closed = _closed_words()
        self.seen: dict[str, tuple[object, float] | None] = {}
        return self

    def kind_of(self, word: str) -> tuple[object, float] | None:
        """The word's class and weight; None for other words."""
        weight = self.insults.get(word + WORD_END)
        if weight is None:
            stems = (self.insults.get(word[:n]) for n in self.lengths if len(word) >= n)
            weight = next((w for w in stems if w is not None), None)
        if weight is not None:
            return INSULT, weight
        kind = self.closed.get(word)
        return None if kind is None else (kind, 1.0)

    def features(self, text: str | None) -> tuple[np.ndarray, int]:
        """The summed weight of each finding, and the clauses with any."""
        sums = np.zeros(len(self.places))
        clauses, state, gap, hit, weight_before, weak_before = 0, 0, 0, False, 1.0, False
        seen, table = self.seen, self.table
        for token in TOKENS.findall(text.lower()) if text else ():
            if token in seen:
                found = seen[token]
            else:
                if len(seen) >= CACHE:
                    seen.clear()
                found = seen[token] = self.kind_of(token)
            if found is None:
                gap += 1
                continue
            for _ in range(min(gap, SCOPE)):
                state = table[WORD][state][0]
            gap = 0
            kind, weight = found
            weak = kind == INSULT and weight < SURE
            state, out, _ = table[kind][state]
            if out is not None:
                # A target behind an insult counts by the insult that it closes.
                if out == AIMED_LATER:
                    weight, weak = weight_before, weak_before
                sums[self.places[(WEAK, out) if weak else out]] += weight
                weight_before, weak_before = weight, weak
                hit = True
            if kind == END:
                clauses, hit = clauses + hit, False
        return sums, clauses + hit

    def score(self, text: str | None) -> tuple[float, int]:
        sums, clauses = self.features(text)
        logit = self.offset + float(_capped(sums) @ self.weights)
        return float(1 / (1 + np.exp(-np.clip(logit, -40, 40)))), clauses


def _capped(sums: np.ndarray) -> np.ndarray:
    return np.minimum(sums, ENOUGH)


def _forms(text: str | None) -> set[str]:
    """A text's words with their end mark, and their stems."""
    words = {w for w in TOKENS.findall(text.lower()) if len(w) > 2} if text else set()
    return {w + WORD_END for w in words} | {w[:n] for w in words for n in STEM_CHARS if len(w) >= n}


def _count_forms(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    counts: tuple[Counter, Counter] = Counter(), Counter()
    for frame in frames:
        for text, toxic in zip(frame["text"], frame["toxic"], strict=True):
            counts[int(toxic)].update(_forms(text))
    rows = [(form, n, counts[0][form]) for form, n in counts[1].items()]
    rows += [(form, 0, n) for form, n in counts[0].items() if form not in counts[1]]
    yield pd.DataFrame(rows, columns=["form", "toxic", "clean"])


def labelled_sample(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text_column: str = "text",
    label_column: str = "toxic", limit: int = MAX_LABELLED,
) -> DataFrame:
    """``text, toxic`` of ``limit`` labelled rows at most, by the least hashes of their ids; stored.

    Of near copies one is taken, so that what a text of many copies says by chance
    is not learned.
    """
    known = labels.select(
        F.col(f"`{id_column}`").alias("id"), F.col(f"`{label_column}`").cast("int").alias("toxic")
    ).dropna()
    chosen = known.groupBy("id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("id"), "id").limit(limit)
    texts = docs.select(F.col(f"`{id_column}`").alias("id"), F.col(f"`{text_column}`").alias("text"))
    # The right side has ``limit`` rows of two numbers at most.
    found = texts.join(F.broadcast(chosen), "id").withColumn("copy", _copy_key(F.col("text")))
    return written(found.dropDuplicates(["copy", "toxic"]).select("text", "toxic"), "labelled")


def _copy_key(text: Column) -> Column:
    """The least hash of the text's stretches of words: mostly the same for near copies."""

    @F.pandas_udf("bigint")
    def of(texts: pd.Series) -> pd.Series:
        keys = []
        for t in texts:
            words = words_of(t)
            # A shorter text is one stretch.
            size = min(COPY_WORDS, len(words))
            runs = map(b" ".join, zip(*(words[i:] for i in range(size)), strict=False))
            keys.append(min(map(xxhash.xxh64_intdigest, runs), default=0) >> 1)
        return pd.Series(keys, dtype="int64")

    return of(text)


def objective(rows: np.ndarray, toxic: np.ndarray, weights: np.ndarray, mean: np.ndarray, strength: np.ndarray) -> float:
    """What the fit makes small: the log loss and the distance from the grammar's own weights."""
    logits = rows @ weights
    loss = np.logaddexp(0, logits) - toxic * logits
    return float(loss.sum() + 0.5 * (strength * (weights - mean) ** 2).sum())


def fit_weights(found: np.ndarray, toxic: np.ndarray, prior: np.ndarray) -> tuple[np.ndarray, float, list[float]]:
    """Weights of the findings, none under ``LEAST_WEIGHT``, the offset, and the objective after each step.

    Logistic regression drawn towards the grammar's own weights, by Newton steps in
    the weights that are not held at the bound. A step is halved until the
    objective falls by a share of what its slope promises, so it never rises.
    """
    rows = np.hstack([_capped(found), np.ones((len(found), 1))])
    mean = np.append(prior, -3.0)
    strength = np.append(np.full(len(prior), PRIOR_STRENGTH * 20), PRIOR_STRENGTH)
    least = np.append(np.full(len(prior), LEAST_WEIGHT), -np.inf)
    weights = np.maximum(mean, least)
    values = [objective(rows, toxic, weights, mean, strength)]
    for _ in range(STEPS):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -500, 500)))
        slope = rows.T @ (p - toxic) + strength * (weights - mean)
        free = (weights > least) | (slope < 0)
        if np.abs(slope[free]).max(initial=0) < FLAT:
            break
        curve = (rows * (p * (1 - p))[:, None]).T @ rows + np.diag(strength)
        step = np.zeros(len(weights))
        step[free] = -np.linalg.solve(curve[np.ix_(free, free)], slope[free])
        share = 1.0
        while True:
            tried = np.maximum(weights + share * step, least)
            value = objective(rows, toxic, tried, mean, strength)
            if value <= values[-1] + 1e-4 * slope @ (tried - weights) or share < 1e-12:
                break
            share /= 2
        if value >= values[-1]:
            break
        weights, values = tried, [*values, value]
    return weights[:-1], float(weights[-1]), values


def fit_toxicity(sample: DataFrame) -> Toxicity:
    """Learns insults and weights from ``text, toxic`` rows, which are few (``labelled_sample``).

    Without any toxic row the model has no insults and the grammar's own weights.
    """
    sizes = {bool(t): n for t, n in sample.groupBy("toxic").count().collect()}
    toxic_rows, clean_rows = sizes.get(True, 0), sizes.get(False, 0)
    if not toxic_rows:
        return Toxicity({})
    counted = sample.mapInPandas(_count_forms, "form string, toxic bigint, clean bigint")
    counts = written(
        counted.groupBy("form")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .filter(F.col("toxic") + F.col("clean") >= MIN_TOXIC),
        "forms",
    )
    a, n, base = F.col("toxic"), F.col("toxic") + F.col("clean"), toxic_rows / (toxic_rows + clean_rows)
    # How far the share of toxic samples is from that of all samples, in nats over all its samples.
    unlike = a * F.log(a / (n * base)) + F.when(
        F.col("clean") > 0, F.col("clean") * F.log(F.col("clean") / (n * (1 - base)))
    ).otherwise(0.0)
    odds = F.log((a + 0.5) / (toxic_rows + 1) / ((F.col("clean") + 0.5) / (clean_rows + 1)))
    best = (
        counts.filter(a > 0)
        .select("form", unlike.alias("sure"), odds.alias("odds"))
        .filter((F.col("sure") >= SURENESS + np.log(max(1, counts.count()))) & (F.col("odds") > 0))
        # Each stands in some toxic rows of the sample, whose size is bounded.
        .collect()
    )
    model = Toxicity({r["form"]: float(r["odds"]) for r in best})

    def measure(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = Toxicity(model.insults).prepare()
        for frame in frames:
            found = [own.features(t)[0].tolist() for t in frame["text"]]
            yield pd.DataFrame({"toxic": frame["toxic"], "found": found})

    rows = sample.mapInPandas(measure, "toxic int, found array<double>").collect()
    found = np.array([r["found"] for r in rows])
    weights, offset, _ = fit_weights(found, np.array([float(bool(r["toxic"])) for r in rows]), model.weights)
    return Toxicity(model.insults, weights, offset)


def held_out(id_column: Column) -> Column:
    """Rows that labels are never learned from: a quarter, by a checksum of the id."""
    return F.coalesce(F.crc32(id_column.cast("string")) % 4 == 2, F.lit(False))


def toxicity_scores(
    docs: DataFrame, model: Toxicity, text_column: str = "text", carry: DataFrame | None = None,
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The rows with ``score`` (0 to 1), ``predicted`` (0 or 1) and ``n_clauses``, those with a finding.

    Only the text is looked at. Null and empty texts have no finding and the
    lowest score. Repeated rows are scored alike. ``carry`` (a selection of
    ``docs``) says which columns come back, those named like results replaced. An
    empty table stays empty.
    """
    carried = docs if carry is None else carry
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("score double, n_clauses int")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        learned = shared.value
        own = Toxicity(learned.insults, learned.weights, learned.offset).prepare()
        for texts in batches:
            yield pd.DataFrame([own.score(t) for t in texts], columns=["score", "n_clauses"])

    made = docs.select(packed(carried), scored(F.col(f"`{text_column}`")).alias("made"))
    return made.select(
        "row",
        "made.score",
        (F.col("made.score") >= threshold).cast("int").alias("predicted"),
        "made.n_clauses",
    ).select(unpacked(carried.columns, RESULTS))
