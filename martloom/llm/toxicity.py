"""Toxicity by a weighted finite-state pattern grammar.

Three small transducers are composed over the words of each clause. The first rewrites words to weighted classes
(insult, threat, target, negation, reported speech) by whole words and by word beginnings. The second carries negation
for a few words and reported speech to the end of the clause, over a colon into the next clause and through a quotation
that begins there to its end, and scales what it passes. The third emits a match for an
insult or a threat, stronger with a target in the clause; a threat without one hardly counts. A document's clause
matches give a few totals, and a logistic model turns them into a score.

Which words are insults is learned from labelled documents: a bounded sample (SAMPLE rows, near copies merged) gives
candidate words and beginnings, a greedy cover picks those that mark toxic documents and no others, and the
logistic model is fitted on the same sample. Only that sample's counts and feature rows reach the driver.
Language, source, id and labels are not inputs of a score. Null and empty texts score as texts without matches.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import map_texts, numbered, remainder, slices
from martloom.session import materialise

#: Labelled rows that the classifier is fitted on at most, and candidate patterns considered.
SAMPLE, CANDIDATES = 12_000, 3_000
#: Lengths of word beginnings that may become a pattern.
STEMS = (4, 5, 6, 7, 8)
#: Least toxic documents with a pattern, least share of toxic ones among its documents, least gain in the cover.
SUPPORT, PURITY, GAIN = 4, 0.6, 2.0
THRESHOLD = 0.3

# Seed classes in English, German, French and Spanish; insults are learned besides these.
INSULTS = ("idiot moron loser scum stupid pathetic worthless disgusting trash imbecile vollidiot dummkopf abschaum "
           "versager crétin abruti ordure minable imbécil estúpido basura escoria").split()
THREATS = "kill hurt destroy murder stab umbringen töten vernichten tuer détruire frapper matar destruir golpear".split()
TARGETS = "you your he she they them du dich dir ihr euch sie tu toi te vous ils elles usted tú ti ellos ellas vosotros".split()
NEGATIONS = "not never no nobody nicht kein keine keinen nie pas jamais aucun nunca jamás ningún ninguna".split()
REPORTS = "said says say wrote quoted called reported sagte schrieb zitierte dit écrit cité dijo escribió citó".split()

_WORD = re.compile(r"\w+")
_TOKEN = re.compile(r"\w+|[.!?;:\n\"“”„«»]+")
_QUOTES = frozenset("\"“”„«»")
INSULT, THREAT, TARGET, NEGATION, REPORT = range(1, 6)
#: Words that a negation reaches, and what is left of a match that is negated or reported.
REACH, NEGATED, REPORTED = 3, 0.4, 0.5
#: Weight of a seed insult, and factors of a match by whether the clause has a target.
SEED_WEIGHT, WITH_TARGET, THREAT_ALONE = 2.0, 1.5, 0.2


@dataclass
class Grammar:
    """The composed transducers: word classes with weights, by whole word and by beginning."""

    words: dict[str, tuple[int, float]] = field(default_factory=dict)
    stems: dict[str, tuple[int, float]] = field(default_factory=dict)

    def __post_init__(self):
        for names, kind, weight in ((THREATS, THREAT, 2.0), (TARGETS, TARGET, 0.0), (NEGATIONS, NEGATION, 0.0), (REPORTS, REPORT, 0.0), (INSULTS, INSULT, SEED_WEIGHT)):
            for name in names:
                self.words.setdefault(name, (kind, weight))
        self._known: dict[str, tuple[int, float]] = {}

    def classify(self, word: str) -> tuple[int, float]:
        """Lexical transducer: class and weight of a lower-case word; (0, 0) passes unmarked."""
        found = self._known.get(word)
        if found is None:
            found = self.words.get(word)
            for n in STEMS if found is None or found[0] == INSULT else ():
                stem = self.stems.get(word[:n]) if len(word) >= n else None
                if stem and (found is None or stem[1] > found[1]):
                    found = stem
            if len(self._known) > 300_000:
                self._known.clear()
            found = self._known[word] = found or (0, 0.0)
        return found

    def clause(self, classes: list[tuple[int, float]], reported: bool = False) -> tuple[float, float, float]:
        """(insult score, threat score, weight taken away by negation and report) of one clause, which may begin in reported speech."""
        aimed = any(kind == TARGET for kind, _ in classes)
        negation = 0  # with ``reported``, the state of the context transducer
        insult = threat = lost = 0.0
        for kind, weight in classes:
            if kind == NEGATION:
                negation = REACH + 1
            elif kind == REPORT:
                reported = True
            elif kind in (INSULT, THREAT):
                scale = (NEGATED if negation else 1.0) * (REPORTED if reported else 1.0)
                lost += weight * (1 - scale)
                if kind == INSULT:
                    insult += weight * scale * (WITH_TARGET if aimed else 1.0)
                else:
                    threat += weight * scale * (1.0 if aimed else THREAT_ALONE)
            negation = max(0, negation - 1)
        return insult, threat, lost

    def clauses(self, text: str) -> list[tuple[list[tuple[int, float]], bool]]:
        """The classified clauses of a text, and whether each begins in reported speech."""
        found: list[tuple[list[tuple[int, float]], bool]] = [([], False)]
        quoted = False  # inside a quotation that a report introduced
        for token in _TOKEN.findall(text.lower()):
            if token[0] not in ".!?;:\n\"“”„«»":
                found[-1][0].append(self.classify(token))
                continue
            classes, reported = found[-1]
            said = any(kind == REPORT for kind, _ in classes)
            quotes = not _QUOTES.isdisjoint(token)
            if quotes:
                quoted = not quoted and (said or (reported and not classes))
                if token in _QUOTES and not (said or reported):
                    continue  # a quoted word or two inside a clause
            carried = quoted or (said and token[0] == ":") or (reported and not classes)
            found.append(([], carried))
        return found

    def features(self, text: str | None) -> list[float]:
        """Totals over the clauses of a text, with a leading 1; null text has no clause."""
        words = _WORD.findall(text.lower()) if text else []
        different = sum(self.classify(w)[0] in (INSULT, THREAT) for w in set(words))
        if not different:
            return [1.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0, 0.0]
        scores = [self.clause(c, reported) for c, reported in self.clauses(text) if any(k in (INSULT, THREAT) for k, _ in c)]
        insult, threat, lost = (sum(s[i] for s in scores) for i in range(3))
        return [
            1.0, math.log1p(insult), max(s[0] + s[1] for s in scores), math.log1p(len(scores)),
            math.log1p(1000 * insult / len(words)), math.log1p(threat), math.log1p(lost),
            math.log1p(different - 1),
        ]


#: Weights in force when there is nothing to learn from.
_DEFAULT = np.array([-3.0, 1.5, 0.3, 0.0, 0.0, 0.5, -0.5, 0.5])


@dataclass
class Model:
    grammar: Grammar
    weights: np.ndarray

    def score(self, text: str | None) -> float:
        z = float(self.weights @ np.array(self.grammar.features(text)))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def _patterns(text: str | None) -> set[str]:
    """Candidate patterns of a text: whole words as ``=word``, beginnings as they are."""
    words = set(_WORD.findall(text.lower())) if text else set()
    return {f"={w}" for w in words if len(w) >= 3} | {w[:n] for w in words for n in STEMS if len(w) >= n}


def _signature(text: str | None) -> int:
    """Least hash of the three-word runs of a text: near copies mostly share it, and texts that differ do not."""
    words = _WORD.findall(text.lower()) if text else []
    return min((zlib.crc32(" ".join(words[i : i + 3]).encode()) for i in range(max(1, len(words) - 2))), default=0)


def _fit_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(label, text): the bounded sample of labelled documents, near copies of a label merged."""
    known = labels.where("doc_id is not null and toxic is not null").where(remainder("doc_id", 4) != 2)
    known = known.groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("label"))
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE)
    # Of the rows of one id, and of near copies, the text of the least hash: the same in every run, and no more rows than ids.
    least = F.min_by("text", F.struct(F.xxhash64("text"), F.col("text"))).alias("text")
    rows = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").groupBy("doc_id", "label").agg(least).select("label", "text")

    def make():
        return lambda c: {"label": c["label"], "text": c["text"], "signature": [_signature(t) for t in c["text"]]}

    signed = map_texts(rows, "text", "label int, text string, signature long", make)
    return materialise(signed.groupBy("label", "signature").agg(least).select("label", "text"), "toxicity-sample")


def _candidates(rows: DataFrame) -> list[tuple[str, int, int]]:
    """The most frequent patterns that are pure enough: (pattern, toxic documents, other documents)."""

    def run(batches):
        import pyarrow as pa

        counts = (Counter(), Counter())
        for batch in batches:
            for label, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                counts[label].update(_patterns(text))
        for label in (0, 1):
            keys = list(counts[label])
            for i in range(0, len(keys), 50_000):
                part = keys[i : i + 50_000]
                yield pa.RecordBatch.from_arrays([pa.array(part), pa.array([label] * len(part), pa.int32()), pa.array([counts[label][k] for k in part], pa.int64())], ["pattern", "label", "n"])

    n1, n0 = F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)), F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0))
    found = rows.mapInArrow(run, "pattern string, label int, n long").groupBy("pattern").agg(n1.alias("n1"), n0.alias("n0"))
    found = found.where((F.col("n1") >= SUPPORT) & (F.col("n1") >= PURITY * (F.col("n1") + F.col("n0"))))
    return [tuple(r) for r in found.orderBy(F.desc("n1"), "pattern").limit(CANDIDATES).collect()]


def _cover(marks: list[list[int]], labels: np.ndarray, names: list[str]) -> list[int]:
    """Greedy cover: each picked pattern halves what its toxic documents still offer; others' documents cost one each."""
    rows = [[] for _ in names]
    for doc, found in enumerate(marks):
        for i in found:
            rows[i].append(doc)
    rows = [np.array(r, np.int64) for r in rows]
    offer, cost = np.where(labels == 1, 1.0, -1.0), 0.5
    picked: list[int] = []
    left = set(range(len(names)))
    while left:
        gains = {i: float(offer[rows[i]].sum()) for i in left}
        left = {i for i in left if gains[i] >= GAIN}
        if not left:
            break
        best = max(left, key=lambda i: (round(gains[i], 6), not names[i].startswith("="), len(names[i]), names[i]))
        picked.append(best)
        left.discard(best)
        inside = rows[best]
        offer[inside] = np.where(offer[inside] > 0, offer[inside] * cost, offer[inside])
    return picked


def _logistic(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Ridge logistic regression by Newton steps."""
    w, ridge = np.zeros(x.shape[1]), np.diag([1e-3] + [0.3] * (x.shape[1] - 1))
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + ridge, x.T @ (y - p) - ridge @ w)
        w = w + np.clip(step, -3, 3)
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Grammar and weights from labelled documents outside fold 2 of 4."""
    spark = docs.sparkSession
    rows = _fit_rows(docs, labels)
    found = _candidates(rows)
    names = [f[0] for f in found]
    place = spark.sparkContext.broadcast({n: i for i, n in enumerate(names)})

    def marks():
        known = place.value
        return lambda c: {"label": c["label"], "marks": [sorted(known[p] for p in _patterns(t) if p in known) for t in c["text"]]}

    grammar = Grammar()
    if names:
        seen = map_texts(rows, "text", "label int, marks array<int>", marks).collect()  # at most SAMPLE rows
        y = np.array([r[0] for r in seen])
        toxic, clean = max(1, int((y == 1).sum())), max(1, int((y == 0).sum()))
        for i in _cover([r[1] for r in seen], y, names):
            name, n1, n0 = found[i]
            weight = min(6.0, max(1.0, math.log((n1 + 0.5) / toxic) - math.log((n0 + 0.5) / clean)))
            if name.startswith("="):
                grammar.words[name[1:]] = (INSULT, weight)
            else:
                grammar.stems[name] = (INSULT, weight)
    sent = spark.sparkContext.broadcast(grammar)

    def measure():
        g = sent.value
        return lambda c: {"label": c["label"], "x": [g.features(t) for t in c["text"]]}

    fit = sorted(map_texts(rows, "text", "label int, x array<double>", measure).collect())  # at most SAMPLE rows
    y = np.array([r[0] for r in fit], float)
    if len(fit) == 0 or y.min() == y.max():
        return Model(grammar, _DEFAULT)
    return Model(grammar, _logistic(np.array([r[1] for r in fit]), y))


def score(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, score) of every row's whole text; one pass, no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = sent.value
        return lambda c: {"key": c["key"], "score": [m.score(t) for t in c["text"]]}

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return map_texts(rows, "text", f"key {kind}, score double", make).withColumnRenamed("key", key)


def judge(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted): learn outside fold 2 of 4, score every row."""
    scored = score(docs, train(docs, labels))
    return scored.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def reject(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not predicted toxic, all columns kept; the score decides row by row."""
    sent = docs.sparkSession.sparkContext.broadcast(train(docs, labels))
    rows, text = numbered(docs), docs.columns.index("text")

    def run(batches):
        import pyarrow as pa

        m = sent.value
        for batch in batches:
            for part in slices(batch, f"c{text}"):
                yield part.filter(pa.array([m.score(t) < THRESHOLD for t in part.column(text).to_pylist()], pa.bool_()))

    return rows.mapInArrow(run, rows.schema).toDF(*docs.columns)
