"""Language identification as a mixture: each document's language proportions are estimated by expectation-
maximisation from n-gram likelihoods, and its set of languages is chosen by penalised likelihood.

The n-grams are three bytes of the lower-cased text, hashed to a fixed number of cells. Counts by language are summed over
all labelled documents in use; the table of languages x cells is all that reaches the driver. Rows without a
language are not learned from. Text that is null or has no letter is ``und`` with score 0, and so is all text when
nothing was learned.
"""

from __future__ import annotations

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import map_texts, remainder

#: Cells of hashed n-grams, rounds of EM, and the likelihood that another language must add, in nats per log(n-grams).
CELLS, ROUNDS, PENALTY = 1 << 15, 10, 8.0
_LETTER = regex.compile(r"\p{L}")


def _cells(text: str) -> np.ndarray:
    """Cell of each n-gram of a text; the ends count as spaces."""
    raw = np.frombuffer(b" " + text.lower().encode() + b" ", np.uint8).astype(np.uint32)
    code = raw[:-2] << 16 | raw[1:-1] << 8 | raw[2:]
    return (code * np.uint32(2654435761) >> np.uint32(17)).astype(np.int64)


def train(docs: DataFrame, text: str = "text", lang: str = "lang") -> tuple[list[str], np.ndarray]:
    """(languages in order, log probabilities cells x languages) from all rows given."""

    def run(batches):
        import pyarrow as pa

        counts: dict[str, np.ndarray] = {}
        for batch in batches:
            for t, name in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if t and name is not None and _LETTER.search(t):
                    counts.setdefault(name, np.zeros(CELLS, np.int64))
                    counts[name] += np.bincount(_cells(t), minlength=CELLS)
        for name, n in counts.items():
            cells = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(cells), pa.string()), pa.array(cells.astype(np.int32)), pa.array(n[cells])], ["lang", "cell", "n"])

    rows = docs.select(F.col(text), F.col(lang)).mapInArrow(run, "lang string, cell int, n long")
    found = rows.groupBy("lang", "cell").agg(F.sum("n").alias("n")).collect()  # at most languages x CELLS rows
    names = sorted({r[0] for r in found})
    counts = np.full((CELLS, len(names)), 0.5)
    place = {name: i for i, name in enumerate(names)}
    for name, cell, n in found:
        counts[cell, place[name]] += n
    return names, np.log(counts / counts.sum(axis=0)) if names else counts


def _mixtures(chances: np.ndarray, weight: np.ndarray, starts: np.ndarray, doc: np.ndarray, allowed: np.ndarray):
    """EM over many documents at once: (proportions, log-likelihoods, bounds on the likelihood of any proportions of all
    languages). ``allowed``: languages of each document."""
    share = allowed / allowed.sum(axis=1, keepdims=True)
    total = np.add.reduceat(weight, starts)[:, None]
    for _ in range(ROUNDS):
        part = chances * share[doc]
        part *= (weight / np.maximum(part.sum(axis=1), 1e-300))[:, None]
        share = np.add.reduceat(part, starts) / total
    mixed = np.maximum((chances * share[doc]).sum(axis=1), 1e-300)
    like = np.add.reduceat(weight * np.log(mixed), starts)
    # The likelihood is concave in the proportions: no others exceed this one by more than its steepest slope less the n-grams.
    slopes = np.add.reduceat(chances * (weight / mixed)[:, None], starts)
    return share, like, like + np.maximum(slopes.max(axis=1) - total[:, 0], 0)


def infer(texts: list[str], logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the chosen language set, texts x languages, and which were chosen. Texts have letters."""
    cells = [np.unique(_cells(t), return_counts=True) for t in texts]
    sizes = np.array([len(u) for u, _ in cells])
    starts, doc = np.concatenate([[0], np.cumsum(sizes)[:-1]]), np.repeat(np.arange(len(texts)), sizes)
    weight = np.concatenate([n for _, n in cells]).astype(float)
    rows = logs[np.concatenate([u for u, _ in cells])]
    alone = np.add.reduceat(rows * weight[:, None], starts)  # one language explains everything
    shift = rows.max(axis=1, keepdims=True)
    chances, base = np.exp(rows - shift), np.add.reduceat(weight * shift[:, 0], starts)
    k, cost = logs.shape[1], PENALTY * np.log(np.add.reduceat(weight, starts) + 1)
    best, chosen = alone.max(axis=1), np.zeros((len(texts), k))
    chosen[np.arange(len(texts)), alone.argmax(axis=1)] = 1
    result = chosen.copy()
    if k > 1:
        share, _, most = _mixtures(chances, weight, starts, doc, np.ones((len(texts), k)))
        order = np.argsort(-share, axis=1)
        open_ = np.flatnonzero(most + base - cost > best)  # no set of two or more can gain more than this
        score = best.copy()
        if len(open_):
            keep = np.isin(doc, open_)
            new = np.cumsum(np.isin(np.arange(len(texts)), open_)) - 1
            sub_doc = new[doc[keep]]
            sub_starts = np.concatenate([[0], np.cumsum(sizes[open_])[:-1]])
            for m in range(2, k + 1):
                allowed = np.zeros((len(open_), k))
                np.put_along_axis(allowed, order[open_, :m], 1, axis=1)
                share_m, like, _ = _mixtures(chances[keep], weight[keep], sub_starts, sub_doc, allowed)
                value = like + base[open_] - (m - 1) * cost[open_]
                better = value > score[open_]
                rows_ = open_[better]
                score[rows_], result[rows_], chosen[rows_] = value[better], share_m[better], allowed[better]
    return result, chosen


def predict(docs: DataFrame, model: tuple[list[str], np.ndarray], key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, lang_pred, score, proportions map<string,double>): the leading language, its proportion, and the chosen set."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        names, logs = sent.value

        def step(c):
            out = {"key": c["key"], "lang_pred": ["und"] * len(c["key"]), "score": [0.0] * len(c["key"]), "proportions": [[] for _ in c["key"]]}
            rows = [i for i, t in enumerate(c["text"]) if t and names and _LETTER.search(t)]
            for at in range(0, len(rows), 256):
                part = rows[at : at + 256]
                share, chosen = infer([c["text"][i] for i in part], logs)
                for i, p, used in zip(part, share, chosen):
                    top = int(p.argmax())
                    out["lang_pred"][i], out["score"][i] = names[top], min(1.0, float(p[top]))
                    out["proportions"][i] = [(names[j], float(p[j])) for j in np.flatnonzero(used)]
            return out

        return step

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {kind}, lang_pred string, score double, proportions map<string,double>"
    return map_texts(rows, "text", schema, make).withColumnRenamed("key", key)


def identify(docs: DataFrame) -> DataFrame:
    """Learn from folds 0, 1 and 3 of four, predict all: (doc_id, held_out, lang_pred, score, proportions)."""
    fold = remainder("doc_id", 4)
    model = train(docs.where(fold != 2))
    return predict(docs, model).select("doc_id", (fold == 2).alias("held_out"), "lang_pred", "score", "proportions")
