"""Language-model scoring by a weighted backoff automaton.

Training counts words and pairs of words over all training documents. Every trained word is a state of the automaton;
a pair that was seen is an arc with its smoothed probability, and each state has a failure arc, weighted with what
smoothing leaves over, to the root, whose arcs are the smoothed single words:

    root arc      p(w)    = (c(w) + 0.1) / (N + 0.1 (V + 1))
    pair arc      p(w|h)  = (c(hw) + m p(w)) / (c(h) + m)         where c(hw) > 0
    failure arc   b(h)    = m / (c(h) + m), then p(w) at the root

These sum to 1 in each state. One left-to-right traversal carries the state and adds up log10 probabilities; the
end of a text is a token and leads to the state in which the next text begins. Null and empty texts are one end token.

The model grows with the corpus, so no task holds it. Documents are dealt into blocks; a block asks for the counts
of its distinct grams, sorted by hash and cut into equal ranges of the hash space (shards); a shard sums what all
blocks counted and answers each; the answers return to the block, whose documents are traversed there. A gram costs
one entry per block however often it occurs, so frequent words load no shard more than rare ones.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import on_workers, remainder
from martloom.llm.grams import Words, follow, mix, pack, planes, shard_ends, text_bytes, tokens, unpack, unplanes
from martloom.session import materialise

#: Bytes of text in a block, and bytes of text whose grams a shard sums.
BLOCK, SHARD = 8 << 20, 24 << 20
#: Weight of the root's probability in a state, in words.
PRIOR = 128.0
_END = b"\n"  # no word holds white space
_SINGLE, _PAIR = 0, 1


class _Stream:
    """The texts of a block as one sequence of tokens, an end after each, and the distinct grams of it."""

    def __init__(self, texts: list[str | None]):
        words = Words()
        words.add([_END])
        parts = [np.array([*words.add(tokens(t)), 0], np.int64) for t in texts]
        self.sizes = np.array([len(p) for p in parts], np.int64)
        self.ids = np.concatenate(parts) if parts else np.zeros(0, np.int64)
        self.state = np.concatenate([[0], self.ids[:-1]])[: len(self.ids)]
        hashes = words.hashes()
        keys = mix(hashes)
        order = np.argsort(keys, kind="stable")
        self.singles, place = keys[order], np.empty(len(keys), np.int64)
        place[order] = np.arange(len(keys))
        self.word = place[self.ids]
        self.context = place[self.state]
        self.pairs, self.pair = np.unique(mix(follow(hashes[self.state], hashes[self.ids])), return_inverse=True)


def _requests(table: pa.Table, shards: int) -> pa.Table:
    """Distinct grams of a block with their counts in its training documents, one row for each shard and kind."""
    block = table.column("block")[0].as_py()
    stream = _Stream(table.column("text").to_pylist())
    trained = np.repeat(table.column("trained").to_numpy(zero_copy_only=False).astype(np.float64), stream.sizes)
    rows = []
    for kind, keys, at in ((_SINGLE, stream.singles, stream.word), (_PAIR, stream.pairs, stream.pair)):
        counts = np.bincount(at, weights=trained, minlength=len(keys)).astype(np.uint32)
        start = 0
        for shard, end in enumerate(shard_ends(keys, shards)):
            if end > start:
                rows.append((shard, block, kind, pack(keys[start:end]), planes(counts[start:end])))
            start = end
    return pa.table([pa.array(c, t) for c, t in zip(zip(*rows), (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.binary()))], ["shard", "block", "kind", "keys", "counts"])


def _answers(table: pa.Table) -> pa.Table:
    """Totals of a shard's grams for each block that asked, and one row of the shard's own totals."""
    out, tokens_, words = [], 0, 0
    shard = table.column("shard")[0].as_py()
    kinds = table.column("kind").to_numpy()
    for kind in (_SINGLE, _PAIR):
        part = table.filter(pa.array(kinds == kind))
        if not part.num_rows:
            continue
        keys = [unpack(x.as_py()) for x in part.column("keys")]
        counts = np.concatenate([unplanes(x.as_py(), np.uint32) for x in part.column("counts")])
        found, at = np.unique(np.concatenate(keys), return_inverse=True)
        totals = np.bincount(at, weights=counts, minlength=len(found))
        if kind == _SINGLE:
            tokens_, words = int(totals.sum()), int(np.count_nonzero(totals))
        totals, start = totals[at].astype(np.uint64), 0
        for block, own in zip(part.column("block").to_pylist(), keys):
            out.append((shard, block, kind, planes(totals[start : start + len(own)]), 0, 0))
            start += len(own)
    out.append((shard, None, None, None, tokens_, words))
    names = ["shard", "block", "kind", "totals", "tokens", "words"]
    return pa.table([pa.array(c, t) for c, t in zip(zip(*out), (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64()))], names)


class Automaton:
    """The arcs that a block needs: counts of its words, contexts and pairs against the corpus."""

    def __init__(self, words: np.ndarray, pairs: np.ndarray, corpus: int, vocabulary: int, prior: float = PRIOR):
        self.words, self.pairs, self.prior = words, pairs, prior
        self.root = np.log10((words + 0.1) / (corpus + 0.1 * (vocabulary + 1)))
        self.failure = np.log10(prior / (words + prior))

    def walk(self, word: np.ndarray, context: np.ndarray, pair: np.ndarray) -> np.ndarray:
        """Log10 weight of each step: the pair's arc, or the failure arc of the state and the root's arc."""
        seen = self.pairs[pair]
        arc = np.log10((seen + self.prior * 10.0 ** self.root[word]) / (self.words[context] + self.prior))
        return np.where(seen > 0, arc, self.failure[context] + self.root[word])


def _score(docs: pa.Table, answers: pa.Table, corpus: int, vocabulary: int, prior: float) -> pa.Table:
    """Traverse the documents of a block with the arcs that the shards answered."""
    stream = _Stream(docs.column("text").to_pylist())
    answers = answers.sort_by("shard")
    kinds = answers.column("kind").to_numpy()
    totals = [np.concatenate([unplanes(x.as_py(), np.uint64) for x in answers.filter(pa.array(kinds == k)).column("totals")]).astype(np.float64) for k in (_SINGLE, _PAIR)]
    automaton = Automaton(totals[0], totals[1], corpus, vocabulary, prior)
    starts = np.concatenate([[0], np.cumsum(stream.sizes)[:-1]])
    steps = automaton.walk(stream.word, stream.context, stream.pair)
    trained = docs.column("trained").to_numpy(zero_copy_only=False)
    columns = {
        "key": docs.column("key"), "held_out": pa.array(~trained.astype(bool)), "n_tokens": pa.array(stream.sizes),
        "n_known": pa.array(np.add.reduceat((totals[0] > 0)[stream.word].astype(np.int64), starts)),
        "train_tokens": pa.array(np.full(len(stream.sizes), corpus, np.int64)),
        "base_score": pa.array(np.add.reduceat(automaton.root[stream.word], starts)), "score": pa.array(np.add.reduceat(steps, starts)),
    }
    return pa.table(list(columns.values()), list(columns))


def score(docs: DataFrame, trained, key: str = "doc_id", text: str = "text", prior: float = PRIOR) -> DataFrame:
    """(key, held_out, n_tokens, n_known, train_tokens, base_score, score): learn from the rows where ``trained`` is
    true, score every row. Without training rows all counts are 0 and every score is 0."""
    on_workers(docs.sparkSession)
    size = text_bytes(docs, text)
    blocks, shards = max(1, -(-size // BLOCK)), max(1, -(-size // SHARD))
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.coalesce(trained, F.lit(False)).alias("trained"))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("key", F.octet_length("text")), F.lit(blocks)).cast("long"))
    kind = docs.schema[key].dataType.simpleString()

    def ask(table: pa.Table) -> pa.Table:
        return _requests(table, shards)

    asked = rows.select("block", "text", "trained").groupBy("block").applyInArrow(ask, "shard int, block long, kind int, keys binary, counts binary")
    answers = materialise(asked.groupBy("shard").applyInArrow(_answers, "shard int, block long, kind int, totals binary, tokens long, words long"), "lm-answers")
    corpus, vocabulary = (int(x or 0) for x in answers.where("block is null").agg(F.sum("tokens"), F.sum("words")).first())

    def traverse(table: pa.Table, own: pa.Table) -> pa.Table:
        return _score(table, own, corpus, vocabulary, prior)

    own = answers.where("block is not null").select("block", "shard", "kind", "totals")
    schema = f"key {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.groupBy("block").cogroup(own.groupBy("block")).applyInArrow(traverse, schema).withColumnRenamed("key", key)


def held_out_scores(docs: DataFrame) -> DataFrame:
    """Scores of all documents, learning from all but fold 0 of ten."""
    return score(docs, remainder("doc_id", 10) != 0)
