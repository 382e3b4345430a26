"""Secret scan: fixed patterns, and a ratio of two character Markov models for strings that no pattern names.

The models are first-order chains over characters: one of random strings, trained from what the patterns found (label
1), one of ordinary text, trained from all other runs of these characters, words of any length included (label 0).
Transition counts are summed over all documents; only the two count tables, of fixed size, reach the driver. Every run of
SHORTEST characters outside the pattern spans becomes a span of kind ``markov`` when its mean log-likelihood ratio per
character passes the threshold, whatever characters it has. Of a run that a hex or access span covers in part the rest
is judged: looks it random as a whole, the run is a span, else each piece of it that does. Offsets are code points, end
exclusive. Null and empty texts have no spans.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import map_texts, numbered

KINDS = ("assign", "access", "hex", "markov")
_ASSIGN = re.compile(r"(?ai:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")
_NAMES = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]+")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Shortest run that the models judge, and the ratio per character from which it is a secret.
SHORTEST, THRESHOLD = 16, 0.1
_RUN = re.compile(r"[A-Za-z0-9+/_=-]{%d,}" % SHORTEST)
_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."
_CODE = np.zeros(128, np.uint8)
for _i, _c in enumerate(_LETTERS):
    _CODE[ord(_c)] = _i + 1
#: States: the start, and each letter.
STATES = len(_LETTERS) + 1
#: Characters counted at once.
_CHUNK = 1 << 18

# Seeds: labelled samples that are there before any corpus is read, so an empty corpus has models too.
_RANDOM = [hashlib.sha256(b"seed %d" % i).hexdigest() for i in range(100)] + [
    "".join(_LETTERS[b % 64] for b in hashlib.sha512(b"seed %d" % i).digest()) for i in range(1000)]
_ORDINARY = (
    "internationalization configuration_manager get_user_by_identifier application-settings DocumentBuilderFactory "
    "com/example/project/service/UserController representation responsibilities straightforwardness src/main/resources "
    "max_partition_bytes shuffle-partitions-default mail-server-example https-www-example transactionManagerBean "
    "Verantwortungsbewusstsein Geschwindigkeitsbegrenzung anticonstitutionnellement desafortunadamente 2024-01-31-release "
    "characteristically misunderstandings counterrevolutionary telecommunications disproportionately interdisciplinary "
    "Wahrscheinlichkeitsrechnung Donaudampfschifffahrtsgesellschaft Krankenversicherungskarte Arbeitsunfaehigkeitsbescheinigung "
    "gouvernementalisation professionnellement extraordinairement responsabilidades internacionalmente caracteristicas "
    "AbstractSingletonProxyFactoryBean getElementsByClassName addEventListener shouldComponentUpdate UnsupportedOperationException "
    "MAXIMUM_CONNECTION_TIMEOUT ENVIRONMENT_VARIABLE_NAME INTERNATIONALIZATION user_account_settings_page "
    "0000000000000000 1234567890123456 ================ ---------------- ________________ ++++++++++++++++"
).split()
# Words of prose, many more times than here in any corpus.
_ORDINARY += (
    "Rechtsschutzversicherung Bundesverfassungsgericht Geschwindigkeitsmessung Nahrungsmittelunvertraeglichkeit Freundschaftsbeziehungen "
    "Aufenthaltsgenehmigung Sehenswuerdigkeiten Unabhaengigkeitserklaerung Lebensversicherungsgesellschaft Wettbewerbsfaehigkeit "
    "Grundstuecksverkehr Strassenbahnhaltestelle Entwicklungszusammenarbeit Kraftfahrzeughaftpflicht Begrenzungen Zwischenpruefung "
    "Steuererklaerung Schmetterling Fussballweltmeisterschaft Rindfleisch Bezirksschornsteinfegermeister Gesundheitsministerium "
    "developpement gouvernement particulierement environnement reconnaissance etablissement malheureusement bouleversement "
    "approximativement caracteristiques administration responsabilite quotidiennement enseignement heureusement questionnaire "
    "desarrollo conocimiento aproximadamente establecimiento universidades trabajadores acontecimientos desafortunadamente "
    "precipitevolissimevolmente riconoscimento straordinariamente amministrazione comportamento sviluppo cittadinanza "
    "verantwoordelijkheid arbeidsongeschiktheid ziektekostenverzekering gemeenschappelijk samenwerkingsverband wereldkampioenschap "
    "desenvolvimento conhecimento aproximadamente relacionamento odpowiedzialnosc przedsiebiorstwo niepodleglosc rzeczpospolita "
    "electroencephalography pseudopseudohypoparathyroidism parliamentarianism incomprehensibilities thermodynamically "
    "photosynthesis psychophysiological hydrochlorofluorocarbon knowledgeable throughout nevertheless acknowledgement breakthrough "
    "the quick brown fox jumps over lazy dog while every young child would have known about their work which began before "
    "people through great world another between because should under never around together without something against children"
).split()
_ORDINARY *= 20
# Words that identifiers are made of, joined in all usual ways, and plain numbers.
_PARTS = (
    "get set user name file path email address config value type index list map string number data table column query key "
    "build test main source target event service client server request response error handler manager factory provider "
    "by from to with for is has on all max min default size count time date start end update create delete insert select "
    "internal public private abstract base object item page view model control message queue cache buffer stream channel "
    "https www com org net example mail"
).split()
for _i, _a in enumerate(_PARTS):
    for _j in range(1, len(_PARTS), 4):
        _b, _c = _PARTS[(_i + _j) % len(_PARTS)], _PARTS[(_i * 7 + _j * 3) % len(_PARTS)]
        _ORDINARY += [_a + _b.title() + _c.title(), "_".join((_a, _b, _c)), "-".join((_a, _b, _c)), "/".join((_a, _b, _c)), "_".join((_a, _b, _c)).upper()]
_ORDINARY += [str(int(hashlib.sha256(b"number %d" % _i).hexdigest(), 16))[:20] for _i in range(400)]
_ORDINARY += [_sign * 1000 for _sign in "-=_+/"]
#: Least share of the seeds in the ordinary chain, and the transitions of a letter below which they have more.
SEED_SHARE, SEED_WEIGHT = 0.2, 1000


def pattern_spans(text: str | None) -> list[tuple[int, int, int]]:
    """(start, kind number, end) of the fixed patterns, by start, then kind."""
    if not text:
        return []
    out = []
    low = text.lower()
    if any(name in low for name in _NAMES):
        out += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end() - m.start(2) >= 6]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(out)


def other_runs(text: str | None, taken: list[tuple[int, int, int]]) -> list[tuple[int, int, list[tuple[int, int]]]]:
    """Runs of identifier characters not wholly in pattern spans: (start, end, the pieces outside).

    An assignment ends a run, as its name is no part of the string before it; the other patterns' spans are parts of the run.
    """
    if not text:
        return []
    out, starts, ends = [], [s for s, _, _ in taken], np.maximum.accumulate([e for _, _, e in taken] or [0]).tolist()
    for m in _RUN.finditer(text):
        a, b = m.span()
        i = bisect_right(ends, a)
        if i >= len(taken) or starts[i] >= b:
            out.append((a, b, [(a, b)]))
            continue
        # Pieces between the spans; each begins a run of its own behind an assignment.
        group, at, first = [], a, a
        while i < len(taken) and starts[i] < b:
            start, kind, end = taken[i]
            if start > at:
                group.append((at, start))
            if kind == 0:
                out.append((first, max(first, min(start, b)), group))
                group, first = [], min(max(end, at), b)
            at = max(at, end)
            i += 1
        out.append((first, b, [*group, (at, b)] if at < b else group))
    # A piece alone counts from SHORTEST characters on, as any run; beside a span it is a part of a longer string.
    return [(x, y, g) for x, y, g in out if g and y - x >= SHORTEST]


def _codes(run: str) -> np.ndarray:
    raw = np.frombuffer(run.encode("ascii"), np.uint8)
    return np.concatenate([np.zeros(1, np.int64), _CODE[raw].astype(np.int64)])


def _count(counts: np.ndarray, run: str) -> None:
    codes = _codes(run)
    counts += np.bincount(codes[:-1] * STATES + codes[1:], minlength=STATES * STATES)


def _count_text(counts: np.ndarray, text: str, spans: list[tuple[int, int, int]]) -> None:
    """Transitions inside all runs of a text but those that touch a pattern span."""
    raw = np.frombuffer(text.encode("ascii", "replace"), np.uint8)
    codes = np.concatenate([np.zeros(1, np.uint8), _CODE[raw]])
    for start, _, end in spans:
        while start and codes[start]:
            start -= 1
        while end < len(raw) and codes[end + 1]:
            end += 1
        codes[start + 1 : end + 1] = 0
    for at in range(0, len(raw), _CHUNK):
        part = codes[at : at + _CHUNK + 1].astype(np.int64)
        pairs = np.bincount(part[:-1] * STATES + part[1:], minlength=STATES * STATES).reshape(STATES, STATES)
        pairs[:, 0] = 0  # ends of runs
        counts += pairs.reshape(-1)


def _key_part(text: str, start: int, kind: int, end: int) -> str:
    """The random part of a pattern's match: the value, without the name before it."""
    return _ASSIGN.match(text, start)[2] if kind == 0 else text[start:end]


def train(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log-likelihood ratio of every transition, from counts over all documents."""

    def run(batches):
        import pyarrow as pa

        both = np.zeros((2, STATES * STATES), np.int64)
        for batch in batches:
            for t in batch.column(0).to_pylist():
                spans = pattern_spans(t)
                for start, kind, end in spans:
                    _count(both[1], _key_part(t, start, kind, end))
                if t:
                    _count_text(both[0], t, spans)
        label, cell = np.nonzero(both)
        yield pa.RecordBatch.from_arrays([pa.array(label, pa.int32()), pa.array(cell, pa.int32()), pa.array(both[label, cell])], ["label", "cell", "n"])

    rows = docs.select(F.col(text)).mapInArrow(run, "label int, cell int, n long").groupBy("label", "cell").agg(F.sum("n").alias("n"))
    counts = np.zeros((2, STATES * STATES))
    for label, cell, n in rows.collect():  # at most 2 * STATES^2 rows
        counts[label, cell] = n
    seeds = np.full((2, STATES * STATES), 0.5)
    for sample, label in ((_RANDOM, 1), (_ORDINARY, 0)):
        for run_text in sample:
            _count(seeds[label], run_text)
    random, seen, ordinary = (t.reshape(STATES, STATES) for t in (counts[1] + seeds[1], counts[0], seeds[0]))
    # The seeds keep a share however large the corpus: identifiers that prose does not hold stay ordinary.
    total = seen.sum(axis=1, keepdims=True)
    share = np.maximum(SEED_SHARE, SEED_WEIGHT / (total + SEED_WEIGHT))
    plain = (1 - share) * seen / np.maximum(total, 1) + share * ordinary / ordinary.sum(axis=1, keepdims=True)
    return np.log(random / random.sum(axis=1, keepdims=True)) - np.log(plain)


def ratio(model: np.ndarray, run: str) -> float:
    """Mean log-likelihood ratio per character: above 0 the run looks random."""
    codes = _codes(run)
    return float(model[codes[:-1], codes[1:]].mean())


def _random_parts(text: str, start: int, end: int, pieces: list[tuple[int, int]], model: np.ndarray) -> list[tuple[int, int]]:
    """The whole run where its characters outside the pattern spans look random, else each piece that does."""
    if pieces == [(start, end)]:
        return pieces if ratio(model, text[start:end]) >= THRESHOLD else []
    codes = _codes(text[start:end])
    steps = model[codes[:-1], codes[1:]]
    each = [steps[a - start : b - start] for a, b in pieces]
    if np.concatenate(each).mean() >= THRESHOLD:
        return [(start, end)]
    return [piece for piece, own in zip(pieces, each) if own.mean() >= THRESHOLD]


def find(text: str | None, model: np.ndarray) -> list[tuple[int, int, int]]:
    """All spans of a text: the patterns', and the runs that the models call random."""
    spans = pattern_spans(text)
    more = [(a, 3, b) for run in other_runs(text, spans) for a, b in _random_parts(text, *run, model)]
    return sorted(spans + more)


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def scan(docs: DataFrame, model: np.ndarray, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_assign, n_access, n_hex, base_sha256, spans, n_markov), one row per input row, no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        m = sent.value

        def step(c):
            found = [find(t, m) for t in c["text"]]
            base = [[s for s in x if s[1] < 3] for x in found]
            numbers = {f"n_{KINDS[k]}": [sum(s[1] == k for s in x) for x in found] for k in range(4)}
            return {
                "key": c["key"], **numbers, "spans": [joined(x) for x in found],
                "base_sha256": [hashlib.sha256(joined(x).encode()).hexdigest() for x in base],
            }

        return step

    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {kind}, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_markov long"
    return map_texts(rows, "text", schema, make).withColumnRenamed("key", key)


def mask_text(text: str | None, spans: list[tuple[int, int, int]], mask: str) -> str | None:
    """The text with every span, overlapping ones as one, replaced."""
    if not spans:
        return text
    out, at = [], 0
    merged: list[list[int]] = []
    for a, _, b in spans:
        if merged and a < merged[-1][1]:
            merged[-1][1] = max(b, merged[-1][1])
        else:
            merged.append([a, b])
    for a, b in merged:
        out += [text[at:a], mask]
        at = b
    return "".join([*out, text[at:]])


def redact(docs: DataFrame, model: np.ndarray, text: str = "text", mask: str = "[SECRET]") -> DataFrame:
    """The documents with every secret replaced by a mask; all columns stay, in order."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    rows, column = numbered(docs), f"c{docs.columns.index(text)}"

    def make():
        m = sent.value

        def step(c):
            c[column] = [mask_text(t, find(t, m), mask) for t in c[column]]
            return c

        return step

    return map_texts(rows, column, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in rows.schema), make).toDF(*docs.columns)
