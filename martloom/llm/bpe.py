"""Byte-pair encoding and decoding with a public word-end vocabulary.

Every piece of text (a run between white space, cut by the vocabulary's pattern) is merged by a segment tree
whose leaves hold the key ``rank * width + position`` of the pair that begins at a symbol. The root is then the
leftmost pair of the lowest rank; a merge changes three leaves and their ancestors. Short pieces are merged
many at a time, one tree to a row of an array; longer ones by one tree each, in n log n.

Null text encodes as empty text. The strings of the added tokens are recognised in the raw text.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from collections.abc import Sequence
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from martloom.llm.common import map_texts

_SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
_GAP = regex.compile(f"[{_SPACE}]+")
_PIECE = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^" + _SPACE + r"\p{L}\p{N}]+")
_END = "</w>"
_NONE = np.int64(1) << 62
#: Widest piece, in bytes, that is merged in arrays of many trees.
_ROW_WIDTH = 64
#: Words whose ids a worker remembers; the memory is emptied when full, and results do not depend on it.
REMEMBERED = 400_000


def _byte_letters() -> list[str]:
    """Byte-level letters: printable bytes stand for themselves, the others for letters from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(others)) for b in range(256)]


class Bpe:
    """Encoder and decoder of one vocabulary file of the tokenizers library."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        vocab = dict(spec["model"]["vocab"])
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens = [""] * (max([*vocab.values(), *self.added.values()]) + 1)
        for token, i in [*vocab.items(), *self.added.items()]:
            self.tokens[i] = token
        letters = _byte_letters()
        self.inner = np.array([vocab[c] for c in letters], np.int64)
        self.last = np.array([vocab[c + _END] for c in letters], np.int64)
        self.size = np.int64(len(self.tokens) + 1)
        pairs = np.array([(vocab[a], vocab[b], vocab[a + b]) for a, b in spec["model"]["merges"]], np.int64)
        keys = pairs[:, 0] * self.size + pairs[:, 1]
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order.astype(np.int64), pairs[:, 2]
        self.by_pair = {int(k): r for r, k in enumerate(keys)}
        self.marks = regex.compile("|".join(map(regex.escape, self.added))) if self.added else None
        self.words: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}

    # -- merging

    def _rank(self, a: np.ndarray, b: np.ndarray, at: np.ndarray, width: int) -> np.ndarray:
        """Leaf keys of the pairs (a, b) at their positions; none where no merge is known."""
        key = a * self.size + b
        found = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where((self.keys[found] == key) & (a >= 0) & (b >= 0), self.ranks[found] * width + at, _NONE)

    def _merge_many(self, pieces: list[bytes], width: int) -> list[bytes]:
        """Ids of pieces of at most ``width`` bytes (a power of two): a segment tree in each row."""
        rows = len(pieces)
        lengths = np.fromiter(map(len, pieces), np.int64, rows)
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(rows, width)
        at = np.arange(width)
        symbols = np.full((rows, width + 1), -1, np.int64)  # the last column stands for "no symbol"
        symbols[:, :width] = np.where(at < lengths[:, None], self.inner[raw], -1)
        ends = lengths - 1
        symbols[np.arange(rows), ends] = self.last[raw[np.arange(rows), ends]]
        after = np.tile(np.arange(1, width + 2), (rows, 1))
        after[:, width] = width
        before = np.tile(np.arange(-1, width), (rows, 1))
        tree = np.full((rows, 2 * width), _NONE, np.int64)
        tree[:, width:] = self._rank(symbols[:, :width], symbols[:, 1:], np.broadcast_to(at, (rows, width)), width)
        level = width
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        flat, live = tree.reshape(-1), np.arange(rows)
        while True:
            root = tree[live, 1]
            going = root < _NONE
            live, root = live[going], root[going]
            if not len(live):
                break
            pos = root % width
            right = after[live, pos]
            beyond = after[live, right]
            symbols[live, pos] = self.merged[root // width]
            symbols[live, right] = -1
            after[live, pos] = beyond
            before[live, beyond] = pos
            left = before[live, pos]
            first = left < 0
            here = self._rank(symbols[live, pos], symbols[live, beyond], pos, width)
            left = np.where(first, pos, left)
            there = np.where(first, here, self._rank(symbols[live, left], symbols[live, pos], left, width))
            base = live * (2 * width)
            nodes = [pos + width, right + width, left + width]
            for node, value in zip(nodes, (here, _NONE, there)):
                flat[base + node] = value
            for _ in range(width.bit_length() - 1):
                for i, node in enumerate(nodes):
                    nodes[i] = node = node >> 1
                    under = base + 2 * node
                    flat[base + node] = np.minimum(flat[under], flat[under + 1])
        ids = symbols.astype("<u4")
        kept = symbols >= 0
        return [ids[i][kept[i]].tobytes() for i in range(rows)]

    def _merge_one(self, piece: bytes) -> bytes:
        """Ids of one long piece: a segment tree with a point update in log n for each merge."""
        n = len(piece)
        symbols = [int(self.inner[b]) for b in piece[:-1]] + [int(self.last[piece[-1]])]
        width, size, known, none = 1 << max(1, (n - 1).bit_length()), int(self.size), self.by_pair, int(_NONE)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        tree = [none] * (2 * width)

        def key(i: int) -> int:
            if i < 0 or after[i] >= n:
                return none
            rank = known.get(symbols[i] * size + symbols[after[i]])
            return none if rank is None else rank * width + i

        def put(i: int, value: int) -> None:
            node = i + width
            tree[node] = value
            while node > 1:
                node >>= 1
                low = min(tree[2 * node], tree[2 * node + 1])
                if tree[node] == low:
                    break
                tree[node] = low

        for i in range(n):
            tree[width + i] = key(i)
        for node in range(width - 1, 0, -1):
            tree[node] = min(tree[2 * node], tree[2 * node + 1])
        while tree[1] < none:
            rank, pos = divmod(tree[1], width)
            right = after[pos]
            symbols[pos], symbols[right] = int(self.merged[rank]), -1
            after[pos] = after[right]
            if after[pos] < n:
                before[after[pos]] = pos
            put(right, none)
            put(pos, key(pos))
            if before[pos] >= 0:
                put(before[pos], key(before[pos]))
        return np.array([s for s in symbols if s >= 0], "<u4").tobytes()

    def _learn_pieces(self, pieces: list[str]) -> None:
        """Merge pieces that are not remembered yet, by width."""
        widths: dict[int, list[str]] = {}
        for piece in pieces:
            n = len(piece.encode())
            widths.setdefault(1 << (n - 1).bit_length() if n > 1 else 2, []).append(piece)
        for width, group in widths.items():
            for i in range(0, len(group), 20_000):
                part = group[i : i + 20_000]
                raw = [p.encode() for p in part]
                done = self._merge_many(raw, width) if width <= _ROW_WIDTH else map(self._merge_one, raw)
                self.pieces.update(zip(part, done))

    @staticmethod
    def _cut(word: str) -> list[str]:
        """Pieces of a word: canonical composition, lower case letter by letter, then the pattern."""
        if not word.isascii():
            word = unicodedata.normalize("NFC", word).replace("Σ", "σ")
        word = word.lower()
        if word.isalpha():
            return [word]
        if word[-1:] in ".,;:" and word[:-1].isalpha():
            return [word[:-1], word[-1]]
        return _PIECE.findall(word)

    @staticmethod
    def _split(text: str) -> list[str]:
        """Words between white space. Python's own split also cuts at U+001C to U+001F, which the pattern keeps."""
        if "\x1c" in text or "\x1d" in text or "\x1e" in text or "\x1f" in text:
            return _GAP.split(text)
        return text.split()

    # -- texts

    def _parts(self, text: str) -> list[str | int]:
        """Words of a text, with the ids of added tokens found in it."""
        if self.marks is None or not any(mark in text for mark in self.added):
            return self._split(text)
        out: list[str | int] = []
        start = 0
        for found in self.marks.finditer(text):
            out += self._split(text[start : found.start()])
            out.append(self.added[found[0]])
            start = found.end()
        return out + self._split(text[start:])

    def encode_texts(self, texts: list[str | None]) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers."""
        split = [self._parts(t) if t else [] for t in texts]
        if len(self.words) > REMEMBERED or len(self.pieces) > REMEMBERED:
            self.words.clear()
            self.pieces.clear()
        fresh = set().union(*split) - self.words.keys()
        cuts = {w: self._cut(w) for w in fresh if isinstance(w, str)}
        missing = {p for cut in cuts.values() for p in cut} - self.pieces.keys()
        self._learn_pieces(list(missing))
        pieces, words = self.pieces, self.words
        for word, cut in cuts.items():
            words[word] = b"".join([pieces[p] for p in cut])
        words.update({i: int(i).to_bytes(4, "little") for i in fresh if not isinstance(i, str)})
        return [b"".join([words[w] for w in parts]) for parts in split]

    def decode(self, ids) -> str:
        """Token strings joined by spaces, as a vocabulary without a decoder is decoded."""
        tokens = self.tokens
        return " ".join([tokens[i] for i in ids])


@lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    """The vocabulary, read once in each Python worker."""
    return Bpe(path)


def encode(df: DataFrame, path: str, key: str = "doc_id", text: str = "text", carry: Sequence[str] = ()) -> DataFrame:
    """(key, carried columns, n_tokens, ids array<int>) of every row's whole text, in one pass and without a shuffle."""

    def make():
        bpe = load(path)

        def step(c):
            ids = [np.frombuffer(b, "<u4").astype(np.int32) for b in bpe.encode_texts(c.pop("text"))]
            return c | {"ids": ids, "n_tokens": [len(i) for i in ids]}

        return step

    kept = [f for f in df.select(key, *carry).schema]
    # The text goes by a name of its own, and carried columns by number: names may clash with the results'.
    rows = df.select(*[F.col(f.name).alias(f"c{i}") for i, f in enumerate(kept)], F.col(text).alias("text"))
    schema = ", ".join([f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(kept)] + ["n_tokens long", "ids array<int>"])
    out = map_texts(rows, "text", schema, make)
    return out.select(*[F.col(f"c{i}").alias(f.name) for i, f in enumerate(kept)], "n_tokens", "ids")


def decode(df: DataFrame, path: str, key: str = "doc_id", ids: str = "ids") -> DataFrame:
    """(key, text) of every row's ids; null ids give null."""
    kind = df.schema[key].dataType.simpleString()

    def run(batches):
        import pyarrow as pa

        bpe = load(path)
        for batch in batches:
            for i in range(0, batch.num_rows, 256):
                part = batch.slice(i, 256)
                texts = [None if x is None else bpe.decode(x) for x in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string())], ["key", "text"])

    rows = df.select(F.col(key).alias("key"), F.col(ids).alias("ids"))
    return rows.mapInArrow(run, f"key {kind}, text string").withColumnRenamed("key", key)


def token_counts(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens): encoded lengths without the ids."""

    def make():
        bpe = load(path)
        return lambda c: {"key": c["key"], "n_tokens": [len(b) // 4 for b in bpe.encode_texts(c["text"])]}

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    return map_texts(rows, "text", f"key {kind}, n_tokens long", make).withColumnRenamed("key", key)


def digests(df: DataFrame, path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_tokens, ids_sha256, decoded_sha256): encode, decode the ids again, and digest both."""

    def make():
        bpe = load(path)

        def step(c):
            ids = bpe.encode_texts(c["text"])
            return {
                "key": c["key"],
                "n_tokens": [len(b) // 4 for b in ids],
                "ids_sha256": [hashlib.sha256(b).hexdigest() for b in ids],
                "decoded_sha256": [
                    hashlib.sha256(bpe.decode(np.frombuffer(b, "<u4").tolist()).encode()).hexdigest() for b in ids
                ],
            }

        return step

    kind = df.schema[key].dataType.simpleString()
    rows = df.select(F.col(key).alias("key"), F.col(text).alias("text"))
    schema = f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return map_texts(rows, "text", schema, make).withColumnRenamed("key", key)
