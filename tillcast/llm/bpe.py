"""BPE encoding and decoding: a segment tree over the ranks of adjacent pairs picks each merge.

The root of the tree holds the smallest (rank, place), which is the leftmost pair of lowest rank. A merge
changes three leaves; each is a point update of logarithmic cost. Merging ends when the root holds no pair.
Short words run through one array of trees together; a long word has a tree of its own.
"""

from __future__ import annotations

import hashlib
import json
import re
import unicodedata

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tillcast.llm.common import Remembered, add_columns, keep_memory

#: Words of more symbols than this get a tree of their own.
WIDEST = 64
#: Bytes of pieces of text, with their ids, that a Python worker remembers.
REMEMBERED = 240_000_000

NONE = np.int64(1) << 60
#: The characters that Unicode calls white space.
SPACE = "".join(map(chr, (*range(9, 14), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
SPACES = re.compile(f"[{SPACE}]+")
#: Python's split() also splits at these.
SPLIT_ONLY = re.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """A printable letter for each byte: itself where printable, else the next code point from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


class PairTable:
    """Merge ranks by pair of ids, in sorted arrays; ``made[rank]`` is the id that a merge makes."""

    def __init__(self, vocab: dict[str, int], merges: list):
        self.size = max(vocab.values()) + 1
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        keys = np.array([vocab[a] * self.size + vocab[b] for a, b in pairs], np.int64)
        self.made = np.array([vocab[a + b] for a, b in pairs], np.int64)
        order = np.argsort(keys, kind="stable")
        self.keys, self.order = keys[order], order.astype(np.int64)
        self.rank_of = {int(k): int(r) for k, r in zip(self.keys[::-1], self.order[::-1])}

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair, NONE if it does not merge."""
        asked = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, asked), len(self.keys) - 1)
        return np.where(self.keys[at] == asked, self.order[at], NONE)


def merge_long(symbols: list[int], pairs: PairTable) -> list[int]:
    """The symbols of one word after all merges, by a tree of its own."""
    n = len(symbols)
    width = 1 << max(1, (n - 1).bit_length())
    none, size, rank_of = int(NONE), pairs.size, pairs.rank_of
    symbol, after, before = list(symbols), list(range(1, n + 1)), list(range(-1, n - 1))

    def leaf(i: int) -> int:
        if i < 0 or after[i] >= n:
            return none
        rank = rank_of.get(symbol[i] * size + symbol[after[i]])
        return none if rank is None else rank * width + i

    tree = [none] * width + [leaf(i) for i in range(n)] + [none] * (width - n)
    for k in range(width - 1, 0, -1):
        tree[k] = min(tree[2 * k], tree[2 * k + 1])

    def put(i: int, value: int) -> None:
        k = i + width
        tree[k] = value
        while k > 1:
            k >>= 1
            least = min(tree[2 * k], tree[2 * k + 1])
            if tree[k] == least:
                break
            tree[k] = least

    while tree[1] < none:
        rank, i = divmod(tree[1], width)
        gone = after[i]
        symbol[i], symbol[gone] = int(pairs.made[rank]), -1
        after[i] = after[gone]
        if after[i] < n:
            before[after[i]] = i
        put(gone, none)
        put(i, leaf(i))
        if before[i] >= 0:
            put(before[i], leaf(before[i]))
    return [s for s in symbol if s >= 0]


def merge_short(symbols: np.ndarray, lengths: np.ndarray, pairs: PairTable) -> np.ndarray:
    """Rows of ids after all merges, -1 where a symbol is gone; ``symbols`` has a power of two columns."""
    rows, width = symbols.shape
    levels = width.bit_length() - 1
    place = np.arange(width)
    after = np.broadcast_to(place + 1, (rows, width)).copy()
    before = np.broadcast_to(place - 1, (rows, width)).copy()
    out = symbols.copy()
    tree = np.full((rows, 2 * width), NONE)
    has_next = place + 1 < lengths[:, None]
    r, c = np.nonzero(has_next)
    ranks = pairs.ranks(out[r, c], out[r, c + 1])
    tree[r, width + c] = np.where(ranks < NONE, ranks * width + c, NONE)
    for level in range(levels - 1, -1, -1):
        lo = 1 << level
        tree[:, lo:2 * lo] = np.minimum(tree[:, 2 * lo:4 * lo:2], tree[:, 2 * lo + 1:4 * lo:2])

    def put(r: np.ndarray, c: np.ndarray, value) -> None:
        k = c + width
        tree[r, k] = value
        for _ in range(levels):
            k = k >> 1
            tree[r, k] = np.minimum(tree[r, 2 * k], tree[r, 2 * k + 1])

    def leaf(r: np.ndarray, c: np.ndarray) -> np.ndarray:
        nxt = after[r, c]
        inside = nxt < lengths[r]
        rank = pairs.ranks(out[r, c], out[r, np.where(inside, nxt, c)])
        return np.where(inside & (rank < NONE), rank * width + c, NONE)

    live = np.flatnonzero(tree[:, 1] < NONE)
    while len(live):
        rank, at = np.divmod(tree[live, 1], width)
        gone = after[live, at]
        out[live, at] = pairs.made[rank]
        out[live, gone] = -1
        then = after[live, gone]
        after[live, at] = then
        inside = then < lengths[live]
        before[live[inside], then[inside]] = at[inside]
        put(live, gone, NONE)
        put(live, at, leaf(live, at))
        prev = before[live, at]
        has = prev >= 0
        put(live[has], prev[has], leaf(live[has], prev[has]))
        live = live[tree[live, 1] < NONE]
    return out


class WordBpe:
    """Encodes and decodes as a vocabulary file of this kind says: NFC, lower case, word ends, no decoder step."""

    def __init__(self, spec: str):
        import regex

        spec = json.loads(spec)
        model = spec["model"]
        vocab = model["vocab"]
        self.end = model.get("end_of_word_suffix") or ""
        self.pairs = PairTable(vocab, model["merges"])
        letters = byte_letters()
        self.inner = [vocab.get(x, -1) for x in letters]
        self.last = [vocab.get(x + self.end, -1) for x in letters]
        steps = spec["pre_tokenizer"]["pretokenizers"]
        self.words = regex.compile(steps[0]["pattern"]["Regex"]).findall
        self.tokens = {i: t for t, i in vocab.items()}
        self.added = {x["content"]: x["id"] for x in spec["added_tokens"]}
        self.tokens |= {i: t for t, i in self.added.items()}
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(self.added, key=len, reverse=True))) + ")") if self.added else None
        #: Ids and decoded text of a piece.
        self.known = Remembered(REMEMBERED, lambda piece, found: 320 + len(piece) + len(found[0]) + len(found[1]))

    def symbols(self, word: str) -> list[int]:
        data = word.encode()
        found = [self.inner[b] for b in data[:-1]] + [self.last[data[-1]]]
        return [s for s in found if s >= 0]

    def encode_words(self, words: list[str]) -> list[np.ndarray]:
        """Ids of each word."""
        symbols = [self.symbols(w) for w in words]
        sizes = np.array([len(s) for s in symbols], np.int64)
        out: list = [None] * len(words)
        for i in np.flatnonzero((sizes < 2) | (sizes > WIDEST)).tolist():
            out[i] = np.array(merge_long(symbols[i], self.pairs) if sizes[i] > 1 else symbols[i], "<u4")
        width = 2
        while width <= WIDEST:
            rows = np.flatnonzero((sizes <= width) & (sizes > (width >> 1 if width > 2 else 1)))
            if len(rows):
                grid = np.full((len(rows), width), -1, np.int64)
                grid[np.arange(width) < sizes[rows][:, None]] = np.concatenate([symbols[i] for i in rows.tolist()])
                done = merge_short(grid, sizes[rows], self.pairs)
                kept = done >= 0
                flat, ends = done[kept].astype("<u4"), kept.sum(1).cumsum()
                for i, ids in zip(rows.tolist(), np.split(flat, ends[:-1])):
                    out[i] = ids
            width *= 2
        return out

    def lower(self, text: str) -> str:
        """Lower case letter by letter: a final sigma is not treated apart."""
        return "".join(map(str.lower, text)) if "Σ" in text else text.lower()

    def pieces(self, text: str) -> list[str]:
        text = unicodedata.normalize("NFC", text)
        return [p for p in SPACES.split(text) if p] if SPLIT_ONLY.search(text) else text.split()

    def learn(self, pieces: set[str]) -> None:
        """Adds what is new to the remembered pieces."""
        new = self.known.missing(pieces)
        if not new:
            return
        split = {p: self.words(self.lower(p)) for p in new}
        words = list({w for ws in split.values() for w in ws})
        ids = dict(zip(words, self.encode_words(words)))
        done = []
        for p, ws in split.items():
            found = ids[ws[0]] if len(ws) == 1 else np.concatenate([ids[w] for w in ws]) if ws else np.zeros(0, "<u4")
            done.append((p, (found.tobytes(), self.decode(found.tolist()))))
        self.known.add(done)

    def decode(self, ids: list[int]) -> str:
        """The tokens with a space between, special ones too."""
        return " ".join([self.tokens[i] for i in ids])

    def encode(self, texts: list[str | None]) -> list[tuple[bytes, str]]:
        """For each text its ids as little-endian 32-bit integers and the text that they decode to."""
        parts = [self.special.split(t or "") if self.special and "<" in (t or "") else [t or ""] for t in texts]
        cut = [[[p] if k % 2 else self.pieces(p) for k, p in enumerate(ps)] for ps in parts]
        self.learn({p for doc in cut for k, ps in enumerate(doc) if k % 2 == 0 for p in ps})
        known, out = self.known.young, []
        for doc in cut:
            found = [known[p] for p in doc[0]]
            for k, ps in enumerate(doc[1:], 1):
                found += [(self.added[ps[0]].to_bytes(4, "little"), ps[0])] if k % 2 else [known[p] for p in ps]
            out.append((b"".join([x[0] for x in found]), " ".join([x[1] for x in found if x[1]])))
        self.known.settle()
        return out


_READY: dict[str, WordBpe] = {}


def word_bpe(spec: str) -> WordBpe:
    """The encoder of a vocabulary, one a Python worker."""
    key = hashlib.sha256(spec.encode()).hexdigest()
    if key not in _READY:
        _READY[key] = WordBpe(spec)
        keep_memory("bpe", _READY[key].known)
    return _READY[key]


def vocabulary(path: str, most: int = 64_000_000) -> str:
    """The text of a vocabulary file, which is broadcast; larger than ``most`` bytes is refused."""
    with open(path, "rb") as f:
        data = f.read(most + 1)
    if len(data) > most:
        raise ValueError(f"{path} has more than {most} bytes")
    return data.decode()


def encode_texts(docs: DataFrame, path: str, column: str = "text", keep_text: bool = True, remembered: int = REMEMBERED) -> DataFrame:
    """``docs`` with ids (arrays), n_tokens and decoded text, or with their digests if ``keep_text`` is off.

    A null text counts as empty: no ids, an empty decoded text. New columns replace clashing ones. ``remembered`` bounds the
    bytes of pieces that a worker keeps; it changes the time, not the result.
    """
    spec = docs.sparkSession.sparkContext.broadcast(vocabulary(path))

    def make():
        bpe = word_bpe(spec.value)
        bpe.known.bound(remembered)

        def full(texts):
            found = bpe.encode(texts)
            return [np.frombuffer(a, "<u4").astype(np.int64) for a, _ in found], [len(a) // 4 for a, _ in found], [b for _, b in found]

        def digests(texts):
            found = bpe.encode(texts)
            return (
                [len(a) // 4 for a, _ in found], [hashlib.sha256(a).hexdigest() for a, _ in found],
                [hashlib.sha256(b.encode()).hexdigest() for _, b in found],
            )

        return full if keep_text else digests

    make.owner = "bpe"
    if keep_text:
        fields = [T.StructField("ids", T.ArrayType(T.LongType())), T.StructField("n_tokens", T.LongType()), T.StructField("decoded", T.StringType())]
    else:
        fields = [T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()), T.StructField("decoded_sha256", T.StringType())]
    return add_columns(docs, column, make, fields)
