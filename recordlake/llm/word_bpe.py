"""Encoding and decoding with a word-end BPE vocabulary, by a segment tree over pair ranks."""

from __future__ import annotations

import json
import unicodedata
from functools import lru_cache
from hashlib import sha256
from struct import pack

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField

from recordlake.llm.batches import append_columns
from recordlake.llm.pretokens import Cutter
from recordlake.llm.token_counts import byte_characters

#: Fixed value: white space as the vocabulary's own pattern means it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Fixed value: how vocabularies of this kind cut a text; the rest is dropped.
PIECES = Cutter(r"'s|'t|'re|'ve|'m|'ll|'d|[LETTER]+|[NUMBER]|[^SPACELETTERNUMBER]+", SPACE)
#: Distinct pieces that a worker remembers; then it starts anew.
REMEMBERED = 300_000
NONE = 1 << 62
#: Pieces of fewer than 2**8 bytes are merged many at once.
SHORT_BITS = 8


class WordBpe:
    """A BPE model whose words end in a symbol of their own."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        vocabulary, self.end = model["model"]["vocab"], model["model"]["end_of_word_suffix"]
        self.special = {t["content"]: t["id"] for t in model["added_tokens"]}
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        self.pairs = {
            (vocabulary[a], vocabulary[b]): (rank, vocabulary[a + b])
            for rank, (a, b) in enumerate(merges)
        }
        self.size = len(vocabulary)
        keys = np.array([a * self.size + b for a, b in self.pairs], np.int64)
        order = np.argsort(keys)
        self.keys, self.ranks = keys[order], order
        self.made = np.array([made for _, made in self.pairs.values()], np.int64)
        self.tokens = {i: t for t, i in (*vocabulary.items(), *self.special.items())}
        characters = byte_characters()
        self.inner = [vocabulary[c] for c in characters]
        self.last = [vocabulary[c + self.end] for c in characters]
        found = "|".join(regex.escape(s) for s in sorted(self.special, key=len)[::-1])
        self.cut = regex.compile(f"({found})") if found else None
        self.known: dict[str, bytes] = {}

    def merged(self, symbols: list[int]) -> list[int]:
        """Merge the leftmost lowest-rank pair until none is left.

        Leaf i of the tree holds the rank of the pair that starts at place i, and the place;
        an inner node the smaller of its two. So the root is the pair to merge, and a merge
        changes three leaves and the nodes above them.
        """
        n = len(symbols)
        if n < 2:
            return symbols
        pairs, size = self.pairs, 1 << (n - 2).bit_length()
        tree = [NONE] * (2 * size)
        for i in range(n - 1):
            if pair := pairs.get((symbols[i], symbols[i + 1])):
                tree[size + i] = pair[0] * size + i
        for node in range(size - 1, 0, -1):
            a, b = tree[2 * node], tree[2 * node + 1]
            tree[node] = a if a < b else b
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))

        def put(place: int, value: int) -> None:
            node = size + place
            tree[node] = value
            while node > 1:
                other, node = tree[node ^ 1], node >> 1
                if other < value:
                    value = other
                if tree[node] == value:
                    return
                tree[node] = value

        top = min(1, size)
        while (root := tree[top]) < NONE:
            i = root % size
            j = after[i]
            k = after[j]
            symbols[i] = pairs[symbols[i], symbols[j]][1]
            after[i] = k
            if j < n - 1:
                put(j, NONE)
            if k < n:
                before[k] = i
                pair = pairs.get((symbols[i], symbols[k]))
                put(i, pair[0] * size + i if pair else NONE)
            else:
                put(i, NONE)
            if (h := before[i]) >= 0:
                pair = pairs.get((symbols[h], symbols[i]))
                put(h, pair[0] * size + h if pair else NONE)
        left, i = [], 0
        while i < n:
            left.append(symbols[i])
            i = after[i]
        return left

    def merged_rows(self, rows: list[list[int]]) -> list[list[int]]:
        """:meth:`merged` for many short rows of symbols at once, one tree for each."""
        counts = np.fromiter(map(len, rows), np.int64, len(rows))
        m, n = len(rows), int(counts.max())
        size = 1 << n.bit_length()
        symbols = np.full((m, size), -1, np.int64)
        symbols[np.arange(size) < counts[:, None]] = [s for row in rows for s in row]
        tree = np.full((m, 2 * size), NONE, np.int64)
        places = np.arange(size - 1)
        tree[:, size : 2 * size - 1] = self.leaves(symbols[:, :-1], symbols[:, 1:], places, size)
        level = size
        while level > 1:
            level //= 2
            children = tree[:, 2 * level : 4 * level]
            tree[:, level : 2 * level] = np.minimum(children[:, ::2], children[:, 1::2])
        after = np.tile(np.arange(1, size + 1), (m, 1))
        before = np.tile(np.arange(-1, size), (m, 1))
        live = np.flatnonzero(tree[:, 1] < NONE)
        while len(live):
            root = tree[live, 1]
            i = root % size
            j = after[live, i]
            k = after[live, j]
            symbols[live, i] = self.made[root // size]
            symbols[live, j] = -1
            after[live, i] = k
            before[live, k] = i
            h = before[live, i]
            following = np.where(k < counts[live], symbols[live, np.minimum(k, size - 1)], -1)
            preceding = np.where(h >= 0, symbols[live, h], -1)
            tree[live, size + j] = NONE
            tree[live, size + i] = self.leaves(symbols[live, i], following, i, size)
            has = h >= 0
            tree[live[has], size + h[has]] = self.leaves(
                preceding, symbols[live, i], h, size
            )[has]
            owners = np.concatenate([live, live, live])
            nodes = size + np.concatenate([i, j, np.where(has, h, i)])
            while nodes[0] > 1:
                nodes >>= 1
                tree[owners, nodes] = np.minimum(tree[owners, 2 * nodes], tree[owners, 2 * nodes + 1])
            live = live[tree[live, 1] < NONE]
        kept = symbols >= 0
        flat, ends = symbols[kept].tolist(), np.cumsum(kept.sum(1)).tolist()
        return [flat[a:b] for a, b in zip([0, *ends], ends)]

    def leaves(self, left: np.ndarray, right: np.ndarray, place: np.ndarray, size: int) -> np.ndarray:
        """What the leaves of pairs hold; a symbol of -1 is none."""
        wanted = np.where((left >= 0) & (right >= 0), left * self.size + right, -1)
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at] * size + place, NONE)

    def learn(self, pieces: list[str]) -> None:
        """Encode pieces that are not known yet, pieces of like length together."""
        by_length: dict[int, list[str]] = {}
        for p in pieces:
            by_length.setdefault(len(p.encode()).bit_length(), []).append(p)
        for bits, group in by_length.items():
            at_once = 1 if bits > SHORT_BITS else (1 << 19) >> bits
            for first in range(0, len(group), at_once):
                some = group[first : first + at_once]
                rows = [
                    [self.inner[b] for b in d[:-1]] + [self.last[d[-1]]]
                    for d in (p.encode() for p in some)
                ]
                merged = self.merged_rows(rows) if bits <= SHORT_BITS else [self.merged(rows[0])]
                for p, ids in zip(some, merged):
                    self.known[p] = pack(f"<{len(ids)}I", *ids)

    def decoded(self, ids: list[int]) -> str:
        """Without a decoder of its own, the vocabulary decodes to symbols and spaces."""
        try:
            return " ".join(map(self.tokens.__getitem__, ids))
        except KeyError:
            return " ".join(self.tokens[i] for i in ids if i in self.tokens)

    def encode(self, texts: list[str | None]) -> list[list[bytes]]:
        """For each text the ids of its pieces, in little-endian 32-bit numbers."""
        cut = [self.pieces(t or "") for t in texts]
        known = self.known
        new = {p for pieces in cut for p in pieces if p not in known}
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = {p for pieces in cut for p in pieces}
        known.update((s, pack("<I", i)) for s, i in self.special.items())
        self.learn([p for p in new if p not in self.special])
        return [list(map(known.__getitem__, pieces)) for pieces in cut]

    def pieces(self, text: str) -> list[str]:
        """What is encoded apart; a special token's string is a piece of its own.

        No other piece equals such a string, as letters and signs never share a piece.
        """
        parts = [text]
        if self.cut and any(s in text for s in self.special):
            parts = self.cut.split(text)
        made = []
        for k, part in enumerate(parts):
            if k % 2:
                made.append(part)
            else:
                # Character by character there is no final sigma.
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ").lower()
                made += PIECES.pieces(part)
        return made


@lru_cache(maxsize=2)
def model(path: str) -> WordBpe:
    """One per worker and vocabulary."""
    return WordBpe(path)


def encoded(
    df: DataFrame, vocabulary: str, text: str = "text", keep: list[str] | None = None, with_decoded: bool = False
) -> DataFrame:
    """Add the token ids of every text (``ids``) and their number (``n_tokens``).

    ``with_decoded`` also adds what the ids decode to (``decoded``), as :func:`decoded` does from
    a column of ids, by the same worker and vocabulary.

    ``vocabulary`` is the path of a word-end BPE file, the same on every executor. A null text
    counts as empty: no ids. Repeated rows are encoded each, an empty table stays empty, and a
    column with a new column's name is replaced. Texts of any length are encoded whole; a worker
    remembers a bounded number of pieces.
    """
    fields = [StructField("n_tokens", LongType()), StructField("ids", ArrayType(IntegerType(), False))]
    if with_decoded:
        fields.append(StructField("decoded", StringType()))

    def make(texts):
        bpe = model(vocabulary)
        ids = [np.frombuffer(b"".join(pieces), "<u4").astype("i4") for pieces in bpe.encode(texts)]
        made = [[len(row) for row in ids], ids]
        return [*made, [bpe.decoded(row.tolist()) for row in ids]] if with_decoded else made

    return append_columns(df, text, fields, make, keep)


def round_trips(df: DataFrame, vocabulary: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Encode every text and decode it again: number of tokens and digests of ids and text.

    ``ids_sha256`` is over the ids as little-endian 32-bit numbers, ``decoded_sha256`` over the
    text in UTF-8 that these ids decode to. Otherwise as :func:`encoded`.
    """
    fields = [
        StructField("n_tokens", LongType()),
        StructField("ids_sha256", StringType()),
        StructField("decoded_sha256", StringType()),
    ]

    def make(texts):
        bpe, tokens, digests, decoded = model(vocabulary), [], [], []
        for pieces in bpe.encode(texts):
            row = b"".join(pieces)
            ids = np.frombuffer(row, "<u4").tolist()
            tokens.append(len(ids))
            digests.append(sha256(row).hexdigest())
            decoded.append(sha256(bpe.decoded(ids).encode()).hexdigest())
        return [tokens, digests, decoded]

    return append_columns(df, text, fields, make, keep)


def decoded(
    df: DataFrame, vocabulary: str, ids: str = "ids", column: str = "decoded", keep: list[str] | None = None
) -> DataFrame:
    """Add the text that a column of token ids decodes to, special tokens included.

    The vocabulary has no decoder of its own: a text is the tokens' symbols with spaces between,
    in lower case and without the white space that encoding dropped. Null and empty ids give an
    empty text; an id that the vocabulary does not have is left out, as by the library. ``column``
    replaces a column of its name; repeated rows and any other columns stay as they are.
    """

    def make(rows):
        bpe = model(vocabulary)
        return [[bpe.decoded(row or []) for row in rows]]

    return append_columns(df, ids, [StructField(column, StringType())], make, keep)
