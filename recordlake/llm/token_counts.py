"""Token counts by rank-synchronous merging of arrays."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql.types import BooleanType, LongType, StructField

from recordlake.llm.batches import append_columns
from recordlake.llm.pretokens import Cutter

#: Fixed value: how byte-level vocabularies of this kind cut a text before merging.
PIECES = Cutter(
    r"'s|'t|'re|'ve|'m|'ll|'d| ?[LETTER]+| ?[NUMBER]+| ?[^SPACELETTERNUMBER]+|[SPACE]+(?![^SPACE])|[SPACE]+"
)
#: Distinct pieces whose counts a worker remembers; then it starts anew.
REMEMBERED = 400_000
NO_PAIR = np.int64(1) << 40


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary.

    Printable Latin-1 bytes stand for themselves, the others for characters from 256 on.
    """
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return [chr(b) if b in own else chr(next(others)) for b in range(256)]


class RankMerger:
    """Counts the symbols that are left when all merges of a byte-level vocabulary are done.

    Pre-tokens lie one after another in one array of symbols. In every round each of them
    has its lowest-rank pair merged, wherever that pair stands in it; those without a pair
    leave with their count. A merge may only join symbols made by earlier merges, which
    makes merging all places of a pair at once the same as one after another.
    """

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            model = json.load(file)
        vocabulary = model["model"]["vocab"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
        self.special = [t["content"] for t in model["added_tokens"]]
        self.size = len(vocabulary) + len(self.special)
        left = np.array([vocabulary[a] for a, _ in merges], np.int64)
        right = np.array([vocabulary[b] for _, b in merges], np.int64)
        made = np.array([vocabulary[a + b] for a, b in merges], np.int64)
        rank = np.arange(len(merges))
        born = np.full(self.size, -1, np.int64)
        born[made] = rank
        if len(np.unique(made)) < len(made) or (np.maximum(born[left], born[right]) >= rank).any():
            raise ValueError("a merge joins symbols of a later merge")
        keys = left * self.size + right
        order = np.argsort(keys)
        self.keys, self.ranks, self.made = keys[order], rank[order], made
        self.symbols = np.array([vocabulary[c] for c in byte_characters()], np.int64)

    def pair_ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NO_PAIR)

    def counts(self, pieces: list[bytes]) -> np.ndarray:
        """Tokens of each pre-token."""
        lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
        counts = lengths.copy()
        symbols = self.symbols[np.frombuffer(b"".join(pieces), np.uint8)]
        owner = np.repeat(np.arange(len(pieces)), lengths)
        ranks = np.full(len(symbols), NO_PAIR)
        same = np.flatnonzero(owner[1:] == owner[:-1])
        ranks[same] = self.pair_ranks(symbols[same], symbols[same + 1])
        while len(symbols):
            first = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]])
            sizes = np.diff(np.r_[first, len(owner)])
            lowest = np.repeat(np.minimum.reduceat(ranks, first), sizes)
            if (alive := lowest < NO_PAIR).sum() < len(alive):
                counts[owner[first]] = sizes
                symbols, owner, ranks, lowest = (x[alive] for x in (symbols, owner, ranks, lowest))
                if not len(symbols):
                    break
            chosen = ranks == lowest
            # Of overlapping places (a run of one symbol) every second one is merged.
            starts = chosen & ~np.r_[False, chosen[:-1]]
            at = np.arange(len(chosen))
            offset = at - np.maximum.accumulate(np.where(starts, at, 0))
            places = np.flatnonzero(chosen & (offset % 2 == 0))
            symbols[places] = self.made[ranks[places]]
            left = np.ones(len(symbols), bool)
            left[places + 1] = False
            places = places - np.arange(len(places))
            symbols, owner, ranks = symbols[left], owner[left], ranks[left]
            changed = np.unique(np.r_[places, places[places > 0] - 1])
            ranks[changed] = NO_PAIR
            changed = changed[changed < len(symbols) - 1]
            changed = changed[owner[changed] == owner[changed + 1]]
            ranks[changed] = self.pair_ranks(symbols[changed], symbols[changed + 1])
        return counts


class TokenCounter:
    """Token counts of texts; the strings of special tokens are one token each."""

    def __init__(self, path: str):
        self.merger = RankMerger(path)
        self.known: dict[str, int] = {}
        special = "|".join(regex.escape(s) for s in sorted(self.merger.special, key=len)[::-1])
        self.special = regex.compile(special) if special else None

    def count(self, texts: list[str | None]) -> list[int]:
        known, cut, totals = self.known, [], []
        for text in texts:
            parts = [text or ""]
            if self.special and any(s in parts[0] for s in self.merger.special):
                parts = self.special.split(parts[0])
            totals.append(len(parts) - 1)
            cut.append([p for part in parts for p in PIECES.pieces(part)])
        new = list({p for pieces in cut for p in pieces if p not in known})
        if len(known) + len(new) > REMEMBERED:
            known.clear()
            new = list({p for pieces in cut for p in pieces})
        if new:
            known.update(zip(new, self.merger.counts([p.encode() for p in new]).tolist()))
        return [n + sum(map(known.__getitem__, pieces)) for n, pieces in zip(totals, cut)]


@lru_cache(maxsize=2)
def counter(path: str) -> TokenCounter:
    """One per worker and vocabulary."""
    return TokenCounter(path)


def token_counts(
    df: DataFrame, vocabulary: str, text: str = "text", limit: int = 1024, keep: list[str] | None = None
) -> DataFrame:
    """Bytes and tokens of every text, and whether there are more than ``limit`` tokens.

    ``vocabulary`` is the path of a byte-level vocabulary file, the same on every executor.
    Adds ``n_bytes``, ``n_tokens`` and ``over_limit`` to the ``keep`` columns (all). A null
    text counts as empty: no bytes, no tokens. Repeated rows are counted each; an empty table
    gives an empty table; a column with a new column's name is replaced. A text of any length
    is counted whole.
    """
    fields = [
        StructField("n_bytes", LongType()),
        StructField("n_tokens", LongType()),
        StructField("over_limit", BooleanType()),
    ]

    def make(texts):
        tokens = counter(vocabulary).count(texts)
        return [[len((t or "").encode()) for t in texts], tokens, [n > limit for n in tokens]]

    return append_columns(df, text, fields, make, keep)
