"""Benchmark decontamination by greedy string tiling."""

from __future__ import annotations

from collections import deque
from dataclasses import dataclass

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StringType, StructField, StructType

from recordlake.llm.batches import append_columns, quoted
from recordlake.llm.words import separators, window_hashes, word_bounds, word_hashes

#: Tokens are runs of letters, marks and digits, in lower case. Bytes of letters beyond ASCII all count.
BETWEEN = separators(bytes(c for c in range(128) if not chr(c).isalnum()))
#: What parts tokens beyond ASCII, and letters of scripts without spaces, each of which is a token.
OTHER = regex.compile(r"[^\p{L}\p{M}\p{N}\x00-\x7f]")
ALONE = regex.compile(
    r"[\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}\p{Tibetan}]\p{M}*"
)
#: Bytes of benchmark text that are searched for in one pass over the documents.
BLOCK_BYTES = 8_000_000

MATCH = StructType(
    [
        StructField("item", LongType()),
        StructField("coverage", DoubleType()),
        StructField("tiled_tokens", LongType()),
        StructField("longest_tile", LongType()),
    ]
)


def token_hashes(text: str | None) -> np.ndarray:
    text = (text or "").lower()
    if not text.isascii():
        text = ALONE.sub(r" \g<0> ", OTHER.sub(" ", text))
    data = np.frombuffer(text.encode(), np.uint8)
    return word_hashes(data, *word_bounds(data, BETWEEN))


def tiles(text: list, item: list, shortest: int) -> list[tuple[int, int, int]]:
    """:func:`tiled` for lists; None in ``text`` matches nothing."""
    blocked = np.array([t is None for t in text], bool)
    values = np.array([0 if t is None else t for t in text], np.uint64)
    return tiled(values, blocked, np.array(item, np.uint64), shortest)


def tiled(text: np.ndarray, blocked: np.ndarray, item: np.ndarray, shortest: int) -> list[tuple[int, int, int]]:
    """Non-overlapping matches (start in text, start in item, length), longest first.

    Running Karp-Rabin greedy string tiling: hashes of all unmarked windows of one length tell
    whether a match of that length is left, and halving finds the greatest such length. The matches
    of that length are marked, the leftmost first, and the search goes on with shorter ones. A match
    is compared token by token before it is marked. Each length costs a number of steps linear in
    both texts, also where one token stands many times, and lengths add up to the item's at most.
    """
    marked, taken, found = blocked.copy(), np.zeros(len(item), bool), []
    most = min(len(text), len(item))
    while most >= shortest:
        length = longest_shared(text, marked, item, taken, shortest, most)
        if not length:
            break
        found += marked_matches(text, marked, item, taken, length)
        most = length - 1
    return found


def free_windows(values: np.ndarray, marked: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts and hashes of the windows without a mark."""
    before = np.r_[0, np.cumsum(marked)]
    starts = np.flatnonzero(before[length:] == before[:-length])
    return starts, window_hashes(values, length)[starts]


def longest_shared(text, marked, item, taken, shortest: int, most: int) -> int:
    """The greatest length up to ``most`` at which both have a free window of equal hash, or 0."""

    def shared(length: int) -> bool:
        own = free_windows(item, taken, length)[1]
        return bool(len(own)) and bool(np.isin(own, free_windows(text, marked, length)[1]).any())

    if not shared(shortest):
        return 0
    low, high = shortest, most + 1
    if shared(most):
        return most
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if shared(middle) else (low, middle)
    return low


def marked_matches(text, marked, item, taken, length: int) -> list[tuple[int, int, int]]:
    """Mark the matches of one length, the longest there are: by their place in the text, then the item.

    Places of the item that marks have reached are passed over for good, so each is looked at once.
    """
    own, own_hashes = free_windows(item, taken, length)
    places: dict[int, deque] = {}
    for b, value in zip(own.tolist(), own_hashes.tolist()):
        places.setdefault(value, deque()).append(b)
    starts, hashes = free_windows(text, marked, length)
    meet = np.isin(hashes, own_hashes)
    found, end = [], 0
    for a, value in zip(starts[meet].tolist(), hashes[meet].tolist()):
        if a < end:
            continue
        left = places[value]
        while left and taken[left[0] : left[0] + length].any():
            left.popleft()
        for b in left:
            if not taken[b : b + length].any() and np.array_equal(text[a : a + length], item[b : b + length]):
                end = a + length
                marked[a:end] = taken[b : b + length] = True
                found.append((a, b, length))
                break
    return found


@dataclass(frozen=True)
class SeedIndex:
    """The items of a block: their tokens, and their windows of ``seed`` tokens by hash.

    Items of fewer tokens are kept by their number of tokens, with one hash each.
    """

    seed: int
    items: list[tuple[int, np.ndarray]]
    hashes: np.ndarray
    owners: np.ndarray
    places: np.ndarray
    short: dict[int, tuple[np.ndarray, np.ndarray]]

    @staticmethod
    def of(rows: list[tuple[int, str | None]], seed: int) -> SeedIndex:
        items, hashes, owners, places = [], [np.zeros(0, np.uint64)], [], []
        short: dict[int, list[tuple[int, int]]] = {}
        for number, text in sorted(rows, key=lambda r: (r[0], r[1] or "")):
            tokens = token_hashes(text)
            if not len(tokens):
                continue
            if len(tokens) < seed:
                whole = int(window_hashes(tokens, len(tokens))[0])
                short.setdefault(len(tokens), []).append((whole, len(items)))
            else:
                windows = window_hashes(tokens, seed)
                owners += [len(items)] * len(windows)
                places += range(len(windows))
                hashes.append(windows)
            items.append((number, tokens))
        found = np.concatenate(hashes)
        order = np.argsort(found, kind="stable")
        by_length = {
            n: (np.array([h for h, _ in sorted(some)], np.uint64), np.array([k for _, k in sorted(some)]))
            for n, some in short.items()
        }
        return SeedIndex(
            seed, items, found[order], np.array(owners, np.int64)[order],
            np.array(places, np.int64)[order], by_length,
        )

    def search(self, texts: list[str | None], least: float) -> list[list[dict]]:
        """For each text the items of which tiles cover a share of ``least`` or more."""
        return [self._search(token_hashes(t), least) for t in texts]

    def _search(self, tokens: np.ndarray, least: float) -> list[dict]:
        found = self.whole_items(tokens)
        for owner, (values, blocked) in self.candidates(tokens, least).items():
            item = self.items[owner][1]
            sizes = [size for _, _, size in tiled(values, blocked, item, self.seed)]
            if sizes and sum(sizes) >= least * len(item):
                found[owner] = sizes
        return [
            {
                "item": self.items[owner][0],
                "coverage": sum(sizes) / len(self.items[owner][1]),
                "tiled_tokens": sum(sizes),
                "longest_tile": max(sizes),
            }
            for owner, sizes in sorted(found.items())
        ]

    def whole_items(self, tokens: np.ndarray) -> dict[int, list[int]]:
        """Items shorter than a seed that stand in a text as they are, with their one tile."""
        found = {}
        for length, (hashes, owners) in self.short.items():
            windows = window_hashes(tokens, length)
            for k in np.flatnonzero(np.isin(hashes, windows)).tolist():
                item = self.items[owners[k]][1]
                starts = np.flatnonzero(windows == hashes[k]).tolist()
                if any(np.array_equal(tokens[a : a + length], item) for a in starts):
                    found[int(owners[k])] = [length]
        return found

    def candidates(self, tokens: np.ndarray, least: float) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """By item: the runs of a text that its seeds cover, one after another with blocks between.

        Tiles consist of seeds, so what no seed covers cannot be tiled; items that seeds cannot
        cover enough of are left out.
        """
        windows = window_hashes(tokens, self.seed)
        if not len(windows) or not len(self.hashes):
            return {}
        seen, inverse = np.unique(windows, return_inverse=True)
        first = np.searchsorted(self.hashes, seen, "left")
        last = np.searchsorted(self.hashes, seen, "right")
        hits = np.flatnonzero(first < last)
        if not len(hits):
            return {}
        counts = last[hits] - first[hits]
        entries = np.repeat(first[hits] - (np.cumsum(counts) - counts), counts) + np.arange(counts.sum())
        owners, seeds = self.owners[entries], np.repeat(hits, counts)
        order = np.argsort(owners, kind="stable")
        entries, owners, seeds = entries[order], owners[order], seeds[order]
        cuts = np.r_[np.flatnonzero(np.r_[True, owners[1:] != owners[:-1]]), len(owners)]
        found = {}
        for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
            owner = int(owners[a])
            item = self.items[owner][1]
            if spread(self.places[entries[a:b]], self.seed, len(item)).sum() < least * len(item):
                continue
            shared = np.zeros(len(seen), bool)
            shared[seeds[a:b]] = True
            covered = spread(np.flatnonzero(shared[inverse]), self.seed, len(tokens))
            places = np.flatnonzero(covered)
            gaps = np.flatnonzero(np.diff(places) > 1) + 1
            values = np.insert(tokens[places], gaps, 0)
            blocked = np.insert(np.zeros(len(places), bool), gaps, True)
            found[owner] = values, blocked
        return found


def spread(starts: np.ndarray, length: int, size: int) -> np.ndarray:
    """Which of ``size`` places lie within ``length`` places from one of the starts on."""
    steps = np.bincount(starts, minlength=size + 1) - np.bincount(starts + length, minlength=size + 1)
    return np.cumsum(steps)[:size] > 0


def seed_indexes(benchmark: DataFrame, item: str = "item_id", text: str = "text", seed: int = 5):
    """The benchmark in blocks of :data:`BLOCK_BYTES` or a little more, one at a time.

    A benchmark of any size is searched: a larger one takes more passes over the documents.
    """
    rows = benchmark.select(F.col(quoted(item)).cast("long").alias("item"), F.col(quoted(text)).alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = 1 + size // BLOCK_BYTES
    block = F.pmod(F.xxhash64("item", "text"), F.lit(blocks))
    for k in range(blocks):
        some = rows.where((block == k) & F.col("item").isNotNull() & F.col("text").isNotNull())
        yield SeedIndex.of([tuple(r) for r in some.collect()], seed)


def contaminations(
    df: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    seed: int = 5,
    min_coverage: float = 0.5,
) -> DataFrame:
    """Pairs of a document and a benchmark item that it gives away.

    Runs of ``seed`` tokens that both share are the seeds. Where they could cover enough of the
    item, greedy string tiling covers it with the longest matches of ``seed`` tokens or more, in
    any order, so passages moved about are found too. A pair is returned if tiles cover
    ``min_coverage`` of the item's tokens: key, item, ``coverage``, ``tiled_tokens``,
    ``longest_tile`` and ``contaminated`` (true).

    Tokens are runs of letters and digits without regard to case; in scripts without spaces each
    letter is one. An item of fewer than ``seed`` tokens is given away by a document that holds all
    of them side by side. Texts without a token match nothing; items with a null key are left out. Repeated rows of either table give a pair each. Keys of documents may be null, other
    columns are not read, and an empty table on either side gives an empty result. Documents are
    not shuffled; the benchmark goes to the tasks in blocks of bounded size.
    """
    source = df.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text"))
    pairs = None
    for index in seed_indexes(benchmark, item, item_text, seed):
        def make(texts, index=index):
            return [index.search(texts, min_coverage)]

        found = append_columns(source, "text", [StructField("found", ArrayType(MATCH))], make, ["key"])
        found = found.select("key", F.inline("found"))
        pairs = found if pairs is None else pairs.unionAll(found)
    return pairs.select(
        F.col("key").alias(key),
        F.col("item").alias(item),
        "coverage",
        "tiled_tokens",
        "longest_tile",
        F.lit(True).alias("contaminated"),
    )


def without_contaminated(
    df: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    seed: int = 5,
    min_coverage: float = 0.5,
) -> DataFrame:
    """The documents that give no item away, with all their columns; see :func:`contaminations`."""
    mark = "found by the operator"
    columns = df.columns
    for index in seed_indexes(benchmark, item, item_text, seed):
        def make(texts, index=index):
            return [["x" if found else None for found in index.search(texts, min_coverage)]]

        df = append_columns(df, text, [StructField(mark, StringType())], make)
        df = df.where(F.col(quoted(mark)).isNull()).select(*[quoted(c) for c in columns])
    return df
