"""Periodic runs: stretches of words that repeat with a fixed period, by seeds on diagonals.

A run of period q matches itself q words later, on the diagonal of lag q. Of the run's length at
least ``min_exponent`` periods, all but one lie on that diagonal, so it holds a seed: a k-gram whose
next occurrence in the same document is q words on.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from recordlake.llm.batches import append_columns
from recordlake.llm.words import SPACES

RUN = StructType([StructField(name, LongType()) for name in ("start", "length", "period")])


def seed_length(low: int, high: int, min_length: int, min_exponent: int) -> int:
    """The shortest self-overlap of runs whose period lies in [low, high)."""
    middle = min_length // min_exponent
    periods = {low, high - 1, *(p for p in (middle, middle + 1) if low <= p < high)}
    return min(max(min_length - p, (min_exponent - 1) * p) for p in periods)


def numbered(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Equal numbers for equal keys, and whether a key occurs twice or more."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    first = np.r_[True, ordered[1:] != ordered[:-1]]
    group = np.cumsum(first) - 1
    names = np.empty(len(keys), np.int64)
    names[order] = group
    return names, (np.bincount(group) > 1)[names]


class Grams:
    """Exact names of the k-grams of a sequence, for those that occur twice or more.

    The name of a gram comes from the names of its two halves, so equal names mean equal words.
    Both halves of a recurring gram recur, so only such places go on to the next length; where no
    gram recurs any more, none of a greater length does.
    """

    def __init__(self, symbols: np.ndarray):
        self.count, self.length = len(symbols), 1
        names, recurs = numbered(symbols)
        self.names = np.where(recurs, names, -1)

    def pairs(self, shift: int) -> tuple[np.ndarray, np.ndarray]:
        """Places of recurring grams of ``length + shift`` words, and their names."""
        here, there = self.names[: self.count - shift], self.names[shift:]
        places = np.flatnonzero((here >= 0) & (there >= 0))
        if not len(places):
            return places, places
        names, recurs = numbered(here[places] * self.count + there[places])
        return places[recurs], names[recurs]

    def reach(self, length: int) -> bool:
        """Double the length while it fits; false if no gram of it recurs."""
        while 2 * self.length <= length:
            places, names = self.pairs(self.length)
            self.names = np.full(self.count, -1, np.int64)
            self.names[places] = names
            self.length *= 2
            if not len(places):
                return False
        return True

    def of_length(self, length: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and names of recurring grams: two overlapping grams of the doubled length."""
        return self.pairs(length - self.length)


def extended(symbols: np.ndarray, start: int, end: int, lag: int) -> tuple[int, int]:
    """The longest stretch around [start, end) whose words equal those ``lag`` words on."""
    last, size = len(symbols) - lag, 32
    while end < last:
        stop = min(last, end + size)
        differ = np.flatnonzero(symbols[end:stop] != symbols[end + lag : stop + lag])
        if len(differ):
            end += int(differ[0])
            break
        end, size = stop, 2 * size
    size = 32
    while start > 0:
        stop = max(0, start - size)
        differ = np.flatnonzero(symbols[stop:start] != symbols[stop + lag : start + lag])
        if len(differ):
            start = stop + int(differ[-1]) + 1
            break
        start, size = stop, 2 * size
    return start, end


def runs_of(symbols: np.ndarray, min_length: int, min_exponent: int) -> Iterator[tuple[int, int, int]]:
    """All runs of a sequence of numbers: start, length, period, in no order.

    Lags are taken by octaves. Within an octave every run has a seed of its shortest overlap, and
    such a seed is longer than the lag: in a run of smallest period q it can recur no sooner than q
    words on. So the pair of an occurrence and the next one is all that is looked at, a number of
    pairs that is linear in the words however often a gram occurs.
    """
    if min_exponent < 3 or min_length < 1:
        raise ValueError("runs need three periods at least, and a length")
    grams, high, unique = Grams(symbols), 1, len(symbols) + 1
    while max(min_length, min_exponent * high) <= len(symbols):
        low, high = high, 2 * high
        k = seed_length(low, high, min_length, min_exponent)
        if k >= unique:
            continue
        if k < grams.length:  # only where min_length is large: long seeds of short periods
            grams = Grams(symbols)
        if not grams.reach(k):
            unique = grams.length
            continue
        places, names = grams.of_length(k)
        order = np.lexsort((places, names))
        places, names = places[order], names[order]
        lags = np.diff(places)
        seeds = np.flatnonzero((names[1:] == names[:-1]) & (lags >= low) & (lags < high))
        places, lags = places[seeds], lags[seeds]
        order = np.lexsort((places, lags))
        places, lags = places[order], lags[order]
        # Seeds one word apart on a diagonal are one piece of it.
        fresh = np.flatnonzero(np.r_[True, (np.diff(places) != 1) | (np.diff(lags) != 0)][: len(places)])
        covered: dict[int, int] = {}
        for first, after in zip(fresh.tolist(), [*fresh[1:].tolist(), len(places)]):
            place, lag = int(places[first]), int(lags[first])
            if place < covered.get(lag, 0):
                continue  # its stretch is known already
            start, end = extended(symbols, place, place + (after - first - 1) + k, lag)
            covered[lag] = end
            length = end - start + lag
            if length >= max(min_length, min_exponent * lag):
                yield start, length, lag


def runs_of_texts(
    words: list[list[bytes]], min_length: int, min_exponent: int
) -> list[list[tuple[int, int, int]]]:
    """The runs of each text by start, then period; no run spans two texts."""
    symbols, sizes, used = [], [], 0
    for some in words:
        known: dict[bytes, int] = {}
        symbols += [known.setdefault(w, used + len(known)) for w in some]
        used += len(known)
        sizes.append(len(some))
    starts = np.cumsum([0, *sizes])
    found: list[list[tuple[int, int, int]]] = [[] for _ in words]
    for start, length, period in runs_of(np.array(symbols, np.int64), min_length, min_exponent):
        k = int(np.searchsorted(starts, start, "right")) - 1
        found[k].append((start - int(starts[k]), length, period))
    return [sorted(runs, key=lambda r: (r[0], r[2])) for runs in found]


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> str:
    """The words that no run holds after its first period, joined by one space."""
    if runs:
        keep = np.ones(len(words), bool)
        for start, length, period in runs:
            keep[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(keep).tolist()]
    return b" ".join(words).decode()


def with_periodic_runs(
    df: DataFrame,
    text: str | Column = "text",
    keep: list[str] | None = None,
    min_length: int = 6,
    min_exponent: int = 4,
) -> DataFrame:
    """Add the periodic runs of every text, and the text with each run cut to its first period.

    Words are what stands between space, tab, line feed, vertical tab, form feed and carriage
    return, numbered from 0. A run is a stretch of words with smallest period q, at least
    ``min_length`` and ``min_exponent * q`` words long (an exponent of three or more), that no
    neighbouring word extends. ``runs`` holds start, length and period of each by start, then
    period; ``collapsed`` the words that no run holds after its first period, joined by spaces.

    ``text`` is a column's name or an expression. A null or empty text, or one of white space, has
    no runs and an empty ``collapsed``. Repeated rows are searched each, an empty table stays
    empty, and a column with a new column's name is replaced. A text is searched whole and by
    itself: n words take in the order of n log n steps, also if they are one word n times.
    """
    fields = [
        StructField("runs", ArrayType(RUN, False)),
        StructField("collapsed", StringType()),
    ]

    def make(texts):
        words = [(t or "").encode().split() for t in texts]
        found = runs_of_texts(words, min_length, min_exponent)
        rows = [[dict(zip(RUN.names, run)) for run in runs] for runs in found]
        return [rows, list(map(collapsed, words, found))]

    return append_columns(df, text, fields, make, keep)


def run_digests(df: DataFrame) -> DataFrame:
    """Number of runs, the longest of them, and digests, from :func:`with_periodic_runs`.

    Adds ``n_runs``; ``start``, ``length``, ``period`` and ``exponent_milli`` of the longest run
    (ties: smallest start, then period; nulls without runs); ``runs_sha256`` over a line
    ``start,length,period`` per run; ``collapsed_sha256``. Takes ``runs`` and ``collapsed`` away.
    """
    ranked = F.transform(
        "runs", lambda r: F.struct((-r["length"]).alias("longest"), r["start"], r["period"], r["length"])
    )
    best = F.array_min(ranked)
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    new = {
        "n_runs": F.size("runs").cast("bigint"),
        "start": best["start"],
        "length": best["length"],
        "period": best["period"],
        "exponent_milli": F.floor(1000 * best["length"] / best["period"]).cast("bigint"),
        "runs_sha256": F.sha2(F.array_join(F.transform(lines, lambda x: F.concat(x, F.lit("\n"))), ""), 256),
        "collapsed_sha256": F.sha2(F.col("collapsed"), 256),
    }
    return df.withColumns(new).drop("runs", "collapsed")


def words_of(text: Column) -> Column:
    """The words of a text as an array, in built-in functions."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), "[" + SPACES.decode() + "]+"), "")


def planted(text: Column, key: Column) -> Column:
    """A text in which one key in ten, chosen by its CRC-32, has a periodic end.

    With h the CRC-32 of the key as text, g = h // 10 and n words: if h is divisible by ten and n is
    not 0, every word i >= a becomes word a + (i - a) % p, where a = g % n and
    p = 1 + (n - a) // (3 + g % 8). All other texts, and those with a null key, stay as they are.
    """
    number = F.crc32(key.cast("string").cast("binary"))
    g = F.floor(number / 10).cast("bigint")

    def changed(words: Column) -> Column:
        n = F.size(words)
        a = F.pmod(g, F.greatest(n, F.lit(1))).cast("int")
        p = (1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))).cast("int")
        parts = F.struct(words.alias("words"), a.alias("a"), p.alias("p"))
        made = F.transform(
            F.array(parts),
            lambda s: F.array_join(
                F.transform(
                    s["words"],
                    lambda word, i: F.when(
                        i >= s["a"], F.get(s["words"], s["a"] + F.pmod(i - s["a"], s["p"]))
                    ).otherwise(word),
                ),
                " ",
            ),
        )
        return made[0]

    whole = F.transform(F.array(words_of(text)), changed)[0]
    return F.when(F.pmod(number, F.lit(10)) == 0, whole).otherwise(text)
