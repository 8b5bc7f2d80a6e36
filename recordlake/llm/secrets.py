"""Secrets in texts: fixed patterns, and character Markov models for random strings."""

from __future__ import annotations

import re
from collections.abc import Callable
from dataclasses import dataclass
from hashlib import sha256
from itertools import accumulate

import numpy as np
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField

from recordlake.llm.batches import append_columns, quoted, stored

#: The patterns, and the lengths from which a match counts.
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    re.IGNORECASE | re.ASCII,
)
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN_LENGTH = 12
ACCESS = re.compile("AKIA[A-Z0-9]{14,}")
HEX = re.compile("[0-9a-f]{16,}")
KINDS = ("assign", "access", "hex", "random")

#: What the models judge: segments of runs of these characters, of this length at least.
LEAST = 16
CANDIDATE = re.compile("[A-Za-z0-9+/_=-]{%d,}" % LEAST)
#: Identifiers and words of this length teach the model of ordinary strings.
SAMPLED = re.compile("[A-Za-z0-9_-]{8,}")
#: Strings of each label that the models are trained on, and the most characters of one.
SAMPLE_SIZE = 20_000
SAMPLE_LENGTH = 128

_CLASSES = np.zeros(256, np.int64)
for _i, _c in enumerate(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-."):
    _CLASSES[_c] = _i + 1
_STATES = 69


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """Start, end and kind of what the fixed patterns find, leftmost and without overlap per kind."""
    spans = []
    lower = text.lower()
    if any(w in lower for w in ASSIGN_WORDS):
        # A short value hides what it overlaps, so its length is judged after the search.
        for m in ASSIGN.finditer(text):
            if len(m[2]) >= ASSIGN_LENGTH:
                spans.append((m.start(), m.end(), "assign"))
    if "AKIA" in text:
        spans += [(*m.span(), "access") for m in ACCESS.finditer(text)]
    return spans + [(*m.span(), "hex") for m in HEX.finditer(text)]


@dataclass(frozen=True)
class MarkovModels:
    """Log-likelihood ratios, random against ordinary, of a character after another."""

    ratios: np.ndarray
    threshold: float

    def steps(self, strings: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ratio of every character after the one before it, and where each string begins.

        The strings are ASCII and not empty.
        """
        states = _CLASSES[np.frombuffer("".join(strings).encode(), np.uint8)]
        starts = np.zeros(len(strings), np.int64)
        np.cumsum([len(s) for s in strings[:-1]], out=starts[1:])
        before = np.r_[0, states[:-1]]
        before[starts] = 0
        return self.ratios[before, states], starts

    def scores(self, strings: list[str]) -> np.ndarray:
        """The log-likelihood ratio of each string."""
        steps, starts = self.steps(strings)
        return np.add.reduceat(steps, starts)

    def segments(self, strings: list[str]) -> list[list[tuple[int, int]]]:
        """For each string its segments (start, end) that are more likely random than ordinary.

        They are the segments of greatest sum (see :func:`greatest_segments`) beyond the threshold.
        One that is too short is widened to the best :data:`LEAST` characters around it; what
        overlaps then is one segment.
        """
        steps, starts = self.steps(strings)
        hopeful = np.add.reduceat(np.maximum(steps, 0), starts) > self.threshold
        found: list[list[tuple[int, int]]] = [[] for _ in strings]
        ends = np.r_[starts[1:], len(steps)]
        for k in np.flatnonzero(hopeful).tolist():
            own = steps[starts[k] : ends[k]].tolist()
            before = [0.0, *accumulate(own)]
            for a, b, _ in greatest_segments(own):
                a, b = widened(a, b, before)
                if b - a < LEAST or before[b] - before[a] <= self.threshold:
                    continue
                while found[k] and a < found[k][-1][1]:
                    x, y = found[k].pop()
                    a, b = min(a, x), max(b, y)
                found[k].append((a, b))
        return found


def widened(start: int, end: int, before: list[float]) -> tuple[int, int]:
    """A segment of :data:`LEAST` characters or more: itself, or the best that holds it."""
    n = len(before) - 1
    if end - start >= LEAST or n < LEAST:
        return start, end
    starts = range(max(0, end - LEAST), min(start, n - LEAST) + 1)
    best = max(starts, key=lambda s: (before[s + LEAST] - before[s], -s))
    return best, best + LEAST


def greatest_segments(steps: list[float]) -> list[tuple[int, int, float]]:
    """All disjoint segments of greatest sum, from left to right, in one pass: start, end, sum.

    The first is the segment of greatest sum of all, the others are those of what is left on
    either side of it, and so on; each begins and ends with a rise.
    """
    # Start, end, sum before, sum at the end, and the last one before that begins lower.
    held: list[tuple[int, int, float, float, int]] = []
    total = 0.0
    for i, step in enumerate(steps):
        before, total = total, total + step
        if step <= 0:
            continue
        start, low = i, before
        while True:
            # The last segment that begins lower than this one does.
            k = len(held) - 1
            while k >= 0 and held[k][2] >= low:
                k = held[k][4]
            if k < 0 or held[k][3] >= total:
                held.append((start, i + 1, low, total, k))
                break
            start, low = held[k][0], held[k][2]
            del held[k:]
    return [(a, b, high - low) for a, b, low, high, _ in held]


def transitions(strings: list[str]) -> np.ndarray:
    """Smoothed probabilities of a character after another; 0 stands for the start."""
    counts = np.full((_STATES, _STATES), 0.5)
    for s in strings:
        states = _CLASSES[np.frombuffer(s.encode("ascii", "replace"), np.uint8)]
        np.add.at(counts, (np.r_[0, states[:-1]], states), 1)
    return counts / counts.sum(1, keepdims=True)


def train(samples: DataFrame, text: str = "text", label: str = "is_secret", threshold: float = 8.0) -> MarkovModels:
    """Train both models on labelled strings: ``label`` is true for random ones.

    The samples come to the driver, so the caller bounds them (see :func:`labelled_samples`).
    Rows with a null text or label are left out. A class without samples has the model that
    finds every character equally likely.
    """
    strings_, labels = F.col(quoted(text)), F.col(quoted(label))
    rows = samples.select(strings_, labels).where(strings_.isNotNull() & labels.isNotNull()).collect()
    # In a fixed order, though sums of whole numbers do not depend on it.
    strings = {kind: sorted(r[0] for r in rows if r[1] is kind) for kind in (True, False)}
    ratios = np.log(transitions(strings[True])) - np.log(transitions(strings[False]))
    return MarkovModels(ratios, threshold)


def labelled_samples(df: DataFrame, text: str = "text", size: int = SAMPLE_SIZE) -> DataFrame:
    """``size`` strings at most of each label, found in the texts themselves.

    What the fixed patterns find is labelled as secret, other words and identifiers as
    ordinary. Each task keeps the strings with the smallest hashes, and so does the final
    choice: an even sample of the distinct strings, the same on every run.
    """

    def run(batches):
        kept: dict[bool, dict[str, int]] = {True: {}, False: {}}
        most = {True: 1 << 64, False: 1 << 64}
        for batch in batches:
            for value in batch.column(0).to_pylist():
                secrets, ordinary = strings_of(value or "")
                for label, found in ((True, secrets), (False, ordinary)):
                    keep, limit = kept[label], most[label]
                    for s in found:
                        if s not in keep and (h := xxhash.xxh64_intdigest(s)) < limit:
                            keep[s] = h
                    if len(keep) > 2 * size:
                        kept[label] = keep = dict(sorted(keep.items(), key=lambda x: (x[1], x[0]))[:size])
                        most[label] = max(keep.values())
        import pyarrow as pa

        for label, keep in kept.items():
            chosen = sorted(keep.items(), key=lambda x: (x[1], x[0]))[:size]
            yield pa.RecordBatch.from_pydict(
                {"text": [s for s, _ in chosen], "is_secret": [label] * len(chosen)},
                schema=pa.schema([("text", pa.string()), ("is_secret", pa.bool_())]),
            )

    # One pass over the texts; both labels are chosen from what it kept.
    found = df.select(F.col(quoted(text)).alias("text")).mapInArrow(run, "text string, is_secret boolean")
    found = stored(found.distinct(), "labelled-strings")
    chosen = [
        found.where(F.col("is_secret") == label).orderBy(F.xxhash64("text"), "text").limit(size)
        for label in (True, False)
    ]
    return chosen[0].unionAll(chosen[1])


def strings_of(text: str) -> tuple[list[str], list[str]]:
    """Strings of a text that are labelled as secret, and those labelled as ordinary."""
    secrets, ordinary, spans = [], [], sorted(base_spans(text))
    for start, end, kind in spans:
        found = text[start:end]
        if kind == "assign":
            found = ASSIGN.fullmatch(found)[2]
        secrets.append(found[:SAMPLE_LENGTH])
    at = 0
    for start, end, _ in [*spans, (len(text), len(text), "")]:
        if start > at:
            ordinary += [s[:SAMPLE_LENGTH] for s in SAMPLED.findall(text, at, start)]
        at = max(at, end)
    return secrets, ordinary


def judged_pieces(text: str, base: list[tuple[int, int, str]]) -> list[tuple[int, int]]:
    """Runs of candidate characters without what the fixed patterns found, where long enough."""
    pieces, spans = [], sorted((a, b) for a, b, _ in base)
    for m in CANDIDATE.finditer(text):
        at, stop = m.span()
        for a, b in spans:
            if b <= at or a >= stop:
                continue
            if a - at >= LEAST:
                pieces.append((at, a))
            at = max(at, b)
        if stop - at >= LEAST:
            pieces.append((at, stop))
    return pieces


def found_spans(texts: list[str | None], models: MarkovModels) -> list[list[tuple[int, int, str]]]:
    """All spans of each text, by start and then kind; the models add to the fixed patterns.

    The models judge what the patterns leave of a run, and mark the segments that look random:
    neither a path before a key nor a span of the patterns beside it hides the key.
    """
    spans, strings, places = [], [], []
    for k, text in enumerate(texts):
        spans.append(base_spans(text or ""))
        for a, b in judged_pieces(text or "", spans[k]):
            strings.append(text[a:b])
            places.append((k, a))
    if strings:
        for (k, at), segments in zip(places, models.segments(strings)):
            spans[k] += [(at + a, at + b, "random") for a, b in segments]
    return [sorted(s, key=lambda x: (x[0], KINDS.index(x[2]))) for s in spans]


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for start, end, kind in spans)


def secret_spans(df: DataFrame, models: MarkovModels, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """Find the secrets of every text.

    Adds to the ``keep`` columns (all): ``n_assign``, ``n_access``, ``n_hex``, ``n_random``,
    ``base_sha256`` (over the spans of the fixed patterns) and ``spans``, a list
    ``kind:start:end`` by start, joined by commas, in code points, the end exclusive. A null
    text counts as empty: no spans. Repeated rows are scanned each, an empty table stays
    empty, a column with a new column's name is replaced, and texts are scanned whole.
    """
    fields = [
        *[StructField(f"n_{kind}", LongType()) for kind in KINDS],
        StructField("base_sha256", StringType()),
        StructField("spans", StringType()),
    ]

    def make(texts):
        found = found_spans(texts, models)
        base = [[s for s in spans if s[2] != "random"] for spans in found]
        return [
            *[[sum(s[2] == kind for s in spans) for spans in found] for kind in KINDS],
            [sha256(joined(s).encode()).hexdigest() for s in base],
            [joined(s) for s in found],
        ]

    return append_columns(df, text, fields, make, keep)


def redactor(models: MarkovModels, mark: str = "<secret>") -> Callable[[list], list]:
    """A function that puts ``mark`` in place of every secret of the texts of a list."""

    def redact(texts):
        made = []
        for text, spans in zip(texts, found_spans(texts, models)):
            if spans:
                parts, at = [], 0
                for start, end, _ in spans:
                    if start >= at:
                        parts += [text[at:start], mark]
                    at = max(at, end)
                text = "".join([*parts, text[at:]])
            made.append(text)
        return made

    return redact


def without_secrets(df: DataFrame, models: MarkovModels, text: str = "text") -> DataFrame:
    """The same rows and columns, with a mark in place of every secret. Null stays null."""
    redact = redactor(models)
    made = append_columns(df, text, [StructField(text, StringType())], lambda texts: [redact(texts)])
    return made.select(*[quoted(c) for c in df.columns])
