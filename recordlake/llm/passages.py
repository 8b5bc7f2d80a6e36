"""Substring dedup: passages that stand elsewhere too, located by word automata."""

from __future__ import annotations

from hashlib import sha256
from math import ceil, sqrt

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm.batches import quoted, row_keys, steps
from recordlake.llm.words import SPACES, separators, window_hashes, word_bounds, word_hashes

BETWEEN = separators(SPACES)
#: Text of the documents that share an automaton, in bytes; more for more than 60 GB of input.
SHARD_BYTES = 4_000_000
STEP_BYTES = 2_000_000


def shard_count(total_bytes: int) -> int:
    """Shards of documents, and shards of hashes.

    Every shard of the one kind has a message for every shard of the other, so shards grow with
    the square root of the input when it is large.
    """
    return max(1, ceil(total_bytes / max(SHARD_BYTES, 16 * sqrt(total_bytes))))


def hashed(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of some texts, and the place behind each text's last word."""
    data = np.frombuffer(b"\n".join((t or "").encode() for t in texts), np.uint8)
    starts, ends = word_bounds(data, BETWEEN)
    sizes = np.cumsum([len((t or "").encode()) + 1 for t in texts])
    return word_hashes(data, starts, ends), np.searchsorted(starts, sizes)


def planes(values: np.ndarray) -> bytes:
    """Sorted numbers with their first bytes together, then their second: those compress well."""
    return values.view(np.uint8).reshape(-1, values.itemsize).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.frombuffer(data, np.uint8).reshape(8, -1).T.copy().view(np.uint64).ravel()


def starts_of(words: np.ndarray, ends: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Window hashes of some texts, and which of them lie within one text."""
    windows = window_hashes(words, length)
    inside = np.ones(len(windows), bool)
    for end in ends[:-1]:
        inside[max(0, end - length + 1) : end] = False
    return windows, inside


def _requests(length: int, shards: int):
    """Every window's hash, sent to the hash's shard with the shard of its document."""

    def run(batches):
        for batch in batches:
            for step in steps(batch, limit=STEP_BYTES):
                owners = step.column(1).to_numpy()
                order = np.argsort(owners, kind="stable")
                texts = step.column(0).to_pylist()
                words, ends = hashed([texts[i] for i in order])
                windows, inside = starts_of(words, ends, length)
                owner = np.repeat(owners[order], np.diff(np.r_[0, ends]))[: len(windows)][inside]
                windows = windows[inside]
                # Stable, and documents are in the order of their shards: equal hashes are too.
                by_hash = np.argsort(windows, kind="stable")
                windows, owner = windows[by_hash], owner[by_hash]
                new = np.ones(len(windows), bool)
                new[1:] = (windows[1:] != windows[:-1]) | (owner[1:] != owner[:-1])
                first = np.flatnonzero(new)
                again = np.diff(np.r_[first, len(new)]) > 1
                windows, owner = windows[first], owner[first]
                shard = (windows >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)
                cuts = np.searchsorted(shard, np.arange(shards + 1, dtype=np.uint64))
                some = [(k, cuts[k], cuts[k + 1]) for k in range(shards) if cuts[k] < cuts[k + 1]]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([k for k, _, _ in some], pa.int32()),
                        pa.array([planes(windows[a:b]) for _, a, b in some], pa.binary()),
                        pa.array([owner[a:b].astype("<i4").tobytes() for _, a, b in some], pa.binary()),
                        pa.array([np.packbits(again[a:b]).tobytes() for _, a, b in some], pa.binary()),
                    ],
                    names=["shard", "hashes", "owners", "again"],
                )

    return run


def _replies(table: pa.Table) -> pa.Table:
    """The hashes of one shard that occur twice or more, for each shard of documents that has them."""
    windows, owners, again = [], [], []
    for h, o, a in zip(*(table.column(c).to_pylist() for c in ("hashes", "owners", "again"))):
        windows.append(from_planes(h))
        owners.append(np.frombuffer(o, "<i4"))
        again.append(np.unpackbits(np.frombuffer(a, np.uint8), count=len(owners[-1])).astype(bool))
    windows, owners, again = map(np.concatenate, (windows, owners, again))
    order = np.argsort(windows, kind="stable")
    windows, owners, again = windows[order], owners[order], again[order]
    same = windows[1:] == windows[:-1]
    recurs = again
    recurs[1:] |= same
    recurs[:-1] |= same
    windows, owners = windows[recurs], owners[recurs]
    order = np.argsort(owners, kind="stable")
    windows, owners = windows[order], owners[order]
    found, first = np.unique(owners, return_index=True)
    cuts = np.r_[first, len(owners)]
    made = [planes(np.unique(windows[a:b])) for a, b in zip(cuts, cuts[1:])]
    return pa.table({"part": pa.array(found, pa.int32()), "hashes": pa.array(made, pa.binary())})


def covered_words(words: np.ndarray, ends: np.ndarray, recurring: np.ndarray, length: int) -> np.ndarray:
    """Which words of a shard's texts stand in a recurring passage.

    Runs of recurring windows make the passages. An automaton of all distinct passages of the
    shard reads every text, word by word, and marks each place where one of them stands.
    """
    windows, inside = starts_of(words, ends, length)
    at = np.minimum(np.searchsorted(recurring, windows), max(0, len(recurring) - 1))
    hit = inside & (recurring[at] == windows) if len(recurring) else np.zeros(len(windows), bool)
    covered = np.zeros(len(words) + 1, np.int64)
    if not hit.any():
        return covered[:-1] > 0
    numbers = np.unique(words, return_inverse=True)[1]
    step = np.diff(np.r_[0, hit.astype(np.int8), 0])
    firsts, lasts = np.flatnonzero(step == 1), np.flatnonzero(step == -1) + length - 1
    # Windows that cross from one text to the next are no hits, so runs end with their text.
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    for a, b in zip(firsts.tolist(), lasts.tolist()):
        automaton.add_word(tuple(numbers[a:b].tolist()), b - a)
    automaton.make_automaton()
    for a, b in zip(np.r_[0, ends[:-1]].tolist(), ends.tolist()):
        if b - a >= length:
            for last, size in automaton.iter(tuple(numbers[a:b].tolist())):
                covered[a + last + 1 - size] += 1
                covered[a + last + 1] -= 1
    return np.cumsum(covered)[:-1] > 0


RESULT = "n_words bigint, n_removed bigint, kept_text string, kept_sha256 string"


def without_repeated_passages(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    length: int = 35,
    with_text: bool = True,
) -> DataFrame:
    """Remove each word that a window of ``length`` words covers which also starts elsewhere.

    Elsewhere is any other place, in the same document or in another. Words are runs of other
    characters than space, tab, line feed, vertical tab, form feed and return, unchanged.
    Windows are judged on the input. Returns the key, ``n_words``, ``n_removed``, ``kept_text``
    (the kept words with single spaces; null unless ``with_text``) and ``kept_sha256`` of it.

    Confirming: every window's hash goes once per step of a task to the shard of its hash, which
    answers the shards of documents that asked with the hashes it has seen twice or more. So
    equal passages combine before the shuffle, and no shard depends on one passage or document.
    Locating: a shard of documents compiles the passages confirmed for it into an Aho-Corasick
    automaton and reads all its documents with it. Work and messages are linear in the text.

    A null text has no words; a document shorter than a window loses none. Repeated rows count as
    occurrences of each other. Keys may be null, other columns are not read, an empty table gives
    an empty table, and texts are read whole. Windows are of two words at least.
    """
    if length < 2:
        raise ValueError("a window has two words at least")
    source = df.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text"), *row_keys(key, text))
    size = source.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    shards = shard_count(size)
    # A shard is drawn from the row's own values: it is the same whenever the row is read.
    source = source.select(
        "text", F.pmod(F.xxhash64("key_a", "key_b"), F.lit(shards)).cast("int").alias("part"), "key"
    )
    requests = source.select("text", "part").mapInArrow(
        _requests(length, shards), "shard int, hashes binary, owners binary, again binary"
    )
    replies = requests.groupBy("shard").applyInArrow(_replies, "part int, hashes binary")

    def locate(documents: pa.Table, answers: pa.Table) -> pa.Table:
        texts = documents.column("text").to_pylist()
        words, ends = hashed(texts)
        known = [from_planes(h) for h in answers.column("hashes").to_pylist()]
        recurring = np.unique(np.concatenate([*known, np.zeros(0, np.uint64)]))
        covered = covered_words(words, ends, recurring, length)
        counts, removed, kept, digests = [], [], [], []
        for t, a, b in zip(texts, np.r_[0, ends[:-1]], ends):
            own, gone = (t or "").encode().split(), covered[a:b]
            counts.append(len(own))
            removed.append(int(gone.sum()))
            rest = b" ".join(own if not removed[-1] else [own[i] for i in np.flatnonzero(~gone)])
            kept.append(rest.decode() if with_text else None)
            digests.append(sha256(rest).hexdigest())
        return pa.table(
            {
                "key": documents.column("key"),
                "n_words": pa.array(counts, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "kept_text": pa.array(kept, pa.string()),
                "kept_sha256": pa.array(digests, pa.string()),
            }
        )

    key_type = source.schema["key"].dataType.simpleString()
    found = source.groupBy("part").cogroup(replies.groupBy("part")).applyInArrow(
        locate, f"key {key_type}, {RESULT}"
    )
    return found.withColumnRenamed("key", key)
