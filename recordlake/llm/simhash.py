"""SimHash near-duplicates, found by the generalised pigeonhole principle."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField

from recordlake.llm.batches import append_columns, quoted, row_keys, stored
from recordlake.llm.components import components
from recordlake.llm.words import LOWER

BITS = 64
SEED = 42
#: Distinct fingerprints that the driver looks at to group bits and to estimate candidates.
SAMPLE_SIZE = 2048
#: Fingerprints of a bucket that are compared in one piece; larger buckets are cut into blocks.
#: A bucket of n blocks deals out each row n times, so blocks are as large as one task can compare
#: in seconds; they take well under a megabyte.
BLOCK = 8192
#: Relative costs of dealing out a fingerprint once and of comparing a pair.
ROW_COST, PAIR_COST = 2.0, 0.005


def fingerprint(text: str | None, shingle: int) -> int:
    """The 64-bit fingerprint of a text's word shingles."""
    words = (text or "").encode().translate(LOWER).split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.r_[0, ends[:-1] + 1]
    count = max(1, len(words) - shingle + 1)
    total = np.zeros(BITS, np.int64)
    digest, step = xxhash.xxh64_intdigest, 1 << 15
    last = ends[min(shingle, len(words)) - 1 :]
    for first in range(0, count, step):
        bounds = zip(starts[first : min(first + step, count)].tolist(), last[first : first + step].tolist())
        hashes = np.array([digest(line[a:b], SEED) for a, b in bounds], "<u8")
        total += bit_counts(hashes)
    return int(np.packbits(2 * total > count, bitorder="little").view("<u8")[0])


def bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit."""
    bits = np.unpackbits(hashes.view(np.uint8), bitorder="little").reshape(-1, BITS)
    return bits.sum(0, dtype=np.int64)


def signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def fingerprints(
    df: DataFrame, text: str = "text", shingle: int = 4, keep: list[str] | None = None
) -> DataFrame:
    """Add the fingerprint of every text as a long (``fingerprint``) to the ``keep`` columns (all)."""

    def make(texts):
        return [[signed(fingerprint(t, shingle)) for t in texts]]

    return append_columns(df, text, [StructField("fingerprint", LongType())], make, keep)


@dataclass(frozen=True)
class Part:
    """Some bit positions, and how many of them may differ for a pair to meet here."""

    bits: tuple[int, ...]
    threshold: int


def correlated_groups(sample: np.ndarray, parts: int) -> list[tuple[int, ...]]:
    """Cut the bit positions into parts of like size; bits that agree often go together."""
    bits = (sample[:, None] >> np.arange(BITS, dtype=np.uint64)) & np.uint64(1)
    bits = bits.astype(float) - bits.mean(0)
    spread = np.sqrt((bits**2).mean(0)) + 1e-9
    likeness = np.abs((bits.T @ bits) / len(bits) / np.outer(spread, spread))
    np.fill_diagonal(likeness, 0)
    free, groups = list(range(BITS)), []
    for k in range(parts):
        size = len(free) // (parts - k)
        group = [max(free, key=lambda b: (likeness[b, free].max(), -b))]
        free.remove(group[0])
        while len(group) < size:
            group.append(max(free, key=lambda b: (likeness[b, group].sum(), -b)))
            free.remove(group[-1])
        groups.append(tuple(sorted(group)))
    return groups


def close_shares(sample: np.ndarray, group: tuple[int, ...], most: int) -> list[float]:
    """Estimated share of pairs that differ in at most 0, 1, ... ``most`` bits of a group.

    Counted on all pairs of the sample, or as if bits were independent, whichever is more: a
    sample shows no rare meetings.
    """
    mask = np.uint64(sum(1 << b for b in group))
    own = sample & mask
    counts = np.zeros(BITS + 1, np.int64)
    for i in range(1, len(own)):
        counts += np.bincount(np.bitwise_count(own[:i] ^ own[i]), minlength=BITS + 1)
    seen = np.cumsum(counts) / max(1, counts.sum())
    chance = np.zeros(len(group) + 1)
    chance[0] = 1
    for b in group:
        p = float(((sample >> np.uint64(b)) & np.uint64(1)).mean())
        chance[1:] = chance[1:] * (1 - 2 * p * (1 - p)) + chance[:-1] * 2 * p * (1 - p)
        chance[0] *= 1 - 2 * p * (1 - p)
    chance = np.cumsum(np.r_[chance, np.zeros(BITS)])
    return [float(max(seen[t], chance[t])) for t in range(most + 1)]


def partition_plan(sample: np.ndarray, total: int, max_bits: int) -> list[Part]:
    """Parts and their thresholds, with the smallest estimated work for ``total`` fingerprints.

    By the generalised pigeonhole principle, thresholds t of parts may differ as long as the
    sum of t + 1 is ``max_bits`` + 1: a pair that exceeds each of them differs in more bits. A
    part with -1 is not searched. For every number of parts, dynamic programming allots the
    thresholds; costs are the rows dealt out and the pairs expected to meet.
    """
    best: tuple[float, list[Part]] | None = None
    for parts in range(1, min(BITS, max_bits + 4) + 1):
        groups = correlated_groups(sample, parts)
        # cheapest[s]: cost and thresholds of the parts so far whose sum of t + 1 is s
        cheapest: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for group in groups:
            shares = close_shares(sample, group, max_bits)
            costs = {-1: 0.0}
            for t in range(min(max_bits, len(group)) + 1):
                ball = sum(comb(len(group), k) for k in range(t + 1))
                costs[t] = ROW_COST * total * (1 + ball) / 2 + PAIR_COST * shares[t] * total**2 / 2
            following: dict[int, tuple[float, list[int]]] = {}
            for s, (cost, chosen) in cheapest.items():
                for t, more in costs.items():
                    to = s + t + 1
                    if to <= max_bits + 1 and (to not in following or cost + more < following[to][0]):
                        following[to] = (cost + more, [*chosen, t])
            cheapest = following
        if (found := cheapest.get(max_bits + 1)) and (best is None or found[0] < best[0]):
            best = (found[0], [Part(g, t) for g, t in zip(groups, found[1]) if t >= 0])
    return best[1]


@dataclass(frozen=True)
class Closeness:
    """When two rows of fingerprints are linked: by their differing bits."""

    max_bits: int

    def __call__(self, values: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
        """values: (count, 1 or more); whether each of ``rows`` is linked with each of ``columns``."""
        apart = np.zeros((len(rows), len(columns)), np.int16)
        for k in range(values.shape[1]):
            apart += np.bitwise_count(values[rows, k][:, None] ^ values[columns, k])
        return apart <= self.max_bits


def spanning_links(values: np.ndarray, close: Callable) -> np.ndarray:
    """Pairs of places that connect all values which ``close`` links.

    Not all links but a tree over each connected set, so its size never exceeds the number of
    values, however many copies lie close together.
    """
    every = np.arange(len(values))
    rows = max(1, (1 << 20) // len(values))
    linked = [close(values, every[a : a + rows], every).sum(1) > 1 for a in range(0, len(values), rows)]
    free = np.flatnonzero(np.concatenate(linked))
    pairs = []
    while len(free):
        frontier, free = free[:1], free[1:]
        while len(frontier) and len(free):
            some = frontier[: max(1, (1 << 20) // len(free))]
            frontier = frontier[len(some) :]
            near = close(values, some, free)
            hit = near.any(0)
            if hit.any():
                pairs.append(np.stack([some[near[:, hit].argmax(0)], free[hit]], 1))
                frontier = np.r_[frontier, free[hit]]
                free = free[~hit]
    return np.concatenate(pairs) if pairs else np.zeros((0, 2), np.int64)


def fingerprint_links(distinct: DataFrame, close: Closeness) -> DataFrame:
    """Links ``a``, ``b`` that connect the fingerprints which ``close`` links.

    ``distinct`` holds each ``fingerprint`` once. Every fingerprint is dealt to the bucket of its
    bits in each searched part, and to the buckets within the part's threshold: of a pair, the
    one that lacks the highest differing bit goes to the other. Buckets above :data:`BLOCK` are
    cut into blocks, and each pair of blocks is a bucket of its own, so no task holds more than
    two blocks at once; every bucket is verified bit by bit and gives its spanning links.
    """
    total = distinct.count()
    rows = distinct.orderBy(F.xxhash64("fingerprint"), "fingerprint").limit(SAMPLE_SIZE).collect()
    sample = np.array([r["fingerprint"] for r in rows], np.int64).view(np.uint64)
    if total < 2:
        return distinct.sparkSession.createDataFrame([], "a bigint, b bigint")
    probes = []
    for number, part in enumerate(partition_plan(sample, total, close.max_bits)):
        mask = sum(1 << b for b in part.bits)
        for size in range(part.threshold + 1):
            for flips in combinations(part.bits, size):
                flip = sum(1 << b for b in flips)
                probes.append((number, signed(mask), signed(flip), signed(1 << max(flips)) if flips else 0))
    probe = F.explode(
        F.array(*[
            F.struct(F.lit(n).alias("part"), F.lit(m).cast("long").alias("mask"),
                     F.lit(f).cast("long").alias("flip"), F.lit(h).cast("long").alias("top"))
            for n, m, f, h in probes
        ])
    )
    dealt = (
        distinct.select("fingerprint", probe.alias("p"))
        .where(F.col("fingerprint").bitwiseAND(F.col("p.top")) == 0)
        .select(
            F.col("p.part").alias("part"),
            F.col("fingerprint").bitwiseAND(F.col("p.mask")).bitwiseXOR(F.col("p.flip")).alias("value"),
            "fingerprint",
        )
    )
    sizes = dealt.groupBy("part", "value").count().where(F.col("count") > BLOCK)
    blocks = F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")
    large = stored(sizes.select("part", "value", blocks), "large-buckets")
    dealt = in_blocks(dealt, large, ["part", "value"], "fingerprint")

    def links_of(table, ends):
        values = columns_of(table, ["fingerprint"])
        yield from links_of_buckets(values, ends, close)

    return per_bucket(dealt, ["part", "value", "x", "y"], links_of)


def in_blocks(dealt: DataFrame, large: DataFrame, keys: list[str], row: str) -> DataFrame:
    """Add the pair of blocks ``x``, ``y`` that a row meets in its bucket of ``keys``.

    ``large`` has the number of ``blocks`` of the buckets that are cut; a row goes to one of them
    by its value of ``row`` and meets all.
    """
    cut = dealt.join(large, keys, "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    cut = cut.withColumn("own", F.pmod(F.xxhash64(row), F.col("blocks")).cast("int"))
    cut = cut.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    pair = [F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y")]
    return cut.select(*dealt.columns, *pair)


def per_bucket(cut: DataFrame, keys: list[str], links_of: Callable) -> DataFrame:
    """The links ``a``, ``b`` that ``links_of`` gives for whole buckets and their ends."""

    def verify(batches):
        held, rows = [], 0
        for batch in batches:
            if batch.num_rows == 0:
                continue
            table = pa.Table.from_batches([batch])
            ends = bucket_ends(table)
            if held and any(table.column(k)[0] != held[-1].column(k)[-1] for k in keys):
                yield from whole(held)
                held = []
            if len(ends) > 1:  # the last bucket may go on in the next batch
                yield from whole([*held, table.slice(0, ends[-2])])
                held, table = [], table.slice(ends[-2])
            held.append(table)
        if held:
            yield from whole(held)

    def whole(tables):
        table = pa.concat_tables(tables)
        for pairs in links_of(table, bucket_ends(table)):
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["a", "b"])

    def bucket_ends(table):
        new = np.zeros(table.num_rows - 1, bool)
        for k in keys:
            column = table.column(k).to_numpy()
            new |= column[1:] != column[:-1]
        return np.r_[np.flatnonzero(new) + 1, table.num_rows]

    return cut.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(verify, "a bigint, b bigint")


def columns_of(table: pa.Table, names: list[str]) -> np.ndarray:
    return np.stack([table.column(n).to_numpy().astype(np.int64) for n in names], 1).view(np.uint64)


def links_of_buckets(values: np.ndarray, ends: np.ndarray, close: Callable) -> Iterator[np.ndarray]:
    """Spanning links of each bucket, as pairs of first columns."""
    starts = np.r_[0, ends[:-1]]
    several, found = ends - starts > 1, [np.zeros((0, 2), np.int64)]
    for a, b in zip(starts[several].tolist(), ends[several].tolist()):
        found.append(values[a:b, 0][spanning_links(values[a:b], close)].view(np.int64))
    yield np.concatenate(found)


def near_duplicates(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4
) -> DataFrame:
    """The near-duplicate class of every document: key, ``fingerprint`` (hex), ``component_id``.

    Fingerprints are linked if they differ in ``max_bits`` bits or fewer; ``component_id`` is the
    smallest key that a document reaches over links, its own included. Texts with fewer words
    than a shingle have one shingle of all their words; null texts and texts without a word have
    fingerprint zero and are linked like any other. Equal texts meet once: links are searched
    between distinct fingerprints, exactly and without a cap. Every row gives a row; null keys
    are passed over in the minimum (a class of null keys only has a null id). Other columns are
    not read, and an empty table gives an empty table.
    """
    source = df.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text"))
    documents = stored(fingerprints(source, "text", shingle, ["key"]), "fingerprints")
    distinct = documents.groupBy("fingerprint").agg(F.min("key").alias("least"))
    distinct = stored(distinct, "distinct-fingerprints")
    classes = classed(distinct, fingerprint_links(distinct, Closeness(max_bits)))
    found = documents.join(stored(classes, "classes"), "fingerprint")
    return found.select(
        F.col("key").alias(key),
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        F.col("class_least").alias("component_id"),
    )


def classed(distinct: DataFrame, links: DataFrame) -> DataFrame:
    """Each ``fingerprint`` with the smallest ``least`` of its class (``class_least``)."""
    roots = components(links)
    rooted = stored(
        distinct.join(roots, F.col("fingerprint") == F.col("node"), "left").select(
            "fingerprint", "least", F.coalesce("root", "fingerprint").alias("root")
        ),
        "rooted",
    )
    smallest = stored(rooted.groupBy("root").agg(F.min("least").alias("class_least")), "class-least")
    return rooted.join(smallest, "root").select("fingerprint", "class_least")


def one_of_each(
    df: DataFrame, key: str = "doc_id", text: str = "text", shingle: int = 4, max_bits: int = 4
) -> DataFrame:
    """One document of each class of :func:`near_duplicates`, with all its columns.

    Of a class the row with the smallest key stays; keys that are null come last, and of rows with
    equal keys one that the rows' own values choose. Of rows that are equal in key and text one
    stays, which is any if other columns differ. Texts without a word make one class, together
    with all that are linked to fingerprint zero. Columns may have any names.
    """
    keys = row_keys(key, text)
    source = df.select(F.col(quoted(key)).alias("key"), F.col(quoted(text)).alias("text"), *keys)
    who = F.struct(F.isnull("key").alias("none"), "key", "key_a", "key_b").alias("who")
    documents = fingerprints(source, "text", shingle, ["key", "key_a", "key_b"])
    documents = stored(documents.select("fingerprint", who), "fingerprints")
    distinct = documents.groupBy("fingerprint").agg(F.min("who").alias("least"))
    distinct = stored(distinct, "distinct-fingerprints")
    classes = classed(distinct, fingerprint_links(distinct, Closeness(max_bits)))
    chosen = stored(classes.select("class_least.key_a", "class_least.key_b").distinct(), "chosen")
    row = F.struct(*[F.col(quoted(c)) for c in df.columns]).alias("row")
    left = df.select(row, *keys).join(chosen, ["key_a", "key_b"], "leftsemi")
    repeated = documents.groupBy("who.key_a", "who.key_b").count().where("count > 1")
    repeated = stored(repeated.select("key_a", "key_b").join(chosen, ["key_a", "key_b"], "leftsemi"), "repeated")
    single = left.join(repeated, ["key_a", "key_b"], "leftanti")
    # Almost always empty: rows that repeat in key and text and were chosen.
    several = left.join(repeated, ["key_a", "key_b"], "leftsemi").groupBy("key_a", "key_b")
    several = several.agg(F.first("row").alias("row"))
    return single.select("row.*").unionByName(several.select("row.*"))
