"""Token ids in binary shards, each compressed by a Re-Pair grammar of its own."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    IntegerType,
    LongType,
    StructField,
    StructType,
)

from recordlake.llm.batches import pa_type, quoted, steps
from recordlake.llm.library_tokens import encoder

#: Ids of one shard; it ends with the document that reaches this number.
SHARD_IDS = 1 << 18
#: Bytes of text that are encoded at a time.
TEXT_BYTES = 16_000_000
#: A pair is replaced while it occurs this often in a shard: a rule itself takes a few symbols.
MIN_PAIRS = 16
#: Pairs are counted by so many bits of a hash first.
HASH_BITS, MIX = 17, 40_503
#: Rules with expansions up to this length are expanded through a table.
TABLED = 64


@dataclass(frozen=True)
class Grammar:
    """A sequence of ids as symbols, of which those from ``len(alphabet)`` on are rules.

    Symbol s below that stands for ``alphabet[s]``, any other for the two symbols of its rule.
    ``lengths`` holds the number of ids that each symbol expands to.
    """

    alphabet: np.ndarray
    rules: np.ndarray
    lengths: np.ndarray
    symbols: np.ndarray

    def expanded(self, symbols: np.ndarray) -> np.ndarray:
        """The ids that some symbols stand for."""
        base = len(self.alphabet)
        while len(long := np.flatnonzero(self.lengths[symbols] > TABLED)):
            sizes = np.ones(len(symbols), np.int64)
            sizes[long] = 2
            places = np.cumsum(sizes) - sizes
            wider = np.repeat(symbols, sizes)
            pairs = self.rules[symbols[long] - base]
            wider[places[long]], wider[places[long] + 1] = pairs[:, 0], pairs[:, 1]
            symbols = wider
        flat, starts = self.table
        sizes = self.lengths[symbols]
        shift = starts[symbols] - (np.cumsum(sizes) - sizes)
        return flat[np.repeat(shift, sizes) + np.arange(int(sizes.sum()))]

    @property
    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """Expansions of all symbols up to TABLED ids, one after another, and where each begins."""
        made = [[i] for i in self.alphabet.tolist()]
        for (a, b), length in zip(self.rules.tolist(), self.lengths[len(made) :].tolist()):
            made.append(made[a] + made[b] if length <= TABLED else [])
        sizes = np.fromiter(map(len, made), np.int64, len(made))
        return np.array([i for some in made for i in some], "<u4"), np.cumsum(sizes) - sizes

    def between(self, first: int, stop: int) -> np.ndarray:
        """Ids first to stop (exclusive): only the symbols that reach into them are expanded."""
        ends = np.cumsum(self.lengths[self.symbols])
        a = int(np.searchsorted(ends, first, "right"))
        b = int(np.searchsorted(ends, stop, "left")) + 1
        if first >= stop or a >= len(ends):
            return np.zeros(0, "<u4")
        before = int(ends[a - 1]) if a else 0
        return self.expanded(self.symbols[a:b])[first - before : stop - before]


def chosen(keys: np.ndarray, counts: np.ndarray, size: int) -> list[int]:
    """Of frequent pairs, the most frequent first, those that can be replaced together.

    No symbol may be the left one of one pair and the right one of another, so that places of
    different pairs never overlap and the order of replacement does not matter.
    """
    left, right, taken = set(), set(), []
    for k in np.lexsort((keys, -counts)).tolist():
        a, b = divmod(int(keys[k]), size)
        if a in right or b in left or (a == b and (a in left or b in right)):
            continue
        left.add(a)
        right.add(b)
        taken.append(int(keys[k]))
    return taken


def compressed(ids: np.ndarray, min_pairs: int = MIN_PAIRS) -> Grammar:
    """Re-Pair: replace frequent pairs of neighbours by new symbols until none is frequent.

    Every round replaces pairs that occur at least a quarter as often as the most frequent one may,
    and at least ``min_pairs`` times. Counts of hashed pairs, which are never too small, leave few
    places whose pairs are then counted themselves. Of a run of one symbol every second place is
    a pair.
    """
    alphabet = np.flatnonzero(np.bincount(ids))
    numbers = np.zeros(int(alphabet[-1]) + 1 if len(alphabet) else 0, np.uint32)
    numbers[alphabet] = np.arange(len(alphabet))
    symbols = numbers[ids]
    size, rules, mask = len(alphabet), [], np.uint32((1 << HASH_BITS) - 1)
    while len(symbols) > 1:
        hashed = symbols[:-1] * np.uint32(MIX)
        hashed += symbols[1:]
        hashed &= mask
        hashed = hashed.astype(np.intp)
        buckets = np.bincount(hashed)
        often, bound = [], int(buckets.max())
        while not len(often) and bound >= min_pairs:
            bound = max(min_pairs, (bound + 3) // 4)
            places = np.flatnonzero((buckets >= bound)[hashed])
            keys = symbols[places].astype(np.int64) * size + symbols[places + 1]
            ordered = np.sort(keys)
            first = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]])
            counts = np.diff(np.r_[first, len(ordered)])
            often = np.flatnonzero(counts >= bound)
            if bound == min_pairs:
                break
        if not len(often):
            break
        pairs = np.sort(np.array(chosen(ordered[first[often]], counts[often], size), np.int64))
        is_left, is_right = np.zeros(size, bool), np.zeros(size, bool)
        is_left[pairs // size], is_right[pairs % size] = True, True
        fits = is_left[symbols[places]] & is_right[symbols[places + 1]]
        places, keys = places[fits], keys[fits]
        at = np.minimum(np.searchsorted(pairs, keys), len(pairs) - 1)
        hit = pairs[at] == keys
        places, at = places[hit], at[hit]
        # Places one after another are those of a run of one symbol.
        number = np.arange(len(places))
        begins = np.where(np.r_[True, np.diff(places) != 1], number, 0)
        every_second = (number - np.maximum.accumulate(begins)) % 2 == 0
        places, at = places[every_second], at[every_second]
        symbols[places] = size + at
        left = np.ones(len(symbols), bool)
        left[places + 1] = False
        symbols = symbols[left]
        rules += [divmod(key, size) for key in pairs.tolist()]
        size += len(pairs)
    lengths = [1] * len(alphabet)
    for a, b in rules:
        lengths.append(lengths[a] + lengths[b])
    pairs = np.array(rules, np.int64).reshape(-1, 2)
    return Grammar(alphabet.astype("<u4"), pairs, np.array(lengths, np.int64), symbols.astype(np.int64))


def packed(numbers: np.ndarray) -> bytes:
    """Numbers in the file format: little-endian, in 2, 4 or 8 bytes, which the first byte tells."""
    most = int(numbers.max()) if len(numbers) else 0
    width = 2 if most < 1 << 16 else 4 if most < 1 << 32 else 8
    return bytes([width]) + numbers.astype(f"<u{width}").tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def shard_schema(key: StructField) -> StructType:
    """The file format: one row per shard, in Parquet files.

    ``part`` and ``shard`` number the shards in the order of their documents, ``before`` counts the
    ids in earlier shards of the part. ``keys`` and ``sizes`` list the shard's documents and their
    ids; ``first_key`` and ``last_key`` let a reader skip shards. ``alphabet``, ``rules`` (left and
    right symbol in turn), ``lengths`` (ids that each rule expands to) and ``symbols`` are the
    grammar.
    """
    numbers = [StructField(name, LongType()) for name in ("shard", "before", "n_ids")]
    keys = [StructField(name, key.dataType) for name in ("first_key", "last_key")]
    lists = [StructField("keys", ArrayType(key.dataType)), StructField("sizes", ArrayType(LongType()))]
    grammar = [StructField(name, BinaryType()) for name in ("alphabet", "rules", "lengths", "symbols")]
    return StructType([StructField("part", IntegerType()), *numbers, *keys, *lists, *grammar])


def write_token_shards(
    df: DataFrame,
    path: str,
    vocabulary: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = 0,
    shard_ids: int = SHARD_IDS,
    min_pairs: int = MIN_PAIRS,
) -> None:
    """Encode every text and write the ids, in the order of the keys, as shards under ``path``.

    ``vocabulary`` is the path of a byte-level vocabulary file of the tokenizers library, the same
    on every executor. Each document's ids are followed by ``end_id``. Null keys come first; rows
    with equal keys stand in the order of a hash of their texts, equal rows side by side. A null
    text counts as empty: the end id alone. Other columns are not read, and an empty table gives
    files without shards.

    Documents are dealt out by ranges of keys. Place in the input is the last sort key, so that a
    key of any number of rows, even of equal rows, is spread over tasks; the input must read the
    same again, as a table does. A shard ends with the document that brings it to ``shard_ids``
    ids, so a task holds one shard at a time, and a longer document whole.
    """
    source = df.select(
        F.col(quoted(text)).alias("text"),
        F.col(quoted(key)).alias("key"),
        F.xxhash64(F.col(quoted(text))).alias("tie"),
        F.monotonically_increasing_id().alias("place"),
    )
    order = [F.asc_nulls_first("key"), "tie", "place"]
    ordered = source.repartitionByRange(*order).sortWithinPartitions(*order).select("text", "key")
    schema = shard_schema(df.schema[key])
    arrow = pa.schema([(field.name, pa_type(field)) for field in schema])

    def run(batches):
        part, before, end = TaskContext.get().partitionId(), 0, np.array([end_id], "<u4")
        keys, texts, held, shard = [], [], 0, 0

        def made():
            grammar = compressed(np.concatenate([x for ids in texts for x in (ids, end)]), min_pairs)
            row = {
                "part": part, "shard": shard, "before": before, "n_ids": held,
                "first_key": keys[0], "last_key": keys[-1], "keys": keys,
                "sizes": [len(ids) + 1 for ids in texts],
                "alphabet": packed(grammar.alphabet), "rules": packed(grammar.rules.ravel()),
                "lengths": packed(grammar.lengths[len(grammar.alphabet) :]),
                "symbols": packed(grammar.symbols),
            }
            return pa.RecordBatch.from_pylist([row], arrow)

        for batch in batches:
            for step in steps(batch, limit=TEXT_BYTES):
                ids, ends = encoder(vocabulary).encode_array(step.column(0))
                starts = [0, *ends[:-1].tolist()]
                for k, a, b in zip(step.column(1).to_pylist(), starts, ends.tolist()):
                    keys.append(k)
                    texts.append(ids[a:b])
                    held += b - a + 1
                    if held >= shard_ids:
                        yield made()
                        before, shard = before + held, shard + 1
                        keys, texts, held = [], [], 0
        if keys:
            yield made()

    ordered.mapInArrow(run, schema).write.option("compression", "zstd").parquet(path)


def grammar_of(row: dict) -> Grammar:
    """The grammar of a shard as it stands in the files."""
    alphabet = unpacked(row["alphabet"])
    lengths = np.r_[np.ones(len(alphabet), np.int64), unpacked(row["lengths"])]
    rules = unpacked(row["rules"]).reshape(-1, 2)
    return Grammar(alphabet.astype("<u4"), rules, lengths, unpacked(row["symbols"]))


def with_places(shards: DataFrame) -> DataFrame:
    """Shards with ``offset``, the number of ids before each in the whole sequence.

    Only one number per part, that is per task of the write, is summed up and broadcast.
    """
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    totals = shards.groupBy("part").agg(F.sum("n_ids").alias("ids"))
    parts = totals.select("part", F.coalesce(F.sum("ids").over(earlier), F.lit(0)).alias("offset"))
    placed = shards.join(F.broadcast(parts), "part")
    return placed.withColumn("offset", F.col("offset") + F.col("before"))


def read_token_shards(spark: SparkSession, path: str, key: str = "doc_id") -> DataFrame:
    """Every document of the shards under ``path``, from the files alone.

    Returns the key, ``start`` (ids of all documents before it), ``n_tokens`` (with the end id) and
    ``ids`` as little-endian 32-bit numbers in one binary value. Files without shards give no rows.
    Each shard is expanded by itself; results leave a task a few megabytes at a time.
    """
    shards = spark.read.parquet(path)
    key_type = shards.schema["first_key"]
    schema = StructType(
        [StructField("key", key_type.dataType)]
        + [StructField(name, LongType()) for name in ("start", "n_tokens")]
        + [StructField("ids", BinaryType())]
    )
    arrow = pa.schema([(field.name, pa_type(field)) for field in schema])

    def run(batches):
        for batch in batches:
            for k in range(batch.num_rows):  # one shard at a time
                row = batch.slice(k, 1).to_pylist()[0]
                grammar = grammar_of(row)
                ids = grammar.expanded(grammar.symbols).tobytes()
                ends = np.cumsum(row["sizes"])
                starts = ends - row["sizes"]
                texts = [ids[4 * a : 4 * b] for a, b in zip(starts.tolist(), ends.tolist())]
                found = [row["keys"], (starts + row["offset"]).tolist(), row["sizes"], texts]
                arrays = [pa.array(values, field.type) for values, field in zip(found, arrow)]
                yield from steps(pa.RecordBatch.from_arrays(arrays, schema=arrow), column=3)

    columns = ["offset", "keys", "sizes", "alphabet", "rules", "lengths", "symbols"]
    found = with_places(shards).select(*columns).mapInArrow(run, schema)
    return found.withColumnRenamed("key", key)


def ids_between(spark: SparkSession, path: str, first: int, stop: int) -> DataFrame:
    """The ids from place ``first`` to ``stop`` (exclusive) of the whole sequence: ``place``, ``id``.

    Random access: shards outside are not read, and of the others only the symbols whose
    expansions reach into the range are expanded. Places beyond the end give no rows.
    """
    shards = with_places(spark.read.parquet(path))
    shards = shards.where((F.col("offset") < stop) & (F.col("offset") + F.col("n_ids") > first))

    def run(batches):
        for batch in batches:
            for row in batch.to_pylist():
                a, b = max(0, first - row["offset"]), min(row["n_ids"], stop - row["offset"])
                ids = grammar_of(row).between(a, b).astype(np.int64)
                places = row["offset"] + a + np.arange(len(ids))
                yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(ids)], names=["place", "id"])

    columns = ["offset", "n_ids", "alphabet", "rules", "lengths", "symbols"]
    return shards.select(*columns).mapInArrow(run, "place bigint, id bigint")
