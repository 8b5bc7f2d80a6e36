"""SimHash classes, components, passages and string tiling against brute force."""

from __future__ import annotations

import random
import time
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np
import pytest
import xxhash

from recordlake.llm import passages, simhash, string_tiling
from recordlake.llm.components import components
from pyspark.sql import functions as F


def brute_fingerprint(text, shingle):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = (text or "").translate(lower).encode().split()
    if not words:
        return 0
    parts = [b" ".join(words[i : i + shingle]) for i in range(max(1, len(words) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(p, 42) for p in parts]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_classes(nodes, linked):
    """Smallest member of each node's class."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    nodes = sorted(nodes)
    for i, a in enumerate(nodes):
        for b in nodes[i + 1 :]:
            if linked(a, b):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("block", [8192, 8])
def test_near_duplicates_against_brute_force(documents, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)  # cuts buckets into blocks
    rng = random.Random(6)
    base = [f"w{rng.randrange(500)}" for _ in range(400)]
    rows = []
    for i in range(90):
        words = list(base)
        for _ in range(rng.randrange(6)):
            words[rng.randrange(400)] = "X"
        rows.append((i, " ".join(words)))
    rows += [(100 + i, " ".join(f"v{rng.randrange(99)}" for _ in range(30))) for i in range(40)]
    rows += [(200, None), (201, ""), (202, " \t"), (203, "one"), (204, "ONE"), (None, base[0]), (5, rows[5][1])]
    found = simhash.near_duplicates(documents(rows)).collect()
    prints = [brute_fingerprint(t, 4) for _, t in rows]
    roots = brute_classes(set(prints), lambda a, b: bin(a ^ b).count("1") <= 4)
    least = defaultdict(list)
    for (key, _), p in zip(rows, prints):
        least[roots[p]].append(key)
    expected = Counter(
        (key, f"{p:016x}", min((k for k in least[roots[p]] if k is not None), default=None))
        for (key, _), p in zip(rows, prints)
    )
    assert Counter(map(tuple, found)) == expected
    assert len(set(roots.values())) < len(roots)


def test_unequal_thresholds_find_every_link(spark):
    rng = np.random.default_rng(4)
    values = rng.integers(0, 1 << 63, 60, dtype=np.int64)
    near = [v ^ sum(1 << int(b) for b in rng.choice(63, rng.integers(1, 8), replace=False)) for v in values.tolist()]
    every = sorted({*values.tolist(), *near})
    table = spark.createDataFrame([(v,) for v in every], "fingerprint long")
    for bits in (0, 3, 7):
        links = simhash.fingerprint_links(table, simhash.Closeness(bits)).collect()
        roots = brute_classes(every, lambda a, b: bin((a ^ b) & (2**64 - 1)).count("1") <= bits)
        pairs = {frozenset(r) for r in links}
        assert all(bin((a ^ b) & (2**64 - 1)).count("1") <= bits for a, b in pairs)
        assert brute_classes(every, lambda a, b: frozenset((a, b)) in pairs) == roots


def test_the_plan_allots_the_pigeonhole_sum():
    rng = np.random.default_rng(1)
    sample = rng.integers(0, 1 << 64, 300, dtype=np.uint64)
    for total in (1000, 10**7, 10**10):
        plan = simhash.partition_plan(sample, total, 4)
        assert sum(p.threshold + 1 for p in plan) == 5
        bits = [b for p in plan for b in p.bits]
        assert len(bits) == len(set(bits))
    assert len({p.threshold for p in simhash.partition_plan(sample, 10**8, 4)}) > 1


def test_components_against_brute_force(spark):
    rng = random.Random(8)
    links = [(i, i + 1) for i in range(0, 40)] + [(rng.randrange(50, 200), rng.randrange(50, 200)) for _ in range(90)]
    links += [(300, n) for n in range(301, 360)] + [(7, 7), (1, 0)]
    table = spark.createDataFrame(links, "a long, b long")
    nodes = {n for pair in links for n in pair}
    pairs = {frozenset(p) for p in links}
    roots = brute_classes(nodes, lambda a, b: frozenset((a, b)) in pairs)
    found = {r["node"]: r["root"] for r in components(table).collect()}
    assert found == {n: r for n, r in roots.items() if n != r}
    assert components(table.limit(0)).count() == 0


def test_one_of_each_class_stays(documents):
    rng = random.Random(2)
    base = [f"w{rng.randrange(900)}" for _ in range(300)]
    near = list(base)
    near[40] = "changed"
    other = [f"u{rng.randrange(900)}" for _ in range(300)]
    rows = [(3, " ".join(base)), (2, " ".join(near)), (7, " ".join(other)), (7, " ".join(other)), (9, None), (8, "")]
    df = documents(rows).withColumns({"key_a": F.lit(1), "row": F.lit(2), "wide": F.lit(3), "who": F.lit(4)})
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    found = {r["doc_id"] for r in kept.collect()}
    prints = {k: brute_fingerprint(t, 4) for k, t in rows}
    roots = brute_classes(prints, lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 4)
    assert found == set(roots.values()) and kept.count() == len(found)
    assert simhash.one_of_each(df.limit(0)).count() == 0


def brute_passages(rows, length):
    texts = [(key, (text or "").encode().split()) for key, text in rows]
    windows = Counter(tuple(w[i : i + length]) for _, w in texts for i in range(len(w) - length + 1))
    found = []
    for key, w in texts:
        gone = {
            i + k for i in range(len(w) - length + 1) if windows[tuple(w[i : i + length])] > 1 for k in range(length)
        }
        rest = b" ".join(x for i, x in enumerate(w) if i not in gone)
        found.append((key, len(w), len(gone), rest.decode(), sha256(rest).hexdigest()))
    return found


@pytest.mark.parametrize("shard_bytes", [4_000_000, 700])
def test_passages_against_brute_force(documents, monkeypatch, shard_bytes):
    monkeypatch.setattr(passages, "SHARD_BYTES", shard_bytes)
    rng = random.Random(11)
    shared = [[f"p{rng.randrange(50)}" for _ in range(rng.randrange(6, 30))] for _ in range(6)]
    rows = []
    for i in range(60):
        words = []
        for _ in range(rng.randrange(4)):
            words += [f"é{rng.randrange(400)}" for _ in range(rng.randrange(12))]
            a, p = rng.randrange(5), rng.choice(shared)
            words += p[a : a + rng.randrange(3, 30)]
        rows.append((i, " ".join(words) + rng.choice(["", "\n", "\xa0x"])))
    rows += [(70, "a b " * 20), (71, None), (72, ""), (None, rows[0][1]), rows[1], rows[1], (73, "q " * 7)]
    found = passages.without_repeated_passages(documents(rows), length=8)
    assert Counter(map(tuple, found.collect())) == Counter(brute_passages(rows, 8))


def test_passages_of_no_rows_and_short_texts(documents):
    df = documents([(1, "a b c"), (2, "a b c")])
    assert [r["n_removed"] for r in passages.without_repeated_passages(df).collect()] == [0, 0]
    assert passages.without_repeated_passages(df.limit(0)).count() == 0
    clash = df.withColumns({"part": F.lit(0), "n_words": F.lit(0), "key": F.lit("k")})
    assert passages.without_repeated_passages(clash, length=2).columns[0] == "doc_id"


def brute_tiles(text, item, shortest):
    """Greedy string tiling by comparing every pair of places."""
    marked, taken, tiles = [False] * len(text), [False] * len(item), []
    while True:
        best, found = shortest, []
        for a in range(len(text)):
            for b in range(len(item)):
                n = 0
                while (
                    a + n < len(text) and b + n < len(item) and text[a + n] == item[b + n]
                    and not marked[a + n] and not taken[b + n]
                ):
                    n += 1
                if n > best:
                    best, found = n, [(a, b)]
                elif n == best:
                    found.append((a, b))
        if not found:
            return tiles
        for a, b in found:
            if not any(marked[a : a + best]) and not any(taken[b : b + best]):
                tiles.append((a, b, best))
                marked[a : a + best] = taken[b : b + best] = [True] * best


def test_running_karp_rabin_tiles_greedily():
    rng = random.Random(5)
    for _ in range(60):
        item = [rng.randrange(6) for _ in range(rng.randrange(3, 60))]
        text = [rng.randrange(6) for _ in range(20)] + item[10:] + item[:10] + [rng.randrange(6) for _ in range(20)]
        found = string_tiling.tiles(text, item, 3)
        assert sorted(found) == sorted(brute_tiles(text, item, 3))


def test_tiling_of_repeats_equals_brute_force():
    rng = random.Random(9)
    for _ in range(40):
        text = [rng.randrange(2) for _ in range(rng.randrange(1, 40))] + [0] * rng.randrange(30) + [None]
        text += [1, 2, 3] * rng.randrange(9) + [0, 1] * rng.randrange(9)
        item = [0] * rng.randrange(1, 20) + [1, 2, 3] * rng.randrange(5) + [rng.randrange(2) for _ in range(9)]
        for shortest in (1, 3, 5):
            assert string_tiling.tiles(text, item, shortest) == brute_tiles(text, item, shortest)


def test_tiling_of_repeats_takes_linear_time():
    def seconds(n):
        began = time.process_time()
        index = string_tiling.SeedIndex.of([(1, "log " * (n // 4)), (2, "log line " * (n // 8))], 5)
        found = index.search(["log " * n + "log line " * n], 0.5)
        assert [m["item"] for m in found[0]] == [1, 2]
        return time.process_time() - began

    seconds(1000)
    assert seconds(40_000) < 3 * max(0.05, seconds(20_000))
    assert seconds(80_000) < 5


def test_short_and_unspaced_items_are_found(spark, documents):
    bench = spark.createDataFrame(
        [(1, "What is 2+2?"), (2, "日本で一番高い山は何ですか"), (3, "Qui a écrit « Germinal » ?"), (4, "?!"), (5, "ประเทศไทย")],
        "item_id long, text string",
    )
    df = documents([
        (1, "what is 2 + 2"), (2, "前に日本で一番高い山は何ですか。後"), (3, "x “qui a écrit ‘germinal’” y"), (4, "what was 2+2"),
        (5, "日本 山"), (6, "ในประเทศไทยมี"), (7, "?! ?!"),
    ])
    found = {(r["doc_id"], r["item_id"]) for r in string_tiling.contaminations(df, bench).collect()}
    assert found == {(1, 1), (2, 2), (3, 3), (6, 5)}


def test_the_query_against_tiling_all_pairs(spark):
    from recordlake.llm import queries

    sf_dir = "/root/testdata/sf0.001"
    bench = [tuple(r) for r in queries.table(spark, sf_dir, "benchmark").select("item_id", "text").collect()]
    rows = queries.table(spark, sf_dir, "documents").select("doc_id", "text").collect()
    numbers = {}
    docs = []
    for key, text in rows:
        words = [numbers.setdefault(h, len(numbers)) for h in string_tiling.token_hashes(text).tolist()]
        if len(words) < 400:
            docs.append((key, words))
    found = queries.QUERIES["op9_string_tiling"](spark, sf_dir).collect()
    got = sorted((r["doc_id"], r["item_id"], r["tiled_tokens"]) for r in found if r["doc_id"] in dict(docs))
    wanted = []
    for number, text in bench:
        item = [numbers.setdefault(h, len(numbers)) for h in string_tiling.token_hashes(text).tolist()]
        for key, words in docs:
            # Half of an item cannot be covered where fewer than half of its tokens stand.
            if item and sum(t in words for t in item) * 2 >= len(item):
                size = sum(n for _, _, n in brute_tiles(words, item, min(5, len(item))))
                if size and size >= 0.5 * len(item):
                    wanted.append((key, number, size))
    assert got == sorted(wanted) and len(docs) > 100 and wanted


def test_contaminations_catch_reordered_passages(spark, documents):
    rng = random.Random(3)
    items = [(i, " ".join(f"t{i}x{rng.randrange(60)}" for _ in range(40))) for i in range(8)]
    words = items[2][1].split()
    moved = " ".join(words[20:] + ["and"] + words[:20]).upper()
    rows = [
        (1, f"clean text {items[0][1][:40]}"), (2, f"before, {items[1][1]}. after"), (3, f"x {moved} y"), (4, None),
        (5, ""), (None, items[4][1]), (2, f"before, {items[1][1]}. after"), (6, items[5][1] + " " + items[6][1]),
    ]
    bench = spark.createDataFrame([*items, (90, None), (None, "a b c d e f"), (91, "a b")], "item_id long, text string")
    df = documents(rows).withColumns({"key": F.lit(1), "found": F.lit(2), "item_id": F.lit(3)})
    found = string_tiling.contaminations(df, bench)
    pairs = Counter((r["doc_id"], r["item_id"]) for r in found.collect())
    assert pairs == Counter([(2, 1), (2, 1), (3, 2), (None, 4), (6, 5), (6, 6)])
    assert {r["coverage"] for r in found.collect()} == {1.0}
    kept = string_tiling.without_contaminated(df, bench)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == [1, 4, 5]
    assert string_tiling.contaminations(df, bench.limit(0)).count() == 0
    assert string_tiling.contaminations(df.limit(0), bench).count() == 0


def test_a_benchmark_in_blocks_gives_the_same_pairs(spark, documents, monkeypatch):
    items = [(i, " ".join(f"t{i}x{k}" for k in range(30))) for i in range(6)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = documents([(i, f"a {t} b") for i, t in items])
    whole = {tuple(r) for r in string_tiling.contaminations(df, bench).collect()}
    monkeypatch.setattr(string_tiling, "BLOCK_BYTES", 300)
    assert {tuple(r) for r in string_tiling.contaminations(df, bench).collect()} == whole
    assert len(whole) == 6 and string_tiling.without_contaminated(df, bench).count() == 0


@pytest.mark.parametrize("block", [8192, 8])
def test_one_of_each_is_the_smallest_key_of_each_class(documents, monkeypatch, block):
    monkeypatch.setattr(simhash, "BLOCK", block)  # cuts buckets into blocks
    rng = random.Random(4)
    rows, key = [], 0
    for group in range(40):
        base = [f"g{group}w{rng.randrange(5000)}" for _ in range(rng.choice([9, 30, 120, 300]))]
        for changes in (0, 1, rng.randrange(8), max(1, len(base) // 46)):
            words = list(base)
            for place in rng.sample(range(len(base)), min(changes, len(base))):
                words[place] = f"new{key}"
            rows.append((key := key + 1, " ".join(words)))
    rows += [(990, None), (991, "a"), (992, "A"), (985, " ")]
    rng.shuffle(rows)
    prints = {k: brute_fingerprint(t, 4) for k, t in rows}
    close = lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 4
    expected = sorted(set(brute_classes(prints, close).values()))
    assert 40 < len(expected) < len(rows) - 10
    df = documents(rows).withColumns({"a.b": F.lit(1), "fingerprint": F.lit(2)})
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == expected
