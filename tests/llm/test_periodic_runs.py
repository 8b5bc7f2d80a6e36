"""Periodic runs against a plain search over all stretches."""

from __future__ import annotations

import random
import time
from hashlib import sha256
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordlake.llm import queries
from recordlake.llm.periodic_runs import planted, run_digests, runs_of_texts, with_periodic_runs

SF_DIR = "/root/testdata/sf0.001"


def plain_runs(words, min_length=6, min_exponent=4):
    """Every stretch that repeats with its smallest period and that no neighbour extends."""
    n, found = len(words), []
    for q in range(1, n // min_exponent + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            length = j + q - i
            stretch = words[i : i + length]
            if j > i and length >= max(min_length, min_exponent * q):
                if not any(stretch[p:] == stretch[: length - p] for p in range(1, q)):
                    found.append((i, length, q))
            i = j + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def odd_texts():
    rng = random.Random(7)
    texts = [[], [b"a"], [b"a"] * 5, [b"a"] * 6, [b"a"] * 300, [b"a", b"b"] * 4, [b"a", b"b"] * 90 + [b"a"]]
    word = [b"a"]
    for _ in range(7):  # Thue-Morse: squares, but no cubes
        word += [b"b" if w == b"a" else b"a" for w in word]
    texts += [word, word * 5, ([b"a", b"a", b"a", b"b"] * 5 + [b"c"]) * 6]
    for _ in range(400):
        letters = [b"a", b"b", b"c"][: rng.randrange(1, 4)]
        text = []
        for _ in range(rng.randrange(1, 6)):
            unit = [rng.choice(letters) for _ in range(rng.randrange(1, 14))]
            copies = unit * rng.randrange(1, 8)
            text += copies[: rng.randrange(len(copies) + 1)]
        texts.append(text)
    return texts


def test_runs_are_those_of_a_plain_search():
    texts = odd_texts()
    for text, found in zip(texts, runs_of_texts(texts, 6, 4)):
        assert found == plain_runs(text), text


@pytest.mark.parametrize("least", [(1, 3), (10, 3), (35, 4), (9, 7)])
def test_other_limits(least):
    texts = odd_texts()
    for text, found in zip(texts, runs_of_texts(texts, *least)):
        assert found == plain_runs(text, *least), text


def test_no_run_spans_two_texts():
    assert runs_of_texts([[b"a"] * 4, [b"a"] * 4], 6, 4) == [[], []]
    assert runs_of_texts([], 6, 4) == []


def test_exponents_below_three_are_refused():
    with pytest.raises(ValueError, match="three"):
        runs_of_texts([[b"a"] * 9], 6, 2)


def test_time_grows_in_line_with_the_words():
    def seconds(n):
        began = time.perf_counter()
        text = [b"a"] * n + [b"a", b"b"] * n + [str(i).encode() for i in range(n)] + [b"a"] * n
        assert len(runs_of_texts([text], 6, 4)[0]) == 3
        return time.perf_counter() - began

    seconds(10_000)
    assert seconds(160_000) < 20 * max(0.02, seconds(20_000))


def test_runs_of_a_table(documents):
    text = "x y " * 4 + "\t\n" + "z\f" * 7
    df = documents([(1, text), (1, text), (2, None), (3, ""), (None, " \n "), (4, "a a " * 9)])
    found = run_digests(with_periodic_runs(df.withColumns({"a.b": F.lit(1), "n_runs": F.lit("old")})))
    assert found.columns.count("n_runs") == 1 and "a.b" in found.columns
    rows = {r["doc_id"]: r for r in found.collect()}
    assert len(rows) == 5 and found.count() == 6
    assert (rows[1]["n_runs"], rows[1]["start"], rows[1]["length"], rows[1]["period"]) == (2, 0, 8, 2)
    assert rows[1]["exponent_milli"] == 4000
    assert rows[1]["runs_sha256"] == sha256(b"0,8,2\n8,7,1\n").hexdigest()
    assert rows[1]["collapsed_sha256"] == sha256(b"x y z").hexdigest()
    assert rows[4]["length"] == 9
    for key in (2, 3, None):
        assert rows[key]["n_runs"] == 0 and rows[key]["start"] is None
        assert rows[key]["runs_sha256"] == rows[key]["collapsed_sha256"] == sha256(b"").hexdigest()
    assert with_periodic_runs(df.limit(0)).count() == 0
    collapsed = with_periodic_runs(df, keep=["doc_id"]).where("doc_id = 1").first()
    assert collapsed["collapsed"] == "x y z" and [tuple(r) for r in collapsed["runs"]] == [(0, 8, 2), (8, 7, 1)]


def expected(key, text):
    """The query's row, word by word."""
    words = (text or "").encode().split()
    n, h = len(words), crc32(str(key).encode())
    g = h // 10
    if h % 10 == 0 and n > 0:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    listed = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in dropped)
    milli = 1000 * best[1] // best[2] if runs else None
    return (len(runs), *best, milli, sha256(listed.encode()).hexdigest(), sha256(kept).hexdigest())


def test_planted_ends(spark, documents):
    rng = np.random.default_rng(3)
    texts = {k: " ".join(map(str, rng.integers(0, 9, rng.integers(0, 60)))) for k in range(300)}
    df = documents([*texts.items(), (None, "a b")])
    found = df.select("doc_id", planted(F.col("text"), F.col("doc_id")).alias("text"))
    found = run_digests(with_periodic_runs(found, keep=["doc_id"]))
    rows = {r[0]: tuple(r)[1:] for r in found.where("doc_id is not null").collect()}
    assert rows == {k: expected(k, t) for k, t in texts.items()}
    assert sum(r[0] for r in rows.values()) > 5


def test_the_query_against_the_plain_search(spark):
    found = queries.QUERIES["op13_periodic_runs"](spark, SF_DIR)
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    rows = {r["doc_id"]: tuple(r[n] for n in names) for r in found.collect()}
    documents = queries.table(spark, SF_DIR, "documents").select("doc_id", "text").collect()
    short = [(k, t) for k, t in documents if len((t or "").split()) < 1500]
    assert len(rows) == len(documents) and len(short) > 150
    for key, text in short:
        assert rows[key] == expected(key, text), key
