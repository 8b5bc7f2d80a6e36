"""Both tokenizers against the library that the vocabulary files are made for."""

from __future__ import annotations

import random
import struct
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from recordlake.llm.token_counts import RankMerger, TokenCounter, token_counts
from recordlake.llm.word_bpe import WordBpe, decoded, encoded, round_trips

tokenizers = pytest.importorskip("tokenizers")


def samples() -> list[str]:
    rng = random.Random(5)
    odd = [
        "", " ", "\n\n  \t x", "Σας ΣΑΣ İI", "a\x85b\xa0c d\x1ce", "it's I'LL we'Ve '",
        "<|endoftext|>x<|startoftext|> y <|endoftext|>", "<|endoftext", "a" * 5000, "ab" * 700,
        "ﬁ ² ½ Ⅷ ١٢ é ẛ̣ ñ", "日本語テキスト 한국어 ไทย", "\x00\x01\x7f", "𐐀𐐁 \U0001F600\U0001F600",
        "12345678901234567890 3.14 1e9", "_under_score_ --- ***$$$", "x" * 300 + "é" * 300,
    ]
    ranges = [(32, 127), (160, 0x250), (0x370, 0x530), (0x3040, 0x30FF), (0x1F300, 0x1F600)]
    for _ in range(150):
        odd.append("".join(chr(rng.randrange(*rng.choice(ranges))) for _ in range(rng.randrange(1, 80))))
    return odd


def test_rank_merging_counts_as_the_library(vocabulary):
    path = vocabulary("byte_bpe_50k.json")
    library = tokenizers.Tokenizer.from_file(path)
    texts = samples()
    expected = [len(e.ids) for e in library.encode_batch(texts, add_special_tokens=False)]
    assert TokenCounter(path).count(texts) == expected


def test_merges_of_an_overlapping_pair(vocabulary):
    merger = RankMerger(vocabulary("byte_bpe_50k.json"))
    library = tokenizers.Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    words = ["a" * n for n in range(1, 40)]
    assert merger.counts([w.encode() for w in words]).tolist() == [
        len(library.encode(w, add_special_tokens=False).ids) for w in words
    ]


def test_word_bpe_encodes_and_decodes_as_the_library(vocabulary):
    path = vocabulary("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    library.no_truncation()
    library.no_padding()
    texts = samples()
    for text, pieces, wanted in zip(
        texts, WordBpe(path).encode(texts), library.encode_batch(texts, add_special_tokens=False)
    ):
        ids = b"".join(pieces)
        assert list(struct.unpack(f"<{len(ids) // 4}I", ids)) == wanted.ids, ascii(text)


def test_one_tree_and_many_trees_merge_alike(vocabulary):
    model = WordBpe(vocabulary("word_bpe_49k.json"))
    rng = random.Random(3)
    rows = [
        [model.inner[rng.choice(b"etaoinshr")] for _ in range(rng.randrange(1, 60))] + [model.last[101]]
        for _ in range(300)
    ]
    assert model.merged_rows([list(r) for r in rows]) == [model.merged(list(r)) for r in rows]


def brute_force(pairs: dict, symbols: list[int]) -> list[int]:
    while True:
        ranked = [(pairs[p][0], i) for i, p in enumerate(zip(symbols, symbols[1:])) if p in pairs]
        if not ranked:
            return symbols
        _, i = min(ranked)
        symbols = symbols[:i] + [pairs[symbols[i], symbols[i + 1]][1]] + symbols[i + 2 :]


def test_the_tree_merges_as_a_plain_search_does(vocabulary):
    model = WordBpe(vocabulary("word_bpe_49k.json"))
    rng = random.Random(4)
    for _ in range(100):
        row = [model.inner[rng.choice(b"aaabnt")] for _ in range(rng.randrange(1, 30))]
        assert model.merged(list(row)) == brute_force(model.pairs, row)


def test_token_counts_of_a_table(documents, vocabulary):
    df = documents([(1, "Hello world"), (None, None), (3, ""), (3, ""), (4, "x " * 1500)])
    found = token_counts(df, vocabulary("byte_bpe_50k.json"), keep=["doc_id"])
    rows = sorted(map(tuple, found.collect()), key=lambda r: (r[0] or 0, r))
    assert rows == [
        (None, 0, 0, False), (1, 11, 2, False), (3, 0, 0, False), (3, 0, 0, False), (4, 3000, 1501, True),
    ]
    again = token_counts(found.withColumnRenamed("n_bytes", "text").withColumn("text", found.doc_id.cast("string")),
                         vocabulary("byte_bpe_50k.json"))
    assert again.columns.count("n_tokens") == 1 and again.count() == 5
    assert token_counts(df.limit(0), vocabulary("byte_bpe_50k.json")).count() == 0


def test_ids_decode_as_by_the_library(spark, documents, vocabulary):
    path = vocabulary("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    library.no_truncation()
    texts = samples()
    df = documents(list(enumerate(texts))).withColumns({"a.b": F.lit(1), "decoded": F.lit("old")})
    found = decoded(encoded(df, path), path)
    assert sorted(found.columns) == sorted([*df.columns, "n_tokens", "ids"])
    for row in found.collect():
        wanted = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["ids"] == wanted
        assert row["decoded"] == library.decode(wanted, skip_special_tokens=False)
    at_once = encoded(df, path, keep=["doc_id"], with_decoded=True).collect()
    wanted = {r["doc_id"]: (r["n_tokens"], r["ids"], r["decoded"]) for r in found.collect()}
    assert {r["doc_id"]: (r["n_tokens"], r["ids"], r["decoded"]) for r in at_once} == wanted
    odd = spark.createDataFrame([(1, None), (2, []), (3, [320, 10**6, 320])], "k int, ids array<int>")
    texts = {r["k"]: r["decoded"] for r in decoded(odd, path).collect()}
    assert texts == {1: "", 2: "", 3: library.decode([320, 10**6, 320], skip_special_tokens=False)}
    assert decoded(odd.limit(0), path).count() == 0


def test_round_trips_of_a_whole_table(spark, vocabulary):
    path = vocabulary("word_bpe_49k.json")
    library = tokenizers.Tokenizer.from_file(path)
    library.no_truncation()
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    digests = {r["doc_id"]: r for r in round_trips(df, path, keep=["doc_id"]).collect()}
    for row in decoded(encoded(df, path), path).collect():
        ids = library.encode(row["text"] or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        assert row["decoded"] == text
        assert digests[row["doc_id"]]["decoded_sha256"] == sha256(text.encode()).hexdigest()
        assert digests[row["doc_id"]]["ids_sha256"] == sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()


def test_round_trips_of_a_table(documents, vocabulary):
    df = documents([(1, "Hello, World"), (2, None), (2, None)])
    found = round_trips(df, vocabulary("word_bpe_49k.json"), keep=["doc_id"]).orderBy("doc_id").collect()
    empty = sha256(b"").hexdigest()
    assert [tuple(r) for r in found[1:]] == [(2, 0, empty, empty)] * 2
    ids = encoded(df, vocabulary("word_bpe_49k.json")).where("doc_id = 1").first()["ids"]
    assert found[0]["ids_sha256"] == sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
    assert found[0]["decoded_sha256"] == sha256(b"hello</w> ,</w> world</w>").hexdigest()
    assert encoded(df.limit(0), vocabulary("word_bpe_49k.json")).count() == 0
