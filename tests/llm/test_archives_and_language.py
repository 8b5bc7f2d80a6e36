"""WARC round trips and salvage, language identification, and the pipeline."""

from __future__ import annotations

import gzip
import os
import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordlake.llm import language, queries, warc
from tests.llm.test_duplicates import brute_classes, brute_fingerprint

PAGES = [
    (1, "http://a.com/", "<p>one</p>"), (2, "http://b.com/", "<p>one</p>"), (3, None, None), (4, "http://c.com/\r\nX: y", ""),
    (5, "http://d.com/é", "é\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n"), (None, "http://e.com/", "<p>none</p>"),
    (6, "u", "x" * 300_000), (7, "u", "twice"), (7, "u", "twice"),
]


@pytest.mark.parametrize("compressed", [True, False])
def test_archives_round_trip(spark, out, compressed):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").repartition(2)
    pages = pages.withColumns({c: F.lit("x") for c in ("page", "payload", "sha", "size", "largest")})
    warc.write_archives(pages, out, compressed=compressed)
    found = warc.read_archives(spark, out, with_payload=True).collect()
    assert [r["gap"] for r in found if r["gap"]] == []
    rows = sorted(
        ((r["page"], r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in found),
        key=lambda r: (r[0] or 0, r),
    )
    expected = []
    for page, _, html in PAGES:
        data = (html or "").encode()
        largest = max((p for p, _, h in PAGES if p and (h or "") == (html or "")), default=None)
        revisit = largest is not None and page != largest
        expected.append(
            (page, "revisit" if revisit else "response", largest if revisit else None, len(data), warc.digest(data))
        )
    assert rows == sorted(expected, key=lambda r: (r[0] or 0, r))
    payloads = {r["page"]: r["payload"] for r in found}
    assert bytes(payloads[5]) == PAGES[4][2].encode() and payloads[1] is None
    assert {r["page"]: r["url"] for r in found}[4] == "http://c.com/%0D%0AX: y"
    if compressed:
        for name in os.listdir(out):
            if name.startswith("part"):
                gzip.open(os.path.join(out, name)).read()


def test_small_payloads_are_all_responses_and_empty_tables_are_in_order(spark, out):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    warc.write_archives(pages, out, min_revisit_bytes=1000)
    assert {r["record_type"] for r in warc.read_archives(spark, out).collect()} == {"response"}
    warc.write_archives(pages.limit(0), out + "2")
    assert warc.read_archives(spark, out + "2").count() == 0


def record(page: int, payload: bytes) -> bytes:
    return warc.record_bytes(page, f"http://x/{page}", payload, None, False, "2000-01-01T00:00:00Z") + warc.END


@pytest.mark.parametrize("compressed", [True, False])
def test_salvage_recovers_what_follows_the_damage(compressed):
    pack = (lambda b: gzip.compress(b, mtime=0)) if compressed else (lambda b: b)
    parts = [pack(record(i, bytes(f"page {i} " * 40, "ascii"))) for i in range(6)]
    whole = b"".join(parts)
    assert [r.headers["warc-record-id"][10:-1] for _, _, r, _, _ in warc.salvage(whole)] == list("012345")
    starts = np.cumsum([0, *map(len, parts)]).tolist()
    damaged = bytearray(whole)
    damaged[starts[2] + len(parts[2]) // 2] ^= 0xFF  # inside a record
    cut = bytes(damaged[: starts[4]]) + b"garbage" + bytes(damaged[starts[4] : starts[5] + 60])  # and a cut end
    found = list(warc.salvage(cut))
    pages = [r.headers["warc-record-id"][10:-1] for _, _, r, *_ in found if r]
    assert pages == ["0", "1", "3", "4"]
    gaps = [(a, b) for a, b, r, *_ in found if r is None]
    shift = starts[4] + len(b"garbage")
    assert gaps == [(starts[2], starts[3]), (starts[4], shift), (shift + len(parts[4]), len(cut))]
    covered = sum(b - a for a, b, *_ in found)
    assert covered == len(cut)  # every byte is in a record or in a gap


@pytest.mark.parametrize("compressed", [True, False])
def test_long_urls_and_long_members_are_whole_records(spark, out, compressed):
    rows = [(1, "http://a.com/" + "u" * 70_000, "one"), (2, "\x01" * 30_000, "two"), (3, "v" * 200_000 + "WARC/1.1", "3"),
            (4, "http://b.com/", "four")]
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), out, compressed=compressed)
    found = warc.whole(warc.read_archives(spark, out, with_payload=True)).collect()
    assert {r["page"]: bytes(r["payload"]).decode() for r in found} == {p: html for p, _, html in rows}
    assert {r["page"]: len(r["url"]) for r in found} == {1: 70_013, 2: 90_000, 3: 200_008, 4: 13}


def pages_of(found) -> list[str]:
    return [r.headers["warc-record-id"][10:-1] for _, _, r, *_ in found if r]


def inner_gaps(found) -> list[tuple]:
    return [(*inner, why) for _, _, r, why, inner in found if r is None and inner]


def test_damage_inside_a_member_costs_one_record():
    parts = [record(i, bytes(f"page {i} " * 60, "ascii")) for i in range(5)]
    starts = np.cumsum([0, *map(len, parts)]).tolist()
    content = bytearray(b"".join(parts))
    content[starts[2] + 400] ^= 0xFF
    member = gzip.compress(bytes(content), mtime=0)
    found = list(warc.salvage(member + gzip.compress(parts[0])))
    assert pages_of(found) == ["0", "1", "3", "4", "0"]
    assert [(a, b) for a, b, _ in inner_gaps(found)] == [(starts[2], starts[3])]
    assert [inner for _, _, r, _, inner in found if r][:2] == [(0, starts[1]), (starts[1], starts[2])]
    last = [x for x in found if x[2]][-1]
    assert (last[0], last[1]) == (len(member), len(member) + len(gzip.compress(parts[0])))


def test_a_member_that_breaks_off_gives_what_it_holds():
    rng = random.Random(2)
    parts = [record(i, bytes(rng.randrange(256) for _ in range(3000))) for i in range(40)]
    member = gzip.compress(b"".join(parts), mtime=0)
    found = list(warc.salvage(member[: len(member) * 5 // 8]))
    pages = pages_of(found)
    assert pages == [str(i) for i in range(len(pages))] and 22 <= len(pages) <= 25
    assert len(inner_gaps(found)) == 1 and found[-1][1] == len(member) * 5 // 8
    broken = bytearray(member)
    broken[len(member) // 2 : len(member) // 2 + 40] = bytes(40)
    found = list(warc.salvage(bytes(broken) + gzip.compress(parts[0]) + parts[1]))
    pages = pages_of(found)
    assert pages[:15] == [str(i) for i in range(15)] and pages[-2:] == ["0", "1"]
    assert len(inner_gaps(found)) >= 1
    trailer = bytearray(gzip.compress(parts[3], mtime=0))
    trailer[-6] ^= 0xFF  # the member's own check fails, the record's hold
    found = list(warc.salvage(bytes(trailer) + parts[4]))
    assert pages_of(found) == ["3", "4"] and len(inner_gaps(found)) == 1
    no_record = gzip.compress(b"nothing of the kind")
    found = list(warc.salvage(no_record + parts[4]))
    assert [(a, b, bool(r)) for a, b, r, *_ in found][0] == (0, len(no_record), False) and pages_of(found) == ["4"]


def test_members_are_read_as_a_stream():
    parts = [record(i, b"x" * size) for i, size in enumerate([10, 3_000_000, 20, 5_000_000, 7])]
    held = []
    member = warc.Member(gzip.compress(b"".join(parts)), 0)
    stream = warc.Stream(member.pieces())
    for _, _, found, _ in warc.records_of(stream):
        held.append(len(stream.data))
        assert found
    assert len(held) == 5 and max(held) < 12_000_000 and held[0] < 9_000_000


@pytest.mark.parametrize("compressed", [True, False])
def test_salvage_takes_one_pass_however_much_is_damaged(compressed):
    pack = (lambda b: gzip.compress(b, mtime=0)) if compressed else (lambda b: b)
    rng = random.Random(3)
    one = bytes(rng.randrange(256) for _ in range(2000))

    def seconds(n):
        parts = []
        for i in range(n):
            data = bytearray(pack(record(i, one)))
            data[len(data) // 2] ^= 0xFF
            parts.append(bytes(data))
        whole = b"".join(parts)
        began = time.process_time()
        assert sum(1 for x in warc.salvage(whole) if x[2]) == 0
        return time.process_time() - began

    seconds(500)
    assert seconds(4000) < 2.5 * max(0.05, seconds(2000))


def test_archives_have_bounded_files(spark, out):
    rows = [(i, "u", f"{i} " * 500) for i in range(400)] + [(1000, "u", "y" * 300_000)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(2)
    warc.write_archives(pages, out, compressed=False, file_bytes=50_000)
    sizes = [os.path.getsize(os.path.join(out, f)) for f in os.listdir(out) if f.startswith("part")]
    assert len(sizes) > 10 and sorted(sizes)[-2] <= 60_000 and max(sizes) < 310_000
    assert warc.whole(warc.read_archives(spark, out)).count() == 401


def test_a_gap_fails_where_archives_must_be_whole(spark, tmp_path):
    (tmp_path / "a.warc").write_bytes(record(1, b"one") + b"garbage" + record(2, b"two"))
    records = warc.read_archives(spark, str(tmp_path))
    assert records.where("gap is null").count() == 2
    with pytest.raises(Exception, match="gap in"):
        warc.whole(records).collect()


def test_salvage_of_noise():
    rng = random.Random(1)
    noise = bytes(rng.randrange(256) for _ in range(5000)) + b"\x1f\x8b\x08" * 50 + b"\nWARC/1.0\r\n" * 50
    assert [(a, b) for a, b, r, *_ in warc.salvage(noise) if r is None] == [(0, len(noise))]
    assert list(warc.salvage(b"")) == [] and list(warc.salvage(warc.EMPTY_MEMBER * 3)) == []


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(0)
    model = language.new_model(["a", "b", "c"], rng)
    for d in (model.forward, model.backward):
        d.inputs, d.gates, d.candidate = (w.astype(float) for w in (d.inputs, d.gates, d.candidate))
    model.out = model.out.astype(float)
    windows, target = rng.integers(97, 103, (7, 5)).astype(np.uint8), rng.integers(3, size=5)
    real = (rng.random((7, 5)) < 0.8).astype(float)
    _, gradients = language.loss_gradients(model, windows, target, real)
    for weights, gradient in zip(model.weights(), gradients):
        place = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        kept, ends = weights[place], []
        for change in (1e-5, -1e-5):
            weights[place] = kept + change
            ends.append(language.loss_gradients(model, windows, target, real)[0])
        weights[place] = kept
        assert abs((ends[0] - ends[1]) / 2e-5 - gradient[place]) < 1e-4 * abs(gradient[place]) + 1e-8


def test_reading_in_place_is_step_after_step():
    model = language.new_model(["a", "b"], np.random.default_rng(3))
    windows = np.random.default_rng(4).integers(0, 256, (9, 4))
    kept = model.backward.trained_states(windows, range(8, -1, -1))
    states = model.backward.states(windows, range(8, -1, -1))
    for t, *_, after in kept:
        assert np.allclose(states[t], after, atol=1e-6)


SYLLABLES = {"aa": ["ba", "lo", "mi", "tu"], "bb": ["sch", "ung", "ein", "er"], "cc": ["ção", "nh", "eu", "ix"]}


def sentence(rng, lang, words=40):
    return " ".join("".join(rng.choices(SYLLABLES[lang], k=3)) for _ in range(words))


def test_held_out_documents_get_their_language(documents):
    rng = random.Random(7)
    rows = [(i, sentence(rng, lang), lang, "s") for i, lang in enumerate(rng.choices(list(SYLLABLES), k=240))]
    rows += [(900, None, "aa", "s"), (901, "123 !?", "aa", "s"), (902, "", "aa", "s"), (903, sentence(rng, "aa", 4000), None, "s"),
             (None, sentence(rng, "bb"), "bb", "s"), rows[0]]
    df = documents(rows).withColumns({"score": F.lit("x"), "language": F.lit("y"), "drawn": F.lit(0)})
    held_out = language.held_out(F.col("doc_id"))
    model = language.fitted(df.where(~held_out))
    found = language.predictions(df, model, keep=["doc_id", "lang"])
    rows = found.withColumn("held_out", held_out).collect()
    tested = [r for r in rows if r["held_out"] and r["lang"] and r["lang_pred"] != "und"]
    assert len(tested) > 30 and np.mean([r["lang"] == r["lang_pred"] for r in tested]) > 0.95
    by_key = {r["doc_id"]: r for r in rows}
    assert [by_key[k]["lang_pred"] for k in (900, 901, 902, 903)] == ["und", "und", "und", "aa"]
    assert by_key[None]["lang_pred"] == "bb" and not by_key[None]["held_out"]
    assert all(0 <= r["score"] <= 1 for r in rows)
    kept = language.in_known_languages(df, model)
    assert kept.columns == df.columns and kept.where("doc_id in (900, 901, 902)").count() == 0
    unlabelled = language.fitted(df.limit(0))
    assert {r["lang_pred"] for r in language.predictions(df, unlabelled).collect()} == {"und"}


def test_held_out_accuracy_by_length(spark):
    table = queries.table(spark, "/root/testdata/sf0.01", "documents")
    model = language.fitted(table.where(~language.held_out(F.col("doc_id"))))
    rows = table.where(language.held_out(F.col("doc_id")) & F.col("lang").isNotNull()).collect()
    rng = random.Random(1)
    for words, least in ((4, 0.9), (10, 0.96), (20, 0.97), (None, 0.98)):
        texts, labels = [], []
        for row in rows:
            own = (row["text"] or "").split()
            if len(own) >= (words or 1):
                start = rng.randrange(len(own) - (words or len(own)) + 1)
                texts.append(" ".join(own[start : start + (words or len(own))]))
                labels.append(row["lang"])
        found, _ = model.predict(texts)
        known = [(a, b) for a, b in zip(labels, found) if b != "und"]
        assert len(known) > 150 and np.mean([a == b for a, b in known]) > least, words


def test_windows_label_every_position():
    model = language.new_model(["a", "b"], np.random.default_rng(3))
    text = "abcdefgh" * 40
    data = np.frombuffer(text.encode(), np.uint8).reshape(-1, language.WINDOW)
    at = model.positions(data.T.astype(np.intp, order="C"))
    assert at.shape == (language.WINDOW, 2, len(data))
    label, score = model.predict([text])
    assert np.isclose(score[0], at.mean((0, 2)).max(), atol=1e-5) and label[0] in ("a", "b")


SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_give_what_their_sql_gives(spark, name):
    from tests.compare import connect, differences

    assert differences(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLES[name]) == []


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
def test_pipeline_stages_against_brute_force(spark):
    import corpus_pipeline
    from recordlake.llm import secrets, string_tiling

    docs = queries.table(spark, SF_DIR, "documents").cache()
    steps = [docs]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        steps.append(stage(spark, steps[-1], SF_DIR).cache())
        assert steps[-1].columns == docs.columns
    ids = [{r["doc_id"] for r in s.select("doc_id").collect()} for s in steps]
    letters = {r["doc_id"] for r in docs.collect() if any(map(str.isalpha, r["text"] or ""))}
    assert ids[1] <= letters and len(ids[1]) >= 0.97 * len(letters)
    texts = {r["doc_id"]: r["text"] for r in steps[1].collect()}
    prints = {key: brute_fingerprint(text, 4) for key, text in texts.items()}
    classes = brute_classes(prints, lambda a, b: bin(prints[a] ^ prints[b]).count("1") <= 4)
    assert ids[2] == set(classes.values()) and len(ids[2]) < len(ids[1])
    bench = [string_tiling.token_hashes(r["text"]).tolist() for r in queries.table(spark, SF_DIR, "benchmark").collect()]
    given = set()
    for key in ids[2]:
        tokens = string_tiling.token_hashes(texts[key]).tolist()
        for item in bench:
            n = len(item)
            if n and any(tokens[i : i + n] == item for i in range(len(tokens) - n + 1)):
                given.add(key)
    assert not ids[3] & given and ids[4] == ids[3]
    assert all(not secrets.base_spans(r["text"]) for r in steps[4].collect())
    last = corpus_pipeline.tokenized(spark, steps[4], SF_DIR)
    assert last.count() == len(ids[4]) and last.where("size(ids) <> n_tokens").count() == 0
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(queries.vocabulary("word_bpe_49k.json"))
    library.no_truncation()
    left = {r["doc_id"]: r["text"] for r in steps[4].collect()}
    for row in last.collect():
        wanted = library.encode(left[row["doc_id"]] or "", add_special_tokens=False).ids
        assert row["ids"] == wanted and row["decoded"] == library.decode(wanted, skip_special_tokens=False)
