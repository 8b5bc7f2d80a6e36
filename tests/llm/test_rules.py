"""Line frequency, URL rules and secrets against brute force on small tables."""

from __future__ import annotations

import itertools
import random
import re
import time
from collections import Counter
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from recordlake.llm import queries, secrets, url_rules
from recordlake.llm.line_frequency import line_quality, repeated_words, without_frequent_lines
from recordlake.llm.url_rules import judged_urls, rule_table
from tests.helpers import plan

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_quality(rows, min_documents, max_percent):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789", "abcdefghijklmnopqrstuvwxyz0000000000")
    hosts, lines, found = Counter(r[3] for r in rows), Counter(), []
    for _, text, _, host in rows:
        own = {" ".join(WORD.findall(x)).translate(lower) for x in (text or "").split("\n")} - {""}
        lines.update((host, x) for x in own)
    for key, text, _, host in rows:
        words, kept, seen, dups = WORD.findall(text or ""), 0, set(), 0
        for x in (text or "").split("\n"):
            if not WORD.search(x):
                continue
            dups += x in seen
            seen.add(x)
            n = lines[host, " ".join(WORD.findall(x)).translate(lower)]
            if not (n >= min_documents and 100 * n > max_percent * hosts[host]):
                kept += len(WORD.findall(x))
        windows = Counter(zip(words, words[1:], words[2:]))
        places = {i + k for i, w in enumerate(zip(words, words[1:], words[2:])) if windows[w] > 1 for k in range(3)}
        failed = len(words) < 50 or 100 * len(places) > 50 * len(words)
        symbols = sum((text or "").count(c) for c in "#*$%&|<>")
        found.append(
            (key, len(words), sum(map(len, words)), symbols, dups, len(places), len(words) - kept,
             failed, not failed and 100 * kept >= 50 * len(words))
        )
    return found


def test_line_quality_against_brute_force(documents):
    rng = random.Random(2)
    common = [" ".join(f"c{rng.randrange(9)}" for _ in range(20)) for _ in range(4)]
    rows = []
    for i in range(60):
        lines = [" ".join(f"w{rng.randrange(300)}é" for _ in range(rng.randrange(1, 40))) for _ in range(3)]
        lines += [rng.choice(common).upper() for _ in range(rng.randrange(4))] + ["", " # \t|"]
        rng.shuffle(lines)
        rows.append((i, "\n".join(lines), None, rng.choice(["a", "a", "b", None])))
    rows += [(100, None, None, "a"), (101, "", None, None), (None, rows[0][1], None, "a"), rows[1], rows[1]]
    found = line_quality(documents(rows), min_documents=5, max_percent=20)
    assert Counter(map(tuple, found.collect())) == Counter(brute_quality(rows, 5, 20))
    assert {r["kept"] for r in found.collect()} == {True, False}


def test_line_quality_with_clashing_columns_and_no_rows(documents):
    df = documents([(1, "a b\n" * 60, None, "h")])
    for name in ("n_words", "lines", "host", "key_a", "kept"):
        df = df.withColumn(name, F.lit("x"))
    row = line_quality(df).first()
    assert (row["n_words"], row["n_dup_lines"], row["base_failed"], row["kept"]) == (120, 59, True, False)
    assert line_quality(df.limit(0)).count() == 0


def test_frequent_lines_leave_the_texts(documents):
    rng = random.Random(9)
    rows = []
    for i in range(40):
        own = [" ".join(f"w{rng.randrange(900)}" for _ in range(30)) for _ in range(4)]
        shared = [f"  Page {i} of\tthis  HOST", f"{'menu ' * 3}{i % 7}", "", "once é"]
        lines = own[:2] + shared[: 1 + i % 4] + own[2:]
        rows.append((i, "\n".join(lines), "en", "a" if i < 30 else "b"))
    rows += [(50, "too short", "en", "a"), (51, None, "en", "a"), rows[3], (None, rows[2][1], None, "a")]
    df = documents(rows).withColumns({"rest": F.lit("r"), "c0": F.lit(1), "gone": F.lit(2), "cleaned": F.lit("t")})
    found = without_frequent_lines(df, min_documents=5, max_percent=20)
    assert found.columns == df.columns

    def common(line, host):
        return host == "a" and (line.startswith(("  Page", "menu")) or line == "once é") or host == "b" and (
            line.startswith(("  Page", "menu")))

    kept = [r for r in rows if r[0] not in (50, 51)]
    expected = [
        (k, "\n".join(x for x in t.split("\n") if not common(x, h)), lang, h) for k, t, lang, h in kept
    ]
    got = [(r["doc_id"], r["text"], r["lang"], r["source"]) for r in found.collect()]
    assert Counter(got) == Counter(expected)
    quality = line_quality(df, min_documents=5, max_percent=20).where("kept").collect()
    left = Counter((r["doc_id"], r["n_words"] - r["n_removed_words"]) for r in quality)
    assert left == Counter((k, len(t.split())) for k, t, *_ in got)
    assert without_frequent_lines(df.limit(0)).count() == 0


def test_repeated_words_overlap():
    assert repeated_words("a a a a".split()) == 4
    assert repeated_words("a b c x a b c".split()) == 6
    assert repeated_words("a b".split()) == 0


RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/es/a", "allow"), ("net", "/fr/", "block"), ("example.net", "/es", "allow"),
    ("x.example.net", "", "block"), ("net", "/fr/", "allow"), ("", "/", "block"), ("org", None, "block"),
]


def brute_rule(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "")
    host, path = (m[1], m[2]) if m else ("", "")
    host = re.sub("[A-Z]", lambda c: c[0].lower(), host)
    fit = [
        (len(h) + len(p or ""), len(h), h + (p or ""), v) for h, p, v in RULES
        if h and (host == h or host.endswith("." + h)) and path.startswith(p or "")
    ]
    best = max(fit, default=(0, 0, None, "allow"))
    return host, path, best[2], best[3]


def test_url_rules_against_brute_force(spark, settings):
    settings("spark.sql.shuffle.partitions", "3")
    rng = random.Random(1)
    hosts = ["example.com", "www.EXAMPLE.com", "a.www.example.com", "net", "example.net", "x.example.net",
             "y.x.example.net", "notexample.com", "com", "org", "a.org.", "", "a..com", "é.com", "a,b.net", "com.net"]
    paths = ["", "/", "/en/", "/en/x", "/es/a/b", "/es", "/fr/?q", "/fr/1#t", "?/en/", "#/es/", "/EN/", "/es/ab\n"]
    urls = ["http://" + rng.choice(hosts) + rng.choice(paths) for _ in range(300)]
    urls += [None, "", "example.com/en/", "://", "a://b://example.com/en/", "http://" + "a." * 500 + "com/"]
    rows = [(i, u) for i, u in enumerate(urls)] + [(5, urls[5]), (None, urls[0])]
    pages = spark.createDataFrame(rows, "page_id long, url string")
    pages = pages.withColumns({c: F.lit(1) for c in ("host", "verdict", "share", "place", "number")})
    found = judged_urls(pages, rule_table(spark, RULES))
    expected = Counter((i, *brute_rule(u)) for i, u in rows)
    assert Counter(map(tuple, found.collect())) == expected
    text = plan(found)
    assert not any(x in text for x in ("Python", "Arrow", "NestedLoop", "Cartesian"))


def test_url_rules_with_empty_tables(spark):
    pages = spark.createDataFrame([(1, "http://a.com/x")], "page_id long, url string")
    rules = rule_table(spark, RULES)
    assert judged_urls(pages.limit(0), rules).count() == 0
    assert tuple(judged_urls(pages, rules.limit(0), default="block").first()) == (1, "a.com", "/x", None, "block")


def nested_rules(rng, n):
    labels, parts = ["a", "b", "c"], ["/", "/x", "/x/", "/x/y", "/z", ""]
    rules = {}
    for _ in range(n):
        host = ".".join(rng.choice(labels) for _ in range(rng.randrange(1, 5)))
        rules[host, rng.choice(parts)] = rng.choice(["allow", "block", "check"])
    return [(h, p, v) for (h, p), v in sorted(rules.items())]


def longest_rule(url, rules):
    host, path = split_url(url)
    fits = [(len(h) + len(p), len(h), h + p, v) for h, p, v in rules
            if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fits)[2:] if fits else (None, "allow")


def split_url(url):
    rest = (url or "").partition("://")[2]
    host = re.split("[/?#]", rest, maxsplit=1)[0]
    return host.lower(), re.split("[?#]", rest[len(host):], maxsplit=1)[0]


@pytest.mark.parametrize("partitions", ["1", "40"])
def test_ranges_begin_with_the_rules_open_at_the_cut(spark, settings, partitions):
    settings("spark.sql.shuffle.partitions", partitions)
    settings("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rng = random.Random(8)
    rules = nested_rules(rng, 120)
    hosts = [".".join(rng.choice("abcd") for _ in range(rng.randrange(1, 7))) for _ in range(200)]
    paths = ["", "/", "/x", "/x/", "/x/y/z", "/zz", "/w"]
    rows = [(i, f"h://{rng.choice(hosts)}{rng.choice(paths)}") for i in range(500)]
    rows += [(1000 + i, "h://a.b/x/y?q") for i in range(300)] + rows[:50]  # a hot key, and repeated rows
    pages = spark.createDataFrame(rows, "page_id long, url string")
    found = judged_urls(pages, rule_table(spark, rules)).collect()
    expected = Counter((i, *split_url(u), *longest_rule(u, rules)) for i, u in rows)
    assert Counter(map(tuple, found)) == expected
    assert len({r["rule"] for r in found}) > 40


def test_rules_are_not_repeated_for_more_partitions(spark, settings):
    settings("spark.sql.adaptive.coalescePartitions.enabled", "false")
    rules = nested_rules(random.Random(5), 200)
    table = rule_table(spark, rules)
    pages = spark.range(2000).selectExpr("id as page_id", "concat('h://a.b.c', id % 50, '.b/x/', id) as url")
    for partitions in ("4", "100"):
        settings("spark.sql.shuffle.partitions", partitions)
        events = url_rules.sweep_events(pages, url_rules.clean_rules(table), 4, "page_id", "url").cache()
        assert events.where("kind <> 1").count() == 2 * len(rules)
        assert events.select("share").distinct().count() == int(partitions)
        deepest = 4 * 6  # labels of a host, and paths that may nest
        assert url_rules.open_at_cuts(events).count() <= deepest * int(partitions)
        events.unpersist()


def test_upper_case_rule_hosts_fit(spark):
    pages = spark.createDataFrame([(1, "http://WWW.example.com/A/b"), (1, "http://www.example.com/A/b")], "page_id long, url string")
    rules = rule_table(spark, [("Example.COM", "/A/", "block")])
    assert [tuple(r) for r in judged_urls(pages, rules).collect()] == [
        (1, "www.example.com", "/A/b", "example.com/A/", "block")
    ] * 2


def test_base_spans_follow_the_patterns():
    text = (
        "password = 'abcdefghijkl' TOKEN:short secret=token: abcdefghijklmn é AKIAABCDEFGHIJKLMN AKIA123 "
        "0123456789abcdef 0123456789abcde api-key=xxxxxxxxxxxxxxx API_KEY=deadbeefdeadbeef"
    )
    kinds = [(text[a:b], k) for a, b, k in sorted(secrets.base_spans(text))]
    assert kinds == [
        ("password = 'abcdefghijkl", "assign"), ("AKIAABCDEFGHIJKLMN", "access"), ("0123456789abcdef", "hex"),
        ("API_KEY=deadbeefdeadbeef", "assign"), ("deadbeefdeadbeef", "hex"),
    ]
    assert secrets.base_spans("paſſword=zzzzzzzzzzzzzzzz") == []  # letters A-Z only


def test_markov_scores_against_a_plain_sum(spark):
    rng = random.Random(9)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    words = ["configuration", "management", "identifier", "transaction", "information", "application"]
    rows = [("".join(rng.choice(alphabet) for _ in range(30)), True) for _ in range(4000)]
    rows += [("_".join(rng.sample(words, 2)), False) for _ in range(4000)]
    rows += [(None, True), ("x", None)]
    models = secrets.train(spark.createDataFrame(rows, "text string, is_secret boolean"))
    held_out = ["".join(rng.choice(alphabet) for _ in range(24)) for _ in range(100)]
    plain = ["_".join(rng.sample(words, 3)) for _ in range(100)]
    assert (models.scores(held_out) > models.threshold).mean() > 0.95
    assert (models.scores(plain) > models.threshold).mean() < 0.05
    s, before, total = held_out[0], 0, 0.0
    for c in s:
        state = int(secrets._CLASSES[ord(c)])
        total += models.ratios[before, state]
        before = state
    assert abs(total - models.scores([s])[0]) < 1e-9


def plain_segments(steps):
    """The segment of greatest sum, then those to its left and right, by trying all."""
    best = (0.0, 0, 0)
    for a in range(len(steps)):
        total = 0.0
        for b in range(a, len(steps)):
            total += steps[b]
            if total > best[0] + 1e-9:
                best = (total, a, b + 1)
    if best[0] <= 0:
        return []
    _, a, b = best
    return [*plain_segments(steps[:a]), (a, b), *[(x + b, y + b) for x, y in plain_segments(steps[b:])]]


def plain_marks(steps, least, threshold):
    """The segments beyond the threshold, short ones widened and overlapping ones united."""
    found = []
    for a, b in plain_segments(steps):
        if b - a < least:
            starts = [s for s in range(len(steps) - least + 1) if s <= a and b <= s + least]
            a = max(starts, key=lambda s: (round(sum(steps[s : s + least]), 9), -s))
            b = a + least
        if sum(steps[a:b]) <= threshold:
            continue
        while found and a < found[-1][1]:
            x, y = found.pop()
            a, b = min(a, x), max(b, y)
        found.append((a, b))
    return found


def test_greatest_segments_against_all_segments():
    rng = random.Random(2)
    for _ in range(300):
        steps = [rng.choice([-3, -1.5, -1, 1, 1.5, 2, 4]) + rng.random() / 100 for _ in range(rng.randrange(60))]
        assert [(a, b) for a, b, _ in secrets.greatest_segments(steps)] == plain_segments(steps)


def plain_spans(text, models):
    """The spans of a text, character by character."""
    base = sorted(secrets.base_spans(text))
    free = [c.isascii() and (c.isalnum() or c in "+/_=-") for c in text]
    runs, at = [], 0
    for ok, group in itertools.groupby(free):
        size = len(list(group))
        if ok and size >= secrets.LEAST:
            runs.append((at, at + size))
        at += size
    spans = list(base)
    for a, b in runs:
        own = [i for i in range(a, b) if not any(x <= i < y for x, y, _ in base)]
        pieces = [[]]
        for i in own:
            if pieces[-1] and pieces[-1][-1] != i - 1:
                pieces.append([])
            pieces[-1].append(i)
        for piece in pieces:
            if len(piece) >= secrets.LEAST:
                states = [0, *(int(secrets._CLASSES[ord(text[i])]) for i in piece)]
                steps = [float(models.ratios[x, y]) for x, y in zip(states, states[1:])]
                for x, y in plain_marks(steps, secrets.LEAST, models.threshold):
                    spans.append((piece[0] + x, piece[0] + y, "random"))
    return ",".join(f"{k}:{a}:{b}" for a, b, k in sorted(spans, key=lambda s: (s[0], secrets.KINDS.index(s[2]))))


def random_key(rng, n):
    return "".join(rng.choice("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789") for _ in range(n))


@pytest.fixture(scope="module")
def trained(spark):
    rng = random.Random(9)
    words = ["configuration", "management", "identifier", "transaction", "information", "application", "directory"]
    rows = [(random_key(rng, 30), True) for _ in range(4000)]
    rows += [(rng.choice("_-/").join(rng.sample(words, 3)), False) for _ in range(4000)]
    return secrets.train(spark.createDataFrame(rows, "text string, is_secret boolean"))


def test_keys_beside_other_text_are_found(trained):
    rng = random.Random(4)
    hits = 0
    for _ in range(100):
        first, second = random_key(rng, 24), random_key(rng, 24)
        path = "/information/application_configuration/management/"
        text = f"0123456789abcdef0123_{first} and {path}{second} end"
        spans = secrets.found_spans([text], trained)[0]
        assert (0, 20, "hex") in spans
        marked = [set(range(a, b)) for a, b, kind in spans if kind == "random"]
        keys = [set(range(at, at + 24)) for at in (text.index(first), text.index(second))]
        hits += all(any(len(m & key) >= 18 for m in marked) for key in keys)
        assert not any("application" in text[min(m) : max(m)] for m in marked)
    assert hits > 90


def test_long_runs_take_one_pass(trained):
    rng = random.Random(6)
    text = "".join(rng.choice("configuration_management/") for _ in range(400_000))
    began = time.process_time()
    secrets.found_spans([text, "A" * 400_000, random_key(rng, 200_000)], trained)
    assert time.process_time() - began < 10


def test_the_query_against_a_plain_scan(spark):
    sf_dir = "/root/testdata/sf0.001"
    table = queries.table(spark, sf_dir, "documents")
    models = secrets.train(secrets.labelled_samples(table))
    rows = {r["doc_id"]: r for r in queries.QUERIES["op3_secret_scan"](spark, sf_dir).collect()}
    documents = table.select("doc_id", "text").collect()
    assert len(rows) == len(documents)
    for key, text in documents:
        assert rows[key]["spans"] == plain_spans(text or "", models), key


def test_models_are_right_on_labels_kept_back(spark):
    samples = secrets.labelled_samples(queries.table(spark, "/root/testdata/sf0.1", "documents"))
    samples = samples.withColumn("fold", F.pmod(F.xxhash64(F.lit(5), "text"), F.lit(2))).cache()
    models = secrets.train(samples.where("fold = 0"))
    kept = samples.where("fold = 1 and length(text) >= 16").collect()
    truth = [r["is_secret"] for r in kept]
    guess = [any(s) for s in models.segments([re.sub("[^!-~]", "-", r["text"]) for r in kept])]
    hits = sum(t and g for t, g in zip(truth, guess))
    assert sum(truth) > 150 and hits / sum(truth) > 0.97, (hits, sum(truth))
    assert hits / max(1, sum(guess)) > 0.97, (hits, sum(guess))


def test_secrets_of_a_table(documents):
    key = "Zx9Kq2Lw7Rt4Yp1Bn6Vc3Md8"
    rows = [(i, f"ordinary words about configuration_management and responsibilities {i}") for i in range(40)]
    rows += [(100 + i, f"password={key[i % 5:]}{i:02d}Qz7") for i in range(40)]
    rows += [(1, None), (2, ""), (None, f"see {key}x9Jw2"), (3, "token: aaaabbbbcccc"), (3, "token: aaaabbbbcccc")]
    df = documents(rows)
    models = secrets.train(secrets.labelled_samples(df))
    found = {}
    for r in secrets.secret_spans(df, models, keep=["doc_id"]).collect():
        found.setdefault(r["doc_id"], []).append(r)
    assert found[None][0]["spans"].startswith("random:4:") and found[None][0]["n_random"] == 1
    assert [r["spans"] for r in found[3]].count("assign:0:19") == 2
    assert found[3][-1]["base_sha256"] == sha256(b"assign:0:19").hexdigest()
    assert all(r["spans"] == "" for i in (1, 2, 10) for r in found[i] if r["n_assign"] == 0)
    clean = secrets.without_secrets(df, models)
    assert clean.columns == df.columns and clean.count() == df.count()
    texts = [r["text"] for r in clean.collect()]
    assert None in texts and not any(key[5:] in (t or "") for t in texts)
    assert secrets.secret_spans(df.limit(0), secrets.train(secrets.labelled_samples(df.limit(0)))).count() == 0
