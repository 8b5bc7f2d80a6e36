"""One query per operator, over whole tables, with SQL where SQL gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordlake.llm import (
    language,
    line_frequency,
    passages,
    periodic_runs,
    secrets,
    simhash,
    string_tiling,
    token_counts,
    token_shards,
    url_rules,
    warc,
    whitening,
    word_bpe,
)
from recordlake.scratch import scratch_path

QUERIES = {}
ORACLES = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLES[function.__name__] = sql
        return function

    return register


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def vocabulary(name: str) -> str:
    """The path of a vocabulary file, which every executor has under the same path."""
    import public_tokenizers

    return public_tokenizers.path(name)


WORD = r"'[^\x20\x09-\x0D]+'"


@query(rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), {WORD}) AS ws FROM documents),
split AS (SELECT r, source, unnest(string_split(t, chr(10))) AS line FROM d),
lines AS (SELECT r, source, line, regexp_extract_all(line, {WORD}) AS ws FROM split
          WHERE regexp_matches(line, {WORD})),
dups AS (SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines FROM lines GROUP BY r),
normal AS (
  SELECT r, source, len(ws) AS words, regexp_replace(translate(array_to_string(ws, ' '),
         'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9]', '0', 'g') AS line
  FROM lines),
distinct_lines AS (SELECT r, source, line, sum(words) AS words FROM normal GROUP BY r, source, line),
sizes AS (SELECT source, count(*) AS documents FROM d GROUP BY source),
frequent AS (
  SELECT c.source, line FROM (SELECT source, line, count(*) AS n FROM distinct_lines GROUP BY ALL) c
  JOIN sizes s ON c.source IS NOT DISTINCT FROM s.source WHERE n >= 10 AND 100 * n > 5 * documents),
removed AS (
  SELECT r, sum(words) AS n FROM distinct_lines l
  JOIN frequent f ON l.line = f.line AND l.source IS NOT DISTINCT FROM f.source GROUP BY r),
starts AS (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM d),
windows AS (SELECT r, i, ws[i:i + 2] AS w FROM starts),
repeated AS (SELECT r, i, count(*) OVER (PARTITION BY r, w) AS n FROM windows),
words AS (SELECT r, count(DISTINCT i + k) AS n FROM repeated, range(3) AS t(k) WHERE n > 1 GROUP BY r),
figures AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
         CAST(length(array_to_string(ws, '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(words.n, 0) AS n_repeat_words,
         CAST(coalesce(removed.n, 0) AS BIGINT) AS n_removed_words
  FROM d LEFT JOIN dups USING (r) LEFT JOIN words USING (r) LEFT JOIN removed USING (r)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM figures)
SELECT *, NOT base_failed AND 100 * (n_words - n_removed_words) >= 50 * n_words AS kept FROM judged
""")
def op1_line_frequency(spark, sf_dir):
    return line_frequency.line_quality(table(spark, sf_dir, "documents"))


#: Host, path and verdict of the rules that the query applies.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]


@query(f"""
WITH rules(h, p, v) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}),
pages_split AS (
  SELECT row_number() OVER () AS r, page_id,
         translate(coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), ''),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
fitting AS (
  SELECT r, h || p AS rule, v FROM pages_split JOIN rules
  ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
  QUALIFY row_number() OVER (PARTITION BY r ORDER BY length(h || p) DESC) = 1)
SELECT page_id, host, path, rule, coalesce(v, 'allow') AS verdict
FROM pages_split LEFT JOIN fitting USING (r)
""")
def op2_url_rules(spark, sf_dir):
    rules = url_rules.rule_table(spark, RULES)
    return url_rules.judged_urls(table(spark, sf_dir, "pages"), rules)


@query()
def op3_secret_scan(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    models = secrets.train(secrets.labelled_samples(documents))
    return secrets.secret_spans(documents, models, keep=["doc_id"])


@query()
def op4_word_bpe(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return word_bpe.round_trips(documents, vocabulary("word_bpe_49k.json"), keep=["doc_id"])


@query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h FROM pages),
groups AS (SELECT html, max(page_id) AS largest FROM p GROUP BY html)
SELECT page_id, CAST(strlen(p.html) AS BIGINT) AS payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         CAST(1 + ((CAST('0x' || substr(h, 1 + 5 * (k // 4), 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31)
         AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> largest THEN largest END AS refers_to
FROM p JOIN groups USING (html)
""")
def op5_warc(spark, sf_dir):
    path = scratch_path(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), path)
    records = warc.whole(warc.read_archives(spark, path))
    return records.select(
        F.col("page").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


@query()
def op6_simhash(spark, sf_dir):
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


@query()
def op7_language(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    held_out = language.held_out(F.col("doc_id"))
    model = language.fitted(documents.where(~held_out))
    found = language.predictions(documents, model, keep=["doc_id"])
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query(rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), {WORD}) AS ws
  FROM documents),
starts AS (SELECT r, ws, unnest(range(1, len(ws) - 33)) AS i FROM d),
windows AS (SELECT r, i, array_to_string(ws[i:i + 34], ' ') AS w FROM starts),
counted AS (SELECT r, i, count(*) OVER (PARTITION BY w) AS n FROM windows),
gone AS (SELECT DISTINCT r, i + k AS i FROM counted, range(35) AS t(k) WHERE n > 1),
per_document AS (SELECT r, list(i) AS removed FROM gone GROUP BY r),
kept AS (
  SELECT doc_id, ws, list_filter(range(1, len(ws) + 1),
         lambda i: NOT list_contains(coalesce(removed, CAST([] AS BIGINT[])), i)) AS left_words
  FROM d LEFT JOIN per_document USING (r))
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(len(ws) - len(left_words) AS BIGINT) AS n_removed,
       sha256(array_to_string(list_transform(left_words, lambda i: ws[i]), ' ')) AS kept_sha256 FROM kept
""")
def op8_repeated_passages(spark, sf_dir):
    found = passages.without_repeated_passages(table(spark, sf_dir, "documents"), with_text=False)
    return found.drop("kept_text")


@query()
def op9_string_tiling(spark, sf_dir):
    return string_tiling.contaminations(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@query()
def op10_token_counts(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return token_counts.token_counts(documents, vocabulary("byte_bpe_50k.json"), keep=["doc_id"])


@query()
def op11_whitening(spark, sf_dir):
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


@query()
def op12_token_shards(spark, sf_dir):
    path = scratch_path(spark, "token-shards")
    documents = table(spark, sf_dir, "documents")
    token_shards.write_token_shards(documents, path, vocabulary("byte_bpe_50k.json"))
    found = token_shards.read_token_shards(spark, path)
    return found.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query()
def op13_periodic_runs(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    text = periodic_runs.planted(F.col("text"), F.col("doc_id"))
    found = periodic_runs.with_periodic_runs(documents, text, keep=["doc_id"])
    return periodic_runs.run_digests(found)
