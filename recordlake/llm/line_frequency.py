"""Quality rules: lines that many documents of a host share, and base figures of a text."""

from __future__ import annotations

from collections import Counter

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from recordlake.llm.batches import append_columns, quoted, row_keys, steps, stored
from recordlake.llm.words import LOWER, SPACES

SYMBOLS = "#*$%&|<>"
#: Lines are compared with their letters A-Z in lower case and their digits as 0.
NORMAL = bytes(b"0"[0] if 48 <= c <= 57 else c for c in LOWER)

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
_LINES = ArrayType(StructType([StructField("line", LongType()), StructField("words", LongType())]))


def repeated_words(words: list) -> int:
    """Words in windows of three that stand twice or more in the text."""
    windows = list(zip(words, words[1:], words[2:]))
    if len(set(windows)) == len(windows):
        return 0
    counts, covered, end = Counter(windows), 0, 0
    for i, window in enumerate(windows):
        if counts[window] > 1:
            covered += i + 3 - max(i, end)
            end = i + 3
    return covered


def line_hash(line: bytes) -> int | None:
    """The hash by which lines are compared; None if the line has no word."""
    found = line.split()
    if not found:
        return None
    key = xxhash.xxh64_intdigest(b" ".join(found).translate(NORMAL))
    return key - (1 << 64) if key >> 63 else key


def without_lines(text: str | None, gone: list[int] | None) -> str | None:
    """The text without the lines of these hashes; as it is if there are none."""
    if text is None or not gone:
        return text
    hashes = set(gone)
    return b"\n".join(x for x in text.encode().split(b"\n") if line_hash(x) not in hashes).decode()


def figures(texts: list[str | None]) -> list[list]:
    """The base figures of each text, and its distinct normalised lines with their words."""
    rows = []
    for text in texts:
        text = text or ""
        data = text.encode()
        words = data.split()
        seen, duplicates, lines = set(), 0, {}
        for line in data.split(b"\n"):
            key = line_hash(line)
            if key is not None:
                duplicates += line in seen
                seen.add(line)
                lines[key] = lines.get(key, 0) + len(line.split())
        rows.append(
            (
                len(words),
                len(text) - sum(text.count(chr(c)) for c in SPACES),
                sum(text.count(c) for c in SYMBOLS),
                duplicates,
                repeated_words(words),
                [{"line": k, "words": n} for k, n in lines.items()],
            )
        )
    return [list(column) for column in zip(*rows)]


def line_quality(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    min_documents: int = 10,
    max_percent: int = 5,
    min_kept_percent: int = 50,
    min_words: int = 50,
    max_repeat_percent: int = 50,
) -> DataFrame:
    """Judge documents by their own figures and by the lines they share with others of their host.

    A line is hashed after its white space is reduced to single spaces, A-Z are lower-cased and
    digits become 0. It is removed from a host if ``min_documents`` or more of the host's
    documents hold it and these are more than ``max_percent`` of them. A document is rejected if
    its own figures fail (``base_failed``: fewer than ``min_words`` words, or more than
    ``max_repeat_percent`` of its words in repeated windows of three), or if fewer than
    ``min_kept_percent`` of its words are left without those lines.

    Returns a row per row: the key, the five figures, ``n_removed_words``, ``base_failed``,
    ``kept``. Every row is a document, so repeated rows count each. A null text has no words and
    fails; documents with a null host share one host; the key may be null. Other columns are not
    read. An empty table gives an empty table.
    """
    limits = min_documents, max_percent, min_kept_percent, min_words, max_repeat_percent
    columns = [F.col("key").alias(key), *BASE, "n_removed_words", "base_failed", "kept"]
    return judged(df, key, text, host, *limits).select(*columns)


def without_frequent_lines(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    host: str = "source",
    min_documents: int = 10,
    max_percent: int = 5,
    min_kept_percent: int = 50,
    min_words: int = 50,
    max_repeat_percent: int = 50,
) -> DataFrame:
    """The documents that :func:`line_quality` keeps, without the frequent lines of their hosts.

    The columns are those of ``df``; all other lines of a text stay as they are and in order. The
    lines that leave are those whose words :func:`line_quality` counts.
    """
    limits = min_documents, max_percent, min_kept_percent, min_words, max_repeat_percent
    changed = judged(df, key, text, host, *limits).where("gone is not null or not kept")
    # Written first, so its true size decides whether the texts are shuffled. Equal rows are judged alike.
    changed = changed.select("key_a", "key_b", "kept", "gone").dropDuplicates(["key_a", "key_b"])
    changed = stored(changed, "changed")
    rest = [c for c in df.columns if c != text]
    others = F.struct(*[F.col(quoted(c)).alias(f"c{k}") for k, c in enumerate(rest)]).alias("rest")
    rows = df.select(F.col(quoted(text)).alias("text"), others, *row_keys(key, text, host))
    rows = rows.join(changed, ["key_a", "key_b"], "left").where("coalesce(kept, true)")
    rows = rows.select("text", "gone", "rest")
    schema = StructType([StructField("text", StringType()), rows.schema["rest"]])

    def run(batches):
        for batch in batches:
            for step in steps(batch):
                pairs = zip(step.column(0).to_pylist(), step.column(1).to_pylist())
                texts = pa.array([without_lines(t, gone) for t, gone in pairs], pa.string())
                yield pa.RecordBatch.from_arrays([texts, step.column(2)], names=schema.names)

    fields = {c: F.col(f"rest.c{k}") for k, c in enumerate(rest)} | {text: F.col("text")}
    return rows.mapInArrow(run, schema).select(*[fields[c].alias(c) for c in df.columns])


def judged(
    df: DataFrame,
    key: str,
    text: str,
    host: str,
    min_documents: int,
    max_percent: int,
    min_kept_percent: int,
    min_words: int,
    max_repeat_percent: int,
) -> DataFrame:
    """Every row's keys, figures and verdict, and the hashes of its frequent lines (``gone``) if it has any."""
    fields = [*[StructField(name, LongType()) for name in BASE], StructField("lines", _LINES)]
    source = df.select(
        F.col(quoted(key)).alias("key"),
        F.col(quoted(text)).alias("text"),
        F.xxhash64(F.lit(0), F.col(quoted(host))).alias("host"),
        *row_keys(key, text, host),
    )
    measured = stored(
        append_columns(source, "text", fields, figures, ["key", "host", "key_a", "key_b"]), "lines"
    )
    frequent = frequent_lines(measured, min_documents, max_percent)
    # Few rows: those of frequent lines. Equal rows have equal lines, which count once.
    removed = (
        measured.select("key_a", "key_b", "host", F.inline("lines"))
        .join(frequent, ["host", "line"], "leftsemi")
        .groupBy("key_a", "key_b", "line")
        .agg(F.first("words").alias("words"))
        .groupBy("key_a", "key_b")
        .agg(F.sum("words").alias("removed"), F.collect_list("line").alias("gone"))
    )
    n_words, lost = F.col("n_words"), F.coalesce("removed", F.lit(0).cast("long"))
    failed = (n_words < min_words) | (
        100 * F.col("n_repeat_words") > max_repeat_percent * n_words
    )
    return measured.join(removed, ["key_a", "key_b"], "left").select(
        "key",
        "key_a",
        "key_b",
        "gone",
        *BASE,
        lost.alias("n_removed_words"),
        failed.alias("base_failed"),
        (~failed & (100 * (n_words - lost) >= min_kept_percent * n_words)).alias("kept"),
    )


def frequent_lines(measured: DataFrame, min_documents: int, max_percent: int) -> DataFrame:
    """Host and hash of the lines above the limits.

    Counts combine per task before they are shuffled. Lines below the first limit are gone
    before the counts meet the sizes of the hosts, so no large host gathers its lines.
    """
    counts = (
        measured.select("host", F.explode("lines.line").alias("line"))
        .groupBy("host", "line")
        .count()
        .where(F.col("count") >= min_documents)
    )
    sizes = measured.groupBy("host").agg(F.count("*").alias("documents"))
    above = 100 * F.col("count") > max_percent * F.col("documents")
    return stored(counts.join(sizes, "host").where(above).select("host", "line"), "frequent")
