"""Quality rules with host verdicts.

Every text is measured once. Rule failures are counted by host; for each rule, a beta prior fitted to the hosts' failure
rates by moments shrinks each host's rate towards the corpus, little for a large host and much for a small one. A host
whose shrunk rate reaches the limit for some rule is bad, and all its documents go with it.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rasterloom.llm.common import checkpointed, sub_batches, table

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: Fixed characters that count as symbols.
SYMBOLS = "#*$%&|<>"
#: A host is bad if its shrunk failure rate of a rule is at least this.
HOST_LIMIT = 0.5
WINDOW = 3
_SALTS = 64
_SPACE = str.maketrans(dict.fromkeys("\x20\x09\x0a\x0b\x0c\x0d", ""))
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
#: SQL of each rule's failure on the measures.
RULES = {
    "few_words": f"n_words < {MIN_WORDS}",
    "repeats": f"100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words",
    "word_length": "word_chars < 2 * n_words OR word_chars > 20 * n_words",
    "symbols": "n_symbols > n_words",
    "dup_lines": "2 * n_dup_lines > n_lines",
}


def measures(text: str | None) -> tuple[int, int, int, int, int, int]:
    """``MEASURES`` and the number of lines that have a word; a null text has zeros."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = text.encode("utf-8", "surrogatepass").split()
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if windows:
        counts = Counter(windows)
        if len(counts) < len(windows):
            twice = np.fromiter((counts[w] > 1 for w in windows), bool, len(windows))
            covered = np.zeros(len(words), bool)
            for shift in range(WINDOW):
                covered[shift : shift + twice.size] |= twice
            repeated = int(covered.sum())
    lines = [line for line in text.split("\n") if line.strip(" \t\r\x0b\x0c")]
    chars = len(text.translate(_SPACE)) if not text.isascii() else sum(map(len, words))
    return len(words), chars, sum(map(text.count, SYMBOLS)), len(lines) - len(set(lines)), repeated, len(lines)


def measured(docs: DataFrame, host: str = "source") -> DataFrame:
    """(doc_id, host, n_lines, ``MEASURES``), a row for each row of ``docs``."""
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sub_batches(batches, "text"):
            found = np.array([measures(t) for t in batch.column("text").to_pylist()], np.int64).reshape(-1, len(names))
            columns = [pa.array(found[:, i]) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("host"), *columns], ["doc_id", "host", *names])

    rows = docs.select(F.col("doc_id").cast("long"), F.col(host).cast("string").alias("host"), F.col("text").cast("string"))
    return rows.mapInArrow(run, "doc_id long, host string, " + ", ".join(f"{n} long" for n in names))


def host_rates(rows: DataFrame) -> DataFrame:
    """(host, docs, and for each rule <rule>_rate, the shrunk failure rate); documents of a null host are one host."""
    fails = [F.sum(F.expr(rule).cast("long")).alias(name) for name, rule in RULES.items()]
    hosts = checkpointed(rows.groupBy("host").agg(F.count("*").alias("docs"), *fails))
    moments = []
    for name in RULES:
        rate = F.col(name) / F.col("docs")
        moments += [F.sum(name).alias(f"{name}_n"), F.sum(F.col("docs") * rate * rate).alias(f"{name}_2")]
    total = hosts.agg(F.sum("docs").alias("docs"), F.count("*").alias("hosts"), *moments).first()
    columns = []
    for name in RULES:
        alpha, beta = beta_prior(total["docs"] or 0, total["hosts"], total[f"{name}_n"] or 0, total[f"{name}_2"] or 0.0)
        columns.append(((F.col(name) + F.lit(alpha)) / (F.col("docs") + F.lit(alpha + beta))).alias(f"{name}_rate"))
    return hosts.select("host", "docs", *columns)


def beta_prior(docs: int, hosts: int, fails: int, squares: float) -> tuple[float, float]:
    """Moment estimates from host totals: ``squares`` is the sum of docs times the squared rate.

    The spread between hosts is what the weighted variance has beyond binomial noise; without any, the prior weighs as
    much as an average host, so that one host alone or hosts alike are still shrunk.
    """
    if not docs:
        return 1.0, 1.0
    mean = min(max(fails / docs, 1e-6), 1 - 1e-6)
    noise = mean * (1 - mean)
    spread = squares / docs - mean * mean - noise * hosts / docs
    weight = noise / spread - 1 if spread > 0 else docs / hosts
    weight = min(max(weight, 1.0), max(docs / hosts, 1.0))
    return mean * weight, (1 - mean) * weight


def judged(docs: DataFrame, host: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """A row for each row of ``docs`` (doc_id, text, host): doc_id, host, ``MEASURES``, base_failed, host_rate, kept.

    base_failed is that the text is too short or repeats itself; host_rate is the largest shrunk failure rate of the
    document's host; kept is that neither the document nor its host failed. Null and wordless texts count as no words
    and fail; a null host is a host; repeated rows count each; other columns are ignored; an empty table gives none.
    Hosts' verdicts are salted before the join, so a host with a large share of all rows is in no single task.
    """
    rows = checkpointed(measured(docs, host))
    rates = [F.col(f"{name}_rate") for name in RULES]
    verdicts = host_rates(rows).select(F.col("host").alias("__host"), F.greatest(*rates).alias("host_rate"))
    salts = F.explode(F.sequence(F.lit(0), F.lit(_SALTS - 1))).alias("__salt")
    verdicts = verdicts.select("__host", "host_rate", salts)
    salt = F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(_SALTS)).cast("int")
    failed = F.expr(f"({RULES['few_words']}) OR ({RULES['repeats']})")
    same = F.col("host").eqNullSafe(F.col("__host")) & (F.col("__own") == F.col("__salt"))
    joined = rows.withColumn("__own", salt).join(verdicts, same)
    kept = ~F.col("base_failed") & (F.col("host_rate") < limit)
    return (
        joined.withColumn("base_failed", failed)
        .withColumn("kept", kept)
        .select("doc_id", "host", *MEASURES, "base_failed", "host_rate", "kept")
    )


def _oracle() -> str:
    """DuckDB SQL of the query; hosts' rates are rounded as there."""
    word, some = r"[^\x20\x09-\x0D]+", r"[^\x20\x09-\x0D]"
    fails = ", ".join(f"count(*) FILTER (WHERE {rule}) AS {name}" for name, rule in RULES.items())
    sums = ", ".join(f"sum({name}) AS {name}_n, sum(CAST({name} AS DOUBLE) * {name} / docs) AS {name}_2" for name in RULES)
    means = ", ".join(f"least(greatest({name}_n / CAST(docs AS DOUBLE), 1e-6::DOUBLE), 1 - 1e-6::DOUBLE) AS {name}_m, {name}_2" for name in RULES)
    spreads = ", ".join(f"{name}_m, {name}_m * (1 - {name}_m) AS {name}_v, {name}_2 / docs - {name}_m * {name}_m - {name}_m * (1 - {name}_m) * hosts / docs AS {name}_s" for name in RULES)
    weights = ", ".join(
        f"{name}_m, least(greatest(CASE WHEN {name}_s > 0 THEN {name}_v / {name}_s - 1 ELSE docs / CAST(hosts AS DOUBLE) END, 1.0::DOUBLE), greatest(docs / CAST(hosts AS DOUBLE), 1.0::DOUBLE)) AS {name}_w"
        for name in RULES
    )
    rates = ", ".join(f"({name} + {name}_m * {name}_w) / (h.docs + {name}_w)" for name in RULES)
    return f"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, source AS host, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{word}') AS words, list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '{some}')) AS lines FROM d),
t AS (SELECT r, unnest(range(1, len(words) - 1)) AS i, words FROM w WHERE len(words) > 2),
k AS (SELECT r, i, count(*) OVER (PARTITION BY r, words[i], words[i + 1], words[i + 2]) AS n FROM t),
c AS (SELECT r, count(DISTINCT i + s) AS n_repeat_words FROM k, (SELECT unnest([0, 1, 2]) AS s) WHERE n > 1 GROUP BY r),
m AS (SELECT doc_id, host, len(words) AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0) AS word_chars,
length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, len(lines) AS n_lines FROM w LEFT JOIN c USING (r)),
h AS (SELECT host, count(*) AS docs, {fails} FROM m GROUP BY host), a AS (SELECT sum(docs) AS docs, count(*) AS hosts, {sums} FROM h),
b AS (SELECT docs, hosts, {means} FROM a), e AS (SELECT docs, hosts, {spreads} FROM b), f AS (SELECT {weights} FROM e),
g AS (SELECT host, greatest({rates}) AS rate FROM h, f)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols, CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words,
n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words AS base_failed,
NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEAT_PERCENT} * n_words) AND rate < {HOST_LIMIT} AS kept, round(rate, 9) AS host_rate FROM m JOIN g ON m.host IS NOT DISTINCT FROM g.host"""


ORACLE_SQL = _oracle()


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = judged(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *MEASURES, "base_failed", "kept", F.round("host_rate", 9).alias("host_rate"))
