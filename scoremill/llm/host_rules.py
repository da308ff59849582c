"""Quality rules whose strictness depends on the host: failures are counted by host, rates shrunk.

Each document is held against base rules (too short, mostly repeated) and soft rules (symbols, repeated
lines). A host's failure rate is shrunk towards the rate of all documents by a beta prior that is fitted
to the hosts themselves (method of moments). On a host whose shrunk rate reaches a limit, a document
that fails any rule goes; elsewhere only the base rules decide. A document that passes all rules stays,
whatever its host.

Only built-in functions are used: each text is read once, within its row, and the counts are stored
before hosts are grouped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scoremill.llm.common import table, words
from scoremill.session import materialise

MIN_WORDS, MAX_REPEATED, MAX_SYMBOLS, MAX_DUP_LINES = 50, 50, 10, 30
#: A host is distrusted from this shrunk failure rate on.
DISTRUST = 0.5
#: Weight of the prior where nothing tells hosts apart.
ONE_RATE = 1e6
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
WINDOW = 3


def rule_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without its text and with counts of words, characters, symbols, lines and repeats.

    Null, empty and blank texts have zero of everything. Columns of the counts' names are replaced.
    """
    full = F.coalesce(F.col(text), F.lit(""))
    rest = [c for c in docs.columns if c != text and c not in COUNTS]
    lines = F.filter(F.split(full, "\n"), lambda line: F.translate(line, BLANKS, "") != "")
    step = docs.select(
        *rest,
        words(F.col(text)).alias("_words"),
        lines.alias("_lines"),
        F.length(F.translate(full, BLANKS, "")).cast("long").alias("word_chars"),
        (F.length(full) - F.length(F.translate(full, SYMBOLS, ""))).cast("long").alias("n_symbols"),
    )
    step = step.select(
        *rest,
        "word_chars",
        "n_symbols",
        F.size("_words").cast("long").alias("n_words"),
        F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.expr(
            f"""CASE WHEN size(_words) < {WINDOW} THEN array()
                ELSE transform(sequence(0, size(_words) - {WINDOW}),
                               i -> xxhash64(_words[i], _words[i + 1], _words[i + 2])) END"""
        ).alias("_runs"),
    )
    # Only a text with some repeated run has its runs sorted, to find the equal ones side by side.
    step = step.withColumn(
        "_sorted",
        F.expr(
            """CASE WHEN size(array_distinct(_runs)) < size(_runs)
               THEN array_sort(transform(_runs, (run, i) -> struct(run, i))) END"""
        ),
    ).drop("_runs")
    step = step.withColumn(
        "_covered",
        F.expr(
            """flatten(transform(
                 filter(_sorted, (s, j) -> s.run = get(_sorted, j - 1).run OR s.run = get(_sorted, j + 1).run),
                 s -> array(s.i, s.i + 1, s.i + 2)))"""
        ),
    ).drop("_sorted")
    repeated = F.coalesce(F.size(F.array_distinct("_covered")), F.lit(0))
    repeated = F.when(F.col("_covered").isNull(), 0).otherwise(repeated).cast("long")
    return step.select(*rest, *[c for c in COUNTS if c != "n_repeat_words"], repeated.alias("n_repeat_words"))


COUNTS = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]


def base_failed():
    short = F.col("n_words") < MIN_WORDS
    return short | (100 * F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))


def soft_failed():
    symbols = 100 * F.col("n_symbols") > MAX_SYMBOLS * F.col("word_chars")
    return symbols | (100 * F.col("n_dup_lines") > MAX_DUP_LINES * F.col("n_lines"))


def prior_weight(mean: float, spread: float, n: int, hosts: int, n_squared: float) -> float:
    """Documents that the beta prior is worth; ``spread`` is the sum of ``n * (rate - mean) ** 2`` over hosts.

    If hosts differ by the share ``r`` of the largest variance possible, the spread expected is
    ``mean * (1 - mean) * (hosts - 1 + r * (n - n_squared / n - hosts + 1))``: solved for ``r``, worth ``1 / r - 1``.
    """
    informative = n - n_squared / n - (hosts - 1)
    if informative < 1e-9:
        return ONE_RATE
    share = (spread / (mean * (1 - mean)) - (hosts - 1)) / informative
    return max(1.0, 1 / share - 1) if share > 1 / ONE_RATE else ONE_RATE


def host_verdicts(checked: DataFrame, host: str) -> DataFrame:
    """``host, host_documents, host_rate, distrusted`` of checked documents; a null host is one host."""
    by_host = checked.groupBy(F.col(host).alias("host")).agg(
        F.count("*").alias("n"), F.sum(F.col("failed").cast("long")).alias("bad")
    )
    by_host = materialise(by_host, "host-rules")
    total = by_host.agg(
        F.sum("n").alias("n"), F.sum("bad").alias("bad"), F.count("*").alias("hosts"), F.sum(F.col("n") ** 2).alias("n2")
    ).first()
    mean = total.bad / total.n if total.n else 0.0
    weight = ONE_RATE
    if 0 < mean < 1:
        spread = by_host.agg(F.sum(F.col("n") * (F.col("bad") / F.col("n") - mean) ** 2)).first()[0]
        weight = prior_weight(mean, spread, total.n, total.hosts, total.n2)
    rate = (F.col("bad") + F.lit(mean * weight)) / (F.col("n") + F.lit(weight))
    return by_host.select(
        "host", F.col("n").alias("host_documents"), rate.alias("host_rate"), (rate >= DISTRUST).alias("distrusted")
    )


def judge(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """``docs`` without its text, with counts, ``base_failed``, ``distrusted`` and ``kept``.

    Rows that repeat are judged each; null hosts form one host. Empty input gives empty output.
    """
    made = [*COUNTS, "base_failed", "failed", "distrusted", "kept"]
    plain = docs.select(*[c for c in docs.columns if c not in made or c == text])
    checked = rule_counts(plain, text)
    checked = checked.withColumn("base_failed", base_failed())
    checked = checked.withColumn("failed", F.col("base_failed") | soft_failed())
    checked = materialise(checked, "host-rules")
    verdicts = materialise(host_verdicts(checked, host), "host-rules").select(
        F.col("host").alias("_host"), "distrusted"
    )
    joined = checked.join(verdicts, F.col(host).eqNullSafe(F.col("_host")), "left").drop("_host")
    distrusted = F.coalesce("distrusted", F.lit(False))
    kept = ~F.col("base_failed") & ~(F.col("failed") & distrusted)
    return joined.withColumn("distrusted", distrusted).withColumn("kept", kept)


def filter_documents(docs: DataFrame, host: str = "source", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``judge`` keeps, with their columns as they are.

    The rows are stored once with their flags, between the rules and the verdicts of the hosts.
    """
    wrapped = docs.select(F.struct("*").alias("_row"), F.col(host).alias("_host"), F.col(text).alias("_text"))
    checked = rule_counts(wrapped, "_text").select("_row", "_host", base_failed().alias("base"), soft_failed().alias("soft"))
    checked = materialise(checked, "host-rules")
    flags = checked.select("_host", (F.col("base") | F.col("soft")).alias("failed"))
    verdicts = materialise(host_verdicts(flags, "_host"), "host-rules").where("distrusted").select("host", "distrusted")
    joined = checked.join(verdicts, F.col("_host").eqNullSafe(F.col("host")), "left")
    gone = F.col("base") | (F.col("soft") & F.coalesce("distrusted", F.lit(False)))
    return joined.where(~gone).select("_row.*")


def op7_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and verdict of all ``documents``; nulls, repeats and empty tables as in ``judge``."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return judge(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


#: The judgement of ``documents`` in DuckDB: one row per document with its rules and verdict.
JUDGED_SQL = r"""
WITH texts AS (
  SELECT row_number() OVER () AS k, doc_id, source, coalesce(text, '') AS text FROM {documents}
), parts AS (
  SELECT k, doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines
  FROM texts
), runs AS (
  SELECT k, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS run
  FROM (SELECT k, w, unnest(range(1, len(w) - 1)) AS i FROM parts)
), repeated AS (
  SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, run) AS n FROM runs) WHERE n > 1
), covered AS (
  SELECT k, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT k, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY k
), counted AS (
  SELECT k, doc_id, source, CAST(len(w) AS BIGINT) AS n_words,
         CAST(length(list_aggregate(list_concat([''], w), 'string_agg', '')) AS BIGINT) AS word_chars,
         CAST(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words
  FROM parts LEFT JOIN covered USING (k)
), checked AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
         n_words < 50 OR 100 * n_repeat_words > 50 * n_words
           OR 100 * n_symbols > 10 * word_chars OR 100 * n_dup_lines > 30 * n_lines AS failed
  FROM counted
), hosts AS (
  SELECT source, count(*) AS n, count(*) FILTER (failed) AS bad FROM checked GROUP BY source
), overall AS (
  SELECT sum(bad) / sum(n) AS mean, sum(n) AS total, count(*) AS k, sum(CAST(n AS DOUBLE) ** 2) AS n2 FROM hosts
), spread AS (
  SELECT any_value(mean) AS mean, any_value(k) AS k, any_value(total - n2 / total - (k - 1)) AS room,
         sum(n * (bad / n - mean) ** 2) AS s
  FROM hosts, overall
), shares AS (
  SELECT mean, CASE WHEN mean > 0 AND mean < 1 AND room >= 1e-9
                    THEN (s / (mean * (1 - mean)) - (k - 1)) / room ELSE 0 END AS r FROM spread
), prior AS (
  SELECT mean, CASE WHEN r > 1e-6 THEN greatest(1, 1 / r - 1) ELSE 1e6 END AS weight FROM shares
), verdicts AS (
  SELECT source, (bad + mean * weight) / (n + weight) >= 0.5 AS distrusted FROM hosts, prior
), judged AS (
  SELECT c.*, NOT base_failed AND NOT (failed AND distrusted) AS kept
  FROM checked c JOIN verdicts v ON c.source IS NOT DISTINCT FROM v.source
)
"""

SQL = (
    JUDGED_SQL.replace("{documents}", "documents")
    + """
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept FROM judged
"""
)
