"""Quality rules by document and by host, in built-in expressions only.

Each document is measured once.  A handful of rules looks at the measures; the share of a host's documents that fail a rule is shrunk
towards what hosts in general show, by a beta prior fitted to the rates of all hosts, so that three bad pages do not
condemn a host and three good ones do not clear it.  A host whose shrunk rate is high is rejected with all
its documents; one whose rate is raised is suspect, and loses the documents that fail the rule themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tideline.session import stage

SPACE = "[\\x20\\x09-\\x0D]+"
NOT_SPACE = "[^\\x20\\x09-\\x0D]"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
MIN_WORDS = 20
REPEATED = 30
"""Percent of words in repeated windows beyond which a document fails."""
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words")
RULES = {
    "base": f"n_words < {MIN_WORDS} OR 100 * n_repeat_words > {REPEATED} * n_words",
    "symbols": "10 * n_symbols > n_words",
    "lines": "10 * n_dup_lines > 3 * n_lines",
    "letters": "word_chars < 2 * n_words OR word_chars > 15 * n_words",
}
"""What fails each rule, over the measures."""
REJECT = 0.5
SUSPECT = 0.2
PARTS = 1_000_000
"""Rates enter the prior as whole parts of this, so that its sums are exact."""
STRENGTH = (10.0, 1000.0)
"""The prior weighs at least and at most so many documents."""


def _walk(windows: Column, single: Column) -> Column:
    """How many words lie in the windows that are not in ``single``, which has the others in the order of the text.

    Going along the windows, one that is next in ``single`` is a window found once; any other adds the words no earlier one has covered.
    """
    start = F.struct(F.lit(0).alias("next"), F.lit(0).alias("at"), F.lit(0).alias("reached"), F.lit(0).alias("total"))

    def step(so_far: Column, h: Column) -> Column:
        once = F.get(single, so_far["next"]).eqNullSafe(h)
        at = so_far["at"]
        end = at + WINDOW
        return F.struct(
            F.when(once, so_far["next"] + 1).otherwise(so_far["next"]).alias("next"),
            (at + 1).alias("at"),
            F.when(once, so_far["reached"]).otherwise(end).alias("reached"),
            F.when(once, so_far["total"]).otherwise(so_far["total"] + end - F.greatest(so_far["reached"], at)).alias("total"),
        )

    return F.aggregate(windows, start, step, lambda done: done["total"])


def measure(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(row, measures): the other columns of ``docs`` as a struct, and what was counted in the text.

    Measures are n_words, word_chars, n_symbols, n_lines (lines with a word), n_dup_lines and n_repeat_words.  Windows are compared
    by 64-bit hashes within one text.  Only the windows of texts that have one twice are sorted.
    """
    others = [F.col(f"`{c}`") for c in docs.columns if c != text_col]
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACES))
    split = docs.select(
        F.struct(*others).alias("row"),
        F.when(trimmed != "", F.split(trimmed, SPACE)).otherwise(F.array().cast("array<string>")).alias("words"),
        F.filter(F.split(text, "\n"), lambda line: line.rlike(NOT_SPACE)).alias("lines"),
        F.length(F.translate(text, SPACES, "")).alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"),
    )
    n = F.size("words")
    hashes = F.when(n > WINDOW, F.transform("words", lambda w: F.xxhash64(w)))
    hashed = split.select("row", "word_chars", "n_symbols", "lines", n.alias("n_words"), hashes.alias("hashes"))
    window = F.transform(
        F.sequence(F.lit(0), F.col("n_words") - WINDOW),
        lambda k: F.xxhash64(*[F.get("hashes", k + j) for j in range(WINDOW)]),
    )
    windows = hashed.withColumn("windows", F.when(F.col("hashes").isNotNull(), window)).drop("hashes")
    twice = F.size(F.array_distinct("windows")) < F.size("windows")
    ordered = windows.withColumn("ordered", F.when(twice, F.sort_array("windows")))
    again = F.filter("ordered", lambda h, k: h == F.get("ordered", k - 1))
    single = F.when(F.col("ordered").isNotNull(), F.array_except("windows", again))
    placed = ordered.withColumn("single", single).drop("ordered")
    covered = F.when(F.size("single") < F.size("windows"), _walk(F.col("windows"), F.col("single")))
    return placed.select(
        "row",
        F.struct(
            *[F.col(m).cast("bigint").alias(m) for m in ("n_words", "word_chars", "n_symbols")],
            F.size("lines").cast("bigint").alias("n_lines"),
            (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
            F.coalesce(covered, F.lit(0)).cast("bigint").alias("n_repeat_words"),
        ).alias("measures"),
    )


def host_rates(failures: DataFrame) -> DataFrame:
    """(host, rule, n, failed, shrunk) from rows (host, failed): per host and rule, its documents, how many fail, and the shrunk rate.

    The prior of a rule is a beta distribution with the mean and variance of the hosts' rates, every host counting alike; without a
    variance it weighs as much as it may.  A host has one row per document in ``failures``, whose counts are summed before the shuffle.
    """
    counted = failures.groupBy("host").agg(F.count("*").alias("n"), *[F.sum(F.col("failed")[r].cast("bigint")).alias(r) for r in RULES])
    each = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("failed")) for r in RULES]))
    rates = stage(counted.select("host", "n", each.alias("x")).select("host", "n", "x.*"), "hosts")
    parts = F.expr(f"({PARTS} * failed) div n").cast("decimal(38,0)")
    sums = rates.groupBy("rule").agg(F.count("*").alias("hosts"), F.sum(parts).alias("one"), F.sum(parts * parts).alias("two"))
    mean = F.col("one").cast("double") / F.col("hosts") / PARTS
    second = F.col("two").cast("double") / F.col("hosts") / PARTS / PARTS
    prior = sums.select("rule", mean.alias("mean"), (second - mean * mean).alias("variance"))
    strength = F.when(F.col("variance") > 0, F.col("mean") * (1 - F.col("mean")) / F.col("variance") - 1).otherwise(STRENGTH[1])
    prior = prior.select("rule", "mean", F.greatest(F.lit(STRENGTH[0]), F.least(F.lit(STRENGTH[1]), strength)).alias("strength"))
    shrunk = (F.col("failed") + F.col("mean") * F.col("strength")) / (F.col("n") + F.col("strength"))
    return rates.join(F.broadcast(prior), "rule").select("host", "rule", "n", "failed", shrunk.alias("shrunk"))


def judge(docs: DataFrame, host_col: str = "source", text_col: str = "text") -> DataFrame:
    """``docs`` without its text, with ``measures``, ``failed``, ``host_rejected``, ``host_suspect`` and ``kept``.

    ``failed`` has the rules that a document fails, ``host_suspect`` those that too many of its host's documents fail.  A null or empty
    text has no words, so it fails the base rule.  Documents without a host count as one host.  Equal rows and equal ids
    are judged each for itself.  An empty table gives no rows.  Texts of any length are measured whole.  Columns of ``docs`` with
    the names of new ones are replaced; others may have any name.
    """
    new = ("measures", "failed", "host_rejected", "host_suspect", "kept")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col and c not in new])
    host = F.coalesce(F.col(f"`{host_col}`").cast("string"), F.lit(""))
    measured = measure(docs.select(row.alias("row"), host.alias("host"), F.col(f"`{text_col}`").alias("text")))
    measured = measured.select("row.row", "row.host", "measures", *[F.expr(f"measures.{m}").alias(m) for m in MEASURES])
    fails = F.struct(*[F.coalesce(F.expr(when), F.lit(False)).alias(rule) for rule, when in RULES.items()])
    measured = stage(measured.select("row", "host", "measures", fails.alias("fails")), "measured")
    rates = host_rates(measured.select("host", F.col("fails").alias("failed")))
    over = rates.where(F.col("shrunk") > SUSPECT).groupBy("host")
    over = stage(over.agg(F.max(F.col("shrunk") > REJECT).alias("rejected"), F.sort_array(F.collect_set("rule")).alias("suspect")), "verdicts")
    failed = F.filter(F.array(*[F.when(F.col("fails")[r], F.lit(r)) for r in RULES]), lambda r: r.isNotNull())
    none = F.array().cast("array<string>")
    judged = measured.join(over, "host", "left").select(
        "row",
        "measures",
        failed.alias("failed"),
        F.coalesce("rejected", F.lit(False)).alias("host_rejected"),
        F.coalesce("suspect", none).alias("host_suspect"),
    )
    kept = ~F.array_contains("failed", "base") & ~F.col("host_rejected") & ~F.arrays_overlap("failed", "host_suspect")
    return judged.select("row.*", *new[:-1], kept.alias("kept"))


def oracle() -> str:
    """SQL of the query: the same measures, rates and verdicts."""
    rules = "\n".join(f"        UNION ALL SELECT rid, host, '{rule}', {when} FROM measured" for rule, when in RULES.items())
    return f"""
    WITH docs AS (
        SELECT row_number() OVER () AS rid, doc_id, coalesce(source, '') AS host, coalesce(text, '') AS text FROM documents
    ), split AS (
        SELECT *, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') AS words,
            [line for line in string_split(text, chr(10)) if regexp_matches(line, '[^\\x20\\x09-\\x0D]')] AS lines
        FROM docs
    ), places AS (
        SELECT rid, unnest(range(1, len(words) - {WINDOW - 2})) AS k,
            unnest([array_to_string(words[k:k + {WINDOW - 1}], ' ') for k in range(1, len(words) - {WINDOW - 2})]) AS run
        FROM split
    ), windows AS (
        SELECT rid, k, count(*) OVER (PARTITION BY rid, run) AS n FROM places
    ), twice AS (
        SELECT rid, least({WINDOW}, coalesce(lead(k) OVER (PARTITION BY rid ORDER BY k) - k, {WINDOW})) AS adds FROM windows WHERE n > 1
    ), repeated AS (
        SELECT rid, sum(adds) AS n FROM twice GROUP BY rid
    ), measured AS (
        SELECT rid, doc_id, host, len(words) AS n_words, coalesce(list_sum([length(w) for w in words]), 0)::BIGINT AS word_chars,
            length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) AS n_lines,
            len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
        FROM split LEFT JOIN repeated USING (rid)
    ), ruled AS (
        SELECT 0 AS rid, '' AS host, '' AS rule, false AS fails WHERE false
{rules}
    ), rates AS (
        SELECT host, rule, count(*) AS n, sum(fails::INT)::BIGINT AS failed FROM ruled GROUP BY ALL
    ), sums AS (
        SELECT rule, count(*) AS hosts, sum({PARTS} * failed // n)::DOUBLE / count(*) / {PARTS} AS mean,
            sum(({PARTS} * failed // n)::HUGEINT * ({PARTS} * failed // n))::DOUBLE / count(*) / {PARTS} / {PARTS} AS second
        FROM rates GROUP BY rule
    ), prior AS (
        SELECT rule, mean, greatest({STRENGTH[0]}, least({STRENGTH[1]},
            CASE WHEN second - mean * mean > 0 THEN mean * (1 - mean) / (second - mean * mean) - 1 ELSE {STRENGTH[1]} END)) AS strength
        FROM sums
    ), shrunk AS (
        SELECT host, rule, (failed + mean * strength) / (n + strength) AS rate FROM rates JOIN prior USING (rule)
    ), rejected AS (
        SELECT DISTINCT host FROM shrunk WHERE rate > {REJECT}
    ), lost AS (
        SELECT DISTINCT rid FROM ruled JOIN shrunk USING (host, rule) WHERE fails AND (rate > {SUSPECT} OR rule = 'base')
    )
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
        {RULES["base"]} AS base_failed, host IN (FROM rejected) AS host_rejected,
        NOT ({RULES["base"]}) AND host NOT IN (FROM rejected) AND rid NOT IN (FROM lost) AS kept
    FROM measured
    """
