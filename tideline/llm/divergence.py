"""How the sources of a language differ in their words.

Identical texts of a language are collapsed first: a text is tokenised once, whatever the number of its copies, and its words count
as often as each source has it.  Document frequencies and counts are sums of such weights.  Pairs of sources are evaluated
sparsely.  A word that a source lacks has the share z of that source, so a sum of |p_s - p_t| over all words is

    words * |z_s - z_t|  +  gain(s, t)  +  gain(t, s)  +  sum over words of both (|p_s - p_t| - |p_s - z_t| - |z_s - p_t| + |z_s - z_t|)

with gain(s, t) the sum of |p_s - z_t| - |z_s - z_t| over the words of s.  A gain only needs how many words of s have each
count, which is a short histogram; the last sum is a join of the counts on the word.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tideline.llm.frames import importable
from tideline.session import stage

TERM = re.compile(rb"[a-z\x80-\xff]+")
"""Over UTF-8 with A-Z lower-cased: runs of letters and of characters beyond ASCII."""
LEAST_DOCS = 30
TOP_TERMS = 50
SCALE = 1_000_000_000
PSEUDO = 5
FLUSH = 1 << 17
WHOLE = "decimal(38,0)"


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + PSEUDO) / (total + PSEUDO * terms)), without rounding; null if there are no terms."""
    over = (total + terms * PSEUDO).cast(WHOLE)
    part = ((n + PSEUDO).cast("decimal(28,0)") * F.lit(SCALE).cast("decimal(10,0)")).cast(WHOLE)
    return F.when(terms > 0, (part - F.pmod(part, over)) / over + 1).cast("bigint")


def term_counts(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> tuple[DataFrame, DataFrame]:
    """((lang, source), (lang, source, term, n, docs)): all groups; each term's count and number of documents in each group.

    Texts meet by their SHA-256.  A text that many documents share is one row of a task before it is sent anywhere.
    """
    read = docs.select(*[F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")).alias(n) for c, n in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    read = read.withColumn("digest", F.unhex(F.sha2(F.col("text").cast("binary"), 256)))
    copies = stage(read.groupBy("lang", "digest", "source").agg(F.count("*").alias("n")), "copies")
    weights = copies.groupBy("lang", "digest").agg(F.collect_list(F.struct("source", "n")).alias("weights"))
    texts = read.groupBy("lang", "digest").agg(F.first("text").alias("text"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[str, str], dict[bytes, list[int]]] = {}
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            for (lang, source), terms in held.items():
                n, there = zip(*terms.values(), strict=True)
                names = pa.array([t.decode() for t in terms])
                same = [pa.array([x]).take(pa.array([0] * len(terms))) for x in (lang, source)]
                yield pa.RecordBatch.from_arrays([*same, names, pa.array(n, pa.int64()), pa.array(there, pa.int64())], names=["lang", "source", "term", "n", "docs"])

        for batch in batches:
            for lang, text, copied in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
                found = Counter(TERM.findall(text.encode().lower()))
                for each in copied if found else ():
                    terms, times = held.setdefault((lang, each["source"]), {}), each["n"]
                    size -= len(terms)
                    for term, n in found.items():
                        if known := terms.get(term):
                            known[0] += n * times
                            known[1] += times
                        else:
                            terms[term] = [n * times, times]
                    size += len(terms)
                if size >= FLUSH:
                    yield from flush()
                    held, size = {}, 0
        yield from flush()

    importable(docs.sparkSession)
    once = texts.join(weights, ["lang", "digest"]).select("lang", "text", "weights")
    counted = once.mapInArrow(run, "lang string, source string, term string, n bigint, docs bigint")
    counted = counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    return copies.select("lang", "source").distinct(), stage(counted, "terms")


def audit(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank): how far each source is from each other one, and the terms it has more of than its language.

    Null texts, languages and sources are ''.  A source without terms is a group like any other.  Of a language without kept terms
    all pairs have value 0.  Ties of rank go by the item's bytes.  Repeated rows and equal ids count each.  An empty table
    gives no rows; further columns are not read.
    """
    groups, counts = term_counts(docs, text_col, lang_col, source_col)
    terms = counts.groupBy("lang", "term").agg(F.sum("n").alias("all_n"), F.sum("docs").alias("docs"))
    terms = stage(terms.where(F.col("docs") >= LEAST_DOCS).drop("docs"), "kept")
    kept = stage(counts.drop("docs").join(terms, ["lang", "term"]), "present")
    langs = terms.groupBy("lang").agg(F.count("*").alias("terms"), F.sum("all_n").alias("all_total"))
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    none = F.lit(0).cast("bigint")
    groups = groups.join(totals, ["lang", "source"], "left").join(langs, "lang", "left").select(
        "lang", "source", *[F.coalesce(c, none).alias(c) for c in ("total", "terms", "all_total")]
    )
    groups = stage(groups.withColumn("z", _share(none, F.col("total"), F.col("terms"))), "groups")
    shares = kept.join(groups, ["lang", "source"]).select(
        "lang", "source", "term", "n", "z", _share(F.col("n"), F.col("total"), F.col("terms")).alias("p"),
        _share(F.col("all_n"), F.col("all_total"), F.col("terms")).alias("q"),
    )
    shares = stage(shares, "shares")
    group = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    more = shares.where("p > q").select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"), (F.col("p") - F.col("q")).alias("value"))
    more = more.withColumn("rank", F.row_number().over(group)).where(F.col("rank") <= TOP_TERMS)
    pairs = _pairs(groups, shares).withColumn("rank", F.row_number().over(group))
    return pairs.unionByName(more)


def _pairs(groups: DataFrame, shares: DataFrame) -> DataFrame:
    """(lang, source, part, item, value) for each two sources of a language, by what each has rather than by all terms."""
    other = groups.select("lang", F.col("source").alias("item"), F.col("z").alias("other_z"))
    apart = F.abs(F.col("z") - F.col("other_z"))
    base = groups.join(other, "lang").where("source <> item")
    base = base.select("lang", "source", "item", F.coalesce(F.col("terms") * apart, F.lit(0)).cast(WHOLE).alias("value"))
    spread = shares.groupBy("lang", "source", "z", "p").agg(F.count("*").alias("times"))
    gain = spread.join(other, "lang").where("source <> item")
    gain = gain.groupBy("lang", "source", "item").agg(F.sum(F.col("times") * (F.abs(F.col("p") - F.col("other_z")) - apart)).cast(WHOLE).alias("value"))
    back = gain.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    right = shares.select("lang", "term", F.col("source").alias("item"), F.col("p").alias("other_p"), F.col("z").alias("other_z"))
    both = shares.join(right, ["lang", "term"]).where("source < item")
    less = F.abs(F.col("p") - F.col("other_p")) - F.abs(F.col("p") - F.col("other_z")) - F.abs(F.col("z") - F.col("other_p")) + apart
    both = both.groupBy("lang", "source", "item").agg(F.sum(less).cast(WHOLE).alias("value"))
    mirrored = both.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "value")
    parts = base.unionByName(gain).unionByName(back).unionByName(both).unionByName(mirrored)
    summed = parts.groupBy("lang", "source", "item").agg(F.sum("value").cast("bigint").alias("value"))
    return summed.select("lang", "source", F.lit("pair").alias("part"), "item", "value")


def oracle() -> str:
    """SQL of the query: every kept term of every group, pair by pair."""
    capitals = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    share = f"1 + ({SCALE}::HUGEINT * ({{}} + {PSEUDO})) // ({{}} + {PSEUDO} * terms)"
    return f"""
    WITH docs AS (
        SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
            regexp_extract_all(translate(coalesce(text, ''), '{capitals}', '{capitals.lower()}'), '[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS found
        FROM documents
    ), once AS (
        SELECT lang, unnest(list_distinct(found)) AS term FROM docs
    ), kept AS (
        SELECT lang, term FROM once GROUP BY ALL HAVING count(*) >= {LEAST_DOCS}
    ), words AS (
        SELECT lang, source, unnest(found) AS term FROM docs
    ), counts AS (
        SELECT lang, source, term, count(*) AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL
    ), langs AS (
        SELECT lang, (SELECT count(*) FROM kept k WHERE k.lang = d.lang) AS terms FROM (SELECT DISTINCT lang FROM docs) d
    ), totals AS (
        SELECT d.lang, d.source, coalesce(sum(n), 0) AS total FROM (SELECT DISTINCT lang, source FROM docs) d
        LEFT JOIN counts c ON c.lang = d.lang AND c.source = d.source GROUP BY ALL
    ), shares AS (
        SELECT t.lang, t.source, k.term, coalesce(n, 0) AS n, {share.format("coalesce(n, 0)", "total")} AS p
        FROM totals t JOIN langs USING (lang) JOIN kept k ON k.lang = t.lang
        LEFT JOIN counts c ON c.lang = t.lang AND c.source = t.source AND c.term = k.term
    ), whole AS (
        SELECT c.lang, c.term, {share.format("sum(c.n)", "any_value(a.total)")} AS q
        FROM counts c JOIN langs USING (lang) JOIN (SELECT lang, sum(total) AS total FROM totals GROUP BY lang) a USING (lang)
        GROUP BY c.lang, c.term, terms
    ), pairs AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum(abs(s.p - o.p)), 0)::BIGINT AS value
        FROM totals a JOIN totals b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN shares s ON s.lang = a.lang AND s.source = a.source
        LEFT JOIN shares o ON o.lang = b.lang AND o.source = b.source AND o.term = s.term
        GROUP BY ALL
    ), terms AS (
        SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value
        FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q
    ), ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INT AS rank
        FROM (FROM pairs UNION ALL FROM terms)
    )
    FROM ranked WHERE part = 'pair' OR rank <= {TOP_TERMS}
    """
