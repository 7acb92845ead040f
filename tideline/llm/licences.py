"""Licence statements: sentences become identifiers, sequences of identifiers become licences."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: What a normalised sentence must contain.  A sentence yields the identifier of every pattern that it fits, each once, in
#: the order in which they begin, equal places in this order; the last one only if it fits no other.
SENTENCES = (
    ("ApacheTwo", r"apache licen[sc]e,? \(?version 2(\.0)?"),
    ("ApacheCopy", r"you may obtain a copy of the licen[sc]e at"),
    ("ApacheAsIs", r"distributed under the licen[sc]e is distributed on an as is basis"),
    ("ApacheSee", r"see the licen[sc]e for the specific language governing permissions"),
    ("GplDetails", r"see the gnu ((lesser|library|affero) )?general public licen[sc]e for more details"),
    ("LgplFree", r"is free software you can redistribute it and/or modify it under the terms of the gnu (lesser|library) general public licen[sc]e"),
    ("GplFree", r"is free software you can redistribute it and/or modify it under the terms of the gnu general public licen[sc]e"),
    ("LgplThree", r"gnu lesser general public licen[sc]e,? (version|v) ?3"),
    ("LgplTwo", r"gnu lesser general public licen[sc]e,? (version|v) ?2"),
    ("GplThree", r"gnu general public licen[sc]e,? \(?(version|v) ?3"),
    ("GplTwo", r"gnu general public licen[sc]e,? \(?(version|v) ?2"),
    ("VersionThree", r"either version 3 of the licen[sc]e"),
    ("VersionTwo", r"either version 2(\.1)? of the licen[sc]e"),
    ("LaterVersion", r"(or )?\(?at your option\)? any later version"),
    ("MitTitle", r"(^|under the )(the )?mit licen[sc]e"),
    ("MitGrant", r"permission is hereby granted,? free of charge,? to any person obtaining a copy"),
    ("MitNotice", r"the above copyright notice and this permission notice shall be included"),
    ("AsIs", r"(the|this) software is provided (by .* )?as is"),
    ("BsdUse", r"redistribution and use in source and binary forms"),
    ("BsdSource", r"redistributions of source code must retain the above copyright"),
    ("BsdBinary", r"redistributions in binary form must reproduce the above copyright"),
    ("BsdEndorse", r"(neither the names? of .*|nor the names? of (its|their|the) contributors) may be used to endorse or promote"),
    ("BsdTitle", r"(^|under the )(the )?(new |modified )?bsd licen[sc]e"),
    ("CcByNcSa", r"(cc|creative commons) by-nc-sa [1-4]\.[0-9]"),
    ("CcByNcNd", r"(cc|creative commons) by-nc-nd [1-4]\.[0-9]"),
    ("CcByNc", r"(cc|creative commons) by-nc [1-4]\.[0-9]"),
    ("CcBySa", r"(cc|creative commons) by-sa [1-4]\.[0-9]"),
    ("CcByNd", r"(cc|creative commons) by-nd [1-4]\.[0-9]"),
    ("CcBy", r"(cc|creative commons) by [1-4]\.[0-9]"),
    ("MplTwo", r"mozilla public licen[sc]e,? (version|v\.?) ?2"),
    ("PublicDomain", r"(released|placed) into the public domain"),
    ("Unlicensed", r"all rights reserved"),
    ("Copyright", r"^(copyright|©|\(c\)) "),
    ("Unknown", r"(^|[^a-z])(licen[sc]ed? (under|as|for|terms)|under (the )?(terms of the )?[a-z0-9 .-]*licen[sc]e|all warrant(y|ies))"),
)
#: Sequences of identifiers, and the licence that they state; where several fit, the first counts.
RULES = (
    (("LgplFree", "VersionThree", "LaterVersion"), "LGPL-3.0-or-later"),
    (("LgplFree", "VersionTwo", "LaterVersion"), "LGPL-2.1-or-later"),
    (("LgplFree", "VersionThree"), "LGPL-3.0"),
    (("LgplFree", "VersionTwo"), "LGPL-2.1"),
    (("LgplFree", "LgplThree", "LaterVersion"), "LGPL-3.0-or-later"),
    (("LgplFree", "LgplTwo", "LaterVersion"), "LGPL-2.1-or-later"),
    (("LgplFree", "LgplThree"), "LGPL-3.0"),
    (("LgplFree", "LgplTwo"), "LGPL-2.1"),
    (("LgplThree", "LaterVersion"), "LGPL-3.0-or-later"),
    (("LgplTwo", "LaterVersion"), "LGPL-2.1-or-later"),
    (("GplFree", "GplThree", "LaterVersion"), "GPL-3.0-or-later"),
    (("GplFree", "GplTwo", "LaterVersion"), "GPL-2.0-or-later"),
    (("GplFree", "GplThree"), "GPL-3.0"),
    (("GplFree", "GplTwo"), "GPL-2.0"),
    (("GplFree", "VersionThree", "LaterVersion"), "GPL-3.0-or-later"),
    (("GplFree", "VersionTwo", "LaterVersion"), "GPL-2.0-or-later"),
    (("GplThree", "LaterVersion"), "GPL-3.0-or-later"),
    (("GplTwo", "LaterVersion"), "GPL-2.0-or-later"),
    (("GplFree", "VersionThree"), "GPL-3.0"),
    (("GplFree", "VersionTwo"), "GPL-2.0"),
    (("MitTitle", "MitGrant", "MitNotice", "AsIs"), "MIT"),
    (("MitGrant", "MitNotice", "AsIs"), "MIT"),
    (("MitGrant", "MitNotice"), "MIT"),
    (("BsdUse", "BsdSource", "BsdBinary", "BsdEndorse", "AsIs"), "BSD-3-Clause"),
    (("BsdUse", "BsdSource", "BsdBinary", "BsdEndorse"), "BSD-3-Clause"),
    (("BsdUse", "BsdSource", "BsdBinary", "AsIs"), "BSD-2-Clause"),
    (("BsdUse", "BsdSource", "BsdBinary"), "BSD-2-Clause"),
    (("ApacheTwo", "ApacheCopy", "ApacheAsIs"), "Apache-2.0"),
    (("ApacheTwo", "ApacheCopy"), "Apache-2.0"),
    (("ApacheTwo",), "Apache-2.0"),
    (("LgplFree",), "LGPL"),
    (("LgplThree",), "LGPL-3.0"),
    (("LgplTwo",), "LGPL-2.1"),
    (("GplThree",), "GPL-3.0"),
    (("GplTwo",), "GPL-2.0"),
    (("GplFree",), "GPL"),
    (("MitTitle",), "MIT"),
    (("BsdTitle",), "BSD"),
    (("CcByNcSa",), "CC-BY-NC-SA"),
    (("CcByNcNd",), "CC-BY-NC-ND"),
    (("CcByNc",), "CC-BY-NC"),
    (("CcBySa",), "CC-BY-SA"),
    (("CcByNd",), "CC-BY-ND"),
    (("CcBy",), "CC-BY"),
    (("MplTwo",), "MPL-2.0"),
    (("PublicDomain",), "public domain"),
    (("Unlicensed",), "all rights reserved"),
    (("Unknown",), "unknown"),
)
NEUTRAL = ("Copyright", "ApacheSee", "GplDetails")
"""Identifiers that may stand between those of a rule."""
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Every sentence that a pattern above fits holds one of these; others need no pattern tried.
MENTION = "licen|copyright|©|(c)|version|permission|software|redistribution|public domain|all rights|neither the|nor the|cc by|creative commons|warrant".split("|")
LEADER = r"[ \t]*(//+|#+|;+|--|/?\*+/?|<!--|rem )?[ \t]*"
"""What may stand before the text of a line, as in comments."""
BREAK = r"\r?\n|\r"
PARAGRAPH = rf"\n{LEADER}(\n{LEADER})+"
WRAP = rf"\n{LEADER}"
END = r"[.!?]+[ \t]+|[.!?;:]*\n+|[.!?;:]+$"
DROPPED = r"[\"'`“”‘’*#;:]|//"
BLANKS = r"[ \t\x0b\x0c]+"


def _sequence(rule: tuple[str, ...]) -> str:
    return "".join(f"<{x}>" for x in rule)


ANY_RULE = "|".join(_sequence(rule) for rule, _ in RULES)


def recognise(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, sentence_ids, licences, n_licences): one row per row of ``docs``.

    A line break within a paragraph is a blank, and so is a comment mark at the start of a line; blank lines end a sentence, as full stops
    do.  ``sentence_ids`` are the identifiers of all licence sentences in text order, ``licences`` the different
    licences in the order in which they are first stated; both joined by commas and empty if there is none.  A null or
    empty text has none.  Only built-in expressions, one scan, no shuffle; repeated rows and null ids pass through and other columns
    are not read.
    """
    low = F.translate(F.coalesce(F.col(text_col), F.lit("")), UPPER, UPPER.lower())
    lines = F.regexp_replace(low, BREAK, "\n")
    # a paragraph ends in a character that no wrapped line has
    flat = F.regexp_replace(F.regexp_replace(lines, PARAGRAPH, "\f"), WRAP, " ")
    text = F.translate(flat, "\f", "\n")
    *stated, (unknown, fallback) = SENTENCES

    def clean(sentence: Column) -> Column:
        return F.btrim(F.regexp_replace(F.regexp_replace(sentence, DROPPED, ""), BLANKS, " "))

    def mentions(sentence: Column) -> Column:
        return reduce(or_, (sentence.contains(word) for word in MENTION))

    def fitting(sentence: Column) -> Column:
        found = [F.struct(F.regexp_instr(sentence, F.lit(p)).alias("at"), F.lit(k).alias("k"), F.lit(n).alias("name")) for k, (n, p) in enumerate(stated)]
        return F.struct(sentence.alias("s"), F.array_sort(F.filter(F.array(*found), lambda x: x["at"] > 0))["name"].alias("names"))

    def named(x: Column) -> Column:
        rest = F.when(x["s"].rlike(fallback), F.array(F.lit(unknown))).otherwise(F.array().cast("array<string>"))
        return F.when(F.size(x["names"]) > 0, x["names"]).otherwise(rest)

    # one step each: an expression used in several places of a lambda is computed in each of them
    sentences = F.filter(F.transform(F.split(text, END), clean), mentions)
    ids = F.flatten(F.transform(F.transform(sentences, fitting), named))
    counted = F.filter(F.col("ids"), lambda x: ~x.isin(*NEUTRAL))
    string = F.array_join(F.transform(counted, lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "")
    matched = F.regexp_extract_all(string, F.lit(f"({ANY_RULE})"), 1)
    meaning = F.create_map(*(F.lit(x) for rule, licence in RULES for x in (_sequence(rule), licence)))
    licences = F.array_distinct(F.transform(matched, lambda m: F.element_at(meaning, m)))
    found = docs.select(F.col(id_col), ids.alias("ids")).select(id_col, "ids", licences.alias("found"))
    return found.select(
        F.col(id_col),
        F.array_join("ids", ",").alias("sentence_ids"),
        F.array_join("found", ",").alias("licences"),
        F.size("found").cast("bigint").alias("n_licences"),
    )


def oracle() -> str:
    """DuckDB SQL for ``recognise`` on ``documents``: one row per sentence, put together again."""
    quote = lambda x: "'" + x.replace("'", "''") + "'"
    *stated, (unknown, fallback) = SENTENCES
    fits = ", ".join(
        f"{{'pos': CASE WHEN regexp_matches(s, {quote(p)}) THEN length(regexp_extract(s, {quote(f'^(.*?)(?:{p})')}, 1)) END, 'rank': {k}, 'id': '{n}'}}"
        for k, (n, p) in enumerate(stated)
    )
    rules = " ".join(f"WHEN m = '{_sequence(r)}' THEN '{x}'" for r, x in RULES)
    neutral = ", ".join(f"'{x}'" for x in NEUTRAL)
    text = f"regexp_replace(translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}'), {quote(BREAK)}, chr(10), 'g')"
    text = f"regexp_replace(regexp_replace({text}, {quote(PARAGRAPH)}, chr(12), 'g'), {quote(WRAP)}, ' ', 'g')"
    return f"""
WITH pieces AS (SELECT row_number() OVER () AS r, doc_id, regexp_split_to_array(translate({text}, chr(12), chr(10)), {quote(END)}) AS parts FROM documents),
sentences AS (SELECT r, doc_id, unnest(parts) AS part, unnest(range(1, len(parts) + 1)) AS k FROM pieces),
clean AS (SELECT r, k, trim(regexp_replace(regexp_replace(part, {quote(DROPPED)}, '', 'g'), {quote(BLANKS)}, ' ', 'g'), ' ') AS s FROM sentences),
fits AS (SELECT r, k, f.pos AS pos, f.rank AS rank, f.id AS id FROM (SELECT r, k, unnest([{fits}]) AS f FROM clean WHERE s <> '') WHERE f.pos IS NOT NULL),
named AS (FROM fits UNION ALL SELECT r, k, 0, 0, '{unknown}' FROM clean ANTI JOIN fits USING (r, k) WHERE regexp_matches(s, {quote(fallback)})),
strings AS (SELECT r, string_agg(id, ',' ORDER BY k, pos, rank) AS ids,
  coalesce(string_agg('<' || id || '>', '' ORDER BY k, pos, rank) FILTER (id NOT IN ({neutral})), '') AS seq FROM named GROUP BY r),
matched AS (SELECT r, unnest(regexp_extract_all(seq, '{ANY_RULE}')) AS m, unnest(range(1, 1 + len(regexp_extract_all(seq, '{ANY_RULE}')))) AS k FROM strings),
first_of AS (SELECT r, CASE {rules} END AS licence, min(k) AS k FROM matched GROUP BY 1, 2),
listed AS (SELECT r, string_agg(licence, ',' ORDER BY k) AS licences, count(*) AS n FROM first_of GROUP BY r)
SELECT doc_id, coalesce(ids, '') AS sentence_ids, coalesce(licences, '') AS licences, coalesce(n, 0) AS n_licences
FROM pieces LEFT JOIN strings USING (r) LEFT JOIN listed USING (r)"""
