"""Brute-force counterparts and the odd cases: nulls, empty and long texts, ties, repeated rows, empty tables, extra columns."""

import collections
import itertools
import math
import random
import re
import time
import zlib

import numpy as np
import pytest
from plans import plan

from tideline.llm import contamination, embeddings, golay, html, language, licences, ngram_lm, packing, quality, simhash, urls

DOCS = "doc_id bigint, text string, node string, row string, fp string, score string, text_ string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def prose(seed, words=120):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(["ka", "lo", "mi", "Tu", "re", "sé"]) for _ in range(rng.randint(1, 4))) for _ in range(words))


def docs_of(spark, texts):
    rows = [(k if k >= 0 else None, t, "x", "y", None, "z", None) for k, t in texts]
    return spark.createDataFrame(rows, DOCS)


@pytest.fixture(scope="module")
def odd():
    base = prose(1)
    near = base.split()
    near[50] = "other"
    return [
        (5, base), (3, base), (3, base), (9, " ".join(near)), (1, None), (2, ""), (4, " \t\n"), (6, "one"), (-1, "one two"), (7, prose(2, 60_000)), (8, "Ünï çødé 12"),
    ]


def rows(df):
    return sorted(map(repr, df.collect()))


# near copies


def test_golay_is_perfect_and_fuzzy():
    words = np.arange(1 << 12, dtype=np.uint32) << 11
    codewords = words | golay.syndrome(words)
    assert (golay.syndrome(codewords) == 0).all()
    assert min(int(c).bit_count() for c in codewords[1:]) == 7
    rng = np.random.default_rng(0)
    for a in rng.integers(0, 1 << 23, 200):
        near = {int(x) for x in golay.indices(np.array([a]))[0]}
        for bits in itertools.combinations(range(23), 2):
            one, two = a ^ (1 << bits[0]), a ^ (1 << bits[0]) ^ (1 << bits[1])
            both = golay.indices(np.array([one, two]))
            assert int(both[0, 0]) in near
            assert near & {int(x) for x in both[1]}


def test_keys_lose_nothing_up_to_four_bits():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 63, 3000).astype(np.uint64)
    b = a.copy()
    for k in range(len(b)):
        for bit in rng.choice(64, rng.integers(0, 5), replace=False):
            b[k] ^= np.uint64(1) << np.uint64(bit)
    base, probe = simhash.exact_keys(a, False)[0], simhash.exact_keys(b, True)[0]
    assert all(set(x) & set(y) for x, y in zip(base.tolist(), probe.tolist(), strict=True))


def plain_fingerprint(text, size):
    import xxhash

    words = WORD.findall((text or "").translate(LOWER))
    shingles = [" ".join(words[k : k + size]) for k in range(max(1, len(words) - size + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in itertools.combinations(nodes, 2):
        if linked(a, b):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {n: find(n) for n in nodes}


def test_near_duplicates(spark, odd):
    got = simhash.near_duplicates(docs_of(spark, odd)).collect()
    prints = [plain_fingerprint(t, 4) for _, t in odd]
    assert sorted(r["fingerprint"] for r in got) == sorted(f"{p:016x}" for p in prints)
    group = plain_components(sorted(set(prints)), lambda a, b: (a ^ b).bit_count() <= 4)
    least = collections.defaultdict(list)
    for (k, _), p in zip(odd, prints, strict=True):
        least[group[p]].append(k if k >= 0 else math.inf)
    want = [(k if k >= 0 else None, f"{p:016x}", x if (x := min(least[group[p]])) < math.inf else None) for (k, _), p in zip(odd, prints, strict=True)]
    assert sorted(map(tuple, got), key=str) == sorted(want, key=str)
    assert simhash.near_duplicates(docs_of(spark, [])).collect() == []


def test_keys_of_fingerprints_are_not_broadcast(spark, monkeypatch):
    """Spark does not see that Python makes many rows of one, so it takes the keys of some 100,000 fingerprints for a few MB."""
    plans, real = [], simhash.components
    monkeypatch.setattr(simhash, "components", lambda links: plans.append(plan(links)) or real(links))
    texts = [(k, prose(k, 40)) for k in range(30)] + [(30, prose(3, 40) + " more")]
    got = {r["doc_id"]: r["component_id"] for r in simhash.near_duplicates(docs_of(spark, texts)).collect()}
    assert len(got) == 31 and len(plans) == 2
    for links in plans:
        by_key = [line for line in links.splitlines() if "Join [key#" in line]
        assert by_key and all("SortMergeJoin" in line for line in by_key)


def test_near_copies(spark, odd):
    got = {r["node"]: r["component"] for r in simhash.near_copies(docs_of(spark, odd)).collect()}
    assert got == {1: 1, 2: 1, 4: 1, 3: 3, 5: 3, 9: 3, 6: 6, 7: 7, 8: 8}
    assert simhash.near_copies(docs_of(spark, [])).collect() == []


def plain_copies(texts):
    """The groups of texts whose sets of five-word shingles have a Jaccard similarity of 0.8 or more, by brute force."""
    sets = {}
    for k, t in texts:
        words = t.lower().split()
        sets[k] = {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))}
    return plain_components(sorted(sets), lambda a, b: len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]) - 1e-9)


def test_near_copies_equal_brute_force_over_text_lengths(spark):
    rng = random.Random(11)
    texts = []
    for group in range(150):
        size = rng.choice([5, 9, 12, 20, 30, 40, 80, 200, 400])
        base = [f"{rng.choice('abcdef')}{rng.randrange(3000)}" for _ in range(size)]
        texts.append((10 * group, " ".join(base)))
        for copy in range(1, 4):
            words = list(base)
            for _ in range(rng.randint(1, 1 + size // 45)):
                at = rng.choice([0, len(words) - 1, rng.randrange(len(words))])
                words[at : at + 1] = rng.choice([["other"], [], [words[at], "more"]])
            texts.append((10 * group + copy, " ".join(words)))
    want = plain_copies(texts)
    assert sum(k != c for k, c in want.items()) > 150
    got = {r["node"]: r["component"] for r in simhash.near_copies(docs_of(spark, texts)).collect()}
    assert got == want


def test_near_copies_keep_texts_that_share_a_repeated_line(spark):
    line = " ".join(["see the terms of use of this site before you copy"] * 60)
    texts = [(k, f"{prose(500 + k, 300)} {line}") for k in range(12)]
    assert len(set(plain_copies(texts).values())) == 12
    got = {r["node"]: r["component"] for r in simhash.near_copies(docs_of(spark, texts)).collect()}
    assert got == {k: k for k in range(12)}


# language and quality


def test_language(spark, odd):
    pure = [(k, " ".join(random.Random(k).choices(s.split(), k=40))) for k, s in enumerate(["der die und ist nicht", "the and that with", "les des une dans"] * 20)]
    rows_ = [(k, t, x) for (k, t), x in zip(pure, ["de", "en", "fr"] * 20, strict=True)]
    model = language.train(spark.createDataFrame([*rows_, (99, None, "de"), (98, "x", None)], "doc_id int, text string, lang string"))
    assert model.languages == ("de", "en", "fr")
    best, score, unsure = model.predict(["und die ist", "with that", "dans les", None, "", "12 !"])
    assert best == ["de", "en", "fr", "und", "und", "und"]
    assert (score[:3] > 0.5).all() and (score[3:] == 0).all() and not unsure[3:].any()
    out = language.identify(docs_of(spark, odd), model)
    assert out.columns == [*DOCS.replace(",", "").split()[::2], "lang_pred", "lang_score", "lang_ambiguous"]
    assert out.count() == len(odd)
    empty = language.train(docs_of(spark, []).selectExpr("text", "node AS lang"))
    assert {r["lang_pred"] for r in language.identify(docs_of(spark, odd), empty).collect()} == {"und"}


def test_codewords_are_apart():
    for n in (2, 3, 5, 7, 20):
        code = language.codewords(n)
        assert len({tuple(r) for r in code.tolist()}) == n
        assert (np.abs(code.sum(0)) < n).all()


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(3)
    sizes = [1, 4, 2]
    bounds, evidence, ties = np.concatenate(([0], np.cumsum(sizes))), rng.normal(size=7), rng.normal(size=(2, 2))
    got, pairs = quality.marginals(evidence, bounds, ties)
    want, seen = np.zeros(7), np.zeros((2, 2))
    for lo, n in zip(bounds[:-1], sizes, strict=True):
        weight = {}
        for path in itertools.product((0, 1), repeat=n):
            weight[path] = math.exp(sum(evidence[lo + k] * s for k, s in enumerate(path)) + sum(ties[a, b] for a, b in itertools.pairwise(path)))
        for path, w in weight.items():
            for k, s in enumerate(path):
                want[lo + k] += s * w / sum(weight.values())
            for a, b in itertools.pairwise(path):
                seen[a, b] += w / sum(weight.values())
    assert np.allclose(got, want) and np.allclose(pairs, seen)


def test_quality(spark, sample, odd):
    docs, labels = (spark.read.parquet(f"{sample}/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels.where(~quality.held_out()))
    out = quality.assess(docs, model).join(labels.where(quality.held_out()), "doc_id").select("quality_score", "quality").collect()
    assert sum((s >= 0.3) == q for s, q in out) / len(out) > 0.95
    scores = quality.assess(docs_of(spark, odd), model).collect()
    assert len(scores) == len(odd) and all(0 <= r["quality_score"] <= 1 for r in scores)
    assert quality.train(docs, labels.limit(0)).slope == 0.0


def test_quality_learns_from_whole_documents_within_its_bound(spark, monkeypatch):
    good, bad = "This is a line of plain prose, which says something.", "$$$ ### CLICK HERE >>> 123 |||"
    texts = [(k, "\n".join([good] * 500 + [bad] * 500 if k % 2 else [good] * 1000)) for k in range(40)]
    texts += [(k, t) for k, t in texts[:4]] + [(99, None), (-1, good)]
    docs = docs_of(spark, texts)
    labels = spark.createDataFrame([(k, 1 - k % 2) for k in range(40)] + [(99, 0)], "doc_id bigint, quality int")
    scores = {r["doc_id"]: r["quality_score"] for r in quality.assess(docs, quality.train(docs, labels)).collect()}
    assert min(scores[k] for k in range(0, 40, 2)) > max(scores[k] for k in range(1, 40, 2)), "only the second half tells them apart"
    monkeypatch.setattr(quality, "SAMPLE_LINES", 20_000)
    seen = []
    monkeypatch.setattr(quality, "fit", lambda lines, label, prior: seen.append((len(lines.weights), sorted(label))) or "model")
    assert quality.train(docs, labels.where("doc_id <> 99")) == "model"
    assert seen == [(40_000, [0.0] * 20 + [1.0] * 20)], "rows that repeat count once"
    monkeypatch.setattr(quality, "SAMPLE_LINES", 19_999)
    assert quality.train(docs, labels.where("doc_id <> 99")).slope == 0.0, "documents over a twentieth of the bound are not sampled"


# URLs and pages


@pytest.mark.parametrize(
    ("url", "want"),
    [
        (None, ("", "", None, "allow")),
        ("", ("", "", None, "allow")),
        ("no scheme/casino", ("", "", None, "block")),
        ("HTTP://A.Example.ORG/es/x?y", ("a.example.org", "/es/x", "example.org/es/", "block")),
        ("http://example.org/en/12", ("example.org", "/en/12", "example.org/en/1", "block")),
        ("http://casino.org/", ("casino.org", "/", "org/", "allow")),
        ("http://casino.org", ("casino.org", "", None, "block")),
        ("http://x.com/fr/casino", ("x.com", "/fr/casino", "com/fr/", "allow")),
        ("http://cheap.net/pills", ("cheap.net", "/pills", None, "block")),
        ("http://cheap.net/cheap", ("cheap.net", "/cheap", None, "allow")),
        ("http://casinos.net/freedom", ("casinos.net", "/freedom", None, "allow")),
        ("a://b#c://d", ("b", "", None, "allow")),
    ],
)
def test_url(url, want):
    assert urls.UrlJudge(urls.DEFAULT).judge(url) == want


def test_urls_frame(spark):
    pages = spark.createDataFrame([(1, "http://a.org/", "c"), (1, "http://a.org/", "c"), (None, None, None)], "page_id bigint, url string, host string")
    assert rows(urls.judge_urls(pages)) == sorted(["Row(page_id=1, host='a.org', path='/', rule='org/', verdict='allow')"] * 2 + ["Row(page_id=None, host='', path='', rule=None, verdict='allow')"])
    assert urls.judge_urls(pages.limit(0)).collect() == []


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><header><h1>Site</h1></header><nav><ul><li><a>Home</a></ul></nav>
<div class="cookie-notice">We use cookies. Accept, or not.</div><div id=main><h1>The   title</h1><p>First <b>bold</b>er paragraph, with text &amp; marks; long
enough.<p>Second one, <a href="x>y">linked</a>.&nbsp;Fine.<br>After a break.<form><input>Send</form><!-- <p>no</p> --></div>
<aside>Side</aside><section class="comments"><p>Great article, thanks, really, I mean it, and so on and on!</p></section><footer>&copy; me</footer>"""


def test_main_text():
    want = "The title First bolder paragraph, with text & marks; long enough. Second one, linked. Fine. After a break."
    assert html.main_text(PAGE) == want
    assert [html.main_text(x) for x in (None, "", "<script>x</script>", "<p", "plain text")] == ["", "", "", "", "plain text"]
    long = "<article>" + "<p>Word, and word.</p>" * 20_000 + "</article>"
    assert html.main_text(long) == " ".join(["Word, and word."] * 20_000)


@pytest.mark.parametrize(
    ("page", "want"),
    [
        ("<p>Word, and word.</p><b>" * 20_000, " ".join(["Word, and word."] * 20_000)),
        ("<div>" * 20_000 + "Word, and word." + "</div>" * 20_000, "Word, and word."),
        ("<div><span>" * 20_000 + "Word, and word.", "Word, and word."),
        ("<b>" + "<div>" * 20_000 + "</b>" * 20_000 + "Word, and word.", "Word, and word."),
    ],
    ids=("unclosed", "nested", "mixed", "closed in vain"),
)
def test_main_text_of_deep_pages_takes_time_in_proportion(page, want):
    start = time.process_time()
    assert html.main_text(page) == want
    assert time.process_time() - start < 5


def test_extract(spark):
    pages = spark.createDataFrame([(1, "u", PAGE, "t"), (1, None, None, None)], "page_id bigint, url string, html string, text string")
    got = html.extract(pages).collect()
    assert [r["n_chars"] for r in got] == [len(html.main_text(PAGE)), 0]
    assert html.extract(pages.limit(0)).collect() == []


# contamination and licences


def plain_shingles(text):
    words = re.findall(r"[0-9a-z\x80-\U0010ffff]+", (text or "").lower())
    return {" ".join(words[k : k + 5]) for k in range(max(1, len(words) - 4))} if words else set()


def test_contamination(spark, odd):
    passages = [prose(100 + k, n) for k, n in enumerate((7, 14, 30, 59, 200))]
    texts = [*odd, *((20 + k, f"{prose(200 + k, 3000)}\n{p.upper()}! {prose(300 + k, 50)}") for k, p in enumerate(passages))]
    half = " ".join(passages[2].split()[:15])
    texts.append((40, f"{prose(400)} {half} {prose(401)}"))
    items = [*enumerate(passages), (3, passages[3]), (50, None), (51, "!!"), (52, "one two"), (None, passages[1])]
    table = spark.createDataFrame([(k, t, "a", 1) for k, t in items], "item_id bigint, text string, size string, doc_id int")
    got = sorted(map(str, ((r["doc_id"], r["item_id"], r["shared"], r["item_shingles"]) for r in contamination.find(docs_of(spark, texts), table).collect())))
    want = set()
    for d, t in texts:
        for i, p in items:
            own = plain_shingles(p)
            shared = len(own & plain_shingles(t))
            if own and shared >= math.ceil(len(own) * 0.8 - 1e-9):
                want.add((d if d >= 0 else None, i, shared, len(own)))
    assert got == sorted(map(str, want))
    assert contamination.find(docs_of(spark, texts), table.limit(0)).collect() == []
    assert contamination.find(docs_of(spark, []), table).collect() == []


def test_contamination_finds_all_short_items(spark):
    items = [(k, " ".join(prose(2000 + k, 400).split()[:n])) for k, n in enumerate([5] * 200 + [6, 8, 9, 10, 12] * 8)]
    items += [(900, "na " * 60), (901, "so it goes on " * 30)]
    texts = [(10_000 + k, f"{prose(5000 + k, 60)} {' '.join(p for _, p in items[k::12])} {prose(6000 + k, 60)}") for k in range(12)]
    got = {(r["doc_id"], r["item_id"], r["shared"]) for r in contamination.find(docs_of(spark, texts), spark.createDataFrame(items, "item_id bigint, text string")).collect()}
    want = set()
    for d, t in texts:
        there = plain_shingles(t)
        for i, p in items:
            own = plain_shingles(p)
            if (shared := len(own & there)) >= math.ceil(len(own) * 0.8 - 1e-9):
                want.add((d, i, shared))
    assert len(want) >= len(items)
    assert got == want


def test_licences(spark):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this.\nThe above copyright notice and this permission notice shall be included.\nTHE SOFTWARE IS PROVIDED \"AS IS\", so."
    gpl = "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License. Either version 2 of the License."
    texts = [(1, mit), (2, "Copyright (c) me.\nReleased under the MIT License.\nReleased under the MIT License."), (3, None), (4, ""), (5, "No word of it"), (-1, gpl), (6, "Licensed under a strange thing"), (7, "Work: CC  \"BY\" 4.0.")]
    got = {r["doc_id"]: (r["sentence_ids"], r["licences"], r["n_licences"]) for r in licences.recognise(docs_of(spark, texts)).collect()}
    assert got[1] == ("MitGrant,MitNotice,AsIs", "MIT", 1)
    assert got[2] == ("Copyright,MitTitle,MitTitle", "MIT", 1)
    assert got[3] == got[4] == got[5] == ("", "", 0)
    assert got[6] == ("Unknown", "unknown", 1)
    assert got[7] == ("CcBy", "CC-BY", 1)
    assert got[None][1].startswith("GPL")
    assert licences.recognise(docs_of(spark, [])).collect() == []


GPL_3 = """This program is free software: you can redistribute it and/or modify
it under the terms of the GNU General Public License as published by
the Free Software Foundation, either version 3 of the License, or
(at your option) any later version.

This program is distributed in the hope that it will be useful,
but WITHOUT ANY WARRANTY; without even the implied warranty of
MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.  See the
GNU General Public License for more details.

You should have received a copy of the GNU General Public License
along with this program.  If not, see <https://www.gnu.org/licenses/>."""
LGPL_2 = """This library is free software; you can redistribute it and/or
modify it under the terms of the GNU Lesser General Public
License as published by the Free Software Foundation; either
version 2.1 of the License, or (at your option) any later version."""
BSD_3 = """Copyright (c) 2020, Someone
All rights are held.

Redistribution and use in source and binary forms, with or without
modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this
   list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice,
   this list of conditions and the following disclaimer in the documentation
   and/or other materials provided with the distribution.

3. Neither the name of the copyright holder, Inc. nor the names of its
   contributors may be used to endorse or promote products derived from
   this software without specific prior written permission.

THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS"
AND ANY EXPRESS OR IMPLIED WARRANTIES ARE DISCLAIMED."""
MIT = """Permission is hereby granted, free of charge, to any person obtaining
a copy of this software and associated documentation files, to deal
in the Software without restriction, subject to the following conditions:

The above copyright notice and this permission notice shall be
included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND."""
APACHE = """Licensed under the Apache License, Version 2.0 (the "License");
you may not use this file except in compliance with the License.
You may obtain a copy of the License at

    http://www.apache.org/licenses/LICENSE-2.0

Unless required by applicable law or agreed to in writing, software
distributed under the License is distributed on an "AS IS" BASIS,
WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.
See the License for the specific language governing permissions and
limitations under the License."""


def test_licences_wrapped_as_they_usually_are(spark):
    whole = {"GPL-3.0-or-later": GPL_3, "LGPL-2.1-or-later": LGPL_2, "BSD-3-Clause": BSD_3, "MIT": MIT, "Apache-2.0": APACHE}
    shapes = [
        lambda t: t,
        lambda t: " ".join(t.split()),
        lambda t: t.replace("\n", "\r\n"),
        lambda t: "\n".join(f"# {x}".rstrip() for x in t.split("\n")),
        lambda t: "/*\n" + "\n".join(f" * {x}".rstrip() for x in t.split("\n")) + "\n */",
        lambda t: f"Some prose before.\n\n{t}\n\nSome prose after.",
    ]
    texts = [(k * 10 + n, shape(t)) for k, t in enumerate(whole.values()) for n, shape in enumerate(shapes)]
    got = {r["doc_id"]: r["licences"] for r in licences.recognise(docs_of(spark, texts)).collect()}
    assert got == {k * 10 + n: name for k, name in enumerate(whole) for n in range(len(shapes))}


# language model


def test_ngram_counts_are_exact(spark, odd, monkeypatch):
    monkeypatch.setattr(ngram_lm, "HEAD_WORDS", 3)
    monkeypatch.setattr(ngram_lm, "FLUSH", 500)
    monkeypatch.setattr(ngram_lm, "ROWS_OUT", 64)
    docs = docs_of(spark, odd)
    learned = ngram_lm.train(docs.where("doc_id < 8"))
    tokens = lambda t: [*WORD.findall((t or "").translate(LOWER)), ""]
    seen = collections.Counter(x for k, t in odd if 0 <= k < 8 for x in tokens(t))
    total, kinds = sum(seen.values()), len(seen)
    want = sorted((k, len(x), sum(seen[w] > 0 for w in x), sum(math.log10((seen[w] + 1) / (total + kinds + 1)) for w in x)) for k, t in odd for x in [tokens(t)])
    got = sorted((-1 if r["doc_id"] is None else r["doc_id"], r["n_tokens"], r["n_known"], r["base_score"]) for r in ngram_lm.score(docs, *learned).collect())
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert np.allclose([g[3] for g in got], [w[3] for w in want])
    assert ngram_lm.score(docs, *learned).where("train_tokens <> " + str(total)).count() == 0
    empty = ngram_lm.train(docs.limit(0))
    assert all(r["base_score"] == 0 for r in ngram_lm.score(docs, *empty).collect())


def test_filter_keeps_counts_within_a_factor_of_two(spark):
    h = [(k * 0x9E3779B97F4A7C15) % (1 << 63) for k in range(1, 6000)]
    n = [1 + k % 50 for k in range(len(h))]
    found, _ = ngram_lm.build_filter(spark.createDataFrame(list(zip(h, n, strict=True)), "h bigint, n bigint"))
    got, n, pair = found.levels(np.array(h, dtype=np.uint64)), np.array(n), np.array(h) % 2 == 1
    least = ngram_lm._least(got)
    seen = ~pair | (n > 1)
    assert (least[seen] > n[seen] / 2).all() and (least[seen] <= n[seen]).mean() > 0.98
    assert (got[~seen] == 0).mean() > 0.999
    others = np.array([x ^ (1 << 40) for x in h], dtype=np.uint64)
    assert (found.levels(others) > 0).mean() < 0.001


def test_scores_do_not_depend_on_the_room_for_a_filter(spark, odd, monkeypatch):
    docs = docs_of(spark, [(k, t) for k, t in odd if k != 7] + [(10 + k, prose(700 + k % 4, 200 + k)) for k in range(12)])
    scores = []
    for room in (ngram_lm.MAX_BITS, 64):
        monkeypatch.setattr(ngram_lm, "MAX_BITS", room)
        learned = ngram_lm.train(docs.where("doc_id <> 9"))
        assert (learned[1] is None) == (room > 64)
        scores.append(sorted(ngram_lm.score(docs, *learned).collect(), key=str))
    for one, two in zip(*scores, strict=True):
        assert one[:4] == two[:4]
        assert one[4:] == pytest.approx(two[4:], rel=1e-12), "the same levels, whoever is asked"


def word_hashes(words):
    import pyarrow as pa

    from tideline.llm.text import chunks

    return np.concatenate([c.hashes() & ~np.uint64(1) for c in chunks(pa.array(words))])


def pair_after(before, word):
    mix = ngram_lm.mix
    return mix(before * np.uint64(0x9E3779B97F4A7C15) + mix(word)) | np.uint64(1)


@pytest.mark.filterwarnings("ignore:overflow")
@pytest.mark.parametrize("bits", [20, 25])
def test_words_after_a_context_have_no_more_than_all_of_the_mass(spark, sample, monkeypatch, bits):
    """With 20 the filter is as full as it may be."""
    monkeypatch.setattr(ngram_lm, "HEAD_WORDS", 2000)
    monkeypatch.setattr(ngram_lm, "MIN_BITS", 1 << bits)
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    model, _, counts = ngram_lm.train(docs)
    words = sorted({w for r in docs.select("text").collect() for w in WORD.findall((r["text"] or "").translate(LOWER))})
    vocabulary = np.append(word_hashes(words), ngram_lm.END)
    least, most = model.seen(vocabulary)
    alone = (least + 1) / (model.tokens + model.words + 1)
    assert alone.sum() + 1 / (model.tokens + model.words + 1) <= 1 + 1e-9
    order = np.argsort(-most)
    sums = []
    for k in (*order[:40], *order[200:5000:200], *order[-60:]):
        context, before = vocabulary[k], most[k]
        pairs = np.maximum(ngram_lm._least(model.filter.levels(pair_after(context, vocabulary))) - 1, 0)
        weight = ngram_lm.PAIR_WEIGHT * before / (before + ngram_lm.BACK_OFF)
        after = np.minimum(pairs / np.maximum(before + model.words * model.chance, 1), 1)
        sums.append((weight * after + (1 - weight) * alone).sum())
    assert max(sums) <= 1 + 1e-9
    assert min(sums) > 0.5


def test_scores_equal_a_plain_model(spark, odd):
    """Against counts in a dictionary, quantised the same way; the filter is far from full, so chance plays no part."""
    texts = [t for k, t in odd if k != 7] + [prose(700 + k % 4, 200 + k) for k in range(12)]
    docs = docs_of(spark, list(enumerate(texts)))
    learned = ngram_lm.train(docs)
    tokens = [[*WORD.findall((t or "").translate(LOWER)), None] for t in texts]
    words = collections.Counter(w for x in tokens for w in x)
    pairs = collections.Counter(p for x in tokens for p in zip(["<"] + x[:-1], x, strict=True))
    total, model = sum(words.values()), learned[0]
    want = {}
    for k, x in enumerate(tokens):
        score = 0.0
        for before, word in zip(["<"] + x[:-1], x, strict=True):
            n = words[before] if before != "<" else len(texts)
            weight = ngram_lm.PAIR_WEIGHT * n / (n + ngram_lm.BACK_OFF)
            kept = 2 ** (pairs[before, word].bit_length() - 1) - 1
            after = min(kept / (n + len(words) * model.chance), 1)
            score += math.log10(weight * after + (1 - weight) * (words[word] + 1) / (total + len(words) + 1))
        want[k] = score
    got = {r["doc_id"]: r["score"] for r in ngram_lm.score(docs, *learned).collect()}
    assert got == pytest.approx(want)


def test_each_ngram_is_looked_up_once_in_a_text_and_the_head_never(spark, monkeypatch):
    import pyarrow as pa

    from tideline.llm.text import chunks

    monkeypatch.setattr(ngram_lm, "HEAD_WORDS", 2)
    model, _, _ = ngram_lm.train(docs_of(spark, [(k, "a a b a") for k in range(20)]))
    asked, has = [], ngram_lm.Filter.has
    monkeypatch.setattr(ngram_lm.Filter, "has", lambda self, h, *more: asked.append(h) or has(self, h, *more))
    chunk = next(chunks(pa.array(["a a b " * 500])))
    row = ngram_lm._score_chunk(model, pa.array([1]), np.arange(1), chunk)
    word, pair, _ = ngram_lm._tokens(chunk)
    looked_up = np.concatenate(asked)
    assert row.column(2).to_pylist() == [1501]
    assert len(looked_up) <= ngram_lm.LEVELS * (len(np.unique(pair)) + 2)
    assert not np.isin(model.head, looked_up).any() and np.isin(np.unique(word)[~np.isin(np.unique(word), model.head)], looked_up).all()


def test_a_bucket_of_the_filter_looks_up_once_whoever_asks(monkeypatch):
    import pyarrow as pa

    rng, size_log = np.random.default_rng(3), 22
    inner_log = size_log - ngram_lm.segments_log(size_log)
    h = np.unique(rng.integers(0, 1 << 64, 4000, dtype=np.uint64) >> np.uint64(7) | np.uint64(5 << 57))  # all of one bucket
    level = rng.integers(2, 9, len(h))
    bits = np.zeros(1 << size_log, dtype=bool)
    bits[ngram_lm._events(h[:3000], level[:3000], size_log).astype(np.int64)] = True
    whole = ngram_lm.Filter(np.packbits(bits, bitorder="little"), size_log)
    block, first = 1 << (inner_log - 3), 5 << ngram_lm.BUCKET_LOG
    own = [whole.bits[s * block : (s + 1) * block].tobytes() for s in range(first, first + (1 << ngram_lm.BUCKET_LOG))]
    held = pa.table({"segment": pa.array(range(first + 7, first - 1, -1), pa.int64()), "bits": pa.array(own[::-1], pa.binary())})
    runs = [np.sort(rng.choice(h, 50, replace=False)) for _ in range(200)] + [h[:0]]
    asked = pa.table({"bucket": [5] * 201, "piece": list(range(201)), "h": pa.array([r.view(np.int64) for r in runs], pa.list_(pa.int64()))})
    want = [whole.levels(r).tobytes() for r in runs]
    calls, levels = [], ngram_lm.Filter.levels
    monkeypatch.setattr(ngram_lm.Filter, "levels", lambda self, h: calls.append(len(h)) or levels(self, h))
    got = ngram_lm._answer(asked, held, size_log)
    assert got["levels"].to_pylist() == want and got["piece"].to_pylist() == list(range(201))
    assert calls == [10_000]
    none = ngram_lm._answer(asked, held.slice(0, 0), size_log)
    assert set(b"".join(none["levels"].to_pylist())) == {0}, "a bucket without a bit"
    assert len(ngram_lm._answer(asked.slice(0, 0), held, size_log)) == 0


# packing


@pytest.mark.parametrize("seed", range(12))
def test_plan_fills_all_windows(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 2047): rng.choice([1, 2, 7, 400]) for _ in range(rng.choice([1, 3, 60]))}
    plan = packing.make_plan(dict(counts))
    length = np.concatenate([np.full(c, n) for n, c in counts.items()])
    rank = np.concatenate([np.arange(c) for c in counts.values()])
    row, start, size, sequence, offset = packing.deal(length, rank, plan)
    total = np.bincount(sequence, weights=size).astype(int)
    assert total.max() <= 2048 and all(int(t).bit_count() == 1 for t in total)
    order = np.lexsort((offset, sequence))
    at = collections.defaultdict(int)
    for s, o, z in zip(sequence[order], offset[order], size[order], strict=True):
        assert o == at[s]
        at[s] += z
    assert (np.bincount(row, weights=size) == length).all()
    assert packing.make_plan({}).sequences == 0


def test_pack_round_trip(spark, odd):
    import public_tokenizers
    from tokenizers import Tokenizer

    texts = [*odd, (30, "a <|endoftext|> b"), (31, "漢字 🙂 é")]
    got = packing.pack(docs_of(spark, texts)).collect()
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = collections.Counter()
    for k, t in texts:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], dtype="<u4")
        want[k if k >= 0 else None, len(ids)] += len(ids)
        for r in got if k not in (3, -1) else []:
            if r["doc_id"] == k:
                assert r["ids_crc32"] == zlib.crc32(ids[r["start"] : r["start"] + r["length"]].tobytes())
    have = collections.Counter()
    filled = collections.defaultdict(list)
    for r in got:
        have[r["doc_id"], r["doc_tokens"]] += r["length"]
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    assert have == want
    for pieces in filled.values():
        end = 0
        for offset, length in sorted(pieces):
            assert offset == end
            end += length
        assert end <= 2048
    assert packing.pack(docs_of(spark, [])).collect() == []


# vectors


def test_embeddings(spark, monkeypatch):
    monkeypatch.setattr(embeddings, "LEAF", 16)
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(40, 16))
    vectors = [(k, (centres[k % 40] + rng.normal(size=16) * (0.05 if k % 40 else 0.001)).tolist(), int(k % 40) % 3) for k in range(300)]
    vectors += [(1000 + k, vectors[7][1], vectors[7][2]) for k in range(30)]
    odd = [(500, None, 1), (501, [0.0] * 16, 1), (502, [None] + [1.0] * 15, 1), (503, [float("nan")] * 16, 1), (504, vectors[0][1], None), (505, [], 1), (506, [1.0, 2.0], 1), (506, [float("inf")] * 16, 1)]
    table = spark.createDataFrame([(*v, "a", 1) for v in [*vectors, *odd]], "vec_id bigint, embedding array<float>, label int, cell string, node int")
    got = {(r["vec_id"], r["n_links"], r["component_id"], r["kept"]) for r in embeddings.near_duplicates(table).collect()}
    x = np.array([v[1] for v in vectors], dtype=np.float32).astype(float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    label = np.array([v[2] for v in vectors])
    near = (unit @ unit.T >= 0.98) & (label[:, None] == label[None, :])
    np.fill_diagonal(near, False)
    ids = [v[0] for v in vectors]
    group = plain_components(range(len(ids)), lambda a, b: near[a, b])
    least = collections.defaultdict(list)
    for k, g in group.items():
        least[g].append(ids[k])
    want = {(ids[k], int(near[k].sum()), min(least[group[k]]), ids[k] == min(least[group[k]])) for k in range(len(ids))}
    want |= {(v[0], 0, v[0], True) for v in odd}
    assert len(got & want) / len(want) > 0.97
    assert sum(g[1] for g in got) >= 0.97 * near.sum()
    assert embeddings.near_duplicates(table.limit(0)).collect() == []


def test_pairs_count_in_the_first_cell_they_share():
    rng = np.random.default_rng(2)
    cells = np.full((60, 9), np.iinfo(np.int64).max)
    for k in range(60):
        own = np.sort(rng.choice(40, rng.integers(1, 9), replace=False)) - 20
        cells[k, : len(own)] = own
    cells[:, 8] = 7  # all are here
    a, b = np.nonzero(~np.eye(60, dtype=bool))
    sets = [set(row.tolist()) - {np.iinfo(np.int64).max} for row in cells]
    want = [min(sets[x] & sets[y]) == 7 for x, y in zip(a, b, strict=True)]
    assert embeddings._first_meeting(cells, a, b, 7).tolist() == want and 0 < sum(want) < len(want)


def test_vectors_are_not_moved_to_split_a_tree(spark, monkeypatch):
    """A pass over all vectors for each level, with the vectors written each time, does not end on large tables."""
    monkeypatch.setattr(embeddings, "LEAF", 8)
    rng, staged, real = np.random.default_rng(8), [], embeddings.stage
    monkeypatch.setattr(embeddings, "stage", lambda df, label: staged.append((label, df.columns)) or real(df, label))
    monkeypatch.setattr(embeddings, "LEVELS_AT_ONCE", 3)
    x = rng.normal(size=(200, 8)).astype(np.float32)
    table = spark.createDataFrame([(k, v.tolist(), 1) for k, v in enumerate(x)], "vec_id bigint, embedding array<float>, label int")
    leaf = embeddings.leaves(embeddings._classes(table.select(table.vec_id.alias("id"), table.embedding.alias("raw"), "label")), 0.98, 2)
    split = [columns for label, columns in staged if label in ("halves", "leaves")]
    assert len(split) > 4 and not any("vec" in columns for columns in split)
    assert sum(label == "projected" for label, _ in staged) == -(-sum(label == "cells" for label, _ in staged) // 3)
    rows = leaf.groupBy("cell").count().collect()
    assert max(r["count"] for r in rows) <= 8 and leaf.select("node").distinct().count() == 200
    found = embeddings.near_duplicates(table).orderBy("vec_id").collect()
    assert [r["vec_id"] for r in found] == list(range(200)) and not any(r["n_links"] for r in found)
