"""The audits and the host rules against brute force, with nulls, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import collections
import itertools
import random
import re

import pytest

from tideline.llm import divergence, filter_audit, host_rules

DOCS = "doc_id bigint, text string, lang string, source string, row string, host string, n string, mask string, words string, term string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def table(spark, rows):
    return spark.createDataFrame([(*r, "x", None, "z", "m", "w", "t") for r in rows], DOCS)


def prose(seed, words):
    rng = random.Random(seed)
    return " ".join(rng.choice(["Ka", "lo", "mi", "Tu", "re", "sé", "ño"]) + rng.choice(["", "ra", "mo", "x1"]) for _ in range(words))


@pytest.fixture(scope="module")
def docs():
    text = prose(1, 150)
    return [
        (7, text, "en", "a"), (3, text, "en", "b"), (3, text, "en", "b"), (9, text, "fr", None), (None, text, None, "a"),
        (1, None, "en", "a"), (2, "", None, None), (4, " \t\n\x0b", "", "b"), (5, "AB CD # one", "fr", "c"), (6, prose(2, 30_000), "en", "c"),
        (8, "one two three four five six seven eight " * 3 + "\none\none\n \nTwo\none", "en", "a"), (10, "ÀÉ " * 120, "fr", "c"),
    ]


# filters


def plain_audit(docs, labels):
    parts = sorted({lang or "" for _, _, lang, _ in docs})
    rows = []
    for doc_id, text, lang, _ in docs:
        text = text or ""
        words = WORD.findall(text)
        earlier = doc_id is not None and any(d is not None and d < doc_id and (t or "") == text for d, t, _, _ in docs)
        fails = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            "D": bool(re.search(r"[#$%&*|]", text)),
            "E": earlier,
        }
        flag = {k: any(d == doc_id and d is not None and v[k] == 1 for d, *v in labels) for k in (0, 1)}
        rows.append((lang or "", {f for f, x in fails.items() if x}, flag[0], flag[1]))
    out, removed_by = [], collections.Counter()
    for part, order in itertools.product(parts, itertools.permutations("ABCDE")):
        for step, f in enumerate(order):
            inside = [(fails, good, toxic) for p, fails, good, toxic in rows if p == part]
            removed = [x for x in inside if f in x[0] and not x[0] & set(order[:step])]
            removed_by[part, f] += len(removed)
            out.append((
                part, "".join(order), step + 1, sum(not fails & set(order[: step + 1]) for fails, *_ in inside), len(removed),
                sum(f in fails for fails, *_ in inside) - len(removed), sum(fails == {f} for fails, *_ in inside),
                sum(good for _, good, _ in removed), sum(toxic for *_, toxic in removed),
            ))
    return sorted((*r, removed_by[r[0], r[1][r[2] - 1]]) for r in out)


def test_filter_audit_equals_brute_force(spark, docs):
    labels = [(3, 1, 0), (3, None, 1), (7, 1, 1), (9, 0, 1), (8, 1, None), (None, 1, 1), (99, 1, 1)]
    flags = spark.createDataFrame([(*x, "clash") for x in labels], "doc_id bigint, quality int, toxic int, good string")
    out = filter_audit.audit(table(spark, docs), flags)
    assert sorted(map(tuple, out.collect())) == plain_audit(docs, labels)


def test_filter_audit_of_nothing(spark, docs):
    flags = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filter_audit.audit(table(spark, docs).limit(0), flags).count() == 0
    assert {r["good_lost"] for r in filter_audit.audit(table(spark, docs), flags).collect()} == {0}


def test_fields_do_not_overflow():
    counts = [(mask, True, False, 10**15 + mask) for mask in range(32)]
    rows = filter_audit.audit_part(counts)
    total = sum(n for *_, n in counts)
    assert len(rows) == 600
    for order, step, kept, removed, redundant, unique, good, toxic, shapley in rows:
        bits = [1 << "ABCDE".index(f) for f in order]
        before, own = sum(bits[: step - 1]), bits[step - 1]
        assert removed == good == sum(n for m, _, _, n in counts if m & own and not m & before)
        assert redundant == sum(n for m, _, _, n in counts if m & own and m & before)
        assert kept == sum(n for m, _, _, n in counts if not m & (before + own))
        assert unique == 10**15 + own and toxic == 0 and shapley > removed
    assert sum(r[3] for r in rows if r[0] == "ABCDE") + rows[4][2] == total


# divergence


def plain_divergence(docs):
    terms = [(d[2] or "", d[3] or "", collections.Counter(re.findall(rb"[a-z\x80-\xff]+", (d[1] or "").encode().lower()))) for d in docs]
    out = []
    for lang in {t[0] for t in terms}:
        inside = [(s, c) for x, s, c in terms if x == lang]
        df = collections.Counter(t for _, c in inside for t in c)
        kept = sorted(t for t, n in df.items() if n >= divergence.LEAST_DOCS)
        counts = {s: collections.Counter() for s, _ in inside}
        for s, c in inside:
            counts[s].update(c)
        whole = sum(counts.values(), collections.Counter())

        def share(c, kept=kept):
            total = sum(c[t] for t in kept)
            return {t: 1 + 10**9 * (c[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p, q = {s: share(c) for s, c in counts.items()}, share(whole)
        for s in counts:
            pair = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o.encode(), o, "pair") for o in counts if o != s]
            more = [(q[t] - p[s][t], t, t.decode(), "term") for t in kept if counts[s][t] and p[s][t] > q[t]]
            for ranked in (sorted(pair), sorted(more)[: divergence.TOP_TERMS]):
                out += [(lang, s, part, item, -v, k + 1) for k, (v, _, item, part) in enumerate(ranked)]
    return sorted(out)


def test_divergence_equals_brute_force(spark, docs, monkeypatch):
    monkeypatch.setattr(divergence, "FLUSH", 50)
    many = docs + [(100 + k, prose(k % 60, 5 + k % 40), "en" if k % 3 else "fr", "abcd"[k % 4 * (k % 7 > 1)]) for k in range(200)]
    many += [(500, "", "en", "empty"), (501, None, "xx", "p"), (502, "few words", "xx", "q")]
    out = divergence.audit(table(spark, many))
    assert sorted(map(tuple, out.collect())) == plain_divergence(many)
    assert out.where("lang = 'xx' AND value = 0").count() == 2


def test_divergence_of_nothing(spark, docs):
    assert divergence.audit(table(spark, docs).limit(0)).count() == 0


# host rules


def plain_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = collections.defaultdict(list)
    for k in range(len(words) - 7):
        windows[tuple(words[k : k + 8])].append(k)
    covered = {k + j for ks in windows.values() if len(ks) > 1 for k in ks for j in range(8)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines), len(lines) - len(set(lines)), len(covered),
    )


def test_measures_equal_brute_force(spark, docs):
    rng = random.Random(5)
    odd = [" ".join(rng.choice("ab") for _ in range(n)) + "\n" * (n % 3) + "x #\nx #" for n in range(60)]
    many = docs + [(1000 + k, t, "en", "s") for k, t in enumerate(odd)]
    out = host_rules.judge(table(spark, many)).collect()
    assert sorted((r["doc_id"] or -1, tuple(r["measures"])) for r in out) == sorted((d[0] or -1, plain_measures(d[1])) for d in many)
    assert {r["n"] for r in out} == {"z"} and {r["row"] for r in out} == {"x"}


def test_hosts_are_shrunk_and_judged(spark):
    good = " ".join(f"word{k}" for k in range(40))
    noisy = " ".join(f"w{k} #" for k in range(40))
    hosts = {"bad": (60, 0), "few": (1, 0), "fine": (1, 60), "mixed": (30, 70), "clean": (0, 80), None: (0, 5)}
    rows = [
        (k, noisy if k < fails else good, "en", host) for host, (fails, passes) in hosts.items() for k in range(fails + passes)
    ]
    out = host_rules.judge(table(spark, rows)).collect()
    kept = collections.Counter((r["source"], r["failed"] == [], r["kept"]) for r in out)
    assert kept["bad", False, False] == 60 and {r["source"] for r in out if r["host_rejected"]} == {"bad"}
    assert kept["few", False, True] == 0 or kept["few", False, False] == 0
    assert kept["fine", True, True] == 60 and kept["fine", False, True] == 1, "one failure of a fine host is forgiven"
    assert kept["mixed", True, True] == 70 and kept["mixed", False, False] == 30
    assert kept["clean", True, True] == 80 and kept[None, True, True] == 5


def test_hosts_of_nothing(spark, docs):
    assert host_rules.judge(table(spark, docs).limit(0)).count() == 0
