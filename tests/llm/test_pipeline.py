"""The queries against their SQL, and the pipeline's stages against what they promise."""

import pytest
from compare import connect, difference
from plans import plan

import corpus_pipeline
from tideline.catalog.base import Query
from tideline.llm import catalog, simhash


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_its_sql(spark, sample, name):
    with connect(sample) as sql:
        assert difference(spark, sql, sample, Query(catalog.QUERIES[name], catalog.SQL[name])) == ""


def test_language_is_learned(spark, sample):
    out = catalog.op2_language(spark, sample).join(spark.read.parquet(f"{sample}/documents.parquet"), "doc_id").where("held_out").collect()
    assert sum(r["lang"] == r["lang_pred"] for r in out) / len(out) > 0.98


def test_pipeline(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    kept, before = docs, docs.count()
    for name, function in corpus_pipeline.STAGES[:-1]:
        kept = function(spark, kept, sample).cache()
        assert kept.columns == docs.columns
        assert kept.count() <= before, name
        before = kept.count()
    pieces = corpus_pipeline.STAGES[-1][1](spark, kept, sample)
    packed = {r["doc_id"] for r in pieces.collect()}
    assert packed == {r["doc_id"] for r in kept.collect()}
    assert before > 0.5 * docs.count()


def test_entry_registers_all():
    import __spark_entry__ as entry

    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert "pipeline" in entry.queries()


def test_near_dedup_keeps_one_row_of_each_group_of_fingerprints(spark, sample):
    docs = spark.read.parquet(f"{sample}/documents.parquet")
    kept = {r["doc_id"] for r in dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, sample).collect()}
    assert kept == {r["component_id"] for r in simhash.near_duplicates(docs).collect()}


def test_near_dedup_broadcasts_no_keys(spark, sample, monkeypatch):
    plans, real = [], simhash.components
    monkeypatch.setattr(simhash, "components", lambda links: plans.append(plan(links)) or real(links))
    docs = spark.read.parquet(f"{sample}/documents.parquet").where("doc_id < 40")
    assert 0 < dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, sample).count() <= 40
    assert len(plans) == 2
    for links in plans:
        by_key = [line for line in links.splitlines() if "Join [key#" in line]
        assert by_key and all("SortMergeJoin" in line for line in by_key), "the keys are many more rows than Spark sees"


ODD = "doc_id string, text string, lang string, `my col` string, `a-b` int, row string, c0 string, lang_score double, node string"


@pytest.fixture
def odd_docs(spark, sample):
    """Real texts with ids that are text, null or repeat, and columns with names in use or in need of quotes."""
    docs = [(r["text"], r["lang"]) for r in spark.read.parquet(f"{sample}/documents.parquet").orderBy("doc_id").limit(60).collect()]
    item = spark.read.parquet(f"{sample}/benchmark.parquet").orderBy("item_id").first()["text"]
    clean = [t for t in docs if len((t[0] or "").split()) > 150][:6]
    rows = [(f"d{k}", *t) for k, t in enumerate(clean)]
    rows += [(None, *clean[0]), ("d0", *clean[0]), ("a", *clean[1]), (None, *clean[1]), ("d2", clean[3][0] + " " + item, "en"), (None, item, "en")]
    rows += [("e1", None, "en"), ("e2", "", None), ("e2", " \t", "en"), (None, "word " * 30_000, "en")]
    return spark.createDataFrame([(*r, f"m{k}", k, "own row", "own c0", 0.25, None) for k, r in enumerate(rows)], ODD), clean, item


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages_with_odd_rows(spark, sample, odd_docs, name):
    docs, clean, item = odd_docs
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, docs, sample)
    if name == "pack":
        assert {r["doc_id"] for r in out.collect()} == {r["doc_id"] for r in docs.collect()}
        assert stage(spark, docs.limit(0), sample).count() == 0
        return
    assert out.columns == docs.columns
    got = out.collect()
    assert {(r["row"], r["c0"], r["lang_score"]) for r in got} <= {("own row", "own c0", 0.25)}
    kept = {r["my col"] for r in got}
    if name == "near_dedup":
        assert {r["my col"] for r in got if r["text"] == clean[0][0]} < {"m0", "m7"}, "of equal ids one, never the null"
        assert {r["my col"] for r in got if r["text"] == clean[1][0]} == {"m8"}, "the smallest id"
        assert sum(not (r["text"] or "").strip() for r in got) == 1
        assert {"m2", "m3", "m4", "m5", "m15"} <= kept
    if name == "decontaminate":
        assert {r["my col"] for r in docs.collect()} - kept == {"m10", "m11"}, "rows with the item, not others with their id"
    if name == "language_id":
        assert not kept & {"m12", "m13", "m14"}
    assert stage(spark, docs.limit(0), sample).count() == 0
