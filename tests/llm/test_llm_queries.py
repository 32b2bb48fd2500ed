"""The registered queries on the smallest tables: beside their SQL, or beside plain code."""

import collections
import inspect
import re
import zlib

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from fitweave.llm.oracles import ORACLES
from fitweave.llm.queries import QUERIES
from test_near_dedup import by_force as near_by_force
from test_vector_dedup import answer, by_force as vectors_by_force
from tools.check_queries import TABLES, comparable

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF_DIR}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def documents(tables):
    return tables.execute("select doc_id, text, lang, source from documents").fetchall()


def test_all_are_registered():
    names = [f"op{n}_" for n in range(1, 14)]
    for n in names:
        assert sum(q.startswith(n) for q in entry.queries()) == 1
    assert "pipeline" in entry.queries() and set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", list(ORACLES))
def test_query_equals_sql(spark, tables, name):
    df = entry.queries()[name](spark, SF_DIR)
    result = tables.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    at = [columns.index(c) for c in df.columns]
    want = comparable([tuple(r[i] for i in at) for r in result.fetchall()])
    assert comparable([tuple(r) for r in df.collect()]) == want and want


@pytest.mark.parametrize("name", ["op6_source_mixing", "op10_hash_tree_sharding"])
def test_native_plans_hold_no_python(spark, name):
    plan = QUERIES[name](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()
    for word in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"):
        assert word not in plan


def test_passages_of_the_table(spark, documents):
    """Every found passage is one; every run of 50 words that two documents share is found."""
    found = QUERIES["op1_substring_dedup"](spark, SF_DIR).collect()
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t)) for i, t, _, _ in documents}
    runs = collections.defaultdict(set)
    for i, w in words.items():
        for k in range(len(w) - 49):
            runs[tuple(w[k : k + 50])].add(i)
    spans = collections.defaultdict(list)
    for r in found:
        spans[r["doc_id"]].append((r["first_word"], r["end_word"]))
        assert r["end_word"] - r["first_word"] >= 50 and r["end_word"] <= len(words[r["doc_id"]])
    for i, w in words.items():
        for k in range(len(w) - 49):
            if len(runs[tuple(w[k : k + 50])]) > 1:
                assert any(a <= k + 45 and b > k for a, b in spans[i])
    # Without a shared run of 25 words nothing is similar enough over 50.
    some = collections.Counter(x for w in words.values() for x in {tuple(w[k : k + 8]) for k in range(len(w) - 7)})
    clean = {i for i, w in words.items() if not any(some[tuple(w[k : k + 8])] > 1 for k in range(len(w) - 7))}
    assert not clean & set(spans)


def test_vectors_of_the_table(spark, tables):
    rows = tables.execute("select vec_id, embedding, label from embeddings").fetchall()
    assert answer(QUERIES["op9_vector_dedup"](spark, SF_DIR)) == vectors_by_force(rows)


def test_class_scores_of_the_table(spark, documents):
    found = {r["doc_id"]: r for r in QUERIES["op5_class_scores"](spark, SF_DIR).collect()}
    words = {i: re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) for i, t, _, _ in documents}
    held = {i for i in words if zlib.crc32(str(i).encode()) % 7 == 2}
    count = collections.Counter(w for i in words if i not in held for w in words[i])
    n, v = sum(count.values()) + len(words) - len(held), len(count) + 1
    ends = len(words) - len(held)
    for i, w in words.items():
        r = found[i]
        base = sum(np.log10((count[x] + 1) / (n + v + 1)) for x in w) + np.log10((ends + 1) / (n + v + 1))
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (i in held, len(w) + 1, sum(x in count for x in w) + 1, n)
        assert r["base_score"] == pytest.approx(base)
    own, plain = (sum(found[i][c] for i in held) for c in ("score", "base_score"))
    assert own > plain


def test_languages_of_the_table(spark, documents):
    found = {r["doc_id"]: r for r in QUERIES["op8_language_id"](spark, SF_DIR).collect()}
    held = [(i, lang) for i, _, lang, _ in documents if found[i]["held_out"]]
    assert np.mean([found[i]["lang_pred"] == lang for i, lang in held]) > 0.9


def test_pipeline_stages(spark, documents):
    """Each stage beside plain code or its query on what the stage before it kept."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, schema = docs.columns, docs.schema
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["toxicity", "near-duplicates", "decontamination", "mixing", "sharding"]
    stages = [f for _, f in corpus_pipeline.STAGES]
    assert all(list(inspect.signature(f).parameters) == ["spark", "docs", "sf_dir"] for f in stages)

    first = stages[0](spark, docs, SF_DIR)
    assert first.columns == columns and first.schema == schema
    toxic = {r["doc_id"] for r in QUERIES["op7_toxicity"](spark, SF_DIR).collect() if r["predicted"]}
    rows = [tuple(r) for r in first.collect()]
    assert {r[0] for r in rows} == {i for i, *_ in documents} - toxic

    second = stages[1](spark, first, SF_DIR)
    parts = near_by_force([(r[0], r[1]) for r in rows], 5)
    rows = [tuple(r) for r in second.collect()]
    assert second.columns == columns and {r[0] for r in rows} == {i for i, low in parts.items() if i == low}

    third = stages[2](spark, second, SF_DIR)
    leaked = {r["doc_id"] for r in QUERIES["op3_decontamination"](spark, SF_DIR).collect() if r["contaminated"]}
    rows = [tuple(r) for r in third.collect()]
    assert third.columns == columns and {r[0] for r in rows} == {i for i, low in parts.items() if i == low} - leaked

    fourth = stages[3](spark, third, SF_DIR)
    mix = [tuple(r) for r in fourth.collect()]
    assert fourth.columns == columns and set(mix) <= set(rows) and max(collections.Counter(mix).values()) <= 3
    words = lambda own: sum(len(re.findall(r"[^\x20\x09-\x0D]+", r[1])) for r in own)
    assert abs(words(mix) - words(rows)) < 0.1 * words(rows)

    last = stages[4](spark, fourth, SF_DIR)
    done = last.collect()
    assert sorted(tuple(r[c] for c in columns) for r in done) == sorted(mix)
    for shard, own in collections.Counter(r["shard"] for r in done).items():
        assert 0 <= shard < 8
        assert sorted(r["slot"] for r in done if r["shard"] == shard) == list(range(own))


def test_run_gives_the_last_stage(spark):
    found = corpus_pipeline.run(spark, SF_DIR).collect()
    assert found and len({(r["shard"], r["slot"]) for r in found}) == len(found)


def test_stages_on_empty_odd_and_clashing_rows(spark, tmp_path):
    schema = "doc_id long, text string, lang string, source string, n_chars long, score double, size int, kept boolean, hits string, shard int, copies int, id long"
    extra = (0.5, 1, True, "h", 2, 3, 4)
    rows = [(1, "some words here", "en", "a", 15, *extra), (1, "some words here", "en", "a", 15, *extra), (None, None, None, None, None, *extra),
            (2, "", "en", None, 0, *extra), (3, "x " * 50_000, "fr", "b", 1, *extra)]
    spark.createDataFrame([(1, "quite another text")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (3, 1, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for data in (rows, []):
        docs = spark.createDataFrame(data, schema)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, str(tmp_path))
            assert docs.schema.simpleString() == spark.createDataFrame([], schema).schema.simpleString()
        found = corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).collect()
        assert bool(found) == bool(data)
