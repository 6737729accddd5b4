"""The registered queries and the pipeline on the driver's small tables."""

import collections
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tidewatch.llm import queries as Q
from tidewatch.llm.common import load, stage
from tidewatch.plans import catalog, verify

from .test_operators import components_of, hits

SF, SF10 = "/root/testdata/sf0.001", "/root/testdata/sf0.01"


def test_all_are_registered():
    names = __spark_entry__.queries()
    assert {*Q.QUERIES, "pipeline"} <= set(names) and set(Q.ORACLES) <= set(__spark_entry__.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in Q.QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(Q.ORACLES))
def test_query_equals_its_oracle(spark, monkeypatch, name):
    monkeypatch.setitem(catalog.QUERIES, name, Q.QUERIES[name])
    monkeypatch.setitem(catalog.ORACLES, name, Q.ORACLES[name])
    ok, message = verify.compare(spark, name, SF, verify.duck(SF))
    assert ok, message


def test_op1_digests(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = {r.doc_id: r.text for r in load(spark, SF, "documents").collect()}
    start = 0
    for r in Q.op1_token_ids(spark, SF).orderBy("doc_id").collect():
        ids = [*tok.encode(texts.pop(r.doc_id) or "", add_special_tokens=False).ids, 2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
    assert not texts


@pytest.mark.parametrize("name,column,mod,held,least", [("op2_quality", "quality", 3, 1, 0.95), ("op8_toxicity", "toxic", 5, 0, 0.9)])
def test_held_out_labels(spark, name, column, mod, held, least):
    got = Q.QUERIES[name](spark, SF10).join(load(spark, SF10, "labels"), "doc_id", "left").collect()
    assert len(got) == load(spark, SF10, "documents").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % mod == held) and 0 <= r.score <= 1 for r in got)
    judged = [r.predicted == r[column] for r in got if r.held_out and r[column] is not None]
    assert len(judged) > 50 and np.mean(judged) >= least


def test_held_out_toxic_rows_are_found_and_clean_ones_kept(spark):
    labels = load(spark, "/root/testdata/sf0.1", "labels").where("toxic is not null")
    rows = Q.op8_toxicity(spark, "/root/testdata/sf0.1").where("held_out").join(labels, "doc_id").select("toxic", "predicted").collect()
    n = collections.Counter((r.toxic, r.predicted) for r in rows)
    assert n[1, 1] + n[1, 0] > 90 and n[1, 1] / (n[1, 1] + n[1, 0]) >= 0.9
    assert n[1, 1] / (n[1, 1] + n[0, 1]) >= 0.95 and n[0, 0] / (n[0, 0] + n[0, 1]) >= 0.99, n


def test_nontoxic_stage_drops_toxic_rows_and_keeps_clean_ones(spark):
    docs = load(spark, SF10, "documents")
    left = {r.doc_id for r in corpus_pipeline.nontoxic(spark, docs, SF10).select("doc_id").collect()}
    toxic = {r.doc_id: r.toxic for r in load(spark, SF10, "labels").collect() if r.toxic is not None}
    assert np.mean([i not in left for i, y in toxic.items() if y]) >= 0.9 and np.mean([i in left for i, y in toxic.items() if not y]) >= 0.98


def test_held_out_languages(spark):
    got = Q.op6_language(spark, SF10).join(load(spark, SF10, "documents").select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert np.mean([r.lang_pred == r.lang for r in got if r.held_out]) > 0.98


def test_op5_rules(spark):
    got = Q.op5_url_filter(spark, SF).join(load(spark, SF, "pages").select("page_id", "url"), "page_id").collect()
    assert len(got) == load(spark, SF, "pages").count()
    for r in got:
        fits = []
        for rule in Q.URL_RULES:
            host, _, path = rule.text.partition("/")
            if (r.host == host or r.host.endswith("." + host)) and r.path.startswith("/" + path):
                fits.append(rule)
        best = max(fits, key=lambda rule: len(rule.text), default=None)
        assert r.rule == (best.text if best else None) and r.verdict == (best.verdict if best else r.verdict)
        assert r.url.split("://", 1)[1].lower().startswith(r.host)


def test_op10_law(spark):
    docs = {r.doc_id: r.text for r in load(spark, SF10, "documents").collect()}
    got = Q.op10_shards(spark, SF10).collect()
    assert {r.doc_id for r in got} == set(docs) and {r.law for r in got} == {"bytes"} and {r.grown_shard for r in got} == {None}
    load_of, of_text = collections.Counter(), collections.defaultdict(set)
    for r in got:
        load_of[r.shard] += r.size
        of_text[docs[r.doc_id]].add(r.shard)
    group = collections.Counter(docs.values())
    largest = max(n * (len((t or "").encode()) + 1) for t, n in group.items())
    mean = sum(load_of.values()) / 16
    assert set(load_of) == set(range(16)) and all(len(s) == 1 for s in of_text.values())
    assert max(load_of.values()) <= mean + largest


def test_pipeline_stages_on_their_own_input(spark):
    docs = load(spark, SF, "documents")
    extra = [(9_000_001, "123 -- !!", None, "s", 9), (9_000_002, None, "en", "s", 0)]
    bench = load(spark, SF, "benchmark").first().text
    extra += [(9_000_003, "Before it. " + bench + " After.", "en", "s", 1), (9_000_004, docs.first().text + " tail", "en", "s", 1)]
    docs = docs.union(spark.createDataFrame(extra, docs.schema))
    columns = docs.columns
    kept = {}
    for name, step in corpus_pipeline.STAGES:
        before = {r.doc_id: r.text for r in docs.collect()}
        docs = stage(spark, step(spark, docs, SF), f"t-{name}")
        if name == "packed":
            break
        assert docs.columns == columns
        kept[name] = (before, {r.doc_id: r.text for r in docs.collect()})
        assert kept[name][1].items() <= before.items()
    before, after = kept["language"]
    assert set(before) - set(after) == {i for i, t in before.items() if not any(c.isalpha() for c in t or "")} >= {9_000_001, 9_000_002}
    before, after = kept["nontoxic"]
    toxic = {r.doc_id: r.toxic for r in load(spark, SF, "labels").collect() if r.toxic is not None}
    assert np.mean([(i not in after) == (toxic[i] == 1) for i in before if i in toxic]) > 0.9
    before, after = kept["near_dedup"]
    groups = components_of(before.items(), 5, 80)
    assert set(after) == {i for i, (_, g) in groups.items() if g == i}
    before, after = kept["decontaminated"]
    items = [(r.item_id, r.text) for r in load(spark, SF, "benchmark").collect()]
    assert set(before) - set(after) == {r[0] for r in hits(before.items(), items, 13) if r[-1]}
    packed = docs.groupBy("doc_id").agg(F.sum("length").alias("n")).collect()
    assert {r.doc_id: r.n for r in packed} == {i: len((t or "").encode()) + 1 for i, t in after.items()}


def test_pipeline_query_runs(spark):
    rows = __spark_entry__.queries()["pipeline"](spark, SF)
    assert rows.count() > 0 and "bin_id" in rows.columns
