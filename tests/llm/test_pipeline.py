"""The corpus pipeline against plain versions of its stages, and the registered queries."""

import duckdb
import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from assayline.llm import near_dedup, registry
from tests.llm.test_search_and_dedup import leaks


def test_pipeline_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    items = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text").collect()]
    kept, before = {}, docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, before, sf_dir)
        assert after.columns == docs.columns and after.dtypes == docs.dtypes
        kept[name] = {r.doc_id: r.text for r in after.collect()}
        before = spark.createDataFrame(after.collect(), docs.schema)
    whole = {r.doc_id: r.text for r in docs.collect()}
    good = kept["quality"]
    right = [(i in good) == bool(q) for i, q in labels.items()]
    assert np.mean(right) > 0.95
    one = kept["near_dedup"]
    bags = {i: near_dedup.bag_of(t, 5) for i, t in good.items()}
    for i in good.keys() - one.keys():
        assert any(near_dedup.probability_jaccard(bags[i], bags[j]) >= 0.8 for j in good if j != i)
    ids = sorted(one)
    for a in ids:
        for b in ids:
            if a < b:
                assert near_dedup.probability_jaccard(bags[a], bags[b]) < 0.8
    leaked = {w[0] for w in leaks(list(one.items()), items)}
    assert kept["decontamination"].keys() == one.keys() - leaked
    private = kept["pii"]
    assert private.keys() == kept["decontamination"].keys()
    assert not any("@mail" in t for t in private.values())
    assert sum(private[i] != whole[i] for i in private) < len(private) / 2
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    rows = corpus_pipeline.STAGES[-1][1](spark, before, sf_dir).collect()
    assert {r.doc_id for r in rows} == private.keys()
    for r in rows:
        assert r.ids == library.encode(private[r.doc_id], add_special_tokens=False).ids
        assert r.decoded == library.decode(r.ids, skip_special_tokens=False)


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_query_equals_its_sql(spark, sf_dir, name):
    con = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    cursor = con.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in cursor.description]
    got = registry.queries()[name](spark, sf_dir).select(*columns).collect()
    assert sorted(map(tuple, got)) == sorted(cursor.fetchall())
