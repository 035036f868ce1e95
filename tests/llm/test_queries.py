"""The registered corpus queries: columns of their contracts, rows of their tables, and SQL where it can say them."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as contract
from starledger.bindings.compare import compare, oracle_connection
from starledger.llm import bloom
from starledger.llm.queries import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
COLUMNS = {
    "op1_pii": "doc_id n_email n_ip n_card n_phone base_sha256 spans",
    "op2_bigru_language": "doc_id held_out lang_pred score",
    "op3_epsilon_grid_join": "vec_id n_links component_id kept",
    "op4_host_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op5_virtual_slot_sharding": "doc_id size text_crc32 law shard slot grown_shard",
    "op6_mix_min_cost_flow": "doc_id size source_size target taken",
    "op7_superminhash_near_dedup": "doc_id n_shingles component_id kept",
    "op8_toxicity_trees": "doc_id held_out score predicted",
    "op9_best_fit_packing": "doc_id piece start length ids_crc32 sequence_id offset",
    "op10_markov_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op11_bloom_spelling_groups": "word form root n n_near form_n",
    "op12_pointer_jumping_manifest": "doc_id leaf subroot root proof_sha256 folded_root verified",
    "op13_prefix_token_counts": "doc_id n_bytes n_tokens over_limit",
}


def test_the_entry_registers_the_queries_and_the_pipeline():
    names = set(contract.queries())
    assert set(COLUMNS) == set(QUERIES) and set(QUERIES) | {"pipeline"} <= names
    assert set(contract.oracle_sql()) <= names


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, name):
    found = QUERIES[name](spark, SF_DIR)
    assert set(COLUMNS[name].split()) <= set(found.columns)
    oracle = oracle_connection(SF_DIR) if name in ORACLES else None
    if oracle:
        assert compare(found, oracle, ORACLES[name]) is None
    else:
        table = spark.read.parquet(f"{SF_DIR}/documents.parquet")
        assert found.select("doc_id").distinct().count() == table.count()


def test_bloom_filter_holds_back_no_wanted_row(spark):
    df = spark.range(20_000).select("id", F.xxhash64("id").alias("key"))
    wanted = df.where("id % 7 = 0")
    kept = bloom.thinned(df, F.col("key"), bloom.key_filter(wanted, F.col("key")))
    ids = np.array(sorted(r.id for r in kept.collect()))
    assert set(range(0, 20_000, 7)) <= set(ids) and len(ids) < 3_000
    nothing = bloom.key_filter(df.where("id < 0"), F.col("key"))
    assert bloom.thinned(df, F.col("key"), nothing).count() == 0
