"""The registry, and a sample of its queries against DuckDB on the smallest tables."""

import pytest

import __spark_entry__ as entry
from compare import compare, database

FOLDER = "/root/testdata/sf0.001"

# one or two quick queries of each part; tests/compare.py runs all of them
SAMPLE = [
    "s01_csv_null_tokens", "s02_load_folder", "s07_extract_by_rule", "s11_append_new", "p10_not_equal_keep_null", "p16_indicators",
    "j01_left_lookup", "j09_lookup_or_self", "j11_listed_pairs", "a08_keyword_share", "a12_describe_numbers", "a17_confusion",
    "w03_runs", "w07_fill_back", "w10_rank_scale", "f13_whole_years", "f26_tagged_triples", "f27_text_chunks", "d06_first_holiday",
    "d08_base_table", "d10_sales_base", "m02_stratified_split", "m09_quantile_scaler", "m19_nearest", "m27_auc", "m35_sampled_shapley",
    "t02_speaker_runs", "t07_window_table", "t10_geo_tags", "t13_pattern_relations", "g01_canonical_edges", "g09_levels",
    "b02_replay_commit", "b04_ucb_scores", "i01_ingest_stream", "i02_fan_out", "x01_batch_scorer",
]


@pytest.fixture(scope="module")
def con():
    return database(FOLDER)


def test_registry():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(SAMPLE) <= set(entry.queries())
    rows = {name.split("_")[0] for name in entry.queries()}
    parts = {
        "p": 23, "a": 23, "w": 10, "f": 28, "d": 10, "m": 39, "t": 14, "g": 10, "b": 6, "i": 2, "o": 3, "u": 3,
    }
    missing = [f"{k}{i:02d}" for k, n in parts.items() for i in range(1, n + 1) if f"{k}{i:02d}" not in rows]
    assert missing == []


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", SAMPLE)
def test_query(spark, con, name):
    ok, note = compare(spark, con, FOLDER, name, entry.queries()[name], entry.oracle_sql()[name])
    assert ok, note


@pytest.mark.parametrize("name", ["a12_describe_numbers", "w06_running_mean", "d06_first_holiday", "t13_pattern_relations"])
@pytest.mark.parametrize("parts", ["1", "7"])
def test_number_of_partitions_does_not_matter(spark, con, name, parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        ok, note = compare(spark, con, FOLDER, name, entry.queries()[name], entry.oracle_sql()[name])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert ok, note
