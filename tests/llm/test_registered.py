"""The registered queries and the pipeline on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from meterlake.llm import decontaminate, exact_dedup, pieces, quality, simhash
from meterlake.llm.queries import ORACLE_SQL, QUERIES, tokenizer_file
from tests.llm.helpers import DOCS, ODD_TEXTS, SF, bag, docs, empty, read

TABLES = "documents embeddings pages benchmark labels".split()
COLUMNS = {
    1: "file offset primary_digest primary_length record_id replica_digest replica_length status",
    2: "component_id doc_id fingerprint",
    3: "doc_id ids_xxh64 n_tokens round_trip",
    4: "doc_id group_size keep_id kept text_sha256",
    5: "doc_id n_bytes n_tokens over_limit",
    6: "n_chars page_id text url",
    7: "confirmed doc_id family para_no paragraph probability similarity",
    8: "doc_id held_out predicted score",
    9: "containment doc_id item_id n_shared n_shingles",
    10: "host page_id path rule verdict",
    11: "count_sum doc_id groups_sha256 n_a n_b n_best n_groups n_links n_shared",
    12: "anchor_id negative_id negative_score positive_id positive_score rank",
    13: "component_id doc_id kept n_shingles",
}


def cell(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return None
    return round(v, 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    cursor = con.execute(ORACLE_SQL[name])
    names = [d[0] for d in cursor.description]
    want = [tuple(cell(dict(zip(names, r, strict=True))[c]) for c in sorted(names)) for r in cursor.fetchall()]
    got = QUERIES[name](spark, SF)
    assert sorted(got.columns) == sorted(names)
    assert bag(tuple(cell(r[c]) for c in sorted(names)) for r in got.collect()) == bag(want)


def test_every_operator_is_registered_once():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_schema_and_rows(spark, name):
    got = QUERIES[name](spark, SF)
    assert " ".join(sorted(got.columns)) == COLUMNS[int(name[2:].split("_")[0])]
    n = got.count()
    number = int(name[2:].split("_")[0])
    if number in (2, 3, 4, 5, 8, 11, 13):
        assert n == 200
    if number in (6, 10):
        assert n == 50


def test_stages_by_brute_force(spark, tmp_path):
    """Each stage against the rows that its operator's rule names."""
    df = read(spark, "documents")
    names = []
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        names.append(name)
        out = stage(spark, df, SF)
        out.write.parquet(f"{tmp_path}/{k}")
        after = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert after.columns == df.columns
        before, kept = df.collect(), {r.doc_id for r in after.collect()}
        assert len(kept) == after.count()
        if k == 0:
            model = quality.train(df, read(spark, "labels"))
            want = {r.doc_id for r in before if model.scores([(r.text or "").encode()])[0] >= 0.5}
        elif k == 1:
            want = {r.keep_id for r in exact_dedup.exact_groups(df).collect()}
        elif k == 2:
            prints = {r.doc_id: simhash.fingerprint((r.text or "").encode()) for r in before}
            groups = {r.doc_id: r.component_id for r in simhash.near_groups(df).collect()}
            want = set(groups.values())
            assert all(groups[a] == groups[b] for a in prints for b in prints if ((prints[a] ^ prints[b]) % 2**64).bit_count() <= 3)
        elif k == 3:
            found = decontaminate.contained_items(df, read(spark, "benchmark")).collect()
            want = {r.doc_id for r in before} - {r.doc_id for r in found}
        else:
            want = {r.doc_id for r in before}
            encoder = pieces.Encoder(pieces.load_model(tokenizer_file("piece_bpe_32k.model")))
            text = {r.doc_id: r.text for r in before}
            assert all(r.ids == encoder([text[r.doc_id]])[0].tolist() and r.n_tokens == len(r.ids) for r in after.collect())
        assert kept == want and kept
        df = after
    assert names == [n for n, _ in corpus_pipeline.STAGES] and 0 < df.count() < 200


def test_run_gives_the_last_stage(spark):
    got = entry.queries()["pipeline"](spark, SF)
    assert got.columns == ["doc_id", "lang", "source", "n_tokens", "ids"] and 0 < got.count() < 200


@pytest.mark.parametrize("rows", ["none", "odd"])
def test_stages_on_empty_and_odd_rows(spark, rows):
    df = empty(spark, DOCS) if rows == "none" else docs(spark, [*ODD_TEXTS, *ODD_TEXTS], [None, 1, 1, *range(2, 21)], extra=True)
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, df, SF)
        assert out.count() >= (rows == "odd"), name
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == df.columns
