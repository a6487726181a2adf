"""Near-duplicate vectors against all pairs, the pipeline, and what is registered."""

import re

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__ as contract
import corpus_pipeline
from tallycast.llm import vector_dedup


def all_pairs(ids, vectors, threshold=0.98):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    link = unit @ unit.T >= threshold
    np.fill_diagonal(link, False)
    root = list(range(len(ids)))
    changed = True
    while changed:
        changed = False
        for i, j in zip(*np.nonzero(link)):
            low = min(root[i], root[j])
            if root[i] != low or root[j] != low:
                root[i] = root[j] = low
                changed = True
    return {ids[i]: (int(link[i].sum()), min(ids[k] for k in range(len(ids)) if root[k] == root[i])) for i in range(len(ids))}


@pytest.mark.parametrize("block", [16, 512])
def test_vectors_against_all_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(vector_dedup, "BLOCK", block)
    rng = np.random.default_rng(2)
    center = rng.standard_normal(24)
    vectors = np.concatenate([center + 0.1 * rng.standard_normal((150, 24)), rng.standard_normal((60, 24))])
    vectors = np.concatenate([vectors, vectors[:7], vectors[:7], 3 * vectors[200:205]]).astype(np.float32)
    ids = [int(i) for i in rng.permutation(len(vectors))]
    rows = [(i, v.tolist(), 1, "clash") for i, v in zip(ids, vectors)]
    found = vector_dedup.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, kept string")).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in found} == all_pairs(ids, vectors.astype(float))
    assert all(r["kept"] == (r["vec_id"] == r["component_id"]) for r in found)


def test_vector_edges(spark):
    same = [1.0, 2.0]
    rows = [(1, same, 1), (2, same, 1), (2, same, 1), (3, [2.0, 4.0], 1), (4, same, 2), (5, same, None), (6, None, 1), (7, [0.0, 0.0], 1),
            (8, [float("nan"), 1.0], 1), (9, [None, 1.0], 1), (10, [], 1), (None, same, 1), (11, [1.0, 2.0, 0.0], 1), (12, [float("inf"), 1.0], 1)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = sorted((r["vec_id"] or 0, r["n_links"], r["component_id"]) for r in vector_dedup.near_vectors(frame).collect())
    alone = [(i, 0, i) for i in (4, 5, 6, 7, 8, 9, 10, 11, 12)]
    assert found == [(0, 0, None), (1, 3, 1), (2, 3, 1), (2, 3, 1), (3, 3, 1), *alone]
    assert vector_dedup.near_vectors(frame.limit(0)).count() == 0


def test_estimates_are_unbiased_and_bounded():
    rng = np.random.default_rng(5)
    unit = rng.standard_normal((400, 64))
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    _, code, factor = vector_dedup.encode(unit)
    found, bound = vector_dedup.estimates(code, factor, unit)
    error = found - unit @ unit.T
    assert abs(error[~np.eye(400, dtype=bool)].mean()) < 2e-3
    assert (np.abs(error) <= bound[:, None]).all()
    turned = vector_dedup.rotations(64, 2)
    assert np.allclose(turned @ turned.transpose(0, 2, 1), np.eye(64))


def test_vector_query(spark, sf_dir):
    found = vector_dedup.op5_vector_dedup(spark, sf_dir).toPandas()
    table = spark.read.parquet(f"{sf_dir}/embeddings.parquet").toPandas()
    for _, part in table.groupby("label"):
        expected = all_pairs(part.vec_id.tolist(), np.stack(part.embedding).astype(float))
        mine = found[found.vec_id.isin(part.vec_id)]
        assert {r.vec_id: (r.n_links, r.component_id) for r in mine.itertuples()} == expected


# ---------------------------------------------------------------- pipeline


def test_pipeline_stages_keep_their_contract(spark, sf_dir, tmp_path):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    counts = [docs.count()]
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, sf_dir)
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.dtypes == docs.dtypes, name
        out.write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        counts.append(docs.count())
    assert counts[0] > counts[1] >= counts[2] == counts[3] and counts[4] == counts[5]
    assert docs.filter("not round_trip").count() == 0


def test_pipeline_of_nothing(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).count() == 0


def test_registered_queries():
    names = set(contract.queries())
    assert {int(re.match(r"op(\d+)_", n)[1]) for n in names if re.match(r"op\d+_", n)} == set(range(1, 11))
    assert "pipeline" in names and set(contract.oracle_sql()) <= names


@pytest.mark.parametrize("name", sorted(n for n in contract.oracle_sql() if n == "pipeline" or re.match(r"op\d+_", n)))
def test_query_against_its_sql(spark, sf_dir, name):
    duck = duckdb.connect()
    for table in ("documents", "embeddings", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    ours, theirs = contract.queries()[name](spark, sf_dir).toPandas(), duck.execute(contract.oracle_sql()[name]).df()

    def rows(frame):
        frame = frame[sorted(frame.columns)]
        return sorted((tuple(None if pd.isna(v) else v for v in r) for r in frame.itertuples(index=False, name=None)), key=repr)

    assert sorted(ours.columns) == sorted(theirs.columns) and len(ours) > 0
    assert rows(ours) == rows(theirs)


def test_very_large_and_very_small_vectors_link(spark):
    rows = [(i, [x * scale for x in (1.0, 2.0, -3.0)], 1) for i, scale in enumerate((1e200, 3e200, 1e-200, 2e-200, 1.0))]
    rows += [(9, [1.0, -2.0, 3.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in vector_dedup.near_vectors(df).collect()}
    assert found == {**{i: (4, 0) for i in range(5)}, 9: (0, 9)}
