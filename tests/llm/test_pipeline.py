"""Each stage of the pipeline against brute force on its own input."""

import hashlib
import zlib

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from cohortlift.llm import decontam, line_dedup, ngram_join
from cohortlift.llm.common import written
from test_packing import reference_ids

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        docs = written(stage(spark, docs, SF), "test-stage")
        out.append(docs)
    return [df.toPandas() for df in out], [df.columns for df in out]


def test_columns_and_clean_documents(stages, spark):
    frames, columns = stages
    assert all(c == columns[0] for c in columns[1:5])
    labels = spark.read.parquet(f"{SF}/labels.parquet").toPandas()
    good = set(labels[labels.quality == 1].doc_id)
    assert good <= set(frames[1].doc_id)
    assert not set(labels[labels.quality == 0].doc_id) & set(frames[1].doc_id)


def duck(sql, **tables):
    con = duckdb.connect()
    for name, frame in tables.items():
        con.register(name, frame)
    return con.execute(sql).df()


def test_lines(stages):
    before, after = stages[0][1], stages[0][2].sort_values("doc_id")
    want = duck(line_dedup.dedup_sql(), documents=before).sort_values("doc_id")
    assert [hashlib.sha256(t.encode()).hexdigest() for t in after.text] == want.text_sha256.tolist()
    assert after.n_chars.tolist() == after.text.str.len().tolist()


def test_one_of_each_group(stages):
    before, after = stages[0][2], stages[0][3]
    want = duck(ngram_join.join_sql(), documents=before)
    assert set(after.doc_id) == set(want[want.kept].doc_id) and after.doc_id.is_unique


def test_contaminated_go(stages, spark):
    before, after = stages[0][3], stages[0][4]
    items = spark.read.parquet(f"{SF}/benchmark.parquet").toPandas()
    bad = set(duck(decontam.overlaps_sql(), documents=before, benchmark=items).doc_id)
    assert set(after.doc_id) == set(before.doc_id) - bad and bad


def test_all_is_packed(stages):
    docs, packed = stages[0][4], stages[0][5]
    assert len(packed) >= len(docs)
    for d, t in list(zip(docs.doc_id, docs.text))[:40]:
        ids = reference_ids(t)
        own = packed[packed.doc_id == d].sort_values("piece")
        assert own.length.sum() == len(ids)
        for r in own.itertuples():
            assert r.ids_crc32 == zlib.crc32(np.array(ids[r.start : r.start + r.length], "<u4").tobytes())


def test_run_is_the_stages(stages, spark):
    got = corpus_pipeline.run(spark, SF).toPandas()
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got[key].values.tolist())) == sorted(map(tuple, stages[0][5][key].values.tolist()))


def through(spark, docs):
    """What every stage makes of ``docs``."""
    out = [docs]
    for _, stage in corpus_pipeline.STAGES:
        out.append(written(stage(spark, out[-1], SF), "cases"))
    return out


def test_empty_table_through_all_stages(spark, docs_of):
    out = through(spark, docs_of([]))
    assert [df.count() for df in out] == [0] * 6
    assert all(df.columns == out[0].columns for df in out[:5])


def test_null_ids_repeated_rows_and_clashing_columns_through_all_stages(spark, docs_of):
    good = [" ".join(f"word{k}{n}" for n in range(60)) + "." for k in range(6)]
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first()["text"]
    texts = [good[0], good[1], good[1], good[2], good[3] + "\n" + item, None, good[4], good[4]]
    docs = docs_of(texts, ids=[1, None, None, 2, None, 3, 9, 9])
    names = ("host", "path", "evidence", "probability", "id", "h", "key", "label", "rep", "class", "chars", "first", "rest", "depth", "level", "th", "doc", "lines", "kept", "stay", "b", "a")
    for name in names:
        docs = docs.withColumn(name, docs["source"])
    docs = docs.drop("n_chars")
    out = through(spark, docs)
    assert all(df.columns == docs.columns for df in out[:5])
    left = sorted((str(r["doc_id"]), r["text"] or "") for r in out[4].collect())
    # rows without id take part in no comparison but that with the benchmark; a repeated row of one id goes
    assert left == sorted([("1", good[0]), ("None", good[1]), ("None", good[1]), ("2", good[2]), ("3", ""), ("9", good[4])])
    assert out[5].count() == 6
