import hashlib
import struct
from collections import Counter

import duckdb
import pytest
import tiktoken
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
import public_tokenizers
from sendgate.llm import bpe, mixing, toxicity
from sendgate.llm.queries import (
    ORACLES,
    held_out,
    public_vocabulary,
    source_mix,
    source_tree,
    text_tokens,
)
from sendgate.session import keep
from tests.llm.test_jaccard_join import brute as brute_components
from tests.llm.test_mixing import brute as brute_mix

SF_DIR = "/root/testdata/sf0.01"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The input of each stage, and the result."""
    tables = [spark.read.parquet(f"{SF_DIR}/documents.parquet")]
    for _, stage in pipeline.STAGES:
        tables.append(keep(stage(spark, tables[-1], SF_DIR), "stage"))
    return tables


def test_columns(stages):
    assert [name.split()[0] for name, _ in pipeline.STAGES] == [
        "toxicity", "line", "n-gram", "mixing", "byte-level"
    ]
    assert all(table.columns == COLUMNS for table in stages[:-1])


def test_toxicity(spark, stages):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = toxicity.fit(stages[0], labels.where(~held_out(F.col("doc_id"))))
    before = stages[0].collect()
    scores = model.score([r.text for r in before])
    clean = [r for r, score in zip(before, scores, strict=True) if score < 0.5]
    assert sorted(clean) == sorted(stages[1].collect()) and 0 < len(clean) < len(before)


def test_line_dedup(stages):
    connection = duckdb.connect()
    connection.register("documents", stages[1].toPandas())
    expected = connection.execute(ORACLES["op6_line_dedup"]).df()
    got = stages[2].collect()
    digests = dict(zip(expected.doc_id, expected.text_md5, strict=True))
    assert {r.doc_id: hashlib.md5(r.text.encode()).hexdigest() for r in got} == digests
    assert all(r.n_chars == len(r.text) for r in got) and expected.n_dropped.sum() > 0


def test_near_copies(stages):
    before = [(r.doc_id, r.text) for r in stages[2].collect()]
    component = {i: c for i, _, c in brute_components(before)}
    kept = [r.doc_id for r in stages[3].collect()]
    assert sorted(component[i] for i in kept) == sorted(set(component.values()))
    assert len(kept) < len(before)


def test_mixing(stages):
    mix = source_mix(pipeline.MIX_SHARE, epochs=1)
    drawn = stages[3].withColumn("content", F.xxhash64(*COLUMNS)).select(
        F.array(*source_tree()).alias("path"),
        text_tokens().alias("n"),
        "doc_id",
        F.array(mixing._draw(mix.seed, F.lit(0), ["content"])).alias("draws"),
    )
    rows = [(tuple(r.path), r.n, r.doc_id, r.draws) for r in drawn.collect()]
    expected = {number for number, _ in brute_mix(rows, mix)}
    got = Counter(r.doc_id for r in stages[4].collect())
    assert set(got) == expected and max(got.values()) == 1 and len(got) < len(rows)


def test_tokens(stages):
    ranks = bpe.parse_ranks(public_vocabulary().ranks)
    library = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
    )
    texts = {r.doc_id: r.text for r in stages[4].collect()}
    rows = stages[5].collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert r.ids == ids and r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(struct.pack(f"<{len(ids)}I", *ids)).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()


def test_run(spark, stages):
    got = pipeline.run(spark, SF_DIR)
    assert got.columns == stages[-1].columns
    assert sorted(got.collect()) == sorted(stages[-1].collect())


def test_every_stage_on_odd_rows(spark, tmp_path):
    """Nulls in any column, empty and repeated rows, no labels; then an empty table."""
    rows = [(None, None, None, None, None), (1, "", "en", "src1", 0), (1, "", "en", "src1", 0)]
    rows += [(2, "one two", None, "other", None), (2, "one two", "de", None, 7)]
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(
        f"{tmp_path}/labels.parquet"
    )
    for table in (rows, []):
        docs = keep(spark.createDataFrame(table, schema), "docs")
        for _, stage in pipeline.STAGES:
            docs = keep(stage(spark, docs, str(tmp_path)), "stage")
        assert docs.count() <= len(table)
