import base64

import numpy as np
import public_tokenizers
import tiktoken
from test_llm_leaks import brute as leaks
from test_llm_near import brute as near

import __spark_entry__ as entry
import corpus_pipeline
from barflow.llm.language_id import Classifier, ngrams, ranked
from barflow.llm.queries import RANKS
from barflow.session import BATCH_SETTING

SF = "/root/testdata/sf0.001"


def test_the_pipeline_is_its_stages_by_brute_force(spark):
    rows = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    import zlib
    training = [r for r in rows.values() if zlib.crc32(str(r.doc_id).encode()) % 5 and r.lang]
    profiles = {lang: ranked(np.concatenate([ngrams(r.text) for r in training if r.lang == lang]), 400).tolist()
                for lang in {r.lang for r in training}}
    classifier = Classifier(profiles)
    kept = {d: r.text for d, r in rows.items() if classifier.predict(r.text)[1] > 0}
    kept = {d: t for d, t in kept.items() if d == max(x for x, y in kept.items() if y == t)}
    linked = {d: c for d, _, c in near(list(kept.items()))}
    kept = {d: t for d, t in kept.items() if linked[d] == d}
    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    found = {d for d, _ in leaks(list(kept.items()), items)}
    assert 0 < len(found) < len(kept)
    with open(public_tokenizers.path(RANKS), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    library = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    want = {d: (t, library.encode_ordinary(t)) for d, t in kept.items() if d not in found}
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    assert set(out) == set(want)
    for d, (text, ids) in want.items():
        assert out[d].text == text and np.frombuffer(out[d].ids, "<u4").tolist() == ids and out[d].n_tokens == len(ids)


def test_stages_keep_columns_and_bear_odd_tables(spark, docs):
    rows = [(1, None), (2, ""), (None, "some words"), (3, "some words"), (3, "some words"), (4, "77 !"), (5, "other words " * 20)]
    for table in (docs(rows), docs([])):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, table, SF)
            assert out.columns == table.columns or name == "encode"
            table = out
        assert sorted(r.doc_id for r in table.collect() if r.doc_id is not None) in ([3, 5], [])


def test_python_gets_no_batch_far_beyond_a_block(spark, docs):
    import pyarrow as pa

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes]), pa.array([batch.num_rows])], names=["n_bytes", "n_rows"])

    before = spark.conf.get(BATCH_SETTING)
    base = spark.range(0, 300, 1, 1).selectExpr("id AS doc_id", "concat(id, repeat(' letters of words', 4000)) AS text", "'en' AS lang")
    try:
        for name, stage in corpus_pipeline.STAGES:
            if name == "exact_dedup":  # nothing goes to Python
                continue
            spark.conf.set(BATCH_SETTING, "64m")
            stage(spark, docs([(1, "some words")]), SF)
            seen = base.mapInArrow(sizes, "n_bytes bigint, n_rows bigint").collect()
            assert sum(r.n_rows for r in seen) == 300
            assert max(r.n_bytes for r in seen) < corpus_pipeline.BATCH_BYTES + 100_000, name
        spark.conf.set(BATCH_SETTING, "1m")
        corpus_pipeline.in_small_batches(spark)
        assert spark.conf.get(BATCH_SETTING) == "1m"
    finally:
        spark.conf.set(BATCH_SETTING, before)


def test_queries_are_registered():
    names = [n for n in entry.queries() if n.startswith("op") and n[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14)) and "pipeline" in entry.queries()


def test_oracles(spark):
    import check
    import duckdb

    connection = duckdb.connect()
    for t in check.TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    for name in [n for n in entry.oracle_sql() if n.startswith("op") and n[2].isdigit()]:
        line = check.compare(spark, SF, name, connection)
        assert line.startswith("ok"), line
