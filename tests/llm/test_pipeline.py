"""The stages one after the other, and the guard in the entry module."""

import subprocess
import sys
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
import tiktoken

import __spark_entry__ as entry
import corpus_pipeline
from helioledger.llm import bpe, registry
from tests.llm.data import frame


def test_stages(spark, tmp_path):
    frame(spark).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    seen = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, str(tmp_path))
        assert out.columns == docs.columns
        out.write.parquet(path := str(tmp_path / f"stage{len(seen)}"))
        docs = spark.read.parquet(path)
        seen.append(Counter(r.doc_id for r in docs.collect()))
    quality, single, masked, mixed = seen
    assert {4, 5, 7, 11, 12, 16, 17}.isdisjoint(quality) and {1, 2, 9, 13, 100} <= set(quality)
    assert single[1] == 1 and not {2, 3, None} & set(single) and set(range(100, 140)) <= set(single)
    assert masked == single and set(mixed) == set(single) and max(mixed.values()) <= 2 < sum(mixed.values())
    path, pattern = bpe.public_vocabulary()
    library = tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=bpe.ranks_of(bpe.vocabulary(path)), special_tokens={})
    want = Counter((r.doc_id, len(library.encode_ordinary(r.text))) for r in docs.collect())
    result = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert Counter((r.doc_id, r.n_tokens) for r in result) == want
    assert np.mean([len(r.ids_sha256) for r in result]) == 64


def test_empty_pipeline(spark, tmp_path):
    frame(spark, []).write.parquet(str(tmp_path / "documents.parquet"))
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_registered():
    names = registry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert {*names, "pipeline"} <= set(entry.queries()) and set(registry.oracle_sql()) <= set(names)


def test_entry_works_without_these_operators(tmp_path):
    root = Path(entry.__file__).resolve().parent
    for name in ("helioledger", "energy_fixtures", "__spark_entry__.py"):
        (tmp_path / name).symlink_to(root / name)
    code = "import sys; sys.modules['helioledger.llm'] = None; import __spark_entry__ as e; print(sorted(n for n in e.queries() if n[:2] == 'op' and n[2].isdigit()), len(e.queries()))"
    done = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, check=True)
    assert done.stdout.startswith("[] ")


@pytest.mark.parametrize("name", sorted(registry.oracle_sql()))
def test_against_sql(spark, small, name):
    connection = duckdb.connect()
    for table in ("documents", "embeddings"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{small}/{table}.parquet'")
    answer = connection.execute(registry.oracle_sql()[name])
    columns = [c[0] for c in answer.description]
    got = registry.queries()[name](spark, small).select(columns).collect()
    assert sorted(map(repr, map(tuple, got))) == sorted(map(repr, answer.fetchall()))
