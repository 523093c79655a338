"""The pipeline's stages against brute force, and the registered queries against their SQL."""

import subprocess
import sys
import tempfile
from collections import Counter
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from meterfold.llm import packing, tokens, toxicity
from meterfold.llm.catalog import LLM_ORACLES, LLM_QUERIES

sys.path.insert(0, str(Path(__file__).resolve().parent.parent.parent / "tools"))

from check_oracles import rows_of  # noqa: E402
from test_llm_similarity import shingles, smallest_reached  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="test data not present")


@pytest.fixture(scope="module")
def tables():
    con = duckdb.connect()
    for file in Path(SF_DIR).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


@pytest.mark.parametrize("name", sorted(LLM_ORACLES))
def test_query_equals_its_sql(spark, tables, name):
    df = LLM_QUERIES[name](spark, SF_DIR)
    result = tables.execute(LLM_ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(df.columns) == sorted(columns)
    assert rows_of(df.columns, df.collect()) == rows_of(columns, result.fetchall())


def test_all_are_registered():
    registered = entry.queries()
    assert {"pipeline", *(n for n in LLM_QUERIES)} <= set(registered)
    assert sorted(int(n[2:].split("_")[0]) for n in LLM_QUERIES if n != "pipeline") == list(range(1, 14))


def test_stages_and_whole_run(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    model = toxicity.fit(docs, labels)
    frames = [docs]
    for name, stage in corpus_pipeline.STAGES:
        frames.append(stage(spark, frames[-1], SF_DIR).cache())
        if name != "best_fit_packing":
            assert frames[-1].columns == docs.columns
    rows = [f.collect() for f in frames]
    start, clean, distinct, apart, packed = rows
    odds = list(model.log_odds([r["text"] for r in start]))
    assert Counter(clean) == Counter(r for r, o in zip(start, odds) if 1 / (1 + 2.718281828459045**-o) < 0.7)
    best = {}
    for r in clean:
        best[r["text"].encode().lower()] = max(r["doc_id"], best.get(r["text"].encode().lower(), -1))
    assert sorted(r["doc_id"] for r in distinct) == sorted(best.values())
    sets = [(r["doc_id"], shingles(r["text"])) for r in distinct]
    links = [(a, b) for n, (a, x) in enumerate(sets) for b, y in sets[:n] if x and 100 * len(x & y) >= 80 * len(x | y)]
    reach = smallest_reached(links, {i for i, _ in sets})
    assert sorted(r["doc_id"] for r in apart) == sorted(i for i, c in reach.items() if i == c)
    lengths = [len(x) // 4 for x in tokens.encoded([r["text"] for r in apart])]
    pieces = [p for n in lengths for p in packing.piece_bounds(n, packing.SEQUENCE)]
    assert len(packed) == len(pieces) and {r["doc_id"] for r in packed} == {r["doc_id"] for r in apart}
    assert sum(r["length"] for r in packed) == sum(lengths)
    whole = corpus_pipeline.run(spark, SF_DIR).collect()
    assert Counter(whole) == Counter(packed)


def written(spark, docs, labels):
    folder = tempfile.mkdtemp(prefix="meterfold-test-")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder


def test_pipeline_without_rows(spark, docs):
    folder = written(spark, docs([]), [])
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_pipeline_with_absent_values_ties_repeats_and_clashing_columns(spark, docs, corpus):
    """Rows without id stay, one of each repeated row and of each text goes on, all columns are kept."""
    df = docs(corpus)
    folder = written(spark, df, [(None, 1, 1), (0, None, None), (0, 1, 0)])
    frame = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        frame = stage(spark, frame, folder)
        assert frame.columns == df.columns, name
    rows = frame.collect()
    texts = Counter((r["text"] or "").encode().lower() for r in rows)
    assert max(texts.values()) == 1
    assert {r["doc_id"] for r in rows} >= {50, 43} and all(r["part"] == 1 for r in rows)
    packed = corpus_pipeline.run(spark, folder).collect()
    plain = {r["doc_id"] for r in rows}
    assert {r["doc_id"] for r in packed} == plain
    assert sum(r["length"] for r in packed) == sum(len(x) // 4 for x in tokens.encoded([r["text"] for r in rows]))


def test_core_queries_do_not_need_the_text_packages():
    """A package that only the text operators need may be absent."""
    script = """
import sys
sys.modules["tokenizers"] = sys.modules["xxhash"] = None
import __spark_entry__ as entry
assert entry.queries() and not any(n.startswith("op") for n in entry.queries())
print("imported")
"""
    root = str(Path(__file__).resolve().parent.parent.parent)
    ran = subprocess.run([sys.executable, "-c", script], cwd=root, capture_output=True, text=True, timeout=120)
    assert "imported" in ran.stdout, ran.stderr[-2000:]
