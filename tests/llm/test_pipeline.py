"""The registered queries and the pipeline."""

from collections import Counter, defaultdict

import corpus_pipeline
from fixtures import documents, frame

import __spark_entry__ as contract
from clickloom.llm.common import table
from clickloom.llm.packing import CAPACITY, pack
from clickloom.llm.queries import QUERIES, SQL

NAMES = {"op1", "op2", "op3", "op4", "op5", "op6", "op7", "op8", "op9", "op10", "op11", "op12", "op13", "pipeline"}


def test_everything_is_registered():
    assert {n.split("_")[0] for n in QUERIES} == NAMES and len(QUERIES) == len(NAMES)
    assert set(QUERIES) <= set(contract.queries()) and set(SQL) <= set(contract.oracle_sql()) and corpus_pipeline.ORACLE_SQL is None


def test_stages_one_by_one(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    columns, seen = docs.columns, []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, sf_dir)
        rows = out.collect()
        seen.append(rows)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == columns
            docs = spark.createDataFrame(rows, docs.schema)
    ids = [{r.doc_id for r in rows} for rows in seen]
    assert all(later <= earlier for earlier, later in zip(ids, ids[1:])) and len(ids[1]) < len(ids[0])
    bodies = [r.text.encode() for r in seen[2]]
    windows = Counter(b[p:p + 400] for b in bodies for p in range(0, len(b) - 399))
    assert all(n == 1 for n in windows.values()) or max(windows.values()) == 1
    mixed = Counter(r.doc_id for r in seen[3])
    pieces = defaultdict(int)
    for r in seen[4]:
        pieces[r.doc_id] += r.piece == 0
    assert pieces == mixed and max(mixed.values()) <= 3
    full = sum(r.length for r in seen[4])
    assert len({r.sequence_id for r in seen[4]}) <= 1.02 * full / CAPACITY + 1


def test_run_equals_its_stages(spark, tmp_path):
    folder = str(tmp_path / "sf")
    frame(spark, documents()).select("doc_id", "text", "lang", "source", "n_chars").write.parquet(f"{folder}/documents.parquet")
    docs = table(spark, folder, "documents")
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        docs = spark.createDataFrame(out.collect(), out.schema)
    by_doc = Counter((r.doc_id, r.piece, r.ids_crc32) for r in docs.collect())
    assert by_doc == Counter((r.doc_id, r.piece, r.ids_crc32) for r in corpus_pipeline.run(spark, folder).collect()) and by_doc


def test_stages_take_awkward_tables(spark):
    for rows in (documents(), []):
        docs = frame(spark, rows)
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, "")
            assert out.columns == docs.columns
            out.count()
        pack(docs).count()
