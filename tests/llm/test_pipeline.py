import sys
from pathlib import Path

from edge import SF, clashing, none

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

import corpus_pipeline as C  # noqa: E402
from stray.llm.common import materialise  # noqa: E402


def test_run_and_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    for name, stage in C.STAGES[:-1]:
        columns = docs.columns
        docs = materialise(stage(spark, docs, SF), name)
        assert docs.columns == columns
        counts.append(docs.count())
    assert counts[0] > counts[1] > counts[2] > counts[3] == counts[4] > 0
    assert docs.where("text rlike '[0-9a-z]@[a-z]'").count() == 0
    packed = C.STAGES[-1][1](spark, docs, SF)
    assert packed.select("doc_id").distinct().count() == counts[4]


def test_stages_on_edge_and_empty_tables(spark):
    for table in (none(spark), clashing(spark)):
        for name, stage in C.STAGES:
            out = stage(spark, table, SF)
            assert out.count() <= max(table.count() * 200, 0)
            if name != "packing":
                assert out.columns == table.columns
