"""The training-data pipeline: documents in, token ids out.

Each stage takes ``(spark, docs, sf_dir)``. All but the last return the columns
of ``documents``; ``run`` writes each result to the shared folder and hands the
table read back to the next stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from amity.llm.bpe import stage_bpe
from amity.llm.lines import stage_lines
from amity.llm.mixing import stage_mixing
from amity.llm.quality import stage_quality
from amity.llm.simhash import stage_simhash
from amity.llm.tables import read_table, written

STAGES = [
    ("quality", stage_quality),       # rejected documents go
    ("line_dedup", stage_lines),      # lines an earlier line stands for go
    ("near_dedup", stage_simhash),    # one document of each group stays
    ("mixing", stage_mixing),         # documents repeat towards their source's weight
    ("encoding", stage_bpe),          # token ids, checked by decoding
]
ORACLE_SQL = None  # SimHash, the edit join and BPE are not SQL; tests/llm compares with brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The last stage's rows."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
