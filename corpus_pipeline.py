"""The corpus pipeline: five stages over the documents table.

Each stage works on all that its predecessor kept and returns whole rows; ``run``
writes every stage's result as Parquet in the shared checkpoint folder and reads
it again, so a lost executor costs one stage at most.  A stage's table goes when the
next one's is written.

1. quality classifier: documents that it rejects go;
2. n-gram Jaccard join: one document of each group stays;
3. benchmark decontamination: documents with a benchmark window go;
4. mixing: rows are repeated or left out, so that sources meet their weights;
5. sharding: every row gets its virtual slot and shard.

A classifier stands at the start, so no SQL expresses the run; it is tested
against a brute-force version of the stages.
"""

from __future__ import annotations

from reelpulse.llm import decontaminate, jaccard_join, mix, pu_quality, shards
from reelpulse.llm.common import drop_stored, stored, table

SHARDS = 8


def quality(spark, docs, sf_dir):
    """Documents whose quality score is at least one half."""
    return pu_quality.good_documents(docs, table(spark, sf_dir, "labels"))


def near_duplicates(spark, docs, sf_dir):
    """One document per group of linked documents, the one with the least id."""
    return jaccard_join.one_per_group(docs)


def decontamination(spark, docs, sf_dir):
    """Documents without any window of a benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark, docs, sf_dir):
    """Rows as often as the mix takes them."""
    return mix.mixed_rows(docs)


def sharding(spark, docs, sf_dir):
    """All rows with virtual_slot and shard, shards of near-equal bytes."""
    return shards.sharded_rows(docs, SHARDS)


STAGES = [
    ("quality classifier", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("source mixing", mixing),
    ("sharding", sharding),
]

ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    before = []
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage_" + name.replace(" ", "_"))
        drop_stored(*before)  # a stage reads no table but its predecessor's
        before = [docs]
    return docs
