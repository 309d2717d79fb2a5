"""A corpus through quality rules, near-dedup, decontamination, PII and byte-level BPE.

Every stage works on all that the one before it has kept and gives back the columns of `documents` (the last adds its
digests). Stages are written as Parquet to the folder that the cluster shares and read again.
"""

from __future__ import annotations

from panelscope.llm import bpe, decontam, pii, quality, simhash
from panelscope.llm.common import Scratch


def quality_rules(spark, docs, sf_dir):
    """Rejected documents go; common lines go from those that stay."""
    return quality.filter_documents(docs)


def near_dedup(spark, docs, sf_dir):
    """Of each group of near copies the smallest doc_id stays."""
    return simhash.keep_one(docs)


def decontamination(spark, docs, sf_dir):
    """Documents that hold a passage of the benchmark go."""
    return decontam.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark, docs, sf_dir):
    """Entities are generalised to their kinds, disclosing terms removed; all documents stay."""
    return pii.sanitise(docs)


def encoding(spark, docs, sf_dir):
    """Token ids in place of the text, and digests of the ids and of what they decode to."""
    import public_tokenizers

    return bpe.encode_documents(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, with_text=False)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("personal_data", personal_data),
    ("encoding", encoding),
]

#: Fingerprints, merges and hashes are not expressible in SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    scratch = Scratch(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        docs = scratch.write(stage(spark, docs, sf_dir), f"{i}-{name}")
    return docs
