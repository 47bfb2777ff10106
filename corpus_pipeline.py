"""The training-data pipeline: each stage calls one operator and is written before the next reads it."""

from sluice.llm import bpe, decontaminate, secrets, simhash, toxicity
from sluice.llm.registry import read
from sluice.session import materialize


def drop_toxic(spark, docs, sf_dir):
    """Documents that the toxicity classifier does not reject."""
    return toxicity.keep_clean(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark, docs, sf_dir):
    """One document of each SimHash group: the one with the smallest id."""
    return simhash.keep_one(docs)


def drop_contaminated(spark, docs, sf_dir):
    """Documents without any benchmark window."""
    return decontaminate.remove_documents(docs, read(spark, sf_dir, "benchmark"))


def redact_secrets(spark, docs, sf_dir):
    """All documents, with every secret replaced; n_chars follows the text."""
    return secrets.redact(docs, sizes_col="n_chars")


def encode_texts(spark, docs, sf_dir):
    """Token ids and their round trip: (doc_id, n_tokens, ids_sha256, decoded_sha256, token_ids)."""
    return bpe.digests(bpe.encode(docs, bpe.default_ranks(), with_bytes=True), "token_ids")


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("secret_scan", redact_secrets),
    ("byte_bpe", encode_texts),
]

#: Hashes, a fitted classifier and tokenizer merges are not SQL; tests/llm runs the stages beside plain Python.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages over ``documents``; the rows of the last."""
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
