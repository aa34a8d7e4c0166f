"""The corpus pipeline: raw documents to packed training sequences, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; run() writes it as Parquet in the folder that the cluster
shares and reads it again as the next stage's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers

from gridfold.llm import mixing, packing, secrets, simhash, toxicity
from gridfold.llm.common import table, written

VOCABULARY = "word_bpe_49k.json"


def drop_toxic(spark, docs, sf_dir):
    """Documents whose calibrated toxicity is 0.5 or more go; the classifier learns from the labelled ones among docs."""
    return toxicity.keep_clean(docs, toxicity.fit(docs, table(spark, sf_dir, "labels")))


def drop_near_copies(spark, docs, sf_dir):
    """One document of each group of SimHash near-duplicates stays, the one of smallest doc_id.

    Linked are at most 4 of 64 bits on 4-word shingles, as in op7; README says what share of near copies that leaves.
    """
    return simhash.keep_first(docs)


def redact_secrets(spark, docs, sf_dir):
    """Secrets in texts are replaced by a mark; no document goes."""
    return secrets.redact(docs, vocabulary=public_tokenizers.path(VOCABULARY))


def mix_sources(spark, docs, sf_dir):
    """Each document as often as its source's target takes it: not at all, once or twice, in the order of the output shards."""
    return mixing.mix_documents(docs)


def pack_sequences(spark, docs, sf_dir):
    """Pieces of documents with their places in sequences of 4096 tokens; a document taken twice is packed twice."""
    return packing.pack(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("secrets", redact_secrets),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: A fitted classifier, XXH64 and a tokenizer are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
