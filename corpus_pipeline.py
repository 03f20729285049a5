"""Corpus pipeline over ``documents``: quality, exact dedup, SimHash near-dedup, mixing, BPE.

Each stage works on all that its predecessor kept. All but the last return the
columns of ``documents``; the last returns doc_id, n_tokens, ids_sha256 and
decoded_sha256 of each row of the mix, repeats included. Nulls, empty texts,
repeated rows, empty tables and other columns are treated as the operators'
docstrings say.
"""

from quillprice.llm import bpe
from quillprice.llm.common import table
from quillprice.llm.exact_dedup import exact_dedup
from quillprice.llm.mixing import mix
from quillprice.llm.quality import keep_good
from quillprice.llm.simhash import near_dedup
from quillprice.session import materialize


def quality_stage(spark, docs, sf_dir):
    """Documents that the quality classifier rejects go; it learns from the documents at hand."""
    return keep_good(docs, table(spark, sf_dir, "labels"))


def exact_stage(spark, docs, sf_dir):
    """Of equal texts the row with the largest doc_id stays."""
    return exact_dedup(docs)


def simhash_stage(spark, docs, sf_dir):
    """Of each group of linked fingerprints the document with the smallest doc_id stays."""
    return near_dedup(docs)


def mixing_stage(spark, docs, sf_dir):
    """Documents are repeated or left out so that each source comes near its target."""
    return mix(docs)


def bpe_stage(spark, docs, sf_dir):
    """Every text of the mix is encoded and decoded."""
    return bpe.digests(docs)


STAGES = [("quality", quality_stage), ("exact dedup", exact_stage), ("simhash near-dedup", simhash_stage),
          ("mixing", mixing_stage), ("bpe", bpe_stage)]

#: The classifier, the fingerprints and the encoding are beyond SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark, sf_dir):
    """All stages in order; what each but the last returns is stored in the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name.replace(' ', '-')}")
    return STAGES[-1][1](spark, docs, sf_dir)
