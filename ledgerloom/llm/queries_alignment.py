"""Query of the cross-tokenizer alignment."""

from __future__ import annotations

from ledgerloom.llm.alignment import align_corpus, number_of_pieces, ship
from ledgerloom.llm.columns import table
from ledgerloom.llm.registry import query

TOKENIZERS = "/opt/tokenizers"


@query("op13_token_alignment", None)
def _(spark, sf_dir):
    pieces = f"{TOKENIZERS}/piece_bpe_32k.model"
    both = ship(spark, f"{TOKENIZERS}/byte_bpe_50k.json", pieces)
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return align_corpus(docs, both, number_of_pieces(pieces), digest=True).withColumnRenamed("groups", "groups_sha256")
