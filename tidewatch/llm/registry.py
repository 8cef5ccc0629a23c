"""Queries of the training-data operators and their SQL twins."""

from __future__ import annotations

import corpus_pipeline

from tidewatch.llm import collocations, decontaminate, merkle, quotes, topk
from tidewatch.llm.collocations import op11_collocations
from tidewatch.llm.decontaminate import op9_decontaminate
from tidewatch.llm.id_store import op10_id_store
from tidewatch.llm.language_id import op8_language_id
from tidewatch.llm.licenses import op12_license_scan
from tidewatch.llm.lm_ctw import op6_lm_scores
from tidewatch.llm.merkle import op13_merkle_manifest
from tidewatch.llm.ngram_join import op1_ngram_join
from tidewatch.llm.packing import op2_packing
from tidewatch.llm.pii import op5_pii
from tidewatch.llm.quotes import op7_quotes
from tidewatch.llm.token_count import op3_token_counts
from tidewatch.llm.topk import op4_topk

QUERIES = {
    "op1_ngram_join": op1_ngram_join,
    "op2_packing": op2_packing,
    "op3_token_counts": op3_token_counts,
    "op4_topk": op4_topk,
    "op5_pii": op5_pii,
    "op6_lm_scores": op6_lm_scores,
    "op7_quotes": op7_quotes,
    "op8_language_id": op8_language_id,
    "op9_decontaminate": op9_decontaminate,
    "op10_id_store": op10_id_store,
    "op11_collocations": op11_collocations,
    "op12_license_scan": op12_license_scan,
    "op13_merkle_manifest": op13_merkle_manifest,
    "pipeline": corpus_pipeline.run,
}
ORACLE: dict[str, str] = {
    "op4_topk": topk.ORACLE,
    "op7_quotes": quotes.ORACLE,
    "op9_decontaminate": decontaminate.ORACLE,
    "op11_collocations": collocations.ORACLE,
    "op13_merkle_manifest": merkle.ORACLE,
}
