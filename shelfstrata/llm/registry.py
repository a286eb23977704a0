"""The queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from shelfstrata.llm.decontamination import OP10_SQL, op10_decontamination
from shelfstrata.llm.embedding_dedup import OP8_SQL, op8_embedding_dedup
from shelfstrata.llm.html_extraction import op9_html_extraction
from shelfstrata.llm.language import op5_language
from shelfstrata.llm.merkle import OP12_SQL, op12_merkle_manifest
from shelfstrata.llm.mixing import OP6_SQL, op6_mixing
from shelfstrata.llm.ngram_join import OP2_SQL, op2_ngram_join
from shelfstrata.llm.secrets import OP4_SQL, op4_secrets
from shelfstrata.llm.simhash import op13_simhash_fingerprints
from shelfstrata.llm.spelling import OP11_SQL, op11_spelling_variants
from shelfstrata.llm.suffix_dedup import op1_suffix_dedup
from shelfstrata.llm.toxicity import op3_toxicity
from shelfstrata.llm.warc import op7_warc

QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_ngram_join": op2_ngram_join,
    "op3_toxicity": op3_toxicity,
    "op4_secrets": op4_secrets,
    "op5_language": op5_language,
    "op6_mixing": op6_mixing,
    "op7_warc": op7_warc,
    "op8_embedding_dedup": op8_embedding_dedup,
    "op9_html_extraction": op9_html_extraction,
    "op10_decontamination": op10_decontamination,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_simhash_fingerprints": op13_simhash_fingerprints,
}

ORACLES = {
    "op2_ngram_join": OP2_SQL,
    "op4_secrets": OP4_SQL,
    "op6_mixing": OP6_SQL,
    "op8_embedding_dedup": OP8_SQL,
    "op10_decontamination": OP10_SQL,
    "op11_spelling_variants": OP11_SQL,
    "op12_merkle_manifest": OP12_SQL,
}
