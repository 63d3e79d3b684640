"""The numbered operators as queries over the whole given tables, with their SQL twins."""

from __future__ import annotations

from . import dialogues, jaccard, katz, licenses, mixing, packing, phrases, pieces, pii, quality, rpforest, shards, warc

QUERIES = {
    "op1_warc": warc.warc_query,
    "op2_quality_rules": quality.quality_query,
    "op3_sharding": shards.sharding_query,
    "op4_ngram_jaccard": jaccard.jaccard_query,
    "op5_pii_crf": pii.pii_query,
    "op6_mixing": mixing.mixing_query,
    "op7_license_index": licenses.license_query,
    "op8_katz_lm": katz.katz_query,
    "op9_packing": packing.packing_query,
    "op10_rp_forest": rpforest.rpforest_query,
    "op11_dialogue_repair": dialogues.dialogues_query,
    "op12_piece_encoding": pieces.pieces_query,
    "op13_collocations": phrases.phrases_query,
}

#: The others have no SQL twin (trained models, tokenizers, differencing); tests hold them against brute force or their laws.
ORACLES = {
    "op1_warc": warc.ORACLE,
    "op2_quality_rules": quality.ORACLE,
    "op4_ngram_jaccard": jaccard.ORACLE,
    "op6_mixing": mixing.ORACLE,
    "op7_license_index": licenses.ORACLE,
    "op10_rp_forest": rpforest.ORACLE,
    "op11_dialogue_repair": dialogues.ORACLE,
    "op13_collocations": phrases.ORACLE,
}
