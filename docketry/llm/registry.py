"""The queries of this subpackage and the SQL that some of them equal."""

from __future__ import annotations

from . import ann, decontaminate, fim, licenses, mixing, neardup, quality, repeats, tokens, toxicity, trie, url_filters, warc

QUERIES = {
    "op1_url_filters": url_filters.op1_url_filters,
    "op2_decontamination": decontaminate.op2_decontamination,
    "op3_quality_classifier": quality.op3_quality_classifier,
    "op4_license_scan": licenses.op4_license_scan,
    "op5_toxicity": toxicity.op5_toxicity,
    "op6_minhash_dedup": neardup.op6_minhash_dedup,
    "op7_token_counts": tokens.op7_token_counts,
    "op8_warc_fixity": warc.op8_warc_fixity,
    "op9_ann": ann.op9_ann,
    "op10_mixing": mixing.op10_mixing,
    "op11_fill_in_middle": fim.op11_fill_in_middle,
    "op12_conversation_trie": trie.op12_conversation_trie,
    "op13_repeated_passages": repeats.op13_repeated_passages,
}

ORACLES = {
    "op1_url_filters": url_filters.OP1_SQL,
    "op6_minhash_dedup": neardup.OP6_SQL,
    "op8_warc_fixity": warc.OP8_SQL,
    "op10_mixing": mixing.OP10_SQL,
    "op11_fill_in_middle": fim.OP11_SQL,
    "op12_conversation_trie": trie.OP12_SQL,
    "op13_repeated_passages": repeats.OP13_SQL,
}
