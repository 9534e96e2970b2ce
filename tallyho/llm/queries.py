"""The registered queries of this package, and their DuckDB SQL where there is one."""

from __future__ import annotations

from . import conversations, cover_tree, digest, jaccard_groups, langid, licenses, packing, pieces, shards, spelling, token_counts, toxicity, url_rules

QUERIES = {
    "op1_jaccard_groups": jaccard_groups.query,
    "op2_shard_interleave": shards.query,
    "op3_sentencepiece": pieces.query,
    "op4_language_codes": langid.query,
    "op5_rarity_digest": digest.query,
    "op6_pack_powers": packing.query,
    "op7_cover_tree": cover_tree.query,
    "op8_toxic_segments": toxicity.query,
    "op9_url_rules": url_rules.query,
    "op10_token_counts": token_counts.query,
    "op11_conversation_repair": conversations.query,
    "op12_spelling_variants": spelling.query,
    "op13_license_scan": licenses.query,
}

ORACLES = {
    "op1_jaccard_groups": jaccard_groups.ORACLE,
    "op7_cover_tree": cover_tree.ORACLE,
    "op9_url_rules": url_rules.ORACLE,
    "op11_conversation_repair": conversations.ORACLE,
    "op12_spelling_variants": spelling.ORACLE,
}
