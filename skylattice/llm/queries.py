"""The operators of this subpackage as named queries, with SQL where SQL can say the same."""

from skylattice.llm import (
    collocations, conversations, exact_dedup, langid, licenses, lines, minhash, mixing, packing, quality, secrets, simhash, substring,
)

QUERIES = {
    "op1_secret_scan": secrets.query,
    "op2_mixing": mixing.query,
    "op3_language_id": langid.query,
    "op4_license_scan": licenses.query,
    "op5_line_dedup": lines.query,
    "op6_substring_dedup": substring.query,
    "op7_simhash": simhash.query,
    "op8_exact_dedup": exact_dedup.query,
    "op9_packing": packing.query,
    "op10_quality_rules": quality.query,
    "op11_prefix_trie": conversations.query,
    "op12_collocations": collocations.query,
    "op13_minhash": minhash.query,
}

ORACLE_SQL = {
    "op1_secret_scan": secrets.SQL,
    "op2_mixing": mixing.SQL,
    "op4_license_scan": licenses.SQL,
    "op5_line_dedup": lines.SQL,
    "op6_substring_dedup": substring.SQL,
    "op8_exact_dedup": exact_dedup.SQL,
    "op11_prefix_trie": conversations.SQL,
    "op12_collocations": collocations.SQL,
    "op13_minhash": minhash.SQL,
}
