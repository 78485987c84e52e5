"""The subpackage's queries and, where SQL can express them, their oracles."""

from . import divergence, html_text, linedup, mixing, nndescent, packing, pii, prefix_trie, quality, secret_scan, simhash, substrings, vamana

QUERIES = {
    "op1_vamana": vamana.op1_vamana,
    "op2_packing": packing.op2_packing,
    "op3_simhash": simhash.op3_simhash,
    "op4_substrings": substrings.op4_substrings,
    "op5_html_text": html_text.op5_html_text,
    "op6_mixing": mixing.op6_mixing,
    "op7_nearest": nndescent.op7_nearest,
    "op8_line_dedup": linedup.op8_line_dedup,
    "op9_quality": quality.op9_quality,
    "op10_pii": pii.op10_pii,
    "op11_secrets": secret_scan.op11_secrets,
    "op12_divergence": divergence.op12_divergence,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
}
SQL = {
    "op1_vamana": vamana.OP1_SQL,
    "op4_substrings": substrings.OP4_SQL,
    "op6_mixing": mixing.OP6_SQL,
    "op8_line_dedup": linedup.OP8_SQL,
    "op12_divergence": divergence.OP12_SQL,
    "op13_prefix_trie": prefix_trie.OP13_SQL,
}
