"""The registered ``opN_<name>`` queries and the oracle SQL of those that SQL can express."""

from . import (bpe, centroids, chat, decontaminate, filteraudit, htmltext, licenses, linededup, quality, sharding, simhash, suffixes, topk)

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_byte_bpe": bpe.op2_byte_bpe,
    "op3_quality": quality.op3_quality,
    "op4_exact_topk": topk.op4_exact_topk,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_stratified_shards": sharding.op6_stratified_shards,
    "op7_license_scan": licenses.op7_license_scan,
    "op8_suffix_dedup": suffixes.op8_suffix_dedup,
    "op9_line_dedup": linededup.op9_line_dedup,
    "op10_html_text": htmltext.op10_html_text,
    "op11_filter_audit": filteraudit.op11_filter_audit,
    "op12_centroids": centroids.op12_centroids,
    "op13_chat_format": chat.op13_chat_format,
}

ORACLE = {
    "op4_exact_topk": topk.OP4_SQL,
    "op5_decontaminate": decontaminate.OP5_SQL,
    "op9_line_dedup": linededup.OP9_SQL,
    "op11_filter_audit": filteraudit.OP11_SQL,
    "op12_centroids": centroids.OP12_SQL,
    "op13_chat_format": chat.OP13_SQL,
}
