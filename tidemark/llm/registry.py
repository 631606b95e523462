"""The registered queries of this package and their SQL."""

from __future__ import annotations

from tidemark.llm import (bpe, chat, collocations, exact_dedup, filter_audit, licenses, mixing, mtree,
                          ngram_join, pattern_packing, pii, quality, secrets)

QUERIES = {
    "op1_pii_surrogates": pii.op1_pii_surrogates,
    "op2_chat_format": chat.op2_chat_format,
    "op3_mtree": mtree.op3_mtree,
    "op4_license_scan": licenses.op4_license_scan,
    "op5_exact_dedup": exact_dedup.op5_exact_dedup,
    "op6_mixing": mixing.op6_mixing,
    "op7_ngram_join": ngram_join.op7_ngram_join,
    "op8_quality_knn": quality.op8_quality_knn,
    "op9_bpe": bpe.op9_bpe,
    "op10_secret_scan": secrets.op10_secret_scan,
    "op11_filter_audit": filter_audit.op11_filter_audit,
    "op12_collocations": collocations.op12_collocations,
    "op13_pattern_packing": pattern_packing.op13_pattern_packing,
}

#: DuckDB text for the queries that SQL can express.
ORACLE: dict[str, str] = {
    "op2_chat_format": chat.OP2_SQL,
    "op3_mtree": mtree.OP3_SQL,
    "op4_license_scan": licenses.OP4_SQL,
    "op5_exact_dedup": exact_dedup.OP5_SQL,
    "op6_mixing": mixing.OP6_SQL,
    "op11_filter_audit": filter_audit.OP11_SQL,
    "op12_collocations": collocations.OP12_SQL,
}
