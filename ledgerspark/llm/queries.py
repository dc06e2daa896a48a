"""Registered queries of the package: name -> (builder, DuckDB SQL or None)."""

from __future__ import annotations

from ledgerspark.llm import ann, bpe, decontaminate, langid, lattice, neardup, pieces, quality, secrets, trie, urls, warc, whitening

CATALOG = {
    "op1_warc": (warc.op1_warc, warc.OP1_SQL),
    "op2_decontamination": (decontaminate.op2_decontamination, decontaminate.OP2_SQL),
    "op3_bpe": (bpe.op3_bpe, None),
    "op4_url_filter": (urls.op4_url_filter, None),
    "op5_language_id": (langid.op5_language_id, None),
    "op6_lattice_likelihood": (lattice.op6_lattice_likelihood, None),
    "op7_nearest_neighbours": (ann.op7_nearest_neighbours, None),
    "op8_near_duplicates": (neardup.op8_near_duplicates, None),
    "op9_secret_scan": (secrets.op9_secret_scan, None),
    "op10_quality_classifier": (quality.op10_quality_classifier, None),
    "op11_sentencepiece": (pieces.op11_sentencepiece, None),
    "op12_prefix_trie": (trie.op12_prefix_trie, trie.OP12_SQL),
    "op13_whitening": (whitening.op13_whitening, None),
}
