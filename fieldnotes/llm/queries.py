"""Named queries of the text operators, with DuckDB SQL where SQL can express them."""

from __future__ import annotations

from fieldnotes.llm import langid, language_model, lines, mixing, periods, pieces, quality, simhash, spelling, suffix, surrogates, templates, warc

QUERIES = {
    "op1_fuzzy_lines": lines.op1_fuzzy_lines,
    "op2_compression_bands": quality.op2_compression_bands,
    "op3_bloom_language": langid.op3_bloom_language,
    "op4_surrogates": surrogates.op4_surrogates,
    "op5_template_windows": templates.op5_template_windows,
    "op6_simhash_trie": simhash.op6_simhash_trie,
    "op7_weighted_fair_queueing": mixing.op7_weighted_fair_queueing,
    "op8_warc_dictionary": warc.op8_warc_dictionary,
    "op9_suffix_arrays": suffix.op9_suffix_arrays,
    "op10_pitman_yor": language_model.op10_pitman_yor,
    "op11_sorted_variants": spelling.op11_sorted_variants,
    "op12_basic_factors": periods.op12_basic_factors,
    "op13_offset_pieces": pieces.op13_offset_pieces,
}

ORACLES = {
    "op7_weighted_fair_queueing": mixing.sql(),
    "op8_warc_dictionary": warc.sql(),
}
