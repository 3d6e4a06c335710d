"""The registered queries of this subpackage and their SQL checks."""

from __future__ import annotations

from crawlspark.llm import chat, divergence, extract, language, leaks, mixing, neighbors, packing, phrases, repeats, search, simhash, warc

QUERIES = {
    "op2_extract": extract.op2_extract,
    "op3_search": search.op3_search,
    "op4_chat": chat.op4_chat,
    "op1_suffix_array": repeats.op1_suffix_array,
    "op5_embeddings": neighbors.op5_embeddings,
    "op6_warc": warc.op6_warc,
    "op9_simhash": simhash.op9_simhash,
    "op8_language": language.op8_language,
    "op7_packing": packing.op7_packing,
    "op10_mixing": mixing.op10_mixing,
    "op11_phrases": phrases.op11_phrases,
    "op12_divergence": divergence.op12_divergence,
    "op13_decontaminate": leaks.op13_decontaminate,
}
ORACLES = {
    "op3_search": search.OP3_SQL,
    "op4_chat": chat.OP4_SQL,
    "op6_warc": warc.OP6_SQL,
    "op10_mixing": mixing.OP10_SQL,
    "op11_phrases": phrases.OP11_SQL,
    "op12_divergence": divergence.OP12_SQL,
    "op13_decontaminate": leaks.OP13_SQL,
}
