"""The registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from tidemark.llm import alignment, backoff, blocknames, collocations, decontaminate, mainhtml, packing, quality, sentencepieces, sharding, simhash, suffixes, warc

QUERIES = {
    "op1_bradley_terry": quality.op1,
    "op10_stupid_backoff": backoff.op10,
    "op11_son_phrases": collocations.op11,
    "op12_open_windows": packing.op12,
    "op13_run_skipping": alignment.op13,
    "op2_warc_chain": warc.op2,
    "op3_column_suffixes": suffixes.op3,
    "op4_simhash_trie": simhash.op4,
    "op5_extendible_hashing": sharding.op5,
    "op6_block_naming": blocknames.op6,
    "op7_host_consensus": mainhtml.op7,
    "op8_sentencepiece": sentencepieces.op8,
    "op9_simhash_windows": decontaminate.op9,
}

ORACLE: dict[str, str] = {
    "op10_stupid_backoff": backoff.OP10_SQL,
    "op11_son_phrases": collocations.OP11_SQL,
    "op2_warc_chain": warc.OP2_SQL,
    "op5_extendible_hashing": sharding.OP5_SQL,
    "op6_block_naming": blocknames.OP6_SQL,
}
