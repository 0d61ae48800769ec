"""The operators as queries over whole tables, and SQL where it can express them."""

from __future__ import annotations

from tieout.llm import (
    decontaminate,
    embedding_dup,
    hard_negatives,
    lexical,
    licenses,
    mixing,
    near_dup,
    packing,
    pii,
    sharding,
    tokens,
    toxicity,
    warc,
)

QUERIES = {
    query.__name__: query
    for query in (
        toxicity.op1_toxicity_nnpu,
        mixing.op2_mix_sources,
        tokens.op3_token_files,
        sharding.op4_rendezvous_shards,
        warc.op5_warc_records,
        licenses.op6_license_digests,
        embedding_dup.op7_embedding_links,
        pii.op8_pii_spans,
        decontaminate.op9_decontaminate,
        near_dup.op10_near_duplicates,
        hard_negatives.op11_hard_negatives,
        lexical.op12_ranked_search,
        packing.op13_pack_sequences,
    )
}

ORACLE_SQL = {
    "op2_mix_sources": mixing.ORACLE_SQL,
    "op6_license_digests": licenses.ORACLE_SQL,
    "op9_decontaminate": decontaminate.ORACLE_SQL,
    "op11_hard_negatives": hard_negatives.ORACLE_SQL,
    "op12_ranked_search": lexical.ORACLE_SQL,
}
