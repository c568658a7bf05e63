"""The opN queries and the SQL of those that SQL can express."""

from __future__ import annotations

from . import automata, bpe, decontam, host_rules, langid, minhash, quotes, rans, reshard, suffix

QUERIES = {
    "op1_pigeonhole_decontam": decontam.query,
    "op2_quotation_links": quotes.query,
    "op3_host_rules": host_rules.query,
    "op4_language_bitmasks": langid.query,
    "op6_induced_sorting": suffix.query,
    "op7_minhash_stars": minhash.query,
    "op8_bpe_fold": bpe.query,
    "op9_rans_ids": rans.query,
    "op10_suffix_automata": automata.query,
    "op5_mincost_reshard": reshard.query,
}

ORACLE_SQL: dict[str, str] = {
    "op3_host_rules": host_rules.ORACLE_SQL,
    "op7_minhash_stars": minhash.ORACLE_SQL,
    "op10_suffix_automata": automata.ORACLE_SQL,
}
