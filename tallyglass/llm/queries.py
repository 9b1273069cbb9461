"""The numbered queries of this subpackage and the SQL that DuckDB can check them with."""

from __future__ import annotations

from tallyglass.llm import fim, langid, lmscore, media, mixing, packing, periodic, sharding, simhash, superkmers, topk, urlfilter, warc

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_topk": topk.op2_topk,
    "op3_media": media.op3_media,
    "op4_packing": packing.op4_packing,
    "op5_langid": langid.op5_langid,
    "op6_urlfilter": urlfilter.op6_urlfilter,
    "op7_warc": warc.op7_warc,
    "op8_mixing": mixing.op8_mixing,
    "op9_lmscore": lmscore.op9_lmscore,
    "op10_sharding": sharding.op10_sharding,
    "op11_periodic": periodic.op11_periodic,
    "op12_fim": fim.op12_fim,
    "op13_superkmers": superkmers.op13_superkmers,
}

ORACLE_SQL: dict[str, str] = {
    "op2_topk": topk.ORACLE,
    "op6_urlfilter": urlfilter.ORACLE,
    "op7_warc": warc.ORACLE,
    "op11_periodic": periodic.ORACLE,
    "op12_fim": fim.ORACLE,
    "op13_superkmers": superkmers.ORACLE,
}
