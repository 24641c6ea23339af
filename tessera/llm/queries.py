"""The queries that apply each operator to its whole table, and SQL where it exists."""

from __future__ import annotations

from . import ann, decontam, langid, linededup, lm, mixing, neardup, secrets, sharding, urlrep

QUERIES = {
    "op4_decontaminate": decontam.op4_decontaminate,
    "op6_nearest": ann.op6_nearest,
    "op9_secret_scan": secrets.op9_secret_scan,
    "op1_maxent": lm.op1_maxent,
    "op10_language_id": langid.op10_language_id,
    "op2_near_dedup": neardup.op2_near_dedup,
    "op3_line_dedup": linededup.op3_line_dedup,
    "op5_mixing": mixing.op5_mixing,
    "op7_sharding": sharding.op7_sharding,
    "op8_url_reputation": urlrep.op8_url_reputation,
}

ORACLE_SQL = {
    "op2_near_dedup": neardup.SQL,
    "op5_mixing": mixing.SQL,
    "op8_url_reputation": urlrep.SQL,
}
