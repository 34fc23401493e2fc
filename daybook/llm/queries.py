"""Registered queries of this subpackage and, where SQL can express them, their
DuckDB oracles."""

from __future__ import annotations

from . import chat, decontam, editprints, langid, licenses, neardup, packing, pseudonyms, sharding, suffixdedup, urlrules, vectorcodes, whitening
from .oracles import ORACLES as _SQL

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_langid": langid.op2_langid,
    "op3_pii": pseudonyms.op3_pii,
    "op4_neardup": neardup.op4_neardup,
    "op5_urlrules": urlrules.op5_urlrules,
    "op6_editprints": editprints.op6_editprints,
    "op7_shards": sharding.op7_shards,
    "op8_chat": chat.op8_chat,
    "op9_decontaminate": decontam.op9_decontaminate,
    "op10_licenses": licenses.op10_licenses,
    "op11_vectorcodes": vectorcodes.op11_vectorcodes,
    "op12_suffixdedup": suffixdedup.op12_suffixdedup,
    "op13_whitening": whitening.op13_whitening,
}

ORACLES = {k: v for k, v in _SQL.items() if k in QUERIES}
