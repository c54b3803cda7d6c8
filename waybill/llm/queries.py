"""Registered queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

from .decontaminate import OP7_SQL, op7_decontaminate
from .mixing import op5_mixing
from .pii import op8_pii
from .quality_rules import op10_quality_rules
from .simhash import op1_simhash
from .suffix_dedup import op6_suffix_dedup
from .token_records import op4_token_records
from .toxicity import op3_toxicity
from .url_filter import OP2_SQL, op2_url_filter
from .warc import OP9_SQL, op9_warc

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_url_filter": op2_url_filter,
    "op3_toxicity": op3_toxicity,
    "op4_token_records": op4_token_records,
    "op5_mixing": op5_mixing,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_decontaminate": op7_decontaminate,
    "op8_pii": op8_pii,
    "op9_warc": op9_warc,
    "op10_quality_rules": op10_quality_rules,
}

ORACLES: dict[str, str] = {"op2_url_filter": OP2_SQL, "op7_decontaminate": OP7_SQL, "op9_warc": OP9_SQL}
