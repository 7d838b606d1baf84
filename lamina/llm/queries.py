"""The queries of the training-data operators and their SQL counterparts, by name."""

from __future__ import annotations

from lamina.llm.decontaminate import OP6_SQL, op6_decontaminate
from lamina.llm.fixity import OP1_SQL, op1_fixity
from lamina.llm.license_scan import OP4_SQL, op4_license_scan
from lamina.llm.line_dedup import OP8_SQL, op8_line_dedup
from lamina.llm.packing import op5_packing
from lamina.llm.quality_mil import op3_quality_mil
from lamina.llm.quality_rules import OP10_SQL, op10_quality_rules
from lamina.llm.secrets import OP9_SQL, op9_secrets
from lamina.llm.sharding import op2_sharding
from lamina.llm.simhash import op7_simhash

QUERIES = {
    "op1_fixity": op1_fixity,
    "op2_sharding": op2_sharding,
    "op3_quality_mil": op3_quality_mil,
    "op4_license_scan": op4_license_scan,
    "op5_packing": op5_packing,
    "op6_decontaminate": op6_decontaminate,
    "op7_simhash": op7_simhash,
    "op8_line_dedup": op8_line_dedup,
    "op9_secrets": op9_secrets,
    "op10_quality_rules": op10_quality_rules,
}
ORACLES: dict[str, str] = {
    "op1_fixity": OP1_SQL,
    "op4_license_scan": OP4_SQL,
    "op6_decontaminate": OP6_SQL,
    "op8_line_dedup": OP8_SQL,
    "op9_secrets": OP9_SQL,
    "op10_quality_rules": OP10_SQL,
}
