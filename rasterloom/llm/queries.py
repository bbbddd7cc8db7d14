"""The subpackage's queries and SQL."""

from __future__ import annotations

from rasterloom.llm import lattice, quality
from rasterloom.llm.langid import op9_language_id
from rasterloom.llm.lattice import op4_lattice
from rasterloom.llm.maxent import op8_maxent
from rasterloom.llm.mixing import op3_mixing
from rasterloom.llm.packing import op5_packing
from rasterloom.llm.pii import op2_pii
from rasterloom.llm.quality import op1_quality_rules
from rasterloom.llm.secrets import op6_secrets
from rasterloom.llm.simhash import op7_simhash
from rasterloom.llm.toxicity import op10_toxicity

QUERIES = {
    f.__name__: f
    for f in (
        op1_quality_rules,
        op2_pii,
        op3_mixing,
        op4_lattice,
        op5_packing,
        op6_secrets,
        op7_simhash,
        op8_maxent,
        op9_language_id,
        op10_toxicity,
    )
}
#: SQL expresses these in full; the others depend on models, draws, tokenizers or hashes, and are held against brute force.
ORACLE_SQL: dict[str, str] = {"op1_quality_rules": quality.ORACLE_SQL, "op4_lattice": lattice.ORACLE_SQL}
