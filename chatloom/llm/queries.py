"""The numbered queries and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from chatloom.llm import filter_audit, jaccard_join, licenses, pii, quality, search, token_counts, warc
from chatloom.llm.decontamination import op6_decontamination
from chatloom.llm.filter_audit import op12_filter_audit
from chatloom.llm.jaccard_join import op1_jaccard_join
from chatloom.llm.langid import op5_language_id
from chatloom.llm.licenses import op13_license_scan
from chatloom.llm.lmscore import op10_lm_score
from chatloom.llm.pii import op4_pii
from chatloom.llm.quality import op3_quality_rules
from chatloom.llm.search import op11_lexical_search
from chatloom.llm.sentencepieces import op9_sentencepiece
from chatloom.llm.token_counts import op2_token_counts
from chatloom.llm.toxicity import op7_toxicity
from chatloom.llm.warc import op8_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_jaccard_join": op1_jaccard_join,
    "op2_token_counts": op2_token_counts,
    "op3_quality_rules": op3_quality_rules,
    "op4_pii": op4_pii,
    "op5_language_id": op5_language_id,
    "op6_decontamination": op6_decontamination,
    "op7_toxicity": op7_toxicity,
    "op8_warc": op8_warc,
    "op9_sentencepiece": op9_sentencepiece,
    "op10_lm_score": op10_lm_score,
    "op11_lexical_search": op11_lexical_search,
    "op12_filter_audit": op12_filter_audit,
    "op13_license_scan": op13_license_scan,
}

ORACLES: dict[str, str] = {
    "op1_jaccard_join": jaccard_join.ORACLE,
    "op2_token_counts": token_counts.ORACLE,
    "op3_quality_rules": quality.ORACLE,
    "op4_pii": pii.ORACLE,
    "op8_warc": warc.ORACLE,
    "op11_lexical_search": search.ORACLE,
    "op12_filter_audit": filter_audit.ORACLE,
    "op13_license_scan": licenses.ORACLE,
}
