"""The registered queries of this subpackage: each operator over its whole table, and its SQL where there is one."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from palaver.llm import op2_lines, op8_exact, op11_collocations
from palaver.llm.op1_decontamination import op1_benchmark_decontamination
from palaver.llm.op2_lines import op2_line_dedup
from palaver.llm.op3_packing import op3_best_fit_packing
from palaver.llm.op4_quality import op4_quality_classifier
from palaver.llm.op5_pii import op5_pii_redaction
from palaver.llm.op6_html import op6_html_extraction
from palaver.llm.op7_secrets import op7_secret_scan
from palaver.llm.op8_exact import op8_exact_dedup
from palaver.llm.op9_chat import op9_chat_formatting
from palaver.llm.op10_jaccard import op10_jaccard_join
from palaver.llm.op11_collocations import op11_phrase_collocations
from palaver.llm.op12_toxicity import op12_toxicity
from palaver.llm.op13_runs import op13_periodic_runs

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_benchmark_decontamination,
        op2_line_dedup,
        op3_best_fit_packing,
        op4_quality_classifier,
        op5_pii_redaction,
        op6_html_extraction,
        op7_secret_scan,
        op8_exact_dedup,
        op9_chat_formatting,
        op10_jaccard_join,
        op11_phrase_collocations,
        op12_toxicity,
        op13_periodic_runs,
    )
}
ORACLES: dict[str, str] = {
    "op2_line_dedup": op2_lines.ORACLE,
    "op8_exact_dedup": op8_exact.ORACLE,
    "op11_phrase_collocations": op11_collocations.ORACLE,
}
