"""The queries of this package and, where SQL has words for them, their DuckDB twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from saldo.llm.ann import op9_multi_index
from saldo.llm.bbit_minhash import OP12_SQL, op12_bbit_minhash
from saldo.llm.collocations import OP11_SQL, op11_collocations
from saldo.llm.common import table
from saldo.llm.decontamination import op10_decontaminate
from saldo.llm.hard_negatives import OP13_SQL, op13_hard_negatives
from saldo.llm.language_id import op4_language
from saldo.llm.line_dedup import OP6_SQL, op6_site_lines
from saldo.llm.pii import op2_personal_data
from saldo.llm.piece_scan import op8_pieces
from saldo.llm.quality import op3_quality
from saldo.llm.simhash import op7_simhash
from saldo.llm.suffix_dedup import op5_suffix_array
from saldo.llm.url_filter import OP1_SQL, op1_url_filter


def over(function: Callable[..., DataFrame], *tables: str) -> Callable[[SparkSession, str], DataFrame]:
    """The operator applied to whole tables."""
    return lambda spark, sf_dir: function(*(table(spark, sf_dir, name) for name in tables))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_filter": over(op1_url_filter, "pages"),
    "op2_personal_data": over(op2_personal_data, "documents"),
    "op3_quality": over(op3_quality, "documents"),
    "op4_language": over(op4_language, "documents"),
    "op5_suffix_array": over(op5_suffix_array, "documents"),
    "op6_site_lines": over(op6_site_lines, "pages"),
    "op7_simhash": over(op7_simhash, "documents"),
    "op8_pieces": over(op8_pieces, "documents"),
    "op9_multi_index": over(op9_multi_index, "embeddings"),
    "op10_decontaminate": over(op10_decontaminate, "documents", "benchmark"),
    "op11_collocations": over(op11_collocations, "documents"),
    "op12_bbit_minhash": over(op12_bbit_minhash, "documents"),
    "op13_hard_negatives": over(op13_hard_negatives, "embeddings"),
}
ORACLE: dict[str, str] = {
    "op1_url_filter": OP1_SQL, "op6_site_lines": OP6_SQL, "op11_collocations": OP11_SQL, "op12_bbit_minhash": OP12_SQL,
    "op13_hard_negatives": OP13_SQL,
}
