"""The queries of this subpackage and the SQL that checks them; the pipeline is registered beside them."""

from __future__ import annotations

from vertexloom.llm.byte_bpe import op2_byte_bpe
from vertexloom.llm.decontaminate import OP9_SQL, op9_decontaminate
from vertexloom.llm.divergence import OP12_SQL, op12_source_divergence
from vertexloom.llm.exact_dedup import OP7_SQL, op7_exact_dedup
from vertexloom.llm.language_id import op3_language_id
from vertexloom.llm.licenses import op11_license_scan
from vertexloom.llm.line_dedup import OP10_SQL, op10_line_dedup
from vertexloom.llm.merkle import OP13_SQL, op13_merkle_manifest
from vertexloom.llm.secrets import OP5_SQL, op5_secret_scan
from vertexloom.llm.simhash import op1_simhash
from vertexloom.llm.token_counts import op6_token_counts
from vertexloom.llm.toxicity import op8_toxicity
from vertexloom.llm.warc_zip import OP4_SQL, op4_warc


def queries() -> dict:
    return {
        "op1_simhash": op1_simhash,
        "op2_byte_bpe": op2_byte_bpe,
        "op3_language_id": op3_language_id,
        "op4_warc": op4_warc,
        "op5_secret_scan": op5_secret_scan,
        "op6_token_counts": op6_token_counts,
        "op7_exact_dedup": op7_exact_dedup,
        "op8_toxicity": op8_toxicity,
        "op9_decontaminate": op9_decontaminate,
        "op10_line_dedup": op10_line_dedup,
        "op11_license_scan": op11_license_scan,
        "op12_source_divergence": op12_source_divergence,
        "op13_merkle_manifest": op13_merkle_manifest,
    }


def oracle_sql() -> dict:
    return {
        "op4_warc": OP4_SQL,
        "op5_secret_scan": OP5_SQL,
        "op7_exact_dedup": OP7_SQL,
        "op9_decontaminate": OP9_SQL,
        "op10_line_dedup": OP10_SQL,
        "op12_source_divergence": OP12_SQL,
        "op13_merkle_manifest": OP13_SQL,
    }
