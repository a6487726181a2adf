"""Named queries of the text operators and their SQL."""

from __future__ import annotations

from tallycast.llm.chat_format import op6_chat_format
from tallycast.llm.decontamination import op11_decontamination
from tallycast.llm.hard_negatives import op12_hard_negatives
from tallycast.llm.language_id import op2_language_id
from tallycast.llm.mixing import op9_mixing
from tallycast.llm.near_dedup import op4_near_dedup
from tallycast.llm.oracles import ORACLES
from tallycast.llm.personal_data import op7_personal_data
from tallycast.llm.piece_coding import op8_piece_coding
from tallycast.llm.quality_rules import op3_quality_rules
from tallycast.llm.secret_scan import op1_secret_scan
from tallycast.llm.token_alignment import op13_token_alignment
from tallycast.llm.token_files import op10_token_files
from tallycast.llm.vector_dedup import op5_vector_dedup

__all__ = ["ORACLES", "QUERIES"]

QUERIES = {
    query.__name__: query
    for query in (
        op1_secret_scan,
        op2_language_id,
        op3_quality_rules,
        op4_near_dedup,
        op5_vector_dedup,
        op6_chat_format,
        op7_personal_data,
        op8_piece_coding,
        op9_mixing,
        op10_token_files,
        op11_decontamination,
        op12_hard_negatives,
        op13_token_alignment,
    )
}
