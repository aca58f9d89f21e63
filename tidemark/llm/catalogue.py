"""The queries of the training-data operators, and SQL for those that SQL can express."""

from tidemark.llm import bpe, chat, decontaminate, langid, lines, neardup, pii, quality, rans, substring

QUERIES = {
    "op1_line_dedup": lines.op1_line_dedup,
    "op2_chat_formatting": chat.op2_chat_formatting,
    "op3_pii": pii.op3_pii,
    "op4_quality_rules": quality.op4_quality_rules,
    "op5_decontamination": decontaminate.op5_decontamination,
    "op6_near_dedup": neardup.op6_near_dedup,
    "op7_bpe_encoding": bpe.op7_bpe_encoding,
    "op8_substring_dedup": substring.op8_substring_dedup,
    "op9_language_id": langid.op9_language_id,
    "op10_rans_files": rans.op10_rans_files,
}
ORACLES = {"op1_line_dedup": lines.OP1_SQL, "op2_chat_formatting": chat.OP2_SQL, "op6_near_dedup": neardup.OP6_SQL, "op8_substring_dedup": substring.OP8_SQL}
