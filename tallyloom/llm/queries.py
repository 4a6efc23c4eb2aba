"""The registered queries of the corpus operators, and their SQL where SQL can say the same."""

from __future__ import annotations

from tallyloom.llm import chat, collocations, decontaminate, exact_dedup, language, licenses, lm, negatives, packing, quality, simhash, substrings, warc


def llm_queries() -> dict:
    return {
        "op1_packing": packing.op1_packing,
        "op2_quality": quality.op2_quality,
        "op3_language": language.op3_language,
        "op4_license_scan": licenses.op4_license_scan,
        "op5_suffix_dedup": substrings.op5_suffix_dedup,
        "op6_exact_dedup": exact_dedup.op6_exact_dedup,
        "op7_decontamination": decontaminate.op7_decontamination,
        "op8_simhash": simhash.op8_simhash,
        "op9_chat_formatting": chat.op9_chat_formatting,
        "op10_warc": warc.op10_warc,
        "op11_collocations": collocations.op11_collocations,
        "op12_hard_negatives": negatives.op12_hard_negatives,
        "op13_lm_scores": lm.op13_lm_scores,
    }


def llm_oracles() -> dict[str, str]:
    return {
        "op4_license_scan": licenses.scan_sql(),
        "op5_suffix_dedup": substrings.OP5_SQL,
        "op6_exact_dedup": exact_dedup.OP6_SQL,
        "op9_chat_formatting": chat.OP9_SQL,
        "op10_warc": warc.OP10_SQL,
        "op11_collocations": collocations.OP11_SQL,
        "op12_hard_negatives": negatives.OP12_SQL,
    }
