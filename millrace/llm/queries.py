"""The queries of the training-data operators and their oracle SQL."""

from __future__ import annotations

from millrace.llm import decontaminate, lattice, mixing, near_duplicates, personal_data, quality, secrets, token_files, vector_duplicates, warc


def queries():
    return {
        "op1_random_indexing_quality": quality.op1_random_indexing_quality,
        "op3_weak_supervision": personal_data.op3_weak_supervision,
        "op4_subword_lattice": lattice.op4_subword_lattice,
        "op5_warc_source": warc.op5_warc_source,
        "op6_lsh_forest_join": near_duplicates.op6_lsh_forest_join,
        "op7_nn_descent": vector_duplicates.op7_nn_descent,
        "op8_decoding_worklist": secrets.op8_decoding_worklist,
        "personal_base_spans": personal_data.personal_base_spans,
        "secret_base_spans": secrets.secret_base_spans,
        "op9_positional_index": decontaminate.op9_positional_index,
        "op2_token_files": token_files.op2_token_files,
        "op10_weighted_fair_mix": mixing.op10_weighted_fair_mix,
    }


def oracle_sql():
    return {"personal_base_spans": personal_data.BASE_ORACLE, "secret_base_spans": secrets.BASE_ORACLE, "op5_warc_source": warc.ORACLE, "op6_lsh_forest_join": near_duplicates.ORACLE, "op7_nn_descent": vector_duplicates.ORACLE, "op9_positional_index": decontaminate.ORACLE, "op10_weighted_fair_mix": mixing.ORACLE}
