"""The corpus queries: name -> (Spark callable, DuckDB SQL or None)."""

from __future__ import annotations

import corpus_pipeline

from finloom.llm.collocations import OP11_SQL, op11_collocations
from finloom.llm.decontaminate import OP9_SQL, op9_decontaminate
from finloom.llm.lexical import OP13_SQL, op13_reversed_search
from finloom.llm.line_dedup import OP1_SQL, op1_line_dedup
from finloom.llm.main_text import op10_main_text
from finloom.llm.nearest import OP2_SQL, op2_nearest
from finloom.llm.ngram_join import OP12_SQL, op12_ngram_jaccard
from finloom.llm.packing import OP3_SQL, op3_length_buckets
from finloom.llm.quality import op5_quality
from finloom.llm.sentence_spans import OP6_SQL, op6_sentence_spans
from finloom.llm.simhash import op4_simhash
from finloom.llm.substrings import op8_suffix_array
from finloom.llm.token_ids import op7_token_ids


def registry() -> dict:
    return {
        "op1_line_dedup": (op1_line_dedup, OP1_SQL),
        "op2_nearest": (op2_nearest, OP2_SQL),
        "op3_length_buckets": (op3_length_buckets, OP3_SQL),
        "op4_simhash": (op4_simhash, None),
        "op5_quality": (op5_quality, None),
        "op6_sentence_spans": (op6_sentence_spans, OP6_SQL),
        "op7_token_ids": (op7_token_ids, None),
        "op8_suffix_array": (op8_suffix_array, None),
        "op9_decontaminate": (op9_decontaminate, OP9_SQL),
        "op10_main_text": (op10_main_text, None),
        "op11_collocations": (op11_collocations, OP11_SQL),
        "op12_ngram_jaccard": (op12_ngram_jaccard, OP12_SQL),
        "op13_reversed_search": (op13_reversed_search, OP13_SQL),
        "pipeline": (corpus_pipeline.run, corpus_pipeline.ORACLE_SQL),
    }
