"""Registered queries of this subpackage, and SQL for those that it can express."""

from __future__ import annotations

from shelfmark.llm.op10_fm_index import op10_fm_index
from shelfmark.llm.op11_reply_trees import SQL as REPLY_SQL
from shelfmark.llm.op11_reply_trees import op11_reply_trees
from shelfmark.llm.op12_grammar_runs import op12_grammar_runs
from shelfmark.llm.op13_rmq_search import SQL as SEARCH_SQL
from shelfmark.llm.op13_rmq_search import op13_rmq_search
from shelfmark.llm.op1_qda_quality import op1_qda_quality
from shelfmark.llm.op2_surrogates import op2_surrogates
from shelfmark.llm.op3_delta_rollups import SQL as ROLLUP_SQL
from shelfmark.llm.op3_delta_rollups import op3_delta_rollups, word_rollups
from shelfmark.llm.op4_tensored_minhash import op4_tensored_minhash
from shelfmark.llm.op5_sum_squares_packing import op5_sum_squares_packing
from shelfmark.llm.op6_katz_backoff import op6_katz_backoff
from shelfmark.llm.op7_huffman_files import op7_huffman_files
from shelfmark.llm.op8_crf_rules import op8_line_crf
from shelfmark.llm.op9_line_join import SQL as LINE_SQL
from shelfmark.llm.op9_line_join import op9_line_join

QUERIES = {
    "op1_qda_quality": op1_qda_quality,
    "op2_surrogates": op2_surrogates,
    "op3_delta_rollups": op3_delta_rollups,
    "word_rollups": word_rollups,
    "op4_tensored_minhash": op4_tensored_minhash,
    "op5_sum_squares_packing": op5_sum_squares_packing,
    "op6_katz_backoff": op6_katz_backoff,
    "op7_huffman_files": op7_huffman_files,
    "op8_line_crf": op8_line_crf,
    "op9_line_join": op9_line_join,
    "op10_fm_index": op10_fm_index,
    "op11_reply_trees": op11_reply_trees,
    "op12_grammar_runs": op12_grammar_runs,
    "op13_rmq_search": op13_rmq_search,
}

SQL = {"op9_line_join": LINE_SQL, "op11_reply_trees": REPLY_SQL, "op13_rmq_search": SEARCH_SQL, "word_rollups": ROLLUP_SQL}
