"""The queries of this folder and their DuckDB SQL."""

from __future__ import annotations

from chronoleaf.llm.op1_chat import OP1_SQL, op1_chat_formatting
from chronoleaf.llm.op2_topk import OP2_SQL, op2_topk_search
from chronoleaf.llm.op3_html import OP3_SQL, op3_html_extraction
from chronoleaf.llm.op4_substring import op4_substring_dedup
from chronoleaf.llm.op5_exact import OP5_SQL, op5_exact_dedup
from chronoleaf.llm.op6_toxicity import op6_toxicity
from chronoleaf.llm.op7_binary import op7_token_binary
from chronoleaf.llm.op8_simhash import op8_simhash_neardup
from chronoleaf.llm.op9_bpe import op9_bpe_codec
from chronoleaf.llm.op10_mixing import OP10_SQL, op10_source_mixing
from chronoleaf.llm.op11_phrases import OP11_SQL, op11_phrase_mining
from chronoleaf.llm.op12_rank_bpe import op12_rank_bpe
from chronoleaf.llm.op13_centroids import OP13_SQL, op13_centroid_clustering

QUERIES = {f.__name__: f for f in (
    op1_chat_formatting, op2_topk_search, op3_html_extraction, op4_substring_dedup, op5_exact_dedup,
    op6_toxicity, op7_token_binary, op8_simhash_neardup, op9_bpe_codec, op10_source_mixing,
    op11_phrase_mining, op12_rank_bpe, op13_centroid_clustering)}

ORACLE = {"op1_chat_formatting": OP1_SQL, "op2_topk_search": OP2_SQL, "op3_html_extraction": OP3_SQL,
          "op5_exact_dedup": OP5_SQL, "op10_source_mixing": OP10_SQL,
          "op11_phrase_mining": OP11_SQL, "op13_centroid_clustering": OP13_SQL}
