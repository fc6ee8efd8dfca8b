"""Registered queries of this subpackage, and DuckDB SQL where it can express them."""

from __future__ import annotations

from . import collocations, embedding_dedup, hard_negatives, mixing, quality
from .collocations import op11_collocations
from .embedding_dedup import op2_embedding_dedup
from .hard_negatives import op13_hard_negatives
from .mixing import op4_mixing
from .ngram_lm import op12_lm_score
from .quality import op5_quality
from .sentencepiece_codec import op1_sentencepiece
from .simhash import op9_simhash
from .suffix_dedup import op7_suffix_dedup
from .token_counts import op10_token_counts
from .token_records import op3_token_records
from .toxicity import op6_toxicity
from .url_filter import op8_url_filter

QUERIES = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_embedding_dedup": op2_embedding_dedup,
    "op3_token_records": op3_token_records,
    "op4_mixing": op4_mixing,
    "op5_quality": op5_quality,
    "op6_toxicity": op6_toxicity,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_url_filter": op8_url_filter,
    "op9_simhash": op9_simhash,
    "op10_token_counts": op10_token_counts,
    "op11_collocations": op11_collocations,
    "op12_lm_score": op12_lm_score,
    "op13_hard_negatives": op13_hard_negatives,
}

ORACLES: dict[str, str] = {
    "op2_embedding_dedup": embedding_dedup.ORACLE_SQL,
    "op4_mixing": mixing.ORACLE_SQL,
    "op5_quality": quality.ORACLE_SQL,
    "op11_collocations": collocations.ORACLE_SQL,
    "op13_hard_negatives": hard_negatives.ORACLE_SQL,
}
