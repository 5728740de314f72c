"""The operators of this package as named queries over whole tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from fraudlake.llm.codes import op11_codes
from fraudlake.llm.decontaminate import OP1_SQL, op1_decontaminate
from fraudlake.llm.extract import op5_extract
from fraudlake.llm.hard_negatives import OP13_SQL, op13_negatives
from fraudlake.llm.language import op7_language
from fraudlake.llm.mixing import OP4_SQL, op4_mixing
from fraudlake.llm.neighbours import op8_neighbours
from fraudlake.llm.phrases import OP12_SQL, op12_phrases
from fraudlake.llm.quality import op3_quality
from fraudlake.llm.sharding import op2_shards
from fraudlake.llm.simhash import op9_simhash
from fraudlake.llm.tokens import op10_tokens
from fraudlake.llm.warc import OP6_SQL, op6_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_shards": op2_shards,
    "op3_quality": op3_quality,
    "op4_mixing": op4_mixing,
    "op5_extract": op5_extract,
    "op6_warc": op6_warc,
    "op7_language": op7_language,
    "op8_neighbours": op8_neighbours,
    "op9_simhash": op9_simhash,
    "op10_tokens": op10_tokens,
    "op11_codes": op11_codes,
    "op12_phrases": op12_phrases,
    "op13_negatives": op13_negatives,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op1_decontaminate": OP1_SQL,
    "op4_mixing": OP4_SQL,
    "op6_warc": OP6_SQL,
    "op12_phrases": OP12_SQL,
    "op13_negatives": OP13_SQL,
}
