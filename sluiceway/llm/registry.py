"""The queries of this subpackage and, where SQL can say the same, their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sluiceway.llm.decontaminate import OP8_SQL, op8_overlaps
from sluiceway.llm.embeddings import op3_embeddings
from sluiceway.llm.licences import op6_licences
from sluiceway.llm.lines import OP2_SQL, op2_lines
from sluiceway.llm.mixing import op1_mix
from sluiceway.llm.pii import op4_pii
from sluiceway.llm.prefixes import OP13_SQL, op13_prefixes
from sluiceway.llm.quality import op5_quality
from sluiceway.llm.search import OP12_SQL, op12_search
from sluiceway.llm.simhash import op7_simhash
from sluiceway.llm.toxicity import op11_toxicity
from sluiceway.llm.urls import op10_urls
from sluiceway.llm.warc import OP9_SQL, op9_warc

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_mix": op1_mix,
    "op2_lines": op2_lines,
    "op3_embeddings": op3_embeddings,
    "op4_pii": op4_pii,
    "op5_quality": op5_quality,
    "op6_licences": op6_licences,
    "op7_simhash": op7_simhash,
    "op8_overlaps": op8_overlaps,
    "op9_warc": op9_warc,
    "op10_urls": op10_urls,
    "op11_toxicity": op11_toxicity,
    "op12_search": op12_search,
    "op13_prefixes": op13_prefixes,
}

ORACLES: dict[str, str] = {
    "op2_lines": OP2_SQL,
    "op8_overlaps": OP8_SQL,
    "op9_warc": OP9_SQL,
    "op12_search": OP12_SQL,
    "op13_prefixes": OP13_SQL,
}
