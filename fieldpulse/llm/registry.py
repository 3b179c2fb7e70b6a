"""Queries of this subpackage, by name, and their SQL where SQL can express them."""

from __future__ import annotations

from fieldpulse.llm.align import op12_align
from fieldpulse.llm.chat import OP10_SQL, op10_chat
from fieldpulse.llm.ctw import op5_ctw
from fieldpulse.llm.decontaminate import OP6_SQL, op6_decontaminate
from fieldpulse.llm.fingerprint import op9_fingerprint
from fieldpulse.llm.mixing import op7_mixing
from fieldpulse.llm.piece_bpe import op11_sentencepiece
from fieldpulse.llm.repair import op13_repair
from fieldpulse.llm.sharding import op8_sharding
from fieldpulse.llm.simhash import op2_simhash
from fieldpulse.llm.suffix_dedup import op1_suffix_dedup
from fieldpulse.llm.toxicity import op4_toxicity
from fieldpulse.llm.warc import OP3_SQL, op3_warc


def _pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_simhash": op2_simhash,
    "op3_warc": op3_warc,
    "op4_toxicity": op4_toxicity,
    "op5_ctw": op5_ctw,
    "op6_decontaminate": op6_decontaminate,
    "op7_mixing": op7_mixing,
    "op8_sharding": op8_sharding,
    "op9_fingerprint": op9_fingerprint,
    "op10_chat": op10_chat,
    "op11_sentencepiece": op11_sentencepiece,
    "op12_align": op12_align,
    "op13_repair": op13_repair,
    "pipeline": _pipeline,
}
ORACLE_SQL: dict[str, str] = {"op3_warc": OP3_SQL, "op6_decontaminate": OP6_SQL, "op10_chat": OP10_SQL}
