"""The registered queries of this package."""

from scoreflow.llm import sql
from scoreflow.llm.collocations import op12_collocations
from scoreflow.llm.decontaminate import op9_decontaminate
from scoreflow.llm.merkle import op13_merkle
from scoreflow.llm.pii import op7_pii
from scoreflow.llm.quality import op8_quality_rules
from scoreflow.llm.recompress import op5_recompress
from scoreflow.llm.setjoin import op11_set_join
from scoreflow.llm.simhash import op6_simhash
from scoreflow.llm.suffixdedup import op3_suffix_dedup
from scoreflow.llm.tokenfiles import op10_token_files
from scoreflow.llm.toxicity import op1_toxicity
from scoreflow.llm.warc import op4_warc
from scoreflow.llm.wordbpe import op2_word_bpe

QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity, op2_word_bpe, op3_suffix_dedup, op4_warc, op5_recompress, op6_simhash, op7_pii,
        op8_quality_rules, op9_decontaminate, op10_token_files, op11_set_join, op12_collocations, op13_merkle,
    )
}

#: Operators that SQL cannot express have none; tests/llm holds each against a brute-force version.
ORACLES: dict[str, str] = {
    "op11_set_join": sql.SET_JOIN, "op12_collocations": sql.COLLOCATIONS, "op13_merkle": sql.merkle(),
}
