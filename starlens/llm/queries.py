"""Registered queries of this subpackage and their SQL."""

from starlens.llm.bpe import op9_bpe
from starlens.llm.crosspolytope import OP6_SQL, op6_near_vectors
from starlens.llm.linechunks import OP8_SQL, op8_line_chunks
from starlens.llm.masks import OP13_SQL, op13_masks
from starlens.llm.mixing import OP1_SQL, op1_mixing
from starlens.llm.negatives import OP12_SQL, op12_negatives
from starlens.llm.pii import op7_pii
from starlens.llm.planes import op2_planes
from starlens.llm.quality import op4_quality
from starlens.llm.simhash import op3_simhash
from starlens.llm.suffixes import op5_suffixes
from starlens.llm.topk import OP10_SQL, op10_topk
from starlens.llm.treebpe import op11_tree_bpe

QUERIES = {"op1_mixing": op1_mixing, "op2_planes": op2_planes, "op3_simhash": op3_simhash, "op4_quality": op4_quality,
            "op5_suffixes": op5_suffixes, "op6_near_vectors": op6_near_vectors, "op7_pii": op7_pii,
           "op8_line_chunks": op8_line_chunks, "op9_bpe": op9_bpe, "op10_topk": op10_topk,
           "op11_tree_bpe": op11_tree_bpe, "op12_negatives": op12_negatives,
           "op13_masks": op13_masks}
ORACLES: dict[str, str] = {"op1_mixing": OP1_SQL, "op6_near_vectors": OP6_SQL, "op8_line_chunks": OP8_SQL,
                           "op10_topk": OP10_SQL, "op12_negatives": OP12_SQL, "op13_masks": OP13_SQL}
