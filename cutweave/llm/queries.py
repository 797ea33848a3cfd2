"""Registry of the training-data queries and their SQL."""

from __future__ import annotations

from .decontaminate import OP12_SQL, op12_decontaminate
from .divergence import OP13_SQL, op13_divergence
from .langid import op4_langid
from .linededup import OP6_SQL, op6_linededup
from .mixing import OP8_SQL, op8_mixing
from .mtree import OP5_SQL, op5_mtree
from .ordermin import op7_ordermin
from .packing import op3_packing
from .quality import op2_quality
from .simhash import op1_simhash
from .tokenfiles import op10_tokenfiles
from .toxicity import op9_toxicity
from .whitening import op11_whitening

QUERIES = {
    "op1_simhash": op1_simhash,
    "op2_quality": op2_quality,
    "op3_packing": op3_packing,
    "op4_langid": op4_langid,
    "op5_mtree": op5_mtree,
    "op6_linededup": op6_linededup,
    "op7_ordermin": op7_ordermin,
    "op8_mixing": op8_mixing,
    "op9_toxicity": op9_toxicity,
    "op10_tokenfiles": op10_tokenfiles,
    "op11_whitening": op11_whitening,
    "op12_decontaminate": op12_decontaminate,
    "op13_divergence": op13_divergence,
}
#: SQL can't express the others: hashes that it lacks, trained models, tokenizers, packed files and decompositions.
ORACLE = {"op5_mtree": OP5_SQL, "op6_linededup": OP6_SQL, "op8_mixing": OP8_SQL, "op12_decontaminate": OP12_SQL, "op13_divergence": OP13_SQL}
