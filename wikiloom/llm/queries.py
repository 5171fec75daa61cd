"""The numbered queries over the driver's tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .bpe import op8_bpe_transducer
from .debruijn import op2_debruijn_dedup
from .divergence import op13_source_divergence, op13_sql
from .feistel import op5_feistel_pseudonyms
from .fim import op12_fill_in_middle, op12_sql
from .interpolation import op11_deleted_interpolation
from .langid import op4_naive_bayes_langid
from .licences import op10_licence_digest, op10_sql
from .linecrf import op1_line_crf
from .mixing import op9_temperature_mix
from .rans import op6_rans_tokens
from .simhash import op7_simhash_anchor
from .sniff import op3_signature_sniff

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_crf": op1_line_crf,
    "op2_debruijn_dedup": op2_debruijn_dedup,
    "op3_signature_sniff": op3_signature_sniff,
    "op4_naive_bayes_langid": op4_naive_bayes_langid,
    "op5_feistel_pseudonyms": op5_feistel_pseudonyms,
    "op6_rans_tokens": op6_rans_tokens,
    "op7_simhash_anchor": op7_simhash_anchor,
    "op8_bpe_transducer": op8_bpe_transducer,
    "op9_temperature_mix": op9_temperature_mix,
    "op10_licence_digest": op10_licence_digest,
    "op11_deleted_interpolation": op11_deleted_interpolation,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_source_divergence": op13_source_divergence,
}

ORACLES: dict[str, str] = {"op10_licence_digest": op10_sql(), "op12_fill_in_middle": op12_sql(), "op13_source_divergence": op13_sql()}
