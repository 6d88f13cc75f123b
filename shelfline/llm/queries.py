"""The registered queries of this subpackage, and the same in SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from shelfline.llm import chat, decontaminate, html, jaccard, prefix_trie, ranked, rules, secret_scan
from shelfline.llm.bpe import op7_bpe
from shelfline.llm.chat import op6_chat
from shelfline.llm.decontaminate import op8_decontaminate
from shelfline.llm.html import op1_html
from shelfline.llm.jaccard import op2_jaccard
from shelfline.llm.masked import op5_pseudo_likelihood
from shelfline.llm.prefix_trie import op12_prefix_trie
from shelfline.llm.quality import op9_quality
from shelfline.llm.ranked import op13_ranked
from shelfline.llm.rules import op10_host_rules
from shelfline.llm.secret_scan import op11_secrets
from shelfline.llm.suffix import op4_suffix
from shelfline.llm.wavelet import op3_wavelet

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_html": op1_html,
    "op2_jaccard": op2_jaccard,
    "op3_wavelet": op3_wavelet,
    "op4_suffix": op4_suffix,
    "op5_pseudo_likelihood": op5_pseudo_likelihood,
    "op6_chat": op6_chat,
    "op7_bpe": op7_bpe,
    "op8_decontaminate": op8_decontaminate,
    "op9_quality": op9_quality,
    "op10_host_rules": op10_host_rules,
    "op11_secrets": op11_secrets,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_ranked": op13_ranked,
}

ORACLES: dict[str, str] = {
    "op1_html": html.ORACLE,
    "op2_jaccard": jaccard.ORACLE,
    "op6_chat": chat.ORACLE,
    "op8_decontaminate": decontaminate.ORACLE,
    "op10_host_rules": rules.ORACLE,
    "op11_secrets": secret_scan.ORACLE,
    "op12_prefix_trie": prefix_trie.ORACLE,
    "op13_ranked": ranked.ORACLE,
}
