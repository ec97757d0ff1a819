"""The registered query of each operator, and SQL where SQL can say the same."""

from __future__ import annotations

from . import (
    op01_quality_fm,
    op02_ngram_join,
    op03_decontaminate,
    op04_secret_scan,
    op05_main_text,
    op06_bpe,
    op07_license_scan,
    op08_warc,
    op09_lm_score,
    op10_quality_rules,
    op11_prefix_trie,
    op12_token_orc,
    op13_merkle,
)

_MODULES = [
    op01_quality_fm,
    op02_ngram_join,
    op03_decontaminate,
    op04_secret_scan,
    op05_main_text,
    op06_bpe,
    op07_license_scan,
    op08_warc,
    op09_lm_score,
    op10_quality_rules,
    op11_prefix_trie,
    op12_token_orc,
    op13_merkle,
]

QUERIES = {name: run for module in _MODULES for name, run in module.QUERIES.items()}
SQL = {name: sql for module in _MODULES for name, sql in module.SQL.items()}
