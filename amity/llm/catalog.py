"""Registered queries of the pipeline operators and their DuckDB SQL."""

from __future__ import annotations

from amity.llm import bpe, conversations, fim, licenses, lines, mixing, packing, quality, sharding, simhash, topk, toxicity, warc

MODULES = (quality, simhash, bpe, sharding, topk, warc, lines, mixing, toxicity, packing, conversations, licenses, fim)
QUERIES = {name: fn for m in MODULES for name, fn in m.QUERIES.items()}
SQL = {name: text for m in MODULES for name, text in m.SQL.items()}
