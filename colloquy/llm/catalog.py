"""The modules of this subpackage that have QUERIES and SQL."""

from __future__ import annotations

from colloquy.llm import containers, copies, mixture, pieces, residue, runs, splits, terms

MODULES: list = [pieces, splits, runs, copies, terms, containers, mixture, residue]
