"""Operators for large text corpora (training-data preparation).

Each module implements one operator by the method its docstring names. The registered queries
(``opN_<name>``) and their SQL are in :mod:`orderstar.llm.registry`. Nothing outside this subpackage
imports it.
"""
