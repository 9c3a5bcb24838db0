"""Operators for training-data pipelines: search, dedup, filtering, mixing, tokenizing.

Nothing else in the library imports this subpackage. One module per operator;
``queries`` registers one ``opN_<name>`` query for each, ``oracle`` the DuckDB SQL.
"""
