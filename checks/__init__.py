"""Registered queries: each operator over whole driver tables, with the DuckDB SQL that must agree."""
