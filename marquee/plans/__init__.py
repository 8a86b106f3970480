"""Compositions over the operators: table bundles, the report, the query registry and its SQL oracle."""
