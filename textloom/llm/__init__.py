"""Training-data operators: each module holds one operator with its docstring contract and its ``QUERIES`` / ``SQL`` entries."""
