"""Training-data operators: language, licences, near duplicates, toxicity, tokens, quality,
vector search, decontamination, URL rules and repeated passages.

Nothing else in the library imports this subpackage. Each operator is a function of
DataFrames with its own interface; ``quarry.llm.queries`` binds them to the driver's tables.
"""
