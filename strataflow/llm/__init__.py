"""Operators for training-data pipelines: chat formatting, deduplication, tokenising, personal data,
decontamination, URL rules, language identification, language-model scores and HTML extraction.

Each module holds one operator with an interface of its own; ``queries`` derives the registered
queries from them.  The rest of the library does not import this package.
"""
