"""Operators for preparing training text: near-duplicate search, token files,
packing, archives, classifiers, mixing and fingerprints.

Nothing else in the library imports this subpackage; the registered queries
are in ``dimforge.llm.queries``.
"""
