"""Training-data operators: archives, dedup, packing, language, secrets, fingerprints, mixing and quality.

Nothing else in the library imports this subpackage. Each module holds one operator with its general
interface; ``queries`` has the thin registered queries over the shared tables.
"""
