"""Training-data operators: language-model scoring, mixing, licence scans, de-duplication,
media payloads, embeddings, tokenizing and toxicity.

Nothing else in the library imports this subpackage.
"""
