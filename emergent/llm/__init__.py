"""Training-data operators (tokens, scoring, privacy, de-duplication, packing, archives).

Nothing outside this folder imports it; ``register`` holds the thin queries.
"""
