"""Training-data operators: quality, licences, hosts, toxicity, packing, language
model, personal data, fingerprints, near duplicates, token ids, spelling variants, line
dedup and conversation repair.

Nothing outside this package imports it. `stray.llm.queries` holds the registered
queries and their oracle SQL.
"""
