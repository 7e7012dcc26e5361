"""Training-data operators: URL rules, decontamination, quality, licences, toxicity, near-duplicates,
token counts, fixity, nearest neighbours and source mixing.  Nothing outside this package imports it."""
