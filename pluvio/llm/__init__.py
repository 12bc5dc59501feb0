"""Corpus preparation operators: filtering, deduplication, decontamination, extraction, search and tokenising."""
