"""Training-data operators: packing, decontamination, deduplication, quality, licences, scoring, secrets, counting."""
