"""Training-data operators: deduplication, filtering, decontamination, packing, archives, privacy and licences.

Nothing outside this folder imports it.
"""
