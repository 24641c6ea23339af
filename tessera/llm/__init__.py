"""Training-data operators: scoring, deduplication, decontamination, mixing, search,
sharding, URL and secret filters, language identification.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its queries when
it is present.
"""
