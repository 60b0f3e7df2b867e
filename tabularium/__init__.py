"""Consolidation of large company registries as PySpark DataFrame functions.

``functions``  column expressions (keys, dates, labels, text repair, page extraction)
``operators``  DataFrame -> DataFrame steps (cleaning, joins, dedup, profiling)
``sources``    scans, schemas, sinks and file inventory
``plans``      the composed datasets: establishments, companies, partners, regime,
               consolidation, state extract, page enrichment
"""
