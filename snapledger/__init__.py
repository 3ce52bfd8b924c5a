"""Operators for building and checking snapshot-based analytics warehouses on Spark.

``functions``  column expressions (periods, hashes, labels, stage measures)
``sources``    annual scans, run selection, schema rules, normalizers
``operators``  checks, version histories, validity joins, multi-level totals, corrections
``plans``      dimensions, facts, reports and the end-to-end warehouse builds
``storage``    table contracts, the shared work folder, validated publishing
"""
