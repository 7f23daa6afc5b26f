"""Operators of a training-data pipeline (substring, line and SimHash dedup, HTML
extraction, language-model scoring, quotation linking, decontamination, URL lists,
quality rules, mixing, centroid clustering, byte-level BPE, filter audit).  Nothing else in
the package imports this folder.
"""
