"""Operators of a training-data pipeline: rating, deduplication, packing, scoring.

Python tasks import these modules, so a cluster needs the package installed or
shipped with ``--py-files``.
"""
