"""Gridded forecast analytics on PySpark.

``functions``  column expressions: physics, geography, names and dates, style
``operators``  DataFrame operators over grids, tiles, lines and probabilities
``sources``    where fields come from
``plans``      model manifests, cycle orchestration and the registered queries
``streaming``  Structured Streaming forms of the cycle
"""
