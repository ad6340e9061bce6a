"""Report-text analytics as Spark DataFrame jobs.

``functions``  column expressions (decode, redact, chunk, tokenise, distance)
``sources``    scans: fragment parquet, JSON lines, vectors
``sinks``      writes: JSON lines, CSV, vectors, cluster results
``operators``  DataFrame to DataFrame steps (assemble, join, aggregate, rank)
``plans``      whole jobs composed of the above
``streaming``  the stateless record steps on a file stream
``checks``     the registered queries and their SQL twins
"""
