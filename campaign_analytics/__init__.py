"""Campaign and growth analytics as Spark DataFrame jobs.

``functions``  Column -> Column helpers (URLs, text, dates, identity)
``operators``  DataFrame -> DataFrame building blocks (filters, joins, windows, numbering)
``sources``    report/job readers and the matching writers
``plans``      the domain jobs composed from the above
``streaming``  the same rules over Structured Streaming sources
"""
