"""One module per feed: its rules and ``transform(batch) -> Result``.

``transform`` takes a raw batch with its two lineage columns and does no I/O, so
the same code runs over a whole table, inside a micro-batch and in tests.
"""
