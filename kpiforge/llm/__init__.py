"""Operators of a large-scale training-data pipeline.

Each module holds one operator with a general DataFrame interface; the driver
queries over the synthetic tables are in ``queries``. Nothing outside this
package imports it.
"""
