"""Web-commerce and marketplace analytics as Spark DataFrame operators.

Every operator takes DataFrames and returns a DataFrame.  Nothing here collects
rows to the driver, and nothing runs row-at-a-time Python: the whole library is
built-in expressions, so plans stay inside whole-stage code generation.
"""
