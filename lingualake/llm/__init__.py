"""Training-data operators: ten independent Spark operators over document, page and vector tables.

Nothing else in the library imports this subpackage.
"""
