"""Training-data operators: text corpora as Spark tables.

Nothing else in the library imports this subpackage; ``__spark_entry__.py``
adds its queries when it is present.  Each module holds one operator and its
docstring states what happens to nulls, empty and repeated rows; ``queries``
holds the thin registered queries and their SQL.
"""
