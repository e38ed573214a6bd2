"""Spark SQL expressions as text: compositions of built-ins, no UDFs.

Each function takes and returns SQL text, for ``selectExpr``, ``F.expr`` or a query. A
projection of twenty nested columns is then one string to parse instead of hundreds of
calls into the JVM. Inside an array, ``e`` is the element.
"""
