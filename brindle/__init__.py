"""Spark analytics operators as plain DataFrame -> DataFrame functions.

``brindle.sources``    readers and writers for delimited and text inputs
``brindle.functions``  column expressions shared by the operators
``brindle.operators``  table analytics, nearest reference point, market baskets,
                       bipartite network inference
``brindle.plans``      the operators applied to the test tables, with SQL oracles
"""
