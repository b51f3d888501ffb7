"""Spark-native correspondence corpus and writing-style engine.

Sub-packages:

* ``functions``  Column -> Column building blocks (no shuffles, no UDFs)
* ``operators``  DataFrame -> DataFrame operators
* ``sources``    mailbox and JSONL readers and writers
* ``plans``      multi-step jobs: exact ranks, checked joins, corpus build
* ``streaming``  the row-wise part of the corpus build on a stream
"""
