"""Training-data operators: dedup, scoring, tokenising, extraction.

Every operator takes a DataFrame and column names and returns a DataFrame;
``queries.py`` applies each to its whole table. Nothing outside this folder
imports it (``__spark_entry__.py`` adds its queries only when it is there).
"""
