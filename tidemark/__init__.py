"""tidemark: the history of a sales business as PySpark DataFrames.

Every operator is a function from DataFrames to a DataFrame; persistence lives in
``tidemark.sources`` and ``tidemark.streaming``, ready-made reports in ``tidemark.plans``.
"""
