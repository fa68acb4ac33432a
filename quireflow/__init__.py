"""Document-page analytics on PySpark: clean, chunk, encode, embed, score, evaluate.

Everything is a plain function from DataFrame to DataFrame or from Column to Column.
"""
