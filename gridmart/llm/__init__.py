"""Training-data operators over document, label and embedding tables.

Every operator handles nulls, empty texts, very long texts, ties, repeated rows and empty
tables; the outcome of each case is stated in the operator's docstring. Nothing else in
the library imports this subpackage.
"""
