"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage.  Each operator module
has a general interface over DataFrames; :mod:`cohortguard.llm.queries` binds
them to the driver tables as ``opN_<name>``.
"""
