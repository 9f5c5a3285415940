"""Operators for preparing language-model training data.

Nothing else in the library imports this subpackage. Each module holds one
operator (see its docstring for the result in edge cases); ``queries`` holds
the registered ``opN_<name>`` queries and their SQL.
"""
