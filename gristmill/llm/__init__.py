"""Training-data pipeline operators: ten corpus operators and their queries.

Nothing else in the library imports this subpackage.  Each module holds one
operator with a general interface; ``queries.py`` binds the operators to the
registered ``opN_<name>`` queries.
"""
