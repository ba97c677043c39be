"""Training-data operators over the corpus tables (documents, pages, conversations, benchmark, labels).

Each operator is a module with a general interface; ``queries`` binds the
operators to the registered ``opN_<name>`` queries. Nothing outside this
subpackage imports it.
"""
