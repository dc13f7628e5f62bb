"""Operators for preparing training text at scale.

One module per operator, plus ``queries`` (registered queries and their SQL)
and ``stages`` (the corpus pipeline's stages).  Nothing outside this
subpackage imports it.
"""
