"""Training-data operators over ``documents`` and ``pages``.

Ten operators (one module each), their registered queries (``registry``) and
shared helpers. Nothing outside this package imports it.
"""
