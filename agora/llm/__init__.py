"""Training-data operators over the ``documents``, ``pages`` and
``benchmark`` tables.  Nothing else in the library imports this package."""
