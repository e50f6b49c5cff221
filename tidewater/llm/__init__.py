"""Operators for preparing training text for language models.

Each module holds one operator with its own general interface; ``queries``
applies every operator to the driver tables. Nothing else in the library
imports this subpackage."""
