"""Operators for preparing training text, each built by one stated method.

Nothing outside this subpackage imports it. ``queries.QUERIES`` and
``queries.ORACLE`` hold the registered queries and their SQL.

General rules for all operators, unless a docstring says otherwise:

* Only the columns named are read, so further columns of any name do no harm.
* A null or empty text is a text without words; a null id is kept as null.
* Repeated rows each get their own result row.
* An empty table gives an empty result with the usual columns.
"""
