"""Operators for training-data preparation over the `documents` table. Nothing else in the library imports this
subpackage; `queries.py` registers its queries and `sql.py` holds their DuckDB SQL."""
