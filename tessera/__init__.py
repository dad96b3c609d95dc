"""tessera: paged feature layers and their curation, as Spark DataFrame jobs.

A layer is read as a table of pages (JSON or compact binary bodies), pages
become typed feature rows with decoded geometry, and feature rows are curated
(column contract, casts, keep-latest, key coverage, rule validation) up to a
wide table with one row per building and one column per variable and year.
"""

from tessera.session import checkpoint_root, get_session

__all__ = ["checkpoint_root", "get_session"]
