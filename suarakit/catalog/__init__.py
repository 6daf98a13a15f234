"""Named queries over the fixture tables, each with an SQL text giving the expected result."""

from suarakit.catalog import complaints, duplicates, labelling, pages, records, streams, texts

_MODULES = (texts, complaints, labelling, records, duplicates, pages, streams)

QUERIES = {name: fn for m in _MODULES for name, fn in m.QUERIES.items()}
SQL = {name: sql for m in _MODULES for name, sql in m.SQL.items()}
