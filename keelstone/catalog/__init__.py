"""All registered queries and their comparison SQL."""

from keelstone.catalog import checks, extras, joins, reports, standardise, storage

BOOKS = [
    standardise.book, joins.book, reports.book, checks.book, storage.book, extras.book,
]


def all_queries():
    return {name: query for book in BOOKS for name, query in book.queries.items()}


def all_sql():
    return {name: text for book in BOOKS for name, text in book.sql.items()}
