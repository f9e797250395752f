import pytest

LONG = " ".join(f"word{i % 977} and{i}" for i in range(60_000))
FIFTY = " ".join(f"shared{i}" for i in range(60))

# Nulls in every column, empty and very long texts, ties, repeated rows.
EDGE_ROWS = [
    (1, "A plain text of a few words, nothing more.", "en", "web", 41),
    (1, "A plain text of a few words, nothing more.", "en", "web", 41),
    (2, "A plain text of a few words, nothing more.", "de", None, None),
    (3, None, None, None, None),
    (4, "", "en", "web", 0),
    (5, " \n\t ", "en", "books", 4),
    (6, LONG, "en", "web", len(LONG)),
    (7, FIFTY, "en", "web", 300),
    (8, "before it " + FIFTY + " behind it", "en", "books", 330),
    (None, FIFTY, "en", "books", 330),
    (None, None, None, "web", None),
    (9, "ÄÖÜ ß €uro 字 \U0001f600 end", "de", "z", 9),
]
# Columns that the operators use inside, as extra columns of the input.
CLASHES = "key string, size long, fp long, row long, document_key string, position long, copies int"


@pytest.fixture()
def documents(table):
    schema = "doc_id long, text string, lang string, source string, n_chars long"

    def build(rows=EDGE_ROWS, clashes=True):
        if not clashes:
            return table(schema, *rows)
        wide = [(*r, "k", -1, -2, -3, "x", -4, -5) for r in rows]
        return table(f"{schema}, {CLASHES}", *wide)

    return build


@pytest.fixture()
def rows_of():
    """Rows as tuples, sorted with nulls first."""

    def rows(df, *names):
        found = [tuple(r) for r in (df.select(*names) if names else df).collect()]
        return sorted(found, key=lambda r: [(v is not None, v) for v in r])

    return rows
