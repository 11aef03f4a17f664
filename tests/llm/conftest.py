import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
# Names that operators use inside.
CLASHING = (
    "keep_id string, score double, h long, _h string, _h1 long, _id long, _text string, _row string, _score double, _copies int, _copy int, _source string, _size long, "
    "_number int, _digest string, _g long, _tree long, _fp long, shard int, slot long, position long, group_no long, tree long, key long, rid long, row long, fp long, size long, k int"
)


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text) or (doc_id, text, source); other columns are filled in, with names that operators use inside."""
    values = {"string": "x", "double": 1.5, "long": 7, "int": 3}
    extra = tuple(values[c.split()[1]] for c in CLASHING.split(", "))

    def make(rows):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "s", 0, *extra) for r in rows]
        return spark.createDataFrame(full, f"{DOCS}, {CLASHING}").repartition(3)

    return make
