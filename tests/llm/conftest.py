import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def make_docs(spark):
    """Documents from (doc_id, text, lang, source) rows; ``more`` adds constant columns."""
    from pyspark.sql import functions as F

    def make(rows, parts=3, **more):
        rows = [(i, t, *(rest + (None, None))[:2]) for i, t, *rest in ((r[0], r[1], *[tuple(r[2:])]) for r in rows)
                for rest in [rest[0]]]
        full = [(i, t, lang, src, None if t is None else len(t)) for i, t, lang, src in rows]
        df = spark.createDataFrame(full, SCHEMA).repartition(parts)
        return df.withColumns({k: F.lit(v) for k, v in more.items()}) if more else df

    return make


@pytest.fixture(scope="session")
def prose():
    """Deterministic made-up words: prose(seed, n) gives n of them."""
    import random

    def words(seed, n, stems=("ba", "ke", "lo", "mi", "nu", "ra", "se", "to", "vi", "zu")):
        r = random.Random(seed)
        return [r.choice(stems) + r.choice(stems) + r.choice(stems + ("",)) for _ in range(n)]

    return words
