import random

from corpus_pipeline import near_dedup
from tests.llm.helpers import edited, frame, prose


def test_rows_with_equal_or_null_ids(spark):
    """Different texts under one id all stay; copies without an id go."""
    rng = random.Random(51)
    a, b, c, d, e = (prose(rng, 60) for _ in range(5))
    rows = [(1, a, "en", "s", 1), (1, b, "en", "s", 1), (1, b, "en", "s", 1), (2, edited(rng, a, 0.02), "en", "s", 1), (None, c, "en", "s", 1), (None, c, "en", "s", 1),
            (None, edited(rng, b, 0.02), "en", "s", 1), (None, d, "en", "s", 1), (7, d, "en", "s", 1), (6, d, "en", "s", 1), (None, e, "en", "s", 1)]
    got = near_dedup(spark, frame(spark, rows), "").select("doc_id", "text").collect()
    assert sorted((repr(r.doc_id), r.text) for r in got) == sorted([("1", a), ("1", b), ("None", c), ("6", d), ("None", e)])
