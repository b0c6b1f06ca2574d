import hashlib
import random
import re

from closecast.llm.decontaminate import decontaminate
from tests.llm.helpers import clashing, corpus, frame, prose

BENCH = "item_id long, text string"


def words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(text, items):
    w = words(text)
    hit, found = set(), set()
    for item, t in items:
        iw = words(t)
        k = min(10, len(iw))
        wins = {tuple(iw[i:i + k]) for i in range(len(iw) - k + 1)} if iw else set()
        for i in range(len(w) - k + 1 if wins else 0):
            if tuple(w[i:i + k]) in wins:
                hit |= set(range(i, i + k))
                found |= {str(item)} if item is not None else set()
    ids = ",".join(sorted(found))
    return len(w), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


def test_against_brute_force(spark):
    rng = random.Random(1)
    rows = corpus(rng)
    items = [(i, prose(rng, rng.randrange(1, 40)).upper()) for i in range(8)] + [(20, None), (21, ""), (22, "one"), (None, "çødé ünï"), (8, prose(rng, 12)), (8, prose(rng, 12))]
    rows += [(200 + k, "Start " + (t or "")[:400].replace(" ", ",\n") + " End", "en", "s", 1) for k, (_, t) in enumerate(items)]
    rows.append((300, " ".join(t or "" for _, t in items), "en", "s", 1))
    for shard in (10, 1_000_000):  # many automata and one
        got = decontaminate(frame(spark, rows), spark.createDataFrame(items, BENCH), max_shard_words=shard).collect()
        assert len(got) == len(rows)
        want = sorted((repr(r[0]), brute(r[1], items)) for r in rows)
        assert sorted((repr(r.doc_id), (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)) for r in got) == want


def test_spans_map_to_the_original(spark):
    text = "Çé — before: THE quick, brown fox! Jumps over the lazy dog tonight (again) after"
    item = [(1, "the quick brown fox jumps over the lazy dog tonight again")]
    got = decontaminate(frame(spark, [(1, text, "en", "s", 1)], 1), spark.createDataFrame(item, BENCH)).first()
    (span,) = got.hit_spans
    assert text.encode()[span.start:span.end].decode() == "THE quick, brown fox! Jumps over the lazy dog tonight (again"


def test_empty_tables_and_clashing_columns(spark):
    docs = clashing(frame(spark, corpus(random.Random(2), 4)), "n_hit", "items_sha256", "extra")
    none = spark.createDataFrame([], BENCH)
    got = decontaminate(docs, none)
    assert got.where("contaminated or n_hit > 0").count() == 0 and got.columns.count("n_hit") == 1 and "extra" in got.columns
    assert decontaminate(docs.limit(0), none).count() == 0
