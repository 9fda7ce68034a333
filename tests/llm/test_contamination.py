import re

from reviewlens.llm import contamination
from tests.llm.conftest import rows_of

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
ITEMS = [
    (1, "What is the capital of France? The capital of France is Paris, of course."),
    (2, "short answer"),
    (2, "short answer"),
    (3, None),
    (4, "..."),
    (None, "an item without any id in it"),
    (10, "élan 漢字 x1"),
]


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def by_hand(text, items):
    own, hit, found = words(text), set(), set()
    for name, item in items:
        parts = words(item)
        for s in range(max(1, len(parts) - 9) if parts else 0):
            window = parts[s : s + 10]
            for k in range(len(own) - len(window) + 1):
                if own[k : k + len(window)] == window:
                    hit |= set(range(k, k + len(window)))
                    if name is not None:
                        found.add(str(name))
    return len(own), sorted(hit), sorted(found)


DOCS = [
    (1, "well: WHAT is the capital of france -- the capital of France IS paris of course, yes"),
    (2, "a short   ANSWER and a short answer; short, answer"),
    (3, None),
    (4, ""),
    (5, "an item without any id in it"),
    (None, "Élan"),
    (6, "élan 漢字 x1 élan 漢字 x1"),
    (6, "élan 漢字 x1 élan 漢字 x1"),
    (7, "what is the capital of france the capital of germany"),
    (8, "short\x00answer shorter answer"),
]


def frames(spark):
    docs = spark.createDataFrame([(*d, "x", 1) for d in DOCS], "doc_id long, text string, items string, n_words int")
    items = spark.createDataFrame([(*i, "y") for i in ITEMS], "item_id long, text string, doc_id string")
    return docs, items


def check(got, docs, items):
    want = sorted(((d, *by_hand(t, items)) for d, t in docs), key=repr)
    assert rows_of(got, "doc_id", "n_words", "hit_words", "items") == want


def test_equals_search_for_every_window(spark, tricky):
    docs, items = frames(spark)
    check(contamination.contamination(docs, items), DOCS, ITEMS)


def test_several_automata_give_the_same(spark, tricky):
    docs, items = frames(spark)
    check(contamination.contamination(docs, items, max_words=9), DOCS, ITEMS)


def test_no_items_and_no_documents(spark, tricky):
    docs, items = frames(spark)
    assert contamination.contamination(docs.limit(0), items).count() == 0
    assert {len(r["hit_words"]) for r in contamination.contamination(docs, items.limit(0)).collect()} == {0}


def test_clean_documents_stay_whole(spark, tricky):
    docs, items = frames(spark)
    kept = contamination.clean_documents(docs, items)
    assert kept.schema == docs.schema
    want = [d for d, t in DOCS if not by_hand(t, ITEMS)[1]]
    assert sorted((r["doc_id"] for r in kept.collect()), key=repr) == sorted(want, key=repr)
    twice = contamination.clean_documents(docs, items, max_words=9)
    assert sorted((r["doc_id"] for r in twice.collect()), key=repr) == sorted(want, key=repr)


def test_spans_are_places_in_the_original_text():
    text = "É: A short,  ANSWER! 漢 short answer"
    items = contamination.Items([("2", words("short answer"))])
    assert [text[a:b] for a, b in contamination.spans(text, items)] == ["short,  ANSWER", "short answer"]
