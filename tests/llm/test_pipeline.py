import __spark_entry__ as entry
import corpus_pipeline
from reviewlens.llm import mixing, overlap
from reviewlens.llm.queries import QUERIES
from tests.llm import test_contamination, test_overlap, test_quality
from tests.llm.conftest import FOLDER, TRICKY
from tests.llm.test_packing import expected, library, read  # noqa: F401


def keep_by_hand(rows):
    """Rows (id, text) that stay, one of each group of linked texts."""
    groups, kept, labels = {}, [], {}
    for doc, n, component in test_overlap.by_hand(rows):
        labels.setdefault(doc, set()).add((n > 0, component))
    for doc, text in rows:
        (filled, component), = labels[doc]
        if not filled:
            kept.append((doc, text))
        elif component == doc and doc not in groups:
            groups[doc] = text
            kept.append((doc, text))
    return kept


def test_keep_one_of_each_group(spark, documents):
    rows = test_overlap.near_copies(3)
    rows = list({doc: (doc, text) for doc, text in rows}.values())
    extra = [(*r, "x", 1) for r in rows + rows[:5]]  # repeated rows too
    df = spark.createDataFrame(extra, "doc_id long, text string, __join string, node int")
    kept = overlap.keep_one(df)
    assert kept.schema == df.schema
    assert sorted((r["doc_id"], r["text"]) for r in kept.collect()) == sorted(keep_by_hand(rows))


def test_keep_one_with_equal_ids_and_without_ids(spark, documents):
    a, b, c = ("one two three four five six seven", "uno dos tres cuatro cinco seis", "eins zwei drei vier fünf")
    rows = [(5, a), (5, b), (2, b), (None, c), (None, c), (None, a + " x"), (7, ""), (7, None)]
    kept = overlap.keep_one(spark.createDataFrame(rows, "doc_id long, text string"), percent=60)
    got = sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr)
    assert got == sorted([(5, a), (2, b), (None, c), (7, ""), (7, None)], key=repr)


def stage_by_hand(rows, items):
    rows = [r for r in rows if test_quality.by_hand(r[1])[-1]]
    rows = keep_by_hand(rows)
    return [r for r in rows if not test_contamination.by_hand(r[1], items)[1]]


def test_run_equals_plain_steps(spark, documents, library):  # noqa: F811
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    rows = stage_by_hand([(r["doc_id"], r["text"]) for r in documents.collect()], items)
    kept = documents.join(spark.createDataFrame([(r[0],) for r in rows], "doc_id long"), "doc_id", "left_semi")
    copies = {r["doc_id"]: r["copies"] for r in mixing.plan(kept).collect()}
    assert set(copies) == {r[0] for r in rows} and max(copies.values()) > 0
    mixed = [r for r in rows for _ in range(copies[r[0]])]
    assert read(entry.queries()["pipeline"](spark, FOLDER)) == expected(mixed, library)


def test_stages_keep_the_columns_and_take_edge_rows(spark, tricky):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5
    rows = spark.createDataFrame(
        [(*r[:4], 1, "x") for r in TRICKY], "doc_id long, text string, lang string, source string, n_chars int, size string"
    )
    for docs in (rows, rows.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, docs, FOLDER)
            assert out.schema == docs.schema
            out.count()
        assert corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).count() == docs.count()


def test_every_operator_is_registered():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 11))
    assert set(QUERIES) <= set(entry.queries())
