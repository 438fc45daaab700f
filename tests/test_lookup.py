"""Documents looked up by id in a store of several batches, some of them compacted."""

from quirefold.plans.ingest import IngestOptions, ingest
from quirefold.plans.resolve import from_texts
from quirefold.sources.store import DocumentStore
from pyspark.sql import functions as F

OPTIONS = IngestOptions(strategy="window", size=12, overlap=2, provider_options={"dims": 8}, doc_types=None)
KINDS = ("a b", "c+d%/é", None)


def texts(spark, ids):
    rows = [(i, f"d{i} " + " ".join(f"w{(i * 7 + j * j) % 83}" for j in range(30)), KINDS[i % 3] or "plain") for i in ids]
    df = spark.createDataFrame(rows, "list_pos long, text string, doc_type string")
    return from_texts(df.selectExpr("list_pos", "'u' AS url", "'t' AS title", "doc_type", "cast(null AS date) AS meeting_date", "text"))


def test_lookup(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path / "s p"))
    for start in (0, 40):
        ingest(spark, store.root, texts(spark, range(start, start + 40)), f"run {start}", OPTIONS)
    store.compact(file_rows=10)
    files = store.rows("files").where("tab = 'documents'").collect()
    assert len(files) >= 8
    ingest(spark, store.root, texts(spark, range(80, 90)), "later", OPTIONS)  # this batch is not laid out by id
    ids = [r[0] for r in store.documents().orderBy("document_id").select("document_id").collect()]
    assert len(ids) == 90
    for wanted in (ids[0], ids[45], ids[-1], 12345):
        assert sum(f["lo"] <= wanted <= f["hi"] for f in files) <= len(KINDS)
        for table in ("documents", "chunks"):
            there = store.read(table).where(F.col("document_id") == wanted)
            assert sorted(map(str, store.lookup(table, wanted).collect())) == sorted(map(str, there.collect()))
    by_kind = {r["doc_type"]: r["document_id"] for r in store.documents().select("doc_type", "document_id").collect()}
    assert len(by_kind) == 3 and all(store.lookup("documents", i).count() == 1 for i in by_kind.values())
    store.delete(store.documents().where(F.col("document_id") == ids[45]))
    assert store.lookup("documents", ids[45]).count() == store.lookup("chunks", ids[45]).count() == 0
    store.delete_all()
    assert store.lookup("documents", ids[0]).count() == 0


def test_compacted_kinds_share_no_ranges(spark, tmp_path):
    """Files are as many as ranges, and not one for each range and kind."""
    store = DocumentStore(spark, str(tmp_path / "s"))
    ingest(spark, store.root, texts(spark, range(90)), "run", OPTIONS)
    store.compact(file_rows=10)
    assert 9 <= store.rows("files").where("tab = 'documents'").count() <= 9 + len(KINDS)
