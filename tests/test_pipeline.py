"""Landed files to stored tables: resolution, ingestion, repeats, failures, streams, reports, deletes."""

import datetime
import hashlib
import json
import os
import shutil
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from quirefold import fixed_values as fv
from quirefold.operators.embedding import HashingProvider, embed_query, register_provider
from quirefold.operators.topk import ranked_top_k
from quirefold.plans import reports
from quirefold.plans.ingest import IngestOptions, ingest, ingest_batch, prepare_batch
from quirefold.plans.resolve import NO_BODY, from_texts, plan_ingest, resolve
from quirefold.plans.run import dry_run, run_batch, run_incremental
from quirefold.sources.landing import BodyIndex, read_bodies, read_detail, read_listing, read_pages
from quirefold.sources.store import ConflictError, DocumentStore, RunManifest
from quirefold.streaming.incremental import ingest_stream

cloudpickle.register_pickle_by_value(sys.modules[__name__])

FIRST, SECOND = fv.DOC_TYPES
OPTIONS = IngestOptions(size=20, overlap=4, provider_options={"dims": 16})


# --- landed files ---------------------------------------------------------------------------------

def _dump(path, payload):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(payload, ensure_ascii=False), encoding="utf-8")


def _item(number, day, title=None, key="nroReuniao"):
    return {"dataReferencia": day, key: number} | ({"titulo": title} if title is not None else {})


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    root = tmp_path_factory.mktemp("landed")
    _dump(root / "listing" / FIRST / "0001.json", {"conteudo": [
        _item(1, "2024-01-31T10:00:00Z", " First "), _item(2, "2024-2-5"), _item(3, None, "Three", "nro_reuniao"),
        _item(4, "2024-04-01"), _item(5, "05/05/2024"), _item(6, "2024-06-01"), _item(7, "2024-07-01"),
        _item(8, "2024-08-01"), {"titulo": "Numberless"}]})
    _dump(root / "listing" / SECOND / "0001.json", {"conteudo": [
        {"dataReferencia": "2023-12-31", "nro_reuniao": 0, "nroReuniao": 11}, _item(12, "2025-01-01"),
        _item(13, "2024-03-03", "Copy")]})
    _dump(root / "listing" / SECOND / "0002.json", {})
    detail = root / "detail"
    pdf = "/pdf/{}.pdf".format
    _dump(detail / FIRST / "1.json", {"conteudo": [{"urlPdfAta": pdf(1), "textoAta": "<p>unused</p>"}]})
    _dump(detail / FIRST / "2.json", {"conteudo": [{"urlPdfAta": "https://x.example/2.pdf", "textoAta": "<p>unused</p>"}]})
    _dump(detail / FIRST / "3.json", {"conteudo": [{"urlPdfAta": pdf(3), "textoAta": "<p>html three</p>"}]})
    _dump(detail / FIRST / "4.json", {"conteudo": [{"urlPdfAta": None, "textoAta": "<p>same text</p>"}]})
    _dump(detail / FIRST / "5.json", {"conteudo": [{"urlPdfAta": pdf(5), "textoAta": None}]})
    _dump(detail / FIRST / "6.json", {"conteudo": []})
    _dump(detail / FIRST / "7.json", {"conteudo": [{"textoAta": "<p> </p>"}]})
    _dump(detail / SECOND / "11.json", {"conteudo": [{"textoComunicado": "<div>eleven</div>"}]})
    _dump(detail / SECOND / "12.json", {"conteudo": [{"textoComunicado": "  "}]})
    _dump(detail / SECOND / "13.json", {"conteudo": [{"textoComunicado": "<p>same text</p>"}]})

    def key(url):
        return hashlib.sha256(url.encode()).hexdigest()

    urls = {1: fv.BASE_URL + pdf(1), 2: "https://x.example/2.pdf", 5: fv.BASE_URL + pdf(5)}
    (root / "bodies").mkdir()
    (root / "bodies" / f"{key(urls[1])}.pdf").write_bytes(b"%PDF one")
    (root / "bodies" / f"{key(urls[2])}.pdf").write_bytes(b"%PDF two")
    (root / "bodies" / f"{key(urls[5])}.pdf").write_bytes(b"")
    spark.createDataFrame(
        [(key(urls[1]), 2, "second page"), (key(urls[1]), 1, "first page"), (key(urls[1]), 3, ""), (key(urls[2]), 1, None)],
        "doc_key string, page_no int, text string").write.parquet(str(root / "pages"))
    return str(root)


def _sources(spark, root, **listing):
    read = [read_listing(spark, f"{root}/listing", t, **listing) for t in fv.DOC_TYPES]
    details = [read_detail(spark, f"{root}/detail", t) for t in fv.DOC_TYPES]
    return (read[0].unionByName(read[1]), details[0].unionByName(details[1]),
            read_bodies(spark, f"{root}/bodies"), read_pages(spark, f"{root}/pages"))


def _resolved(spark, root, **listing):
    return resolve(*_sources(spark, root, **listing))


def test_listing(spark, landed):
    rows = {(r["doc_type"], r["meeting_number"]): r for r in _sources(spark, landed)[0].collect()}
    assert len(rows) == 12
    assert rows[FIRST, 1]["title"] == "First" and rows[FIRST, 1]["meeting_date"] == datetime.date(2024, 1, 31)
    assert rows[FIRST, 2]["title"] == fv.TITLE_PREFIXES[FIRST] + " 2"
    assert rows[FIRST, 3]["list_pos"] == 2 and rows[FIRST, 0]["title"] == "Numberless"
    assert rows[SECOND, 11]["title"] == fv.TITLE_PREFIXES[SECOND] + " 11"


def test_plan_ingest_reads_no_bodies(spark, landed):
    out = plan_ingest(_sources(spark, landed)[0], fv.DOC_TYPES, datetime.date(2024, 1, 1), datetime.date(2024, 12, 31))
    got = {(r["doc_type"], r["meeting_number"]) for r in out.collect()}
    assert got == {(FIRST, n) for n in range(9)} | {(SECOND, 13)}
    plan = out._jdf.queryExecution().toString()
    assert "binaryFile" not in plan and "texto" not in plan


def test_resolution(spark, landed):
    rows = {(r["doc_type"], r["meeting_number"]): r for r in _resolved(spark, landed).with_texts().collect()}

    def got(key):
        r = rows[key]
        return r["url"], r["text"], r["page_count"], r["has_text"], r["error"]

    def detail(kind, n):
        return fv.DETAIL_URLS[kind] + str(n)

    assert got((FIRST, 1)) == (fv.BASE_URL + "/pdf/1.pdf", "first page\nsecond page", 3, True, None)
    assert got((FIRST, 2)) == ("https://x.example/2.pdf", None, 1, False, None)
    assert got((FIRST, 3)) == (detail(FIRST, 3), "html three", None, True, None)
    assert got((FIRST, 4)) == (detail(FIRST, 4), "same text", None, True, None)
    assert got((FIRST, 7))[1:] == ("", None, False, None)
    for key in ((FIRST, 5), (FIRST, 6), (FIRST, 8), (FIRST, 0), (SECOND, 12)):
        assert rows[key]["error"] == NO_BODY, key
    assert rows[FIRST, 1]["source_hash"] == hashlib.sha256(b"%PDF one").hexdigest()
    assert rows[FIRST, 4]["source_hash"] == hashlib.sha256("same text".encode()).hexdigest()
    assert rows[FIRST, 7]["source_hash"] == ""


def test_narrow_pass_leaves_page_texts_alone(spark, landed):
    assert "collect_list" not in _resolved(spark, landed).narrow._jdf.queryExecution().toString()


def test_ingest_from_landed_files(spark, landed, tmp_path):
    store = DocumentStore(spark, str(tmp_path / "store"))
    summary = ingest(spark, store.root, _resolved(spark, landed), "run", OPTIONS)
    # Stored: 1, 3, 4, 11. Processed without a row: 2 (PDF without text) and 7 (blank text). 13 copies 4.
    assert summary == {"documents_processed": 6, "chunks_inserted": 4, "quarantined": 5, "oversize": 0, "truncated": 0}
    documents = {r["title"]: r for r in store.documents().collect()}
    assert set(documents) == {"First", "Three", fv.TITLE_PREFIXES[FIRST] + " 4", fv.TITLE_PREFIXES[SECOND] + " 11"}
    assert documents["First"]["page_count"] == 3 and documents["First"]["ingested_at"] is not None
    texts = {r["chunk_text"] for r in store.chunks().collect()}
    assert texts == {"first page\nsecond page", "html three", "same text", "eleven"}
    assert {r["error"] for r in store.read("quarantine").collect()} == {NO_BODY}
    with pytest.raises(ValueError, match=NO_BODY):
        ingest(spark, str(tmp_path / "strict"), _resolved(spark, landed), "run", IngestOptions(skip_errors=False))


# --- repeats and failures -------------------------------------------------------------------------

def _texts(spark, rows, doc_type=FIRST, dated=True):
    df = spark.createDataFrame(rows, "list_pos long, text string")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("list_pos").cast("int")) if dated else F.lit(None).cast("date")
    return from_texts(df.select("list_pos", F.concat(F.lit("u"), "list_pos").alias("url"),
                                F.concat(F.lit("t"), "list_pos").alias("title"), F.lit(doc_type).alias("doc_type"),
                                day.alias("meeting_date"), "text"))


def _contents(store):
    documents = sorted((r["source_hash"], r["url"]) for r in store.documents().collect())
    chunks = sorted((r["document_id"], r["chunk_index"], r["content_hash"], tuple(r["embedding"]))
                    for r in store.chunks().collect())
    return documents, chunks


LONG = " ".join(f"word{i}" for i in range(120))
ROWS = [(0, "a text"), (1, LONG), (2, "a text"), (3, " \n "), (4, "another text"), (5, LONG + " more")]


def test_ingesting_twice_is_ingesting_once(spark, tmp_path):
    root = str(tmp_path / "s")
    first = ingest(spark, root, _texts(spark, ROWS), "a", OPTIONS)
    store = DocumentStore(spark, root)
    before = _contents(store)
    assert first["documents_processed"] == 5 and len(before[0]) == 4 and len(before[1]) == first["chunks_inserted"]
    same = ingest(spark, root, _texts(spark, ROWS), "a", OPTIONS)  # under the same name again
    assert (same["documents_processed"], same["chunks_inserted"]) == (1, 0) and _contents(store) == before
    again = ingest(spark, root, _texts(spark, ROWS), "b", OPTIONS)
    assert (again["documents_processed"], again["chunks_inserted"]) == (1, 0)  # only the blank text, every time
    assert _contents(store) == before
    indexes = [r["ix"] for r in store.chunks().groupBy("document_id").agg(F.sort_array(F.collect_list("chunk_index")).alias("ix")).collect()]
    assert all(ix == list(range(len(ix))) for ix in indexes)


def test_a_batch_that_broke_off_is_repaired_by_its_replay(spark, tmp_path, monkeypatch):
    store = DocumentStore(spark, str(tmp_path / "s")).create()
    whole = DocumentStore(spark, str(tmp_path / "w")).create()
    write = DocumentStore.write_batch

    def breaking(self, table, df):
        if table == "documents":
            raise OSError("lost")
        write(self, table, df)

    monkeypatch.setattr(DocumentStore, "write_batch", breaking)
    with pytest.raises(OSError):
        ingest_batch(store, _texts(spark, ROWS), OPTIONS, "run", "0")
    monkeypatch.setattr(DocumentStore, "write_batch", write)
    assert store.rows("chunks").count() > 0  # half-written, and not to be seen
    assert store.documents().count() == 0 and store.chunks().count() == 0
    assert reports.search_text(store, "a text", dims=16).count() == 0
    done = ingest_batch(store, _texts(spark, ROWS), OPTIONS, "run", "0")
    assert ingest_batch(store, _texts(spark, ROWS), OPTIONS, "run", "0") == done
    ingest_batch(whole, _texts(spark, ROWS), OPTIONS, "run", "0")
    assert _contents(store) == _contents(whole)
    assert reports.search_text(store, "a text", k=5, dims=16).count() == 5


def test_runs_under_one_name_add_up(spark, tmp_path):
    root = str(tmp_path / "s")
    ingest(spark, root, _texts(spark, ROWS), "history", OPTIONS)
    ingest(spark, root, _texts(spark, [(9, "a third")]), "history", OPTIONS)
    store = DocumentStore(spark, root)
    assert {r["url"] for r in store.documents().collect()} == {"u0", "u1", "u4", "u5", "u9"}
    before = _contents(store)
    store.compact()
    assert _contents(store) == before and store.commits().count() == 1
    assert ingest(spark, root, _texts(spark, ROWS), "history", OPTIONS)["chunks_inserted"] == 0


def test_quarantine_ends_when_the_body_arrives(spark, landed, tmp_path):
    store = DocumentStore(spark, str(tmp_path / "s")).create()
    missing = _resolved(spark, landed)
    first = ingest_batch(store, missing, OPTIONS, "run", "0")
    assert first["quarantined"] == 5
    none = ingest_batch(store, _texts(spark, [(50, "came late")]), OPTIONS, "run", "1")
    assert none["quarantined"] == 0 and none["documents_processed"] == 1


def test_documents_wait_for_their_bodies(spark, landed, tmp_path):
    """Listings first, details and bodies later: the next run takes them from quarantine, with no new listing."""
    empty = tmp_path / "landing"
    shutil.copytree(f"{landed}/listing", empty / "listing")
    for name in ("detail/" + FIRST, "detail/" + SECOND, "bodies"):
        (empty / name).mkdir(parents=True)
    spark.createDataFrame([], "doc_key string, page_no int, text string").write.parquet(str(empty / "pages"))
    store = DocumentStore(spark, str(tmp_path / "s"))

    def run():
        run_incremental(spark, str(empty), store.root, "daily", options=OPTIONS).awaitTermination()
        return store.documents().count(), store.read("quarantine").count()

    listed = read_listing(spark, f"{landed}/listing", FIRST).count() + read_listing(spark, f"{landed}/listing", SECOND).count()
    assert run() == (0, listed)
    commits = store.commits().count()
    shutil.copytree(f"{landed}/detail", empty / "detail", dirs_exist_ok=True)
    halfway = run()  # texts in HTML are there, PDFs are not
    assert 0 < halfway[0] and halfway[1] < listed and store.commits().count() == commits + 1
    for name in ("bodies", "pages"):
        shutil.copytree(f"{landed}/{name}", empty / name, dirs_exist_ok=True)
    whole = DocumentStore(spark, str(tmp_path / "w"))
    run_batch(spark, landed, whole.root, "once", options=OPTIONS)
    late = run()  # what has a PDF and no other text
    assert late[0] >= halfway[0] and late[1] == whole.read("quarantine").count() <= halfway[1]
    run_batch(spark, landed, store.root, "daily", options=OPTIONS)  # finds the PDFs of those taken as HTML
    assert {d["source_hash"] for d in store.documents().collect()} >= {d["source_hash"] for d in whole.documents().collect()}
    assert store.read("quarantine").count() == late[1]


def test_bodies_are_digested_once(spark, landed, tmp_path):
    index = BodyIndex(spark, str(tmp_path / "s"), f"{landed}/bodies")
    wanted = sorted(map(tuple, read_bodies(spark, f"{landed}/bodies").collect()))
    assert sorted(map(tuple, index.refresh().collect())) == wanted
    folder = tmp_path / "bodies"
    shutil.copytree(f"{landed}/bodies", folder)
    for f in folder.iterdir():
        os.utime(f, (1_700_000_000, 1_700_000_000))
    index = BodyIndex(spark, str(tmp_path / "s"), str(folder))
    assert sorted(map(tuple, index.refresh().collect())) == wanted
    key = "0" * 64
    (folder / f"{key}.pdf").write_bytes(b"new")
    kept = {p.name for p in folder.iterdir()}
    shutil.copytree(folder, tmp_path / "copy")
    got = dict(map(tuple, index.refresh().collect()))
    assert len(got) == len(wanted) + 1 and got[key] == hashlib.sha256(b"new").hexdigest() and len(kept) >= len(got)
    stored = spark.read.parquet(index.path).where("modified > timestamp'2024-01-01'")
    assert stored.count() == 1  # the old files were not read again


def test_a_broken_listing_is_quarantined(spark, landed, tmp_path):
    good = tmp_path / "l" / FIRST
    good.mkdir(parents=True)
    _dump(good / "a.json", {"conteudo": [{"titulo": "T", "nroReuniao": 3, "dataReferencia": "2024-01-31"}]})
    (good / "b.json").write_text('{"conteudo": [{"titulo": "cut o')
    listing = read_listing(spark, str(tmp_path / "l"), FIRST)
    assert sorted((r["title"], r["list_error"] is None) for r in listing.collect()) == [("T", True), ("b.json", False)]
    assert plan_ingest(listing, fv.DOC_TYPES).count() == 1
    _, *parts = _sources(spark, landed)
    done = ingest(spark, str(tmp_path / "s"), resolve(listing, *parts), "a", OPTIONS)
    assert (done["documents_processed"], done["quarantined"]) == (1, 1)
    with pytest.raises(ValueError, match="cannot be read"):
        ingest(spark, str(tmp_path / "x"), resolve(listing, *parts), "a", IngestOptions(skip_errors=False))


def test_two_writers_store_each_text_once(spark, tmp_path):
    one, two = (DocumentStore(spark, str(tmp_path / "s")).create() for _ in range(2))
    first = prepare_batch(one, _texts(spark, ROWS), OPTIONS, "first")
    third = prepare_batch(one, _texts(spark, ROWS + [(9, "only third")]), OPTIONS, "third")
    second = ingest_batch(two, _texts(spark, ROWS[:2] + [(8, "only second")]), OPTIONS, "second")
    done, last = first.commit(), third.commit()
    assert (second["documents_processed"], done["documents_processed"], last["documents_processed"]) == (3, 3, 2)
    hashes = [r["source_hash"] for r in one.documents().collect()]
    assert len(hashes) == len(set(hashes)) == 6
    alone = DocumentStore(spark, str(tmp_path / "w"))
    ingest(spark, alone.root, _texts(spark, ROWS + [(8, "only second"), (9, "only third")]), "a", OPTIONS)
    assert _contents(one)[1] == _contents(alone)[1]
    assert one.chunks().count() == sum(d["chunks_inserted"] for d in (second, done, last))


def test_two_texts_of_one_id(spark, tmp_path, monkeypatch):
    """Ids are part of a hash; a text whose id is taken is quarantined and not mixed up with the other."""
    from quirefold.plans import ingest as plan
    monkeypatch.setattr(plan, "document_id", lambda source_hash: F.lit(7).cast("bigint"))
    store = DocumentStore(spark, str(tmp_path / "s")).create()
    done = ingest_batch(store, _texts(spark, ROWS[:2]), OPTIONS, "a")
    assert (done["documents_processed"], done["quarantined"]) == (1, 1) and store.documents().count() == 1
    again = ingest_batch(store, _texts(spark, ROWS), OPTIONS, "b")
    assert again["quarantined"] == 3 and store.documents().count() == 1
    assert {r["error"] for r in store.read("quarantine").collect()} == {"violates unique:document_id"}


def test_two_attempts_at_one_batch(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path / "s")).create()
    attempts = [prepare_batch(store, _texts(spark, ROWS), OPTIONS, "run", "0") for _ in range(2)]
    assert attempts[0].commit() == attempts[1].commit() and store.commits().count() == 1


def test_deletes_and_compaction_beside_other_writers(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path / "s"))
    ingest(spark, store.root, _texts(spark, ROWS), "a", OPTIONS)
    create = store.create_commit
    between = []

    def interrupted(version, batch, **values):
        while between:
            between.pop()()
        return create(version, batch, **values)

    store.create_commit = interrupted
    other = DocumentStore(spark, store.root)
    between.append(lambda: other.delete(other.documents().where("url = 'u0'")))
    store.compact()  # a delete comes between: it holds for the new batch as well
    assert {r["url"] for r in store.documents().collect()} == {"u1", "u4", "u5"} and store.chunks().count() == other.chunks().count()
    between.append(other.compact)
    assert store.delete(store.documents().where("url = 'u1'"))["documents"] == 1  # looked up anew in the compacted batch
    assert {r["url"] for r in store.documents().collect()} == {"u4", "u5"}
    between.append(other.compact)
    with pytest.raises(ConflictError):
        store.compact()
    assert {r["url"] for r in store.documents().collect()} == {"u4", "u5"}
    between.append(lambda: ingest(spark, store.root, _texts(spark, [(9, "came between")]), "b", OPTIONS))
    assert store.delete_all()["documents"] == 3 and store.documents().count() == 0


def _stats(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_statistics_from_commits(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path / "s")).create()

    def same():
        assert _stats(reports.stats_of(store)) == _stats(reports.stats(store.documents(), store.chunks()))
        assert reports.stats_of(store).where("metric = 'documents'").first()["value"] == str(store.documents().count())

    same()
    for i in range(6):
        ingest(spark, store.root, _texts(spark, [(10 * i + j, f"text {i} {j} " * 9) for j in range(3)], SECOND if i % 2 else FIRST), f"r{i}", OPTIONS)
    same()
    assert "documents/" not in reports.stats_of(store)._jdf.queryExecution().toString()  # the tables are not read
    store.delete(store.documents().where("url in ('u0', 'u12', 'u51')"))
    same()
    before = _contents(store)
    written = store.compact_tiers(3)
    assert _contents(store) == before and 0 < written and store.commits().where("rows > 0").count() < 6
    same()
    store.delete(store.documents().where("url = 'u1'"))
    same()
    between, create = [lambda: DocumentStore(spark, store.root).delete(store.documents().where("url = 'u2'"))], store.create_commit

    def interrupted(version, batch, **values):
        while between:
            between.pop()()
        return create(version, batch, **values)

    store.create_commit = interrupted
    store.compact(store.live_batches())  # some batches, which happen to be all
    same()
    store.compact()
    same()
    first, second = (prepare_batch(store, _texts(spark, [(90, "both have this"), (n, f"own {n}")]), OPTIONS, f"w{n}") for n in (91, 92))
    first.commit()
    second.commit()
    same()
    store.delete_all()
    same()


def test_rows_are_written_once_for_each_tier(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path / "s")).create()
    total = written = 0
    for i in range(9):
        done = ingest(spark, store.root, _texts(spark, [(i, f"alone {i}")]), f"r{i}", OPTIONS)
        total += done["documents_processed"] + done["chunks_inserted"]
        written += store.compact_tiers(3)
    assert written <= 3 * total and store.documents().count() == 9 and store.chunks().count() == 9


def test_a_discarded_run_starts_afresh(spark, landed, tmp_path):
    store = DocumentStore(spark, str(tmp_path / "s"))
    run_incremental(spark, landed, store.root, "daily", options=OPTIONS).awaitTermination()
    n = store.documents().count()
    store.delete_all()
    run_incremental(spark, landed, store.root, "daily", options=OPTIONS).awaitTermination()
    assert store.documents().count() == 0  # the listings have been taken
    RunManifest(spark, store.root).discard("daily")
    assert RunManifest(spark, store.root).latest("daily") is None
    run_incremental(spark, landed, store.root, "daily", options=OPTIONS).awaitTermination()
    assert store.documents().count() == n


def test_vectors_of_another_length_are_refused(spark, tmp_path):
    root = str(tmp_path / "s")
    ingest(spark, root, _texts(spark, ROWS), "a", OPTIONS)
    with pytest.raises(ValueError, match="embedding_dimensions: stored 16, current 8"):
        ingest(spark, root, _texts(spark, [(9, "x")]), "b", IngestOptions(size=20, overlap=4, provider_options={"dims": 8}))


def test_limits_are_counted(spark, tmp_path):
    options = IngestOptions(strategy="window", size=2, overlap=0, max_chunks=3, max_bytes=60, provider_options={"dims": 16})
    done = ingest(spark, str(tmp_path / "s"), _texts(spark, [(0, "a b c d e f g h i"), (1, "x " * 60), (2, "y")]), "a", options)
    assert (done["oversize"], done["truncated"], done["chunks_inserted"]) == (1, 1, 4)


def test_delete_with_any_run_name(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path / "s"))
    ingest(spark, store.root, _texts(spark, ROWS), "r#1:x", OPTIONS)
    assert store.delete(store.documents().where("url = 'u0'")) == {"documents": 1, "chunks": 1}
    assert {r["url"] for r in store.documents().collect()} == {"u1", "u4", "u5"}
    assert store.delete(store.documents()) == {"documents": 3, "chunks": store.rows("chunks").count() - 1}
    assert store.chunks().count() == 0


def test_scoring_reads_no_texts(spark, filled):
    """Texts are read for the winners only, by their ids."""
    frame = reports.search(filled.documents(), filled.chunks(), embed_query(spark, "late text", dims=16), 2, complete=True)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "ReadSchema" in line and "chunk_text" in line]
    assert scans and all("embedding" not in line.split("ReadSchema")[1] and "In(document_id" in line for line in scans)


def test_two_stores_have_their_own_progress(spark, landed, tmp_path):
    counts = []
    for name in ("one", "two"):
        run_incremental(spark, landed, str(tmp_path / name), "daily", options=OPTIONS).awaitTermination()
        counts.append(DocumentStore(spark, str(tmp_path / name)).documents().count())
    assert counts == [4, 4]


@register_provider("brittle")
class Brittle(HashingProvider):
    """Cannot embed texts with one word."""

    fails = True

    def embed_batch(self, texts):
        if any("word77" in t for t in texts):
            raise RuntimeError("no word77")
        return super().embed_batch(texts)


def test_a_document_that_fails_is_quarantined_whole_and_retried(spark, tmp_path):
    root = str(tmp_path / "s")
    brittle = IngestOptions(size=20, overlap=4, provider="brittle", provider_options={"dims": 16}, batch_size=2)
    summary = ingest(spark, root, _texts(spark, ROWS), "a", brittle)
    store = DocumentStore(spark, root)
    assert summary["quarantined"] == 2 and summary["documents_processed"] == 3
    assert sorted(r["url"] for r in store.documents().collect()) == ["u0", "u4"]
    assert store.chunks().where("embedding is null").count() == 0 and store.chunks().count() == 2
    assert all("no word77" in r["error"] for r in store.read("quarantine").collect())
    ingest(spark, root, _texts(spark, ROWS), "b", OPTIONS)
    fresh = str(tmp_path / "f")
    ingest(spark, fresh, _texts(spark, ROWS), "a", OPTIONS)
    assert _contents(store) == _contents(DocumentStore(spark, fresh))
    with pytest.raises(Exception, match="no word77"):
        ingest(spark, str(tmp_path / "x"), _texts(spark, ROWS), "a", IngestOptions(
            provider="brittle", provider_options={"dims": 16}, skip_errors=False))


# --- streams --------------------------------------------------------------------------------------

def _stream(spark, landed, run, store, tmp_path, options=OPTIONS):
    listing, *landed_parts = _sources(spark, landed, streaming=True, max_files=1)
    query = ingest_stream(store, listing, lambda batch: resolve(batch, *landed_parts), run, options,
                          checkpoint=str(tmp_path / "progress" / run))
    query.awaitTermination()


def test_stream_equals_batch_and_resumes(spark, landed, tmp_path):
    store = DocumentStore(spark, str(tmp_path / "s"))
    batch = DocumentStore(spark, str(tmp_path / "b"))
    ingest(spark, batch.root, _resolved(spark, landed), "run", OPTIONS)
    _stream(spark, landed, "run", store, tmp_path)
    assert [h for h, _ in _contents(store)[0]] == [h for h, _ in _contents(batch)[0]]
    assert _contents(store)[1] == _contents(batch)[1]
    manifest = RunManifest(spark, store.root)
    state, batches = manifest.latest("run"), manifest._rows().count()
    assert state["processed_count"] == 6 and state["embedding_dimensions"] == 16 and state["chunk_size"] == 20
    before = _contents(store)
    _stream(spark, landed, "run", store, tmp_path)  # nothing new has arrived
    assert _contents(store) == before and manifest._rows().count() == batches
    _stream(spark, landed, "other", store, tmp_path)  # a new run starts afresh and finds all known
    assert _contents(store) == before
    with pytest.raises(ValueError, match="chunk_size: stored 20, current 30.*chunk_overlap|chunk_size"):
        _stream(spark, landed, "run", store, tmp_path, IngestOptions(size=30, overlap=4, provider_options={"dims": 16}))


def test_manifest(spark, tmp_path):
    manifest = RunManifest(spark, str(tmp_path))
    assert manifest.latest("r") is None
    manifest.check("r", embedding_dimensions=1536)
    manifest.save(run_name="r", embedding_dimensions=768, chunk_size=500)
    (tmp_path / "manifest" / "broken.json").write_text('{"run_name": "r", "run_')
    manifest.check("r", embedding_dimensions=768, chunk_size=500, chunk_overlap=3)  # absent: not compared
    with pytest.raises(ValueError, match="embedding_dimensions: stored 768, current 1536; chunk_size: stored 500, current 9"):
        manifest.check("r", embedding_dimensions=1536, chunk_size=9)
    manifest.check("new run", embedding_dimensions=1536)


# --- reports and deletes --------------------------------------------------------------------------

@pytest.fixture(scope="module")
def filled(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("filled"))
    ingest(spark, root, _texts(spark, ROWS), "a", OPTIONS)
    ingest(spark, root, _texts(spark, [(6, "late text"), (7, "alone")], SECOND, dated=False), "b", OPTIONS)
    return DocumentStore(spark, root)


def test_reports(filled):
    documents, chunks = filled.documents(), filled.chunks()
    stats = {(r["metric"], r["key"]): r["value"] for r in reports.stats(documents, chunks).collect()}
    assert stats["documents", ""] == "6" and stats["documents_of_type", SECOND] == "2"
    assert stats["first_date", ""] == "2024-01-01" and stats["last_date", ""] == "2024-01-06"
    listed = reports.list_documents(documents, chunks).collect()
    assert [r["title"] for r in listed[:4]] == ["t5", "t4", "t1", "t0"] and {r["title"] for r in listed[4:]} == {"t6", "t7"}
    long_id = next(r["document_id"] for r in listed if r["title"] == "t1")
    shown = reports.show_document(documents, chunks, long_id).collect()
    assert [r["chunk_index"] for r in shown] == list(range(len(shown))) and len(shown) > 5
    assert reports.show_document(documents, chunks, 1).count() == 0
    assert reports.delete_preview(documents, chunks, long_id).first()["chunks"] == len(shown)
    assert "embedding" not in reports.show_document(documents, chunks, long_id)._jdf.queryExecution().executedPlan().toString()


def test_search_is_the_same_with_and_without_the_join_first(spark, filled):
    documents, chunks = filled.documents(), filled.chunks()
    query = embed_query(spark, "late text", dims=16)
    for doc_type in (None, FIRST, SECOND):
        for k in (1, 3, 100):
            a = [tuple(r) for r in reports.search(documents, chunks, query, k, doc_type).orderBy("rank").collect()]
            b = [tuple(r) for r in reports.search(documents, chunks, query, k, doc_type, complete=True).orderBy("rank").collect()]
            owned = chunks.count() if doc_type is None else chunks.where(F.col("doc_type") == doc_type).count()
            assert a == b and len(a) == min(k, owned)
    best = reports.search(documents, chunks, query, 1).first()
    assert best["chunk_text"] == "late text" and round(best["similarity"], 6) == 1 and best["rank"] == 1


def test_search_for_more_chunks_than_the_driver_takes(spark, filled):
    documents, chunks = filled.documents(), filled.chunks()
    query = embed_query(spark, "late text", dims=16)
    for doc_type in (None, FIRST):
        small = [tuple(r) for r in reports.search(documents, chunks, query, 100, doc_type).orderBy("rank").collect()]
        for complete in (False, True):
            frame = reports.search(documents, chunks, query, 10**6, doc_type, complete=complete)
            assert [tuple(r) for r in frame.orderBy("rank").collect()] == small
            assert not {"Window", "LocalLimit", "TakeOrderedAndProject"} & set(frame._jdf.queryExecution().optimizedPlan().toString().split())
    scored = spark.range(1000).selectExpr("id AS document_id", "0 AS chunk_index", "cast(id % 7 AS double) AS similarity")
    ranks = ranked_top_k(scored, 500, ["document_id", "chunk_index"]).orderBy("rank").collect()
    expected = sorted(range(1000), key=lambda i: (-(i % 7), i))[:500]
    assert [r["document_id"] for r in ranks] == expected and [r["rank"] for r in ranks] == list(range(1, 501))
    assert reports.search(documents, chunks.limit(0), query, 10**6).count() == 0


def test_empty_tables(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path / "e")).create().create()
    stats = {(r["metric"], r["key"]): r["value"] for r in reports.stats(store.documents(), store.chunks()).collect()}
    assert stats == {("documents", ""): "0", ("chunks", ""): "0", ("first_date", ""): None, ("last_date", ""): None}
    assert reports.search(store.documents(), store.chunks(), [1.0, 0.0]).count() == 0


def test_register_for_sql(spark, filled):
    spark.sql("CREATE DATABASE IF NOT EXISTS reg")
    filled.register("reg")
    filled.register("reg")
    assert spark.sql("SELECT count(*) FROM reg.documents").first()[0] == 6
    assert spark.sql("SELECT count(*) FROM reg.chunks c JOIN reg.documents d USING (document_id)").first()[0] == filled.chunks().count()


def test_delete_and_delete_all(spark, tmp_path):
    store = DocumentStore(spark, str(tmp_path / "s"))
    ingest(spark, store.root, _texts(spark, ROWS), "a", OPTIONS)
    ingest(spark, store.root, _texts(spark, [(9, "only one here")]), "b", OPTIONS)
    chunk_total = store.chunks().count()
    doomed = store.documents().where("title in ('t1', 't9')")
    ids = [r["document_id"] for r in doomed.collect()]
    lost = store.chunks().where(F.col("document_id").isin(ids)).count()
    assert store.delete(doomed) == {"documents": 2, "chunks": lost}
    assert store.documents().count() == 3 and store.chunks().count() == chunk_total - lost
    assert store.chunks().where(F.col("document_id").isin(ids)).count() == 0
    gone = spark.createDataFrame([(i,) for i in ids], "document_id long")
    assert store.delete(gone) == {"documents": 0, "chunks": 0}
    # A deleted document may come back.
    assert ingest(spark, store.root, _texts(spark, ROWS), "c", OPTIONS)["chunks_inserted"] == lost - 1
    assert store.delete_all() == {"documents": 4, "chunks": chunk_total - 1}
    assert store.documents().count() == 0 and store.chunks().count() == 0
    assert ingest(spark, store.root, _texts(spark, ROWS), "a", OPTIONS)["documents_processed"] == 5


# --- whole runs -----------------------------------------------------------------------------------

def test_runs_over_a_landing_folder(spark, landed, tmp_path):
    day = datetime.date(2024, 2, 1)
    planned = {(r["doc_type"], r["meeting_number"]) for r in dry_run(spark, landed, SECOND, day).collect()}
    assert planned == {(SECOND, 12), (SECOND, 13)}
    root = str(tmp_path / "s")
    assert run_batch(spark, landed, root, "one", SECOND, day, options=OPTIONS) == {
        "documents_processed": 1, "chunks_inserted": 1, "quarantined": 1, "oversize": 0, "truncated": 0}
    run_incremental(spark, landed, root, "two", options=OPTIONS, checkpoint=str(tmp_path / "c")).awaitTermination()
    store = DocumentStore(spark, root)
    assert store.documents().count() == 4
    found = reports.search_text(store, "first page second page", 1, dims=16).first()
    assert found["title"] == "First" and round(found["similarity"], 6) == 1
    with pytest.raises(ValueError, match="embedding_dimensions: stored 16, current 8"):
        run_batch(spark, landed, root, "one", options=IngestOptions(size=20, overlap=4, provider_options={"dims": 8}))
