"""Golden values of text, date, hash and vector functions."""

import datetime
import hashlib
import html
import time
import unicodedata

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quirefold import fixed_values as fv
from quirefold.functions import text as tx
from quirefold.functions import vectors as vx
from quirefold.functions.dates import in_date_range, parse_date, parse_iso_argument
from quirefold.functions.hashing import content_hash, document_id, source_hash

CLEANED = [
    ("A pol­i​tica oﬁcial", "A politica oficial"),
    ("do Banco Central do Brasil\nfoi", "do foi"),
    ("12ª fim x", "12a fim x"),
    ("t\nCopom - 12ª Reunião\nata", "t\nata"),
    ("abc\n\n 7 \n\ndef", "abc\n\ndef"),
    ("abc\n12\n13\ndef", "abc\n\ndef"),
    ("pós-\nfixado", "pósfixado"),
    ("x-\r\ny", "x-\r\ny"),
    ("a  \t b\n\n\n\nc ", "a b\n\nc"),
    ("x Página 1 de 9\ny", "x y"),
    ("x PÁGINA 1 DE 9\ny", "x y"),
    ("w www.bcb.gov.br\nz", "w z"),
    ("ﬅa ½", "sta 1⁄2"),
    ("7", ""),
    ("", ""),
    (None, None),
]


def test_clean_text(column):
    assert column([c[0] for c in CLEANED], lambda x: tx.clean_text(x)) == [c[1] for c in CLEANED]


def test_own_patterns(column):
    assert column(["-- cut --\nkeep"], lambda x: tx.clean_text(x, [r"(?m)^-- cut --\n"])) == ["keep"]


HTML = [
    ("<style>p{}</style><P class=x>Caf&eacute;&nbsp;A &amp; B<br/>C<td>1</td><td>2</td><!-- z --></p>",
     "Café A & B\nC12"),
    ("a\n\n\n\nD &amp;lt; E<link rel=x>F", "a\n\nD &lt; E\nF"),
    ("a<script>1</script>b<STYLE>2</style>c", "abc"),
    ("<pre>x</pre>", "x"),
    ("&#233; &copy x &amp;amp; &unknown; &", "é © x &amp; &unknown; &"),
    ("&lt;b&gt; &quot;q&quot; &#39;", "<b> \"q\" '"),
    (None, None),
]


def test_html_to_text(column):
    assert column([c[0] for c in HTML], lambda x: tx.html_to_text(x)) == [c[1] for c in HTML]


_TEXTS = st.lists(st.text(max_size=40), min_size=1, max_size=40)
_QUICK = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@_QUICK
@given(_TEXTS)
def test_nfkc_equals_unicodedata(column, texts):
    texts = [t.encode("utf-8", "ignore").decode() for t in texts]
    assert column(texts, lambda x: tx.nfkc(x)) == [unicodedata.normalize("NFKC", t) for t in texts]


@_QUICK
@given(st.lists(st.text(alphabet="&;#xalmpgtqunbs;39 c", max_size=30), min_size=1, max_size=60))
def test_unescape_equals_html_module(column, texts):
    assert column(texts, lambda x: tx.unescape_entities(x)) == [html.unescape(t) for t in texts]


@_QUICK
@given(_TEXTS)
def test_strip_equals_python(column, texts):
    texts = [" \t" + t.encode("utf-8", "ignore").decode() + " \x1c" for t in texts]
    assert column(texts, lambda x: tx.strip_ws(x)) == [t.strip() for t in texts]


def test_token_estimate(column):
    assert column(["", "a" * 7, "a" * 8, "a" * 2000], lambda x: tx.token_estimate(x)) == [1, 1, 2, 500]


def test_titles_and_previews(column):
    assert column(["t" * 51, "t" * 52], lambda x: tx.short_title(x)) == ["t" * 51, "t" * 50 + "..."]
    assert column(["p" * 200, "p" * 199], lambda x: tx.is_truncated(x, at_limit=True)) == [True, False]
    assert column(["p" * 300, "p" * 301], lambda x: tx.is_truncated(x, 300)) == [False, True]


DATES = [
    ("2024-01-31T10:00:00Z", (2024, 1, 31)), ("2024-1-5", (2024, 1, 5)), ("31/01/2024", (2024, 1, 31)),
    ("5/1/2024", (2024, 1, 5)), ("2024-01-31 10:00", (2024, 1, 31)), ("2024-02-30", None), ("24-01-05", None),
    ("", None), (None, None), ("2024-001-5", None), ("02024-1-5", None),
]


def test_parse_date(column):
    assert column([d[0] for d in DATES], lambda x: parse_date(x)) == [d[1] and datetime.date(*d[1]) for d in DATES]


def test_in_date_range(column):
    days = ["2023-12-31", "2024-01-01", "2024-12-31", "2025-01-01", None]
    lo, hi = datetime.date(2024, 1, 1), datetime.date(2024, 12, 31)

    def passes(*bounds):
        return column(days, lambda x: in_date_range(x.cast("date"), *bounds))

    assert passes(lo, hi) == [False, True, True, False, True]
    assert passes(lo) == [False, True, True, True, True]
    assert passes() == [True] * 5


def test_iso_argument():
    assert parse_iso_argument("2024-01-05") == datetime.date(2024, 1, 5) and parse_iso_argument(None) is None
    with pytest.raises(ValueError, match="05/01/2024"):
        parse_iso_argument("05/01/2024")


def test_hashes(spark, column):
    def made(x):
        return content_hash(x, F.lit("recursive"), F.lit(500), F.lit(20))

    assert column(["a"], made) == ["77742890cfbe91ef1eee8ad31124ad35916a5dbe5c0cbfc9f0cd57db76779546"]
    digest = hashlib.sha256("Reunião".encode()).hexdigest()
    assert column(["Reunião"], lambda x: source_hash(None, x)) == [digest]
    assert column(["Reunião"], lambda x: source_hash(x.cast("binary"), F.lit("other"))) == [digest]
    assert column(["", None], lambda x: source_hash(x.cast("binary"), x)) == ["", ""]
    assert column([digest], lambda x: document_id(x)) == [int(digest[:15], 16)]


def test_similarity(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 1.0]), (3, [-1.0, 0.0]), (4, None), (5, [0.0, 0.0]), (6, [1.0])]
    df = spark.createDataFrame(rows, "k int, v array<float>").orderBy("k")
    expected = [1.0, 0.0, 0.707107, -1.0, None, None, None]
    for scored in (vx.similarity_to(F.col("v"), [1.0, 0.0]), vx.cosine_similarity(F.col("v"), F.array(F.lit(1.0), F.lit(0.0)))):
        got = [r[0] for r in df.select(scored).collect()]
        assert [g if g is None else round(g, 6) for g in got] == expected


def test_vector_literal_round_trip(spark):
    values = np.random.default_rng(3).normal(size=(20, 7)).astype("float32").tolist()
    df = spark.createDataFrame([(v,) for v in values], "v array<float>")
    assert [r[0] for r in df.select(vx.parse_literal(vx.to_literal(F.col("v")))).collect()] == values
    assert df.select(vx.to_literal(F.array(F.lit(1.5), F.lit(-2.0)))).first()[0] == "[1.5,-2.0]"


def test_long_runs_of_line_feeds_are_read_once(column):
    texts = ["a" + "\n" * 2_000_000 + "7\nb", "\n" * 500_000, " \n7\n\n 8 \n", "x\n \n12\n\ny"]
    start = time.perf_counter()
    assert column(texts, lambda x: tx.clean_text(x)) == ["a\n\nb", "", "", "x\n\ny"]
    assert time.perf_counter() - start < 20


def test_cleaning_looks_only_where_it_must(spark):
    """What is skipped in texts that cannot match makes no difference to them or to others."""
    texts = ["", " ", "a  b\tc\t \td  ", "a b c", "\u00adx\u200b\ufeff", "BANCO central do BRASIL \nrest", "banco central do bra\u017fil\nx", "banco central do bras\u0131l\nx",
             "BANCO CENTRAL DO BRAS\u0130L\nx", "Copom - 12\u00aa REUNI\u00c3O\ny", "copom \u2013 3 reuni\u00e3o\ny", "Ata da 5a Reuni\u00e3o do Copom\nz",
             "WWW.BCB.GOV.BR\nq", "P\u00c1GINA 3 de 19 \nq", "Pa\u0301gina 3 de 19\nq", "bra\u212a www.bcb.gov.br\n", "x-\ny", "x-\n y", "a\n\n\n\nb", "a\n\nb", " 7 \n12\nx", None]
    c = F.col("t")
    plain = F.regexp_replace(c, f"[{fv.INVISIBLE_CHARS}]", "")
    plain = tx.nfkc(plain)
    for p in fv.BOILERPLATE_PATTERNS:
        plain = F.regexp_replace(plain, *((p, "") if isinstance(p, str) else p))
    plain = F.regexp_replace(plain, r"-\n(\S)", "$1")
    plain = tx.strip_ws(F.regexp_replace(F.regexp_replace(plain, r"[ \t]+", " "), r"\n{3,}", "\n\n"))
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(plain.alias("a"), tx.clean_text(c).alias("b")).collect()
    assert [r["a"] for r in rows] == [r["b"] for r in rows]


def test_few_texts_of_a_batch_are_python_objects():
    import tracemalloc

    import pyarrow as pa

    texts = pa.array([f"{i} " + "x" * 2000 for i in range(10_000)] + [None])
    tracemalloc.start()
    done = tx.text_by_text(texts, lambda t: [t[:900], t[900:]], pa.list_(pa.string()))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert done[9_999].as_py() == ["9999 " + "x" * 895, "x" * 1105] and done[10_000].as_py() is None
    assert peak < 4 << 20  # the texts are 20 MB, and so are the results
