"""Text cleaning as Column expressions.

Everything stays in the JVM except two steps Spark has no function for: NFKC and full HTML entity
decoding. Both go through Arrow, and only the rows that need them carry their text across; all
other rows send a null.
"""

import functools
import html
import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quirefold import fixed_values as fv

# Every character Unicode counts as white space (str.isspace), all below U+3001.
WHITESPACE = "".join(chr(c) for c in range(0x3001) if chr(c).isspace())


def _latin1_changed_by_nfkc() -> str:
    return "".join(chr(c) for c in range(0x100) if unicodedata.normalize("NFKC", chr(c)) != chr(c))


# Texts without any of these are in NFKC already: below U+0132 only some Latin-1 characters change,
# no combining character comes before U+0300, and common dashes and quotes (U+2012-2023) are stable.
_NEEDS_NFKC = f"[{_latin1_changed_by_nfkc()}\\x{{132}}-\\x{{2011}}\\x{{2017}}\\x{{2024}}-\\x{{10ffff}}]"

# Entities decoded in the JVM; "amp" comes last so that "&amp;lt;" is decoded once only.
_NATIVE_ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "nbsp": "\u00a0", "copy": "\u00a9",
                    "middot": "\u00b7", "#39": "'", "amp": "&"}
_OTHER_ENTITY = "&(?!(?:" + "|".join(_NATIVE_ENTITIES) + ");)"

# Not ASCII, but equal to s, k, i and i where case is ignored.
_OTHER_CASE = "\u017f\u212a\u0130\u0131"


# Texts of a batch that are Python strings at one time.
_TEXTS = 64


def text_by_text(texts: pa.Array, step, kind: pa.DataType) -> pa.Array:
    """``step`` of every text that is not null; few of a batch's texts and results are Python objects at one time."""
    done = [pa.array([None if t is None else step(t) for t in texts.slice(at, _TEXTS).to_pylist()], kind)
            for at in range(0, len(texts), _TEXTS)]
    return pa.concat_arrays(done) if done else pa.array([], kind)


@F.arrow_udf(T.StringType())
def _nfkc_arrow(texts: pa.Array) -> pa.Array:
    # Arrow's own utf8_normalize leaves NFKC decomposed.
    return text_by_text(texts, functools.partial(unicodedata.normalize, "NFKC"), pa.string())


@F.arrow_udf(T.StringType())
def _unescape_arrow(texts: pa.Array) -> pa.Array:
    return text_by_text(texts, html.unescape, pa.string())


def _once(c: Column, step) -> Column:
    """``step`` of a column that is computed once, however often the step names it."""
    return F.transform(F.array(c), step)[0]


def strip_ws(c: Column) -> Column:
    """Strip Unicode white space from both ends; null stays null."""
    return F.btrim(c, F.lit(WHITESPACE))


def has_text(c: Column) -> Column:
    """False for null, empty and white-space-only texts."""
    return F.coalesce(F.length(strip_ws(c)) > 0, F.lit(False))


def remove_invisible(c: Column) -> Column:
    """Drop soft hyphens and zero-width characters."""
    return functools.reduce(lambda acc, char: F.replace(acc, F.lit(char), F.lit("")), fv.INVISIBLE_CHARS, c)


def expand_ligatures(c: Column) -> Column:
    """Replace Latin ligatures by their letters (NFKC does the same, so clean_text needs no such step)."""
    return functools.reduce(lambda acc, kv: F.replace(acc, F.lit(kv[0]), F.lit(kv[1])), fv.LIGATURES.items(), c)


def nfkc(c: Column) -> Column:
    """Unicode NFKC."""
    return F.coalesce(_nfkc_arrow(F.when(c.rlike(_NEEDS_NFKC), c)), c)


def drop_boilerplate(c: Column, patterns=fv.BOILERPLATE_PATTERNS) -> Column:
    """Remove page headers, footers and lone page numbers: the patterns apply one after the other.

    A pattern is removed; a pair of pattern and replacement is replaced. A pattern with a word that it cannot do without
    (``fv.BOILERPLATE_WORDS``) is looked for only in texts that hold this word in any case.
    """
    pairs = [(p, "") if isinstance(p, str) else p for p in patterns]

    def applied(text: Column, pair) -> Column:
        return F.regexp_replace(text, *pair)

    def rare(text: Column) -> Column:
        words = sorted({fv.BOILERPLATE_WORDS[p] for p, _ in pairs if p in fv.BOILERPLATE_WORDS})
        if not words:
            return functools.reduce(applied, pairs, text)
        # Letters that match others in any case without being their capitals.
        held = functools.reduce(lambda acc, x: acc | text.contains(x), _OTHER_CASE, F.exists(F.array(F.lower(text)), lambda low: functools.reduce(
            lambda acc, w: acc | low.contains(w), words[1:], low.contains(words[0]))))
        rest = [pair for pair in pairs if pair[0] not in fv.BOILERPLATE_WORDS]
        return F.when(held, functools.reduce(applied, pairs, text)).otherwise(functools.reduce(applied, rest, text))

    return _once(c, rare)


def _where(c: Column, part: str, step) -> Column:
    """``step`` of the texts that hold a part; the others stay as they are."""
    return _once(c, lambda text: F.when(text.contains(part), step(text)).otherwise(text))


def dehyphenate(c: Column) -> Column:
    """Re-join words split by a hyphen at a line end."""
    return _where(c, "-\n", lambda text: F.regexp_replace(text, r"-\n(\S)", "$1"))


def squeeze_ws(c: Column) -> Column:
    """Runs of blanks and tabs become one blank, three or more line feeds become two."""
    # A blank on its own is one already.
    single = _once(c, lambda text: F.when(text.contains("  ") | text.contains("\t"), F.regexp_replace(text, r" [ \t]+|\t[ \t]*", " ")).otherwise(text))
    return _where(single, "\n\n\n", lambda text: F.regexp_replace(text, r"\n{3,}", "\n\n"))


def clean_text(c: Column, patterns=fv.BOILERPLATE_PATTERNS) -> Column:
    """The cleaning chain applied before chunking; null and empty pass through."""
    return strip_ws(squeeze_ws(dehyphenate(drop_boilerplate(nfkc(remove_invisible(c)), patterns))))


def unescape_entities(c: Column) -> Column:
    """Decode named and numeric HTML entities once."""
    native = functools.reduce(
        lambda acc, kv: F.replace(acc, F.lit(f"&{kv[0]};"), F.lit(kv[1])), _NATIVE_ENTITIES.items(), c)
    return F.coalesce(_unescape_arrow(F.when(c.rlike(_OTHER_ENTITY), c)), native)


def strip_tags(c: Column) -> Column:
    """Drop script and style blocks, turn opening block tags into line feeds, drop every other tag."""
    c = F.regexp_replace(c, fv.HTML_DROPPED_BLOCKS, "")
    c = F.regexp_replace(c, fv.HTML_LINE_BREAKS, "\n")
    return F.regexp_replace(c, fv.HTML_TAGS, "")


def html_to_text(c: Column) -> Column:
    """Plain text of an HTML fragment."""
    return strip_ws(squeeze_ws(unescape_entities(strip_tags(c))))


def token_estimate(c: Column) -> Column:
    """Four characters count as one token, at least one."""
    return F.greatest(F.lit(1), F.floor(F.length(c) / F.lit(4)).cast("int"))


def preview(c: Column, chars: int = fv.PREVIEW_CHARS) -> Column:
    return F.substring(c, 1, chars)


def is_truncated(c: Column, chars: int = fv.PREVIEW_CHARS, at_limit: bool = False) -> Column:
    """Whether a preview is shown with a trailing mark: past the limit, or already at it."""
    return F.length(c) >= chars if at_limit else F.length(c) > chars


def short_title(c: Column, chars: int = fv.TITLE_CHARS) -> Column:
    """Titles longer than the limit plus one are cut and marked."""
    return F.when(F.length(c) > chars + 1, F.concat(F.substring(c, 1, chars), F.lit("..."))).otherwise(c)
